"""Silver to gold: the full rebuild, and the rebuild of single days."""

from __future__ import annotations

from datetime import date
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import with_ymd
from ..operators.counters import KEYS, TOTALS, counted
from ..operators.event_date import media_days, own_day, resolve_event_date
from ..operators.gold import media_daily, media_sums, visitor_daily, visitor_sums
from ..operators.sketches import visitor_sketches
from ..session import together
from ..sources.tables import (
    YMD,
    drop_days,
    drop_folder,
    read_silver,
    write_full,
    write_gold,
)
from .latest_media import read_latest_media

MEDIA, VISITOR = "agg_media_daily", "agg_visitor_daily"
SKETCHES = "agg_visitor_sketch"


def run_gold(
    spark: SparkSession,
    silver_base: str,
    gold_base: str,
    mode: str = "latest_activity",
    interactions: str = "rows",
    counters: str = "daily",
    sketches: bool = False,
) -> dict[str, int]:
    """Rebuild both gold tables from all of silver; returns the rows written.

    ``sketches`` adds a table with a sketch of the visitors per media and day, from which the
    distinct visitors of any range and selection are got without reading visitor rows.

    The folders are replaced as a whole: a late change can move a row to another event date, and
    a partition-wise overwrite would leave its old copy behind.
    """
    fact = read_silver(spark, silver_base, "fact_media_engagement")
    media = read_latest_media(spark, silver_base)
    frames = {
        MEDIA: media_daily(fact, media, mode, counters=counters),
        VISITOR: visitor_daily(fact, media, mode, interactions, counters=counters),
    }
    if sketches:
        dated = resolve_event_date(counted(fact, counters), media, mode)
        frames[SKETCHES] = visitor_sketches(dated)
    done = together(*[
        partial(write_full, with_ymd(df), gold_base, table, by=YMD, rows_as="rows")
        for table, df in frames.items()
    ])
    return {table: seen.get.get("rows", 0) for table, seen in zip(frames, done)}


class GoldRefresh:
    """Bring gold up to date after some silver days are rebuilt.

        refresh = GoldRefresh(spark, silver, gold, days, snapshot)  # before the rebuild
        run_silver(spark, bronze, silver, days)
        refresh.apply()                                             # after it

    The event dates to rebuild are those the rows of the days had before, those they have now, and
    both creation days of every media whose day moved. They are rebuilt from silver; a date left
    without rows is deleted. ``mode``, ``interactions``, ``counters`` and ``sketches`` must be those
    gold was built with.

    With running totals a new day also changes what other days' rows count for: the row before it
    stops being the latest, or the row after it adds less. What all rows of the media and visitors
    that the days have, or had, count for is therefore kept before the rebuild and compared after it;
    the dates of what differs are touched too, and their rows counted anew from all rows of their
    media and visitor.

    ``snapshot`` is a folder all executors share; the media days and the counts as they were go there
    until ``apply`` is through, however that ends. The dates stay a table: stamps that are wrong but
    readable make it longer, and nothing else. The first gold of all comes from ``run_gold``, and so
    does the gold after a run that died between the two steps.
    """

    def __init__(
        self,
        spark: SparkSession,
        silver_base: str,
        gold_base: str,
        days: list[str],
        snapshot: str,
        mode: str = "latest_activity",
        interactions: str = "rows",
        counters: str = "daily",
        sketches: bool = False,
    ):
        self.spark, self.silver_base, self.gold_base = spark, silver_base, gold_base
        self.days, self.snapshot = days, snapshot
        self.mode, self.interactions, self.counters = mode, interactions, counters
        self.sketches = sketches
        media_days(read_latest_media(spark, silver_base)).write.parquet(f"{snapshot}/media")
        fact = self._fact()
        changing = self._in_days(fact)
        self._stated(fact.where(changing)).write.parquet(f"{snapshot}/stated")
        if counters != "daily":
            pairs = self._kept(fact.where(changing).select(*KEYS).distinct(), "pairs-before")
            before = counted(fact.join(pairs, [*KEYS], "left_semi"), counters)
            self._counts(before).write.parquet(f"{snapshot}/before")

    def _fact(self) -> DataFrame:
        return read_silver(self.spark, self.silver_base, "fact_media_engagement")

    def _kept(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.snapshot}/{name}")
        return self._read(name, df)

    def _read(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(f"{self.snapshot}/{name}")

    def _in_days(self, fact: DataFrame) -> Column:
        days = F.col("dt").isin([F.lit(d).cast("date") for d in self.days])
        return F.coalesce(days, F.lit(False))

    def _counts(self, rows: DataFrame) -> DataFrame:
        """What rows add to gold, and the day they state."""
        return rows.select(*KEYS, *TOTALS, own_day(rows, self.mode).alias("day"))

    def _stated(self, rows: DataFrame) -> DataFrame:
        """Media and stated day of rows, once each."""
        return rows.select("media_id", own_day(rows, self.mode).alias("day")).distinct()

    def apply(self) -> list[date | None]:
        """Rebuild the touched event dates; returns them in order, the missing date first."""
        try:
            return self._apply()
        finally:
            drop_folder(self.spark, self.snapshot)

    def _changed(self) -> DataFrame:
        """Media and stated day of the rows that the days have or had, and of what else counts now
        and did not before, or the other way round."""
        fact = self._fact()
        changing = self._in_days(fact)
        now = self._stated(fact.where(changing))
        changed = now.unionByName(self._read("stated", now))
        if self.counters != "daily":
            changed = changed.unionByName(self._differing(fact, changing))
        return changed.distinct()

    def _differing(self, fact: DataFrame, changing: Column) -> DataFrame:
        old_pairs = self._read("pairs-before", fact.select(*KEYS))
        now = fact.where(changing).select(*KEYS).distinct()
        new_pairs = self._kept(now.join(old_pairs, [*KEYS], "left_anti"), "pairs-new")
        pairs = old_pairs.unionByName(new_pairs)
        after = self._counts(counted(fact.join(pairs, [*KEYS], "left_semi"), self.counters))
        # Media and visitors that are new to the days had only their other rows before.
        others = fact.where(~changing).join(new_pairs, [*KEYS], "left_semi")
        before = self._read("before", after).unionByName(
            self._counts(counted(others, self.counters))
        )
        both = after.withColumn("n", F.lit(1)).unionByName(before.withColumn("n", F.lit(-1)))
        differing = both.groupBy(*after.columns).agg(F.sum("n").alias("n")).where("n <> 0")
        return differing.select("media_id", "day")

    def _touched(self) -> DataFrame:
        """The event dates to rebuild, once each."""
        changed = self._kept(self._changed(), "changed")
        stated = changed.where("day is not null").select(F.col("day").alias("event_date"))
        undated = changed.where("day is null").select("media_id")
        if self.mode == "first_seen":
            touched = stated.unionByName(undated.select(F.lit(None).cast("date").alias("event_date")))
        else:
            new = media_days(read_latest_media(self.spark, self.silver_base))
            old = self._read("media", new).withColumnRenamed("media_created_date", "old")
            new = new.withColumnRenamed("media_created_date", "new")
            days = old.join(new, "media_id", "full")
            moved = days.where(~F.col("old").eqNullSafe(F.col("new")))
            both = F.explode(F.array("old", "new")).alias("event_date")
            touched = stated.unionByName(moved.select(both)).unionByName(
                undated.join(days, "media_id", "left").select(both)
            )
        return self._kept(touched.distinct(), "touched")

    def _apply(self) -> list[date | None]:
        touched = self._touched()
        fact, media = self._fact(), read_latest_media(self.spark, self.silver_base)
        # Rows that state a day outside the touched range are not read, those that state another
        # day in between go before the shuffle, and what is left is built into both tables.
        ends = touched.agg(F.min("event_date").alias("a"), F.max("event_date").alias("b")).first()
        rows = self._stating(fact, ends["a"], ends["b"])
        if self.counters != "daily":
            pairs = self._kept(self._of_dates(rows, touched).select(*KEYS).distinct(), "pairs")
            rows = counted(fact.join(pairs, [*KEYS], "left_semi"), self.counters)
        dated = resolve_event_date(self._of_dates(rows, touched), media, self.mode)
        days = touched.withColumnRenamed("event_date", "_day")
        same_day = dated["event_date"].eqNullSafe(F.col("_day"))
        kept = self._kept(
            dated.join(days, same_day, "left_semi").select(*KEYS, *TOTALS, "event_date"), "rows"
        )
        frames = {MEDIA: media_sums(kept), VISITOR: visitor_sums(kept, self.interactions)}
        if self.sketches:
            frames[SKETCHES] = visitor_sketches(kept)
        together(*[partial(write_gold, df, self.gold_base, table) for table, df in frames.items()])
        built = kept.select(F.col("event_date").alias("_day")).distinct()
        empty = touched.join(built, touched["event_date"].eqNullSafe(F.col("_day")), "left_anti")
        for row in empty.toLocalIterator():
            for table in frames:
                drop_days(self.spark, self.gold_base, table, [row])
        return [row["event_date"] for row in touched.orderBy("event_date").toLocalIterator()]

    def _of_dates(self, rows: DataFrame, touched: DataFrame) -> DataFrame:
        """Rows that state a touched date, or none."""
        rows = rows.withColumn("_own", own_day(rows, self.mode))
        stated = rows.join(touched.withColumnRenamed("event_date", "_own"), "_own", "left_semi")
        return rows.where("_own is null").unionByName(stated.select(*rows.columns)).drop("_own")

    def _stating(self, fact: DataFrame, low: date | None, high: date | None) -> DataFrame:
        """Rows whose stated day may lie in a range, by plain comparisons that reach the files."""
        first = F.col("first_seen").isNull()
        inside = first
        if low:
            day = (F.col("first_seen") >= F.lit(low)) & (
                F.col("first_seen") < F.date_add(F.lit(high), 1)
            )
            inside = inside | day
        if self.mode == "first_seen":
            return fact.where(inside)
        last = F.col("last_active")
        if low:
            recent = (last >= F.lit(low)) & (last < F.date_add(F.lit(high), 1))
            return fact.where(recent | last.isNull()).where(last.isNotNull() | inside)
        return fact.where(last.isNull() & inside)
