"""One query per operator or job; each reads its tables whole.

Dates, stamps and arrays leave as text so that any two engines compare them alike.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import coalesce_text, to_double, to_long
from ..functions import paths
from ..functions.paths import MEDIAS_FILE, VISITORS_FILE, dt_from_path, id_from_path
from ..functions.times import backfill_days, date10, last_n_days, parse_ts, with_ymd
from ..operators import (
    counters, event_date, gold, joins, kpi, landing, quality, schema_drift, silver, sketches,
)
from ..operators.dedup import latest_dim, latest_per_key
from ..operators.filters import date_between, media_in
from ..plans import cli, latest_media
from ..plans.gold_job import MEDIA, SKETCHES, VISITOR, GoldRefresh, run_gold
from ..plans.silver_job import run_silver
from ..plans.views import gold_views
from ..schemas import DATASETS, GOLD
from ..session import scratch_path, together, use_utc
from ..sources import bronze, tables
from ..sources.cache import GoldCache
from ..sources.compaction import compact, folder_files
from ..streaming.landed_days import follow_bronze
from . import sample_tables as sample

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The report range of the ranged queries: all but the first and last days of the events.
START, END = date(2024, 1, 3), date(2024, 1, 28)


def plain(df: DataFrame) -> DataFrame:
    def text(name: str, kind: str) -> Column:
        column = F.col(name)
        if kind == "date":
            return column.cast("string").alias(name)
        if kind.startswith("timestamp"):
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)
        if kind == "array":
            return F.concat_ws(",", column).alias(name)
        return column

    return df.select(*[text(f.name, f.dataType.typeName()) for f in df.schema])


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(build(use_utc(spark), sf_dir))

    QUERIES[build.__name__.removesuffix("_query")] = run
    return build


def events(spark: SparkSession, sf: str) -> DataFrame:
    return sample.table(spark, sf, "events")


def fact(spark: SparkSession, sf: str) -> DataFrame:
    return sample.event_fact(events(spark, sf))


def fact_per_day(spark: SparkSession, sf: str) -> DataFrame:
    """The fact as silver keeps it: one row per media, visitor and day."""
    keys = ["media_id", "visitor_id", "dt"]
    return latest_per_key(fact(spark, sf), keys, ["last_active", "last_event_key"])


def media_dim(spark: SparkSession, sf: str) -> DataFrame:
    return silver.dim_media(sample.metadata_feed(sample.table(spark, sf, "part")))


def media_gold(spark: SparkSession, sf: str) -> DataFrame:
    return gold.media_daily(fact(spark, sf), media_dim(spark, sf))


def visitor_gold(spark: SparkSession, sf: str) -> DataFrame:
    return gold.visitor_daily(fact(spark, sf), media_dim(spark, sf))


def old_media(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.prep_kpi(sample.old_media_gold(events(spark, sf)))


def old_visitors(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.prep_kpi(sample.old_visitor_gold(events(spark, sf)))


# --- gold -----------------------------------------------------------------------------------


@query
def media_daily(spark: SparkSession, sf: str) -> DataFrame:
    return media_gold(spark, sf)


@query
def visitor_daily(spark: SparkSession, sf: str) -> DataFrame:
    return visitor_gold(spark, sf)


@query
def media_daily_first_seen(spark: SparkSession, sf: str) -> DataFrame:
    return gold.media_daily(fact(spark, sf), mode="first_seen")


@query
def visitor_daily_sum_plays(spark: SparkSession, sf: str) -> DataFrame:
    return gold.visitor_daily(fact(spark, sf), media_dim(spark, sf), interactions="sum_plays")


@query
def media_daily_latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return gold.media_daily(fact_per_day(spark, sf), media_dim(spark, sf), latest_only=True)


@query
def visitor_daily_latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return gold.visitor_daily(fact_per_day(spark, sf), media_dim(spark, sf), latest_only=True)


@query
def running_increments(spark: SparkSession, sf: str) -> DataFrame:
    return counters.running_increments(sample.running_fact(events(spark, sf)))


@query
def media_daily_increments(spark: SparkSession, sf: str) -> DataFrame:
    """Daily truth of running totals."""
    running = sample.running_fact(events(spark, sf))
    return gold.media_daily(running, media_dim(spark, sf), counters="increments")


@query
def visitor_daily_increments(spark: SparkSession, sf: str) -> DataFrame:
    running = sample.running_fact(events(spark, sf))
    return gold.visitor_daily(running, media_dim(spark, sf), counters="increments")


@query
def gold_ymd(spark: SparkSession, sf: str) -> DataFrame:
    return with_ymd(gold.media_daily(fact(spark, sf), mode="first_seen"))


# --- event date, joins, quality -------------------------------------------------------------


@query
def resolve_event_date(spark: SparkSession, sf: str) -> DataFrame:
    return event_date.resolve_event_date(fact(spark, sf), media_dim(spark, sf))


@query
def resolve_event_date_unbroadcast(spark: SparkSession, sf: str) -> DataFrame:
    return event_date.resolve_event_date(
        fact(spark, sf), media_dim(spark, sf), broadcast_bytes=0
    )


@query
def resolve_event_date_again(spark: SparkSession, sf: str) -> DataFrame:
    """A fact that already has an event date, beyond the broadcast limit, with few hot keys."""
    stale = fact(spark, sf).withColumn("event_date", F.lit("1990-01-01").cast("date"))
    return event_date.resolve_event_date(
        stale, media_dim(spark, sf), broadcast_bytes=0, hot_keys=3
    )


@query
def event_date_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return event_date.event_date_coverage(fact(spark, sf), media_dim(spark, sf))


@query
def unknown_media(spark: SparkSession, sf: str) -> DataFrame:
    return joins.unknown_media(fact(spark, sf), media_dim(spark, sf))


@query
def with_title(spark: SparkSession, sf: str) -> DataFrame:
    return joins.with_title(media_gold(spark, sf), media_dim(spark, sf))


@query
def row_counts(spark: SparkSession, sf: str) -> DataFrame:
    feed = sample.visitors_feed(events(spark, sf))
    return quality.row_counts({
        "visitors": feed,
        "dim_media": media_dim(spark, sf),
        "dim_visitor": silver.dim_visitor(feed),
        "fact_media_engagement": silver.fact_media_engagement(feed),
    })


@query
def sample_rows(spark: SparkSession, sf: str) -> DataFrame:
    return quality.sample_rows(media_gold(spark, sf), 50, ordered=True)


# --- silver ---------------------------------------------------------------------------------


@query
def dim_media(spark: SparkSession, sf: str) -> DataFrame:
    return media_dim(spark, sf)


@query
def latest_dim_media(spark: SparkSession, sf: str) -> DataFrame:
    return latest_dim(media_dim(spark, sf), "media_id")


@query
def dim_visitor(spark: SparkSession, sf: str) -> DataFrame:
    return silver.dim_visitor(sample.visitors_feed(events(spark, sf)))


@query
def fact_media_engagement(spark: SparkSession, sf: str) -> DataFrame:
    return silver.fact_media_engagement(sample.visitors_feed(events(spark, sf)))


@query
def fact_media_daily_raw(spark: SparkSession, sf: str) -> DataFrame:
    return silver.fact_media_daily_raw(sample.medias_feed(sample.table(spark, sf, "lineitem")))


@query
def fact_media_daily_titled(spark: SparkSession, sf: str) -> DataFrame:
    feed = sample.medias_feed(sample.table(spark, sf, "lineitem"))
    return silver.fact_media_daily_raw(feed, media_dim(spark, sf))


# --- scalar functions -----------------------------------------------------------------------


@query
def parse_ts_query(spark: SparkSession, sf: str) -> DataFrame:
    return sample.visitors_feed(events(spark, sf)).select(
        "last_event_key",
        parse_ts(F.col("created_at")).alias("created"),
        parse_ts(F.col("last_active_at")).alias("active"),
        parse_ts(F.col("event_date")).alias("day_start"),
    )


@query
def date10_query(spark: SparkSession, sf: str) -> DataFrame:
    return sample.visitors_feed(events(spark, sf)).select(
        "last_event_key",
        date10(F.col("created_at")).alias("created_day"),
        date10(F.col("last_active_at")).alias("active_day"),
    )


@query
def media_id_from_path(spark: SparkSession, sf: str) -> DataFrame:
    path = F.col("source_path")
    upper = F.concat(F.lit("file:/x/visitors_old/MEDIAS_"), path)
    return sample.visitors_feed(events(spark, sf)).select(
        "last_event_key",
        id_from_path(path, VISITORS_FILE).alias("visitors_id"),
        id_from_path(F.replace(path, F.lit("_m"), F.lit("_M"))).alias("upper_case_id"),
        id_from_path(path, MEDIAS_FILE).alias("other_kind"),
        id_from_path(upper).alias("deeper_id"),
    )


@query
def dt_from_path_query(spark: SparkSession, sf: str) -> DataFrame:
    path = F.col("source_path")
    return sample.visitors_feed(events(spark, sf)).select(
        "last_event_key",
        dt_from_path(path).alias("day"),
        dt_from_path(F.concat(F.lit("file:/dt=1999-12-31/"), path)).alias("inner_day"),
        dt_from_path(F.replace(path, F.lit("/dt="), F.lit("/day="))).alias("no_day"),
    )


@query
def with_ids(spark: SparkSession, sf: str) -> DataFrame:
    return silver.with_ids(sample.visitors_feed(events(spark, sf))).select(
        "last_event_key", "media_id", "dt", "event_date"
    )


@query
def typed_casts(spark: SparkSession, sf: str) -> DataFrame:
    return sample.visitors_feed(events(spark, sf)).select(
        "last_event_key",
        to_long(F.col("load_count")).alias("loads"),
        to_long(F.col("play_count")).alias("plays"),
        to_double(F.col("play_count")).alias("plays_double"),
        to_long(F.concat("load_count", F.lit("e1"))).alias("exponent"),
        F.col("user_agent_details.mobile").try_cast("boolean").alias("is_mobile"),
    )


@query
def coalesce_text_query(spark: SparkSession, sf: str) -> DataFrame:
    return fact(spark, sf).select(
        "last_event_key", coalesce_text("last_active", "dt", "visitor_id").alias("first_filled")
    )


@query
def backfill_days_query(spark: SparkSession, sf: str) -> DataFrame:
    day = F.to_date("ts")
    window = events(spark, sf).agg(F.min(day).alias("start"), F.max(day).alias("last"))
    return backfill_days(window, F.col("start"), F.col("last"), F.date_add("last", 5))


# --- KPIs -----------------------------------------------------------------------------------


@query
def prep_kpi(spark: SparkSession, sf: str) -> DataFrame:
    return old_media(spark, sf).groupBy("media_id", "event_date").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("total_plays").alias("plays"),
        F.sum("total_loads").alias("loads"),
        F.sum("watch_time_sec").alias("watch_time_sec"),
    )


@query
def media_totals(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.media_totals(old_media(spark, sf))


@query
def media_totals_empty(spark: SparkSession, sf: str) -> DataFrame:
    never = date(1990, 1, 1)
    return kpi.media_totals(date_between(old_media(spark, sf), never, never))


@query
def media_totals_last_30_days(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.media_totals(date_between(old_media(spark, sf), *last_n_days(date(2024, 2, 10))))


@query
def visitor_totals(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.visitor_totals(old_visitors(spark, sf))


@query
def unique_visitors(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.unique_visitors(visitor_gold(spark, sf))


@query
def unique_visitors_approximate(spark: SparkSession, sf: str) -> DataFrame:
    """The exact number, and whether the approximate one is within a tenth of it."""
    seen = visitor_gold(spark, sf)
    near = kpi.unique_visitors(seen, approximate=True).scalar()
    exact = F.col("unique_visitors")
    return kpi.unique_visitors(seen).withColumn("near", F.abs(near - exact) <= exact / 10)


@query
def visitors_by_sketch(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct visitors of weeks, and of some media, from stored sketches beside the exact count."""
    base = scratch_path(spark, "sketches")
    dated = event_date.resolve_event_date(fact(spark, sf), media_dim(spark, sf))
    tables.write_gold(sketches.visitor_sketches(dated), base, SKETCHES)
    stored = tables.read_gold(spark, base, SKETCHES, GOLD[SKETCHES])
    parts = []
    for name, frame in (
        ("week", lambda df: df.where("event_date is not null")),
        ("selection", lambda df: media_in(df, ["m1", "m7", "m77"])),
    ):
        key = F.trunc("event_date", "week") if name == "week" else F.lit(None).cast("date")
        near = sketches.visitors_of(frame(stored), key.alias("of"))
        exact = frame(dated).groupBy(key.alias("of")).agg(
            F.count_distinct("visitor_id").alias("exact")
        )
        off = F.abs(F.col("visitors") - F.col("exact"))
        parts.append(exact.join(near, exact["of"].eqNullSafe(near["of"])).select(
            F.lit(name).alias("range"), exact["of"], "exact",
            (off <= F.ceil(F.col("exact") * sketches.relative_error())).alias("within_bound"),
        ))
    return parts[0].unionByName(parts[1])


@query
def media_kpis(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.media_kpis(old_media(spark, sf))


@query
def media_trend(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.trend(old_media(spark, sf))


@query
def visitor_trend(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.trend(old_visitors(spark, sf))


@query
def top_visitors(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.top_visitors(old_visitors(spark, sf))


@query
def media_list(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.media_list(media_gold(spark, sf), media_dim(spark, sf))


@query
def default_media(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.default_media(media_gold(spark, sf))


@query
def summary_kpis(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.summary_kpis(media_gold(spark, sf), visitor_gold(spark, sf), START, END)


@query
def summary_kpis_default_media(spark: SparkSession, sf: str) -> DataFrame:
    media = media_gold(spark, sf)
    return kpi.summary_kpis(
        media, visitor_gold(spark, sf), START, END, kpi.default_media(media)
    )


@query
def media_daily_series(spark: SparkSession, sf: str) -> DataFrame:
    titled = joins.with_title(media_gold(spark, sf), media_dim(spark, sf))
    return kpi.media_daily_series(titled, START, END)


@query
def visitor_daily_series(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.visitor_daily_series(visitor_gold(spark, sf), START, END)


@query
def media_in_selection(spark: SparkSession, sf: str) -> DataFrame:
    media = media_gold(spark, sf)
    return media_in(media, kpi.default_media(media))


@query
def media_in_list(spark: SparkSession, sf: str) -> DataFrame:
    return media_in(media_gold(spark, sf), ["m1", "m7", "m77", "none of them"])


@query
def media_in_long_list(spark: SparkSession, sf: str) -> DataFrame:
    return media_in(media_gold(spark, sf), [f"m{3 * i}" for i in range(250)])


@query
def media_in_empty(spark: SparkSession, sf: str) -> DataFrame:
    media = media_gold(spark, sf)
    return media_in(media_in(media, []), media.select("media_id").limit(0))


# --- sources, sinks and jobs ----------------------------------------------------------------


def land_all(spark: SparkSession, sf: str, base: str, kinds: Column | None = None) -> None:
    """Land the three datasets; ``kinds`` narrows the events to those of a later page."""
    rows = events(spark, sf)
    page = rows if kinds is None else rows.where(kinds)
    metadata = sample.metadata_feed(sample.table(spark, sf, "part"))
    land_together(base, {
        "visitors": sample.landed_rows(sample.visitors_feed(page)),
        "metadata": sample.landed_rows(metadata), "medias": sample.daily_totals_feed(rows),
    })


def land_together(base: str, feeds: dict[str, DataFrame]) -> None:
    """Land several datasets, at the same time."""
    together(*[partial(bronze.land_bronze, df, base, d) for d, df in feeds.items()])


def land_late(spark: SparkSession, sf: str, base: str, kinds: Column) -> None:
    """Another page of visitors for days that were landed before."""
    page = sample.landed_rows(sample.visitors_feed(events(spark, sf).where(kinds)))
    bronze.land_bronze(page, base, "visitors", overwrite=False)


@query
def bronze_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, "roundtrip")
    feed = sample.landed_rows(sample.visitors_feed(events(spark, sf)))
    bronze.land_bronze(feed, base, "visitors")
    bronze.land_bronze(feed, base, "visitors")
    good, _ = bronze.split_corrupt(bronze.read_bronze(spark, base, "visitors"))
    return good.select(
        "last_event_key", "visitor_key", "media_id", "created_at", "load_count", "dt",
        F.col("visitor_identity.org.title").alias("org_title"),
    )


@query
def landed_day(spark: SparkSession, sf: str) -> DataFrame:
    """Everything fetched on one day, landed twice into its folder."""
    base, day = scratch_path(spark, "one-day"), date(2024, 2, 1)
    feed = sample.landed_rows(sample.visitors_feed(events(spark, sf)))
    for _ in range(2):
        bronze.land_day(bronze.tag_rows(feed, None, day), base, "visitors", day)
    rows = bronze.read_bronze(spark, base, "visitors", days=[str(day)])
    return rows.select("last_event_key", "visitor_key", "media_id", "dt", "event_date")


@query
def missing_days(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of days that lack the same datasets, found from what is landed."""
    base = scratch_path(spark, "gaps")
    rows, of_month = events(spark, sf), F.dayofmonth("dt")
    totals = sample.daily_totals_feed(rows).where(~of_month.isin(9, 10, 11, 25))
    visits = sample.landed_rows(sample.visitors_feed(rows)).where((of_month % 5 != 0) & (of_month != 9))
    bronze.land_bronze(totals, base, "medias")
    bronze.land_bronze(visits, base, "visitors")
    day = F.to_date("ts")
    window = rows.agg(F.min(day).alias("start"), F.max(day).alias("last"))
    expected = backfill_days(window, F.col("start"), F.date_add("last", 2), F.date_add("last", 5))
    kinds = ("medias", "visitors")
    return landing.missing_days(expected, landing.landed_days(spark, base, kinds), kinds)


@query
def bronze_root(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows whether the base names the sub-folder, ends in a slash, or neither."""
    base = scratch_path(spark, "root")
    bronze.land_bronze(sample.daily_totals_feed(events(spark, sf)), f"{base}/raw", "medias")
    out = None
    for spelling in (base, f"{base}/", f"{base}/raw", f"{base}/raw/"):
        rows = bronze.read_bronze(spark, paths.bronze_root(spelling, "raw"), "medias").select(
            "media_id", "dt", "load_count", F.lit(spelling.removeprefix(base)).alias("spelling")
        )
        out = rows if out is None else out.unionByName(rows)
    return out


@query
def refused_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Silver runs that are refused, and why: no metadata, no visitors, rows without a media id."""
    base = scratch_path(spark, "refused")
    feed = sample.landed_rows(sample.visitors_feed(events(spark, sf)))
    metadata = sample.landed_rows(sample.metadata_feed(sample.table(spark, sf, "part")))
    totals = tables.staged(sample.daily_totals_feed(events(spark, sf)), "totals")
    lost = F.col("visitor_identity.org.title").isin("error", "signup")
    without = feed.withColumn("media_id", F.when(~lost, F.col("media_id")))
    cases = {
        "no metadata": (feed, metadata.where("false")),
        "no visitors": (feed.where("false"), metadata),
        "no media id": (without, metadata),
        "sound": (feed, metadata),
    }
    found = []
    for name, (visitors, media) in cases.items():
        raw = f"{base}/{name.replace(' ', '-')}"
        land_together(raw, {"visitors": visitors, "metadata": media, "medias": totals})
        for dataset in DATASETS:
            spark.createDataFrame([], "x string").write.mode("append").text(f"{raw}/{dataset}")
        try:
            run_silver(spark, raw, f"{base}/silver")
            found.append((name, None))
        except quality.QualityError as error:
            found.append((name, str(error)))
    return spark.createDataFrame(found, "case_name string, refusal string")


@query
def schema_drift_query(spark: SparkSession, sf: str) -> DataFrame:
    """Visitors land loads as numbers from the 15th on, and plays as numbers where they are any."""
    base = scratch_path(spark, "drift")
    feed = sample.landed_rows(sample.visitors_feed(events(spark, sf)))
    # Fields whose values are not the same in every row have to leave as JSON of their own types.
    plays, loads = F.col("play_count"), F.col("load_count")
    late = F.col("dt") >= F.lit(date(2024, 1, 15))
    whole = loads.cast("double").cast("int").cast("string")
    quoted = F.concat(F.lit('"'), loads, F.lit('"'))
    pairs = [
        F.to_json(F.struct("visitor_key", F.col("visitor_identity.org").alias("org"), "created_at")),
        F.concat(F.lit('{"load_count":'), F.when(late, whole).otherwise(quoted), F.lit("}")),
        F.concat(
            F.lit('{"play_count":'), F.when(plays == "n/a", '"n/a"').otherwise(plays), F.lit("}")
        ),
    ]
    inner = F.concat_ws(",", *[
        F.nullif(F.substring(text, F.lit(2), F.length(text) - 2), F.lit("")) for text in pairs
    ])
    lines = feed.select(F.concat(F.lit("{"), inner, F.lit("}")).alias("value"), "dt")
    lines.hint("rebalance", F.col("dt")).write.partitionBy("dt").text(f"{base}/visitors")
    return schema_drift.schema_drift(spark, base, ("visitors",))


@query
def schema_report_one_dataset(spark: SparkSession, sf: str) -> DataFrame:
    """The report of one dataset only, though all are landed."""
    base = scratch_path(spark, "one-schema")
    land_all(spark, sf, base)
    found = {"medias": quality.infer_bronze(spark, base, "medias")}
    return quality.schema_report(spark, found, ("medias",))


@query
def bronze_selected_days(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, "days")
    bronze.land_bronze(
        sample.landed_rows(sample.visitors_feed(events(spark, sf))), base, "visitors"
    )
    rows = bronze.read_bronze(spark, base, "visitors", days=[str(START), str(END)])
    return rows.select("last_event_key", "visitor_key", "media_id", "dt")


@query
def multiline_json(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, "multiline")
    feed = sample.visitors_feed(events(spark, sf)).drop("source_path")
    sample.json_arrays(feed).write.text(f"{base}/visitors")
    rows = bronze.read_bronze(spark, base, "visitors", fmt="json")
    return rows.select(
        "last_event_key", "visitor_key", "media_id", "event_date",
        F.col("visitor_identity.email").alias("email"),
    )


@query
def corrupt_rows(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, "corrupt")
    feed = sample.landed_rows(sample.visitors_feed(events(spark, sf)))
    line = F.to_json(F.struct(*[c for c in feed.columns if c != "dt"]))
    # All errors, and whatever came on the last day of the range: a day corrupt throughout.
    broken = (F.col("visitor_identity.org.title") == "error") | (F.col("dt") == F.lit(END))
    lines = feed.select(F.when(broken, F.lit("{broken")).otherwise(line).alias("value"), "dt")
    lines.hint("rebalance", F.col("dt")).write.partitionBy("dt").text(f"{base}/visitors")
    good, bad = bronze.split_corrupt(bronze.read_bronze(spark, base, "visitors"))
    kinds = good.select("dt", F.lit(True).alias("good")).unionByName(
        bad.select("dt", F.lit(False).alias("good"))
    )
    return kinds.groupBy("dt").agg(
        F.count_if("good").alias("good_rows"), F.count_if(~F.col("good")).alias("corrupt_rows")
    )


@query
def bronze_health(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, "health")
    land_all(spark, sf, base)
    parts = [
        quality.bronze_health(bronze.read_bronze(spark, base, d), d) for d in DATASETS
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def schema_report(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, "schemas")
    land_all(spark, sf, base)
    found = {d: quality.infer_bronze(spark, base, d) for d in DATASETS}
    return quality.schema_report(spark, found)


@query
def dt_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """Silver of all days, then the view and click rows of each day written over them."""
    base = scratch_path(spark, "overwrite")
    rows = fact_per_day(spark, sf)
    tables.write_partitioned(rows, base, "fact_media_engagement")
    seen = tables.write_partitioned(
        rows.where("load_count > 0"), base, "fact_media_engagement",
        measures={"rows": F.count(F.lit(1))},
    )
    out = tables.read_silver(spark, base, "fact_media_engagement")
    return out.withColumn("written", F.lit(seen.get["rows"]))


@query
def append_mode(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, "append")
    rows = fact_per_day(spark, sf)
    for _ in range(2):
        tables.write_partitioned(rows, base, "fact_media_engagement", mode="append")
    return tables.read_silver(spark, base, "fact_media_engagement")


@query
def fact_by_event_date(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, "by-event-date")
    dated = event_date.resolve_event_date(fact_per_day(spark, sf), media_dim(spark, sf))
    tables.write_full(dated, base, "fact_by_event_date", by=("event_date",))
    return spark.read.parquet(tables.table_path(base, "fact_by_event_date"))


@query
def gold_rerun_idempotent(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, "rerun")
    for _ in range(2):
        tables.write_gold(media_gold(spark, sf), base, MEDIA)
    return tables.read_gold(spark, base, MEDIA, GOLD[MEDIA]).drop("year", "month", "day")


@query
def read_gold_merged(spark: SparkSession, sf: str) -> DataFrame:
    """Files with and without the watch time under one table; where it is absent it is null."""
    base = scratch_path(spark, "merged")
    path = tables.table_path(base, VISITOR)
    rows = events(spark, sf).select(
        F.col("user_id").cast("string").alias("visitor_id"),
        F.to_date("ts").alias("event_date"),
        F.floor("value").alias("watch_time"),
        "event_type",
    )
    clicks = F.col("event_type") == "click"
    rows.where(clicks).drop("event_type").write.mode("append").parquet(path)
    rows.where(~clicks).drop("event_type", "watch_time").write.mode("append").parquet(path)
    return tables.read_gold(spark, base, VISITOR)


@query
def read_gold_mixed_types(spark: SparkSession, sf: str) -> DataFrame:
    """Days whose watch time is whole, fractional or missing, and whose plays are text after one."""
    base = scratch_path(spark, "mixed-types")
    rows = events(spark, sf).select(
        F.concat(F.lit("e"), "event_id").alias("visitor_id"),
        F.to_date("ts").alias("event_date"), F.floor("value").alias("watch_time"),
        F.when(F.col("event_type") == "click", 1).otherwise(0).cast("long").alias("total_plays"),
    )
    first, last = date(2024, 1, 10), date(2024, 1, 20)
    day, text = F.col("event_date"), F.col("total_plays").cast("string")
    early, late = day < F.lit(first), day >= F.lit(last)
    tables.write_gold(rows.where(early), base, VISITOR)
    middle = rows.where(~early & ~late).withColumn("watch_time", F.col("watch_time") / 2)
    tables.write_gold(middle, base, VISITOR)
    tables.write_gold(rows.where(late).drop("watch_time").withColumn("total_plays", text), base, VISITOR)
    return tables.read_gold(spark, base, VISITOR).drop("month", "day")


@query
def compacted_gold(spark: SparkSession, sf: str) -> DataFrame:
    """Days written in many appends, gathered into one file each."""
    base = scratch_path(spark, "compacted")
    rows = media_gold(spark, sf)
    for part in range(4):
        mine = F.pmod(F.crc32("media_id"), F.lit(4)) == part
        tables.write_gold(rows.where(mine), base, MEDIA, mode="append")
    path = tables.table_path(base, MEDIA)
    compact(spark, path, GOLD[MEDIA], tables.YMD)
    files = folder_files(spark, path).groupBy("folder").count()
    single = files.agg((F.max("count") == 1).alias("single")).scalar()
    stored = tables.read_gold(spark, base, MEDIA, GOLD[MEDIA])
    return stored.drop("year", "month", "day").withColumn("one_file_each", single)


def mixed_gold(spark: SparkSession, sf: str) -> str:
    """Media gold of the events, clicks in the canonical naming, the others in the older one."""
    base = scratch_path(spark, "mixed")
    path = tables.table_path(base, MEDIA)
    rows = events(spark, sf).select(
        F.concat(F.lit("m"), F.get_json_object("props", "$.k")).alias("media_id"),
        F.to_date("ts").alias("event_date"), "event_type",
        F.floor("value").cast("double").alias("seconds"),
    )
    clicks = F.col("event_type") == "click"
    rows.where(clicks).select(
        "media_id", "event_date", F.lit(1).cast("long").alias("total_plays"),
        F.lit(1).cast("long").alias("total_loads"), F.col("seconds").alias("watch_time"),
    ).write.mode("append").parquet(path)
    rows.where(~clicks).select(
        "media_id",
        F.when(F.col("event_type") == "error", "n/a").otherwise(
            F.col("event_date").cast("string")).alias("d"),
        F.lit("0").alias("plays"),
        F.when(F.col("event_type") == "view", 1).otherwise(0).alias("loads"),
        F.col("seconds").alias("seconds_watched"),
    ).write.mode("append").parquet(path)
    return base


@query
def kpi_job_mixed_naming(spark: SparkSession, sf: str) -> DataFrame:
    """Old and new files under one table, in canonical names by the job's own read."""
    return kpi.prep_kpi(tables.read_gold(spark, mixed_gold(spark, sf), MEDIA)).select(
        "media_id", "event_date", "total_plays", "total_loads", "watch_time_sec"
    )


@query
def kpi_job_outputs(spark: SparkSession, sf: str) -> DataFrame:
    """The whole media KPIs and trend as the command writes them."""
    base = mixed_gold(spark, sf)
    tables.write_gold(visitor_gold(spark, sf), base, VISITOR)
    cli.run(spark, cli.parser().parse_args([
        "kpi", "--gold-base", base, "--start", "2024-01-01", "--end", "2024-12-31", "--media",
        "--output", f"{base}/out",
    ]))
    by_media = spark.read.parquet(f"{base}/out/media_kpis").select(
        F.lit("media").alias("frame"), F.col("media_id").alias("name"), "plays", "watch_time_sec"
    )
    by_day = spark.read.parquet(f"{base}/out/media_trend").select(
        F.lit("day").alias("frame"), F.col("event_date").cast("string").alias("name"), "plays",
        "watch_time_sec",
    )
    return by_media.unionByName(by_day)


@query
def cached_gold(spark: SparkSession, sf: str) -> DataFrame:
    """Two reports from one kept frame; the second is returned."""
    with tables.cached_gold(media_gold(spark, sf)) as kept:
        kpi.media_list(kept).count()
        return tables.staged(kept, "cached-gold")


@query
def gold_cache(spark: SparkSession, sf: str) -> DataFrame:
    """A kept table, and what is served once its age is over and it was rewritten."""
    base, now = scratch_path(spark, "cache"), 0.0
    media = media_gold(spark, sf)
    tables.write_gold(media.where("total_plays = 0"), base, MEDIA)
    with GoldCache(spark, max_age=300, clock=lambda: now) as cache:
        kept = cache.get(base, MEDIA, GOLD[MEDIA]).count()
        tables.write_full(with_ymd(media), base, MEDIA, by=tables.YMD)
        now = 300.0
        fresh = tables.staged(cache.get(base, MEDIA, GOLD[MEDIA]), "cached")
    return fresh.drop("year", "month", "day").withColumn("kept_rows", F.lit(kept).cast("long"))


@query
def written_in_files(spark: SparkSession, sf: str) -> DataFrame:
    """Silver written as one file per task for three tasks, and an unpartitioned table beside it."""
    base = scratch_path(spark, "files")
    rows = fact_per_day(spark, sf)
    tables.write_partitioned(rows, base, "fact_media_engagement", files=3)
    tables.write_full(rows, base, "unpartitioned")
    stored = tables.read_silver(spark, base, "fact_media_engagement")
    files = stored.select("dt", F.input_file_name().alias("file")).distinct()
    most = files.groupBy("dt").count().agg((F.max("count") <= 3).alias("few")).scalar()
    whole = spark.read.parquet(tables.table_path(base, "unpartitioned"))
    return whole.select(*stored.columns).withColumn("few_files", most)


@query
def gold_range_pruned(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, "pruned")
    tables.write_gold(media_gold(spark, sf), base, MEDIA)
    stored = tables.read_gold(spark, base, MEDIA, GOLD[MEDIA])
    return date_between(stored, START, END).drop("year", "month", "day")


def whole_pipeline(spark: SparkSession, sf: str) -> str:
    """Bronze, silver and gold of the tables; the folder they are in."""
    base = scratch_path(spark, "pipeline")
    land_all(spark, sf, f"{base}/bronze")
    run_silver(spark, f"{base}/bronze", f"{base}/silver")
    run_gold(spark, f"{base}/silver", f"{base}/gold")
    return base


@query
def bronze_to_gold_media(spark: SparkSession, sf: str) -> DataFrame:
    base = whole_pipeline(spark, sf)
    return tables.read_gold(spark, f"{base}/gold", MEDIA, GOLD[MEDIA]).drop("year", "month", "day")


@query
def bronze_to_gold_visitor(spark: SparkSession, sf: str) -> DataFrame:
    base = whole_pipeline(spark, sf)
    stored = tables.read_gold(spark, f"{base}/gold", VISITOR, GOLD[VISITOR])
    return stored.drop("year", "month", "day")


@query
def gold_views_sql(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, "views")
    tables.write_partitioned(media_dim(spark, sf), f"{base}/silver", "dim_media")
    tables.write_gold(media_gold(spark, sf), f"{base}/gold", MEDIA)
    tables.write_gold(visitor_gold(spark, sf), f"{base}/gold", VISITOR)
    gold_views(spark, f"{base}/gold", f"{base}/silver")
    return spark.sql(
        """
        select m.event_date, m.media_title, m.plays, v.visitors
        from (select event_date, media_title, sum(total_plays) as plays
              from agg_media_daily_p where event_date between :start and :end
              group by event_date, media_title) m
        join (select event_date, count(distinct visitor_id) as visitors
              from agg_visitor_daily_p where event_date between :start and :end
              group by event_date) v
          on m.event_date = v.event_date
        """,
        args={"start": START, "end": END},
    )


@query
def incremental_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Clicks land as later pages of days already taken in; the result equals one batch."""
    base = scratch_path(spark, "follow")
    folders = f"{base}/bronze", f"{base}/silver", f"{base}/state"
    clicks = F.col("event_type") == "click"
    land_all(spark, sf, folders[0], ~clicks)
    follow_bronze(spark, *folders)
    land_late(spark, sf, folders[0], clicks)
    follow_bronze(spark, *folders)
    return tables.read_silver(spark, folders[1], "fact_media_engagement")


def refreshed(spark: SparkSession, sf: str, meaning: str = "daily") -> str:
    """Gold after late pages, rebuilt for the touched dates only; the folder it is in."""
    base = scratch_path(spark, "refresh")
    raw, silver_base, gold_base = f"{base}/bronze", f"{base}/silver", f"{base}/gold"
    late = F.col("event_type").isin("click", "purchase")
    land_all(spark, sf, raw, ~late)
    run_silver(spark, raw, silver_base)
    run_gold(spark, silver_base, gold_base, counters=meaning)
    land_late(spark, sf, raw, late)
    stored = tables.read_silver(spark, silver_base, "fact_media_engagement")
    days = [str(row["dt"]) for row in stored.select("dt").distinct().collect()]
    job = GoldRefresh(
        spark, silver_base, gold_base, days, f"{base}/before", counters=meaning
    )
    run_silver(spark, raw, silver_base, days)
    job.apply()
    return gold_base


@query
def gold_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Gold after late pages, rebuilt for the touched dates only, equals a full rebuild."""
    out = tables.read_gold(spark, refreshed(spark, sf), VISITOR, GOLD[VISITOR])
    return out.drop("year", "month", "day")


@query
def gold_refresh_latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """The same for running totals of which the last counts."""
    out = tables.read_gold(spark, refreshed(spark, sf, "latest"), MEDIA, GOLD[MEDIA])
    return out.drop("year", "month", "day")


@query
def gold_refresh_increments(spark: SparkSession, sf: str) -> DataFrame:
    """The same for running totals of which each day's increment counts."""
    out = tables.read_gold(spark, refreshed(spark, sf, "increments"), MEDIA, GOLD[MEDIA])
    return out.drop("year", "month", "day")


@query
def latest_media_merged(spark: SparkSession, sf: str) -> DataFrame:
    """The stored latest dimension after late rows of some days and the loss of others."""
    base = scratch_path(spark, "latest-media")
    rows = media_dim(spark, sf)
    cut = date(2024, 1, 2)
    odd = F.col("media_id").endswith("3")
    tables.write_partitioned(rows.where(~(odd & (F.col("dt") >= F.lit(cut)))), base, "dim_media")
    latest_media.update_latest_media(spark, base, None)
    stamped = rows.where(F.col("dt") >= F.lit(cut)).select("dt").distinct()
    days = [str(row["dt"]) for row in stamped.collect()]
    # What came late for media ending in 3; media ending in 7 are gone from these days.
    late = rows.where((F.col("dt") >= F.lit(cut)) & ~F.col("media_id").endswith("7"))
    tables.write_partitioned(late, base, "dim_media")
    latest_media.update_latest_media(spark, base, days)
    return latest_media.read_latest_media(spark, base)
