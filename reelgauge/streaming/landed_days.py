"""Silver kept up to date from files as they land.

A stream lists new bronze files (names only, no content), marked with the number of the run that
found them. The days they belong to are rebuilt from their whole bronze folders, and their names go
to a ledger by day. Rebuilding the day, and not writing the new files' rows, is what keeps a day's
earlier pages: a partition overwrite with only the late page would remove them.

A run reads the names found since the last run that came through, those of days that were refused,
and the ledger of just these days; days that are done are not read, however long the feeds go on.

Each table is built from the days its dataset has. A day that so far lacks metadata or visitors does
not hold up others and is rebuilt when they come; ``waiting`` tells which days lack what, and how
many files have no day at all (they lie outside ``dt=`` folders and are left alone). A day whose
metadata or visitors are there but useless is refused and tried again by every run; ``refused`` tells
why. It does not hold up others either.

The file source does not notice a file rewritten under the same name. Feeds that rewrite files
should run the batch job with the list of days instead.

Below the state folder: ``landed/<dataset>`` by run, ``ledger`` by day, and the small versioned
tables ``progress`` (the last run that came through) and ``held`` (files of refused days).
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.paths import dt_from_path
from ..operators.quality import QualityError
from ..plans.silver_job import run_silver_days
from ..schemas import DATASETS
from ..session import together
from ..sources.compaction import compact
from ..sources.versions import read_version, write_version

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
LEDGER_SCHEMA = "dataset string, path string, dt date"
PROGRESS = T.StructType().add("run", T.IntegerType())
HELD = T.StructType().add("dataset", "string").add("path", "string").add("dt", "date").add(
    "reason", "string"
)
# A day without one of these lacks a silver table.
NEEDED = ("metadata", "visitors")
# The ledger's small files are gathered every so many runs.
COMPACT_EVERY = 50


def note_landed_files(
    spark: SparkSession, bronze_base: str, dataset: str, state: str, run: int = 1
) -> None:
    """Append the files that are new since the last call to those landed, each exactly once."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("recursiveFileLookup", True)
        .load(f"{bronze_base.rstrip('/')}/{dataset}")
    )
    landed = files.select(
        F.lit(dataset).alias("dataset"), "path", dt_from_path(F.col("path")).alias("dt"),
        F.lit(run).alias("run"),
    )
    query = (
        landed.writeStream.format("parquet")
        .option("checkpointLocation", f"{state}/checkpoints/{dataset}")
        .option("path", f"{state}/landed/{dataset}")
        .partitionBy("run")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def last_run(spark: SparkSession, state: str) -> int:
    """Number of the last run that came through, 0 before the first."""
    done = read_version(spark, f"{state}/progress", PROGRESS)
    return done.first()["run"] if done is not None else 0


def ledger(spark: SparkSession, state: str) -> DataFrame:
    """The files of all days that were taken in, and of no day."""
    spark.createDataFrame([], LEDGER_SCHEMA).write.mode("append").partitionBy("dt").parquet(
        f"{state}/ledger"
    )
    return spark.read.schema(LEDGER_SCHEMA).parquet(f"{state}/ledger")


def refused(spark: SparkSession, state: str) -> DataFrame:
    """``dataset``, ``path``, ``dt`` and ``reason``: files of days that could not be taken in."""
    held = read_version(spark, f"{state.rstrip('/')}/held", HELD)
    return spark.createDataFrame([], HELD) if held is None else held


def pending_files(spark: SparkSession, state: str) -> DataFrame:
    """Files found since the last run that came through, and those of refused days."""
    done = last_run(spark, state)
    out = refused(spark, state).drop("reason")
    for dataset in DATASETS:
        landed = spark.read.schema(f"{LEDGER_SCHEMA}, run int").parquet(f"{state}/landed/{dataset}")
        out = out.unionByName(landed.where(F.col("run") > done).drop("run"))
    return out.distinct()


def waiting(spark: SparkSession, state: str) -> DataFrame:
    """Per day that lacks metadata or visitors: the datasets it has and its files; the day is null
    for files outside ``dt=`` folders. A report: it reads the whole ledger."""
    state = state.rstrip("/")
    every = ledger(spark, state).unionByName(pending_files(spark, state)).distinct()
    found = every.groupBy("dt").agg(
        F.sort_array(F.collect_set("dataset")).alias("datasets"), F.count("*").alias("files")
    )
    lacking = F.size(F.array_intersect("datasets", F.array(*map(F.lit, NEEDED)))) < len(NEEDED)
    return found.where(F.col("dt").isNull() | lacking)


def datasets_of_days(spark: SparkSession, state: str, pending: DataFrame) -> dict[str, set[str]]:
    """The datasets that each pending day has, with the files taken in earlier; a row per day and
    dataset comes to the driver."""
    days = [r["dt"] for r in pending.where("dt is not null").select("dt").distinct().collect()]
    if not days:
        return {}
    # Named days, so that the folders of all others are not even listed in the scan.
    there = ledger(spark, state).where(F.col("dt").isin([F.lit(d) for d in days]))
    of_days = pending.where("dt is not null").unionByName(there).select("dt", "dataset").distinct()
    found: dict[str, set[str]] = {}
    for row in of_days.collect():
        found.setdefault(str(row["dt"]), set()).add(row["dataset"])
    return found


def follow_bronze(
    spark: SparkSession, bronze_base: str, silver_base: str, state: str, fmt: str = "ndjson"
) -> list[str]:
    """Take in everything that landed since the last call; returns the days rebuilt.

    ``state`` is a folder all executors share. A run that dies before it is marked as through is
    made up for by the next one, and rebuilding a day twice gives the same day. Raises if all days
    were refused; otherwise the refused ones are held for the next run. One run at a time.
    """
    state = state.rstrip("/")
    run = last_run(spark, state) + 1
    together(*[partial(note_landed_files, spark, bronze_base, d, state, run) for d in DATASETS])
    pending = pending_files(spark, state)
    expected = datasets_of_days(spark, state, pending)
    bad = {}
    if expected:
        bad = run_silver_days(spark, bronze_base, silver_base, expected, fmt)
        if len(bad) == len(expected):
            raise QualityError("; ".join(f"{day}: {bad[day]}" for day in sorted(bad)))
    reasons = spark.createDataFrame(sorted(bad.items()), "day string, reason string").select(
        F.col("day").cast("date").alias("_day"), "reason"
    )
    of_bad = F.col("dt") == F.col("_day")
    taken = pending.join(F.broadcast(reasons), of_bad, "left_anti")
    held = pending.join(F.broadcast(reasons), of_bad).select(*HELD.names)
    taken.write.mode("append").partitionBy("dt").parquet(f"{state}/ledger")
    write_version(held, f"{state}/held")
    write_version(spark.createDataFrame([(run,)], PROGRESS), f"{state}/progress")
    if run % COMPACT_EVERY == 0:
        compact(spark, f"{state}/ledger", LEDGER_SCHEMA, ("dt",))
    return sorted(set(expected) - set(bad))
