"""Bronze to silver."""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import MEDIAS_FILE, VISITORS_FILE
from ..operators import silver
from ..operators.joins import unknown_media
from ..operators.quality import QualityError, health_measures
from ..operators.silver import ensure_dt, ensure_media_id
from ..schemas import BRONZE, CORRUPT, DATASETS, SOURCE_PATH
from ..session import together
from ..sources.bronze import read_bronze, split_corrupt, stage_bronze
from ..sources.tables import scratch_folder, write_partitioned
from .latest_media import invalidate_latest_media, latest_media_holds, update_latest_media

# Datasets whose media id may have to come from the file name.
FILE_PATTERNS = {"medias": MEDIAS_FILE, "visitors": VISITORS_FILE}
# Fields of the feeds that no silver table takes.
UNUSED = ("event_date",)


def silver_tables(parsed: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The four silver tables of bronze frames without corrupt rows."""
    return {
        "dim_media": silver.dim_media(parsed["metadata"]),
        "dim_visitor": silver.dim_visitor(parsed["visitors"]),
        "fact_media_engagement": silver.fact_media_engagement(parsed["visitors"]),
        "fact_media_daily_raw": silver.fact_media_daily_raw(parsed["medias"]),
    }


# The dataset each table cannot do without.
NEEDED = (("metadata", "dim_media"), ("visitors", "dim_visitor and the fact"))


def refusal(
    health: dict[str, dict[str, int]], needed: Collection[str] = ("metadata", "visitors")
) -> str | None:
    """Why silver cannot be built from bronze with these counts; None if it can.

    The rows counted are those before deduplication: a table is empty exactly when they are.
    ``needed`` are the datasets that must have rows.
    """
    for dataset, tables in NEEDED:
        if dataset in needed and not health.get(dataset, {}).get("keyed_rows"):
            return f"{tables} would be empty; check {dataset}, the day and the format"
    missing = health.get("visitors", {}).get("missing_media_id")
    return f"{missing} visitor rows have no media id" if missing else None


def check_bronze(
    health: dict[str, dict[str, int]], needed: Collection[str] = ("metadata", "visitors")
) -> None:
    """Raise if silver could not be built from bronze with these counts."""
    reason = refusal(health, needed)
    if reason:
        raise QualityError(reason)


def refused_days(
    staged: dict[str, DataFrame], expected: dict[str, Collection[str]]
) -> dict[str, str]:
    """The days that cannot be built, and why; ``expected`` says which datasets each day has.

    One aggregate per dataset over the staged rows; a row per day and dataset comes back.
    """
    health: dict[str, dict[str, dict[str, int]]] = {day: {} for day in expected}
    for dataset, df in staged.items():
        measures = [column.alias(name) for name, column in health_measures(dataset).items()]
        for row in df.groupBy(F.col("dt").cast("string").alias("dt")).agg(*measures).collect():
            health.setdefault(row["dt"], {})[dataset] = row.asDict()
    found = {day: refusal(health[day], datasets) for day, datasets in expected.items()}
    return {day: reason for day, reason in found.items() if reason}


def stage_silver_input(
    spark: SparkSession, bronze_base: str, scratch: str, days: list[str] | None, fmt: str,
    partitioned: bool = True,
    check: Callable[[dict[str, dict[str, int]]], None] | None = None,
) -> tuple[dict[str, DataFrame], dict[str, dict[str, int]]]:
    """Bronze parsed once into scratch tables, day and media id filled in, and its counts.

    The path of a row is kept only where it is still of use: the row is corrupt, or has no key of its
    own. ``check`` is given the counts of the metadata, the smallest feed, before the others are read.
    """
    frames = {}
    for dataset in DATASETS:
        raw = ensure_dt(read_bronze(spark, bronze_base, dataset, fmt, days, partitioned))
        key = BRONZE[dataset].names[0]
        if dataset in FILE_PATTERNS:
            raw, key = ensure_media_id(raw, FILE_PATTERNS[dataset]), "media_id"
        of_use = F.col(CORRUPT).isNotNull() | silver.filled(key).isNull()
        raw = raw.withColumn(SOURCE_PATH, F.when(of_use, F.col(SOURCE_PATH)))
        frames[dataset] = raw.drop(*UNUSED)
    staged, health = {}, {}
    for turn in (("metadata",), ("visitors", "medias")) if check else (DATASETS,):
        done = together(*[
            partial(stage_bronze, frames[d], f"{scratch}/{d}", health_measures(d)) for d in turn
        ])
        for dataset, (rows, counts) in zip(turn, done):
            staged[dataset], health[dataset] = rows, counts
        if check and len(staged) < len(frames):
            check(health)
    return staged, health


def write_silver(
    spark: SparkSession, parsed: dict[str, DataFrame], silver_base: str, days: list[str] | None,
    mode: str = "overwrite", files: int | None = None,
) -> None:
    """The four tables of parsed rows, and the latest media dimension after them."""
    trusted = latest_media_holds(spark, silver_base)
    invalidate_latest_media(spark, silver_base)
    many_days = days is None or len(days) > 1
    together(*[
        partial(write_partitioned, df, silver_base, table, mode, files=files, spread=many_days)
        for table, df in silver_tables(parsed).items()
    ])
    update_latest_media(spark, silver_base, days, trusted)


def run_silver(
    spark: SparkSession,
    bronze_base: str,
    silver_base: str,
    days: list[str] | None = None,
    fmt: str = "ndjson",
    mode: str = "overwrite",
    files: int | None = None,
    partitioned: bool = True,
    quarantine_base: str | None = None,
    needed: Sequence[str] = ("metadata", "visitors"),
) -> dict[str, dict[str, int]]:
    """Build silver for the given days, or for all of bronze; returns the bronze counts.

    The JSON is parsed once into a scratch table and counted on the way; if the counts do not
    pass, nothing of silver is touched, and if those of the metadata do not, no other feed is read. A day is always rebuilt from its whole bronze folder, so
    pages that came late are kept and a second run changes nothing. Corrupt lines are left out of
    silver, and written below ``quarantine_base`` if that is given.

    The latest media dimension is brought up to date from the days rebuilt. It is out of use while
    they are written: after a run that died there, readers rank the history until the next run.
    """
    with scratch_folder(spark, "parsed") as scratch:
        staged, health = stage_silver_input(
            spark, bronze_base, scratch, days, fmt, partitioned,
            check=lambda found: check_bronze(found, set(needed) & {"metadata"}),
        )
        check_bronze(health, needed)
        split = {dataset: split_corrupt(df) for dataset, df in staged.items()}
        write_silver(
            spark, {d: good for d, (good, _) in split.items()}, silver_base, days, mode, files
        )
        if quarantine_base:
            many_days = days is None or len(days) > 1
            for dataset, (_, bad) in split.items():
                if health[dataset]["corrupt_rows"]:
                    write_partitioned(bad, quarantine_base, dataset, mode, spread=many_days)
    return health


def run_silver_days(
    spark: SparkSession,
    bronze_base: str,
    silver_base: str,
    expected: dict[str, Collection[str]],
    fmt: str = "ndjson",
) -> dict[str, str]:
    """Build silver for days that are each checked on their own; returns the refused ones.

    ``expected`` gives the datasets a day has. A day whose metadata or visitors are there but hold
    no usable row, or whose visitors lack their media, is refused: its silver stays as it was, and
    the other days are built.
    """
    with scratch_folder(spark, "parsed") as scratch:
        staged, _ = stage_silver_input(spark, bronze_base, scratch, sorted(expected), fmt)
        refused = refused_days(staged, expected)
        days = sorted(set(expected) - set(refused))
        if days:
            fit = F.col("dt").isin([F.lit(d).cast("date") for d in days])
            parsed = {d: split_corrupt(df.where(fit))[0] for d, df in staged.items()}
            write_silver(spark, parsed, silver_base, days)
    return refused


def missing_metadata(fact: DataFrame, media_dim: DataFrame) -> int:
    """How many media ids of the fact have no dimension row; worth a warning, not a failure."""
    return unknown_media(fact, media_dim).count()
