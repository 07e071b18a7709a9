"""Command line of the jobs: ``spark-submit -m``-style entry, one sub-command per job.

    python -m reelgauge.plans.cli silver   --bronze-base B --silver-base S [--dt D ...]
    python -m reelgauge.plans.cli gold     --silver-base S --gold-base G
    python -m reelgauge.plans.cli refresh  --bronze-base B --silver-base S --gold-base G --dt D ...
    python -m reelgauge.plans.cli validate --bronze-base B [--dataset visitors] [--dt D]
    python -m reelgauge.plans.cli kpi      --gold-base G [--start D --end D] [--media M ...] [--output O]
    python -m reelgauge.plans.cli days     --start D --end D [--exec-day D] [--bronze-base B]
    python -m reelgauge.plans.cli follow   --bronze-base B --silver-base S --state F
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import bronze_root
from ..functions.times import backfill_days, date10, last_n_days
from ..operators.counters import COUNTERS
from ..operators.event_date import MODES
from ..operators.filters import media_in
from ..operators.gold import INTERACTIONS
from ..operators.kpi import default_media, prep_kpi
from ..operators.landing import incomplete_days, landed_days
from ..operators.quality import infer_bronze, sample_rows, schema_report
from ..schemas import DATASETS
from ..session import build_session, scratch_path
from ..sources.bronze import FORMATS, read_bronze
from ..sources.tables import cached_gold, read_gold, read_silver
from ..streaming.landed_days import follow_bronze, waiting
from .dashboard import in_range, media_frames, visitor_frames
from .gold_job import MEDIA, VISITOR, GoldRefresh, run_gold
from .silver_job import missing_metadata, run_silver

# Rows of a KPI frame the command prints; ``--output`` gets all of them.
PREVIEW = 20


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="reelgauge")
    top.add_argument("--shuffle-partitions", type=int)
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, *bases: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        for base in bases:
            sub.add_argument(f"--{base}-base", required=True)
        if "bronze" in bases:
            sub.add_argument("--sub-folder", default="", help="folder below the bronze base")
            sub.add_argument("--format", choices=FORMATS, default="ndjson")
        return sub

    silver = command("silver", "bronze", "silver")
    silver.add_argument("--dt", nargs="*", help="days YYYY-MM-DD; all of bronze if left out")
    silver.add_argument("--mode", choices=("overwrite", "append"), default="overwrite")
    silver.add_argument("--files", type=int)
    silver.add_argument("--any-layout", action="store_true", help="also files outside dt= folders")
    silver.add_argument("--quarantine-base")

    gold = command("gold", "silver", "gold")
    refresh = command("refresh", "bronze", "silver", "gold")
    for sub in (gold, refresh):
        sub.add_argument("--event-date", choices=MODES, default=MODES[0])
        sub.add_argument("--interactions", choices=INTERACTIONS, default=INTERACTIONS[0])
        sub.add_argument("--counters", choices=COUNTERS, default=COUNTERS[0])
        sub.add_argument("--sketches", action="store_true", help="also sketches of the visitors")
    gold.add_argument(
        "--latest-only", dest="counters", action="store_const", const="latest",
        help="the same as --counters latest",
    )
    refresh.add_argument("--dt", nargs="+", required=True)

    validate = command("validate", "bronze")
    validate.add_argument("--dataset", choices=("all", *DATASETS), default="all")
    validate.add_argument("--dt")

    kpi = command("kpi", "gold")
    kpi.add_argument("--start", type=date.fromisoformat)
    kpi.add_argument("--end", type=date.fromisoformat)
    kpi.add_argument("--media", nargs="*", help="the first 15 if left out, all if none is named")
    kpi.add_argument("--output", help="folder for the whole frames, one sub-folder each")
    kpi.add_argument("--output-format", choices=("parquet", "json", "csv"), default="parquet")

    days = command("days")
    days.add_argument("--start", required=True)
    days.add_argument("--end", required=True)
    days.add_argument("--exec-day", help="day or ISO stamp; today if left out")
    days.add_argument("--bronze-base", help="only the days that lack a dataset there")
    days.add_argument("--sub-folder", default="", help="folder below the bronze base")

    follow = command("follow", "bronze", "silver")
    follow.add_argument("--state", required=True, help="folder for the stream's own state")
    return top


def write_frame(df: DataFrame, folder: str, name: str, fmt: str) -> None:
    """A whole KPI frame below the output folder, in place of the one before."""
    df.write.mode("overwrite").format(fmt).option("header", True).save(f"{folder}/{name}")


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if getattr(args, "bronze_base", None):
        args.bronze_base = bronze_root(args.bronze_base, args.sub_folder)
    if args.command == "silver":
        health = run_silver(
            spark, args.bronze_base, args.silver_base, args.dt, args.format, args.mode,
            args.files, not args.any_layout, args.quarantine_base,
        )
        fact = read_silver(spark, args.silver_base, "fact_media_engagement")
        unknown = missing_metadata(fact, read_silver(spark, args.silver_base, "dim_media"))
        print(health)
        if unknown:
            print(f"warning: {unknown} media ids of the fact have no metadata")
    elif args.command == "gold":
        print(run_gold(
            spark, args.silver_base, args.gold_base, args.event_date, args.interactions,
            args.counters, args.sketches,
        ))
    elif args.command == "refresh":
        keep = scratch_path(spark, "media-days")
        job = GoldRefresh(
            spark, args.silver_base, args.gold_base, args.dt, keep, args.event_date,
            args.interactions, args.counters, args.sketches,
        )
        run_silver(spark, args.bronze_base, args.silver_base, args.dt, args.format)
        print(job.apply())
    elif args.command == "validate":
        names = DATASETS if args.dataset == "all" else (args.dataset,)
        found = {n: infer_bronze(spark, args.bronze_base, n, args.format, args.dt) for n in names}
        report = schema_report(spark, found, names)
        report.show(report.count(), truncate=False)
        for name in names:
            rows = read_bronze(
                spark, args.bronze_base, name, args.format, [args.dt] if args.dt else None
            )
            sample_rows(rows, 10).show(truncate=80)
    elif args.command == "kpi":
        start, end = last_n_days(args.end or date.today())
        start = args.start or start
        # Without a declared schema: older files hold other names, and the watch time.
        media = read_gold(spark, args.gold_base, MEDIA)
        visitor = read_gold(spark, args.gold_base, VISITOR)
        picked = default_media(prep_kpi(media)) if args.media is None else args.media
        chosen = media_in(in_range(media, start, end), picked)
        with cached_gold(chosen) as chosen, cached_gold(in_range(visitor, start, end)) as seen:
            frames = media_frames(prep_kpi(media), chosen) | visitor_frames(seen)
            for name, df in frames.items():
                if args.output:
                    write_frame(df, args.output, name, args.output_format)
                print(f"{name}: preview, the first {PREVIEW} rows at most")
                df.show(PREVIEW, truncate=False)
    elif args.command == "days":
        today = date10(F.lit(args.exec_day)) if args.exec_day else F.current_date()
        one = spark.range(1)
        found = backfill_days(one, date10(F.lit(args.start)), today, date10(F.lit(args.end)))
        if args.bronze_base:
            found = incomplete_days(found, landed_days(spark, args.bronze_base)).orderBy("day")
        found.show(found.count(), truncate=False)
    elif args.command == "follow":
        print(follow_bronze(
            spark, args.bronze_base, args.silver_base, args.state, fmt=args.format
        ))
        for row in waiting(spark, args.state).orderBy("dt").toLocalIterator():
            print(f"waiting: {row['dt'] or 'no day'} has {row['files']} files of {row['datasets']}")


def main() -> None:
    args = parser().parse_args()
    spark = build_session(f"reelgauge-{args.command}", args.shuffle_partitions)
    try:
        run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
