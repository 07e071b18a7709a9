import os
import threading
from datetime import date

import pytest
from pyspark.sql import functions as F

from reelgauge.operators.quality import QualityError
from reelgauge.plans import cli, silver_job
from reelgauge.plans.gold_job import MEDIA, VISITOR, GoldRefresh, run_gold
from reelgauge.plans.silver_job import missing_metadata, run_silver
from reelgauge.plans.views import gold_views
from reelgauge.schemas import GOLD
from reelgauge.session import scratch_path
from reelgauge.sources import tables
from reelgauge.sources.tables import read_gold, read_silver

from .conftest import land, media_row, plan, rows, visitor, write_lines

DAY, NEXT = "2025-09-19", "2025-09-20"


@pytest.fixture
def bases(folder):
    return f"{folder}/bronze", f"{folder}/silver", f"{folder}/gold"


def fact(spark, base):
    return read_silver(spark, base, "fact_media_engagement")


def gold(spark, base, table=MEDIA):
    stored = read_gold(spark, base, table, GOLD[table])
    return rows(stored, stored.columns[0], "event_date", "total_loads", "total_plays")


def test_bronze_to_gold(spark, bases):
    bronze, silver, out = bases
    land(bronze, DAY, [visitor("a"), visitor("b", loads=2), "{broken"])
    land(bronze, NEXT, [visitor("a", day=NEXT)])
    health = run_silver(spark, bronze, silver, quarantine_base=f"{silver}/bad")
    assert health["visitors"] == {
        "rows": 4, "corrupt_rows": 1, "keyed_rows": 3, "missing_media_id": 0,
    }
    assert rows(fact(spark, silver), "visitor_id", "dt") == [("a", DAY), ("a", NEXT), ("b", DAY)]
    bad = spark.read.parquet(f"{silver}/bad/visitors")
    assert rows(bad, "_corrupt_record", "dt") == [("{broken", DAY)]
    assert read_silver(spark, silver, "fact_media_daily_raw").count() == 2
    assert run_gold(spark, silver, out) == {MEDIA: 2, VISITOR: 3}
    assert gold(spark, out) == [("m1", DAY, 3, 2), ("m1", NEXT, 1, 1)]
    # personal data stays in silver
    for table in (MEDIA, VISITOR):
        assert not {"email", "name"} & set(spark.read.parquet(f"{out}/{table}").columns)


def test_running_again_changes_nothing(spark, bases):
    bronze, silver, out = bases
    land(bronze, DAY, [visitor("a"), visitor("b")])
    seen = []
    for _ in range(2):
        run_silver(spark, bronze, silver)
        run_gold(spark, silver, out)
        dims = [rows(read_silver(spark, silver, t)) for t in ("dim_media", "dim_visitor")]
        seen.append((rows(fact(spark, silver)), dims, gold(spark, out), gold(spark, out, VISITOR)))
    assert seen[0] == seen[1]


def test_late_page_joins_its_day(spark, bases):
    bronze, silver, _ = bases
    land(bronze, DAY, [visitor("a")])
    land(bronze, NEXT, [visitor("z", day=NEXT)])
    run_silver(spark, bronze, silver)
    land(bronze, DAY, [visitor("b")], page=2)
    run_silver(spark, bronze, silver, [DAY])
    assert rows(fact(spark, silver), "visitor_id", "dt") == [("a", DAY), ("b", DAY), ("z", NEXT)]


def test_bad_input_writes_nothing(spark, bases):
    bronze, silver, _ = bases
    land(bronze, DAY, [visitor("a")])
    write_lines(bronze, "visitors", "odd.ndjson", [visitor("b", media="")], DAY)
    with pytest.raises(QualityError, match="1 visitor rows"):
        run_silver(spark, bronze, silver)
    with pytest.raises(QualityError, match="would be empty"):
        run_silver(spark, bronze, silver, ["2020-01-01"])
    assert not os.path.exists(silver)


def test_feeds_are_staged_together(spark, bases, monkeypatch):
    bronze, silver, _ = bases
    land(bronze, DAY, [visitor("a"), visitor("b", media=""), "{broken"])
    write_lines(bronze, "visitors", "odd.ndjson", [visitor("c", media="")], DAY)
    one, both = silver_job.stage_bronze, threading.Barrier(2, timeout=60)

    def stage(df, path, measures):
        if not path.endswith("/metadata"):
            both.wait()
        return one(df, path, measures)

    monkeypatch.setattr(silver_job, "stage_bronze", stage)
    with pytest.raises(QualityError, match="1 visitor rows"):
        run_silver(spark, bronze, silver)
    # the path stays with rows that are corrupt or have no media, and with no others
    with tables.scratch_folder(spark, "parsed") as scratch:
        monkeypatch.setattr(silver_job, "stage_bronze", one)
        staged, health = silver_job.stage_silver_input(spark, bronze, scratch, None, "ndjson")
        found = rows(staged["visitors"].where("source_path is not null"), "visitor_key")
        assert found == [("c",), (None,)]
        assert rows(staged["visitors"], "visitor_key", "media_id") == [
            ("a", "m1"), ("b", "m1"), ("c", None), (None, "m1"),
        ]
        assert health["visitors"]["missing_media_id"] == 1


def test_useless_metadata_is_refused_before_other_feeds_are_read(spark, bases, monkeypatch):
    bronze, silver, _ = bases
    land(bronze, DAY, [visitor("a")])
    write_lines(bronze, "metadata", f"metadata_m1_{DAY}.ndjson", ["{broken"], DAY)
    one, read = silver_job.stage_bronze, []

    def stage(df, path, measures):
        read.append(os.path.basename(path))
        return one(df, path, measures)

    monkeypatch.setattr(silver_job, "stage_bronze", stage)
    with pytest.raises(QualityError, match="dim_media would be empty"):
        run_silver(spark, bronze, silver)
    assert read == ["metadata"]
    health = run_silver(spark, bronze, silver, needed=["visitors"])
    assert sorted(read[1:]) == ["medias", "metadata", "visitors"] and health["visitors"]["rows"] == 1


def test_no_scratch_is_left(spark, bases):
    bronze, silver, _ = bases
    scratch = os.path.dirname(scratch_path(spark, "x")).removeprefix("file:")
    before = set(os.listdir(scratch))
    land(bronze, DAY, [visitor("a")])
    run_silver(spark, bronze, silver)
    with pytest.raises(QualityError):
        run_silver(spark, bronze, silver, ["2020-01-01"])
    left = set(os.listdir(scratch)) - before
    assert not any(name.startswith("parsed") for name in left)


def test_media_without_metadata_is_counted(spark, bases):
    bronze, silver, _ = bases
    land(bronze, DAY, [visitor("a"), visitor("a", media="m8"), visitor("b", media="m8")])
    run_silver(spark, bronze, silver)
    dim = read_silver(spark, silver, "dim_media")
    assert missing_metadata(fact(spark, silver), dim) == 1


def test_full_rebuild_drops_stale_days(spark, bases):
    """A row that moves to another event date leaves no copy on the old one."""
    bronze, silver, out = bases
    land(bronze, DAY, [visitor("a")])
    run_silver(spark, bronze, silver)
    run_gold(spark, silver, out)
    land(bronze, DAY, [visitor("a", last_active_at=f"{NEXT}T01:00:00Z")])
    run_silver(spark, bronze, silver, [DAY])
    run_gold(spark, silver, out)
    assert gold(spark, out) == [("m1", NEXT, 1, 1)]


def test_refresh_equals_full_rebuild(spark, bases):
    """Moved rows, a date left empty, a media whose day moved, rows that lose their date."""
    bronze, silver, out = bases
    bare = {"created_at": None, "last_active_at": None}
    land(bronze, DAY, [
        visitor("a"), visitor("b", day="2025-09-10", event="x"), visitor("c", **bare),
        visitor("d", media="m8", **bare),
    ])
    land(bronze, NEXT, [visitor("z", day=NEXT), visitor("y", day=NEXT, **bare)], media=("m2",))
    run_silver(spark, bronze, silver)
    run_gold(spark, silver, out)
    old = gold(spark, out)
    assert ("m8", None, 1, 1) in old and ("m1", "2025-09-10", 1, 1) in old

    job = GoldRefresh(spark, silver, out, [DAY], f"{silver}-media-days")
    moved = media_row("m1", created="2025-08-01T00:00:00Z")
    write_lines(bronze, "metadata", f"metadata_m1_{DAY}.ndjson", [moved], DAY)
    write_lines(bronze, "visitors", f"visitors_m1_page1_{DAY}.ndjson", [
        visitor("a"), visitor("b", last_active_at="2025-09-12T00:00:00Z", event="x"),
        visitor("c", **bare), visitor("d", media="m8"),
    ], DAY)
    run_silver(spark, bronze, silver, [DAY])
    touched = job.apply()
    # 2025-08-01: y is undated and of m1, on a day that was not rebuilt, and still moves
    assert set(touched) == {
        None, date(2025, 8, 1), date(2025, 9, 1), date(2025, 9, 10), date(2025, 9, 12),
        date(2025, 9, 19),
    }
    got = gold(spark, out), gold(spark, out, VISITOR)
    run_gold(spark, silver, f"{out}-full")
    assert got == (gold(spark, f"{out}-full"), gold(spark, f"{out}-full", VISITOR))
    assert ("m1", "2025-08-01", 2, 2) in got[0]
    assert not any(day in (None, "2025-09-10", "2025-09-01") for _, day, *_ in got[0])


def test_refresh_keeps_the_meanings_gold_was_built_with(spark, bases):
    bronze, silver, out = bases
    land(bronze, DAY, [visitor("a", plays=3), visitor("b", created_at=None)])
    run_silver(spark, bronze, silver)
    chosen = {"mode": "first_seen", "interactions": "sum_plays"}
    run_gold(spark, silver, out, **chosen)
    job = GoldRefresh(spark, silver, out, [DAY], f"{silver}-media-days", **chosen)
    land(bronze, DAY, [visitor("c", plays=5)], page=2)
    run_silver(spark, bronze, silver, [DAY])
    assert job.apply() == [None, date(2025, 9, 19)]
    stored = read_gold(spark, out, VISITOR, GOLD[VISITOR])
    assert rows(stored, "visitor_id", "event_date", "media_interactions") == [
        ("a", DAY, 3), ("b", None, 1), ("c", DAY, 5),
    ]


def test_refresh_without_change(spark, bases):
    bronze, silver, out = bases
    land(bronze, DAY, [visitor("a")])
    run_silver(spark, bronze, silver)
    run_gold(spark, silver, out)
    before = gold(spark, out), gold(spark, out, VISITOR)
    job = GoldRefresh(spark, silver, out, [DAY], f"{silver}-media-days")
    run_silver(spark, bronze, silver, [DAY])
    assert job.apply() == [date(2025, 9, 19)]
    assert (gold(spark, out), gold(spark, out, VISITOR)) == before


def test_write_modes(spark, folder):
    df = spark.createDataFrame([(1, DAY), (2, NEXT)], "a int, day string").select(
        "a", F.col("day").cast("date").alias("dt")
    )
    assert tables.write_partitioned(None, folder, "t") is None
    with pytest.raises(ValueError):
        tables.write_partitioned(df, folder, "t", mode="ignore")
    seen = tables.write_partitioned(df, folder, "t", measures={"n": F.count(F.lit(1))})
    assert seen.get == {"n": 2}
    tables.write_partitioned(df.where("a = 2"), folder, "t", files=1)
    assert rows(spark.read.parquet(f"{folder}/t")) == [(1, DAY), (2, NEXT)]
    tables.write_partitioned(df, folder, "t", mode="append", spread=False)
    assert spark.read.parquet(f"{folder}/t").count() == 4
    tables.write_full(df.where("a = 1").drop("dt"), folder, "t")
    assert rows(spark.read.parquet(f"{folder}/t")) == [(1,)]
    seen = tables.write_full(df, folder, "u", by=("dt",), rows_as="rows")
    assert seen.get == {"rows": 2}
    tables.write_full(df.where("a = 1"), folder, "u", by=("dt",))
    assert rows(spark.read.parquet(f"{folder}/u")) == [(1, DAY)]


def test_a_day_with_most_rows_is_written_by_many_tasks(spark, folder):
    """A quarter of the days holds nearly all rows; no task gets all of them."""
    day = F.when(F.col("id") % 50 > 0, DAY).otherwise(NEXT).cast("date")
    df = spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("v"), day.alias("dt"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        tables.write_partitioned(df, folder, "t")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [f for f in os.listdir(f"{folder}/t/dt={DAY}") if f.endswith(".parquet")]
    assert len(files) > 4
    assert len([f for f in os.listdir(f"{folder}/t/dt={NEXT}") if f.endswith(".parquet")]) <= 2
    assert spark.read.parquet(f"{folder}/t").count() == 200_000


def test_gold_append_is_not_idempotent(spark, folder):
    df = spark.createDataFrame([("m1", date(2025, 9, 19), 1, 1)],
                               "media_id string, event_date date, total_loads long, total_plays long")
    for _ in range(2):
        tables.write_gold(df, folder, MEDIA, mode="append")
    assert spark.read.parquet(f"{folder}/{MEDIA}").count() == 2
    for _ in range(2):
        tables.write_gold(df, folder, VISITOR)
    assert spark.read.parquet(f"{folder}/{VISITOR}").count() == 1


def test_views_prune_by_event_date(spark, bases):
    bronze, silver, out = bases
    land(bronze, DAY, [visitor("a")])
    land(bronze, NEXT, [visitor("a", day=NEXT, plays=4)])
    run_silver(spark, bronze, silver)
    run_gold(spark, silver, out)
    gold_views(spark, out, silver)
    text = "select media_title, total_plays from {} where event_date between :a and :b"
    days = {"a": date(2025, 9, 20), "b": date(2025, 9, 21)}
    for name in ("agg_media_daily", "agg_media_daily_p"):
        got = spark.sql(text.format(name), args=days)
        assert rows(got) == [("Title m1", 4)]
        assert "make_date" in plan(got).split("PartitionFilters: [")[1].split("PushedFilters")[0]
    seen = spark.sql("select sum(media_interactions) from agg_visitor_daily_p")
    assert seen.first()[0] == 2


def test_command_line(spark, bases, capsys):
    bronze, silver, out = bases
    land(f"{bronze}/feed", DAY, [visitor("a"), visitor("b", media="m8")])

    def call(*args):
        cli.run(spark, cli.parser().parse_args(args))
        return capsys.readouterr().out

    source = ("--bronze-base", f"{bronze}/", "--sub-folder", "feed")
    said = call("silver", *source, "--silver-base", silver, "--dt", DAY)
    assert "1 media ids" in said
    assert MEDIA in call("gold", "--silver-base", silver, "--gold-base", out)
    assert gold(spark, out) == [("m1", DAY, 1, 1), ("m8", DAY, 1, 1)]
    call("refresh", *source, "--silver-base", silver, "--gold-base", out, "--dt", DAY)
    assert gold(spark, out) == [("m1", DAY, 1, 1), ("m8", DAY, 1, 1)]
    assert "visitor_identity.org.title" in call("validate", *source, "--dataset", "visitors")
    said = call("kpi", "--gold-base", out, "--start", DAY, "--end", NEXT, "--media", "m8")
    assert "media_totals: preview" in said and "top_visitors" in said
    call("kpi", "--gold-base", out, "--start", DAY, "--end", NEXT, "--output", f"{out}-kpi")
    assert rows(spark.read.parquet(f"{out}-kpi/media_kpis"), "media_id", "plays") == [
        ("m1", 1.0), ("m8", 1.0),
    ] or rows(spark.read.parquet(f"{out}-kpi/media_kpis"), "media_id", "plays") == [("m1", 1), ("m8", 1)]
    days = call("days", "--start", "2025-09-20", "--end", "2025-10-01",
                "--exec-day", "2025-09-21T05:00:00Z")
    assert "2025-09-21" in days and "2025-09-22" not in days
    assert DAY in call("follow", *source, "--silver-base", f"{silver}2", "--state", f"{out}-state")


def test_the_kpi_command_reads_both_namings_and_writes_whole_frames(spark, folder):
    """Sixty days of older and newer files under one table; the command prints only a few rows."""
    cli_args = ["kpi", "--gold-base", folder, "--start", "2025-01-01", "--end", "2025-12-31"]
    days = spark.range(60).select(
        F.date_add(F.lit("2025-03-01").cast("date"), F.col("id").cast("int")).alias("day"), "id"
    )
    days.where("id < 30").select(
        F.lit("m1").alias("media_id"), F.col("day").cast("string").alias("d"),
        F.lit("7").alias("plays"), F.lit(9).alias("loads"), F.lit(33).alias("seconds_watched"),
    ).write.mode("append").parquet(f"{folder}/{MEDIA}")
    days.where("id >= 30").select(
        F.lit("m1").alias("media_id"), F.col("day").alias("event_date"),
        F.lit(2).cast("long").alias("total_plays"), F.lit(4).cast("long").alias("total_loads"),
        F.lit(1.5).alias("watch_time"),
    ).write.mode("append").parquet(f"{folder}/{MEDIA}")
    cli.run(spark, cli.parser().parse_args([*cli_args, "--output", f"{folder}/kpi"]))
    trend = spark.read.parquet(f"{folder}/kpi/media_trend")
    assert trend.count() == 60
    total = spark.read.parquet(f"{folder}/kpi/media_totals").first()
    assert (total["total_plays"], total["total_loads"], total["total_watch_time_sec"]) == (
        30 * 7 + 30 * 2, 30 * 9 + 30 * 4, 30 * 33 + 45
    )


def test_a_refresh_over_odd_stamps(spark, bases):
    bronze, silver, out = bases
    odd = ["12345-01-01T00:00:00Z", "10:15", "9999-12-31T00:00:00Z", "garbage"]
    land(bronze, DAY, [visitor(f"v{i}", last_active_at=t, created_at=None) for i, t in enumerate(odd)])
    run_silver(spark, bronze, silver)
    run_gold(spark, silver, out)
    job = GoldRefresh(spark, silver, out, [DAY], f"{silver}-media-days")
    run_silver(spark, bronze, silver, [DAY])
    # the rows without a day of their own fall back to the day the media was created
    assert job.apply() == [date(2025, 9, 1), date(9999, 12, 31)]
    assert not os.path.exists(f"{silver}-media-days")


def test_a_failed_refresh_leaves_no_snapshot(spark, bases):
    bronze, silver, out = bases
    land(bronze, DAY, [visitor("a")])
    run_silver(spark, bronze, silver)
    job = GoldRefresh(spark, silver, out, [DAY], f"{silver}-media-days", interactions="no such")
    with pytest.raises(ValueError):
        job.apply()
    assert not os.path.exists(f"{silver}-media-days")


def test_an_empty_fact_is_refused(spark, bases):
    bronze, silver, _ = bases
    land(bronze, DAY, [visitor(""), visitor("")])
    with pytest.raises(QualityError):
        run_silver(spark, bronze, silver)
