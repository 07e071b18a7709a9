from datetime import date

import pytest
from pyspark.sql import functions as F

from reelgauge.functions.times import with_ymd
from reelgauge.operators import filters, kpi
from reelgauge.plans.dashboard import kpi_frames
from reelgauge.schemas import GOLD
from reelgauge.sources import tables

from .conftest import plan, rows

START, END = date(2025, 9, 19), date(2025, 9, 20)


@pytest.fixture
def media(spark):
    return spark.createDataFrame(
        [("m1", date(2025, 9, 19), 10, 4), ("m1", date(2025, 9, 20), 0, 0),
         ("m2", date(2025, 9, 20), 0, 1), ("m3", None, 7, 7), (None, date(2025, 9, 20), 1, 1),
         ("m1", date(2025, 9, 25), 3, 3)],
        "media_id string, event_date date, total_loads bigint, total_plays bigint",
    )


@pytest.fixture
def visitors(spark):
    return spark.createDataFrame(
        [("a", date(2025, 9, 19), 1, 2, 5.5), ("a", date(2025, 9, 20), 1, 1, 1.0),
         ("b", date(2025, 9, 20), 2, 3, 0.5), (None, date(2025, 9, 20), 1, 9, 1.0),
         ("c", date(2025, 9, 30), 1, 1, 1.0)],
        "visitor_id string, event_date date, media_interactions bigint, total_plays bigint,"
        " watch_time double",
    )


def test_prep_accepts_the_older_naming(spark):
    old = spark.createDataFrame(
        [("m1", "2025-09-19", "3", "x", "1.5"), ("m1", "n/a", None, "4", "NaN")],
        "media_id string, d string, plays string, loads string, seconds_watched string",
    )
    got = kpi.prep_kpi(old)
    columns = ("event_date", "total_plays", "total_loads", "watch_time_sec")
    assert rows(got, *columns) == [("2025-09-19", 3.0, 0.0, 1.5), (None, 0.0, 4.0, 0.0)]


def test_watch_time_takes_the_first_name_a_row_has(spark):
    df = spark.createDataFrame([("2", "9"), (None, "9")], "watch_time string, seconds_watched string")
    assert rows(kpi.unify_watch_time(df), "watch_time_sec") == [(2.0,), (9.0,)]
    assert rows(kpi.unify_watch_time(df.drop("watch_time")), "watch_time_sec") == [(9.0,), (9.0,)]
    none = df.drop("watch_time", "seconds_watched")
    assert rows(kpi.unify_watch_time(none), "watch_time_sec") == [(0.0,), (0.0,)]


def test_whole_numbers_stay_whole(media):
    got = kpi.prep_kpi(media)
    assert got.schema["total_plays"].dataType.simpleString() == "bigint"


def test_media_totals(media):
    got = kpi.media_totals(kpi.prep_kpi(filters.date_between(media, START, END))).first().asDict()
    assert got == {"total_plays": 6, "total_loads": 11, "total_watch_time_sec": 0,
                   "avg_play_rate": 54.55}
    empty = kpi.media_totals(kpi.prep_kpi(media.limit(0))).first().asDict()
    assert empty == {"total_plays": 0, "total_loads": 0, "total_watch_time_sec": 0,
                     "avg_play_rate": 0.0}


def test_visitor_totals(visitors):
    got = kpi.visitor_totals(kpi.prep_kpi(filters.date_between(visitors, START, END)))
    assert got.first().asDict() == {
        "unique_visitors": 2, "total_visitor_plays": 15, "total_visitor_watch": 8,
        "avg_watch_per_visitor": 4.0,
    }
    empty = kpi.visitor_totals(kpi.prep_kpi(visitors.limit(0))).first().asDict()
    assert set(empty.values()) == {0}
    assert rows(kpi.unique_visitors(visitors)) == rows(kpi.unique_visitors(visitors, True)) == [(3,)]


def test_media_kpis(media):
    got = kpi.media_kpis(kpi.prep_kpi(media)).collect()
    assert [(r["media_id"], r["plays"], r["loads"], r["play_rate"]) for r in got] == [
        ("m1", 7, 13, 53.85), ("m3", 7, 7, 100.0), ("m2", 1, 0, 0.0),
    ]


def test_trends_are_in_day_order(media, visitors):
    got = kpi.trend(kpi.prep_kpi(media)).collect()
    assert [(str(r["event_date"]), r["plays"]) for r in got] == [
        ("2025-09-19", 4), ("2025-09-20", 2), ("2025-09-25", 3),
    ]
    got = kpi.trend(kpi.prep_kpi(visitors)).collect()
    assert [r["watch_time_sec"] for r in got] == [5.5, 2.5, 1.0]


def test_top_visitors(spark, visitors):
    got = kpi.top_visitors(kpi.prep_kpi(visitors), 2).collect()
    assert [(r["visitor_id"], r["plays"], r["watch_time_sec"]) for r in got] == [
        ("a", 3, 6.5), ("b", 3, 0.5),
    ]
    assert "TakeOrderedAndProject" in plan(kpi.top_visitors(kpi.prep_kpi(visitors)))


def test_lists(spark, media):
    titled = media.withColumn("media_title", F.concat(F.lit("z"), F.length("media_id"), "media_id"))
    assert [r["media_id"] for r in kpi.media_list(titled).collect()] == ["m1", "m2", "m3"]
    assert kpi.media_list(media).columns == ["media_id"]
    many = spark.range(40).select(F.format_string("m%02d", "id").alias("media_id"))
    got = [r["media_id"] for r in kpi.default_media(many).collect()]
    assert got == [f"m{i:02d}" for i in range(15)]
    assert [r["media_id"] for r in kpi.default_media(media).collect()] == ["m1", "m2", "m3"]


def test_summary(media, visitors):
    got = kpi.summary_kpis(media, visitors, START, END)
    assert rows(got, "unique_visitors", "total_plays", "total_loads") == [(2, 6, 11)]
    assert got.first()["play_rate_pct"] == pytest.approx(600 / 11)
    # the selection narrows the media side only
    got = kpi.summary_kpis(media, visitors, START, END, ["m2"])
    assert rows(got) == [(2, 1, 0, 0.0)]
    nothing = kpi.summary_kpis(media, visitors, date(1990, 1, 1), date(1990, 1, 1))
    assert rows(nothing) == [(0, 0, 0, 0.0)]


def test_series(media, visitors):
    titled = media.withColumn("media_title", F.lit("t")).withColumn(
        "total_plays", F.nullif("total_plays", F.lit(4))
    )
    got = kpi.media_daily_series(titled, START, END, ["m1", "m2"]).collect()
    assert [(str(r[0]), *r[1:]) for r in got] == [
        ("2025-09-19", "m1", "t", 0, 10), ("2025-09-20", "m1", "t", 0, 0),
        ("2025-09-20", "m2", "t", 1, 0),
    ]
    got = kpi.visitor_daily_series(visitors, START, END).collect()
    assert [tuple(r)[1:] for r in got] == [(1, 2), (4, 13)]


def test_selection_by_list_or_frame(spark, media):
    assert filters.media_in(media, None) is media
    assert filters.media_in(media, []) is media
    short = rows(filters.media_in(media, ["m1", "m1"]), "media_id")
    assert short == [("m1",)] * 3
    long = [f"x{i}" for i in range(filters.LITERAL_IDS)] + ["m1"]
    by_list = filters.media_in(media, long)
    assert rows(by_list, "media_id") == short and "LeftSemi" in plan(by_list)
    twice = spark.createDataFrame([("m1",), ("m1",)], "media_id string")
    assert rows(filters.media_in(media, twice), "media_id") == short


def test_gold_range_reads_only_its_days(spark, media, folder):
    tables.write_gold(media, folder, "agg_media_daily")
    stored = tables.read_gold(spark, folder, "agg_media_daily", GOLD["agg_media_daily"])
    got = filters.date_between(stored, START, START)
    assert rows(got, "media_id", "total_plays") == [("m1", 4)]
    assert "make_date" in plan(got).split("PartitionFilters: [")[1].split("PushedFilters")[0]
    metrics = got.select("total_plays")
    assert {r[0].split("year=")[1].split("/part")[0] for r in
            metrics.select(F.input_file_name()).collect()} == {"2025/month=9/day=19"}


def test_read_gold_without_data(spark, folder):
    for schema in (GOLD["agg_media_daily"], None):
        got = tables.read_gold(spark, folder, "agg_media_daily", schema)
        assert got.isEmpty() and got.columns == GOLD["agg_media_daily"].names


def test_read_gold_merges_and_fills(spark, media, folder):
    with_ymd(media).write.mode("append").parquet(f"{folder}/agg_media_daily")
    more = media.where("media_id = 'm2'").drop("total_loads").withColumn("watch_time", F.lit(3))
    more.write.mode("append").parquet(f"{folder}/agg_media_daily")
    merged = tables.read_gold(spark, folder, "agg_media_daily")
    assert merged.count() == 7 and merged.where("watch_time = 3 and total_loads is null").count() == 1
    declared = tables.read_gold(spark, folder, "agg_media_daily", GOLD["agg_media_daily"])
    assert declared.count() == 7 and "watch_time" not in declared.columns


def test_cached_gold_lets_go(media):
    with tables.cached_gold(media) as kept:
        assert kept.is_cached and kept.count() == 6
    assert not media.is_cached


def test_kpi_frames(media, visitors):
    frames = kpi_frames(media, visitors, START, END, ["m1"])
    assert frames["media_totals"].first()["total_plays"] == 4
    assert rows(frames["media_list"]) == [("m1",), ("m2",), ("m3",)]
    assert frames["visitor_totals"].first()["unique_visitors"] == 2
    assert frames["visitor_sample"].count() == 4
    assert set(frames) == {
        "media_list", "default_media", "media_totals", "media_trend", "media_kpis",
        "media_sample", "visitor_totals", "top_visitors", "visitor_trend", "visitor_sample",
    }
