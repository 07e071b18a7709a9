from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from reelgauge.functions import numbers, paths, times
from reelgauge.session import scratch_path

from .conftest import rows


def one(spark, column, **values):
    """The value of an expression over one row of text columns."""
    schema = ", ".join(f"{name} string" for name in values) or "x string"
    df = spark.createDataFrame([tuple(values.values()) or (None,)], schema)
    return df.select(column.alias("v")).first()["v"]


# The ISO-8601 spellings the feeds use.
STAMP_PATTERNS = (
    "yyyy-MM-dd'T'HH:mm:ss.SSSXXX",
    "yyyy-MM-dd'T'HH:mm:ssXXX",
    "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'",
    "yyyy-MM-dd'T'HH:mm:ss'Z'",
)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("10:15", None), ("T10:15:00", None), ("12345-01-01", None), ("12345-01-01T00:00:00Z", None),
        (" 2025-09-19T10:11:12Z ", datetime(2025, 9, 19, 10, 11, 12)), ("2025", None),
        ("2025-09-19T10:11:12.345Z", datetime(2025, 9, 19, 10, 11, 12, 345000)),
        ("2025-09-19T10:11:12Z", datetime(2025, 9, 19, 10, 11, 12)),
        ("2025-09-19T10:11:12+02:00", datetime(2025, 9, 19, 8, 11, 12)),
        ("2025-09-19T10:11:12.500-05:30", datetime(2025, 9, 19, 15, 41, 12, 500000)),
        ("2025-09-19", datetime(2025, 9, 19)),
        ("garbage", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_ts(spark, text, expected):
    stamp = F.date_format(times.parse_ts(F.col("x")), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    wanted = expected.strftime("%Y-%m-%d %H:%M:%S.%f") if expected else None
    assert one(spark, stamp, x=text) == wanted


def test_the_cast_reads_every_spelling_of_the_feeds(spark):
    """What any pattern can read, ``parse_ts`` reads as the same instant."""
    days = ("2025-09-19", "2024-02-29", "1999-12-31", "0001-01-01", "9999-12-31", "2025-02-30")
    clocks = ("00:00:00", "23:59:59", "10:11:12", "24:00:00", "10:61:00")
    fractions = ("", ".000", ".345", ".3", ".123456")
    zones = ("Z", "+00:00", "-00:00", "+02:00", "-05:30", "+14:00", "+18:00", "+19:00", "+0200", "")
    texts = [f"{d}T{c}{f}{z}" for d in days for c in clocks for f in fractions for z in zones]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    tried = F.coalesce(*[F.try_to_timestamp("x", F.lit(p)) for p in STAMP_PATTERNS])
    read = df.select("x", tried.alias("tried"), times.parse_ts(F.col("x")).alias("cast"))
    read = read.where("tried is not null")
    assert read.count() > 100
    assert read.where("not (tried <=> cast)").count() == 0


def test_written_day_and_utc_day_differ(spark):
    text = "2025-09-19T23:30:00-05:00"
    assert one(spark, times.date10(F.col("x")), x=text) == date(2025, 9, 19)
    assert one(spark, F.to_date(times.parse_ts(F.col("x"))), x=text) == date(2025, 9, 20)
    assert one(spark, times.date10(F.col("x")), x="n/a") is None
    df = spark.createDataFrame([(text,)], "t string")
    typed = df.select(times.parse_ts(F.col("t")).alias("t"))
    assert df.select(times.day_of(df, "t")).first()[0] == date(2025, 9, 19)
    assert typed.select(times.day_of(typed, "t")).first()[0] == date(2025, 9, 20)


def test_backfill_days(spark):
    df = spark.createDataFrame(
        [("2025-09-20", "2025-09-22", "2025-10-01"), ("2025-09-20", "2025-09-10", "2025-10-01"),
         ("2025-10-01", "2025-12-31", "2025-10-01")],
        "start string, run string, stop string",
    )
    day = {c: times.date10(F.col(c)) for c in df.columns}
    got = times.backfill_days(df, day["start"], day["run"], day["stop"])
    assert rows(got) == [("2025-09-20",), ("2025-09-21",), ("2025-09-22",), ("2025-10-01",)]


def test_ranges():
    today = date(2025, 10, 1)
    assert times.last_n_days(today) == (date(2025, 9, 1), today)
    assert times.as_range(today) == (today, today)
    assert times.as_range((date(2025, 9, 1), today)) == (date(2025, 9, 1), today)


@pytest.mark.parametrize(
    "path, media, day",
    [
        ("s3://b/bronze/visitors/dt=2025-09-19/visitors_ABC9_page1_2025.ndjson", "ABC9", "2025-09-19"),
        ("s3://b/medias_old/medias/dt=2025-09-19/medias_x1_2025.ndjson", "x1", "2025-09-19"),
        ("s3://b/dt=2020-01-01/metadata/dt=2025-09-19/metadata_q_1.ndjson", "q", "2025-09-19"),
        ("s3://b/run_dt=2020-01-01/part-000.json", None, None),
        ("s3://b/visitors/other.ndjson", None, None),
    ],
)
def test_path_columns(spark, path, media, day):
    assert one(spark, paths.id_from_path(F.col("x")), x=path) == media
    found = one(spark, paths.dt_from_path(F.col("x")), x=path)
    assert (str(found) if found else None) == day


def test_visitors_pattern_needs_page(spark):
    path = "a/visitors_m1_2025.ndjson"
    assert one(spark, paths.id_from_path(F.col("x"), paths.VISITORS_FILE), x=path) is None


def test_bronze_root():
    assert paths.bronze_root("s3://b/bronze/") == "s3://b/bronze"
    assert paths.bronze_root("s3://b/bronze/", "feed") == "s3://b/bronze/feed"
    assert paths.bronze_root("s3://b/bronze/feed/", "feed") == "s3://b/bronze/feed"


@pytest.mark.parametrize(
    "text, whole, number",
    [("12", 12, 12.0), ("12.0", 12, 12.0), ("12.9", 12, 12.9), ("-1.5", -1, -1.5),
     ("1e3", 1000, 1000.0), ("x", None, None), ("", None, None), (None, None, None),
     ("9007199254740993", 9007199254740993, 9007199254740992.0)],
)
def test_casts(spark, text, whole, number):
    assert one(spark, numbers.to_long(F.col("x")), x=text) == whole
    assert one(spark, numbers.to_double(F.col("x")), x=text) == number


def test_number_or_zero(spark):
    for text, expected in (("2.5", 2.5), ("x", 0.0), (None, 0.0), ("NaN", 0.0)):
        assert one(spark, numbers.number_or_zero(F.col("x")), x=text) == expected
    assert one(spark, numbers.zero_long(F.col("x").cast("bigint")), x=None) == 0


def test_percent(spark):
    def rate(plays, loads, digits=2):
        column = numbers.percent(F.lit(plays).cast("bigint"), F.lit(loads).cast("bigint"), digits)
        return one(spark, column)

    assert rate(1, 3) == 33.33
    assert rate(1, 3, None) == pytest.approx(100 / 3)
    assert rate(1, 800) == 0.13  # half up
    assert rate(0, 0) == 0.0
    assert rate(1, 0) == 0.0
    assert rate(None, None) == 0.0
    assert one(spark, numbers.per_head(F.lit(7), F.lit(0))) == 0.0
    assert one(spark, numbers.per_head(F.lit(7), F.lit(3))) == 2.33


def test_coalesce_text(spark):
    df = spark.createDataFrame([(None, 2, "x"), (None, None, "y")], "a int, b int, c string")
    got = df.select(numbers.coalesce_text("a", "b", "c").alias("v"))
    assert rows(got) == [("2",), ("y",)]


def test_scratch_is_below_the_checkpoint_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(f"file:{base}/reelgauge-") and "/x-" in first and first != second


def test_whole_numbers_are_exact(spark):
    for text, value in ((" 9007199254740993 ", 9007199254740993), ("9007199254740993.9", 9007199254740993),
                        ("1e3", 1000), ("-7.9", -7), ("9223372036854775808", None), ("x1", None)):
        assert one(spark, numbers.to_long(F.col("x")), x=text) == value, text
