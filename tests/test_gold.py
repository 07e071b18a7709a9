from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reelgauge.operators import event_date, gold, joins

from .conftest import plan, rows

FACT = (
    "media_id string, visitor_id string, load_count bigint, play_count bigint,"
    " first_seen timestamp, last_active timestamp, dt date"
)
DIM = "media_id string, title string, created_at timestamp, dt date"
D1, D2, D3 = date(2025, 9, 19), date(2025, 9, 20), date(2025, 9, 21)


def at(day):
    return datetime(day.year, day.month, day.day, 12) if day else None


def fact_of(spark, data):
    return spark.createDataFrame(
        [(m, v, n, p, at(first), at(last), dt) for m, v, n, p, first, last, dt in data], FACT
    )


def dim_of(spark, data):
    return spark.createDataFrame([(m, f"T{m}", at(c), dt) for m, c, dt in data], DIM)


@pytest.fixture
def small(spark):
    fact = fact_of(spark, [
        ("m1", "a", 1, 1, D1, D2, D1),       # last active wins
        ("m1", "b", 2, 0, D1, None, D1),     # first seen
        ("m1", "c", 4, 3, None, None, D1),   # the media's day
        ("m9", "a", 8, 5, None, None, D1),   # no dimension row: stays without a date
    ])
    dim = dim_of(spark, [("m1", D2, D1), ("m1", D3, D2), ("m2", D1, D1)])
    return fact, dim


def test_event_date_order_and_no_fan_out(small):
    fact, dim = small
    got = event_date.resolve_event_date(fact, dim)
    assert rows(got, "media_id", "visitor_id", "event_date") == [
        ("m1", "a", "2025-09-20"), ("m1", "b", "2025-09-19"), ("m1", "c", "2025-09-21"),
        ("m9", "a", None),
    ]
    assert got.columns.count("media_id") == 1 and "media_created_date" not in got.columns


def test_beyond_the_broadcast_bound_the_result_is_the_same(small):
    fact, dim = small
    wide = event_date.resolve_event_date(fact, dim)
    beyond = event_date.resolve_event_date(fact, dim, broadcast_bytes=0)
    assert rows(wide.select(*sorted(wide.columns))) == rows(beyond.select(*sorted(wide.columns)))
    assert rows(gold.visitor_daily(fact, dim)) == rows(gold.visitor_daily(fact, dim, broadcast_bytes=0))


def test_media_daily(small):
    fact, dim = small
    assert rows(gold.media_daily(fact, dim), "media_id", "event_date", "total_loads", "total_plays") == [
        ("m1", "2025-09-19", 2, 0), ("m1", "2025-09-20", 1, 1), ("m1", "2025-09-21", 4, 3),
        ("m9", None, 8, 5),
    ]


def test_visitor_daily_and_its_interactions(small):
    fact, dim = small
    columns = ("visitor_id", "event_date", "media_interactions", "total_plays", "total_loads")
    assert rows(gold.visitor_daily(fact, dim), *columns) == [
        ("a", "2025-09-20", 1, 1, 1), ("a", None, 1, 5, 8), ("b", "2025-09-19", 1, 0, 2),
        ("c", "2025-09-21", 1, 3, 4),
    ]
    by_plays = gold.visitor_daily(fact, dim, interactions="sum_plays")
    assert rows(by_plays, "media_interactions") == rows(by_plays, "total_plays")


def test_first_seen_mode_needs_no_dimension(small):
    fact, _ = small
    got = gold.media_daily(fact, mode="first_seen")
    assert rows(got, "media_id", "event_date", "total_plays") == [
        ("m1", "2025-09-19", 1), ("m1", None, 3), ("m9", None, 5),
    ]
    assert rows(gold.visitor_daily(fact, mode="first_seen"), "visitor_id", "total_plays") == [
        ("a", 1), ("a", 5), ("b", 0), ("c", 3),
    ]


def test_unknown_choices_are_refused(small):
    fact, dim = small
    for call in (
        lambda: gold.media_daily(fact, dim, mode="yesterday"),
        lambda: gold.media_daily(fact),
        lambda: gold.visitor_daily(fact),
        lambda: gold.visitor_daily(fact, dim, interactions="likes"),
    ):
        with pytest.raises(ValueError):
            call()


def test_latest_snapshot_counts_running_totals_once(spark):
    fact = fact_of(spark, [("m1", "a", n, n, D1, D1, D1 + timedelta(n)) for n in (1, 2, 3)])
    dim = dim_of(spark, [("m1", D1, D1)])
    assert rows(gold.media_daily(fact, dim), "total_plays") == [(6,)]
    assert rows(gold.media_daily(fact, dim, latest_only=True), "total_plays") == [(3,)]
    assert rows(gold.visitor_daily(fact, dim, latest_only=True), "total_plays") == [(3,)]


def test_coverage_and_unknown_media(small):
    fact, dim = small
    assert rows(event_date.event_date_coverage(fact, dim)) == [(4, 2, 1)]
    assert rows(event_date.event_date_coverage(fact.limit(0), dim)) == [(0, 0, 0)]
    assert rows(joins.unknown_media(fact, dim)) == [("m9",)]


def test_text_stamps_use_the_written_day(spark):
    fact = spark.createDataFrame(
        [("m1", "a", 1, 1, "2025-09-18T08:00:00Z", "2025-09-19T23:30:00-05:00"),
         ("m1", "b", 1, 1, None, "n/a")],
        "media_id string, visitor_id string, load_count bigint, play_count bigint,"
        " first_seen string, last_active string",
    )
    dim = spark.createDataFrame([("m1", "2025-09-01T00:00:00Z")], "media_id string, created_at string")
    got = event_date.resolve_event_date(fact, dim)
    assert rows(got, "visitor_id", "event_date") == [("a", "2025-09-19"), ("b", "2025-09-01")]


def test_with_title_takes_the_latest(small):
    _, dim = small
    got = joins.with_title(dim.select("media_id").distinct(), dim)
    assert rows(got) == [("m1", "Tm1"), ("m2", "Tm2")]


day_or_none = st.sampled_from([D1, D2, D3, None])
fact_rows = st.lists(
    st.tuples(st.sampled_from(["m1", "m2", "m3"]), st.sampled_from(["a", "b"]),
              st.integers(0, 5), st.integers(0, 5), day_or_none, day_or_none, st.just(D1)),
    min_size=1, max_size=25,
)
dim_rows = st.lists(
    st.tuples(st.sampled_from(["m1", "m2"]), day_or_none, st.sampled_from([D1, D2, D3])),
    max_size=4, unique_by=lambda r: (r[0], r[2]),
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(fact_rows, dim_rows)
def test_gold_against_brute_force(spark, data, dims):
    created = {}
    for media, day, _ in sorted(dims, key=lambda r: r[2]):
        created[media] = day
    media, visitors = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0, 0])
    for m, v, loads, plays, first, last, _ in data:
        day = last or first or created.get(m)
        key = str(day) if day else None
        media[m, key] = [a + b for a, b in zip(media[m, key], (loads, plays))]
        visitors[v, key] = [a + b for a, b in zip(visitors[v, key], (1, plays, loads))]
    fact, dim = fact_of(spark, data), dim_of(spark, dims)
    got = gold.media_daily(fact, dim).select("media_id", "event_date", "total_loads", "total_plays")
    assert rows(got) == sorted(((*k, *v) for k, v in media.items()), key=repr)
    for bound in (joins.BROADCAST_BYTES, 0):
        got = gold.visitor_daily(fact, dim, broadcast_bytes=bound).select(
            "visitor_id", "event_date", "media_interactions", "total_plays", "total_loads"
        )
        assert rows(got) == sorted(((*k, *v) for k, v in visitors.items()), key=repr)


@pytest.mark.parametrize("hot_keys", [1, 2, 10_000])
def test_hot_keys_are_joined_without_a_shuffle(spark, hot_keys):
    """One media has most rows; whatever the number of hot keys, no row is lost or doubled."""
    media = F.when(F.col("id") % 10 < 8, "m1").otherwise(F.concat(F.lit("m"), F.col("id") % 100))
    fact = spark.range(4000).select(media.alias("media_id"), F.col("id").alias("visitor_id"))
    days = spark.createDataFrame([("m1", D1), ("m8", D2)], "media_id string, media_created_date date")
    got = joins.hot_key_left_join(fact, days, "media_id", hot_keys)
    counts = got.groupBy("media_created_date").count()
    assert rows(counts) == [("2025-09-19", 3200), ("2025-09-20", 40), (None, 760)]
    assert got.select("visitor_id").distinct().count() == 4000
    assert "LeftAnti" in plan(got) and "LeftSemi" in plan(got)


def test_rows_without_media_pass_by(spark, small):
    fact, dim = small
    nobody = fact.limit(1).select(
        F.lit(None).cast("string").alias("media_id"),
        *[c for c in fact.columns if c not in ("media_id", "first_seen", "last_active")],
        F.lit(None).cast("timestamp").alias("first_seen"),
        F.lit(None).cast("timestamp").alias("last_active"),
    )
    both = fact.unionByName(nobody)
    for bound in (joins.BROADCAST_BYTES, 0):
        got = event_date.resolve_event_date(both, dim, broadcast_bytes=bound)
        assert got.count() == 5 and got.where("media_id is null and event_date is null").count() == 1


def test_measured_bytes(spark):
    df = spark.createDataFrame([("abc", D1), (None, None)], "media_id string, d date")
    assert joins.measured_bytes(df) == 2 * (joins.ROW_OVERHEAD + 8) + 3
    assert joins.measured_bytes(df.limit(0)) == 0


def test_media_daily_sums_before_it_joins(small):
    fact, dim = small
    physical = plan(gold.media_daily(fact, dim)).split("Physical Plan")[1]
    join = physical.index("Join")
    assert "HashAggregate" in physical[join:] and "partial_sum" in physical[join:]
    assert "CartesianProduct" not in physical and "NestedLoop" not in physical
