import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from reelgauge.operators.counters import counted, running_increments
from reelgauge.operators.event_date import media_days
from reelgauge.operators.gold import media_daily, visitor_daily
from reelgauge.operators.joins import with_title
from reelgauge.plans import latest_media
from reelgauge.plans.gold_job import MEDIA, VISITOR, GoldRefresh, run_gold
from reelgauge.plans.silver_job import run_silver
from reelgauge.plans.views import gold_views
from reelgauge.schemas import GOLD, SILVER
from reelgauge.sources import versions
from reelgauge.sources.tables import read_gold, read_silver, write_partitioned

from .conftest import land, plan, rows, visitor
from .test_gold import at, dim_of, fact_of

DAYS = [date(2025, 9, 1) + timedelta(days=i) for i in range(8)]


def totals(spark, *values, media="m1", who="a"):
    """Load totals day by day; ``...`` is a day without a row."""
    data = [(media, who, n, None, day, None, day) for n, day in zip(values, DAYS) if n is not ...]
    random.Random(1).shuffle(data)
    return fact_of(spark, data)


@pytest.mark.parametrize("falls, values, wanted", [
    ("reset", [3, 5, 5, 9], [3, 2, 0, 4]),
    ("reset", [3, ..., ..., 9], [3, 6]),
    ("reset", [7, 2, 4], [7, 2, 2]),
    ("correction", [7, 2, 4], [7, -5, 2]),
    ("reset", [3, None, 5], [3, None, 2]),
    ("reset", [None, 5, 0, 0], [None, 5, 0, 0]),
])
def test_increments(spark, falls, values, wanted):
    got = running_increments(totals(spark, *values), falls)
    assert [r["load_count"] for r in got.orderBy("dt").collect()] == wanted


def test_increments_are_per_media_and_visitor(spark):
    fact = totals(spark, 1, 4).unionByName(totals(spark, 10, 20, who="b")).unionByName(
        totals(spark, 5, 6, media="m2")
    )
    got = running_increments(fact).groupBy("media_id").agg(F.sum("load_count").alias("n"))
    assert rows(got) == [("m1", 24), ("m2", 6)]
    assert plan(running_increments(fact)).count("Exchange hashpartitioning") == 1


def test_idle_rows_and_meanings(spark):
    fact = totals(spark, 3, 3, None, 5)
    assert running_increments(fact, idle=False).count() == 2
    assert counted(fact).count() == 4 and counted(fact, "latest").count() == 1
    for wrong in ("sum", ""):
        with pytest.raises(ValueError):
            counted(fact, wrong)
        with pytest.raises(ValueError):
            running_increments(fact, wrong)


def test_daily_truth(spark):
    """Three snapshots of one visitor: 4 loads on the first day, none, then 6 more."""
    fact = fact_of(spark, [("m1", "a", n, n, d, d, d) for n, d in zip([4, 4, 10], DAYS)])
    dim = dim_of(spark, [("m1", DAYS[0], DAYS[0])])
    got = media_daily(fact, dim, counters="increments")
    assert rows(got, "event_date", "total_loads") == [("2025-09-01", 4), ("2025-09-03", 6)]
    seen = visitor_daily(fact, dim, counters="increments")
    assert rows(seen, "event_date", "media_interactions", "total_loads") == [
        ("2025-09-01", 1, 4), ("2025-09-03", 1, 6),
    ]


# --- the stored latest dimension --------------------------------------------------------------


def store(spark, base, data, mode="overwrite"):
    dim = dim_of(spark, data)
    kinds = {f.name: f.dataType for f in SILVER["dim_media"]}
    whole = dim.select(*[
        F.col(c).cast(kinds[c]) if c in dim.columns else F.lit(None).cast(kinds[c]).alias(c)
        for c in kinds
    ])
    write_partitioned(whole, base, "dim_media", mode)


def latest(spark, base):
    return rows(latest_media.read_latest_media(spark, base), "media_id", "created_at", "latest_dt")


def ranked(spark, base):
    whole = latest_media._ranked(read_silver(spark, base, "dim_media"))
    return rows(whole, "media_id", "created_at", "latest_dt")


def test_latest_media_follows_rebuilt_days(spark, folder):
    d = DAYS
    store(spark, folder, [
        ("m1", d[0], d[0]), ("m1", d[1], d[1]), ("m1", d[2], d[2]), ("m2", d[0], d[1]),
        ("m3", d[0], d[2]), ("m4", d[3], d[1]), ("m4", d[4], d[2]), (None, d[0], d[0]),
        ("m5", d[0], d[0]), ("m5", d[1], d[1]), ("m5", d[2], d[3]),
    ])
    latest_media.update_latest_media(spark, folder, None)
    assert latest(spark, folder) == ranked(spark, folder)
    # d0 and d2 rebuilt: m1 and m4 gone from d2, m3 stays, m2 appears late, m6 is new, m2's old row
    # of d0 comes too late to matter
    store(spark, folder, [
        ("m3", d[5], d[2]), ("m2", d[6], d[2]), ("m6", d[1], d[2]), ("m2", d[7], d[0]),
        ("m1", d[7], d[0]),
    ])
    latest_media.update_latest_media(spark, folder, [str(d[0]), str(d[2])])
    assert latest(spark, folder) == ranked(spark, folder)
    # m5 leaves d3 but is in the rebuilt d0: its row of d1, not rebuilt, is the latest now
    store(spark, folder, [("m6", d[1], d[3]), ("m5", d[7], d[0])])
    latest_media.update_latest_media(spark, folder, [str(d[0]), str(d[3])])
    assert latest(spark, folder) == ranked(spark, folder)
    assert len(versions.complete_versions(spark, f"{folder}/dim_media_latest")) == 2


def test_random_rebuilds(spark, folder):
    rng = random.Random(9)

    def of(days):
        return [(f"m{rng.randrange(6)}", rng.choice(DAYS), d) for d in days for _ in range(3)]

    store(spark, folder, of(DAYS))
    latest_media.update_latest_media(spark, folder, None)
    for _ in range(4):
        days = rng.sample(DAYS, 3)
        store(spark, folder, of(days))
        latest_media.update_latest_media(spark, folder, [str(d) for d in days])
        got = latest_media.read_latest_media(spark, folder).select("media_id", "latest_dt")
        want = latest_media._ranked(read_silver(spark, folder, "dim_media"))
        assert rows(got) == rows(want, "media_id", "latest_dt")


def test_stale_table_is_not_read(spark, folder):
    store(spark, folder, [("m1", DAYS[0], DAYS[0])])
    assert latest(spark, folder) == ranked(spark, folder)  # nothing stored yet
    latest_media.update_latest_media(spark, folder, None)
    latest_media.invalidate_latest_media(spark, folder)
    store(spark, folder, [("m1", DAYS[1], DAYS[1])])  # and the run dies here
    assert latest(spark, folder) == ranked(spark, folder)
    assert not latest_media.latest_media_holds(spark, folder)
    # the next run, for another day, does not trust what was stored
    latest_media.update_latest_media(spark, folder, [str(DAYS[2])], trusted=False)
    assert latest(spark, folder) == ranked(spark, folder) == [("m1", str(at(DAYS[1])), str(DAYS[1]))]


def test_consumers_of_the_stored_table_rank_nothing(spark, folder):
    bronze, silver, out = f"{folder}/bronze", f"{folder}/silver", f"{folder}/gold"
    land(bronze, str(DAYS[0]), [visitor("a", day=str(DAYS[0]))])
    run_silver(spark, bronze, silver)
    run_gold(spark, silver, out)
    media = latest_media.read_latest_media(spark, silver)
    fact = read_silver(spark, silver, "fact_media_engagement")
    gold_views(spark, out, silver)
    for df in (media_days(media), with_title(fact, media), media_daily(fact, media),
               spark.sql("select media_title from agg_media_daily_p")):
        assert "Window" not in plan(df) and "dim_media/" not in plan(df)
        assert df.count() == 1


# --- refresh of running totals ----------------------------------------------------------------


def gold_of(spark, base):
    return [
        rows(read_gold(spark, base, t, GOLD[t]).drop("year", "month", "day")) for t in (MEDIA, VISITOR)
    ]


@pytest.mark.parametrize("counters", ["latest", "increments"])
def test_refresh_of_running_totals(spark, folder, counters):
    """Rows that stop, or start again, being the latest; increments of the row after a new one."""
    bronze, silver, out = f"{folder}/bronze", f"{folder}/silver", f"{folder}/gold"
    d = [str(day) for day in DAYS]

    def page(day, *who):
        land(bronze, d[day], [
            visitor(name, day=d[day], loads=n, plays=n, event=f"e{day}",
                    **({"created_at": None, "last_active_at": None} if name == "u" else {}))
            for name, n in who
        ])

    page(0, ("a", 1), ("b", 5), ("c", 2), ("u", 1))
    page(2, ("a", 4), ("b", 6), ("u", 3))
    page(4, ("a", 9), ("c", 3))
    run_silver(spark, bronze, silver)
    run_gold(spark, silver, out, counters=counters)
    for day, who in (
        (3, [("a", 6), ("b", 8), ("new", 2)]),   # between and after the others
        (4, [("c", 3), ("u", 8)]),               # a leaves its latest day, u comes back
        (2, [("b", 7), ("u", 3)]),               # a total is set right in between
    ):
        job = GoldRefresh(spark, silver, out, [d[day]], f"{folder}/snap{day}", counters=counters)
        page(day, *who)
        run_silver(spark, bronze, silver, [d[day]])
        job.apply()
        run_gold(spark, silver, f"{out}-full", counters=counters)
        assert gold_of(spark, out) == gold_of(spark, f"{out}-full")
