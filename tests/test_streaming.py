import os
import threading

import pytest
from pyspark.sql import functions as F

from reelgauge.operators.quality import QualityError
from reelgauge.sources.tables import read_silver
from reelgauge.streaming import landed_days

from .conftest import land, media_row, plan, rows, visitor, write_lines

DAY, NEXT = "2025-09-19", "2025-09-20"


def follow(spark, folder):
    return landed_days.follow_bronze(spark, f"{folder}/bronze", f"{folder}/silver", f"{folder}/state")


def fact(spark, folder):
    return rows(read_silver(spark, f"{folder}/silver", "fact_media_engagement"), "visitor_id", "dt")


def test_days_are_taken_in_as_they_land(spark, folder):
    land(f"{folder}/bronze", DAY, [visitor("a")])
    assert follow(spark, folder) == [DAY]
    assert follow(spark, folder) == []
    land(f"{folder}/bronze", NEXT, [visitor("z", day=NEXT)])
    assert follow(spark, folder) == [NEXT]
    # a late page: its day is rebuilt whole, the other day is not touched
    untouched = os.listdir(f"{folder}/silver/fact_media_engagement/dt={NEXT}")
    write_lines(f"{folder}/bronze", "visitors", "visitors_m1_page2_late.ndjson", [visitor("b")], DAY)
    assert follow(spark, folder) == [DAY]
    assert fact(spark, folder) == [("a", DAY), ("b", DAY), ("z", NEXT)]
    assert os.listdir(f"{folder}/silver/fact_media_engagement/dt={NEXT}") == untouched


def test_new_files_of_all_datasets_are_listed_together(spark, folder, monkeypatch):
    land(f"{folder}/bronze", DAY, [visitor("a")])
    one, all_three = landed_days.note_landed_files, threading.Barrier(3, timeout=60)

    def note(*args):
        all_three.wait()
        one(*args)

    monkeypatch.setattr(landed_days, "note_landed_files", note)
    assert follow(spark, folder) == [DAY] and follow(spark, folder) == []
    assert fact(spark, folder) == [("a", DAY)]


def test_a_failed_run_is_made_up_for(spark, folder):
    land(f"{folder}/bronze", DAY, [visitor("a", media="")])
    write_lines(f"{folder}/bronze", "visitors", "odd.ndjson", [visitor("b", media="")], DAY)
    with pytest.raises(QualityError):
        follow(spark, folder)
    write_lines(f"{folder}/bronze", "visitors", "odd.ndjson", [visitor("b")], DAY)
    assert follow(spark, folder) == [DAY]
    assert fact(spark, folder) == [("a", DAY), ("b", DAY)]


def test_only_names_are_read(spark, folder):
    land(f"{folder}/bronze", DAY, [visitor("a")])
    landed_days.note_landed_files(spark, f"{folder}/bronze", "visitors", f"{folder}/state")
    ledger = spark.read.parquet(f"{folder}/state/landed/visitors")
    assert ledger.columns == ["dataset", "path", "dt", "run"]
    assert rows(ledger, "dataset", "dt") == [("visitors", DAY)]


def test_a_day_without_metadata_holds_up_no_other(spark, folder):
    land(f"{folder}/bronze", DAY, [visitor("a")])
    assert follow(spark, folder) == [DAY]
    write_lines(f"{folder}/bronze", "visitors", f"visitors_m1_page1_{NEXT}.ndjson",
                [visitor("z", day=NEXT)], NEXT)
    write_lines(f"{folder}/bronze", "visitors", "visitors_m1_page1_nowhere.ndjson", [visitor("y")])
    assert follow(spark, folder) == [NEXT]
    assert fact(spark, folder) == [("a", DAY), ("z", NEXT)]
    found = landed_days.waiting(spark, f"{folder}/state").selectExpr(
        "cast(dt as string) as dt", "concat_ws(',', datasets) as datasets", "files"
    )
    assert set(rows(found)) == {(None, "visitors", 1), (NEXT, "visitors", 1)}
    land(f"{folder}/bronze", NEXT, [visitor("z", day=NEXT)])
    assert follow(spark, folder) == [NEXT]
    assert rows(read_silver(spark, f"{folder}/silver", "dim_media"), "dt") == [(DAY,), (NEXT,)]
    assert rows(landed_days.waiting(spark, f"{folder}/state"), "dt") == [(None,)]


BROKEN = "{broken"


def refused(spark, folder):
    found = landed_days.refused(spark, f"{folder}/state")
    return rows(found.selectExpr("dataset", "cast(dt as string) as dt", "reason"))


def test_a_useless_day_neither_stops_another_nor_passes_unseen(spark, folder):
    """The metadata of one day is corrupt throughout, that of the other is sound."""
    bronze = f"{folder}/bronze"
    land(bronze, DAY, [visitor("a")])
    write_lines(bronze, "metadata", f"metadata_m1_{NEXT}.ndjson", [BROKEN], NEXT)
    write_lines(bronze, "visitors", f"visitors_m1_page1_{NEXT}.ndjson", [visitor("z", day=NEXT)], NEXT)
    assert follow(spark, folder) == [DAY]
    assert fact(spark, folder) == [("a", DAY)]
    assert [r[:2] for r in refused(spark, folder)] == [("metadata", NEXT), ("visitors", NEXT)]
    assert all("dim_media would be empty" in r[2] for r in refused(spark, folder))
    # tried again by the next run, which has nothing else and says so
    with pytest.raises(QualityError, match=f"{NEXT}: dim_media"):
        follow(spark, folder)
    write_lines(bronze, "metadata", f"metadata_m2_{NEXT}.ndjson", [media_row("m2")], NEXT)
    assert follow(spark, folder) == [NEXT]
    assert fact(spark, folder) == [("a", DAY), ("z", NEXT)]
    assert refused(spark, folder) == [] and follow(spark, folder) == []


def test_done_days_are_not_read(spark, folder):
    for day in (DAY, NEXT):
        land(f"{folder}/bronze", day, [visitor("a", day=day)])
        assert follow(spark, folder) == [day]
    state, last = f"{folder}/state", "2025-09-21"
    land(f"{folder}/bronze", last, [visitor("a", day=last)])
    run = landed_days.last_run(spark, state) + 1
    for dataset in landed_days.DATASETS:
        landed_days.note_landed_files(spark, f"{folder}/bronze", dataset, state, run)
    pending = landed_days.pending_files(spark, state)
    assert rows(pending.select("dt").distinct()) == [(last,)]
    opened = [f for f in pending.inputFiles() if "/landed/" in f]
    scanned = [line for line in plan(pending).splitlines() if "PartitionFilters" in line]
    assert opened and sum(f"(run#" in line and f"> {run - 1})" in line for line in scanned) >= 3
    # of the ledger, only the folders of the pending days
    expected = landed_days.datasets_of_days(spark, state, pending)
    assert expected == {last: {"medias", "metadata", "visitors"}}
    of_days = landed_days.ledger(spark, state).where(F.col("dt").isin(F.lit(last).cast("date")))
    assert "PartitionFilters: [isnotnull(dt" in plan(of_days)
    done = spark.read.parquet(f"{state}/ledger")
    assert rows(done.groupBy("dt").count()) == [(DAY, 3), (NEXT, 3)]


def test_a_run_that_died_after_the_ledger_is_repeated(spark, folder, monkeypatch):
    land(f"{folder}/bronze", DAY, [visitor("a")])
    monkeypatch.setattr(landed_days, "write_version", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        follow(spark, folder)
    monkeypatch.undo()
    assert follow(spark, folder) == [DAY] and follow(spark, folder) == []
    assert rows(landed_days.waiting(spark, f"{folder}/state")) == []
    found = landed_days.ledger(spark, f"{folder}/state")
    assert found.count() == 6 and found.distinct().count() == 3


def test_the_ledger_is_gathered(spark, folder, monkeypatch):
    monkeypatch.setattr(landed_days, "COMPACT_EVERY", 3)
    for page in range(1, 4):
        land(f"{folder}/bronze", DAY, [visitor(f"v{page}")], page=page)
        follow(spark, folder)
    files = os.listdir(f"{folder}/state/ledger/dt={DAY}")
    assert sum(f.endswith(".parquet") for f in files) == 1
    assert landed_days.ledger(spark, f"{folder}/state").count() == 5
    assert fact(spark, folder) == [("v1", DAY), ("v2", DAY), ("v3", DAY)]
