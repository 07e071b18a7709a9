import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from reelgauge.operators import quality, silver
from reelgauge.schemas import BRONZE
from reelgauge.sources import bronze

from .conftest import STATS, media_row, plan, rows, visitor, write_lines

DAY, NEXT = "2025-09-19", "2025-09-20"


def good_rows(spark, base, dataset="visitors", **options):
    return bronze.split_corrupt(bronze.read_bronze(spark, base, dataset, **options))[0]


def test_each_file_is_read_once(spark, folder):
    write_lines(folder, "visitors", "visitors_m1_page1_a.ndjson", [visitor("a"), visitor("b")], DAY)
    write_lines(folder, "visitors", "visitors_m1_page1_b.ndjson", [visitor("c")], NEXT)
    got = good_rows(spark, folder)
    assert rows(got, "visitor_key", "dt") == [("a", DAY), ("b", DAY), ("c", NEXT)]


def test_days_prune_partitions(spark, folder):
    write_lines(folder, "visitors", "visitors_m1_page1_a.ndjson", [visitor("a")], DAY)
    write_lines(folder, "visitors", "visitors_m1_page1_b.ndjson", [visitor("b")], NEXT)
    got = bronze.read_bronze(spark, folder, "visitors", days=[NEXT]).select("visitor_key")
    assert rows(got) == [("b",)]
    partition_filters = plan(got).split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "dt" in partition_filters and NEXT in partition_filters


def test_only_used_columns_are_parsed(spark, folder):
    write_lines(folder, "visitors", "visitors_m1_page1_a.ndjson", [visitor("a")], DAY)
    got = bronze.read_bronze(spark, folder, "visitors").select("visitor_key")
    assert plan(got).split("ReadSchema: ")[1].startswith("struct<visitor_key:string>")


def test_flat_and_mixed_layout(spark, folder):
    write_lines(folder, "visitors", "visitors_m1_page1_flat.ndjson", [visitor("a")])
    write_lines(folder, "visitors", "visitors_m1_page1_day.ndjson", [visitor("b")], DAY)
    got = bronze.read_bronze(spark, folder, "visitors", partitioned=False)
    assert rows(silver.ensure_dt(got), "visitor_key", "dt") == [("a", None), ("b", DAY)]
    one = bronze.read_bronze(spark, folder, "visitors", partitioned=False, days=[DAY])
    assert rows(one, "visitor_key") == [("b",)]


def test_missing_nested_field_is_null(spark, folder):
    bare = {k: v for k, v in visitor("a").items() if k != "visitor_identity"}
    write_lines(folder, "visitors", "visitors_m1_page1_a.ndjson", [bare], DAY)
    got = silver.dim_visitor(good_rows(spark, folder))
    assert rows(got, "visitor_id", "email", "org_title") == [("a", None, None)]


def test_badly_typed_cell_costs_only_the_cell(spark, folder):
    odd = visitor("a", loads="12", plays="many")
    mixed = visitor("b", loads=3.0, plays=2)
    write_lines(folder, "visitors", "visitors_m1_page1_a.ndjson", [odd, mixed], DAY)
    got = silver.fact_media_engagement(good_rows(spark, folder))
    assert rows(got, "visitor_id", "load_count", "play_count") == [("a", 12, None), ("b", 3, 2)]


def test_corrupt_lines_are_set_apart(spark, folder):
    lines = [visitor("a"), "{broken", visitor("b")]
    write_lines(folder, "visitors", "visitors_m1_page1_a.ndjson", lines, DAY)
    raw = bronze.read_bronze(spark, folder, "visitors")
    good, bad = bronze.split_corrupt(raw)
    assert rows(good, "visitor_key") == [("a",), ("b",)]
    assert rows(bad, "_corrupt_record", "dt") == [("{broken", DAY)]
    assert (good.count(), bad.count()) == (2, 1)
    health = quality.bronze_health(raw, "visitors").first()
    assert health.asDict() == {
        "dataset": "visitors", "rows": 3, "corrupt_rows": 1, "keyed_rows": 2, "missing_media_id": 0,
    }
    assert rows(silver.dim_visitor(good), "visitor_id") == [("a",), ("b",)]


def test_staged_rows_and_their_counts(spark, folder):
    lines = [visitor("a"), "{broken"]
    write_lines(folder, "visitors", "visitors_m1_page1_a.ndjson", lines, DAY)
    raw = bronze.read_bronze(spark, folder, "visitors")
    staged, counts = bronze.stage_bronze(raw, f"{folder}/staged", quality.health_measures("visitors"))
    assert counts == {"rows": 2, "corrupt_rows": 1, "keyed_rows": 1, "missing_media_id": 0}
    good, bad = bronze.split_corrupt(staged)
    assert (good.count(), bad.count()) == (1, 1)
    assert rows(good, "visitor_key", "dt") == [("a", DAY)]


def test_multi_line_json(spark, folder):
    path = os.path.join(folder, "metadata", f"dt={DAY}")
    os.makedirs(path)
    with open(os.path.join(path, "metadata_m1_1.json"), "w") as out:
        json.dump([media_row("m1"), media_row("m2")], out, indent=2)
    with open(os.path.join(path, "metadata_m3_1.json"), "w") as out:
        json.dump(media_row("m3"), out, indent=2)
    got = good_rows(spark, folder, "metadata", fmt="json")
    assert rows(got, "hashed_id") == [("m1",), ("m2",), ("m3",)]


def test_unknown_format_and_missing_folder(spark, folder):
    with pytest.raises(ValueError):
        bronze.read_bronze(spark, folder, "visitors", fmt="xml")
    with pytest.raises(AnalysisException):
        bronze.read_bronze(spark, folder, "visitors")


def test_media_id_from_row_or_file(spark, folder):
    lines = [visitor("a", media="m7"), visitor("b", media=None), visitor("c", media="")]
    write_lines(folder, "visitors", "visitors_ABC_page1_x.ndjson", lines, DAY)
    got = silver.fact_media_engagement(good_rows(spark, folder))
    assert rows(got, "visitor_id", "media_id") == [("a", "m7"), ("b", "ABC"), ("c", "ABC")]


def test_health_counts_rows_without_ids(spark, folder):
    write_lines(folder, "visitors", "visitors_ABC_page1_x.ndjson",
                [visitor("a", media=None), visitor("")], DAY)
    write_lines(folder, "visitors", "something.ndjson", [visitor("b", media="")], DAY)
    health = quality.bronze_health(bronze.read_bronze(spark, folder, "visitors"), "visitors").first()
    assert (health["rows"], health["keyed_rows"], health["missing_media_id"]) == (3, 2, 1)


def test_medias_id_comes_from_the_file(spark, folder):
    write_lines(folder, "medias", "medias_M5_x.ndjson", [STATS], DAY)
    got = silver.fact_media_daily_raw(good_rows(spark, folder, "medias"))
    assert rows(got) == [("M5", 4, 2, 0.5, 1.5, 0.25, 3, DAY)]


def test_landing_replaces_only_its_days(spark, folder):
    def frame(*keyed):
        data = [(k, "m1", d) for k, d in keyed]
        df = spark.createDataFrame(data, "visitor_key string, media_id string, day string")
        return df.select("visitor_key", "media_id", F.col("day").cast("date").alias("dt"))

    def landed():
        return rows(good_rows(spark, folder), "visitor_key", "dt")

    bronze.land_bronze(frame(("a", DAY), ("b", NEXT)), folder, "visitors")
    bronze.land_bronze(frame(("c", NEXT)), folder, "visitors")
    assert landed() == [("a", DAY), ("c", NEXT)]
    bronze.land_bronze(frame(("d", NEXT)), folder, "visitors", overwrite=False, spread=False)
    assert landed() == [("a", DAY), ("c", NEXT), ("d", NEXT)]
    bronze.land_day(frame(("e", NEXT)), folder, "visitors", NEXT)
    assert landed() == [("a", DAY), ("e", NEXT)]
    bronze.land_day(frame().limit(0), folder, "visitors", NEXT)
    assert landed() == [("a", DAY)]


def test_tag_rows(spark):
    page = spark.createDataFrame([("a",)], "visitor_key string")
    got = bronze.tag_rows(page, "m1", DAY)
    assert rows(got, "visitor_key", "media_id", "event_date", "dt") == [("a", "m1", DAY, DAY)]


def test_schema_report(spark, folder):
    row = visitor("a", loads="7") | {"extra": 1}
    del row["last_event_key"]
    write_lines(folder, "visitors", "visitors_m1_page1_a.ndjson", [row], DAY)
    found = {"visitors": quality.infer_bronze(spark, folder, "visitors", day=DAY)}
    got = quality.schema_report(spark, found, ["visitors"])
    by_field = {r["field"]: (r["expected"], r["found"]) for r in got.collect()}
    assert by_field["load_count"] == ("bigint", "string")
    assert by_field["play_count"] == ("bigint", "bigint")
    assert by_field["extra"] == (None, "bigint")
    assert by_field["last_event_key"] == ("string", None)
    assert by_field["visitor_identity.org.title"] == ("string", "string")
    assert len(by_field) == 16
    assert set(BRONZE["visitors"].names) <= {f.split(".")[0] for f in by_field}
