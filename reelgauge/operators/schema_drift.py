"""What types the feeds send, day by day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.paths import dt_from_path
from ..schemas import BRONZE, DATASETS

# How a declared type is spelled where a value's own type is asked for.
SPELLED = {"string": "STRING", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}


def fields_by_day(spark: SparkSession, base: str, dataset: str) -> DataFrame:
    """``dataset``, ``dt``, ``field``, ``found`` and ``rows``: per day and top-level field the type
    that holds its values, nested ones spelled out, and in how many rows it is.

    Each line is parsed as a variant, whose values carry their own types; the types of a day are
    merged in each task before the shuffle. ``VARIANT`` stands for values that no type holds
    together, such as numbers beside text. Lines that are no JSON object are the field null.
    """
    path = f"{base.rstrip('/')}/{dataset}"
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(
        dt_from_path(F.col("_metadata.file_path")).alias("dt"),
        F.try_parse_json("value").alias("line"),
    )
    fields = lines.lateralJoin(
        spark.tvf.variant_explode_outer(F.col("line").outer())
    ).select("dt", F.col("key").alias("field"), "value")
    return fields.groupBy(F.lit(dataset).alias("dataset"), "dt", "field").agg(
        F.schema_of_variant_agg("value").alias("found"), F.count(F.lit(1)).alias("rows")
    )


def schema_drift(
    spark: SparkSession, base: str, datasets: Sequence[str] = DATASETS
) -> DataFrame:
    """``dataset``, ``field``, ``expected``, ``found``, ``since``, ``until``, ``days``, ``rows``: the
    runs of days over which a field kept one type, so that drift shows when it began.

    ``expected`` is the declared type of a plain field, null for nested and undeclared ones. Days on
    which no row has the field neither end nor lengthen a run. A window row per field and day.
    """
    found = None
    for dataset in datasets:
        days = fields_by_day(spark, base, dataset)
        found = days if found is None else found.unionByName(days)
    declared = [
        (dataset, f.name, SPELLED.get(f.dataType.simpleString()))
        for dataset in datasets for f in BRONZE[dataset]
    ]
    expected = spark.createDataFrame(declared, "dataset string, field string, expected string")
    of_field = Window.partitionBy("dataset", "field").orderBy("dt")
    changed = ~F.col("found").eqNullSafe(F.lag("found").over(of_field))
    runs = found.withColumn("changed", changed.cast("int")).withColumn(
        "run", F.sum("changed").over(of_field)
    )
    return (
        runs.groupBy("dataset", "field", "found", "run").agg(
            F.min("dt").alias("since"), F.max("dt").alias("until"),
            F.count(F.lit(1)).alias("days"), F.sum("rows").alias("rows"),
        )
        .join(F.broadcast(expected), ["dataset", "field"], "left")
        .select("dataset", "field", "expected", "found", "since", "until", "days", "rows")
    )
