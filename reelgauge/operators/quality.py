"""Checks and counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.paths import VISITORS_FILE
from ..schemas import BRONZE, CORRUPT, DATASETS
from .silver import filled, media_id_or_name


class QualityError(RuntimeError):
    """The input is not fit to be written further."""


def health_measures(dataset: str) -> dict[str, Column]:
    """Counts that say whether a bronze frame is fit for silver: rows, corrupt lines, rows with
    their key, and visitor rows whose media id is neither in them nor in the file name.
    """
    parsed = F.col(CORRUPT).isNull()
    no_media = F.lit(False)
    if dataset == "visitors":
        no_media = media_id_or_name(VISITORS_FILE).isNull()
    return {
        "rows": F.count(F.lit(1)),
        "corrupt_rows": F.count_if(~parsed),
        "keyed_rows": F.count_if(parsed & filled(BRONZE[dataset].names[0]).isNotNull()),
        "missing_media_id": F.count_if(parsed & no_media),
    }


def bronze_health(raw: DataFrame, dataset: str) -> DataFrame:
    """``health_measures`` of a bronze frame as one row, in one scan."""
    measures = [column.alias(name) for name, column in health_measures(dataset).items()]
    return raw.agg(*measures).select(F.lit(dataset).alias("dataset"), "*")


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """(name, rows) of several frames, in one job."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows")
        for name, df in frames.items()
    ]
    out = counted[0]
    for frame in counted[1:]:
        out = out.unionByName(frame)
    return out


def sample_rows(df: DataFrame, n: int = 5, ordered: bool = False) -> DataFrame:
    """Some rows to look at: whichever come first, or the first in the order of all columns."""
    return df.orderBy(*df.columns).limit(n) if ordered else df.limit(n)


def _fields(data_type: T.DataType, prefix: str = "") -> dict[str, str]:
    """Leaf fields of a schema, dotted, with their types."""
    out: dict[str, str] = {}
    for field in data_type:
        name = f"{prefix}{field.name}"
        if isinstance(field.dataType, T.StructType):
            out |= _fields(field.dataType, f"{name}.")
        else:
            out[name] = field.dataType.simpleString()
    return out


def schema_report(
    spark: SparkSession, found: dict[str, T.StructType], datasets: Sequence[str] = DATASETS
) -> DataFrame:
    """(dataset, field, expected, found) for each field declared or met; null where it is not.

    ``found`` are the schemas inferred from the files: they say what the feed really sends.
    """
    rows = []
    for name in datasets:
        expected, met = _fields(BRONZE[name]), _fields(found[name])
        for field in sorted(expected.keys() | met.keys()):
            rows.append((name, field, expected.get(field), met.get(field)))
    return spark.createDataFrame(
        rows, "dataset string, field string, expected string, found string"
    )


def infer_bronze(
    spark: SparkSession, base: str, dataset: str, fmt: str = "ndjson", day: str | None = None
) -> T.StructType:
    """The schema Spark infers from the files of a dataset, all days or one."""
    path = f"{base.rstrip('/')}/{dataset}" + (f"/dt={day}" if day else "")
    reader = spark.read.option("multiLine", fmt == "json").option("recursiveFileLookup", True)
    return reader.json(path).schema
