"""Odd rows every operator must take: nulls, empty, blank, very long, repeated, clashing columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
PASSAGE = " ".join(f"passage{i}" for i in range(60))

ROWS = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta", "a"),
    (2, "alpha BETA gamma delta epsilon zeta eta theta", "a"),
    (3, None, "a"), (4, "", None), (5, " \t\n ", "b"), (6, "one two", None),
    (7, "one two", "c"), (8, LONG, "c"), (8, LONG, "c"), (9, f"start {PASSAGE} end", "d"),
    (10, f"another start {PASSAGE}\nother end", "d"), (None, f"no id {PASSAGE}", None),
    (None, None, None), (11, "ünïcode ▁ 中文😀 \x00 <s> ##", "e"), (12, "x" * 5000, "e"),
]


def odd_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ROWS, "doc_id long, text string, source string")


def no_documents(spark: SparkSession) -> DataFrame:
    return odd_documents(spark).where("false")
