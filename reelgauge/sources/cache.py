"""Gold frames kept between reports, with a lifetime."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import read_gold, table_path

# Seconds a kept frame is served without a look at its files.
MAX_AGE = 300.0


def listing(spark: SparkSession, path: str) -> Row | None:
    """What tells one state of a table's files from another; None where there are none."""
    try:
        files = spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return files.agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"),
        F.max("modificationTime").alias("newest"),
        F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("digest"),
    ).first()


@dataclass
class Kept:
    df: DataFrame
    seen: Row | None
    checked: float


class GoldCache:
    """Keeps gold tables for as long as they do not change.

        with GoldCache(spark) as cache:
            media = cache.get(gold_base, "agg_media_daily")

    A frame is served as it is for ``max_age`` seconds. After that the table's files are listed: if
    they are the same the frame stays, otherwise it is let go and the table read again. Leaving the
    ``with`` block, or ``close``, lets all go. One cache may serve several threads.
    """

    def __init__(
        self, spark: SparkSession, max_age: float = MAX_AGE,
        clock: Callable[[], float] = time.monotonic,
    ):
        self.spark, self.max_age, self.clock = spark, max_age, clock
        self._kept: dict[str, Kept] = {}
        self._lock = threading.Lock()

    def __enter__(self) -> GoldCache:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def get(self, base: str, table: str, schema: T.StructType | None = None) -> DataFrame:
        """The table as ``read_gold`` reads it, kept in memory and on disk."""
        path = table_path(base, table)
        with self._lock:
            now, kept = self.clock(), self._kept.get(path)
            if kept and now - kept.checked < self.max_age:
                return kept.df
            seen = listing(self.spark, path)
            if kept and kept.seen == seen:
                kept.checked = now
                return kept.df
            if kept:
                # First: Spark would take the kept rows for those of the same path read again.
                self._drop(path)
            df = read_gold(self.spark, base, table, schema).persist(StorageLevel.MEMORY_AND_DISK)
            self._kept[path] = Kept(df, seen, now)
            return df

    def _drop(self, path: str) -> None:
        self._kept.pop(path).df.unpersist(blocking=True)

    def close(self) -> None:
        with self._lock:
            for path in list(self._kept):
                self._drop(path)
