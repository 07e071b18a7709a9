"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Every stamp is read, cut into days and written in this zone.
TIME_ZONE = "UTC"


def build_session(app_name: str, shuffle_partitions: int | None = None) -> SparkSession:
    """Session for the jobs.

    Master, memory and executors come from spark-submit. ``shuffle_partitions`` is only the
    starting width: adaptive execution merges what is too small, so on large inputs set it high
    (input bytes / 200 MB) rather than low.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", TIME_ZONE)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256m")
        .config("spark.sql.parquet.compression.codec", "snappy")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return use_utc(builder.getOrCreate())


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone; days would shift otherwise."""
    spark.conf.set("spark.sql.session.timeZone", TIME_ZONE)
    return spark


def together(*steps: Callable) -> list:
    """The results of independent steps whose Spark jobs run at the same time.

    A job that has few tasks, or waits for its commit of many folders, leaves the cluster to the
    others. All steps end before the error of the first that failed is raised.
    """
    with ThreadPoolExecutor(max(1, len(steps))) as pool:
        running = [pool.submit(inheritable_thread_target(step)) for step in steps]
    return [step.result() for step in running]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name for intermediate tables, below the cluster's ``spark.checkpoint.dir``.

    A session without that setting uses its warehouse, which all executors share as well. The names
    lie in one folder per application, which is deleted when the application ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    own = f"{base.rstrip('/')}/reelgauge-{spark.sparkContext.applicationId}"
    folder = jvm.org.apache.hadoop.fs.Path(own)
    system = folder.getFileSystem(conf)
    if not system.exists(folder):
        system.mkdirs(folder)
        system.deleteOnExit(folder)
    return f"{system.makeQualified(folder).toString()}/{name}-{uuid.uuid4().hex}"
