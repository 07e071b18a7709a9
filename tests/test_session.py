import os
import subprocess
import sys
import threading
import time

import pytest

from reelgauge.session import build_session, together


def test_build_session_pins_zone_and_adaptive_execution(spark):
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    try:
        session = build_session("tests", shuffle_partitions=8)
        assert session.conf.get("spark.sql.session.timeZone") == "UTC"
        assert session.conf.get("spark.sql.adaptive.enabled") == "true"
        assert session.conf.get("spark.sql.shuffle.partitions") == "8"
        assert session.conf.get(advisory) == "256m"
    finally:
        spark.conf.unset(advisory)


def test_steps_run_at_the_same_time(spark):
    both = threading.Barrier(2, timeout=60)

    def step(n):
        both.wait()
        return spark.range(n).count()

    assert together(lambda: step(3), lambda: step(5)) == [3, 5]
    ended = []

    def fails():
        both.wait()
        raise ValueError("first")

    with pytest.raises(ValueError, match="first"):
        together(fails, lambda: ended.append(step(2)))
    assert ended == [2] and together() == []


def test_scratch_is_gone_with_the_application(tmp_path):
    code = (
        "from pyspark.sql import SparkSession\n"
        "from reelgauge.sources.tables import staged\n"
        "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false')"
        f".config('spark.checkpoint.dir', '{tmp_path}').getOrCreate()\n"
        "df = staged(s.range(3), 'x')\n"
        "print('rows', df.count(), df.inputFiles()[0])\n"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    assert f"rows 3 file://{tmp_path}/reelgauge-local-" in done.stdout, done.stderr[-2000:]
    for _ in range(100):  # the JVM ends a little after Python
        left = [name for name in os.listdir(tmp_path) if name.startswith("reelgauge-")]
        if not left:
            break
        time.sleep(0.2)
    assert not left
