from __future__ import annotations

import json
import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def write_lines(base: str, dataset: str, name: str, rows: list, day: str | None = None) -> str:
    """One landed file; a row that is text is written as it is."""
    path = os.path.join(base, dataset, f"dt={day}" if day else "")
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as out:
        for row in rows:
            out.write((row if isinstance(row, str) else json.dumps(row)) + "\n")
    return os.path.join(path, name)


def visitor(key, media="m1", day="2025-09-19", loads=1, plays=1, event="e1", **more) -> dict:
    row = {
        "visitor_key": key,
        "visitor_identity": {"email": f"{key}@example.com", "name": key,
                             "org": {"name": "Org", "title": "T"}},
        "user_agent_details": {"browser": "B", "platform": "P", "mobile": False},
        "created_at": f"{day}T08:00:00Z",
        "last_active_at": f"{day}T10:00:00Z",
        "load_count": loads,
        "play_count": plays,
        "last_event_key": event,
        "media_id": media,
        "event_date": day,
    }
    return row | more


def media_row(media, created="2025-09-01T00:00:00Z", **more) -> dict:
    return {
        "hashed_id": media, "name": f"Title {media}", "duration": 12.5, "created": created,
        "updated": created, "status": "ready", "tags": ["a", "b"],
        "project": {"id": "p1", "name": "Project"},
        "thumbnail": {"url": "https://img.example.com/1.jpg"},
    } | more


STATS = {"load_count": 4, "play_count": 2, "play_rate": 0.5, "hours_watched": 1.5,
         "engagement": 0.25, "visitors": 3}


def land(base: str, day: str, rows: list, media=("m1",), page: int = 1) -> None:
    """One day of all three datasets, written the way the feed names its files."""
    for name in media:
        write_lines(base, "metadata", f"metadata_{name}_{day}.ndjson", [media_row(name)], day)
        write_lines(base, "medias", f"medias_{name}_{day}.ndjson", [STATS], day)
    write_lines(base, "visitors", f"visitors_{media[0]}_page{page}_{day}.ndjson", rows, day)


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def rows(df, *columns) -> list[tuple]:
    """Rows as sorted tuples, dates as text."""
    picked = df.select(*columns) if columns else df
    return sorted(
        (tuple(str(v) if hasattr(v, "isoformat") else v for v in r) for r in picked.collect()),
        key=repr,
    )
