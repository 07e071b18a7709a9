from __future__ import annotations

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from reelgauge.llm.hard_negatives import (
    Best, Candidates, SharedList, centroids, hard_negatives, inner, score_range,
)
from reelgauge.llm.queries import LLM_ORACLE, op11_hard_negatives
from tests.conftest import TESTDATA

SCHEMA = "vec_id long, label int, embedding array<double>"
COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def plain(rows, is_anchor, k_positive=5, k_negative=5, low=80, high=100):
    """All scores, sorted."""
    kept = {}
    for vec_id, label, vector in rows:
        if vec_id is None or label is None or not vector:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        row = (label, [min(max(math.floor(256 * x), -2**63), 2**63 - 1) for x in vector])
        kept[vec_id] = min(kept.get(vec_id, row), row)
    out = []
    for a, (label, v) in kept.items():
        if not is_anchor(a):
            continue
        scored = sorted(
            (-min(max(sum(x * y for x, y in zip(v, w)), -2**63), 2**63 - 1), c, other)
            for c, (other, w) in kept.items() if c != a and len(w) == len(v)
        )
        for s, p, _ in [x for x in scored if x[2] == label][:k_positive]:
            fit = [(-t, c) for t, c, other in scored
                   if other != label and low * -s <= 100 * -t <= high * -s]
            out += [(a, p, r, c, -s, t) for r, (t, c) in enumerate(fit[:k_negative], 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.select(*COLUMNS).collect())


def random_rows(rng, n=400, size=6, centres=5):
    around = [[rng.gauss(0, 1) for _ in range(size)] for _ in range(centres)]
    rows = []
    for i in range(n):
        c = rng.randrange(centres)
        rows.append((i, rng.choice([c, rng.randrange(centres)]),
                     [x + rng.gauss(0, 0.4) for x in around[c]]))
    return rows


@pytest.mark.parametrize("block, piece", [(8192, 4096), (60, 7)])
def test_against_all_scores(spark, block, piece):
    rng = random.Random(11)
    rows = random_rows(rng) + [(1000 + i, i % 3, [1.0] * 6) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = hard_negatives(df, F.col("vec_id") % 9 == 0, F.col("label"), block_size=block, slice_size=piece)
    wanted = plain(rows, lambda i: i % 9 == 0)
    assert len(wanted) > 200 and found(got) == wanted
    few = hard_negatives(df, F.col("vec_id") % 9 == 0, F.col("label"), 2, 3, (50, 90, 100),
                         block_size=block, slice_size=piece)
    assert found(few) == plain(rows, lambda i: i % 9 == 0, 2, 3, 50, 90)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 0.0]), (9, 1, [0.9, 0.1]), (2, 2, [0.85, 0.1]), (2, 2, [0.85, 0.1]),
        (3, 2, [0.9, 0.0]), (3, 1, [0.9, 0.2]), (4, None, [1.0, 1.0]), (None, 2, [1.0, 0.0]),
        (5, 2, None), (6, 2, []), (7, 2, [None, 1.0]), (8, 2, [nan, 1.0]), (10, 2, [inf, 1.0]),
        (11, 2, [0.0, 0.0]), (12, 1, [0.0, 0.0]), (18, 1, [0.0, 0.0]), (13, 2, [1.0, 0.0, 0.0]),
        (27, 2, [1.0, 0.5, 0.0]), (14, 2, [0.9, 0.5, 0.0]), (36, 3, [1e300, 1.0]),
        (15, 3, [1e300, -5.0]), (16, 4, [1e299, 1.0]), (45, 3, [-1e300, 2.0]), (54, 7, [1.0, 1.0]),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    anchor = F.col("vec_id") % 9 == 0
    wanted = plain(rows, lambda i: i % 9 == 0)
    assert wanted and found(hard_negatives(df, anchor, F.col("label"))) == wanted
    extra = df.selectExpr("*", "'x' as v", "1 as cluster", "2 as block", "3 as row", "'y' as size",
                          "4 as positives", "true as is_anchor", "5 as slice")
    assert found(hard_negatives(extra, anchor, F.col("label"))) == wanted
    assert hard_negatives(df.where("false"), anchor, F.col("label")).count() == 0
    assert hard_negatives(df, F.lit(None).cast("boolean"), F.col("label")).count() == 0


def test_the_walk_stops_early_and_is_certified():
    rng = np.random.default_rng(3)
    far = rng.normal(0, 1, (5000, 16))
    near = rng.normal(0, 0.05, (200, 16)) + np.eye(16)[0] * 3
    vectors = np.floor(256 * np.concatenate([far, near])).astype(np.int64)
    members = np.floor(256 * (rng.normal(0, 0.05, (20, 16)) + np.eye(16)[0])).astype(np.int64)
    block = Candidates(np.arange(len(vectors)), np.zeros(len(vectors), np.int64), vectors)
    shared = SharedList(block, members)
    for query in members:
        true = vectors @ query
        length = math.sqrt(float(query @ query))
        assert (true[shared.order] <= length * shared.bound * (1 + 1e-9) + 1).all()
        best, read = Best(5), 0

        def take(rows, scores, left):
            nonlocal read
            read += len(rows)
            best.offer(rows, scores)
            return best.beats(left)

        shared.walk(block, query, take)
        assert best.ids.tolist() == np.lexsort((np.arange(len(true)), -true))[:5].tolist()
        assert read < len(vectors) / 4


def test_small_parts():
    assert score_range(101, (80, 100, 100)) == (81, 101)
    assert score_range(-10, (80, 100, 100)) == (-8, -10)
    huge = np.array([[2**62, 2**62], [-2**62, -2**62], [1, 2]], np.int64)
    assert inner(huge, np.array([4, 4])).tolist() == [2**63 - 1, -2**63, 12]
    assert len(centroids(np.zeros((5, 3), np.int64))) == 2


def test_query_against_its_sql(spark):
    folder = f"{TESTDATA}/sf0.01"
    duckdb.sql(f"create or replace view embeddings as select * from '{folder}/embeddings.parquet'")
    sql = f"select {', '.join(COLUMNS)} from ({LLM_ORACLE['op11_hard_negatives']})"
    rows = sorted(duckdb.sql(sql).fetchall())
    assert rows and found(op11_hard_negatives(spark, folder)) == rows
