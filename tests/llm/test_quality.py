from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from reelgauge.llm.quality_classifier import (
    CompressionModel, difference, fit_curve, held_out, learn, quality_scores, train_dictionary,
)
from tests.llm.cases import ROWS, no_documents, odd_documents

FOLDER = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    from reelgauge.llm.queries import op8_quality

    rows = op8_quality(spark, FOLDER).collect()
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    held = [(r["score"], r["predicted"], label[r["doc_id"]]) for r in rows
            if r["held_out"] and r["doc_id"] in label]
    good = [p for _, p, y in held if y == 1]
    bad = [p for _, p, y in held if y == 0]
    assert sum(good) / len(good) > 0.99
    assert sum(bad) / len(bad) < 0.3
    scores = np.array([s for s, _, _ in held])
    y = np.array([y for _, _, y in held])
    order = np.argsort(scores)
    ranks = np.empty(len(order))
    ranks[order] = np.arange(len(order))
    auc = (ranks[y == 1].mean() - (y.sum() - 1) / 2) / (len(y) - y.sum())
    assert auc > 0.96


def test_held_out_labels_are_never_used(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    turned = labels.withColumn("quality", F.when(
        held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert learn(documents, labels) == learn(documents, turned)


def test_odd_rows_and_labels(spark):
    documents = odd_documents(spark).withColumn("score", F.lit("old"))
    labels = spark.createDataFrame(
        [(1, 1), (1, 1), (2, 0), (3, 1), (4, 0), (None, 1), (6, None), (7, 5), (99, 0)],
        "doc_id long, quality int",
    )
    for some in (labels, labels.where("false")):
        model = learn(documents, some)
        rows = quality_scores(documents, model).collect()
        assert len(rows) == len(ROWS)
        assert all(0 <= r["score"] <= 1 for r in rows)
        same = {r["score"] for r in rows if not r["text"]}
        assert len(same) == 1
    assert quality_scores(no_documents(spark), model).count() == 0
    assert learn(no_documents(spark), labels).slope == 0.0


def test_size_difference_points_to_the_dictionary():
    good = train_dictionary([f"the house number {i} on the hill".encode() for i in range(400)])
    bad = train_dictionary([f"$$$ win ### {i} &&& now".encode() for i in range(400)])
    assert difference(b"the house number 77 on the hill", good, bad) > 0
    assert difference(b"$$$ win ### 77 &&& now", good, bad) < 0
    assert difference(None, good, bad) == difference(b"", good, bad) == 0
    x = np.array([-1.0, -0.5, 0.4, 1.0] * 20)
    slope, intercept = fit_curve(x, (x > 0).astype(int))
    assert slope > 0 and CompressionModel(good, bad, slope, intercept).slope == slope


def test_scores_against_plain_compression(spark):
    """The query's scores from a fresh compressor per block, and the fitted numbers from the formula."""
    import math

    import zstandard

    from reelgauge.llm.queries import op8_quality

    folder = "/root/testdata/sf0.01"
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    model = learn(documents, spark.read.parquet(f"{folder}/labels.parquet"))
    assert model.slope > 0

    def size(text: bytes, dictionary: bytes) -> int:
        blocks = (text[at:at + 2048] for at in range(0, len(text), 2048))
        return sum(
            len(zstandard.ZstdCompressor(
                level=3, dict_data=zstandard.ZstdCompressionDict(dictionary), write_checksum=False,
                write_content_size=False, write_dict_id=False,
            ).compress(block)) for block in blocks
        )

    scores = {r["doc_id"]: r["score"] for r in op8_quality(spark, folder).collect()}
    rows = documents.where("doc_id % 5 = 0").collect()
    for doc_id, text in rows:
        data = (text or "").encode()
        good, bad = size(data, model.good), size(data, model.bad)
        x = (bad - good) / (bad + good) if data else 0.0
        assert math.isclose(
            scores[doc_id], 1 / (1 + math.exp(-(model.slope * x + model.intercept))), rel_tol=1e-9, abs_tol=1e-12
        )
    assert len(rows) > 150
