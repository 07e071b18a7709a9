"""Quality scores from how well two zstandard dictionaries compress a text.

One dictionary is trained on blocks of good, one on blocks of bad labelled text. A text is cut into
blocks and each block compressed with either; the difference of the two total sizes over their sum
is turned into a probability by a logistic curve fitted on other labelled rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelgauge.llm.common import python_tasks, utf8

# Labelled rows of each class that are used at most (the first by the hash of their id), half for
# the dictionaries and half for the curve, and blocks of each class a dictionary is trained on.
# This bounds what the driver collects: 2 x 3,000 blocks of 2 KB, and 6,000 pairs of numbers.
SAMPLE_DOCUMENTS = 6000
SAMPLE_BLOCKS = 3000
BLOCK = 2048
DICTIONARY = 110 << 10
LEVEL = 3
THRESHOLD = 0.3


@dataclass(frozen=True)
class CompressionModel:
    """Two dictionaries and the curve from the size difference to a probability of label 1."""

    good: bytes
    bad: bytes
    slope: float
    intercept: float


@lru_cache(maxsize=4)
def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    if data:
        data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=data, write_checksum=False, write_content_size=False,
        write_dict_id=False,
    )


def difference(text: bytes | None, good: bytes, bad: bytes) -> float:
    """(bad size - good size) / (bad size + good size), over all blocks; 0 for an empty text."""
    if not text:
        return 0.0
    by_good, by_bad = compressor(good).compress, compressor(bad).compress
    a = b = 0
    for at in range(0, len(text), BLOCK):
        block = text[at:at + BLOCK]
        a += len(by_good(block))
        b += len(by_bad(block))
    return (b - a) / (a + b)


def differences(text: Column, good: bytes, bad: bytes) -> Column:
    @F.arrow_udf("double")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([difference(t, good, bad) for t in utf8(texts)], pa.float64())

    return of(text)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from: crc32 of the id as text divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train_dictionary(blocks: list[bytes]) -> bytes:
    """A zstandard dictionary; of too few blocks for training, the blocks themselves."""
    if not blocks:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY, blocks).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[:DICTIONARY]


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a slightly smoothed logistic regression, by Newton's steps."""
    scale = max(float(np.std(x)), 1e-6)
    a = np.column_stack([x / scale, np.ones(len(x))])
    n1, n0 = float((y == 1).sum()), float((y == 0).sum())
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    w = np.array([0.0, np.log((n1 + 1) / (n0 + 1))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -35, 35)))
        hessian = a.T @ (a * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, a.T @ (target - p) - 1e-3 * w * np.array([1.0, 0.0]))
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0] / scale), float(w[1])


def learn(
    documents: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCUMENTS,
    blocks: int = SAMPLE_BLOCKS,
) -> CompressionModel:
    """Learn from labelled rows that are not held out, at most ``sample`` of each class.

    Labels that are null or neither 0 nor 1, and labels without a document, are left out; an id
    with both labels counts as both. Without rows of both classes the score is the same for all
    texts, the share of good rows (0.5 without any).
    """
    python_tasks(documents.sparkSession)
    usable = labels.where(
        F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))
    ).select("doc_id", F.col("quality").cast("int").alias("label")).distinct()
    order = F.xxhash64("doc_id")
    chosen = [
        usable.where(F.col("label") == k).orderBy(order, "doc_id").limit(sample) for k in (0, 1)
    ]
    rows = (
        documents.select("doc_id", "text").where(F.col("text").isNotNull())
        .join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")
        .withColumn("use", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)))
    )

    def cut(batches):
        for batch in batches:
            label, block = [], []
            for k, text in zip(batch.column("label").to_pylist(), utf8(batch.column("text"))):
                for at in range(0, len(text), BLOCK):
                    label.append(k)
                    block.append(text[at:at + BLOCK])
            yield pa.RecordBatch.from_arrays(
                [pa.array(label, pa.int32()), pa.array(block, pa.binary())], ["label", "block"]
            )

    schema = T.StructType([
        T.StructField("label", T.IntegerType()), T.StructField("block", T.BinaryType()),
    ])
    pieces = rows.where("use = 0").select("label", "text").mapInArrow(cut, schema)
    dictionaries = [
        train_dictionary([
            bytes(r["block"]) for r in pieces.where(F.col("label") == k)
            .orderBy(F.xxhash64("block"), "block").limit(blocks).collect()
        ])
        for k in (0, 1)
    ]
    bad, good = dictionaries
    pairs = (
        rows.where("use = 1")
        .select("label", differences(F.col("text"), good, bad).alias("difference"))
        .orderBy(F.xxhash64("difference"), "difference", "label").limit(2 * sample).collect()
    )
    y = np.array([r["label"] for r in pairs], int)
    if not good or not bad or len(set(y.tolist())) < 2:
        share = (float(y.sum()) + 1) / (len(y) + 2)
        return CompressionModel(good, bad, 0.0, float(np.log(share / (1 - share))))
    slope, intercept = fit_curve(np.array([r["difference"] for r in pairs]), y)
    return CompressionModel(good, bad, slope, intercept)


def quality_scores(
    documents: DataFrame, model: CompressionModel, threshold: float = THRESHOLD,
) -> DataFrame:
    """``documents`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    One row in, one row out, no shuffle. Null and empty texts have the difference 0 and so the
    curve's own score; whole texts are compressed, block by block however long; repeated rows are
    scored each; an empty table gives an empty table; input columns named like a result are replaced.
    """
    python_tasks(documents.sparkSession)
    found = differences(F.col("text"), model.good, model.bad)
    return (
        documents.withColumn("score", score_column(found, model))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )


def score_column(difference: Column, model: CompressionModel) -> Column:
    z = F.lit(model.slope) * difference + F.lit(model.intercept)
    return 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(35.0)), F.lit(-35.0))))


def passes(difference: Column, model: CompressionModel, threshold: float = THRESHOLD) -> Column:
    """Whether a text is not rejected."""
    return score_column(difference, model) >= threshold
