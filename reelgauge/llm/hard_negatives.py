"""Hard negatives of anchors, exactly, by lists that all anchors of a cluster share.

Anchors are put into clusters by direction. No member of a cluster lies further from its centroid
than the cluster's radius b, an angle; so a candidate i at the angle t from the centroid is at least
t - b away from every member, and a member u scores at most |u| |i| cos(max(0, t - b)) with it. A
block of candidates is sorted by |i| cos(max(0, t - b)) once per cluster. Every member walks that
list from the top and stops when the bound of what follows shows that nothing there can enter its
answer. The first walk finds each anchor's positives, the second, which knows the scores of the
positives, their negatives; the best of each block are merged.

Candidates and anchors are dealt into blocks and slices of bounded size, and every block meets every
slice, so no task holds more than one of each, whatever the number of anchors or of equal vectors.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelgauge.llm.common import python_tasks, stored
from reelgauge.llm.topk_search import quantised

# Candidates of a block and anchors of a slice, on average.
BLOCK, SLICE = 8192, 4096
# The centroids are fitted on at most this many anchors; every anchor is then put to one.
SAMPLE, CLUSTERS, ROUNDS = 2048, 64, 8
# Candidates read first; each further read is as long as all before it.
FIRST_READ = 64
# Room for rounding: of angles, and of a bound in parts of itself.
ANGLE, PART = 1e-6, 1e-9

FOUND = T.StructType([
    T.StructField("anchor_id", T.LongType()), T.StructField("positive_id", T.LongType()),
    T.StructField("vec_id", T.LongType()), T.StructField("positive_score", T.LongType()),
    T.StructField("score", T.LongType()),
])


def directions(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors and lengths; a vector of zeros has no direction and stays zero."""
    real = vectors.astype(np.float64)
    length = np.sqrt((real * real).sum(axis=1))
    return real / np.where(length > 0, length, 1)[:, None], length


def centroids(sample: np.ndarray, clusters: int = CLUSTERS, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids of the sample's directions, fewer for a small sample."""
    unit, _ = directions(sample)
    count = max(1, min(clusters, math.isqrt(len(unit))))
    centres = unit[np.arange(count) * len(unit) // count]
    for _ in range(rounds):
        nearest = (unit @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, unit)
        moved, length = directions(sums)
        centres = np.where(length[:, None] > 0, moved, centres)
    return centres


def inner(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products, held within 64 bits.

    Doubles add up whole numbers exactly below 2^53; larger ones are added as whole numbers of any
    length.
    """
    if not len(vectors):
        return np.zeros(0, np.int64)
    largest = [float(np.abs(x.astype(np.float64)).max(initial=0)) for x in (vectors, query)]
    if largest[0] * largest[1] * len(query) < 2**53:
        return (vectors.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    sums = vectors.astype(object) @ query.astype(object)
    return np.array([min(max(s, -2**63), 2**63 - 1) for s in sums], np.int64)


class Candidates:
    """A block of candidates."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.unit, self.length = directions(vectors)
        self.small = vectors.astype(np.float64)
        self.largest = float(np.abs(self.small).max(initial=0))

    def scores(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        if self.largest * float(np.abs(query.astype(np.float64)).max(initial=0)) * len(query) < 2**53:
            return (self.small[rows] @ query.astype(np.float64)).astype(np.int64)
        return inner(self.vectors[rows], query)


class SharedList:
    """The candidates of a block in the order that all members of a cluster walk."""

    def __init__(self, block: Candidates, members: np.ndarray):
        unit, _ = directions(members)
        centre, length = directions(unit.sum(axis=0, keepdims=True))
        radius = np.arccos(np.clip(unit @ centre[0], -1, 1)).max() if length[0] else math.pi
        angle = np.arccos(np.clip(block.unit @ centre[0], -1, 1))
        bound = block.length * np.cos(np.maximum(0, angle - radius - ANGLE))
        self.order = np.argsort(-bound, kind="stable")
        self.bound = bound[self.order]

    def walk(self, block: Candidates, query: np.ndarray, take: Callable) -> None:
        """Give ``take`` the next candidates, their scores and the most that any later one can
        score, until it says that it needs no more."""
        length = math.sqrt(float((query.astype(np.float64) ** 2).sum()))
        start, stop, n = 0, FIRST_READ, len(self.order)
        while start < n:
            rows = self.order[start:stop]
            left = -math.inf
            if stop < n:
                left = length * self.bound[stop]
                left += abs(left) * PART + 1
            if take(rows, block.scores(rows, query), left):
                return
            start, stop = stop, 2 * stop


class Best:
    """The best ``k`` of what is offered, by score, then id."""

    def __init__(self, k: int):
        self.k = k
        self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def offer(self, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = np.concatenate([self.ids, ids]), np.concatenate([self.scores, scores])
        if len(ids) > 8 * self.k:  # only those that reach the k-th score are worth sorting
            worst = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            ids, scores = ids[scores >= worst], scores[scores >= worst]
        # Scores may be as low as 64 bits go, where a minus sign would wrap.
        keep = np.lexsort((ids, ~scores))[:self.k]
        self.ids, self.scores = ids[keep], scores[keep]

    def beats(self, bound: float) -> bool:
        """Whether nothing that scores at most ``bound`` can enter, not even by its id."""
        return len(self.ids) == self.k and bound < self.scores[-1]


def positives_of(block: Candidates, shared: SharedList, own: int, label: int, query, k: int) -> Best:
    best = Best(k)

    def take(rows, scores, left):
        fit = (block.labels[rows] == label) & (block.ids[rows] != own)
        best.offer(block.ids[rows][fit], scores[fit])
        return best.beats(left)

    shared.walk(block, query, take)
    return best


def score_range(score: int, window: tuple[int, int, int]) -> tuple[int, int]:
    """Least and largest score within the window of a positive's score."""
    low, high, whole = window
    return -(-low * score // whole), high * score // whole


def negatives_of(
    block: Candidates, shared: SharedList, label: int, query, ranges: list[tuple[int, int]], k: int,
) -> list[Best]:
    best = [Best(k) for _ in ranges]

    def take(rows, scores, left):
        fit = block.labels[rows] != label
        ids, values = block.ids[rows][fit], scores[fit]
        done = True
        for one, (low, high) in zip(best, ranges):
            inside = (values >= low) & (values <= high)
            one.offer(ids[inside], values[inside])
            done &= left < low or low > high or one.beats(left)
        return done

    shared.walk(block, query, take)
    return best


def matrix(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, labels and vectors."""
    ids, labels = (np.asarray(rows.column(c).combine_chunks()) for c in ("vec_id", "label"))
    lists = rows.column("v").combine_chunks()
    return ids, labels, np.asarray(lists.flatten()).reshape(len(ids), -1)


def fitted(anchors: DataFrame) -> dict[int, np.ndarray]:
    """Centroids per vector length, of at most ``SAMPLE`` anchors."""
    rows = anchors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()
    by_size: dict[int, list] = {}
    for row in rows:
        by_size.setdefault(len(row["v"]), []).append(row["v"])
    return {size: centroids(np.array(found, np.int64)) for size, found in by_size.items()}


def clustered(anchors: DataFrame) -> DataFrame:
    """``anchors`` with ``cluster``; vectors as long as none in the sample are one cluster."""
    centres = fitted(anchors)

    @F.arrow_udf("int")
    def nearest(vectors: pa.Array) -> pa.Array:
        out = []
        for one in vectors:
            values = np.asarray(one.values)
            known = centres.get(len(values))
            unit, _ = directions(values[None, :])
            out.append(0 if known is None else int((known @ unit[0]).argmax()))
        return pa.array(out, pa.int32())

    return anchors.withColumn("cluster", nearest("v"))


def sliced(anchors: DataFrame, slice_size: int) -> tuple[DataFrame, int]:
    """``anchors`` with ``slice``, and the number of slices.

    Small clusters share a slice, large ones have several of their own.
    """
    sizes = {r["cluster"]: r["count"] for r in anchors.groupBy("cluster").count().collect()}
    first, parts, free, count = {}, {}, 0, 0
    for cluster, size in sorted(sizes.items(), key=lambda item: (item[1], item[0])):
        parts[cluster] = math.ceil(size / slice_size)
        if parts[cluster] > 1 or size > free:
            first[cluster], count = count, count + parts[cluster]
            free = slice_size - size if parts[cluster] == 1 else 0
        else:
            first[cluster], free = count - 1, free - size
    every = range(max(sizes, default=0) + 1)
    place = F.array(*[F.lit(first.get(c, 0)) for c in every])[F.col("cluster")]
    wide = F.array(*[F.lit(parts.get(c, 1)) for c in every])[F.col("cluster")]
    return anchors.withColumn(
        "slice", (place + F.pmod(F.xxhash64("vec_id"), wide)).cast("int")
    ), max(1, count)


def hard_negatives(
    vectors: DataFrame, anchor: Column, label: Column, positives: int = 5, negatives: int = 5,
    window: tuple[int, int, int] = (80, 100, 100), vector: str = "embedding",
    block_size: int = BLOCK, slice_size: int = SLICE,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``,
    ``negative_score``: each anchor's positives with their hard negatives.

    ``anchor`` says which rows are anchors, ``label`` gives each row's label, a whole number. Scores
    are inner products of the quantised vectors; higher ones come first, ties by the smaller id. An
    anchor's positives are its first ``positives`` other rows of its label. For a ``window`` (low,
    high, whole) the negatives of a positive are the first ``negatives`` rows of other labels with
    low * positive score <= whole * score <= high * positive score, all if there are fewer; a
    positive without any gives no row, as does one with a score below zero in the usual window.

    Rows with a null id or label, or a vector that is null, empty, or holds a null or a component
    that is not finite, take no part. Of rows that share an id the one with the least label, then
    vector, counts; repeated rows are thereby one. Only vectors of one length are compared. Huge
    components and scores are held within 64 bits. An empty table, or one without anchors, gives an
    empty table; other columns are not looked at.
    """
    python_tasks(vectors.sparkSession)
    known = stored(
        vectors.select(
            F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
            quantised(F.col(vector)).alias("v"),
            F.coalesce(anchor, F.lit(False)).alias("is_anchor"),
        ).where("vec_id is not null and label is not null and v is not null")
        .groupBy("vec_id").agg(F.min(F.struct("label", "v", "is_anchor")).alias("row"))
        .select("vec_id", "row.*", F.size("row.v").alias("size")),
        "vectors",
    )
    blocks = max(1, math.ceil(known.count() / block_size))
    anchors, slices = sliced(
        stored(clustered(known.where("is_anchor").drop("is_anchor")), "anchors"), slice_size
    )
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    candidates = known.select(
        "vec_id", "label", "v", "size", block.alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"),
    )
    deal = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    keys = ["block", "slice", "size"]

    def walks(answer: Callable) -> Callable:
        """A task: the shared list of each cluster of the slice, walked by each member."""

        def search(rows: pa.Table, asked: pa.Table) -> pa.Table:
            out = [[np.zeros(0, np.int64)] for _ in FOUND]
            if rows.num_rows and asked.num_rows:
                held = Candidates(*matrix(rows))
                ids, labels, queries = matrix(asked)
                cluster = np.asarray(asked.column("cluster").combine_chunks())
                for one in np.unique(cluster):
                    members = np.flatnonzero(cluster == one)
                    shared = SharedList(held, queries[members])
                    for i in members.tolist():
                        for found in answer(held, shared, asked, i, ids[i], labels[i], queries[i]):
                            for column, values in zip(out, found):
                                column.append(values)
            return pa.table(
                [pa.array(np.concatenate(c), pa.int64()) for c in out], FOUND.names
            )

        return search

    def positive(held, shared, asked, i, own, own_label, query):
        best = positives_of(held, shared, own, own_label, query, positives)
        n = len(best.ids)
        yield np.full(n, own), best.ids, best.ids, best.scores, best.scores

    def negative(held, shared, asked, i, own, own_label, query):
        pairs = asked.column("positives")[i].as_py()
        ranges = [score_range(p["score"], window) for p in pairs]
        for p, best in zip(pairs, negatives_of(held, shared, own_label, query, ranges, negatives)):
            n = len(best.ids)
            yield (np.full(n, own), np.full(n, p["vec_id"]), best.ids, np.full(n, p["score"]),
                   best.scores)

    def merged(answer: Callable, asked: DataFrame, by: list[str], k: int) -> DataFrame:
        found = candidates.groupBy(*keys).cogroup(
            asked.select("*", deal).groupBy(*keys)
        ).applyInArrow(walks(answer), FOUND)
        best_first = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)

    first = merged(positive, anchors, ["anchor_id"], positives)
    per_anchor = first.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("vec_id", "score")).alias("positives")
    )
    second = merged(
        negative, anchors.join(per_anchor, "vec_id"), ["anchor_id", "positive_id"], negatives
    )
    return second.select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
