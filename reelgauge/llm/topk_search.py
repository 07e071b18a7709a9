"""Exact top-k inner products by the threshold algorithm.

Vectors are dealt to blocks; a block sorts its values once per dimension. For a query the sorted
lists are read from their good ends (the largest values where the query is positive, the smallest
where it is negative), and what comes up is scored in full. No vector not yet seen can score more
than the sum over the dimensions of query times value last read; once that is less than the k-th
best score, the block is done. The best k of each block are merged per query.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelgauge.llm.common import python_tasks

# Vectors of a block and queries of a slice on average, and the depth of the first read; each read
# doubles it.
BLOCK, SLICE = 8192, 4096
FIRST_READ = 32

FOUND = T.StructType([
    T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()),
    T.StructField("score", T.LongType()),
])


def quantised(vector: Column) -> Column:
    """floor(256 x) of each component; null for a vector that is null, empty or holds a component
    that is null or not finite."""
    real = vector.cast("array<double>")
    bad = F.exists(real, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(real, lambda x: F.floor(x * 256).cast("long"))
    return F.when((F.size(real) > 0) & ~F.coalesce(bad, F.lit(True)), whole)


class SortedLists:
    """The vectors of a block and, per dimension, their order by value."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[by_id], vectors[by_id]
        self.order = np.argsort(self.vectors, axis=0, kind="stable").T
        self.largest = float(np.abs(self.vectors.astype(np.float64)).max(initial=0))

    def holds(self, query: np.ndarray) -> bool:
        """Whether all sums of products stay within 64 bits."""
        most = float(np.abs(query.astype(np.float64)).max(initial=0))
        return self.largest * most * len(query) < 2**62

    def best_of_all(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The same for numbers that 64 bits may not hold: all are scored as whole numbers of any
        length, and the scores held within 64 bits."""
        sums = self.vectors.astype(object) @ query.astype(object)
        scores = np.array([min(max(s, -2**63), 2**63 - 1) for s in sums], np.int64)
        others = np.flatnonzero(self.ids != own)
        # Scores may be as low as 64 bits go, where a minus sign would wrap.
        keep = others[np.lexsort((self.ids[others], ~scores[others]))[:k]]
        return self.ids[keep], scores[keep]

    def best(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best ``k`` vectors that are not the query's own."""
        n = len(self.ids)
        if not self.holds(query):
            return self.best_of_all(query, own, k)
        used = np.flatnonzero(query)
        if not len(used):  # all scores are 0
            at = np.flatnonzero(self.ids != own)[:k]
            return self.ids[at], np.zeros(len(at), np.int64)
        weight, up = query[used], query[used] > 0
        seen = self.ids == own
        top = np.zeros(0, np.int64)
        scores = np.zeros(0, np.int64)
        depth, step = 0, FIRST_READ
        while depth < n:
            stop = min(n, depth + step)
            read = np.concatenate([
                self.order[d, n - stop:n - depth] if high else self.order[d, depth:stop]
                for d, high in zip(used, up)
            ])
            fresh = np.zeros(n, bool)
            fresh[read] = True
            fresh &= ~seen
            new = np.flatnonzero(fresh)
            seen |= fresh
            top = np.concatenate([top, new])
            scores = np.concatenate([scores, self.vectors[new] @ query])
            keep = np.lexsort((self.ids[top], -scores))[:k]
            top, scores = top[keep], scores[keep]
            last = [self.order[d, n - stop if high else stop - 1] for d, high in zip(used, up)]
            bound = int((weight * self.vectors[last, used]).sum())
            # An unseen vector with the k-th score itself could still win by its smaller id.
            if len(top) == k and bound < scores[-1]:
                break
            depth, step = stop, step * 2
        return self.ids[top], scores


def top_k(
    vectors: DataFrame, query: Column, k: int = 5, vector: str = "embedding",
    slice_size: int = SLICE,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of each query's best ``k`` rows.

    ``query`` says which rows are queries; candidates are all rows but those with the query's id.
    Scores are inner products of the quantised vectors; ties go to the smaller id. Rows with a null
    id or a vector that is null, empty or not finite take no part; only vectors of the query's
    length are compared; repeated rows are one row; huge components and scores are held within 64
    bits; an empty table gives an empty table; other columns are not looked at. Every block of
    candidates meets every slice of the queries, so a task holds one of each.
    """
    python_tasks(vectors.sparkSession)
    known = (
        vectors.select(
            F.col("vec_id").cast("long").alias("vec_id"), quantised(F.col(vector)).alias("v"),
            F.coalesce(query, F.lit(False)).alias("is_query"),
        ).where("vec_id is not null and v is not null").distinct()
        .withColumn("size", F.size("v"))
    )
    size = known.agg(F.count("*").alias("n"), F.count_if("is_query").alias("asked")).first()
    blocks = max(1, math.ceil(size["n"] / BLOCK))
    slices = max(1, math.ceil(size["asked"] / slice_size))

    def dealt(parts: int) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int")

    def every(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    candidates = known.select(
        "vec_id", "v", "size", dealt(blocks).alias("block"), every(slices).alias("slice")
    )
    asked = known.where("is_query").select(
        "vec_id", "v", "size", dealt(slices).alias("slice"), every(blocks).alias("block")
    )
    keys = ["block", "slice", "size"]

    def search(block_rows: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if block_rows.num_rows and queries.num_rows:
            lists = SortedLists(*matrix(block_rows))
            for own, values in zip(*matrix(queries)):
                ids, scores = lists.best(values, int(own), k)
                out.append((np.full(len(ids), own), ids, scores))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table([pa.array(c, pa.int64()) for c in columns], FOUND.names)

    found = candidates.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(search, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def matrix(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = np.asarray(rows.column("vec_id").combine_chunks())
    lists = rows.column("v").combine_chunks()
    return ids, np.asarray(lists.flatten()).reshape(len(ids), -1)
