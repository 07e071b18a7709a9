"""How the filters of a corpus interact: what each removes, alone and after others, in any order.

Every filter keeps sorted posting lists: the numbers of the documents it fails, per part and per
range of numbers, so that no list grows beyond a range however hot a part is. Everything an order of
filters can do follows from the sizes of the lists' unions: a step removes what it adds to the union
of the steps before it. Each range computes the sizes of all unions by galloping merges of its lists,
also within the marked documents (good, toxic); the sizes of the ranges are added up per part, and
the orders are read off the sums.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelgauge.llm.common import WORD, python_tasks, stored

# Documents in a range of numbers: the most ids a list, or a task's merge, can hold.
RANGE = 1 << 16
# Texts that occur most often: that many are joined by broadcast, so that no key of the shuffled
# join can hold more than one part in this many of all rows.
HOT_TEXTS = 10_000

SIZES = T.StructType([
    T.StructField("part", T.StringType()), T.StructField("filters", T.IntegerType()),
    T.StructField("marked", T.StringType()), T.StructField("size", T.LongType()),
])
STEPS = "array<struct<filter_order:string,step:int,before:int,own:int>>"


def quality_filters(text: Column) -> dict[str, Column]:
    """Conditions on a text alone under which filters A to D remove it."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals.cast("long") > 3 * F.length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def numbered(documents: DataFrame, part: str, text: str) -> DataFrame:
    """One row per document with a number, its part, the digest of its text and filters A to D.

    The rows are written, so their numbers are fixed: later stages that run again see the same.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    failing = [condition.alias(name) for name, condition in quality_filters(F.col("_text")).items()]
    return stored(
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), whole.alias("_text"),
        ).select(
            F.monotonically_increasing_id().alias("number"), "doc_id", "part",
            F.unhex(F.sha2(F.col("_text").cast("binary"), 256)).alias("digest"), *failing,
        ),
        "audit-rows",
    )


def with_repeats(rows: DataFrame, hot_texts: int = HOT_TEXTS) -> DataFrame:
    """``rows`` with filter E: another row with a smaller id has the same text.

    Texts that occur once never meet the join. The most frequent ones are joined by a broadcast of
    at most ``hot_texts`` rows, so a text that a third of all documents share stays in its tasks.
    """
    groups = stored(
        rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1").select("digest", "first", "n"), "audit-texts",
    )
    top = groups.orderBy(F.desc("n"), "digest").limit(hot_texts).select("digest", "first")
    hot = F.broadcast(stored(top, "audit-hot-texts"))
    by_broadcast = rows.join(hot, "digest")
    rest = rows.join(hot.select("digest"), "digest", "left_anti")
    others = groups.join(hot.select("digest"), "digest", "left_anti").select("digest", "first")
    by_shuffle = rest.join(others, "digest", "left")
    later = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return by_broadcast.unionByName(by_shuffle).withColumn("E", later).drop("first", "digest")


def with_marks(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with ``good`` and ``toxic``: a label of the id says quality 1, toxic 1."""
    marks = labels.where("doc_id is not null").groupBy(
        F.col("doc_id").cast("long").alias("_id")
    ).agg(*[
        F.coalesce(F.max(F.col(column) == 1), F.lit(False)).alias(name)
        for name, column in (("good", "quality"), ("toxic", "toxic"))
    ]).where("good or toxic")
    # Rows without an id are dealt out by their number; the second condition keeps them unmatched.
    key = F.coalesce("doc_id", "number")
    return rows.join(
        marks, (key == F.col("_id")) & F.col("doc_id").isNotNull(), "left"
    ).drop("_id").na.fill(False, ["good", "toxic"])


def posting_lists(rows: DataFrame, lists: tuple[str, ...]) -> DataFrame:
    """``part``, ``range``, ``list`` and the sorted ``numbers`` of the rows where that column holds.

    ``lists`` are Boolean columns of ``rows``. The list ``all`` has every row of the part and range.
    """
    entry = F.array(F.lit("all"), *[F.when(F.col(c), F.lit(c)) for c in lists])
    return rows.select(
        "part", F.shiftright("number", int(math.log2(RANGE))).alias("range"), "number",
        F.explode(F.array_compact(entry)).alias("list"),
    ).groupBy("part", "range", "list").agg(F.sort_array(F.collect_list("number")).alias("numbers"))


def gallop(numbers: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each of ``wanted`` stands, or would stand, in ``numbers``, and whether it is there.

    Both are sorted. A search starts where an even spread would put its number and leaps from there,
    each leap twice as wide, until the number is passed; the last leap is then halved. All searches
    advance together.
    """
    n = len(numbers)
    if not n or not len(wanted):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    low = np.arange(len(wanted)) * n // len(wanted)
    high, leap = low.copy(), 1
    while True:
        up = (high < n) & (numbers[np.minimum(high, n - 1)] < wanted)
        down = (low > 0) & (numbers[np.maximum(low, 1) - 1] >= wanted)
        if not (up | down).any():
            break
        low[up], high[down] = high[up] + 1, low[down] - 1
        high[up] = np.minimum(high[up] + leap, n)
        low[down] = np.maximum(low[down] - leap, 0)
        leap *= 2
    while (open_ := low < high).any():
        middle = (low + high) // 2
        less = numbers[np.minimum(middle, n - 1)] < wanted
        low = np.where(open_ & less, middle + 1, low)
        high = np.where(open_ & ~less, middle, high)
    return low, (low < n) & (numbers[np.minimum(low, n - 1)] == wanted)


def merged(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The union of two sorted lists: the shorter gallops through the longer."""
    if len(first) < len(second):
        first, second = second, first
    place, there = gallop(first, second)
    return np.insert(first, place[~there], second[~there])


def common(first: np.ndarray, second: np.ndarray) -> int:
    """How many numbers two sorted lists share."""
    short, long = sorted((first, second), key=len)
    return int(gallop(long, short)[1].sum())


def unions(lists: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """The union of every subset of some lists, by the bits of the subset."""
    made = {0: np.zeros(0, np.int64)}
    yield 0, made[0]
    for subset in range(1, 1 << len(lists)):
        bit = subset.bit_length() - 1
        made[subset] = merged(made[subset ^ (1 << bit)], lists[bit])
        yield subset, made[subset]


def union_sizes(postings: DataFrame, filters: tuple[str, ...], marks: tuple[str, ...]) -> DataFrame:
    """``part``, ``filters`` (bits of a subset), ``marked`` and ``size`` of the subset's union.

    ``marked`` is ``all`` or one of ``marks``: the union within the documents that have the mark.
    Subset 0 of ``all`` stands for the part itself: its size is the number of documents.
    """

    def merge(group: pa.Table) -> pa.Table:
        part = group.column("part")[0].as_py()
        found = {
            name: np.asarray(numbers.values)
            for name, numbers in zip(group.column("list").to_pylist(), group.column("numbers"))
        }
        none = np.zeros(0, np.int64)
        out = [(part, 0, "all", len(found.get("all", none)))]
        for subset, union in unions([found.get(name, none) for name in filters]):
            if subset:
                out.append((part, subset, "all", len(union)))
            for mark in marks:
                out.append((part, subset, mark, common(union, found.get(mark, none))))
        return pa.Table.from_pylist(
            [dict(zip(SIZES.names, row)) for row in out],
            pa.schema([("part", pa.string()), ("filters", pa.int32()), ("marked", pa.string()),
                       ("size", pa.int64())]),
        )

    sizes = postings.groupBy("part", "range").applyInArrow(merge, SIZES)
    return sizes.groupBy("part", "filters", "marked").agg(F.sum("size").alias("size"))


def order_steps(filters: tuple[str, ...]) -> list[dict]:
    """Every order of the filters cut into steps: the filters before it and its own, as bits."""
    out = []
    for order in permutations(range(len(filters))):
        name, before = "".join(filters[i] for i in order), 0
        for step, i in enumerate(order, 1):
            out.append({"filter_order": name, "step": step, "before": before, "own": 1 << i})
            before |= 1 << i
    return out


def interactions(
    sizes: DataFrame, filters: tuple[str, ...], marks: tuple[str, ...],
) -> DataFrame:
    """What every step of every order does in every part, read off the sizes of unions."""
    full = (1 << len(filters)) - 1
    per_part = sizes.groupBy("part").agg(
        F.map_from_entries(F.collect_list(F.struct(
            F.concat_ws(":", "marked", "filters"), F.col("size")
        ))).alias("sizes")
    )

    def size(marked: str, subset: Column) -> Column:
        found = F.col("sizes")[F.concat_ws(":", F.lit(marked), subset.cast("string"))]
        return F.coalesce(found, F.lit(0))

    def union(marked: str, subset: Column) -> Column:
        # Subset 0 of "all" is the part's own size; the union of no filter is empty.
        return F.when(subset == 0, F.lit(0).cast("long")).otherwise(size(marked, subset))

    steps = F.from_json(F.lit(json.dumps(order_steps(filters))), STEPS)
    at = per_part.select("part", "sizes", F.explode(steps).alias("s")).select("part", "sizes", "s.*")
    after = F.col("before").bitwiseOR(F.col("own"))
    gone = {m: union(m, after) - union(m, F.col("before")) for m in ("all", *marks)}
    others = F.lit(full).bitwiseXOR(F.col("own"))
    done = at.select(
        "part", "filter_order", "step", "own",
        (size("all", F.lit(0)) - union("all", after)).alias("kept"),
        gone["all"].alias("removed"),
        (union("all", F.col("own")) - gone["all"]).alias("redundant"),
        (union("all", F.lit(full)) - union("all", others)).alias("unique_fails"),
        *[gone[m].alias(f"{m}_lost") for m in marks],
    )
    # A part has as many rows as there are orders and steps, so no window grows with the documents.
    same_filter = Window.partitionBy("part", "own")
    return done.withColumn("shapley", F.sum("removed").over(same_filter)).drop("own")


def audit(
    documents: DataFrame, labels: DataFrame, part: str = "lang", text: str = "text",
    hot_texts: int = HOT_TEXTS,
) -> DataFrame:
    """What filters A to E do to every part in every order, one row per part, order and step.

    A: under 200 words; B: under half of the words distinct; C: over 3 % capital letters; D: one of
    ``#$%&*|``; E: another row with a smaller id has the same text. ``kept`` counts the documents
    left after the step, ``removed`` those it removes, ``redundant`` those failing its filter that an
    earlier step removed, ``unique_fails`` those failing no other filter, ``good_lost`` and
    ``toxic_lost`` the removed ones with such a label, ``shapley`` what its filter removes, summed
    over all orders.

    Null and empty texts are the same text without words; a null part is the part without a name.
    Every row counts as a document, repeated ids too; ties in the id are no smaller id. A null id
    fails E never, carries no label and is nobody's smaller id. Of several labels of an id one that
    says so is enough. Very long texts are read whole; an empty table has no parts and no rows; other
    columns are not looked at.
    """
    python_tasks(documents.sparkSession)
    filters, marks = ("A", "B", "C", "D", "E"), ("good", "toxic")
    rows = with_marks(with_repeats(numbered(documents, part, text), hot_texts), labels)
    sizes = union_sizes(posting_lists(rows, (*filters, *marks)), filters, marks)
    return interactions(sizes, filters, marks)
