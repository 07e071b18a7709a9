from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from reelgauge.llm.decontamination import (
    Index, benchmark_matches, budget, find_items, units, without_benchmark,
)
from tests.llm.cases import ROWS, no_documents, odd_documents


def fewest_edits(item: np.ndarray, text: np.ndarray) -> int:
    """The plain table: edits of the best passage of a text."""
    row = np.zeros(len(text) + 1, int)
    for i, char in enumerate(item):
        new = np.empty_like(row)
        new[0] = i + 1
        for j in range(1, len(row)):
            new[j] = min(row[j - 1] + (text[j - 1] != char), row[j] + 1, new[j - 1] + 1)
        row = new
    return int(row.min())


def edited(rng: random.Random, text: str, edits: int) -> str:
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice("qxz")
        elif kind == 1:
            out.insert(at, rng.choice("qxz"))
        else:
            del out[at]
    return "".join(out)


def test_against_the_plain_table():
    rng = random.Random(3)
    words = ["the", "ing", "tion", "and", "er", "on", "re", "ha", "st", "of"]

    def prose(n):
        return " ".join("".join(rng.choices(words, k=rng.randint(1, 3))) for _ in range(n))

    items = [(i, prose(rng.randint(4, 25))) for i in range(12)]
    built = Index.build(tuple(items), 0.08)
    texts = []
    for _ in range(60):
        item = rng.choice(items)[1]
        inside = edited(rng, item, rng.randrange(0, budget(len(item)) + 4))
        texts.append(f"{prose(rng.randint(0, 20))} {inside.upper()}\n{prose(rng.randint(0, 20))}")
    found = find_items(texts, built)
    hits = 0
    for text, matches in zip(texts, found):
        expected = {
            i: e for i, t in items if (e := fewest_edits(units(t), units(text))) <= budget(len(t))
        }
        best: dict[int, int] = {}
        for m in matches:
            best[m["item_id"]] = min(m["edits"], best.get(m["item_id"], 99))
            part = units(text[m["start"]:m["stop"]])
            assert fewest_edits(units(dict(items)[m["item_id"]]), part) <= m["edits"]
        assert best == expected
        hits += len(best)
    assert hits > 20


def test_odd_rows(spark):
    item = "a passage of the benchmark that somebody copied"
    rows = ROWS + [
        (20, f"😀😀 before {item.upper()} after {item}", "z"), (21, item, None), (21, item, None),
        (22, item[:20], None), (None, item, None),
    ]
    documents = spark.createDataFrame(rows, "doc_id long, text string, matches string")
    benchmark = spark.createDataFrame(
        [(1, item), (1, item), (2, None), (3, ""), (4, "short"), (None, "of something without an id")],
        "item_id long, text string",
    )
    found = benchmark_matches(documents, benchmark).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r["matches"] for r in found}
    places = [(m["start"], m["stop"], m["edits"]) for m in by_id[20]]
    assert places == [(10, 10 + len(item), 0), (17 + len(item), 17 + 2 * len(item), 0)]
    assert [m["item_id"] for m in by_id[21]] == [1] and by_id[22] == [] and by_id[3] == []
    kept = without_benchmark(documents, benchmark)
    assert kept.columns == documents.columns
    assert kept.count() == len(ROWS) + 1
    assert without_benchmark(documents, benchmark.where("false")).count() == len(rows)
    assert benchmark_matches(no_documents(spark), benchmark).count() == 0
    assert benchmark_matches(odd_documents(spark), benchmark).where(F.size("matches") > 0).count() == 0


def test_a_large_benchmark_goes_in_blocks(spark):
    folder = "/root/testdata/sf0.01"
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet").unionByName(
        spark.createDataFrame([(10**6, "the"), (None, "le")], "item_id long, text string"),
    )
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").where(
        "doc_id % 3 = 0"
    )
    documents = documents.unionByName(documents.limit(5))
    one, many = (
        sorted(repr((r["doc_id"], r["matches"])) for r in benchmark_matches(
            documents, benchmark, block_bytes=size).collect())
        for size in (8 << 20, benchmark.count() * 40)
    )
    assert one == many and len(one) == documents.count()


def test_short_items_are_found_as_whole_words():
    items = [(1, "wxyz"), (2, "a b"), (3, "é"), (4, "seven77"), (5, "WXYZ"), (None, "no"), (6, "😀 x")]
    built = Index.build(tuple(items), 0.08)
    texts = ["say wxyz, Wxyz!", "wxyzs or awxyz or wxyz1", "a\tb", "é", "😀 seven77", "no", None, "wxyz",
             "x 😀 x"]
    got = [[(m["item_id"], m["start"], m["stop"], m["edits"]) for m in found]
           for found in find_items(texts, built)]
    assert got == [
        [(1, 4, 8, 0), (5, 4, 8, 0), (1, 10, 14, 0), (5, 10, 14, 0)], [], [(2, 0, 3, 0)], [(3, 0, 1, 0)],
        [(4, 2, 9, 0)], [(None, 0, 2, 0)], [], [(1, 0, 4, 0), (5, 0, 4, 0)], [(6, 2, 5, 0)],
    ]


def test_every_planted_item_is_found(spark):
    from reelgauge.llm.queries import op6_decontamination

    folder = "/root/testdata/sf0.01"
    documents = spark.read.parquet(f"{folder}/documents.parquet").collect()
    items = spark.read.parquet(f"{folder}/benchmark.parquet").collect()
    found = {(r["doc_id"], r["item_id"]) for r in op6_decontamination(spark, folder).collect()}
    fold = lambda t: "".join(" " if c.isspace() else c for c in t.lower())
    planted = {
        (d["doc_id"], i["item_id"]) for d in documents for i in items
        if i["text"] and fold(i["text"].strip()) in fold(d["text"] or "")
    }
    assert planted and planted <= found
