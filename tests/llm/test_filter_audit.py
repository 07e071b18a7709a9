from __future__ import annotations

import random
import re
from itertools import permutations

import duckdb
import numpy as np

from reelgauge.llm.filter_audit import audit, common, gallop, merged, unions
from reelgauge.llm.queries import LLM_ORACLE, op13_filter_audit
from tests.conftest import TESTDATA
from tests.llm.cases import no_documents, odd_documents

COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
           "good_lost", "toxic_lost", "shapley")


def plain(rows: list[tuple], labels: list[tuple]) -> list[tuple]:
    """Every order applied to every row; rows are (doc_id, text, part)."""
    failing = []
    for doc_id, text, part in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": re.search("[#$%&*|]", text) is not None,
            "E": doc_id is not None and any(
                i is not None and i < doc_id and (t or "") == text for i, t, _ in rows
            ),
        }
        marks = [m for i, *m in labels if doc_id is not None and i == doc_id]
        failing.append((part or "", {f for f in fails if fails[f]}, any(q == 1 for q, _ in marks),
                        any(t == 1 for _, t in marks)))
    out = []
    for name in {p for p, *_ in failing}:
        mine = [f for f in failing if f[0] == name]
        steps, total = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                total[f] += len(gone)
                steps.append((f, (
                    name, "".join(order), step, len(left), len(gone),
                    sum(f in d[1] for d in mine) - len(gone), sum(d[1] == {f} for d in mine),
                    sum(d[2] for d in gone), sum(d[3] for d in gone),
                )))
        out += [(*row, total[f]) for f, row in steps]
    return sorted(out)


def found(df) -> list[tuple]:
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.select(*COLUMNS).collect())


def test_galloping():
    rng = random.Random(13)
    for _ in range(400):
        a, b = (np.array(sorted(rng.sample(range(300), rng.randint(0, 200))), np.int64)
                for _ in range(2))
        place, there = gallop(a, b)
        assert there.tolist() == [x in set(a.tolist()) for x in b.tolist()]
        assert place.tolist() == np.searchsorted(a, b).tolist()
        assert merged(a, b).tolist() == sorted({*a.tolist(), *b.tolist()})
        assert common(a, b) == len({*a.tolist()} & {*b.tolist()})
    ahead = np.arange(10**6, 2 * 10**6)
    assert merged(np.arange(1000), ahead).tolist() == [*range(1000), *range(10**6, 2 * 10**6)]


def test_unions_of_every_subset():
    lists = [np.array(x, np.int64) for x in ([1, 2], [2, 3], [], [9])]
    for subset, union in unions(lists):
        assert union.tolist() == sorted({
            int(x) for i, one in enumerate(lists) if subset >> i & 1 for x in one
        })


def random_rows(rng: random.Random) -> list[tuple]:
    long = " ".join(f"w{i}" for i in range(210))
    texts = [None, "", "A", "a b c", "THE END " * 3, "x#y", long, long + " $", "w " * 300, long.upper()]
    rows = [
        (rng.choice([None, rng.randrange(40)]), rng.choice(texts), rng.choice([None, "", "en", "de"]))
        for _ in range(300)
    ]
    return rows + rows[:20]


def test_against_every_order_applied(spark):
    rng = random.Random(14)
    rows = random_rows(rng)
    labels = [(rng.choice([None, rng.randrange(40)]), rng.choice([0, 1, None]), rng.choice([0, 1, None]))
              for _ in range(40)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(7)
    tags = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    wanted = plain(rows, labels)
    assert found(audit(documents, tags)) == wanted
    assert found(audit(documents, tags, hot_texts=2)) == wanted
    extra = documents.selectExpr("*", "'x' as number", "1 as part", "true as good", "2 as digest",
                                 "'y' as _text", "3 as first", "4 as _id", "5 as A")
    assert found(audit(extra, tags.selectExpr("*", "'z' as good"))) == wanted


def test_odd_rows_and_empty_tables(spark):
    labels = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    odd = odd_documents(spark).withColumnRenamed("source", "lang")
    wanted = plain([tuple(r) for r in odd.collect()], [(1, 1, 1)])
    assert found(audit(odd, labels)) == wanted
    assert found(audit(odd, labels.where("false"))) == plain([tuple(r) for r in odd.collect()], [])
    empty = no_documents(spark).withColumnRenamed("source", "lang")
    assert audit(empty, labels).count() == 0


def test_query_against_its_sql(spark):
    folder = f"{TESTDATA}/sf0.001"
    for name in ("documents", "labels"):
        duckdb.sql(f"create or replace view {name} as select * from '{folder}/{name}.parquet'")
    rows = duckdb.sql(f"select {', '.join(COLUMNS)} from ({LLM_ORACLE['op13_filter_audit']})").fetchall()
    assert found(op13_filter_audit(spark, folder)) == sorted(rows)
