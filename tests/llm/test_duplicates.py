from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelgauge.llm import ngram_jaccard, substring_dedup
from reelgauge.llm.common import stored
from reelgauge.llm.components import components
from reelgauge.llm.ngram_jaccard import bands, linked_documents, one_of_each_group
from reelgauge.llm.substring_dedup import deduplicated
from tests.conftest import plan
from tests.llm.cases import PASSAGE, ROWS, no_documents, odd_documents


def grams(text: str | None, n: int) -> frozenset:
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1)))


def groups(rows: list[tuple], n: int, p: int, q: int) -> list[tuple]:
    """doc_id, set size and least reachable id of every row, all pairs compared."""
    sets = [(d, grams(t, n)) for d, t, *_ in rows]
    parent = {d: d for d, _ in sets if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    posting = defaultdict(list)
    for i, (d, s) in enumerate(sets):
        common = Counter(j for g in s if d is not None for j in posting[g])
        for j, c in common.items():
            if q * c >= p * (len(s) + len(sets[j][1]) - c):
                a, b = sorted((root(d), root(sets[j][0])))
                parent[b] = a
        if d is not None:
            for g in s:
                posting[g].append(i)
    return sorted(
        ((d, len(s), None if d is None else root(d)) for d, s in sets), key=repr
    )


def as_rows(df) -> list[tuple]:
    return sorted(((r[0], r[1], r[2]) for r in df.collect()), key=repr)


def near_copies(seed: int) -> list[tuple[int, str]]:
    rng, rows = random.Random(seed), []
    vocabulary = [f"w{i}" for i in range(5000)]
    for size in (3, 5, 6, 7, 9, 12, 18, 30, 60, 110, 180, 400):
        for _ in range(3):
            base = rng.choices(vocabulary, k=size)
            for _ in range(8):
                copy = list(base)
                for _ in range(rng.randrange(0, 1 + size // 20 + 1)):
                    at = rng.randrange(len(copy))
                    kind = rng.randrange(3)
                    if kind == 0:
                        copy[at] = rng.choice(vocabulary)
                    elif kind == 1:
                        copy.insert(at, rng.choice(vocabulary))
                    elif len(copy) > 1:
                        del copy[at]
                rows.append((len(rows), " ".join(copy)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("n", "p"), [(4, 85), (5, 80), (2, 60)])
def test_links_against_all_pairs(spark, n, p):
    rows = near_copies(n)
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    assert as_rows(linked_documents(documents, n, (p, 100))) == groups(rows, n, p, 100)


def test_families_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_jaccard, "BLOCK_GRAMS", 60)
    monkeypatch.setattr(ngram_jaccard, "PART_SIGNATURES", 100)
    rows = near_copies(9)
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    assert as_rows(linked_documents(documents, 4, (85, 100))) == groups(rows, 4, 85, 100)


def test_links_of_odd_rows(spark):
    documents = odd_documents(spark).withColumns({"key": F.lit(1), "component_id": F.lit("old")})
    assert as_rows(linked_documents(documents, 4, (85, 100))) == groups(ROWS, 4, 85, 100)
    kept = one_of_each_group(documents, 4, (85, 100))
    assert kept.columns == documents.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    assert ids == sorted([1, 3, 4, 5, 6, 8, 8, 9, 11, 12, None, None], key=repr)
    assert linked_documents(no_documents(spark)).count() == 0


def test_bands_cover_every_size_and_keep_the_pigeonhole():
    for p, q in ((85, 100), (80, 100), (1, 2), (95, 100)):
        upto = 0
        for band in bands(p, q, 3000):
            assert band.low == upto + 1
            upto = band.high
            differ = band.high * (q - p) // p
            assert 2 * band.loose + band.strict == differ + 1 + band.slack
            assert band.partner == band.high * q // p
        assert upto >= 3000


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 300), (300, 100), (5, 5), (None, 1)]
    found = components(spark.createDataFrame(chain * 2, "a long, b long"))
    label = {r["node"]: r["label"] for r in found.collect()}
    assert label == {**{i: 0 for i in range(41)}, 100: 100, 200: 100, 300: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def left_over(rows: list[tuple], window: int) -> list[tuple]:
    first: dict[tuple, int] = {}
    for d, text, *_ in rows:
        words = (text or "").encode().split()
        for i in range(len(words) - window + 1):
            if d is not None:
                w = tuple(words[i:i + window])
                first[w] = min(d, first.get(w, d))
    out = []
    for d, text, *_ in rows:
        words = (text or "").encode().split()
        gone = set()
        for i in range(len(words) - window + 1):
            if d is not None and first[tuple(words[i:i + window])] < d:
                gone.update(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
        out.append((d, len(words), len(gone), kept))
    return sorted(out, key=repr)


def cut(documents, **more) -> list[tuple]:
    found = deduplicated(documents, **more).select("doc_id", "n_words", "n_removed", "kept")
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_passages_against_all_windows(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "UNIT_BYTES", 3000)
    monkeypatch.setattr(substring_dedup, "PART_HASHES", 500)
    rng = random.Random(4)
    shared = [[f"s{k}w{rng.randrange(50)}" for _ in range(rng.randint(8, 60))] for k in range(6)]
    rows = []
    for d in range(150):
        words: list[str] = []
        for _ in range(rng.randrange(5)):
            words += [f"u{rng.randrange(9)}" for _ in range(rng.randrange(12))]
            part = rng.choice(shared)
            a = rng.randrange(len(part))
            words += part[a:a + rng.randint(1, 60)]
        rows.append((d * 7 % 150, rng.choice([" ", "\n", "\t\x0b"]).join(words)))
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    assert cut(documents, window=10) == left_over(rows, 10)


def test_passages_of_odd_rows(spark):
    documents = odd_documents(spark).withColumns({"kept": F.lit("old"), "unit": F.lit(1)})
    assert cut(documents) == left_over(ROWS, 50)
    removed = {r[0]: r[2] for r in cut(documents)}
    # "start" before the passage is common to both as well.
    assert removed[10] == 1 + len(PASSAGE.split()) and removed[9] == removed[8] == removed[None] == 0
    assert deduplicated(no_documents(spark)).count() == 0


def test_parities_drop_no_link_and_most_chance_matches():
    rng = random.Random(21)
    texts = []
    for _ in range(60):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([1, 4, 30, 120, 400]))]
        texts.append(" ".join(words))
        for _ in range(2):
            edited = list(words)
            for _ in range(max(1, len(words) // rng.choice([20, 60, 200]))):
                edited[rng.randrange(len(edited))] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(edited))
    sets = ngram_jaccard.Sets([t.encode() for t in texts], 4)
    every = np.arange(len(texts))
    own = [set(sets.gram[a:a + n].tolist()) for a, n in zip(sets.starts, sets.size)]
    for p, q in ((85, 100), (8, 10)):
        compatible = ngram_jaccard.Compatible(sets.size, sets.parities(every), p, q)
        links = kept = 0
        for i in range(len(texts)):
            near = compatible(np.full(len(texts), i), every)
            for j in range(i):
                linked = q * len(own[i] & own[j]) >= p * len(own[i] | own[j])
                assert near[j] or not linked
                links, kept = links + linked, kept + bool(near[j])
        assert links > 20 and kept < 3 * links


def test_ties_connect_what_compatible_pairs_connect():
    rng = np.random.default_rng(4)
    size = rng.integers(20, 30, 40)
    parity = np.zeros((40, ngram_jaccard.PARITY_WORDS), np.uint64)
    for i in range(1, 40):  # a chain: each differs a little from one before it, or wholly
        parity[i] = parity[rng.integers(0, i)]
        for _ in range(4 if i % 5 else 120):
            parity[i, rng.integers(0, 4)] ^= np.uint64(1) << np.uint64(rng.integers(0, 64))
    compatible = ngram_jaccard.Compatible(size, parity, 80, 100)
    label = list(range(40))
    for i in range(40):
        for j in range(i):
            if compatible(np.array([i]), np.array([j]))[0] and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    found = list(range(40))
    for a, b in ngram_jaccard.tied(np.arange(40), compatible):
        old, new = found[b], found[a]
        found = [new if x == old else x for x in found]
    def groups(labels):
        return sorted(sorted(i for i in range(40) if labels[i] == x) for x in set(labels))

    assert groups(found) == groups(label) and len(set(label)) > 3


def test_least_connected():
    rng = np.random.default_rng(0)
    for _ in range(200):
        n, m = rng.integers(1, 60), rng.integers(0, 60)
        a, b = rng.integers(0, n, m), rng.integers(0, n, m)
        label = list(range(n))
        for x, y in zip(a, b):
            p, q = label[x], label[y]
            label = [min(p, q) if one in (p, q) else one for one in label]
        assert ngram_jaccard.least_connected(n, a, b).tolist() == label


def large_texts(seed: int, count: int = 24) -> list[str]:
    """Texts of 1,500 words, unrelated but for a passage of 900 that all share."""
    rng = random.Random(seed)
    shared = " ".join(f"s{rng.randrange(10**6)}" for _ in range(900))
    return [
        shared + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(600)) for _ in range(count)
    ]


def test_large_sets_that_share_a_passage_are_not_tied(spark, monkeypatch):
    ties = []

    def counted(edges):
        ties.append(edges.count())
        return components(edges)

    monkeypatch.setattr(ngram_jaccard, "components", counted)
    texts = large_texts(3)
    texts.append(texts[0] + " one more")
    rows = list(enumerate(texts))
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    assert as_rows(linked_documents(documents, 5, (80, 100))) == groups(rows, 5, 80, 100)
    assert ties[0] == 1


def test_longer_parities_drop_no_link():
    rng, texts = random.Random(8), []
    for size in (200, 260, 300, 520, 700, 1100, 1300, 5000, 9000):
        words = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        for edits in (0, size // 300, size // 150, size // 80):
            edited = list(words)
            for _ in range(edits):
                edited[rng.randrange(size)] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(edited[:size - rng.randrange(size // 20)]))
    texts += large_texts(9, 6)
    sets, every = ngram_jaccard.Sets([t.encode() for t in texts], 5), np.arange(len(texts))
    longer = ngram_jaccard.folded(sets.wide_parities(every), sets.size)
    compatible = ngram_jaccard.Compatible(sets.size, sets.parities(every), 80, 100, longer)
    own = [set(sets.gram[a:a + n].tolist()) for a, n in zip(sets.starts, sets.size)]
    links = kept = 0
    for i in range(len(texts)):
        near = compatible(np.full(len(texts), i), every)
        for j in range(i):
            linked = 100 * len(own[i] & own[j]) >= 80 * len(own[i] | own[j])
            assert near[j] or not linked
            links, kept = links + linked, kept + bool(near[j])
    assert links > 20 and kept < 2 * links


def test_signatures_of_one_set_are_not_shared():
    def sent(tags, twice):
        tags = np.array(tags, np.uint32)
        return len(tags).to_bytes(4, "little") + ngram_jaccard.planes(tags) + np.packbits(twice).tobytes()

    found = ngram_jaccard.is_shared([sent([1, 5, 9], [False, False, True]), sent([5, 7], [False, False])])
    assert [f.tolist() for f in found] == [[False, True, True], [True, False]]


def test_no_text_is_shuffled_to_be_joined(spark, monkeypatch):
    plans, held = [], spark.conf.get("spark.sql.autoBroadcastJoinThreshold")

    def seen(edges):
        plans.append(plan(edges))
        return components(edges)

    def kept(df, name):
        plans.append(plan(df))
        return stored(df, name)

    monkeypatch.setattr(ngram_jaccard, "components", seen)
    monkeypatch.setattr(ngram_jaccard, "stored", kept)
    rng = random.Random(13)
    rows = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(12))) for i in range(6000)]
    rows += [(len(rows) + i, text + " more") for i, (_, text) in enumerate(rows[:600])]
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")
    try:
        found = linked_documents(documents, 4, (85, 100)).where("component_id <> doc_id").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert sorted((r[0], r[2]) for r in found) == [(6000 + i, i) for i in range(600)]
    assert not [p for p in plans if "hashpartitioning(doc_id" in p]
    assert not [p for p in plans if re.search(r"SortMergeJoin \[unit#\d+L?\], ", p)]
    assert [p for p in plans if re.search(r"BroadcastHashJoin \[unit#\d+L?\], ", p)]
