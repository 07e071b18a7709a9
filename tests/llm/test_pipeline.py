from __future__ import annotations

import corpus_pipeline
import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

from tests.llm.cases import PASSAGE, no_documents, odd_documents

FOLDER = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_on_the_table(spark):
    from tests.llm.test_duplicates import groups, left_over

    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "repeated_passages", "decontaminate", "sentencepiece"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    library = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model")
    )
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        rows = out.collect()
        after = {r["doc_id"]: r["text"] for r in rows}
        assert len(after) == len(rows) and set(after) <= set(before)
        if name != "sentencepiece":
            assert out.columns == COLUMNS
        if name == "quality":
            good = [d for d in before if labels.get(d) == 1]
            assert sum(d in after for d in good) > 0.99 * len(good)
            assert len(after) < len(before)
        if name == "near_duplicates":
            assert set(after) == {d for d, _, c in groups(sorted(before.items()), 5, 80, 100) if d == c}
        if name == "repeated_passages":
            for d, words, gone, kept in left_over(sorted(before.items()), 50):
                assert (d in after) == (gone == 0 or gone < words)
                if d in after:
                    assert after[d] == (kept if gone else before[d])
        if name == "sentencepiece":
            assert set(after) == set(before)
            assert all(r["ids"] == library.encode(r["text"]) for r in rows)
            assert all(r["decoded"] == library.decode(r["ids"]) for r in rows)
        docs = spark.createDataFrame([tuple(r) for r in rows], out.schema)
        before = after


def test_stages_on_odd_rows(spark):
    clashing = {c: F.lit("old") for c in ("ids", "kept", "n_words", "key", "component_id", "matches")}
    docs = odd_documents(spark).withColumns(clashing)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).columns == docs.columns, name
    near = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, FOLDER).collect()}
    assert 1 in near and 2 not in near and 9 in near and 10 not in near
    cut = {r["doc_id"]: r["text"] for r in corpus_pipeline.repeated_passages(spark, docs, FOLDER).collect()}
    assert cut[10] == "another other end" and PASSAGE in cut[9]
    assert 3 in cut and cut[3] is None and cut[5] == " \t\n "
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_documents(spark), FOLDER).count() == 0


def test_run_gives_the_last_stage(spark):
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert found.columns == [*COLUMNS, "ids", "decoded"]
    assert 0 < found.count() < 200


def test_decontaminate_against_the_plain_table(spark):
    from reelgauge.llm.decontamination import budget, units

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("length(text) <= 800")
    texts = [(r["doc_id"], units(r["text"])) for r in docs.collect()]
    items = [r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    # The plain table of all texts at once, one after the other; nothing carries over to the next.
    first = np.cumsum([0, *(len(t) + 1 for _, t in texts)])[:-1]
    chars = np.concatenate([np.r_[-1, t.astype(np.int64)] for _, t in texts])
    shift = np.arange(len(chars)) + (1 << 20) * np.searchsorted(first, np.arange(len(chars)), "right")
    dirty = np.zeros(len(texts), bool)
    for item in items:
        row = np.zeros(len(chars), np.int64)
        for i, char in enumerate(units(item)):
            new = np.minimum(row + 1, np.r_[0, row[:-1]] + (chars != char))
            new[first] = i + 1
            row = np.minimum.accumulate(new - shift) + shift
        dirty |= np.minimum.reduceat(row, first) <= budget(len(units(item)))
    expected = {d for (d, _), gone in zip(texts, dirty) if not gone}
    assert 0 < len(expected) < len(texts)
    kept = corpus_pipeline.decontaminate(spark, docs, FOLDER).collect()
    assert {r["doc_id"] for r in kept} == expected and len(kept) == len(expected)
