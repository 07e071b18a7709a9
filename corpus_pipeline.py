"""The corpus pipeline: documents in, encoded documents out.

Stages 1 to 4 return the columns they are given, with fewer rows or shorter texts; the last one adds
the ids and the text decoded from them. A null text is judged and kept like an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgauge.llm.common import stored, table
from reelgauge.llm.decontamination import without_benchmark
from reelgauge.llm.ngram_jaccard import one_of_each_group
from reelgauge.llm.quality_classifier import differences, learn, passes
from reelgauge.llm.sentencepiece_codec import encode_decode
from reelgauge.llm.substring_dedup import deduplicated

PIECES = "piece_bpe_32k.model"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier, learnt from the labels, does not reject go on."""
    model = learn(docs, table(spark, sf_dir, "labels"))
    return docs.where(passes(differences(F.col("text"), model.good, model.bad), model))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: five-word n-grams, similarity 0.8, the least id stays."""
    return one_of_each_group(docs, n=5, similarity=(80, 100))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that a smaller id has too go; so does a document of nothing else.

    A text that loses nothing stays as it is; of the others the words left are joined by a blank.
    """
    columns = docs.columns
    own = [f"_own_{i}" for i in range(len(columns))]
    text = own[columns.index("text")]
    found = deduplicated(docs.toDF(*own), text=text, doc_id=own[columns.index("doc_id")])
    left = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col(text))
    return found.where("n_removed = 0 or n_removed < n_words").select(*[
        (left if name == text else F.col(name)).alias(c) for name, c in zip(own, columns)
    ])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item occurs go."""
    return without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept document with its ids and its text decoded from them."""
    return encode_decode(docs, public_tokenizers.path(PIECES))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontaminate", decontaminate),
    ("sentencepiece", encode),
]

# Learning, edit distances and encoding are not expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
