"""Token counts with a shortcut for words that are one token.

Offline, before any text is read, every vocabulary string is proved or disproved to encode alone
as one token. Words of that set are counted directly; only the others are given to the library to be
merged, each distinct one once per worker as long as the worker's table has room.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelgauge.llm.common import python_tasks
from reelgauge.llm.pieces import MARK, Pieces, text_words

# Merged words a worker remembers; beyond that its table starts anew.
REMEMBERED = 400_000
# Longer words are merged each time they occur.
LONGEST_REMEMBERED = 64


class Counter(dict):
    """Tokens per word. Whole words are in it from the start, the others come in as they occur."""

    def __init__(self, model: bytes, shortcut: bool = True):
        self.pieces = Pieces(model)
        self.whole = dict.fromkeys(self.pieces.whole_words(), 1) if shortcut else {}
        super().__init__(self.whole)

    def __missing__(self, word: str) -> int:
        # The library puts the mark in front of the word itself.
        count = len(self.pieces.library.encode(word))
        if len(word) <= LONGEST_REMEMBERED:
            if len(self) > REMEMBERED + len(self.whole):
                self.clear()
                self.update(self.whole)
            self[word] = count
        return count

    def count(self, text: str) -> int:
        words = text_words(text)
        if "" not in words:
            return sum(map(self.__getitem__, words))
        total = marks = 0
        for word in words:
            if word == "":
                marks += 1
                continue
            if marks:
                # A word whose mark stays alone lends it to the run of marks before it.
                lone = self.pieces.merge(MARK + word)[0] == MARK
                total += len(self.pieces.run_ids(marks + lone)) - lone
                marks = 0
            total += self[word]
        return total + len(self.pieces.run_ids(marks))


@lru_cache(maxsize=2)
def counter(model: bytes) -> Counter:
    return Counter(model)


def read_model(path: str) -> bytes:
    """A model file of this machine, half a megabyte; tasks get its bytes, not its path."""
    with open(path, "rb") as file:
        return file.read()


def token_count(text: Column, model: bytes) -> Column:
    """Number of tokens of a text column. Null counts as the empty text, which has none."""

    @F.arrow_udf("long")
    def counted(texts: pa.Array) -> pa.Array:
        count = counter(model).count
        return pa.array([count(t) if t else 0 for t in texts.to_pylist()], pa.int64())

    return counted(text)


def token_counts(
    documents: DataFrame, model_path: str, text: str = "text", limit: int = 4096,
) -> DataFrame:
    """``documents`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit``).

    One row in, one row out, no shuffle. A null text has 0 bytes and 0 tokens; an empty table gives
    an empty table; repeated rows are counted each; input columns named like a result are replaced.
    """
    python_tasks(documents.sparkSession)
    model = read_model(model_path)
    n_bytes = F.coalesce(F.octet_length(text).cast("long"), F.lit(0).cast("long"))
    return (
        documents.withColumns({"n_tokens": token_count(F.col(text), model), "n_bytes": n_bytes})
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
