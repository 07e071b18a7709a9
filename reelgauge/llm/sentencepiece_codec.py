"""SentencePiece BPE encoding by backtracking over longest matches, and decoding.

A sequence of tokens is what the merges make of a text exactly if each token is what they make of
its own string and each two neighbours are what they make of the two strings put together. So a
part is encoded from the left: the longest piece that starts at the position (found by an
Aho-Corasick automaton) is tried first, then its shorter prefixes; a piece is taken if
merging it together with the token before it gives these two tokens again. When no piece fits,
the position is marked as failed in a bit field and the token before it is given up.
"""

from __future__ import annotations

from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelgauge.llm.common import python_tasks, long_lists
from reelgauge.llm.pieces import MARK, NEVER, Pieces, text_words
from reelgauge.llm.token_counts import read_model

# Words, parts of words, and pairs of tokens that a worker remembers.
REMEMBERED_WORDS = 200_000
REMEMBERED_PARTS = 400_000
REMEMBERED_PAIRS = 400_000
LONGEST_REMEMBERED = 64


class Memory(dict):
    """A bounded table. When it is full it becomes the old one, from which what recurs is taken."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.old = most, {}

    def keep(self, text: str, ids: bytes) -> None:
        if len(text) <= LONGEST_REMEMBERED:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[text] = ids


class Codec(Memory):
    """Ids per word, as the bytes of 32-bit numbers; filled as words occur."""

    def __init__(self, model: bytes):
        super().__init__(REMEMBERED_WORDS)
        pieces = self.pieces = Pieces(model)
        proper = [p for p in pieces.id if pieces.merge(p) == [p]]
        self.matches = ahocorasick.Automaton()
        for p in proper:
            self.matches.add_word(p, pieces.id[p])
        self.matches.make_automaton()
        self.size = list(map(len, pieces.text))
        known = {p: pieces.id[p] for p in proper}
        # The next shorter token that starts like a token; -1 if there is none.
        self.shorter = [-1] * len(pieces.text)
        for p, i in known.items():
            starts = (known[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in known)
            self.shorter[i] = next(starts, -1)
        self.spines = {i: s for p, i in known.items() if (s := self._spines(p))}
        self.fits: dict[int, bool] = {}
        self.parts = Memory(REMEMBERED_PARTS)
        self.surface = [
            bytes([i - pieces.bytes_from]) if 0 <= i - pieces.bytes_from < 256
            else b"" if i in pieces.reserved else t.replace(MARK, " ").encode("utf-8")
            for i, t in enumerate(pieces.text)
        ]
        unknown = [i for i in pieces.reserved if pieces.text[i] == "<unk>"]
        for i in unknown:
            self.surface[i] = " ⁇ ".encode()

    # -- encoding ---------------------------------------------------------------------------

    def _spines(self, piece: str) -> tuple | None:
        """What stands at the left and at the right end of a piece while it is being merged.

        Each entry is a symbol and the rank of the merge that takes it in. None if the merges of
        the piece do not come in the order of their ranks.
        """
        symbols, rank, left, right, last = list(piece), self.pieces.rank, [], [], -NEVER
        while len(symbols) > 1:
            pairs = [rank.get(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]
            at = pairs.index(min(pairs))
            if pairs[at] < last:
                return None
            last = pairs[at]
            if at == 0:
                left.append((symbols[0], last))
            if at == len(pairs) - 1:
                right.append((symbols[-1], last))
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
        return [*left, (piece, NEVER)], [*right, (piece, NEVER)]

    def _neighbours(self, a: int, b: int) -> bool:
        """Merging the strings of both tokens together gives both again.

        Merged again is what stands at the boundary: nothing may be merged across it before the
        symbols on its two sides are taken in by the merges of their own tokens. Of equal ranks
        the leftmost comes first.
        """
        if a not in self.spines or b not in self.spines:
            x, y = self.pieces.text[a], self.pieces.text[b]
            return self.pieces.merge(x + y) == [x, y]
        ends, starts, rank = self.spines[a][1], self.spines[b][0], self.pieces.rank.get
        i = j = 0
        while True:
            (x, until_x), (y, until_y) = ends[i], starts[j]
            across = rank(x + y, NEVER)
            if across < until_x and across <= until_y:
                return False
            if until_x == until_y == NEVER:
                return True
            if until_x <= until_y:
                i += 1
            else:
                j += 1

    def tokens(self, part: str) -> list[int]:
        """The ids of a part that no piece is cut out of; it has no run of marks."""
        if len(part) == 1:
            return self.pieces.ids(part)
        size, shorter, fits = self.size, self.shorter, self.fits
        # The longest tokens one after the other; most parts need no others.
        longest = {end + 1 - size[t]: t for end, t in self.matches.iter_long(part)}
        stop = len(part)
        failed = 0  # bit k: nothing fits from place k on
        found: list[int] = []
        pos, before, token = 0, -1, longest[0]
        while pos < stop:
            while token >= 0:
                end = pos + size[token]
                if not failed >> end & 1:
                    if before < 0:
                        break
                    fit = fits.get(before << 32 | token)
                    if fit is None:
                        if len(fits) > REMEMBERED_PAIRS:
                            fits.clear()
                        fit = fits[before << 32 | token] = self._neighbours(before, token)
                    if fit:
                        break
                token = shorter[token]
            if token >= 0:
                found.append(token)
                pos, before = end, token
                if pos < stop:
                    token = longest.get(pos, -1)
                    if token < 0:
                        token = longest[pos] = next(self.matches.iter_long(part, pos))[1]
                continue
            if not found:
                raise ValueError("the vocabulary has no tokens for a part")
            failed |= 1 << pos
            token = found.pop()
            before = found[-1] if found else -1
            pos -= size[token]
        return found

    def _part(self, part: str) -> bytes:
        """The ids of a part between two places that no merge crosses."""
        ids = self.parts.get(part)
        if ids is None:
            ids = self.parts.old.get(part) or array("i", self.tokens(part)).tobytes()
            self.parts.keep(part, ids)
        return ids

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = b"".join(map(self._part, self.pieces.cut(MARK + word)))
        self.keep(word, ids)
        return ids

    def encode(self, text: str) -> bytes:
        """The ids of a text, as the bytes of 32-bit numbers."""
        words = text_words(text)
        if "" not in words:
            return b"".join(map(self.__getitem__, words))
        mark = np.int32(self.pieces.id[MARK]).tobytes()
        out, marks = [], 0
        for word in words:
            if word == "":
                marks += 1
                continue
            ids = self[word]
            if marks:
                # A word whose mark stays alone lends it to the run of marks before it.
                if ids.startswith(mark):
                    marks, ids = marks + 1, ids[4:]
                out.append(np.array(self.pieces.run_ids(marks), np.int32).tobytes())
                marks = 0
            out.append(ids)
        out.append(np.array(self.pieces.run_ids(marks), np.int32).tobytes())
        return b"".join(out)

    # -- decoding ---------------------------------------------------------------------------

    def decode(self, ids: list[int]) -> str:
        """The text of ids; one blank at the very start is the mark put there by encoding."""
        data = b"".join(map(self.surface.__getitem__, ids))
        first = next((i for i in ids if self.surface[i]), None)
        if first is not None and self.pieces.text[first].startswith(MARK):
            data = data[1:]
        try:
            return data.decode("utf-8")
        except UnicodeDecodeError:
            return broken_utf8(data)


def broken_utf8(data: bytes) -> str:
    """Like the library: each byte that belongs to no character becomes U+FFFD."""
    out, at = [], 0
    while at < len(data):
        size = next((k for k in (1, 2, 3, 4) if valid(data[at:at + k], k)), 0)
        out.append(data[at:at + size].decode("utf-8") if size else "�")
        at += size or 1
    return "".join(out)


def valid(data: bytes, size: int) -> bool:
    try:
        return len(data) == size and len(data.decode("utf-8")) == 1
    except UnicodeDecodeError:
        return False


@lru_cache(maxsize=2)
def codec(model: bytes) -> Codec:
    return Codec(model)


def encoded(text: Column, model: bytes) -> Column:
    """Ids of a text column; null and empty texts have none."""

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        encode = codec(model).encode
        parts = [encode(t) if t else b"" for t in texts.to_pylist()]
        counts = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        return long_lists(b"".join(parts), counts)

    return ids(text)


def decoded(ids: Column, model: bytes) -> Column:
    """Text of a column of ids; null ids give the empty text."""

    @F.arrow_udf("string")
    def texts(lists: pa.Array) -> pa.Array:
        decode = codec(model).decode
        # From one buffer, as Arrow takes many times longer to turn lists into Python's; a text at a
        # time, as a number in a list takes eight times the room it has in the buffer.
        every = np.asarray(lists.flatten())
        ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0)).tolist()
        parts = (every[a:b].tolist() for a, b in zip([0, *ends], ends))
        return pa.array([decode(ids) if ids else "" for ids in parts], pa.string())

    return texts(ids)


def encode_decode(documents: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """``documents`` with ``ids`` (as the library gives them, no begin or end) and ``decoded``.

    One row in, one row out, no shuffle. A null or empty text has no ids and decodes to the empty
    text; very long texts are encoded whole; repeated rows are encoded each; an empty table gives an
    empty table; input columns named like a result are replaced.
    """
    python_tasks(documents.sparkSession)
    model = read_model(model_path)
    return (
        documents.withColumn("ids", encoded(F.col(text), model))
        .withColumn("decoded", decoded(F.col("ids"), model))
    )
