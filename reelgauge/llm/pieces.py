"""A SentencePiece BPE vocabulary: its pieces, its merges, and what its merges cannot cross.

The library's white space rule is applied by the callers: a blank is the mark ``▁``, and one mark
is put in front of a text that is not empty. Three facts, checked or gathered when a model is loaded, cut a
text into parts that can be encoded alone:

* no piece has a mark after another character, so no merge crosses from a word into the mark of
  the next one;
* two characters that stand side by side in no piece are never merged across;
* pieces of several marks hold nothing else and have the lowest score, so runs of marks are merged
  last, among themselves.
"""

from __future__ import annotations

import heapq

import sentencepiece

MARK = "▁"
NEVER = float("inf")


class Pieces:
    """Vocabulary of one model. Built once per Python worker from the model's bytes."""

    def __init__(self, model: bytes):
        library = self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = library.get_piece_size()
        self.text = [library.id_to_piece(i) for i in range(size)]
        self.bytes_from = self.text.index("<0x00>")
        reserved = {
            i for i in range(size)
            if library.is_byte(i) or library.is_control(i) or library.is_unknown(i)
        }
        if sum(library.is_byte(i) for i in reserved) != 256:
            raise ValueError("a model with byte fallback is needed")
        self.reserved = reserved
        own = [i for i in range(size) if i not in reserved]
        marks = [i for i in own if set(self.text[i]) == {MARK}]
        self.marks = {self.text[i]: -library.get_score(i) for i in marks}
        self.mark_id = {self.text[i]: i for i in marks}
        merged = [i for i in own if len(self.text[i]) == 1 or i not in marks]
        self.id = {self.text[i]: i for i in merged}
        # The lower the rank, the earlier a pair is merged.
        self.rank = {self.text[i]: -library.get_score(i) for i in merged}
        self.runs: dict[int, list[int]] = {}
        self._check(library, merged)
        self.adjacent = {piece[k:k + 2] for piece in self.rank for k in range(len(piece) - 1)}

    def _check(self, library, merged: list[int]) -> None:
        if any(MARK in piece.lstrip(MARK) or piece.startswith(MARK * 2) for piece in self.id):
            raise ValueError("a piece has a mark behind another character")
        normal = [self.rank[self.text[i]] for i in merged if len(self.text[i]) > 1]
        runs = [s for piece, s in self.marks.items() if len(piece) > 1]
        if len(set(normal)) < len(normal) or (runs and min(runs) <= max(normal)):
            raise ValueError("two pieces share a score")
        if library.normalize("  Aä① ") != MARK + "  Aä① ".replace(" ", MARK):
            raise ValueError("a model without normalisation is needed")

    def merge(self, part: str) -> list[str]:
        """The symbols that are left of a part when nothing can be merged any more.

        Of all neighbours that form a piece, those with the lowest rank are merged first, and of
        equal ones the leftmost.
        """
        if len(part) > 48:
            return merge_long(part, self.rank)
        symbols, rank = list(part), self.rank.get
        pairs = [rank(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]
        while pairs and (best := min(pairs)) < NEVER:
            at = pairs.index(best)
            joined = symbols[at] + symbols[at + 1]
            symbols[at:at + 2] = [joined]
            del pairs[at]
            if at:
                pairs[at - 1] = rank(symbols[at - 1] + joined, NEVER)
            if at < len(pairs):
                pairs[at] = rank(joined + symbols[at + 1], NEVER)
        return symbols

    def cut(self, part: str) -> list[str]:
        """A part cut at the places that no merge crosses."""
        adjacent = self.adjacent
        cuts = [k for k in range(1, len(part)) if part[k - 1:k + 1] not in adjacent]
        return [part[a:b] for a, b in zip([0, *cuts], [*cuts, len(part)])]

    def ids(self, symbol: str) -> list[int]:
        """One id, or the ids of the bytes of a character the vocabulary lacks."""
        found = self.id.get(symbol)
        if found is not None:
            return [found]
        return [self.bytes_from + b for b in symbol.encode("utf-8")]

    def run_ids(self, marks: int) -> list[int]:
        """The ids of a run of marks."""
        if marks not in self.runs:
            if len(self.runs) > 1000:
                self.runs.clear()
            self.runs[marks] = [self.mark_id[s] for s in merge_long(MARK * marks, self.marks)]
        return self.runs[marks]

    def whole_words(self) -> list[str]:
        """Words (without the mark before them) that the model encodes as one token.

        Proved for each by merging it alone; by the first fact above the same holds in any text.
        """
        words = (p[1:] for p in self.id if p.startswith(MARK) and len(p) > 1)
        return [w for w in words if self.merge(MARK + w) == [MARK + w]]


def merge_long(part: str, rank: dict[str, float]) -> list[str]:
    """``Pieces.merge`` with a heap, in n log n steps, for parts without any blank."""
    symbols: list[str | None] = list(part)
    n = len(symbols)
    left, right = list(range(-1, n - 1)), [*range(1, n), -1]
    heap: list[tuple[float, int, int, int]] = []

    def offer(a: int, b: int) -> None:
        if a >= 0 and b >= 0 and (s := rank.get(symbols[a] + symbols[b])) is not None:
            heapq.heappush(heap, (s, a, b, len(symbols[a]) + len(symbols[b])))

    for i in range(n - 1):
        offer(i, i + 1)
    while heap:
        _, a, b, size = heapq.heappop(heap)
        if symbols[a] is None or symbols[b] is None or right[a] != b:
            continue
        if len(symbols[a]) + len(symbols[b]) != size:
            continue
        symbols[a], symbols[b] = symbols[a] + symbols[b], None
        right[a] = right[b]
        if right[b] >= 0:
            left[right[b]] = a
        offer(left[a], a)
        offer(a, right[a])
    return [s for s in symbols if s is not None]


def text_words(text: str) -> list[str]:
    """The words of a text, each standing for a mark and what follows up to the next mark.

    An empty word is a mark followed by another mark, or by the end of the text.
    """
    return text.replace(MARK, " ").split(" ") if text else []
