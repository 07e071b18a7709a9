"""Benchmark items in documents, by the q-gram lemma and banded alignment.

An item of m characters that occurs with at most k edits shares at least m - q + 1 - k q of its
character q-grams with the document, and all of them lie on diagonals (place in the document minus
place in the item) that differ by at most 2 k. So shared q-grams are counted in overlapping bands
of diagonals; bands that reach the bound are aligned within the band.

Compared is what readers would call the same text: letters without regard to case, any white space
as a blank. Both are done character by character, so that places stay those of the text.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelgauge.llm.common import python_tasks, stored

Q = 8
EDIT_RATE = 0.08
# Benchmark text that goes to the tasks at once; a larger benchmark takes several passes.
BLOCK_BYTES = 8 << 20
# Characters a task searches at once: their q-grams take some fifty times as many bytes.
PIECE = 1 << 20
BITS = 22
SEPARATOR = 0xFFFF

MATCHES = "array<struct<item_id:bigint,start:bigint,stop:bigint,edits:int>>"


@lru_cache(maxsize=1)
def folded() -> np.ndarray:
    """Per UTF-16 unit the unit it is compared as."""
    table = np.arange(1 << 16, dtype=np.uint16)
    for code in range(1 << 16):
        if 0xD800 <= code < 0xE000:
            continue
        char = chr(code)
        lower = char.lower()
        if char.isspace():
            table[code] = 32
        elif len(lower) == 1 and ord(lower) < 1 << 16:
            table[code] = ord(lower)
    return table


def units(text: str) -> np.ndarray:
    return folded()[np.frombuffer(text.encode("utf-16-le", "surrogatepass"), np.uint16)]


def qgrams(codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the eight units from each place on."""
    n = len(codes) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    data = np.ascontiguousarray(codes)
    four = np.ndarray((n + 4,), "<u8", data, strides=(2,))
    mixed = four[:n] * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed += four[4:]
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed


def budget(size: int, rate: float = EDIT_RATE) -> int:
    """Edits allowed for an item, so few that the q-gram bound stays positive."""
    return max(0, min(math.floor(rate * size), (size - Q) // Q))


def windows(codes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the ``size`` units, fewer than eight, from each place on."""
    n = len(codes) - size + 1
    out = np.zeros(max(0, n), np.uint64)
    for i in range(size if n > 0 else 0):
        out = out * np.uint64(0x9E3779B97F4A7C15) + codes[i:i + n] + np.uint64(1)
    return out


@dataclass
class Short:
    """Items of fewer than eight units, which have no q-gram: they have to occur as they are, as
    whole words, for a few letters occur within words everywhere."""

    by_size: dict[int, tuple[np.ndarray, list[tuple]]]

    @staticmethod
    def build(items: list[tuple]) -> Short:
        sizes: dict[int, dict] = {}
        for item_id, codes in items:
            key = int(windows(codes, len(codes))[0])
            sizes.setdefault(len(codes), {}).setdefault((key, codes.tobytes()), []).append(item_id)
        return Short({
            size: (np.unique(np.array([k for k, _ in found], np.uint64)), found)
            for size, found in sizes.items()
        })

    def find(self, codes: np.ndarray):
        """Yields item, start and stop."""
        for size, (keys, items) in self.by_size.items():
            hashes = windows(codes, size)
            for start in np.flatnonzero(np.isin(hashes, keys)).tolist():
                stop = start + size
                around = [codes[i] for i in (start - 1, stop) if 0 <= i < len(codes)]
                if any(chr(c).isalnum() for c in around):
                    continue
                for item_id in items.get((int(hashes[start]), codes[start:stop].tobytes()), ()):
                    yield item_id, start, stop


@dataclass
class Index:
    """The q-grams of some benchmark items."""

    ids: list
    items: list[np.ndarray]
    budgets: np.ndarray
    widths: np.ndarray
    needed: np.ndarray
    codes: np.ndarray
    starts: np.ndarray
    item: np.ndarray
    place: np.ndarray
    seen: np.ndarray
    short: Short

    @staticmethod
    def build(rows: tuple[tuple[int | None, str], ...], rate: float) -> Index:
        ids, items, short = [], [], []
        for item_id, text in rows:
            codes = units(text.strip())
            if len(codes) >= Q:
                ids.append(item_id)
                items.append(codes)
            elif len(codes):
                short.append((item_id, codes))
        sizes = np.array([len(x) for x in items], np.int64)
        budgets = np.array([budget(int(n), rate) for n in sizes], np.int64)
        grams = [qgrams(x) for x in items]
        code = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(items)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, int)
        order = np.argsort(code, kind="stable")
        codes, starts = np.unique(code[order], return_index=True)
        seen = np.zeros(1 << BITS, bool)
        seen[(codes >> np.uint64(64 - BITS)).astype(np.int64)] = True
        return Index(
            ids, items, budgets, 2 * budgets + 1, sizes - Q + 1 - budgets * Q, codes,
            np.append(starts, len(code)), item[order], place[order], seen, Short.build(short),
        )

    def candidates(self, codes: np.ndarray) -> list[tuple[int, int, int]]:
        """Items with the first and last diagonal of the bands that reach the bound."""
        grams = qgrams(codes)
        at = np.flatnonzero(self.seen[(grams >> np.uint64(64 - BITS)).astype(np.int64)])
        if not len(at) or not len(self.codes):
            return []
        grams = grams[at]
        found = np.searchsorted(self.codes, grams)
        found[found == len(self.codes)] = 0
        hit = self.codes[found] == grams
        at, found = at[hit], found[hit]
        first, count = self.starts[found], self.starts[found + 1] - self.starts[found]
        total = int(count.sum())
        if not total:
            return []
        ends = np.cumsum(count)
        posting = np.arange(total) - np.repeat(ends - count, count) + np.repeat(first, count)
        item = self.item[posting]
        diagonal = np.repeat(at, count) - self.place[posting]
        # Bands overlap by half: a band is two neighbouring strips, each as wide as a match needs.
        strip = diagonal // self.widths[item]
        span = int(strip.max() - strip.min()) + 3
        low = int(strip.min())
        keys, counts = np.unique(item * span + (strip - low + 1), return_counts=True)
        n = dict(zip(keys.tolist(), counts.tolist()))
        out: list[tuple[int, int, int]] = []
        for key in sorted(n):
            which, s = divmod(key, span)
            both = max(n[key] + n.get(key + 1, 0), n[key] + n.get(key - 1, 0))
            if both < self.needed[which]:
                continue
            width = int(self.widths[which])
            left = (s + low - 1 - (n[key] + n.get(key - 1, 0) >= self.needed[which])) * width
            right = (s + low - 1 + (n[key] + n.get(key + 1, 0) >= self.needed[which]) + 1) * width - 1
            if out and out[-1][0] == which and left <= out[-1][2] + 1:
                out[-1] = (which, out[-1][1], max(right, out[-1][2]))
            else:
                out.append((which, left, right))
        return out


def aligned(item: np.ndarray, text: np.ndarray, low: int, high: int, most: int):
    """Occurrences of an item on the diagonals ``low`` to ``high`` of a text, by banded alignment.

    Yields (edits, stop) of the best end of each run of ends within the budget.
    """
    width, n = high - low + 1, len(text)
    steps = np.arange(width, dtype=np.int32)
    far = np.int32(1 << 20)
    padded = np.full(width + len(item) + 1, SEPARATOR, np.uint16)
    a, b = max(0, low), min(n, low + len(padded))
    if b > a:
        padded[a - low:b - low] = text[a:b]
    places = low + steps
    row = np.where((places >= 0) & (places <= n), 0, far).astype(np.int32)
    for i, char in enumerate(item):
        new = row + (padded[i:i + width] != char)
        np.minimum(new[:-1], row[1:] + 1, out=new[:-1])
        places = low + i + 1 + steps
        new[(places < 0) | (places > n)] = far
        row = np.minimum.accumulate(new - steps) + steps
        if row.min() > most:
            return
    good = np.flatnonzero(row <= most)
    for run in np.split(good, np.flatnonzero(np.diff(good) > 1) + 1):
        if len(run):
            best = run[int(np.argmin(row[run]))]
            yield int(row[best]), int(low + len(item) + best)


def start_of(item: np.ndarray, text: np.ndarray, stop: int, edits: int) -> int:
    """Where the occurrence that ends at ``stop`` begins: the same alignment from its end on."""
    size = min(stop, len(item) + edits)
    back = text[stop - size:stop][::-1]
    before = np.arange(size + 1, dtype=np.int32)
    row, steps = before.copy(), before
    for i, char in enumerate(item[::-1]):
        new = np.empty_like(row)
        new[0] = i + 1
        new[1:] = np.minimum(row[:-1] + (back != char), row[1:] + 1)
        row = np.minimum.accumulate(new - steps) + steps
    return stop - int(np.flatnonzero(row == row.min())[-1])


@lru_cache(maxsize=4)
def index(rows: tuple, rate: float) -> Index:
    return Index.build(rows, rate)


def find_items(texts: list[str | None], built: Index) -> list[list[dict]]:
    """The matches of each text: one per place where an item occurs within its budget."""
    out: list[list[dict]] = [[] for _ in texts]
    parts, starts, at = [], [], 0
    gap = np.full(Q, SEPARATOR, np.uint16)
    for text in texts:
        codes = units(text) if text else np.zeros(0, np.uint16)
        starts.append(at)
        parts += [codes, gap]
        at += len(codes) + Q
    whole = np.concatenate(parts) if parts else np.zeros(0, np.uint16)
    starts.append(at)
    bounds = np.array(starts)
    for which, low, high in built.candidates(whole):
        item, most = built.items[which], int(built.budgets[which])
        low, high = low - most, high + most
        first = max(0, int(np.searchsorted(bounds, max(0, low), side="right")) - 1)
        last = min(len(texts) - 1, int(np.searchsorted(bounds, high + len(item), side="right")) - 1)
        for k in range(first, last + 1):
            begin, end = int(bounds[k]), int(bounds[k + 1]) - Q
            codes = whole[begin:end]
            for edits, stop in aligned(item, codes, low - begin, high - begin, most):
                start = start_of(item, codes, stop, edits)
                match = {"item_id": built.ids[which], "start": start, "stop": stop, "edits": edits}
                if match not in out[k]:
                    out[k].append(match)
    for item_id, start, stop in built.short.find(whole):
        k = int(np.searchsorted(bounds, start, side="right")) - 1
        begin = int(bounds[k])
        out[k].append({"item_id": item_id, "start": start - begin, "stop": stop - begin, "edits": 0})
    for text, found in zip(texts, out):
        if found and any(ord(c) > 0xFFFF for c in text):
            data = text.encode("utf-16-le", "surrogatepass")
            for match in found:  # places in characters instead of units
                for side in ("start", "stop"):
                    match[side] = len(data[:2 * match[side]].decode("utf-16-le", "replace"))
        found.sort(key=lambda m: (m["start"], m["stop"], m["item_id"] is None, m["item_id"] or 0))
    return out


def pieces(texts: list[str | None]):
    """Texts in slices of about ``PIECE`` characters; a longer text is a slice of its own."""
    first = size = 0
    for at, text in enumerate(texts):
        size += len(text or "")
        if size >= PIECE:
            yield texts[first:at + 1]
            first, size = at + 1, 0
    if first < len(texts):
        yield texts[first:]


def matches(text: Column, rows: tuple, rate: float) -> Column:
    @F.arrow_udf(MATCHES)
    def found(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([
            ("item_id", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()),
            ("edits", pa.int32()),
        ]))
        found, every = [], texts.to_pylist()
        for piece in pieces(every):
            found += find_items(piece, index(rows, rate))
        return pa.array(found, kind)

    return found(text)


def block_rows(items: DataFrame) -> tuple:
    return tuple((r["item_id"], r["text"]) for r in items.orderBy("item_id", "text").collect())


def benchmark_matches(
    documents: DataFrame, benchmark: DataFrame, rate: float = EDIT_RATE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``documents`` with ``matches``: item, start and stop (in characters), edits of each place.

    An item matches where a passage of the text is at most ``rate`` of its length away in edits (no
    more than ``budget`` allows); one of fewer than 8 characters where it occurs without edits as
    whole words. The benchmark goes to the tasks in blocks of ``block_bytes``. With one block there
    is no shuffle; with more, one block after the other is fetched and sent, its finds are written,
    and the finds of all blocks are put together per row. Null and empty texts, and all texts against
    an empty benchmark, have no match; very long texts are searched whole; repeated rows are searched
    each; an empty table gives an empty table; an input column named ``matches`` is replaced.
    """
    python_tasks(documents.sparkSession)
    items = benchmark.where(F.length(F.trim("text")) > 0).select(
        F.col("item_id").cast("long").alias("item_id"), "text"
    ).distinct()
    size = items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = -(-size // block_bytes)
    if blocks <= 1:
        return documents.withColumn("matches", matches(F.col("text"), block_rows(items), rate))
    numbered = stored(
        documents.drop("matches").withColumn("_row_number", F.monotonically_increasing_id()), "numbered"
    )
    block, found = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)), None
    for k in range(blocks):
        here = matches(F.col("text"), block_rows(items.where(block == k)), rate)
        part = stored(numbered.select("_row_number", F.explode(here).alias("match")), "found")
        found = part if found is None else found.unionByName(part)
    in_order = F.array_sort("all", lambda a, b: F.when(_place(a) < _place(b), -1).otherwise(1))
    grouped = found.groupBy("_row_number").agg(F.collect_list("match").alias("all")).select(
        "_row_number", in_order.alias("matches")
    )
    none = F.array().cast(MATCHES)
    return numbered.join(grouped, "_row_number", "left").withColumn(
        "matches", F.coalesce("matches", none)
    ).drop("_row_number")


def _place(match: Column) -> Column:
    """Order of matches: by place, then item, those without a number last."""
    return F.struct(
        match["start"], match["stop"], match["item_id"].isNull(), F.coalesce(match["item_id"], F.lit(0))
    )


def without_benchmark(
    documents: DataFrame, benchmark: DataFrame, rate: float = EDIT_RATE,
) -> DataFrame:
    """The documents in which no benchmark item occurs, with their own columns."""
    columns = documents.columns
    wide = documents.withColumns({f"_own_{i}": F.col(c) for i, c in enumerate(columns)})
    kept = benchmark_matches(wide, benchmark, rate).where(F.size("matches") == 0)
    return kept.select(*[F.col(f"_own_{i}").alias(c) for i, c in enumerate(columns)])
