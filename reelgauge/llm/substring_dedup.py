"""Removal of passages that another document with a smaller id has too.

A passage of 50 words or more holds, wherever it starts, a whole block of 25 words that begins at a
multiple of 25 in its document. These non-overlapping blocks are the anchors: every rolling window
of 25 words is looked up among them, and windows of 50 words around the hits, which the repeats are
made of, are then compared exactly. A word goes if any window that covers it starts in a document
with a smaller id too; neighbouring windows join to maximal repeats.

Documents are packed into units of a few megabytes, written once. Per unit each distinct hash is
sent once, whatever the number of copies in it, to one of many parts by its value; a part answers
with one bit per hash. So a passage that a third of all documents share costs one hash per unit.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from reelgauge.llm.common import python_tasks, stored, utf8
from reelgauge.llm.packed import (
    BASES, SENT, bits, from_planes, planes, rolling, sent_batch, slices, word_hashes,
)

WINDOW = 50
UNIT_BYTES = 4 << 20
# Hashes a part holds on average, and parts at least.
PART_HASHES = 2_000_000
LEAST_PARTS = 32

UNIT = T.StructType([
    T.StructField("unit", T.LongType()), T.StructField("words", T.LongType()),
    T.StructField("payload", T.BinaryType()),
])


class Unit:
    """The words of some documents, one after the other."""

    def __init__(self, payload: bytes, text: str, doc_id: str, window: int):
        self.rows = pa.ipc.open_stream(zstandard.decompress(payload)).read_all()
        self.words = [t.split() if t else [] for t in utf8(self.rows.column(text))]
        sizes = np.array([len(w) for w in self.words], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.total = int(sizes.sum())
        self.doc = np.repeat(np.arange(len(sizes)), sizes)
        self.hashes = word_hashes(self.words, self.total)
        ids = self.rows.column(doc_id).combine_chunks()
        self.known = np.asarray(ids.is_valid())
        self.ids = np.asarray(ids.cast(pa.int64()).fill_null(0))
        self.window = window

    def whole(self, size: int) -> np.ndarray:
        """Places from which ``size`` words belong to one document that has an id."""
        places = np.arange(max(0, self.total - size + 1))
        doc = self.doc[places]
        return places[(places + size <= self.ends[doc]) & self.known[doc]]

    def anchors(self, parts: int):
        """Distinct hashes of the block-sized windows, by part; and the window each place has.

        Returns places, part and tag of each distinct hash, its index per place, whether it occurs
        twice here and whether once at an anchor.
        """
        size = self.window // 2
        places = self.whole(size)
        found = rolling(self.hashes, size, BASES[0])[places]
        key = ((found >> np.uint64(32)) % np.uint64(parts)) << np.uint64(32)
        key |= found & np.uint64(0xFFFFFFFF)
        key, index, count = np.unique(key, return_inverse=True, return_counts=True)
        at_anchor = np.zeros(len(key), bool)
        at_anchor[index[(places - self.starts[self.doc[places]]) % size == 0]] = True
        part = (key >> np.uint64(32)).astype(np.int64)
        return places, part, key.astype(np.uint32), index, count > 1, at_anchor

    def repeats(self, parts: int, answers: dict[int, bytes]):
        """Windows near a hit: place, part, hash, index per window, least document id per hash."""
        places, part, tag, index, _, _ = self.anchors(parts)
        hot = expand(part, answers)
        hits = np.zeros(self.total + 1, np.int64)
        hits[places[hot[index]] + 1] = 1
        hits = np.cumsum(hits)
        size = self.window
        windows = self.whole(size)
        last = windows + size - size // 2 + 1
        windows = windows[hits[last] > hits[windows]]
        tags = rolling(self.hashes, size, BASES[0])[windows]
        part = (rolling(self.hashes, size, BASES[1])[windows] % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((tags, part))
        first = np.ones(len(order), bool)
        first[1:] = (np.diff(part[order]) != 0) | (tags[order][1:] != tags[order][:-1])
        group = np.cumsum(first) - 1
        index = np.empty(len(order), np.int64)
        index[order] = group
        least = np.full(int(first.sum()), np.iinfo(np.int64).max)
        np.minimum.at(least, index, self.ids[self.doc[windows]])
        return windows, part[order][first], tags[order][first], index, least


def expand(part: np.ndarray, answers: dict[int, bytes]) -> np.ndarray:
    """One truth value per hash from the answers of the parts; no answer means no."""
    out = np.zeros(len(part), bool)
    for p, data in answers.items():
        a, b = np.searchsorted(part, [p, p + 1])
        out[a:b] = bits(data, b - a)
    return out


def units(documents: DataFrame, text: str, size: int | None = None) -> DataFrame:
    """Documents packed by the task that reads them; a unit holds about ``size`` bytes of text, 4 MB
    by default."""
    size = size or UNIT_BYTES

    def pack(batches):
        task, count = TaskContext.get().partitionId(), 0
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            sizes = np.array([len(t or b"") for t in utf8(batch.column(text))], np.int64)
            unit = np.cumsum(sizes) // size
            edges = [0, *(np.flatnonzero(np.diff(unit)) + 1).tolist(), len(sizes)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                rows = batch.slice(a, b - a)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rows.schema) as out:
                    out.write_batch(rows)
                words = sum(len(t.split()) for t in utf8(rows.column(text)) if t)
                payload = squeeze.compress(sink.getvalue().to_pybytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([task << 33 | count], pa.int64()), pa.array([words], pa.int64()),
                     pa.array([payload], pa.binary())], ["unit", "words", "payload"],
                )
                count += 1

    return documents.mapInArrow(pack, UNIT)


def answered(sent: DataFrame, answer) -> DataFrame:
    """The answers of all parts: per unit and part one bit for each hash sent."""

    def of(group: pa.Table) -> pa.Table:
        part, found = group.column("part")[0].as_py(), []
        blobs = group.column("blob").to_pylist()
        for unit, yes in zip(group.column("unit").to_pylist(), answer(blobs)):
            if yes.any():
                found.append((part, unit, np.packbits(yes).tobytes()))
        columns = list(zip(*found)) or [[], [], []]
        kinds = [pa.int32(), pa.int64(), pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "unit", "blob"])

    return sent.groupBy("part").applyInArrow(of, SENT)


def split(values: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    return np.split(values, np.cumsum(sizes)[:-1])


def is_repeated(blobs: list[bytes]) -> list[np.ndarray]:
    """Which anchor-sized windows occur twice, at least once of all times at an anchor."""
    tags, twice, anchor, sizes = [], [], [], []
    for blob in blobs:
        n = int.from_bytes(blob[:4], "little")
        eighth = -(-n // 8)
        tags.append(from_planes(blob[4:4 + 4 * n], np.uint32))
        twice.append(bits(blob[4 + 4 * n:4 + 4 * n + eighth], n))
        anchor.append(bits(blob[4 + 4 * n + eighth:], n))
        sizes.append(n)
    _, index, count = np.unique(np.concatenate(tags), return_inverse=True, return_counts=True)
    more, at_anchor = count > 1, np.zeros(len(count), bool)
    more[index[np.concatenate(twice)]] = True
    at_anchor[index[np.concatenate(anchor)]] = True
    return split((more & at_anchor)[index], sizes)


def is_earlier(blobs: list[bytes]) -> list[np.ndarray]:
    """Which windows a document of another unit, with a smaller id, has too."""
    sizes = [len(b) // 16 for b in blobs]
    tags = np.concatenate([from_planes(b[:8 * n], np.uint64) for b, n in zip(blobs, sizes)])
    ids = np.concatenate([from_planes(b[8 * n:], np.int64) for b, n in zip(blobs, sizes)])
    _, index = np.unique(tags, return_inverse=True)
    least = np.full(int(index.max()) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, index, ids)
    return split(ids > least[index], sizes)


def deduplicated(
    documents: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW,
) -> DataFrame:
    """``documents`` with ``n_words``, ``n_removed`` and ``kept``, the words left, one blank apart.

    Words are separated by ASCII white space. A null text has no words and keeps the empty text; a
    document shorter than a window keeps all; rows with the same id are the same document, and none
    of them is earlier than the other; rows with a null id are never earlier and lose nothing;
    an empty table gives an empty table; input columns named like a result are replaced.
    """
    python_tasks(documents.sparkSession)
    own = documents.drop("n_words", "n_removed", "kept")
    packed = stored(units(own, text), "substring-units")
    words = packed.agg(F.sum("words")).first()[0] or 0
    parts = max(LEAST_PARTS, math.ceil(words / PART_HASHES))
    names = ["part", "unit", "blob"]

    def send_anchors(batches):
        for batch in batches:
            for unit, payload in zip(batch.column("unit").to_pylist(), batch.column("payload").to_pylist()):
                _, part, tag, _, twice, anchor = Unit(payload, text, doc_id, window).anchors(parts)
                rows = [
                    (p, unit, int(b - a).to_bytes(4, "little") + planes(tag[a:b])
                     + np.packbits(twice[a:b]).tobytes() + np.packbits(anchor[a:b]).tobytes())
                    for p, a, b in slices(part)
                ]
                yield pa.RecordBatch.from_arrays(sent_batch(rows), names)

    hits = stored(
        answered(packed.select("unit", "payload").mapInArrow(send_anchors, SENT), is_repeated),
        "substring-hits",
    )

    def send_windows(unit_rows: pa.Table, answers: pa.Table) -> pa.Table:
        rows: list[tuple[int, int, bytes]] = []
        for unit, payload in zip(unit_rows.column("unit").to_pylist(), unit_rows.column("payload").to_pylist()):
            got = dict(zip(answers.column("part").to_pylist(), answers.column("blob").to_pylist()))
            if not got:
                continue
            _, part, tag, _, least = Unit(payload, text, doc_id, window).repeats(parts, got)
            rows += [(p, unit, planes(tag[a:b]) + planes(least[a:b])) for p, a, b in slices(part)]
        return pa.table(sent_batch(rows), names)

    by_unit = packed.select("unit", "payload").groupBy("unit")
    windows = by_unit.cogroup(hits.groupBy("unit")).applyInArrow(send_windows, SENT)
    earlier = answered(windows, is_earlier)
    schema = T.StructType([
        *own.schema.fields, T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType()),
    ])
    answers = hits.withColumn("round", F.lit(1)).unionByName(earlier.withColumn("round", F.lit(2)))

    def remove(unit_rows: pa.Table, answers: pa.Table) -> pa.Table:
        tables = []
        got: dict[int, dict[int, bytes]] = {1: {}, 2: {}}
        for turn, part, blob in zip(*(answers.column(c).to_pylist() for c in ("round", "part", "blob"))):
            got[turn][part] = blob
        for payload in unit_rows.column("payload").to_pylist():
            unit = Unit(payload, text, doc_id, window)
            gone = np.zeros(unit.total + 1, np.int64)
            if got[1]:
                windows, part, _, index, least = unit.repeats(parts, got[1])
                before = expand(part, got[2])[index] | (least[index] < unit.ids[unit.doc[windows]])
                np.add.at(gone, windows[before], 1)
                np.add.at(gone, windows[before] + window, -1)
            gone = np.cumsum(gone)[:-1] > 0
            removed = np.concatenate([[0], np.cumsum(gone)])
            removed = removed[unit.ends] - removed[unit.starts]
            kept = []
            for words, a, n in zip(unit.words, unit.starts.tolist(), removed.tolist()):
                if n:
                    words = [w for w, out in zip(words, gone[a:a + len(words)].tolist()) if not out]
                kept.append(b" ".join(words).decode("utf-8", "replace"))
            rows = unit.rows
            rows = rows.append_column("n_words", pa.array(unit.ends - unit.starts, pa.int64()))
            rows = rows.append_column("n_removed", pa.array(removed, pa.int64()))
            tables.append(rows.append_column("kept", pa.array(kept, pa.string())))
        return pa.concat_tables(tables) if tables else pa.table(
            [pa.array([], to_arrow_type(f.dataType)) for f in schema.fields], schema.names
        )

    return by_unit.cogroup(answers.groupBy("unit")).applyInArrow(remove, schema)
