"""Documents linked by the Jaccard similarity of their word n-grams, exactly.

Sets are put into size bands. Two sets of similarity t, the smaller of size n, differ in at most
n (1 - t) / t elements, H for the largest n of a band. A band cuts the universe of hashed n-grams
into segments; an allocation gives each segment a threshold, 0 (the two parts must be equal) or 1
(one element may be missing on one side), so that thresholds plus one add up to more than H. Then
some segment of a linked pair stays within its threshold, and the pair shares the signature of that
segment: the hash of its elements, or of its elements without one. The allocation is the cheapest
in signatures for the band.

A segment that is empty says nothing and has no signature; the allocation adds some slack for such
segments. The few sets with more empty segments than the slack covers also get a signature per
empty segment, so that no link is lost.

The texts are packed into units of bounded size, written once by the tasks that read them. A text is
known by its unit and its row there. One bit per row says which texts a step is about, one of each
set or those of the families; so no text is shuffled to be joined by its id.

Signatures are matched packed, in two turns. First a unit sends its distinct signatures alone,
without their sets, to parts by their value, and a part answers with one bit per signature: whether
it came more than once. Then only signatures that came more than once are sent with their sets.

Sets also match by chance, on segments that hold little but a common n-gram, so each carries its
parities: a bit per hash value that says whether an odd number of its n-grams has that value. The
parities of two sets differ in no more bits than the sets differ in n-grams; a pair that differs in
more than the similarity allows is no link, for certain, and is dropped where it is matched. A set
has at least as many bits as n-grams, so that large sets are told apart as well as small ones; of
two sets the longer parities are folded to the length of the shorter ones. Members of a match are
tied to each other only through pairs that remain, and the components of these ties are families.
Within a family all pairs of compatible size are verified on the whole sets, in blocks of bounded
size, and only links that join something new leave a block.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelgauge.llm.common import python_tasks, stored, utf8
from reelgauge.llm.components import components
from reelgauge.llm.packed import (
    BASES, SENT, bits, from_planes, mixed, planes, rolling, sent_batch, slices, word_hashes,
)
from reelgauge.llm.substring_dedup import answered, expand, split, units

# Signatures a part holds on average, and parts at least.
PART_SIGNATURES = 2_000_000
LEAST_PARTS = 32
# Text a task works on at once, in bytes: its n-grams and signatures take some forty times as much.
PIECE_BYTES = 2 << 20
# Words of 64 bits that hold the parities of a set, at least and at most.
PARITY_WORDS = 4
MOST_PARITY_WORDS = 128
# N-grams a block of a family holds on average, if it is more than one document. Larger blocks take
# longer in one task, smaller ones send each text to more of them.
BLOCK_GRAMS = 400_000
# Steps of the similarity a band is wide: wide bands suit the sizes in them less, of narrow ones a
# set takes part in more.
WIDTH = 2
# What a match by chance costs, in signatures: it can join families that have nothing in common.
CHANCE = 60
# How much dearer an allocation is in which many sets need signatures for their empty segments.
THIN = 20


@dataclass(frozen=True)
class Band:
    """Sizes of the smaller set, largest size of the larger, and the segments by threshold."""

    low: int
    high: int
    partner: int
    loose: int
    strict: int
    slack: int

    @property
    def segments(self) -> int:
        return self.loose + self.strict


def thin(low: int, loose: int, strict: int, slack: int) -> bool:
    """Whether sets of the least size often have more weight in empty segments than the slack.

    The weight is 2 for a loose segment with at most one element and 1 for an empty strict one;
    often is about once in ten thousand sets.
    """
    fill = low / (loose + strict)
    few, none = loose * (1 + fill) * math.exp(-fill), strict * math.exp(-fill)
    return slack < 2 * few + none + 3.8 * math.sqrt(4 * few + none)


def price(middle: float, loose: int, strict: int) -> float:
    """Cost of an allocation for a set of middle size: its signatures, and what chance matches of
    small segments add, which shared passages make likely."""
    m = loose + strict
    chance = strict * math.exp(-middle / m) + loose * math.exp(1 - middle / m)
    return m + middle * loose / m + CHANCE * chance


def allocate(low: int, high: int, p: int, q: int) -> Band:
    """The cheapest allocation of a band with enough slack."""
    differ, partner, middle = high * (q - p) // p, high * q // p, (low + high) / 2
    if differ == 0:
        return Band(low, high, partner, 0, 1, 0)
    # Without any strict segment, two differences per loose one; right for every size.
    loose = differ // 2 + 1
    band = Band(low, high, partner, loose, 0, 2 * loose - differ - 1)
    best = price(middle, loose, 0) * (THIN if thin(low, loose, 0, band.slack) else 1)
    for share in (0.0, 0.25, 0.5, 1.0):
        for slack in range(2 * high):
            need = differ + 1 + slack
            loose = math.ceil(share * need / 2)
            strict = max(0, need - 2 * loose)
            cost = price(middle, loose, strict)
            if loose + strict >= best:
                break
            if cost < best and not thin(low, loose, strict, 2 * loose + strict - differ - 1):
                best = cost
                band = Band(low, high, partner, loose, strict, 2 * loose + strict - differ - 1)
                break
    return band


def cut_bands(p: int, q: int, largest: int, width: int) -> tuple[Band, ...]:
    """Bands up to a largest set size, each as wide as ``width`` steps of the similarity."""
    out, low = [], 1
    while low <= largest:
        high = low
        while (high + 1) * (q - p) // p == 0:
            high += 1
        high = max(high, int(low * (q / p) ** width))
        if low == 1:
            high = max((n for n in range(1, high + 1) if n * (q - p) // p == 0), default=1)
        out.append(allocate(low, high, p, q))
        low = high + 1
    return tuple(out)


@lru_cache(maxsize=64)
def bands_to(p: int, q: int, power: int) -> tuple[Band, ...]:
    return cut_bands(p, q, 1 << power, WIDTH)


def bands(p: int, q: int, largest: int) -> tuple[Band, ...]:
    """The bands for a similarity of ``p`` / ``q`` up to a largest set size, and some beyond it:
    they are cut up to a power of two, so that few lists of bands serve all batches."""
    return bands_to(p, q, max(0, largest - 1).bit_length())


def signature_counts(sizes: np.ndarray, p: int, q: int) -> np.ndarray:
    """How many signatures sets of some sizes have at most, over the bands they take part in."""
    different, at = np.unique(sizes, return_inverse=True)
    known = bands(p, q, int(different[-1])) if len(different) else ()
    count = [
        sum(b.segments + n * b.loose / b.segments for b in known if b.low <= n <= b.partner)
        for n in different.tolist()
    ]
    return np.ceil(np.array(count)).astype(np.int64)[at] if len(count) else np.zeros(0, np.int64)


class Sets:
    """The n-gram sets of the texts of a batch: sorted hashes, one set after the other."""

    def __init__(self, texts: list[bytes | None], n: int):
        words = [t.lower().split() if t else [] for t in texts]
        count = np.array([len(w) for w in words], np.int64)
        ends, total = np.cumsum(count), int(count.sum())
        hashes = word_hashes(words, total)
        doc = np.repeat(np.arange(len(words)), count)
        places = np.arange(max(0, total - n + 1))
        places = places[places + n <= ends[doc[places]]]
        grams, owner = [rolling(hashes, n, BASES[0])[places]], [doc[places]]
        for size in range(1, min(n, int(count.max()) + 1) if len(count) else 1):
            short = np.flatnonzero(count == size)  # fewer words: the whole text as one n-gram
            at = ends[short] - size
            grams.append(mixed(rolling(hashes, size, BASES[1])[at] + np.uint64(size)))
            owner.append(short)
        gram, doc = np.concatenate(grams), np.concatenate(owner)
        order = np.lexsort((gram, doc))
        gram, doc = gram[order], doc[order]
        new = np.ones(len(gram), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (gram[1:] != gram[:-1])
        self.gram, self.doc = gram[new], doc[new]
        self.size = np.bincount(self.doc, minlength=len(texts)).astype(np.int64)
        self.starts = np.cumsum(self.size) - self.size
        self.key = np.zeros(len(texts), np.uint64)
        full = np.flatnonzero(self.size)
        if len(full):
            self.key[full] = np.add.reduceat(mixed(self.gram), self.starts[full])
        self.key = mixed(self.key + self.size.astype(np.uint64)).view(np.int64)

    def wide_parities(self, chosen: np.ndarray) -> np.ndarray:
        """The parities of the chosen sets, one after the other, ``parity_words`` numbers each."""
        words = parity_words(self.size[chosen])
        starts = np.cumsum(words) - words
        place = np.full(len(self.size), -1)
        place[chosen] = np.arange(len(chosen))
        mine = place[self.doc] >= 0
        at = place[self.doc[mine]]
        spread = mixed(self.gram[mine] * np.uint64(2**32 + 15))
        bit = (spread >> np.uint64(17)) % (64 * words[at]).astype(np.uint64)
        out = np.zeros(int(words.sum()), np.uint64)
        word = starts[at] + (bit >> np.uint64(6)).astype(np.int64)
        np.bitwise_xor.at(out, word, np.uint64(1) << (bit & np.uint64(63)))
        return out

    def parities(self, chosen: np.ndarray) -> np.ndarray:
        """The parities of the chosen sets, folded to ``PARITY_WORDS`` numbers each."""
        return folded(self.wide_parities(chosen), self.size[chosen])[PARITY_WORDS][1]

    def signatures(self, chosen: np.ndarray, p: int, q: int):
        """Signatures and the place of their set, for the chosen sets."""
        largest = int(self.size[chosen].max()) if len(chosen) else 0
        found, owners = [], []
        picked = np.zeros(len(self.size), bool)
        for number, band in enumerate(bands(p, q, largest)):
            picked[:] = False
            picked[chosen] = (self.size[chosen] >= band.low) & (self.size[chosen] <= band.partner)
            if not picked.any():
                continue
            member = picked[self.doc]
            for sig, doc in band_signatures(self.gram[member], self.doc[member], band, number):
                found.append(sig)
                owners.append(doc)
        if not found:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return np.concatenate(found), np.concatenate(owners)


def band_signatures(gram: np.ndarray, doc: np.ndarray, band: Band, number: int):
    """The signatures of one band, with the set each belongs to."""
    m = np.uint64(band.segments)
    spread = mixed(gram * np.uint64(2 * number + 3))
    segment = ((spread >> np.uint64(20)) % m).astype(np.int64)
    group = doc * band.segments + segment
    order = np.argsort(group, kind="stable")
    group, value = group[order], spread[order]
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[first, len(group)])
    sums = np.add.reduceat(value, first)
    owner, which = group[first] // band.segments, group[first] % band.segments
    salt = mixed((which + (number + 1) * (1 << 32)).astype(np.uint64))
    yield mixed(sums + salt), owner
    loose = which < band.loose
    if band.loose:
        wide = np.repeat(loose & (size > 1), size)
        yield (
            mixed(np.repeat(sums + salt, size)[wide] - value[wide]), np.repeat(owner, size)[wide],
        )
    # Sets whose empty segments outweigh the slack: a signature for each such segment.
    sets, at = np.unique(owner, return_inverse=True)
    weight = np.full(len(sets), 2 * band.loose + band.strict)
    np.subtract.at(weight, at, np.where(loose, np.where(size > 1, 2, 0), 1))
    thin = np.flatnonzero(weight > band.slack)
    if len(thin):
        filled = np.zeros((len(thin), band.segments), bool)
        place = np.full(len(sets), -1)
        place[thin] = np.arange(len(thin))
        full = (place[at] >= 0) & (~loose | (size > 1))
        filled[place[at][full], which[full]] = True
        which_set, empty = np.nonzero(~filled)
        salt = mixed((empty + (number + 1) * (1 << 32)).astype(np.uint64))
        yield mixed(salt + np.uint64(1)), sets[thin[which_set]]


def parity_words(size: np.ndarray) -> np.ndarray:
    """How many words of parities sets of some sizes have: powers of two, a bit per n-gram."""
    words = np.clip(-(-size // 64), PARITY_WORDS, MOST_PARITY_WORDS)
    return np.left_shift(1, np.ceil(np.log2(words)).astype(np.int64))


def folded(wide: np.ndarray, size: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """The parities of sets by number of words: the row of each set that has as many, and the rows.

    Longer parities are folded, bits whose places are equal in the shorter length being added up.
    """
    words = parity_words(size)
    starts = np.cumsum(words) - words
    width = int(words.max()) if len(words) else PARITY_WORDS
    member, rows = np.zeros(0, np.int64), np.zeros((0, 2 * width), np.uint64)
    out = {}
    while width >= PARITY_WORDS:
        own = np.flatnonzero(words == width)
        member = np.concatenate([member, own])
        rows = np.concatenate([
            rows[:, :width] ^ rows[:, width:], wide[starts[own][:, None] + np.arange(width)],
        ])
        if width == PARITY_WORDS:
            order = np.argsort(member)
            member, rows = member[order], rows[order]
        place = np.full(len(words), -1, np.int32)
        place[member] = np.arange(len(member))
        out[width] = place, rows
        width //= 2
    return out


def part_of(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of ``values`` that begin at ``starts``, one after the other."""
    first = np.cumsum(lengths) - lengths
    return values[np.arange(int(lengths.sum())) + np.repeat(starts - first, lengths)]


def tagged(tag: np.ndarray, owner: np.ndarray, key: np.ndarray, size: np.ndarray,
           wide: np.ndarray) -> bytes:
    """Tags sorted by their set, with the key, the number of tags, the size and the parities of each
    set; ``owner`` is the place of a tag's set among those of ``key``, ``size`` and ``wide``."""
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    count = np.diff(np.r_[first, len(owner)]).astype(np.uint32)
    chosen, words = owner[first], parity_words(size)
    starts = np.cumsum(words) - words
    return b"".join([
        len(first).to_bytes(4, "little"), planes(key[chosen]), planes(count),
        planes(size[chosen].astype(np.uint32)),
        part_of(wide, starts[chosen], words[chosen]).tobytes(), planes(tag),
    ])


def untagged(blob: bytes) -> tuple[np.ndarray, ...]:
    """Tags, the place of each tag's set, and keys, sizes and parities of the sets."""
    sets, at = int.from_bytes(blob[:4], "little"), 4
    out = []
    for kind in (np.int64, np.uint32, np.uint32):
        width = np.dtype(kind).itemsize * sets
        out.append(from_planes(blob[at:at + width], kind))
        at += width
    key, count, size = out
    size = size.astype(np.int64)
    width = 8 * int(parity_words(size).sum())
    wide = np.frombuffer(blob[at:at + width], np.uint64)
    return (from_planes(blob[at + width:], np.uint32), np.repeat(np.arange(sets), count), key,
            size, wide)


class Compatible:
    """Tells pairs of sets that may be linked from those that cannot.

    ``parity`` has ``PARITY_WORDS`` numbers a set; ``longer`` are the parities by number of words.
    """

    def __init__(self, size: np.ndarray, parity: np.ndarray, p: int, q: int, longer=None):
        self.size, self.parity, self.p, self.q = size, parity, p, q
        self.longer, self.words = longer or {}, parity_words(size)

    def __call__(self, a, b) -> np.ndarray:
        x, y = self.size[a], self.size[b]
        near = np.minimum(x, y) * self.q >= np.maximum(x, y) * self.p
        near &= self.differ_little(self.parity[a], self.parity[b], x + y)
        if not self.longer:
            return near
        words = np.minimum(self.words[a], self.words[b])
        long = np.flatnonzero(near & (words > PARITY_WORDS))
        for width in np.unique(words[long]).tolist():
            at = long[words[long] == width]
            place, rows = self.longer[width]
            first, second = rows[place[a[at]]], rows[place[b[at]]]
            near[at] = self.differ_little(first, second, x[at] + y[at])
        return near

    def differ_little(self, first, second, sizes) -> np.ndarray:
        differ = np.bitwise_count(first ^ second).sum(axis=-1, dtype=np.int64)
        return differ * (self.p + self.q) <= sizes * (self.q - self.p)


def tied(members: np.ndarray, compatible: Compatible) -> list[tuple[int, int]]:
    """Pairs that connect what compatible pairs of the members connect, each with its first member."""
    left, out = members, []
    while len(left) > 1:
        first, left = left[0], left[1:]
        front = [first]
        while front and len(left):
            near = compatible(np.full(len(left), front.pop()), left)
            found = left[near].tolist()
            out += [(first, other) for other in found]
            front += found
            left = left[~near]
    return out


def ties(blobs: list[bytes], p: int, q: int) -> tuple[np.ndarray, np.ndarray]:
    """The sets that the part's signatures connect through pairs that may be linked, each with the
    least of them."""
    tags, owners, keys, sizes, parities, sets = [], [], [], [], [], 0
    for blob in blobs:
        tag, owner, key, size, wide = untagged(blob)
        tags.append(tag)
        owners.append(owner + sets)
        keys.append(key)
        sizes.append(size)
        parities.append(wide)
        sets += len(key)
    # A set comes once per batch that has it; they are numbered in the order of their keys.
    key, once, number = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    size = np.concatenate(sizes)
    words = parity_words(size)
    starts = np.cumsum(words) - words
    wide = part_of(np.concatenate(parities), starts[once], words[once])
    longer = folded(wide, size[once])
    compatible = Compatible(size[once], longer[PARITY_WORDS][1], p, q, longer)
    tag, owner = np.concatenate(tags), number[np.concatenate(owners)]
    order = np.lexsort((owner, tag))
    tag, owner = tag[order], owner[order]
    new = np.r_[True, (tag[1:] != tag[:-1]) | (owner[1:] != owner[:-1])]
    tag, owner = tag[new], owner[new]
    first = np.flatnonzero(np.r_[True, tag[1:] != tag[:-1]])
    count = np.diff(np.r_[first, len(tag)])
    two = first[count == 2]
    pairs = np.unique(np.column_stack([owner[two], owner[two + 1]]), axis=0)
    pairs = pairs[compatible(pairs[:, 0], pairs[:, 1])].tolist()
    known = set()
    for start, many in zip(first[count > 2].tolist(), count[count > 2].tolist()):
        members = owner[start:start + many]
        same = members.tobytes()  # the members of a cluster share many signatures
        if same not in known:
            known.add(same)
            pairs += tied(members, compatible)
    # The sets a part connects are tied to the least of them: every part that connects all of a
    # cluster then says the same, a row per set, however many signatures its sets share.
    found = np.array(pairs, np.int64).reshape(-1, 2)
    least = least_connected(len(key), found[:, 0], found[:, 1])
    other = np.flatnonzero(least != np.arange(len(key)))
    return key[least[other]], key[other]


def least_connected(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least number that each of ``count`` is connected to, by the pairs ``a``, ``b``."""
    label = np.arange(count)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for ends in (label[a], label[b], a, b):
            np.minimum.at(new, ends, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def links_within(sizes, grams, left, right, p: int, q: int) -> list[tuple[int, int]]:
    """Links between the sets of two blocks (or of one) that join components of what is linked.

    ``left`` and ``right`` say which sets to compare with which; a set may be in both.
    """
    count = len(sizes)
    owner = np.repeat(np.arange(count), sizes)
    if not count:
        return []
    _, gram, often = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
    shared = often[gram] > 1
    gram, owner = gram[shared], owner[shared]
    by_gram = np.argsort(gram, kind="stable")
    posting = owner[by_gram]
    begins = np.zeros(len(often) + 1, np.int64)
    np.cumsum(np.bincount(gram, minlength=len(often)), out=begins[1:])
    edges = np.searchsorted(owner, np.arange(count + 1))
    label, found = np.arange(count), []
    for i in np.flatnonzero(left):
        own = gram[edges[i]:edges[i + 1]]
        if not len(own):
            continue
        start, stop = begins[own], begins[own + 1]
        length = stop - start
        at = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length - start, length)
        common = np.bincount(posting[at], minlength=count)
        linked = q * common >= p * (sizes[i] + sizes - common)
        linked &= right & (common > 0) & (label != label[i])
        for j in np.flatnonzero(linked).tolist():
            if label[j] != label[i]:
                found.append((int(i), j))
                label[label == label[j]] = label[i]
    return found


MEMBER = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("key", T.LongType()),
    T.StructField("n_shingles", T.LongType()), T.StructField("signatures", T.LongType()),
    T.StructField("unit", T.LongType()), T.StructField("row", T.IntegerType()),
])
CHOSEN = T.StructType([T.StructField("unit", T.LongType()), T.StructField("chosen", T.BinaryType())])
TEXT = T.StructType([
    T.StructField("unit", T.LongType()), T.StructField("row", T.IntegerType()),
    T.StructField("text", T.StringType()),
])
TIE = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def linked_documents(
    documents: DataFrame, n: int = 5, similarity: tuple[int, int] = (80, 100),
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row of ``documents``.

    A document's set holds its distinct word ``n``-grams, letters A-Z in lower case; with fewer
    words the whole sequence is its only one. Two documents are linked when the intersection of
    their sets times q is at least the union times p, for a ``similarity`` (p, q);
    ``component_id`` is the least id that can be reached by links. Texts that are null or without
    words have an empty set and stay alone. A null id takes part in nothing and stays null; rows
    with the same id are each linked by their own text; an empty table gives an empty table; other
    columns are not looked at.
    """
    python_tasks(documents.sparkSession)
    p, q = similarity
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    packed = stored(units(texts, "text", PIECE_BYTES).select("unit", "payload"), "set-units")

    def members(batches):
        for batch in batches:
            for unit, payload in zip(batch.column("unit").to_pylist(), batch.column("payload").to_pylist()):
                rows = unpacked(payload)
                sets = Sets(utf8(rows.column("text")), n)
                count = len(sets.size)
                yield pa.RecordBatch.from_arrays([
                    rows.column("doc_id").combine_chunks(), pa.array(sets.key, pa.int64()),
                    pa.array(sets.size, pa.int64()),
                    pa.array(signature_counts(sets.size, p, q), pa.int64()),
                    pa.array(np.full(count, unit), pa.int64()),
                    pa.array(np.arange(count), pa.int32()),
                ], MEMBER.names)

    member = stored(packed.mapInArrow(members, MEMBER), "sets")
    known = member.where("n_shingles > 0 and doc_id is not null")
    least = stored(
        known.groupBy("key", "n_shingles", "signatures")
        .agg(F.min(F.struct("doc_id", "unit", "row")).alias("least"))
        .select("key", "n_shingles", "signatures", F.col("least.doc_id").alias("first"),
                "least.unit", "least.row"),
        "least",
    )
    family = components(matched(packed, least, n, p, q)).withColumnsRenamed(
        {"node": "key", "label": "family"}
    )
    link = verified(packed, family, least, n, p, q)
    label = components(link).withColumnsRenamed({"node": "key"})
    reach = label.join(least, "key").groupBy("label").agg(F.min("first").alias("reach"))
    found = (
        least.join(label, "key", "left").join(reach, "label", "left")
        .select("key", F.coalesce("reach", "first").alias("component"))
    )
    return member.join(found, "key", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
        .alias("component_id"),
    ).withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))


def unpacked(payload: bytes, chosen: bytes | None = None) -> pa.Table:
    """The rows of a unit, or those of them that are chosen."""
    rows = pa.ipc.open_stream(zstandard.decompress(payload)).read_all()
    return rows if chosen is None else rows.take(pa.array(places(chosen)))


def places(chosen: bytes) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(np.frombuffer(chosen, np.uint8)))


def with_chosen(packed: DataFrame, rows: DataFrame) -> DataFrame:
    """The units that have any of ``rows`` (``unit``, ``row``), with a bit per row for these.

    The bits are written first, so that Spark knows how few they are before it joins them: an eighth
    of a byte per text, which are broadcast where the units would be shuffled.
    """

    def of(group: pa.Table) -> pa.Table:
        row = np.asarray(group.column("row").combine_chunks())
        flag = np.zeros(int(row.max()) + 1, bool)
        flag[row] = True
        return pa.table(
            [group.column("unit")[:1], pa.array([np.packbits(flag).tobytes()], pa.binary())],
            CHOSEN.names,
        )

    chosen = stored(rows.select("unit", "row").groupBy("unit").applyInArrow(of, CHOSEN), "chosen")
    return packed.join(chosen, "unit")


def is_shared(blobs: list[bytes]) -> list[np.ndarray]:
    """Which signatures came more than once, from one unit or several."""
    tags, twice, sizes = [], [], []
    for blob in blobs:
        n = int.from_bytes(blob[:4], "little")
        tags.append(from_planes(blob[4:4 + 4 * n], np.uint32))
        twice.append(bits(blob[4 + 4 * n:], n))
        sizes.append(n)
    _, index, count = np.unique(np.concatenate(tags), return_inverse=True, return_counts=True)
    more = count > 1
    more[index[np.concatenate(twice)]] = True
    return split(more[index], sizes)


def ones(batches):
    """The number of bits set in the answers."""
    for batch in batches:
        blobs = b"".join(batch.column("blob").to_pylist())
        count = int(np.bitwise_count(np.frombuffer(blobs, np.uint8)).sum(dtype=np.int64))
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], ["found"])


def matched(packed: DataFrame, least: DataFrame, n: int, p: int, q: int) -> DataFrame:
    """Ties (``a``, ``b``: keys) of sets that share a signature and may be linked.

    Signatures are sent alone first and with their sets only if they came more than once, so the
    sets and parities, which cost more than the signatures, are sent for few of them.
    """
    total = least.agg(F.sum("signatures")).first()[0] or 0
    parts = max(LEAST_PARTS, math.ceil(total / PART_SIGNATURES))
    one_of_each = with_chosen(packed, least)

    def signed(payload: bytes, chosen: bytes):
        """The chosen sets of a unit; its distinct signatures, sorted by part; the place among them
        and the set of every signature; and which came more than once."""
        sets = Sets(utf8(unpacked(payload, chosen).column("text")), n)
        full = np.flatnonzero(sets.size > 0)
        full = full[np.unique(sets.key[full], return_index=True)[1]]
        sig, owner = sets.signatures(full, p, q)
        code = ((sig >> np.uint64(32)) % np.uint64(parts)) << np.uint64(32)
        code |= sig & np.uint64(0xFFFFFFFF)
        code, index, count = np.unique(code, return_inverse=True, return_counts=True)
        return sets, owner, code, index, count > 1

    def send(batches):
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("unit", "payload", "chosen"))
            for unit, payload, chosen in zip(*columns):
                _, _, code, _, twice = signed(payload, chosen)
                tag = code.astype(np.uint32)
                rows = [
                    (k, unit, int(b - a).to_bytes(4, "little") + planes(tag[a:b])
                     + np.packbits(twice[a:b]).tobytes())
                    for k, a, b in slices((code >> np.uint64(32)).astype(np.int64))
                ]
                yield pa.RecordBatch.from_arrays(sent_batch(rows), SENT.names)

    hits = stored(answered(one_of_each.mapInArrow(send, SENT), is_shared), "set-hits")
    found = hits.select("blob").mapInArrow(ones, "found long").agg(F.sum("found")).first()[0] or 0
    fewer = max(LEAST_PARTS, math.ceil(found / PART_SIGNATURES))

    def send_sets(unit_rows: pa.Table, answers: pa.Table) -> pa.Table:
        got = dict(zip(answers.column("part").to_pylist(), answers.column("blob").to_pylist()))
        rows: list[tuple[int, int, bytes]] = []
        columns = (unit_rows.column(c).to_pylist() for c in ("unit", "payload", "chosen"))
        for unit, payload, chosen in zip(*columns):
            if not got:
                continue
            sets, owner, code, index, _ = signed(payload, chosen)
            hot = expand((code >> np.uint64(32)).astype(np.int64), got)[index]
            code, (shared, owner) = mixed(code[index[hot]]), np.unique(owner[hot], return_inverse=True)
            part = ((code >> np.uint64(32)) % np.uint64(fewer)).astype(np.int64)
            order = np.lexsort((owner, part))
            part, tag, owner = part[order], code[order].astype(np.uint32), owner[order]
            key, size, wide = sets.key[shared], sets.size[shared], sets.wide_parities(shared)
            rows += [
                (k, unit, tagged(tag[a:b], owner[a:b], key, size, wide)) for k, a, b in slices(part)
            ]
        return pa.table(sent_batch(rows), SENT.names)

    def tie(group: pa.Table) -> pa.Table:
        a, b = ties(group.column("blob").to_pylist(), p, q)
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], TIE.names)

    sent = one_of_each.groupBy("unit").cogroup(hits.groupBy("unit")).applyInArrow(send_sets, SENT)
    return sent.groupBy("part").applyInArrow(tie, TIE).distinct()


def verified(
    packed: DataFrame, family: DataFrame, least: DataFrame, n: int, p: int, q: int,
) -> DataFrame:
    """Links (``a``, ``b``: keys) that connect what is linked within the families."""
    member = family.join(least, "key").withColumn(
        "level", F.floor(F.log(F.col("n_shingles").cast("double")) / math.log(q / p)).cast("int")
    )
    # Families over the size of a block are cut by level (sets further apart than one level are
    # never linked), and levels over that size by the hash of the key.
    by_level = member.groupBy("family", "level").agg(F.sum("n_shingles").alias("grams"))
    by_family = by_level.groupBy("family").agg(F.sum("grams").alias("all_grams"))
    cut = F.when(F.col("all_grams") <= BLOCK_GRAMS, 0).otherwise(
        F.ceil(F.col("grams") / BLOCK_GRAMS)
    ).cast("int")
    levels = stored(
        by_level.join(by_family, "family").select("family", "level", cut.alias("cuts")), "levels"
    )
    near = {
        shift: levels.select(
            "family", (F.col("level") - shift).cast("int").alias("level"), F.col("cuts").alias(name)
        )
        for shift, name in ((1, "above"), (-1, "below"))
    }
    levels = levels.join(near[1], ["family", "level"], "left").join(
        near[-1], ["family", "level"], "left"
    ).na.fill(0, ["above", "below"])
    placed = member.join(levels, ["family", "level"])
    block = F.pmod(F.xxhash64("key"), F.greatest("cuts", F.lit(1))).cast("int")

    def pairs(count: str, lower, upper, first, second, side):
        return F.transform(
            F.when(F.col(count) > 0, F.sequence(F.lit(0), F.col(count) - 1)).otherwise(
                F.array().cast("array<int>")
            ),
            lambda k: F.struct(lower.alias("lower"), upper.alias("upper"), first(k).alias("x"),
                               second(k).alias("y"), side(k).alias("side")),
        )

    level, own = F.col("level"), F.col("block")
    whole = F.array(F.struct(
        F.lit(-1).alias("lower"), F.lit(-1).alias("upper"), F.lit(0).alias("x"),
        F.lit(0).alias("y"), F.lit(0).alias("side"),
    ))
    same = pairs(
        "cuts", level, level, lambda k: F.least(k, own), lambda k: F.greatest(k, own),
        lambda k: F.when(k == own, 0).when(own < k, 1).otherwise(2),
    )
    up = pairs("above", level, level + 1, lambda k: own, lambda k: k, lambda k: F.lit(1))
    down = pairs("below", level - 1, level, lambda k: k, lambda k: own, lambda k: F.lit(2))
    dealt = placed.withColumn("block", block).withColumn(
        "to", F.when(F.col("cuts") == 0, whole).otherwise(F.concat(same, up, down))
    ).select("family", "unit", "row", "to")

    def texts(batches):
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("unit", "payload", "chosen"))
            for unit, payload, chosen in zip(*columns):
                row = places(chosen)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(row), unit), pa.int64()), pa.array(row, pa.int32()),
                    unpacked(payload, chosen).column("text").cast(pa.string()).combine_chunks(),
                ], TEXT.names)

    # A text takes half the room of its hashed n-grams, so texts go to the blocks.
    text = with_chosen(packed, member).mapInArrow(texts, TEXT)
    spread = dealt.join(text, ["unit", "row"]).select(
        "family", "text", F.explode("to").alias("at")
    ).select("family", "text", "at.*")

    def verify(group: pa.Table) -> pa.Table:
        sets = Sets(utf8(group.column("text")), n)
        keys, once = np.unique(sets.key, return_index=True)
        side = np.asarray(group.column("side").combine_chunks())[once]
        sizes = sets.size[once]
        grams = [sets.gram[sets.starts[i]:sets.starts[i] + sets.size[i]] for i in once]
        found = links_within(sizes, grams, side != 2, side != 1, p, q)
        a = keys[[i for i, _ in found]] if found else np.zeros(0, np.int64)
        b = keys[[j for _, j in found]] if found else np.zeros(0, np.int64)
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], TIE.names)

    return spread.groupBy("family", "lower", "upper", "x", "y").applyInArrow(verify, TIE)


def one_of_each_group(
    documents: DataFrame, n: int = 5, similarity: tuple[int, int] = (80, 100),
) -> DataFrame:
    """The documents whose id is the least of their component, with their own columns.

    Rows with a null id stay; repeated rows of a kept id all stay, as one document.
    """
    columns = documents.columns
    found = linked_documents(documents, n, similarity)
    gone = found.where("component_id <> doc_id").select(F.col("doc_id").alias("_gone")).distinct()
    return documents.join(gone, documents["doc_id"] == F.col("_gone"), "left_anti").select(*columns)
