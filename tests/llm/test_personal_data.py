from __future__ import annotations

import hashlib
import random
import re
import time

import pytest

from reelgauge.llm.personal_data import (
    BASE_KINDS, KINDS, find_personal_data, luhn, mod97, personal_spans,
)
from reelgauge.llm.queries import op12_personal_data
from tests.conftest import TESTDATA
from tests.llm.cases import ROWS, no_documents, odd_documents

# The four definitions as they stand, on Python's matcher.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def doubled(digits: str) -> int:
    total = 0
    for i, d in enumerate(reversed(digits)):
        value = int(d) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda: 16 <= len(digits) <= 19 and doubled(digits) % 10 == 0,
                "phone": lambda: 8 <= len(digits) <= 15,
            }[kind]
            if good():
                out.append((kind, m.start(), m.end()))
    return out


def based(text: str) -> list[tuple[str, int, int]]:
    return [(s.kind, s.start, s.end) for s in personal_spans(text) if s.base]


def added(text: str) -> list[tuple[str, str]]:
    return [(s.kind, text[s.start:s.end]) for s in personal_spans(text) if not s.base]


def random_texts():
    rng = random.Random(12)
    bits = list("0123456789") * 2 + list(" -..@@++()a_%é\n") + [
        "a.b@c.de", "10.0.0.255", "4111 1111 1111 1111", "+1 (269) 555-3296", "x@y", "@", "256.1",
        "DE89 3704 0044 0532 0130 00", "card", "😀",
    ]
    for _ in range(6000):
        yield "".join(rng.choices(bits, k=rng.randint(1, 40)))


def test_base_spans_are_the_plain_patterns():
    for text in [*random_texts(), *(r[1] for r in ROWS if r[1])]:
        assert based(text) == plain_spans(text), repr(text)


@pytest.mark.parametrize("text", [
    "a@b.c_x@d.e", "a@b.c@d.e", "@b.c", "a@@b.c", "a@b..c", "a@b.c.", ".@-.-", "a@b@c.d",
    "1.2.3.4.5.6.7.8.9", "1.2.3.256.1.2.3.4", "0000000255.1.1.1", "1.2.3", "1..2.3.4",
    "4111-1111-1111-1111", "4111  1111 1111 1111", "+1234567", "+12345678", "++12345678",
    "+1 2 3 4 5 6 7 8 ) ", "12 4111111111111111",
])
def test_traps_of_the_base_kinds(text):
    assert based(text) == plain_spans(text)


def test_checksums():
    assert luhn("4111111111111111") and not luhn("4111111111111112")
    assert mod97("DE89370400440532013000") and not mod97("DE88370400440532013000")


def test_a_card_beside_other_digits_is_found():
    text = "call +1 (269) 555-3296 4111111111111111 now"
    assert based(text) == []
    assert added(text) == [("card", "4111111111111111"), ("phone", "+1 (269) 555-3296")]
    assert added("9999 4111 1111 1111 1111") == [("card", "4111 1111 1111 1111")]
    assert added("amex 378282246310005") == [("card", "378282246310005")]
    assert added("order 378282246310005") == []
    assert added("x 3782822463100051234567") == []


def test_words_nearby_decide():
    assert added("ssn 219-09-9999") == [("ssn", "219-09-9999")]
    assert added("part 219-09-9999") == [] == added("ssn 000-09-9999")
    assert added("Telefon: 555-123-4567") == [("phone", "555-123-4567")]
    assert added("room 555-123-4567") == [] == added("phone order 555-123-4567")
    far = "phone " + "x " * 40 + "555-123-4567"
    assert added(far) == []


def test_ibans():
    for good in ("DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "NO93 8601 1117 947"):
        assert added(f"to {good}, AND") == [("iban", good)]
    assert added("to DE89 3704 0044 0532 0130 00 AND") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert added("DE88 3704 0044 0532 0130 00") == [] == added("ZZ89 3704 0044 0532 0130 00")
    assert added("XDE89370400440532013000") == [] == added("DE893704004405320130001")


def test_added_spans_touch_nothing_and_are_sorted():
    for text in random_texts():
        spans = personal_spans(text)
        assert spans == sorted(spans, key=lambda s: (KINDS.index(s.kind), s.start))
        for s in spans:
            assert text[s.start:s.end] and 0 <= s.score <= 1
            if not s.base:
                assert all(t is s or t.end <= s.start or t.start >= s.end for t in spans)


@pytest.mark.parametrize("bit", ["1", "a", "a.", "1.", "1 ", "+1", "+ ", "@a", "1-", "DE8", "( ", "x@y."])
def test_long_runs_take_linear_time(bit):
    text = bit * (400_000 // len(bit))
    start = time.perf_counter()
    personal_spans(text)
    assert time.perf_counter() - start < 5


def test_rows_of_every_sort(spark):
    found = find_personal_data(odd_documents(spark).withColumnRenamed("source", "spans"))
    assert found.columns == ["doc_id", "text", "spans"]
    assert found.count() == len(ROWS)
    assert all(r["spans"] == [] for r in found.where("coalesce(text, '') = ''").collect())
    assert find_personal_data(no_documents(spark)).count() == 0


def test_query_against_the_plain_patterns(spark):
    folder = f"{TESTDATA}/sf0.01"
    texts = {r[0]: r[1] or "" for r in
             spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    rows = op12_personal_data(spark, folder).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    more = 0
    for r in rows:
        spans = plain_spans(texts[r["doc_id"]])
        for kind in BASE_KINDS:
            assert r[f"n_{kind}"] == sum(s[0] == kind for s in spans)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        every = r["spans"].split(",") if r["spans"] else []
        assert [s for s in every if s in joined.split(",")] == (joined.split(",") if joined else [])
        more += len(every) - len(spans)
    assert more > 0
