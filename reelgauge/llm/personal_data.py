"""Personal data in texts: patterns propose, checksums confirm, words nearby move the score.

Four base kinds (email, ip, card, phone) are found by one pattern each, leftmost and without
overlap; a proposal that fails its check (parts up to 255, Luhn, number of digits) is dropped and
its characters are not tried again. These spans always stay.

A second look then adds what the base patterns cannot see: a card or a phone that stands in one run
with other digits, cards of 13 to 15 digits, phones without a country code, IBANs (mod 97) and
social security numbers. Each of these starts with a score for its shape, gains by a checksum, gains
by a word nearby that names its kind and loses by one that names another use of digits. Spans that
reach the threshold and touch nothing better are added.

Every pattern here reads a text in linear time: runs are matched possessively or cut by hand, so
a megabyte of one repeated character costs no more than any other megabyte.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelgauge.llm.common import python_tasks

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")
THRESHOLD = 0.7
# Characters before and after a span in which words count.
BEFORE, AFTER = 48, 24

# Words that name a kind of number, and words for other uses of digits.
NAMES = {
    "email": {"email", "mail", "e-mail", "courriel", "correo", "contact"},
    "ip": {"ip", "host", "server", "address", "adresse", "dirección"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "debit", "kreditkarte", "karte",
             "carte", "tarjeta", "crédito"},
    "phone": {"phone", "tel", "telephone", "mobile", "cell", "call", "fax", "telefon", "handy",
              "téléphone", "appelez", "teléfono", "móvil", "llame"},
    "iban": {"iban", "account", "bank", "konto", "compte", "cuenta"},
    "ssn": {"ssn", "social", "security", "sozialversicherung", "sécurité", "seguridad"},
}
OTHER_USES = {
    "isbn", "issn", "doi", "order", "invoice", "tracking", "serial", "version", "timestamp",
    "bestellung", "rechnung", "facture", "commande", "factura", "pedido",
}
# Length of an IBAN by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22,
    "BR": 29, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20,
    "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18,
    "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "JO": 30,
    "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24,
    "ME": 22, "MK": 19, "MT": 31, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25,
    "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TN": 24,
    "TR": 26, "UA": 29, "VG": 24, "XK": 20,
}
# First digits of payment cards by number of digits.
CARD_STARTS = {
    13: ("4",), 14: ("30", "36", "38", "39"), 15: ("34", "37"), 16: ("2", "35", "4", "5", "6"),
    17: ("6",), 18: ("6",), 19: ("4", "6"),
}

LOCAL = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
NUMBERS = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])++")
GROUP = re.compile(r"[0-9]++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
INTERNATIONAL = re.compile(
    r"\+[0-9]{1,3}(?:[ .-]?\([0-9]{1,4}\))?(?:[ .-]?[0-9]{2,5}(?![0-9])){1,5}"
)
NATIONAL = re.compile(
    r"(?<![0-9+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9]|[.-][0-9])"
    r"|(?<![0-9+(.-])0[1-9](?:[ .-][0-9]{2}){4}(?![0-9]|[.-][0-9])"
)
IBAN_HEAD = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=[ A-Z0-9])")
SSN = re.compile(
    r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9]|-[0-9])"
)
NEARBY = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")


class Span(NamedTuple):
    """Code points from ``start`` up to ``end``."""

    kind: str
    start: int
    end: int
    score: float
    base: bool


SPANS = "array<struct<kind:string,start:int,end:int,score:double,base:boolean>>"
SPAN_TYPE = pa.list_(pa.struct([
    ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()),
    ("base", pa.bool_()),
]))


def luhn(digits: str) -> bool:
    """The checksum of payment cards: every second digit from the right doubled."""
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def mod97(code: str) -> bool:
    """The checksum of IBANs: the first four characters last, letters as 10 to 35."""
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def digits_of(text: str) -> str:
    return "".join(GROUP.findall(text))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each ``@`` with a domain, and the characters before it back to the last match."""
    done = 0
    for found in DOMAIN.finditer(text):
        at = found.start()
        before = text[done:at]
        start = done + len(before.rstrip(LOCAL))
        if start < at:
            yield start, found.end()
            done = found.end()
        else:
            done = at + 1


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers of a dotted run at a time, each at most 255."""
    for run in NUMBERS.finditer(text):
        if run.group().count(".") < 3:
            continue
        parts = list(GROUP.finditer(text, run.start(), run.end()))
        for i in range(0, len(parts) - 3, 4):
            four = [p.group().lstrip("0") for p in parts[i:i + 4]]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in four):
                yield parts[i].start(), parts[i + 3].end()


def base_spans(text: str) -> tuple[list[Span], list[tuple[int, int]], list[tuple[int, int]]]:
    """The base spans, and the runs of digits and the phones that failed."""
    found = [Span("email", a, b, 1.0, True) for a, b in emails(text)]
    found += [Span("ip", a, b, 0.8, True) for a, b in addresses(text)]
    runs, phones = [], []
    for run in DIGITS.finditer(text):
        length = run.end() - run.start()
        digits = digits_of(run.group()) if length < 40 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(Span("card", run.start(), run.end(), 0.8, True))
        elif length >= 13:
            runs.append(run.span())
    for phone in PHONE.finditer(text):
        if 8 <= sum(map(len, GROUP.findall(phone.group()))) <= 15:
            found.append(Span("phone", *phone.span(), 0.7, True))
        else:
            phones.append(phone.span())
    return found, runs, phones


def cards_within(text: str, start: int, end: int) -> Iterator[tuple[float, int, int]]:
    """Whole groups of a longer run of digits that are a card together."""
    groups = [g.span() for g in GROUP.finditer(text, start, end)]
    for i, (first, _) in enumerate(groups):
        digits, shape = "", []
        for a, b in groups[i:i + 19]:
            if len(digits) + b - a > 19:
                break
            digits += text[a:b]
            shape.append(b - a)
            if digits.startswith(CARD_STARTS.get(len(digits), ())) and luhn(digits):
                usual = len(shape) == 1 or shape in ([4, 4, 4, 4], [4, 6, 5], [4, 6, 4])
                yield 0.7 if usual else 0.45, first, b


def ibans(text: str) -> Iterator[tuple[float, int, int]]:
    for head in IBAN_HEAD.finditer(text):
        length = IBAN_LENGTHS.get(head.group()[:2])
        if not length:
            continue
        code, at = head.group(), head.end()
        while len(code) < length and at < len(text):
            at += text[at] == " "
            if not text[at:at + 1].isascii() or not text[at:at + 1].isalnum():
                break
            code += text[at]
            at += 1
        ends = not text[at:at + 1].isalnum()
        if len(code) == length and ends and code == code.upper() and mod97(code):
            yield 0.9, head.start(), at


def proposals(text: str, runs, phones) -> Iterator[Span]:
    """What the second look proposes, scored by shape and checksum alone."""
    for start, end in runs:
        for score, a, b in cards_within(text, start, end):
            yield Span("card", a, b, score, False)
    for start, end in phones:
        found = INTERNATIONAL.match(text, start, end)
        if found and 8 <= len(digits_of(found.group())) <= 15:
            yield Span("phone", *found.span(), 0.7, False)
    for found in NATIONAL.finditer(text):
        yield Span("phone", *found.span(), 0.45, False)
    for score, a, b in ibans(text):
        yield Span("iban", a, b, score, False)
    for found in SSN.finditer(text):
        yield Span("ssn", *found.span(), 0.45, False)


def in_context(text: str, span: Span) -> Span:
    """The span with its score moved by the words around it."""
    around = f"{text[max(0, span.start - BEFORE):span.start]} {text[span.end:span.end + AFTER]}"
    words = {w.lower() for w in NEARBY.findall(around)}
    score = span.score + 0.3 * bool(words & NAMES[span.kind]) - 0.3 * bool(words & OTHER_USES)
    return span._replace(score=round(min(1.0, max(0.0, score)), 2))


def personal_spans(text: str, threshold: float = THRESHOLD) -> list[Span]:
    """All spans of a text, by kind, then start."""
    found, runs, phones = base_spans(text)
    found = [in_context(text, span) for span in found]
    more = [in_context(text, span) for span in proposals(text, runs, phones)]
    more = [span for span in more if span.score >= threshold]
    if more:
        # What is taken, merged into ranges that do not touch, so that a look at two of them is
        # enough; base spans of different kinds may overlap.
        starts, ends = [], []
        for span in sorted(found, key=lambda s: s.start):
            if ends and span.start < ends[-1]:
                ends[-1] = max(ends[-1], span.end)
            else:
                starts.append(span.start)
                ends.append(span.end)
        more.sort(key=lambda s: (-s.score, s.start, -s.end, KINDS.index(s.kind)))
        for span in more:
            at = bisect_left(starts, span.end)
            if at and ends[at - 1] > span.start:
                continue
            starts.insert(at, span.start)
            ends.insert(at, span.end)
            found.append(span)
    return sorted(found, key=lambda s: (KINDS.index(s.kind), s.start))


def find_personal_data(
    documents: DataFrame, text: str = "text", threshold: float = THRESHOLD,
) -> DataFrame:
    """``documents`` with ``spans``: kind, start and end (code points, end exclusive), score, and
    whether the span is a base one.

    One row in, one row out, no shuffle. Spans are sorted by kind (email, ip, card, phone, iban,
    ssn), then start; added spans overlap neither each other nor a base span, and of two that would
    the higher score stays, then the earlier, then the longer. Null and empty texts have no spans;
    very long texts are read whole in linear time; repeated rows are read each; an empty table gives
    an empty table; an input column named ``spans`` is replaced.
    """
    python_tasks(documents.sparkSession)

    @F.arrow_udf(SPANS)
    def spans(texts: pa.Array) -> pa.Array:
        rows = (personal_spans(t, threshold) if t else [] for t in texts.to_pylist())
        return pa.array([[s._asdict() for s in row] for row in rows], SPAN_TYPE)

    return documents.withColumn("spans", spans(F.col(text)))


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
    )), ",")
