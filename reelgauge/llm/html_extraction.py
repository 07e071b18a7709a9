"""Main text of web pages by two passes over their blocks.

The first pass decides blocks on their own: by where they stand, by their link density, length and
density of stop words. What is short or in between stays open; the second pass gives it the label
of the nearest decided blocks before and after it.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelgauge.llm.common import python_tasks

# Frequent words of English, German, French and Spanish.
STOP_WORDS = frozenset("""
a an and are as at be been but by for from had has have he her his i in is it its not of on or
she so that the their there they this to was we were what when which who will with you
aber als am an auch auf aus bei das dem den der des die durch ein eine er es für haben hat ich ihr
im ist mit nach nicht noch nur oder sein sich sie sind so über um und von war wenn werden wie zu
au aux avec ce cette dans de des du elle en est et il ils je la le les leur mais ne nous on ou par
pas plus pour que qui sa se ses son sont sur un une vous
al como con de del el ella en entre es esta este la las lo los más no para pero por que se sin
sobre su sus también un una y ya
""".split())

# Elements by their part in a page.
RAW_TEXT = "script|style|title|textarea"
SKIPPED = "noscript|template|svg|iframe|select|button|object"
INLINE = frozenset("""
a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s
samp small span strike strong sub sup time tt u var wbr
""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BESIDE = frozenset("nav aside footer menu dialog".split())
NEVER_BESIDE = frozenset("html body main".split())
# Words in class, id and role that mark what stands beside an article, and words that
# may stand with them: cookie-notice and left-sidebar are marks, no-sidebar and search-results not.
BESIDE_NAMES = frozenset("""
ad ads adv advert advertisement adverts banner sponsor sponsored promo promotion comment comments
reply replies disqus respond sidebar widget nav navbar navigation menu breadcrumb breadcrumbs
footer masthead cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe
subscription share sharing social related recommended pagination pager login signup search form
copyright legal disclaimer hidden skip toolbar complementary contentinfo
""".split())

NEUTRAL_NAMES = frozenset("""
left right top bottom main site global primary secondary area bar block box inner item items link
links list outer section
""".split())

# Words that make a name a mark where it ends in them (post-comments), where it begins
# with them (ad-slot), and words that say that a page has, or has not, what is named after them.
MARKING_TAILS = frozenset("""
ad ads advert adverts advertisement comment comments disqus replies sidebar nav navbar navigation
menu breadcrumb breadcrumbs footer cookies newsletter promo sponsored
""".split())
MARKING_HEADS = frozenset("""
ad ads advert advertisement comment comments cookie disqus newsletter promo sidebar sponsored
""".split())
OF_THE_PAGE = frozenset("no not has have with without".split())

LENGTH_LOW = 70
LENGTH_HIGH = 200
STOP_LOW = 0.15
STOP_HIGH = 0.30
LINKS_OUTSIDE = 0.2
LINKS_INSIDE = 0.5

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({RAW_TEXT})(?=[\s/>])[^>]*+(?:(?<=/)>|>.*?(?:</\1\s*>|\Z))"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[/!?a-zA-Z][^>]*+(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
SKIPPED_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style)(?=[\s/>])[^>]*+(?:(?<=/)>|>.*?(?:</\1\s*>|\Z))"
    rf"|<(/?)({SKIPPED})(?=[\s/>])[^>]*+>"
    r"|<[a-zA-Z/][^>]*+\Z",  # a tag without an end: no other can follow
    re.DOTALL | re.IGNORECASE,
)
SKIPPED_NAMES = frozenset(SKIPPED.split("|"))
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
HIDDEN = re.compile(
    r"(?:^|[\s\"'])hidden(?=[\s/=]|\Z)|\bstyle\s*=\s*[\"']?[^\"'>]*?\bdisplay\s*:\s*none\b",
    re.IGNORECASE,
)
HEADING = re.compile(r"h[1-6]")
NAME_PART = re.compile(r"[a-z]+|[A-Z][a-z]*")
LETTERS = re.compile(r"[^\W\d_]+")


@dataclass(eq=False)
class Part:
    """An element that makes what is in it article or beside.

    Elements that are beside by their name, and forms, may turn out to hold the article.
    """

    beside: bool
    doubtful: bool = False
    rich: int = 0


@dataclass
class Block:
    """A run of text between two block elements, with the parts it is in, the innermost last."""

    within: tuple[Part, ...] = ()
    parts: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    text: str = ""
    label: str = ""
    inside: bool = False
    beside: bool = False
    heading: bool = False

    @cached_property
    def links(self) -> float:
        return len(" ".join(html.unescape("".join(self.linked)).split())) / len(self.text)

    @cached_property
    def stops(self) -> float:
        words = LETTERS.findall(self.text.lower())
        return sum(map(STOP_WORDS.__contains__, words)) / len(words) if words else 0.0


def beside_by_name(attributes: str) -> bool:
    """Whether a whole class, id or role is a mark.

    All its words are marks or neutral ones, or it ends in, or begins with, a word that makes it one;
    unless a word says that it is the page that has, or has not, what is named.
    """
    for match in NAMED.finditer(attributes):
        for token in (match[1] or match[2] or match[3] or "").split():
            words = [part.lower() for part in NAME_PART.findall(token)]
            if not words or not OF_THE_PAGE.isdisjoint(words):
                continue
            if words[-1] in MARKING_TAILS or words[0] in MARKING_HEADS:
                return True
            every = set(words)
            if not every.isdisjoint(BESIDE_NAMES) and every <= BESIDE_NAMES | NEUTRAL_NAMES:
                return True
    return False


def part_of(name: str, attributes: str, within: tuple[Part, ...]) -> Part | None:
    """What an element makes of what is in it; None: nothing new."""
    if name in BESIDE or attributes and name not in NEVER_BESIDE and HIDDEN.search(attributes):
        return Part(True)
    # An article within another, or within what stands beside, may be a comment or a teaser.
    named = name not in NEVER_BESIDE and (name != "article" or bool(within))
    if name == "form" or named and "=" in attributes and beside_by_name(attributes):
        return Part(True, doubtful=True)
    if name in ("article", "main"):
        return Part(False)
    if name == "header" and all(part.beside for part in within):
        return Part(True)
    return None


def skipped_parts(page: str) -> dict[int, int]:
    """Where the skipped elements that are closed begin and end.

    An end tag closes the last open element of its name, so one left open takes nothing with it.
    """
    opened: dict[str, list[int]] = {}
    ends: dict[int, int] = {}
    for match in SKIPPED_TAG.finditer(page):
        if match[3] is None:
            continue
        starts = opened.setdefault(match[3].lower(), [])
        if not match[2]:
            if not match[0].endswith("/>"):
                starts.append(match.start())
        elif starts:
            ends[starts.pop()] = match.end()
    return ends


def blocks(page: str) -> list[Block]:
    """The blocks of a page in page order, with their text in one line each."""
    found: list[Block] = []
    # Open elements that matter: their name, and the parts that what is in them is in.
    opened: list[tuple[str, tuple[Part, ...]]] = []
    links, breaks, at = 0, 0, 0
    block = Block()

    def close() -> None:
        nonlocal block, breaks
        if block.parts:
            block.text = " ".join(html.unescape("".join(block.parts)).split())
            if block.text:
                found.append(block)
        block, breaks = Block(opened[-1][1] if opened else ()), 0

    def text(part: str) -> None:
        nonlocal breaks
        if part:
            block.parts.append(part)
            if links:
                block.linked.append(part)
            if breaks and not part.isspace():
                breaks = 0

    skipped = skipped_parts(page)
    while match := TOKEN.search(page, at):
        text(page[at:match.start()])
        at = skipped.get(match.start(), match.end())
        name = match[3]
        if name is None or name.lower() in SKIPPED_NAMES:
            continue
        name, closing, attributes = name.lower(), bool(match[2]), match[4]
        if name == "a":
            links = 0 if closing else 1
        if name == "br":
            breaks += 1
            if breaks > 1:
                close()
            else:
                block.parts.append(" ")
            continue
        if closing:
            depth = next((k for k in range(len(opened) - 1, -1, -1) if opened[k][0] == name), None)
            if depth is not None:
                del opened[depth:]
        elif name not in VOID:
            if name == "p":  # a paragraph ends the one before it
                while opened and opened[-1][0] == "p":
                    opened.pop()
            within = opened[-1][1] if opened else ()
            part = part_of(name, attributes, within)
            if part or name not in INLINE and name not in ("p", "li", "html", "body", "head"):
                opened.append((name, (*within, part) if part else within))
        if name not in INLINE or opened and opened[-1][0] == name:
            links = 0 if name not in INLINE else links
            close()
            block.heading = not closing and HEADING.fullmatch(name) is not None
    text(page[at:])
    close()
    settle(found)
    return found


def settle(found: list[Block]) -> None:
    """Whether blocks are article or beside: what their innermost part says.

    A doubtful part with more than half of the page's long text rich in stop words says nothing;
    its blocks are judged like those around it.
    """
    total = 0
    if any(part.doubtful for b in found for part in b.within):
        for b in found:
            if len(b.text) >= LENGTH_LOW and b.links <= LINKS_OUTSIDE and b.stops >= STOP_HIGH:
                total += len(b.text)
                for part in b.within:
                    part.rich += len(b.text)
    for b in found:
        told = [part for part in b.within if not part.doubtful or 2 * part.rich <= total]
        b.beside = bool(told) and told[-1].beside
        b.inside = bool(told) and not told[-1].beside


def label(block: Block, has_article: bool, known: bool = True) -> str:
    """What a block is by itself: good, bad, or open (near or short).

    ``known`` says that the page is in a language whose stop words are known; otherwise length and
    links alone decide.
    """
    if block.beside or has_article and not block.inside:
        return "bad"
    size = len(block.text)
    if block.links > (LINKS_INSIDE if block.inside else LINKS_OUTSIDE):
        return "bad"
    if "©" in block.text and size < LENGTH_HIGH and not block.inside:
        return "bad"
    if size < LENGTH_LOW:
        return "short"
    if block.stops >= STOP_HIGH or not known:
        return "good" if size >= LENGTH_HIGH or block.inside else "near"
    if block.stops >= STOP_LOW:
        return "good" if block.inside else "near"
    return "near" if block.inside else "bad"


def main_text(page: str | None) -> str:
    """The good blocks of a page, one per line."""
    if not page:
        return ""
    found = blocks(page)
    has_article = any(b.inside and not b.beside for b in found)
    known = any(b.stops >= STOP_LOW for b in found if len(b.text) >= LENGTH_LOW and not b.beside)
    for b in found:
        b.label = label(b, has_article, known)
    inner = [b for b in found if b.inside and not b.beside] if has_article else found
    before: list[tuple[str, int]] = []
    last = ("", -1)
    for i, b in enumerate(inner):
        before.append(last)
        if b.label in ("good", "bad"):
            last = (b.label, i)
    after = ("", -1)
    for i in range(len(inner) - 1, -1, -1):
        b = inner[i]
        if b.label in ("good", "bad"):
            after = (b.label, i)
            continue
        near = [(abs(i - k), name) for name, k in (before[i], after) if name]
        if not near:  # nothing on the page, or in its article, is decided
            own = True
        elif len({name for _, name in near}) == 1:
            own = near[0][1] == "good"
        elif near[0][0] == near[1][0]:
            # Of equally near ones a heading follows what it stands over.
            own = has_article or b.label == "near" or b.heading and after[0] == "good"
        else:
            own = min(near)[1] == "good"
        b.label = b.label + (" good" if own else " bad")
    return "\n".join(b.text for b in inner if b.label.endswith("good"))


def extracted(page: Column) -> Column:
    @F.arrow_udf("string")
    def texts(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p) for p in pages.to_pylist()], pa.string())

    return texts(page)


def extract_text(pages: DataFrame, page: str = "html") -> DataFrame:
    """``pages`` with ``text`` (empty if a page has none) and ``n_chars`` (its code points).

    One row in, one row out, no shuffle. Null and empty pages have the empty text; broken markup is
    read as far as it goes; very long pages are read whole, in linear time; repeated rows are read
    each; an empty table gives an empty table; input columns named like a result are replaced.
    """
    python_tasks(pages.sparkSession)
    found = pages.withColumn("text", extracted(F.col(page)))
    return found.withColumn("n_chars", F.length("text").cast("long"))
