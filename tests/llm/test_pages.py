from __future__ import annotations

import html
import re
import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from reelgauge.llm.html_extraction import extract_text, main_text

PROSE = "The cat is on the mat and the dog was in the house with all of the others. "


class Article(HTMLParser):
    """The text of the article element by the standard library's parser, block by block."""

    def __init__(self):
        super().__init__()
        self.depth, self.blocks = 0, [""]

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        self.blocks.append("") if tag in ("p", "h1", "article") else None
        if tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        self.blocks.append("") if tag in ("p", "h1", "article") else None
        self.depth -= tag == "article"

    def handle_data(self, data):
        if self.depth:
            self.blocks[-1] += data

    def text(self) -> str:
        lines = (" ".join(b.split()) for b in self.blocks)
        return "\n".join(line for line in lines if line)


def test_articles_of_the_table(spark):
    from reelgauge.llm.queries import op3_html_extraction

    folder = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = op3_html_extraction(spark, folder).collect()
    assert len(rows) == len(pages)
    for r in rows:
        parser = Article()
        parser.feed(pages[r["page_id"]])
        assert r["text"] == parser.text()
        assert r["n_chars"] == len(r["text"])


def test_what_stands_beside_an_article_goes():
    article = f"<article><h1>A title</h1><p>{PROSE * 3}</p><p>Short.</p><p>{PROSE * 3}</p></article>"
    beside = [
        f"<nav><ul><li><a href=x>{PROSE}</a></li></ul></nav>", f"<aside><p>{PROSE * 5}</p></aside>",
        f"<header><p>{PROSE * 4}</p></header>", f"<div class='cookie-notice'><p>{PROSE * 4}</p></div>",
        f"<div id=sidebar>{PROSE * 4}</div>", f"<form><p>{PROSE * 4}</p><input></form>",
        f"<section class=\"comments\"><p>{PROSE * 4}</p></section>", f"<script>{PROSE}</p></script>",
        f"<style>{PROSE}</style><!-- {PROSE} -->", f"<footer>&copy; {PROSE * 4}</footer>",
    ]
    expected = "\n".join(["A title", (PROSE * 3).strip(), "Short.", (PROSE * 3).strip()])
    assert main_text("<body>" + "".join(beside) + article + "".join(beside)) == expected
    inner = article.replace("</article>", "".join(beside[6:]) + "</article>")
    assert main_text(inner) == expected


def test_pages_without_an_article_element():
    menu = "".join(f"<li><a href='/{i}'>Entry {i}</a></li>" for i in range(8))
    page = f"<ul>{menu}</ul><div><p>{PROSE * 4}</p><p>Short.</p><p>{PROSE * 4}</p></div><p>© me</p>"
    assert main_text(page).split("\n") == [(PROSE * 4).strip(), "Short.", (PROSE * 4).strip()]


def test_odd_markup():
    assert main_text(None) == main_text("") == main_text("<script>x") == ""
    assert main_text("<article>a &lt;b&gt; &amp;amp; c\u00a0d<br>e") == "a <b> &amp; c d e"
    assert main_text("<article><p>one<p>two") == "one\ntwo"
    assert main_text("<article>1 < 2 and \"<a title='x>y'>z</a>\" and more words</article>") \
        == "1 < 2 and \"z\" and more words"
    assert len(main_text("<article>" + "<p>word word</p>" * 20_000 + "</article>").split("\n")) == 20_000


def test_skipped_elements_end_where_they_end():
    rest = f"<p>{PROSE * 3}</p><p>{PROSE * 4}</p>"
    expected = "\n".join(["T", (PROSE * 3).strip(), (PROSE * 4).strip()])
    for name in ("svg-icon", "button-group", "title-bar", "select-box", "object-fit", "script-x"):
        tag = f"<{name} name='x'></{name}>"
        assert main_text(f"<article><h1>T</h1>{tag}{rest}</article>") == expected
        real = name.split("-")[0]
        after = f"<{real}>gone</{real}>"
        assert main_text(f"<article><h1>T</h1>{tag}{rest}{after}</article>") == expected
    for name in ("button", "select", "object", "svg", "iframe", "template", "noscript"):
        assert main_text(f"<article><h1>T</h1><{name} a=b>{rest}</article>") == expected
        closed = f"<{name}>gone <{name.upper()} x>too</{name}> gone</{name}\n><{name}/>"
        assert main_text(f"<article><h1>T</h1><{name}>{rest}{closed}</article>") == expected
        assert main_text(f"<article><h1>T</h1>{closed}{rest}</article>") == expected
        script = f"<script>'<{name}>'</script><!-- <{name}> -->"
        assert main_text(f"<article>{script}<h1>T</h1>{rest}</{name}></article>") == expected
    for name in ("script", "style", "title", "textarea"):
        assert main_text(f"<article><h1>T</h1><{name}>{rest}") == "T"
    page = "<article>" + "<button><svg>" * 20_000 + "<p>end</p></article>"
    assert main_text(page) == "end"


def test_names_and_forms_around_the_whole_text():
    rest = f"<p>{PROSE * 3}</p><p>Short.</p><p>{PROSE * 4}</p>"
    expected = "\n".join([(PROSE * 3).strip(), "Short.", (PROSE * 4).strip()])
    gone = f"<div class=sidebar><p>{PROSE * 3}</p></div><nav><p>{PROSE * 3}</p></nav>"
    for name in ("body class='single-post no-sidebar'", "div class='content has-sidebar'",
                 "main class='search-results'", "form id=aspnetForm", "body class=search",
                 "html class=hidden", "main class=search", "article class=comments", "div class=widget"):
        tag = name.split()[0]
        assert main_text(f"<{name}>{rest}</{tag}>") == expected, name
        assert main_text(f"<{name}>{gone}{rest}{gone}</{tag}>") == expected, name
    page = f"<form><div id=search><div class=modal>{gone}<div>{rest}</div>{gone}</div></div></form>"
    assert main_text(page) == expected
    article = f"<article>{rest}<div class=left-sidebar><p>{PROSE * 3}</p></div></article>"
    assert main_text(f"<form id=f>{gone}{article}{gone}</form>") == expected
    comment = f"<div id=comments><article class='comment'><p>{PROSE * 2}</p></article></div>"
    assert main_text(f"<main>{rest}{comment}</main>") == expected
    assert main_text(f"<main>{rest}</main>{comment * 9}") == expected
    assert main_text(f"<aside>{rest}</aside>") == main_text(f"<footer>{rest}</footer>") == ""


def test_rows(spark):
    rows = [(1, "u", None, "old"), (2, None, "", "old"), (3, "u", "<article><p>é😀</p>", "old")]
    pages = spark.createDataFrame(rows * 2, "page_id long, url string, html string, text string")
    found = extract_text(pages)
    assert sorted(found.columns) == ["html", "n_chars", "page_id", "text", "url"]
    assert sorted((r["page_id"], r["text"], r["n_chars"]) for r in found.collect()) == sorted(
        [(1, "", 0), (2, "", 0), (3, "é😀", 2)] * 2
    )
    assert extract_text(pages.where(F.lit(False))).count() == 0


def test_markup_never_remains(spark):
    for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        text = main_text(r["html"])
        assert not re.search(r"</?(p|b|article|nav|div)\b", text)
        assert html.escape(text, quote=False).count("&amp;nbsp;") == 0


def test_reader_comments_and_adverts_within_an_article_go():
    wanted = f"{PROSE * 3}".strip()
    for name in ("post-comments", "ad-slot", "commentList", "comment-thread", "advert_box", "site_nav",
                 "cookie-bar-wide"):
        page = f"<article><p>{PROSE * 3}</p><div class='{name}'><p>{PROSE * 2}</p></div></article>"
        assert main_text(page) == wanted, name
    for name in ("no-comments", "has-sidebar", "with-ads", "search-results", "post-content", "admin"):
        page = f"<article><div class='{name}'><p>{PROSE * 3}</p></div></article>"
        assert main_text(page) == wanted, name


def test_a_title_between_menu_and_text_stays():
    menu = "<div><a href=a>One</a> <a href=b>Two</a> <a href=c>Three</a></div>"
    page = f"<body>{menu}<h1>A title</h1><p>{PROSE * 4}</p></body>"
    assert main_text(page).splitlines() == ["A title", (PROSE * 4).strip()]
    page = f"<body><p>{PROSE * 4}</p><h2>More</h2>{menu}</body>"
    assert main_text(page) == (PROSE * 4).strip()


def test_hidden_parts_go():
    for hidden in ("hidden", "hidden=''", "style='color:red; display: none'", 'style="display:none"'):
        page = f"<article><p>{PROSE * 3}</p><div {hidden}><p>{PROSE * 3}</p></div></article>"
        assert main_text(page) == (PROSE * 3).strip(), hidden
    page = f"<article><p data-hidden=1 style='display:block'>{PROSE * 3}</p></article>"
    assert main_text(page) == (PROSE * 3).strip()


def test_other_languages_without_an_article():
    line = "Съешь же ещё этих мягких французских булок, да выпей чаю. " * 5
    page = f"<nav><a href=x>дом</a></nav><div><a href=y>{line[:80]}</a></div><p>{line}</p><p>{line}</p>"
    assert main_text(page) == "\n".join([line.strip()] * 2)


@pytest.mark.parametrize("bit", [
    "<style ", "<script ", "<script>", "<title ", "<svg ", "<!--", "<a href='", '<a "', "<button ",
    "</", "<style/", "<textarea", "&", "&#", "<p hidden ", "< ", "<b class=\"x",
])
def test_a_megabyte_of_unclosed_tags_is_read_in_linear_time(bit):
    page = f"<p>{PROSE * 3}</p>" + bit * ((1 << 20) // len(bit))
    start = time.perf_counter()
    main_text(page)
    assert time.perf_counter() - start < 8
