from __future__ import annotations

import html
import math
import random
import re
import time

import pytest

from itemstats.llm import html_text
from itemstats.llm.common import table

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><NAV><ul><li><a href="/a">menu</a></li></ul></NAV><div class="sidebar"><p>side text side text side text</p></div>
<main><article><header><h1>Title &amp; more</h1><p class="byline">by x</p></header><!-- <p>no</p> --><p>one <i>two</i>
 three<br>four</p><p><b>five<br><p>x &eacute;</p><aside>related</aside><form><p>mail</p></form><div class="ad">buy</div></article>
<section id="comments"><article class="comment"><p>I like it very much indeed</p></article></section></main>
<div class="cookie-notice">we use cookies</div><footer>&copy; site</footer></body></html>"""


def test_article_without_the_rest():
    assert html_text.main_text(PAGE) == "Title & more\none two three four\nfive\nx \u00e9"


def test_density_without_an_article_element():
    page = """<body><div id=top><a href=x>home</a> <a href=y>about</a></div><div class=body><h2>Head of it</h2><div><p>long text of the
    article that goes on and on and on</p><p>another paragraph which has many words in it too</p></div><div><p>second section long enough to
    count as content here</p></div></div><ul><li><a href=1>l1</a></li><li><a href=2>l2</a></li></ul></body>"""
    got = html_text.main_text(page)
    assert "long text of the article" in got and "second section" in got and "another" in got
    assert "home" not in got and "l1" not in got


A, B, C = (f"{c * 4} " * n for c, n in (("a", 125), ("b", 150), ("c", 175)))


@pytest.mark.parametrize(
    "inner",
    [
        f"<div id=content><h1>The title</h1><p>{A}</p><p>Yes</p><div><p>{B}</p><p>{C}</p></div></div>",
        f"<div id=content><div><h1>The title</h1></div><div><p>{A}</p><p>Yes</p><div><p>{B}</p><p>{C}</p></div></div></div>",
        f"<h1>The title</h1><div><p>{A}</p><p>Yes</p></div><div><p>{B}</p><p>{C}</p></div>",
        f"<div><h1>The title</h1><div><p>{A}</p></div><p>Yes</p><p>{B}</p><p>{C}</p></div>",
    ],
)
def test_headings_and_short_paragraphs_without_an_article_element(inner):
    top, end = "<div id=top><a href=x>home</a> | <a href=y>about</a></div>", "<ul><li><a href=1>l1</a></li><li><a href=2>l2</a></li></ul>"
    want = "\n".join(["The title", A.strip(), "Yes", B.strip(), C.strip()])
    assert html_text.main_text(f"<html><body>{inner}</body></html>") == want
    assert html_text.main_text(f"<html><body><div>{top}{inner}{end}</div></body></html>") == want
    assert html_text.main_text(f"<html><body>{top}{inner}{end}<footer>site</footer></body></html>") == want


def test_headings_of_a_page_without_an_article_element():
    page = f"<body><div id=x><h2>Head of it</h2><div><p>{A}</p></div><h3>Next</h3><p>No.</p><div><p>{B}</p></div><p>End</p></div></body>"
    assert html_text.main_text(page) == "\n".join(["Head of it", A.strip(), "Next", "No.", B.strip(), "End"])


@pytest.mark.parametrize("page,text", [(None, ""), ("", ""), ("plain &lt; text", "plain < text"), ("<div></div>", ""), ("<p>a<p>b", "a\nb"),
                                       ("<script>x", ""), ("a < b", "a < b"), ("<p>" * 3000 + "deep" + "</p>", "deep"), ("<div>" * 5000 + "x", "x")])
def test_edges(page, text):
    assert html_text.main_text(page) == text


def test_whole_table_equals_the_article_element(spark):
    """Brute force on the generated pages: the text between the article tags, split at its blocks."""
    pages = table(spark, "/root/testdata/sf0.001", "pages")
    got = {r["page_id"]: r for r in html_text.extract(pages.selectExpr("*", "1 AS text", "2 AS n_chars")).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        article = r["html"][r["html"].index("<article>") + 9 : r["html"].index("</article>")]
        parts = (" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>", article))
        want = "\n".join(p for p in parts if p)
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)


def test_empty_table_and_nulls(spark):
    df = spark.createDataFrame([(1, None, None), (1, "u", "<p>a"), (None, "v", "")], "page_id long, url string, html string")
    assert sorted((r["page_id"] or 0, r["text"]) for r in html_text.extract(df).collect()) == [(0, ""), (1, ""), (1, "a")]
    assert html_text.extract(df.limit(0)).collect() == []


LONG = "many words of prose that belong to the article and say something at length. " * 4


@pytest.mark.parametrize(
    "name,inner,stays",
    [
        ("related-work", f"<h2>Related work</h2><p>{LONG}</p>", True),
        ("search-results", f"<p>{LONG}</p><p>{LONG}</p>", True),
        ("related-posts", "<ul><li><a href=1>one post</a></li><li><a href=2>another post</a></li></ul>", False),
        ("related-posts", f"<p><a href=1>{LONG}</a></p><p>x</p>", False),
        ("share-buttons", "<span>tweet</span><span>send</span>", False),
        ("related", f"<p>{LONG}</p>", False),
        ("ad-slot", f"<p>{LONG}</p>", False),
        ("cookie-notice", f"<p>{LONG}</p>", False),
        ("right-sidebar", f"<p>{LONG}</p>", False),
        ("related-work sidebar", f"<p>{LONG}</p>", False),
    ],
)
@pytest.mark.parametrize("attribute", ["class", "id"])
def test_marked_blocks_inside_an_article(attribute, name, inner, stays):
    page = f"<body><nav>menu</nav><article><h1>T</h1><p>{LONG}</p><section {attribute}='{name}'>{inner}</section><p>{LONG}</p></article></body>"
    own = [" ".join(b.split()) for b in re.findall("<(?:h2|p)>(.*?)</", inner)] if stays else []
    assert html_text.main_text(page) == "\n".join(["T", LONG.strip(), *own, LONG.strip()])


def test_doubtful_blocks_in_each_other_and_alone():
    alone = f"<article><div class=related-work><p>{LONG}</p><div class=search-results><p>{LONG}</p></div></div></article>"
    assert html_text.main_text(alone) == "\n".join([LONG.strip()] * 2)
    sparse = f"<article><p>{LONG}</p><div class=related-work><p>a</p><div class=search-results><p>b</p></div></div></article>"
    assert html_text.main_text(sparse) == LONG.strip()


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 50_000 + "x",
        "<div>" * 50_000 + "x" + "</section>" * 50_000,
        "<i><div>" + "<b>" * 50_000 + "</i>" * 50_000,
        "<b>" * 50_000 + "<p>x</p>" * 20_000,
        "<div><p>aa aa</p>" * 30_000,
        "<article>" + "<div class=related-work>x y" * 50_000,
        "<div><article>" * 30_000 + "x",
    ],
)
def test_time_is_linear_in_depth(page):
    """A tenth of the page takes about a tenth of the time (a hundredth, were the time quadratic)."""

    def seconds(text):
        start = time.process_time()
        html_text.main_text(text)
        return time.process_time() - start

    assert seconds(page) < 40 * max(seconds(page[: len(page) // 10]), 0.02)


def made_page(rnd):
    tags = "div p section b i a span ul li h1 h2 td".split()
    out = []
    for _ in range(rnd.randrange(1, 40)):
        k, t = rnd.random(), rnd.choice(tags)
        out.append(f"<{t}>" if k < 0.45 else f"</{t}>" if k < 0.75 else " ".join("w" * rnd.randrange(1, 9) for _ in range(rnd.randrange(1, 30))))
    return "".join(out)


def test_densities_and_container_by_brute_force():
    """Every figure of every node from its whole subtree, and what lies around the chosen subtrees."""
    rnd = random.Random(3)

    def below(n):
        return [x for c in n.children if isinstance(c, html_text.Node) for x in (c, *below(c))]

    def chars(n):
        return sum(len("".join(c.split())) if isinstance(c, str) else chars(c) for c in n.children)

    def links(n):
        return chars(n) if n.tag == "a" else sum(links(c) for c in n.children if isinstance(c, html_text.Node))

    for _ in range(400):
        root = html_text.parse(made_page(rnd))
        share = links(root) / max(chars(root), 1)

        def density(n):
            c, k, l, m = chars(n), max(len(below(n)), 1), links(n), sum(x.tag == "a" for x in below(n))
            if not c or not l:
                return c / k
            base = math.log(c / max(c - l, 1) * l + share * c + math.e)
            return c / k * math.log(max(c / l * k / max(m, 1), 1)) / math.log(max(base, 1.0001))

        for n in html_text.densities(root):
            own = [density(c) for c in n.children if isinstance(c, html_text.Node)]
            assert (n.chars, n.tags, n.links) == (chars(n), len(below(n)), links(n))
            assert n.density == pytest.approx(density(n)) and n.total == pytest.approx(sum(own) or n.density)
        # the core is in the text, whole
        core = max([root, *below(root)], key=lambda n: n.total)
        text = "".join(html_text.blocks([core]).split())
        assert text in "".join(html_text.blocks(html_text.content(root)).split())
