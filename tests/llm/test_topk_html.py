import math

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rampart.llm import html_text, topk


def _brute(rows, k=5, step=50):
    ok = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in ok if i % step == 0}):
        mine = min(v for i, v in ok if i == q)
        best = sorted((-sum(a * b for a, b in zip(mine, v)), i) for i, v in ok if i != q and len(v) == len(mine))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def _run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, id int, score int").repartition(4)
    got = topk.top_k(df, F.col("id") % 50 == 0, **kw)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, got.collect()))


def test_top_k_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=24) * (1 + i % 5)).astype(np.float32).tolist()) for i in range(600)]
    for i in range(100, 140):
        rows[i] = (i, rows[100][1])                                # a vector that many rows share: ties
    rows += [(1000, None), (1050, []), (1100, [float("nan")] * 24), (1150, [1.0, None] * 12), (1200, [float("inf")] + [0.0] * 23),
             (None, rows[3][1]), (1250, [0.0] * 24), (300, rows[300][1])]
    monkeypatch.setattr(topk, "TILE", 64)
    want = _brute(rows)
    assert _run(spark, rows) == want
    monkeypatch.setattr(topk, "QUERY_ROWS", 4)
    assert _run(spark, rows) == want


def test_one_block_of_queries_at_a_time(spark, monkeypatch):
    """Each block's result is written before the next block's rows are collected."""
    monkeypatch.setattr(topk, "QUERY_ROWS", 7)
    log, write = [], topk.store.write
    monkeypatch.setattr(topk.store, "write", lambda df, name: log.append(name) or write(df, name))
    rows = [(i, [float((i * 7919 + j * 31) % 17) / 8 for j in range(6)]) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(df, F.col("id") % 4 == 0, k=3).count()
    assert got == 30 * 3 and 4 <= log.count("found") <= 5


def test_few_or_no_candidates(spark):
    assert _run(spark, []) == []
    assert _run(spark, [(50, [1.0, 2.0])]) == []
    assert _run(spark, [(50, [1.0, 2.0]), (1, [1.0, 0.0]), (2, [1.0])]) == [(50, 1, 1, 65536)]


def test_sql_equals_brute_force():
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(120)]
    embeddings = pd.DataFrame({"vec_id": [r[0] for r in rows], "embedding": [r[1] for r in rows]})
    assert len(embeddings) and sorted(duckdb.sql(topk.OP5_SQL).fetchall()) == _brute(rows)


PAGES = {
    "plain": ("<html><head><title>no</title><style>p{}</style></head><body><nav><a href=/>home</a></nav><article><h1>Head &amp; "
              "tail</h1><p>One\n  two<b>bold</b>.<p>Three<br>four &lt;x&gt;</article><footer>&copy; me</footer></body></html>",
              "Head & tail One twobold. Three four <x>"),
    "boilerplate inside": ("<body><header><h1>Site</h1></header><main><article><h1>T</h1><p>text text text</p><aside>see also</aside>"
                           "<div class='share-buttons'>share me</div><form><input><label>mail</label></form><script>var a='<p>no</p>';"
                           "</script><!-- <p>no</p> --><ul><li>one<li>two</ul><table><tr><td>a<td>b</table></article></main>"
                           "<section id=comments><article class='comment'><p>reader says a lot of things at length, again and again"
                           "</p></article></section></body>", "T text text text one two a b"),
    "no article": ("<body><div id=menu><a href=1>a</a><a href=2>b</a></div><div class=cookie-notice>We use cookies on this site to do "
                   "things</div><div><h2>Story</h2><p>The first long paragraph of the story goes on for quite a while here.</p><p>And a "
                   "second one, <a href=x>with a link</a>, that also goes on for a while.</p></div><div><a href=3>next</a> <a href=4>prev"
                   "</a> <a href=5>top</a></div></body>",
                   "Story The first long paragraph of the story goes on for quite a while here. And a second one, with a link, that also "
                   "goes on for a while."),
    "hidden": ("<article><p hidden>no</p><p style='display: none'>no</p><p aria-hidden=true>no</p><p>yes</p><noscript>no</noscript>"
               "<select><option>no</select><button>no</button></article>", "yes"),
    "references": ("<article><p>&eacute;&#233;&#xe9; &nbsp; &amp;amp; &unknown; a&b</p></article>", "ééé &amp; &unknown; a&b"),
    "broken": ("<article><p>a <i>b<p>c</i> d</div> e <br/> f < g <p", "a b c d e f < g <p"),
    "quotes": ("<article><p title='a > b' data-x=\"</article>\">ok</p></article>", "ok"),
    "empty": ("", ""), "text": ("just words", "just words"), "blank": ("<html><body> \n </body></html>", ""),
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text(name):
    page, want = PAGES[name]
    assert html_text.extract(page) == want


LONG = ["word%d goes on " % i * 20 for i in range(4)]
WHOLE = " ".join(" ".join(LONG).split())


@pytest.mark.parametrize("page,want", [
    ("<body><h1>A title of the page</h1><p>" + "x" * 300 + "</p><p>" + "y" * 400 + "</p><p>" + "z" * 130 + "</p><ul><li>one<li>two</ul>"
     "<p>short</p></body>", " ".join(["A title of the page", "x" * 300, "y" * 400, "z" * 130, "one two short"])),
    ("<body><article class='post has-sidebar'><p>" + "<p>".join(LONG) + "</article></body>", WHOLE),
    ("<body><div id=page class=no-comments><form><div class=elementor-widget><p>" + "<p>".join(LONG) + "</div></form></div></body>", WHOLE),
    ("<body><article><p>" + LONG[0] + "<p>" + LONG[1] + "</article><article><p>" + LONG[2] + "<p>" + LONG[3] + "</article></body>", WHOLE),
    ("<body><article><p>" + "<p>".join(LONG) + "<ul><li><a href=1>other one</a><li><a href=2>other two</a></ul></article></body>", WHOLE + " other one other two"),
])
def test_names_are_evidence_only(page, want):
    assert html_text.extract(page) == want


def test_long_and_deep_pages():
    assert html_text.extract("<article>" + "<p>word</p>" * 20000 + "</article>") == " ".join(["word"] * 20000)
    assert html_text.extract("<article>" + "<div>" * 5000 + "deep" + "</div>" * 5000 + "</article>") == "deep"
    assert html_text.extract("<article><p>" + "<b " * 2000 + "</article>") is not None


def test_page_rows(spark):
    rows = [(i, f"u{i}", p, "x") for i, (p, _) in enumerate(PAGES.values())] + [(None, None, None, None), (0, "u0", PAGES["plain"][0], None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(map(tuple, html_text.main_text(df).collect()), key=repr)
    texts = [w for _, w in PAGES.values()] + ["", PAGES["plain"][1]]
    assert got == sorted(((r[0], r[1], t, len(t)) for r, t in zip(rows, texts)), key=repr)
    assert html_text.main_text(df.limit(0)).collect() == []


def test_density_sum_prefers_text():
    root = html_text.parse("<body><div><a href=1>aa</a><a href=2>bb</a></div><div><p>" + "word " * 30 + "</p></div></body>")
    body = html_text.measure(root)
    links, text = (k for k in body.kids if isinstance(k, html_text.Node))
    assert text.density > links.density and text.sum > links.sum and links.lc == 4 and links.lt == 2


# ---- hostile and named pages -------------------------------------------------------------

MB = 1_000_000
HOSTILE = {
    "open name": "<" + "b" * MB, "open quotes": '<a "' * (MB // 4), "open blocks": "<div>" * (MB // 5), "open paragraphs": "<p>x" * (MB // 4),
    "open inlines": "<b>" * (MB // 3), "open items": "<li>x" * (MB // 5), "headers": "<header>x" * (MB // 9),
    "paragraphs in inlines": "<b>" * (MB // 6) + "<p></p>" * (MB // 14), "ends of nothing": "<b>" * (MB // 6) + "</i>" * (MB // 8),
    "open script ends": "<script>" + "</script " * (MB // 9), "values over tags": '<a b="x>' * (MB // 8), "spaces": "<a" + " " * MB,
    "signs": "<" * MB, "comments": "<!--" * (MB // 4), "articles": "<article>x" * (MB // 10), "cells": "<table><tr>" + "<td><b>" * (MB // 7),
    "items below inlines": "<li><ul>" + "<b>" * (MB // 6) + "<li>" * (MB // 8)}


@pytest.mark.parametrize("kind", HOSTILE)
def test_a_megabyte_of_anything_takes_seconds(kind):
    import time
    begin = time.perf_counter()
    html_text.extract(HOSTILE[kind])
    assert time.perf_counter() - begin < 12          # about 1 to 3 s; a quadratic scan takes hours


LONG = "This paragraph of the article is long enough to be its text, and says a thing or two about nothing at all. " * 4


def test_names_inside_words_do_not_take_text():
    page = '<body><nav><a href="/">Home</a> <a href="/b">B</a></nav><article><div class="entry-header"><h1>The headline</h1></div>' \
           f'<p class="search-intro">{LONG}</p><p id="social-contract">{LONG}</p><section id="related-work"><h2>Work</h2><p>{LONG}</p></section>' \
           '<ul><li><a href="/1">First reference</a></li><li><a href="/2">Second reference</a></li></ul></article>' \
           '<div class="ad">Buy now</div><div class="site-menu"><a href="/x">One</a> <a href="/y">Two</a></div></body>'
    text = html_text.extract(page)
    assert text == " ".join(["The headline", LONG.strip(), LONG.strip(), "Work", LONG.strip(), "First reference", "Second reference"])
    assert html_text.extract(page.replace("entry-header", "post-header")) == text


def test_hinted_link_lists_go_and_whole_names_go():
    page = f'<body><div class="left-menu"><a href="/1">One page</a> <a href="/2">Two pages</a></div><div><h1>Head</h1><p>{LONG}</p><p>{LONG}</p></div>' \
           f'<div class="comments"><p>{LONG[:90]}</p></div><div id="page-footer"><a href="/i">Imprint</a></div></body>'
    assert html_text.extract(page) == " ".join(["Head", LONG.strip(), LONG.strip()])


def test_tags_in_one_pass():
    page = 'a<b c="x>y">d</b><!-- <p> -->e<i f=\'>\'>g</i>1 < 2 <3<br/>h<a href="open>k</a>l<![CDATA[m>]]>n<?pi?><u'
    got = [(page[s:e], slash + name) for s, e, slash, name, _ in html_text.tags(page)]
    assert got == [('<b c="x>y">', "b"), ("</b>", "/b"), ("<!-- <p> -->", ""), ("<i f='>'>", "i"), ("</i>", "/i"), ("<br/>", "br"),
                   ('<a href="open>', "a"), ("</a>", "/a"), ("<![CDATA[m>]]>", ""), ("<?pi?>", "")]


def _sums(node):
    """Density sums worked out anew for every node, from its text alone."""
    def text(x, links):
        own = sum(len("".join(k.split())) for k in x.kids if isinstance(k, str)) if not links else 0
        return own + sum(text(k, links and k.tag != "a") for k in x.kids if isinstance(k, html_text.Node) and not k.gone)

    def count(x, links):
        return sum(1 + count(k, False) if not links else (1 + count(k, False) if k.tag == "a" else count(k, True))
                   for k in x.kids if isinstance(k, html_text.Node) and not k.gone)

    def density(x, body):
        c, t = text(x, False), max(count(x, False), 1)
        if not c:
            return 0.0
        inside = x.tag == "a"
        lc, lt = (c, count(x, False)) if inside else (text(x, True), count(x, True))
        whole, share = max(text(body, False), 1), text(body, True)
        base = math.log(c / max(c - lc, 1) * lc + share / whole * c + math.e)
        ratio = c / max(lc, 1) * t / max(lt, 1)
        return c / t * (math.log(ratio) / math.log(base) if base > 1.0 + 1e-9 else math.log(ratio))
    return text, density


def test_density_sums_equal_slow_ones():
    page = f'<body><div><a href="/">Home</a> <a href="/x">Extra</a></div><div><h1>Head</h1><p>{LONG}</p><p>Short <b>bold</b> one.</p>' \
           f'<ul><li>item one</li><li><a href="/q">item two</a></li></ul></div><p>{LONG[:200]}</p></body>'
    root = html_text.parse(page)
    body = html_text.measure(root)
    text, density = _sums(root)
    for x in html_text.walk(root):
        assert x.c == text(x, False), x.tag
        if x.tag != "a" and not any(k.tag == "a" for k in html_text.walk(x)):
            assert math.isclose(x.density, density(x, body), rel_tol=1e-9), x.tag
        kids = [k for k in x.kids if isinstance(k, html_text.Node)]
        assert math.isclose(x.sum, sum(k.density for k in kids) if kids else x.density, rel_tol=1e-9, abs_tol=1e-9)
