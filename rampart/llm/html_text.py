"""Main text of web pages (operator 10) by composite text density.

Per DOM node: C characters, T tags, LC and LT those inside links, all over its
subtree.  The composite density is characters per tag, cut by the share of links:

    C/T * log_b(C/LC * T/LT),   b = ln(C/(C-LC) * LC + LC_body/C_body * C + e)

A node's density sum adds the densities of its children.  On every page the node with
the largest sum is taken, and the smallest density on its path from body is the least
density of text; the region is the lowest node above it that holds every node that
dense, and its whole text is given.  Tags and names are evidence only: inside an
article or main the region is that element, and a region whose article (else main)
elements hold most of its text outside links is cut to those.  Elements named as
something else (by tag, role, or a whole class or id) are taken out unless they wrap
most of the page's text outside links; where a part of a class or id says so, only if
the element is mostly links or a short text without paragraphs.  Of a region outside articles, blocks that are mostly
links and less dense than text are left out.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split())
GONE = frozenset(
    "head script style noscript template button select textarea input option title "
    "iframe object svg canvas noembed noframes xmp audio video map".split())
ASIDE = frozenset("nav footer aside form menu dialog".split())
ENDS_P = frozenset(
    "address article aside blockquote body center details dialog dir div dl fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
SIBLING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
           "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
           "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "thead", "tbody"), "thead": ()}
SCOPE = frozenset("ul ol dl table div article section body main aside nav form blockquote".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu "
                  "menubar toolbar".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox banner promo promotion sponsor sponsored "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
    "subscription sidebar rail widget menu nav navbar navigation breadcrumb breadcrumbs masthead header footer "
    "comment comments commentlist disqus reply replies respond discussion share sharing social related recommended "
    "recommendations pagination pager toolbar login signup search skip hidden".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd".split())
SHORT = 100
_OPEN = re.compile(r"<(?:(!--)|(!\[CDATA\[)|([!?])|(/?)([A-Za-z][^\s/>]*+))")
_STEP = re.compile(r"[=>]")
_SPACE = re.compile(r"\s*+")
_ATTR = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Node:
    """``block`` is the nearest node from here up that is no inline element, ``scope``
    the nearest that rows and items do not reach beyond (with its open ``items``), and
    ``in_text`` tells whether an article or main is among this node and those above."""
    __slots__ = ("tag", "up", "kids", "gone", "named", "hinted", "block", "scope", "items", "in_text", "c", "t", "lc",
                 "lt", "density", "sum")

    def __init__(self, tag: str, up: Node | None, gone: bool):
        self.tag, self.up, self.gone, self.named, self.hinted = tag, up, gone, False, False
        self.block = up.block if up is not None and tag in INLINE else self
        self.scope = up.scope if up is not None and tag not in SCOPE else self
        self.items: list[Node] = []
        self.in_text = tag in ("article", "main") or (up is not None and up.in_text)
        self.kids: list[Node | str] = []
        self.c = self.t = self.lc = self.lt = 0
        self.density = self.sum = 0.0


def unwanted(tag: str, attrs: str) -> bool:
    """Whether an element is never text, or is not shown."""
    if tag in GONE:
        return True
    if tag in ("html", "body", "main") or not attrs.strip():
        return False
    for key, value in attributes(attrs):
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
    return False


def attributes(attrs: str) -> Iterator[tuple[str, str]]:
    for m in _ATTR.finditer(attrs):
        yield m[1].lower(), html.unescape(m[2] or m[3] or m[4] or "")


def named(tag: str, attrs: str, up: Node) -> tuple[bool, bool]:
    """(named, hinted): whether an element is named as something else than article
    text, by its tag, role or a whole class or id; and whether a part of a class or id
    says so, as in ``site-menu``, but also in ``entry-header``."""
    if tag in ASIDE:
        return True, False
    if tag in ("html", "body", "main"):
        return False, False
    if tag == "header" and not up.in_text:
        return True, False
    hinted = False
    for key, value in attributes(attrs):
        if key == "role" and value.lower() in ROLES:
            return True, False
        if key in ("class", "id") and tag not in INLINE:
            if any(x.lower() in NAMES for x in value.split()):
                return True, False
            hinted = hinted or any(x.lower() in NAMES for x in _NAME.findall(value))
    return False, hinted


def within(node: Node | None, tags: tuple) -> bool:
    while node is not None:
        if node.tag in tags:
            return True
        node = node.up
    return False


def tags(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, slash, name, attributes) of each tag, and of each comment or
    declaration with an empty name, in one pass over the page.

    A quoted value may hold ``>``; where its quote, or the tag, never ends, the tag ends
    at the next ``>``.  ``<`` is text where no tag begins or none ends after it.
    """
    at, n, last = 0, len(page), page.rfind(">")
    while (m := _OPEN.search(page, at)) is not None:
        start, at = m.start(), m.end()
        if m[1] or m[2]:
            ends = ("-->", "--!>") if m[1] else ("]]>",)
            found = [(x, e) for e in ends if (x := page.find(e, at)) >= 0]
            at = min(x + len(e) for x, e in found) if found else n
            yield start, at, "", "", ""
        elif m[3]:
            at = page.find(">", at) + 1 or n
            yield start, at, "", "", ""
        elif at <= last:
            end = _tag_end(page, at, last)
            yield start, end + 1, m[4], m[5].lower(), page[at:end]
            at = end + 1


def _tag_end(page: str, at: int, last: int) -> int:
    """Place of the ``>`` that ends a tag whose name ends at ``at``; there is one."""
    i = at
    while i <= last:
        m = _STEP.search(page, i)
        if page[m.start()] == ">":
            return m.start()
        i = _SPACE.match(page, m.end()).end()
        if page[i:i + 1] in ('"', "'"):
            i = page.find(page[i], i + 1) + 1
            if not i:
                break
    return page.find(">", at)


def parse(page: str) -> Node:
    """A tolerant tree: unclosed paragraphs, items and cells end where the next
    begins; an end tag without its start is skipped."""
    root = cur = Node("#root", None, False)
    at, skip = 0, 0
    opened: dict[str, int] = {}

    def close(node: Node) -> Node:
        """Close from ``cur`` up to ``node``; the node around it is open then."""
        x = cur
        while x is not node.up:
            opened[x.tag] -= 1
            if x.tag in SIBLING:
                x.up.scope.items.pop()
            x = x.up
        return x
    for start, end, slash, tag, attrs in tags(page):
        if start < skip:
            continue                             # inside a script or the like
        if start > at:
            cur.kids.append(page[at:start])
        at = end
        if not tag:
            continue
        if slash:
            if opened.get(tag):
                node = cur
                while node.tag != tag:
                    node = node.up
                cur = close(node)
            continue
        if tag in ENDS_P and opened.get("p") and cur.block.tag == "p":
            cur = close(cur.block)
        if tag in SIBLING:
            node = next((x for x in cur.scope.items if x.tag in SIBLING[tag]), None)
            if node is not None:
                cur = close(node)
        node = Node(tag, cur, cur.gone or unwanted(tag, attrs))
        node.named, node.hinted = named(tag, attrs, cur)
        cur.kids.append(node)
        if tag in RAW:
            m = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = skip = len(page) if m is None else page.find(">", m.end()) + 1 or len(page)
        elif tag not in VOID and not attrs.rstrip().endswith("/"):
            cur = node
            opened[tag] = opened.get(tag, 0) + 1
            if tag in SIBLING:
                node.up.scope.items.append(node)
    if at < len(page):
        cur.kids.append(page[at:])
    return root


def measure(root: Node) -> Node:
    """Fill counts, densities and sums, children first; gives the body."""
    order, stack, body = [], [root], root
    while stack:
        node = stack.pop()
        if node.tag == "body" and body is root:
            body = node
        order.append(node)
        stack.extend(k for k in node.kids if isinstance(k, Node) and not k.gone)
    for node in reversed(order):
        for k in node.kids:
            if isinstance(k, str):
                node.c += len("".join(k.split()))
            elif not k.gone:
                node.c, node.t = node.c + k.c, node.t + k.t + 1
                node.lc, node.lt = node.lc + k.lc, node.lt + k.lt + (k.tag == "a")
        if node.tag == "a":
            node.lc, node.lt = node.c, node.lt
    share = body.lc / max(body.c, 1)
    for node in order:
        if node.c:
            t, lc, lt = max(node.t, 1), max(node.lc, 1), max(node.lt, 1)
            base = math.log(node.c / max(node.c - node.lc, 1) * node.lc + share * node.c + math.e)
            ratio = node.c / lc * t / lt
            node.density = node.c / t * (math.log(ratio) / math.log(base) if base > 1.0 + 1e-9 else math.log(ratio))
    for node in order:
        if node.up is not None:
            node.up.sum += node.density
    for node in order:
        if not any(isinstance(k, Node) for k in node.kids):
            node.sum = node.density
    return body


def take_out(root: Node) -> None:
    """Mark named elements as gone.  One stays if it holds most of the text outside
    links and also an article or main, or none with text lies outside it; articles
    stay whatever their names.  One that is only hinted at goes if it is mostly links, or a short
    text (as on a button) without a paragraph or heading."""
    nodes = [x for x in walk(root)]
    plain, links, prose, good, every = {}, {}, {}, {}, {}
    for x in reversed(nodes):
        kids = [k for k in x.kids if isinstance(k, Node) and not k.gone]
        own = sum(len("".join(k.split())) for k in x.kids if isinstance(k, str))
        plain[x] = own + sum(plain[k] for k in kids)
        links[x] = sum(links[k] for k in kids)
        prose[x] = any(k.tag in PROSE or prose[k] for k in kids)
        if x.tag == "a":
            plain[x], links[x] = 0, plain[x] + links[x]
        is_text = x.tag in ("article", "main") and plain[x] > 0
        good[x] = (is_text and not x.named) + sum(good[k] for k in kids)
        every[x] = is_text + sum(every[k] for k in kids)
    for x in nodes:
        if x.up is not None and x.up.gone:
            x.gone = True
        elif x.named and x.tag != "article":
            wraps = 2 * plain[x] > plain[root] and (good[x] > 0 or every[x] == every[root])
            x.gone = not wraps
        elif x.hinted and x.tag != "article":
            x.gone = links[x] > plain[x] or (plain[x] < SHORT and x.tag not in PROSE and not prose[x])


def walk(node: Node) -> Iterator[Node]:
    stack = [node]
    while stack:
        x = stack.pop()
        yield x
        stack.extend(k for k in reversed(x.kids) if isinstance(k, Node) and not k.gone)


def blocks(node: Node, least: float) -> list[str]:
    """Texts of the blocks under a node in page order, without blocks below it of two
    links or more that hold most of the block's text, if less dense than ``least``.  In
    an article or main nothing is left out: its lists of links are its own."""
    out: list[str] = []
    run: list[str] = []

    def end() -> None:
        text = " ".join(html.unescape("".join(run)).split())
        if text:
            out.append(text)
        run.clear()

    stack: list = [node]
    while stack:
        x = stack.pop()
        if x is None:
            end()
        elif isinstance(x, str):
            run.append(x)
        elif not x.gone:
            if x.tag in INLINE:
                stack.extend(reversed(x.kids))
                continue
            end()
            if x is not node and not x.in_text and x.lt > 1 and 2 * x.lc > x.c and x.density < least:
                continue
            stack.append(None)
            stack.extend(reversed(x.kids))
    end()
    return out


def regions(body: Node) -> tuple[list[Node], float]:
    """The nodes whose texts are the main text, and the least density of text."""
    nodes = list(walk(body))
    top = max(nodes, key=lambda x: x.sum)
    least, x = top.density, top
    while x is not body:
        x = x.up
        least = min(least, x.density)
    least = max(least, 0.0)
    dense = {x: x.tag not in INLINE and x.density >= least and x.c > 0 for x in nodes}
    below = {}
    for x in reversed(nodes):
        below[x] = dense[x] + sum(below[k] for k in x.kids if isinstance(k, Node) and not k.gone)
    ways, x = set(), top
    while x is not None:
        ways.add(x)
        x = x.up
    above, x = 0, body
    while x is not top:                      # nodes on the path do not count as outside
        above, path = above + dense[x], [k for k in x.kids if k in ways]
        if not path or below[path[0]] + above < below[body]:
            break
        x = path[0]
    region, up = x, x
    while up is not body:
        if up.tag in ("article", "main"):
            region = up
        up = up.up
    if region.tag in ("article", "main"):
        inner = [k for k in walk(region) if k.tag == "article" and k is not region and not within(k.up, ("article",))]
    else:
        inner = []
        for tag in ("article", "main"):
            inner = inner or [k for k in walk(region) if k.tag == tag and k.c and not within(k.up, (tag,))]
    inner = [k for k in inner if 2 * k.lc <= k.c]
    if 2 * sum(k.c - k.lc for k in inner) > region.c - region.lc:
        return inner, least
    return [region], least


def extract(page: str) -> str:
    """Main text of one page; blocks are joined by one space."""
    root = parse(page)
    take_out(root)
    found, least = regions(measure(root))
    return " ".join(t for x in found for t in blocks(x, least))


def main_text(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The ``keep`` columns, text and n_chars (code points) of every row of
    ``pages``.  A null or empty page has the empty text.  A page is worked on by
    itself, whatever its length; equal rows give equal results; other columns are
    not looked at."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 256):
                part = batch.slice(i, 256)
                texts = [extract(p.as_py() or "") for p in part.column("_html")]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in keep), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], [*keep, "text", "n_chars"])

    schema = ", ".join(f"`{k}` {pages.schema[k].dataType.simpleString()}" for k in keep)
    return pages.select(*keep, F.col(html_col).alias("_html")) \
        .mapInArrow(work, f"{schema}, text string, n_chars long")


def op10(spark, sf_dir: str) -> DataFrame:
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
