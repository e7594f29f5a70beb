"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree.

A page becomes a tree of its block elements; runs of text between their borders
are leaves. Every node is described by its tag, words of its attributes, depth,
density of text, links and tags in its subtree, and its siblings; boosted trees
give the log odds that it holds main text. The decoder picks the set of nodes
with the largest sum of log odds in which a node is kept only if its parent is,
so that no choice contradicts one above or below it, and the text of the kept
leaves is the result: white space inside a block is one blank, blocks are joined
by line feeds in page order. Scripts, styles and comments are never text.

There are no labelled pages, so the trees are trained on pages that are made
here: articles among menus, sidebars, notices, adverts, forms, comments and
footers in many layouts, with and without telling tags and attributes.

Null pages count as empty and have no text. Each row is handled alone, whole,
and without recursion, in time that is in proportion to the page, so neither
ties nor repeated rows, long pages, deep nesting nor broken markup need other
care. An empty table gives no rows. The column of pages and one called text are
replaced by the text; all others pass through.
"""

from __future__ import annotations

import functools
import html
import math
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .boosting import Trees, fit
from .shared import slices, table

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
ATTRIBUTE = re.compile(r"(?:class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
RAW = set("script style noscript template textarea select svg iframe title button option".split())
BLOCKS = set("html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption nav header footer aside form fieldset address details summary hr center".split())
#: What ends an open p, li and so on, and where looking for one stops.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPE = set("html body article main section div ul ol dl table blockquote nav header footer aside form td th figure details".split())
INLINE_IN = set("li dt dd td th tr".split())
LISTS = set("ul ol dl table".split())

GROUPS = [["article"], ["main"], ["section"], ["div", "center"], ["p"], ["h1"], ["h2", "h3", "h4", "h5", "h6"], ["li", "dt", "dd"], ["ul", "ol", "dl"], ["td", "th", "tr"], ["table", "tbody", "thead"], ["blockquote", "pre", "figure", "figcaption"], ["nav"], ["header"], ["footer"], ["aside"], ["form", "fieldset"], ["body", "html"], ["#"]]
GROUP = {tag: k for k, tags in enumerate(GROUPS) for tag in tags}
HINTS = [
    set("ad ads advert adverts advertisement sponsor sponsored promo promotion banner".split()),
    set("comment comments reply replies discussion disqus respond".split()),
    set("cookie cookies consent notice notices alert gdpr popup modal overlay warning message".split()),
    set("nav navigation menu navbar breadcrumb breadcrumbs pagination pager toc tabs links".split()),
    set("sidebar aside side widget widgets rail related recommended more".split()),
    set("footer header masthead bottom topbar copyright legal".split()),
    set("share social newsletter subscribe signup login search form tags meta byline author".split()),
    set("article content post entry main story text body page prose".split()),
]
BOILER = set("nav header footer aside form".split())


class Node:
    __slots__ = ("tag", "parent", "kids", "words", "depth", "pieces", "chars", "links", "tags", "stops", "controls", "heads", "start", "index", "near_p", "near_item")

    def __init__(self, tag: str, parent: Node | None, words: frozenset = frozenset()):
        self.tag, self.parent, self.words = tag, parent, words
        self.depth = parent.depth + 1 if parent else 0
        self.kids: list[Node] = []
        self.pieces: list[str] = []
        self.chars = self.links = self.tags = self.stops = self.controls = self.heads = self.start = self.index = 0
        # the open p, and the open items, rows and cells by tag, that a new element can end
        self.near_p = self if tag == "p" else None if tag in SCOPE or not parent else parent.near_p
        above = parent.near_item if parent else {}
        self.near_item = {} if tag in LISTS else {**above, tag: self} if tag in INLINE_IN else above
        if parent:
            self.index = len(parent.kids)
            parent.kids.append(self)


def closed(source: str, end: int, tag: str, opened: Counter) -> re.Match | None:
    """The closing tag of a button or option, unless the next one of its name or its container's end comes first."""
    inside: Counter = Counter()
    for m in TOKEN.finditer(source, end):
        name = (m[2] or "").lower()
        if name == tag:
            return m if m[1] else None
        if name not in BLOCKS:
            continue
        if not m[1]:
            inside[name] += 1
        elif inside[name]:
            inside[name] -= 1
        elif opened[name]:
            return None
    return None


def tree(source: str) -> list[Node]:
    """All block nodes and text leaves in page order; the first is the root. Time is in proportion to the page."""
    root = at = Node("html", None)
    nodes, leaf, link, end = [root], None, 0, 0
    opened: Counter = Counter()  # blocks that are open, by tag
    endless: set[str] = set()  # elements that no closing tag follows any more

    def text(raw: str) -> None:
        nonlocal leaf
        if not raw or (leaf is None and raw.isspace()):
            return
        if leaf is None:
            leaf = Node("#", at)
            nodes.append(leaf)
        leaf.pieces.append(raw)
        if link:
            leaf.links += len(raw)

    def leave(node: Node) -> None:
        """Ends this element and all inside it."""
        nonlocal at, link
        while at is not node:
            opened[at.tag] -= 1
            at = at.parent
        opened[node.tag] -= 1
        at, link = node.parent, 0

    def raw_end(tag: str) -> re.Match | None:
        if tag in ("button", "option"):
            return closed(source, end, tag, opened)
        found = None if tag in endless else re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(source, end)
        if found is None:
            endless.add(tag)
        return found

    for m in TOKEN.finditer(source):
        if m.start() < end:
            continue
        text(source[end : m.start()])
        end = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag in RAW and not m[1]:
            if tag in ("textarea", "select", "button"):
                at.controls += 1
            if tag == "svg" and m[3].endswith("/"):
                continue
            close = raw_end(tag)
            if close:
                end = close.end()
            elif tag in ("script", "style", "textarea", "title"):
                end = len(source)
            continue
        if tag not in BLOCKS:
            if tag == "a":
                link = 0 if m[1] else 1
            elif tag == "br":
                text(" ") if leaf is not None else None
            elif tag == "input":
                at.controls += 1
            if not m[1]:
                (leaf or at).tags += 1
            continue
        leaf = None
        if m[1]:
            if opened[tag]:
                node = at
                while node.tag != tag:
                    node = node.parent
                leave(node)
            continue
        if tag in ("html", "hr"):
            continue
        if tag in INLINE_IN:
            ended = max((at.near_item[t] for t in CLOSES[tag] if t in at.near_item), key=lambda n: n.depth, default=None)
        else:
            ended = at.near_p
        if ended is not None:
            leave(ended)
        words = frozenset(w.lower() for v in ATTRIBUTE.finditer(m[3]) for w in WORDS.findall(v[1] or v[2] or v[3] or "")) if m[3].strip() else frozenset()
        at = Node(tag, at, words)
        opened[tag] += 1
        nodes.append(at)
    text(source[end:])
    return nodes


def flow(node: Node) -> str:
    return " ".join(html.unescape("".join(node.pieces)).split())


def features(nodes: list[Node]) -> np.ndarray:
    """A row for each node. Sums over subtrees are taken from the last node to the first."""
    total = 0
    for n in nodes:
        n.start = total
        if n.tag == "#":
            raw = "".join(n.pieces)
            n.chars = len(raw)
            n.stops = sum(map(raw.count, ".,;?!"))
            total += n.chars
        n.heads = int(n.tag in ("h1", "h2", "h3"))
    for n in reversed(nodes[1:]):
        p = n.parent
        p.chars += n.chars
        p.links += n.links
        p.tags += n.tags + 1
        p.stops += n.stops
        p.controls += n.controls
        p.heads += n.heads
    out = np.zeros((len(nodes), len(GROUPS) + 2 * len(HINTS) + 18), np.float32)
    above = {}
    for i, n in enumerate(nodes):
        row = out[i]
        row[GROUP.get(n.tag, 3)] = 1
        k = len(GROUPS)
        inherited = list(above[id(n.parent)]) if n.parent else [0] * (len(HINTS) + 3)
        for j, hint in enumerate(HINTS):
            if n.words and n.words & hint:
                row[k + j] = 1
                inherited[j] = 1
            row[k + len(HINTS) + j] = inherited[j]
        if n.tag in BOILER:
            inherited[-3] = 1
        if n.tag in ("article", "main"):
            inherited[-2] = 1
        if n.tag == "li":
            inherited[-1] = 1
        above[id(n)] = inherited
        k += 2 * len(HINTS)
        chars = n.chars or 1
        sisters = n.parent.kids if n.parent else [n]
        row[k:] = (
            *inherited[-3:], n.depth, math.log1p(n.chars), n.links / chars, 100 * n.tags / chars, 100 * n.stops / chars, n.chars / (total or 1), n.start / (total or 1),
            n.index / len(sisters), len(sisters), math.log1p(n.parent.chars / len(sisters)) if n.parent else 0, n.chars / (n.parent.chars or 1) if n.parent else 1,
            len(n.kids), n.controls, n.heads, sum(s.tag == "p" for s in n.kids),
        )
    return out


def decode(nodes: list[Node], odds: np.ndarray) -> list[Node]:
    """The leaves of the best set of nodes that holds each node's parent along with it."""
    place = {id(n): i for i, n in enumerate(nodes)}
    best = np.array(odds, float)
    for i in range(len(nodes) - 1, 0, -1):
        if best[i] > 0:
            best[place[id(nodes[i].parent)]] += best[i]
    kept, out = [True] * len(nodes), []
    for i, n in enumerate(nodes):
        kept[i] = best[i] > 0 and (i == 0 or kept[place[id(n.parent)]])
        if kept[i] and n.tag == "#":
            out.append(n)
    return out


# -- pages to learn from ----------------------------------------------------------

MARK = ""


def made_page(rng: random.Random) -> str:
    """A page in a random layout; each run of main text begins with ``MARK``."""
    syllables = "an be co de en fi ga ho in ka lo me no or pa qu re se ti un va we zo".split()
    word = lambda: "".join(rng.choices(syllables, k=rng.choice((1, 1, 2, 2, 3, 4))))
    noisy = rng.random() < 0.1
    said = lambda a, b: " ".join(w.capitalize() if i == 0 else w + rng.choice(["", "", "", "", ","]) + (rng.choice(["***", "###", "&amp;&amp;&amp;"]) if noisy else "") for i, w in enumerate(word() for _ in range(rng.randint(a, b)))) + "."
    told = rng.random() < 0.75  # whether attributes tell anything
    attr = lambda *names: (f' class="{rng.choice(names)}{rng.choice(["", "-" + word(), " " + word()])}"' if told else rng.choice(["", f' class="{word()}"']))
    links = lambda a, b: "<ul>" + "".join(f'<li><a href="/{word()}">{" ".join(word() for _ in range(rng.randint(1, 4)))}</a></li>' for _ in range(rng.randint(a, b))) + "</ul>"
    tag = lambda good: good if rng.random() < 0.6 else "div"

    def wrap(name, attrs, inside):
        return f"<{name}{attrs}>{inside}</{name}>"

    def para(a=5, b=120):
        t = MARK + " ".join(said(3, 25) for _ in range(rng.choice((1, 1, 2, 3, 6)))) if rng.random() > 0.08 else MARK + said(1, 4)
        k = rng.random()
        if k < 0.15:
            t = t.replace(" ", " <a href='/x'>" + word() + "</a> ", 1)
        elif k < 0.3:
            t = t.replace(" ", " <b>" + word() + "</b> ", 1)
        elif k < 0.4:
            t = f"<b>{t}<br>"
        return t

    def main_part():
        out = [wrap("h1", "", MARK + said(2, 12))] if rng.random() < 0.9 else []
        for _ in range(rng.choice((0, 1, 1, 2, 3, 5, 8, 14))):
            k = rng.random()
            if k < 0.72:
                out.append("<p>" + para() + rng.choice(["</p>", "</p>", ""]))
            elif k < 0.79:
                out.append(wrap(rng.choice(["h2", "h3"]), "", MARK + said(1, 7)))
            elif k < 0.86:
                out.append(wrap(rng.choice(["ul", "ol"]), "", "".join(wrap("li", "", MARK + said(2, 14)) for _ in range(rng.randint(1, 6)))))
            elif k < 0.9:
                out.append(wrap("blockquote", "", wrap("p", "", para())))
            elif k < 0.94:
                out.append(wrap("table", "", "".join(wrap("tr", "", "".join(wrap("td", "", MARK + word()) for _ in range(3))) for _ in range(rng.randint(1, 4)))))
            elif k < 0.96:
                out.append(wrap("pre", "", MARK + said(2, 9)))
            elif k < 0.98:
                out.append(wrap("figure", "", "<img src=a.png>" + wrap("figcaption", "", MARK + said(2, 9))))
            else:
                out.append(wrap("div", attr("ad", "advert", "sponsored", "promo"), said(3, 18)))
        return "".join(out)

    form = lambda: wrap("form", attr("search", "newsletter", "login", "signup"), (said(1, 12) if rng.random() < 0.6 else "") + f"<label>{word()}</label><input name=q>" + wrap("button", "", word()))
    notice = lambda: wrap("div", attr("cookie", "consent", "notice", "alert", "gdpr-popup"), wrap(rng.choice(["p", "div", "span"]), "", said(4, 30)) + rng.choice(["", "<button>ok</button>", "<a href=#>" + word() + "</a>"]))
    advert = lambda: wrap(rng.choice(["div", "aside", "section"]), attr("ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner"), rng.choice([said(2, 25), wrap("p", "", said(2, 25)), f"<a href=/x>{said(1, 8)}</a>"]))
    side = lambda: wrap(tag("aside"), attr("sidebar", "side", "widget", "related", "recommended"), rng.choice(["", wrap("h3", "", said(1, 3))]) + rng.choice([links(2, 9), wrap("p", "", said(3, 30)), wrap("p", "", said(3, 20)) + links(1, 6)]))
    comments = lambda: wrap(tag("section"), attr("comments", "comment-list", "discussion", "replies"), rng.choice(["", wrap("h2", "", said(1, 3))]) + "".join(wrap(rng.choice(["div", "li", "article"]), attr("comment", "reply"), rng.choice([f"<b>{word()}</b>", wrap("span", "", word()), ""]) + wrap("p", "", said(3, 40))) for _ in range(rng.randint(1, 6))) + (form() if rng.random() < 0.3 else ""))
    head = lambda: wrap(tag("header"), attr("header", "masthead", "topbar"), rng.choice([said(1, 4), f"<a href=/>{word()}</a>", wrap("p", "", said(1, 12))]) + (menu() if rng.random() < 0.5 else ""))
    menu = lambda: wrap(tag("nav"), attr("nav", "menu", "navbar", "navigation", "breadcrumb"), links(2, 9))
    foot = lambda: wrap(tag("footer") if told else "footer", attr("footer", "bottom", "copyright", "legal"), rng.choice(["&copy; " + said(1, 14), wrap("p", "", "&copy; " + said(2, 25)), links(2, 6) + said(2, 12)]))
    share = lambda: wrap("div", attr("share", "social", "tags", "byline"), said(1, 5))
    kind = rng.random()
    body = main_part()
    if rng.random() < 0.1:
        body += share()
    if kind < 0.6:
        body = wrap("article", attr("post", "article", "entry") if rng.random() < 0.5 else "", body)
        if rng.random() < 0.3:
            body = wrap("main", "", body)
    elif kind < 0.75:
        body = wrap("main", attr("content", "main") if rng.random() < 0.5 else "", body)
    else:
        body = wrap("div", f' {rng.choice(["class", "id"])}="{rng.choice(["content", "main", "post", "article-body", "entry-content", "story"])}"', body)
    before = [f() for f in (head, menu, notice, advert, side, form) if rng.random() < (0.7 if f is menu else 0.35)]
    after = [f() for f in (advert, side, comments, form, notice, foot) if rng.random() < (0.75 if f is foot else 0.35)]
    rng.shuffle(before)
    whole = "".join(before) + body + "".join(after)
    if rng.random() < 0.3:
        whole = wrap("div", attr("wrapper", "container", "page"), whole)
    return f"<!DOCTYPE html><html><head><title>{said(1, 5)}</title><style>p{{}}</style><script>var t='</p>';</script></head><body>{whole}<!-- {word()} --></body></html>"


@functools.lru_cache(maxsize=2)
def trained(pages: int = 700, seed: int = 1) -> Trees:
    rng = random.Random(seed)
    xs, ys = [], []
    for _ in range(pages):
        nodes = tree(made_page(rng))
        good = {id(n): False for n in nodes}
        for n in reversed(nodes):
            if n.tag == "#" and any(MARK in p for p in n.pieces):
                n.pieces = [p.replace(MARK, "") for p in n.pieces]
                good[id(n)] = True
            if good[id(n)] and n.parent:
                good[id(n.parent)] = True
        xs.append(features(nodes))
        ys.append(np.array([good[id(n)] for n in nodes], float))
    return fit(np.concatenate(xs), np.concatenate(ys))


def texts(pages: list[str], model: Trees) -> list[str]:
    parsed = [tree(p) for p in pages]
    rows = [features(nodes) for nodes in parsed]
    odds = model.log_odds(np.concatenate(rows)) if rows else np.zeros(0)
    out, start = [], 0
    for nodes in parsed:
        own = odds[start : start + len(nodes)]
        start += len(nodes)
        out.append("\n".join(t for n in decode(nodes, own) if (t := flow(n))))
    return out


def extracted(pages: DataFrame, model: Trees | None = None, column: str = "html") -> DataFrame:
    """``pages`` with text in place of ``column``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StringType, StructField, StructType

    model = model or trained()
    kept = [f for f in pages.schema.fields if f.name not in (column, "text")]
    schema = StructType([*kept, StructField("text", StringType())])
    names = to_arrow_schema(StructType(kept)).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column, 1 << 20):
            found = texts([p or "" for p in batch.column(column).to_pylist()], model)
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(found, pa.string())], [*names, "text"])

    return pages.select(*[f.name for f in kept], column).mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = extracted(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
