import html
import random
import re

import numpy as np
import pyarrow.parquet as pq
import pytest

from foliary.llm import boosting, extraction
from tests.llm.fixture import rows


@pytest.fixture(scope="module")
def model():
    return extraction.trained()


def text(page, model):
    return extraction.texts([page], model)[0]


def test_pages_not_seen(model):
    rng, exact = random.Random(99), 0
    for _ in range(150):
        page = extraction.made_page(rng)
        marked = [n for n in extraction.tree(page) if n.tag == "#" and extraction.MARK in "".join(n.pieces)]
        want = "\n".join(extraction.flow(n).replace(extraction.MARK, "").strip() for n in marked)
        exact += text(page.replace(extraction.MARK, ""), model) == want
    assert exact >= 135


def test_pages_of_the_table(model):
    table = pq.read_table("/root/testdata/sf0.01/pages.parquet").to_pylist()
    for r, got in zip(table, extraction.texts([r["html"] for r in table], model), strict=True):
        inner = re.search(r"(?s)<article>(.*)</article>", r["html"])[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert got == "\n".join(b for b in blocks if b)


def said(page):
    return "|".join(extraction.flow(n) for n in extraction.tree(page) if n.tag == "#")


def test_skipped_elements_end_where_they_end():
    assert said("<article><svg class=icon/><p>one</p><p>two</p></article><svg><text>x</text></svg>") == "one|two"
    assert said('<article><svg class="icon" /><p>one</p></article><svg><text>x</text></svg>') == "one"
    assert said("<article><div><button>ok</div><p>one</p></article><button>x</button>") == "ok|one"
    assert said("<article><p>one<button>ok<p>two</article><p>three<button>x</button>") == "oneok|two|three"
    assert said("<datalist><option>a<option>b</datalist><p>one</p><option>c</option>") == "ab|one"
    assert said("<div><button><div>x</div><p>y</button>one</div>") == "one"


def test_all_paragraphs_of_a_container_count():
    nodes = extraction.tree("<div>" + "<h2>x</h2>" * 250 + "<p>y</p>" * 30 + "</div>")
    assert extraction.features(nodes)[1][-1] == 30


LONG = "The committee met on Tuesday, and after a long debate, it agreed on the plan. " * 3


@pytest.mark.parametrize(
    "page,want",
    [
        ("", ""), ("<!-- x", ""), ("<script>if (a<b) x()</script>", ""), ("</p></div>", ""),
        (f"<body><nav><a href=/>Home</a></nav><article><h1>Head</h1><p>{LONG}</p>\n<p>A &amp; b&nbsp;&#8212;  c,\n d.</p></article><footer>&copy; us</footer></body>", f"Head\n{LONG.strip()}\nA & b — c, d."),
        (f"<main><p>{LONG}<p>{LONG}</main><div class='cookie-notice'><p>We use cookies.</p></div><section class=comments><div class=comment><p>I do not agree at all.</p></div></section>", f"{LONG.strip()}\n{LONG.strip()}"),
    ],
)
def test_small_pages(page, want, model):
    assert text(page, model) == want


def test_deep_and_long(model):
    assert isinstance(text("<div>" * 20000 + "x", model), str)
    assert text("<article>" + f"<p>{LONG}</p>" * 3000 + "</article>", model).count("\n") == 2999


def test_kept_nodes_have_kept_parents(model):
    rng = random.Random(5)
    for _ in range(20):
        nodes = extraction.tree(extraction.made_page(rng))
        odds = np.array([rng.uniform(-2, 2) for _ in nodes])
        leaves = extraction.decode(nodes, odds)
        place = {id(n): i for i, n in enumerate(nodes)}
        kept = set()
        for n in leaves:
            while n:
                kept.add(place[id(n)])
                n = n.parent
        # no single branch can be added or cut for a better sum
        assert sum(odds[i] for i in kept) >= -1e-9 or not kept


def test_rows(spark):
    pages = spark.createDataFrame([(1, "u", None, "x"), (2, None, f"<article><p>{LONG}</p></article>", "y"), (2, None, f"<article><p>{LONG}</p></article>", "y")], "page_id long, url string, html string, text string")
    got = rows(extraction.extracted(pages))
    assert [r["text"] for r in got] == ["", LONG.strip(), LONG.strip()] and set(got[0]) == {"page_id", "url", "text"}
    assert extraction.extracted(pages.limit(0)).count() == 0


def test_boosting():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 6))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    model = boosting.fit(x[:1500], y[:1500])
    assert ((model.log_odds(x[1500:]) > 0) == y[1500:]).mean() > 0.95


# Pages written by hand, each with the text of its article.
PAGES = {
"blog": ("""<!doctype html><html lang=en><head><meta charset=utf-8><title>On rivers</title><link rel=stylesheet href=a.css></head><body class="single">
<header class="site-header"><a class="logo" href="/">River Notes</a><nav class="primary-nav"><ul><li><a href="/">Home</a></li><li><a href="/about">About</a></li><li><a href="/archive">Archive</a></li></ul></nav></header>
<main id="main"><article class="post type-post"><h1 class="entry-title">Why rivers bend</h1>
<p>A river that leaves the hills rarely keeps to a straight line for long. Small differences in the bank slow the water on one side, and it drops its sand there.</p>
<p>On the other side the current bites into the soil. After a few <em>hundred</em> years the loop is so tight that the river cuts through its neck.</p>
<h2>What remains</h2><p>The old loop becomes a lake. Such lakes are shallow, warm and full of reeds&nbsp;&mdash; good places to look for birds.</p></article>
<section id="comments" class="comments-area"><h2>3 replies</h2><ol class="comment-list"><li class="comment"><b>Ann</b><p>Lovely piece, thanks for writing it!</p></li><li class="comment"><b>Bo</b><p>I grew up beside one of these lakes.</p></li></ol></section></main>
<aside class="sidebar"><h3>Recent posts</h3><ul><li><a href="/1">On clouds</a></li><li><a href="/2">On stones</a></li></ul></aside>
<footer class="site-footer"><p>&copy; 2020 River Notes. All rights reserved.</p></footer><script>track()</script></body></html>""",
"Why rivers bend\nA river that leaves the hills rarely keeps to a straight line for long. Small differences in the bank slow the water on one side, and it drops its sand there.\nOn the other side the current bites into the soil. After a few hundred years the loop is so tight that the river cuts through its neck.\nWhat remains\nThe old loop becomes a lake. Such lakes are shallow, warm and full of reeds — good places to look for birds."),
"manual": ("""<html><head><title>t</title><style>.x{}</style></head><body><div id="nav"><a href=1>Index</a> | <a href=2>Modules</a> | <a href=3>Search</a></div>
<div id="content"><h1>Reading files</h1><p>The reader takes a path and gives back rows. It stops at the first row that it cannot read unless told otherwise.</p>
<pre>rows = read("data.csv")
for row in rows: print(row)</pre>
<p>Options are given by name:</p><table><tr><th>name</th><th>meaning</th></tr><tr><td>sep</td><td>what stands between two cells</td></tr><tr><td>skip</td><td>rows to pass over at the start</td></tr></table>
<ul><li>Paths may hold stars.</li><li>Folders are read file by file, in the order of their names.</li></ul></div>
<div id="footer">Last changed on Monday. <a href=/legal>Legal notice</a></div></body></html>""",
"Reading files\nThe reader takes a path and gives back rows. It stops at the first row that it cannot read unless told otherwise.\nrows = read(\"data.csv\") for row in rows: print(row)\nOptions are given by name:\nname\nmeaning\nsep\nwhat stands between two cells\nskip\nrows to pass over at the start\nPaths may hold stars.\nFolders are read file by file, in the order of their names."),
"news": ("""<body><div class="cookie-banner"><p>We use cookies to improve your visit. By going on you agree to this.</p><button>Accept</button></div>
<div class="top-menu"><ul><li><a href=/w>World</a><li><a href=/s>Sport</a><li><a href=/m>Money</a></ul></div>
<div class="story-body"><h1>Bridge reopens after nine months</h1><div class="share-tools"><a href=#>Share</a> <a href=#>Print</a></div>
<p>The old bridge over the northern channel was opened to traffic again on Friday morning, two weeks later than planned.
<p>Engineers had replaced forty of the steel beams, some of which were more than a century old.
<div class="advert"><p>Half price on all shoes until Sunday.</p></div>
<p>“It will stand for another hundred years”, the head of works said.
<blockquote><p>We never closed the footpath for more than a day.</p></blockquote></div>
<div class="related-stories"><h3>More on this</h3><ul><li><a href=/x>Tunnel delayed again</a></li><li><a href=/y>Ferry prices rise</a></li></ul></div>
<form class="newsletter"><p>Get our news by mail every morning.</p><input name=m><button>Sign up</button></form><footer><p>Contact the desk</p></footer></body>""",
"Bridge reopens after nine months\nThe old bridge over the northern channel was opened to traffic again on Friday morning, two weeks later than planned.\nEngineers had replaced forty of the steel beams, some of which were more than a century old.\n“It will stand for another hundred years”, the head of works said.\nWe never closed the footpath for more than a day."),
"icons": ("""<body><nav><a href=/><svg class=icon viewBox="0 0 1 1"/> Home</a><button>menu</button></nav><article><h1>Icons</h1><p>A picture in the menu closes itself, and the text goes on as before, sentence after sentence.</p><p>Another one <svg><path d="M0 0"></path><text>not text</text></svg> stands inside a line of this text.</p></article><footer>end of page</footer></body>""",
"Icons\nA picture in the menu closes itself, and the text goes on as before, sentence after sentence.\nAnother one stands inside a line of this text."),
"recipe": ("""<body><div class="wrapper"><div class="header"><a href=/>Kitchen</a></div><div class="menu"><a href=/a>Soups</a> <a href=/b>Cakes</a> <a href=/c>Salads</a></div>
<div class="entry-content"><h2>Leek soup</h2><p>Serves four. It takes half an hour, most of which is waiting.</p><h3>You need</h3><ul><li>three leeks, washed well</li><li>two potatoes</li><li>a litre of stock</li></ul><h3>How to</h3><ol><li>Cut the leeks into rings and fry them slowly in butter.</li><li>Add the potatoes and the stock and cook until soft.</li></ol></div>
<div class="widget sidebar"><h4>About me</h4><p>I cook for a family of five and write down what works.</p></div><div class="footer"><p>All recipes are our own. Write to us!</p></div></div></body>""",
"Leek soup\nServes four. It takes half an hour, most of which is waiting.\nYou need\nthree leeks, washed well\ntwo potatoes\na litre of stock\nHow to\nCut the leeks into rings and fry them slowly in butter.\nAdd the potatoes and the stock and cook until soft."),
}


@pytest.mark.parametrize("name", PAGES)
def test_pages_by_hand(model, name):
    page, want = PAGES[name]
    assert text(page, model) == want


@pytest.mark.parametrize("broken", ["<div>{k}</p></section>", "<div><option>x{k}", "<p><div>{k}<center><h1>", "<svg>{k}", "<button>x{k}<li>y", "<dl><dt>{k}<dd><td>"])
def test_broken_markup_takes_time_in_proportion(broken):
    import time

    def taken(n):
        before, after = broken.split("{k}")
        began = time.process_time()
        extraction.tree(before * n + after * n)
        return time.process_time() - began

    taken(500)
    small, large = min(taken(2000) for _ in range(3)), min(taken(16000) for _ in range(2))
    assert large < 30 * max(small, 0.01)  # eight times as long; the square would be 64
