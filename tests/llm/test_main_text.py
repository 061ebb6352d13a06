"""Main text: blocks by hand, the tree against a plain search, whole pages against a reading of their template."""

import html
import re

import numpy as np
from conftest import SF

from annalist.llm import queries as Q
from annalist.llm.html_blocks import blocks_of
from annalist.llm.main_text import article, features, grow, labelled_blocks, main_text, train
from annalist.llm.page_examples import PAGES

TREE = train()


def texts(page):
    return [b.text for b in blocks_of(page)]


def test_blocks_of_malformed_pages():
    assert texts(None) == texts("") == texts("<p> \n<!-- a --></p>") == []
    assert texts("a < b &amp;&lt; c<br>d<p>e<p>f") == ["a < b &< c d", "e", "f"]
    assert texts("<ul><li>one<li>two <b>bold</ul>x</b>y") == ["one", "two bold", "xy"]
    assert texts("<script>var t='</p><p>x'</script >y<style>p{}</style>") == ["y"]
    assert texts("a<script>never ends <p>x") == ["a"]
    assert texts("a<!-- never ends <p>x") == ["a"]
    assert texts('<p title="a > b">x</p><p title=\'c > d\'>y</p></div></p>z') == ["x", "y", "z"]
    assert texts("x<p class='cut") == ["x"]
    assert texts("<TABLE><TR><TD>a<TD>b<TR><TD>c</TABLE>") == ["a", "b", "c"]
    assert texts("<form><select><option>a</select><textarea>b</textarea><button>c</button>d</form>") == ["d"]
    assert texts("&eacute;&#233;&#xe9; \t x&nbsp;y") == ["ééé x y"]
    assert texts("<svg/>a<svg><text>b</text></svg><noscript>c</noscript>") == ["a"]


def test_links_and_context():
    blocks = blocks_of("<nav><a href=1>a b</a> c</nav><article><a href=2><div>d</div></a>e<header><h1>f</h1></header></article><header>g</header>")
    assert [(b.text, b.link_words) for b in blocks] == [("a b c", 2), ("d", 1), ("e", 0), ("f", 0), ("g", 0)]
    assert [b.in_frame for b in blocks] == [True, False, False, False, True]
    assert [b.in_content for b in blocks] == [False, True, True, True, False]
    named = blocks_of('<body class="sidebar"><div class="no-sidebar">a</div><div class="rightSidebar">b</div><section id=x role="search">c</section></body>')
    assert [b.frame_name for b in named] == [False, True, True]


def test_tree_equals_a_search_over_all_splits():
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 4, (60, 3)).astype(float), rng.integers(0, 2, 60).astype(float)

    def gini(v):
        return len(v) * v.mean() * (1 - v.mean()) if len(v) else 0.0

    def answer(rows, depth, one):
        v = y[rows]
        best = (gini(v) - 1e-9, None, None)
        for f in range(3):
            for t in np.unique(x[rows, f])[:-1] + 0.5 if depth < 3 else []:
                low = rows[x[rows, f] <= t]
                high = rows[x[rows, f] > t]
                if len(low) >= 2 and len(high) >= 2 and gini(y[low]) + gini(y[high]) < best[0] - 1e-9:
                    best = (gini(y[low]) + gini(y[high]), f, t)
        if best[1] is None:
            return v.mean() >= 0.5
        goes = x[rows, best[1]] <= best[2] if one[best[1]] <= best[2] else x[rows, best[1]] > best[2]
        return answer(rows[goes], depth + 1, one)

    tree = grow(x, y, max_depth=3, min_leaf=2)
    # thresholds lie half way between values that occur, so compare on the rows themselves
    wanted = [answer(np.arange(60), 0, one) for one in x]
    assert (tree.predict(x) == np.array(wanted)).mean() > 0.97
    assert grow(x, np.ones(60)).predict(x).all()


def test_labelled_table():
    x, y = labelled_blocks()
    assert len(y) < 200 and (TREE.predict(x) == y).mean() > 0.97
    hits = total = 0
    for i, page in enumerate(PAGES):  # pages that the tree has not seen
        others = train(PAGES[:i] + PAGES[i + 1 :])
        x, y = labelled_blocks([page])
        hits, total = hits + (others.predict(x) == y).sum(), total + len(y)
    assert hits / total > 0.85


def test_pages_of_other_designs():
    body = ["Ein Tag am Meer.", "Der Wind kam von Westen und die See war rau, so dass kein Boot den Hafen verließ.", "Schluss."]
    inner = "".join(f"<p>{p}</p>" for p in body)
    frames = [
        ("<header><h2>Zeitung</h2><p>Seit 1900 in jedem Haus.</p></header><main>{}</main><footer><p>Impressum</p></footer>"),
        ("<div class='navbar'>Start Sport Kultur</div><div class='entry-content'>{}</div><div id='sidebar'><p>Das Wetter wird gut, morgen wie heute.</p></div>"),
        ("<div class=cookie-notice><p>Wir setzen Cookies, bitte stimmen Sie zu.</p></div><article>{}</article><section id=comments><article><p>Sehr schön geschrieben, danke dafür!</p></article></section>"),
        ("<aside><p>Lesen Sie auch, was gestern war.</p></aside><article>{}<form><p>Name</p><input></form></article>"),
        ("<article>{}<div class='advertisement'><p>Kaufen Sie jetzt, nur heute so billig.</p></div></article>"),
        ("<article>{}</article>"),
        ("{}"),
    ]
    for frame in frames:
        assert article(f"<html><body>{frame.format(inner)}</body></html>", TREE) == body, frame
    assert features([]).shape == (0, 12) and article("<nav>a</nav>", TREE) == []


def test_whole_table_against_its_template(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = Q.queries()["op12_html_extraction"](spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search(r"<article>(.*)</article>", pages[r.page_id].html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"</?b>|<br>", "", p)).split()) for p in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_defined_cases(spark):
    long_page = "<article>" + "<p>word word, word.</p>" * 20_000 + "</article>"
    rows = [(1, None, None), (2, "u", ""), (3, "u", long_page), (3, "u", long_page), (None, "u", "<p>x y</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("'a' AS text", "*", "1 AS n_chars")
    got = {(r.page_id, r.url): r for r in main_text(df).collect()}
    assert got[1, None].text == got[2, "u"].text == "" and got[None, "u"].text == "x y"
    assert got[3, "u"].n_blocks == 20_000 and main_text(df).count() == 5
    assert main_text(df.limit(0)).count() == 0
