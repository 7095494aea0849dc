"""URL decisions against SQL and by hand; HTML text against the markup."""

from __future__ import annotations

import html
import itertools
import random
import re

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from llm_fixtures import shipped  # noqa: F401
from oracle_compare import compare
from shelfwise.llm import htmltext, urlfilter

PAGES = "page_id long, url string, html string"


@pytest.fixture
def linked(spark):
    rows = [
        (1, "http://a.net/x", '<html><link rel="canonical" href="https://B.com/de/?a=1&amp;b=2#z">'),
        (2, "https://b.com/de/?a=1&b=2", "x"),
        (3, "http://c.example.com/q", "<meta http-equiv='refresh' content='0; url=/de/t'>"),
        (4, "http://c.example.com/de/t", None),
        (5, "http://d.org/fr/a", "<link href='http://e.fr/u' rel=canonical>"),
        (6, "http://e.fr/u", ""),
        (7, "http://f.net/a", "<LINK REL=CANONICAL HREF=//e.fr/u>"),
        (8, None, "<link rel=canonical href=http://a.net/x>"),
        (9, "nourl", None),
        (10, "http://z.com/k", "<!-- <link rel=canonical href=http://a.net/x> -->"),
        (11, "http://k.com/a/b.html", '<link rel="canonical" href="c.html">'),
        (12, "http://k.com/a/c.html", '<link rel="canonical" href="http://p.net/">'),
        (12, "http://k.com/a/c.html", '<link rel="canonical" href="http://p.net/">'),
        (13, "http://EN.Example.NET/en/x", None),
        (14, "http://net", None),
        (15, "http://notexample.com/de/", None),
    ]
    return rows, spark.createDataFrame([(*r, "x") for r in rows], PAGES + ", host string")


def test_url_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF_SMALL}/pages.parquet')")
    ok, msg = compare(E.queries()["op2_url_redirects"](spark, SF_SMALL), con, E.oracle_sql()["op2_url_redirects"])
    assert ok, msg


def test_decisions_follow_aliases(linked):
    rows, frame = linked
    got = {r.page_id: (r.host, r.rule, r.verdict) for r in urlfilter.judge(frame).collect()}
    assert got[2] == ("b.com", None, "block")  # named by a blocked page
    assert got[3] == ("c.example.com", None, "block")  # sends on to a blocked url
    assert got[6] == ("e.fr", None, "allow")  # allowed and blocked aliases: allow comes first
    assert got[7] == ("f.net", "net/", "block")  # its own rule stands
    assert got[10][2] == "allow"  # a link in a comment is none
    assert got[11][2] == got[12][2] == "block"  # through two hops, to a url that is no page
    assert got[13] == ("en.example.net", "example.net/en/", "allow") and got[14] == ("net", None, "allow")
    assert got[8] == got[9] == ("", None, "allow") and got[15][1] is None
    con = duckdb.connect()
    con.register("pages", pd.DataFrame(rows, columns=["page_id", "url", "html"]))
    ok, msg = compare(urlfilter.judge(frame), con, urlfilter.oracle_sql())
    assert ok, msg
    assert urlfilter.judge(frame.limit(0)).count() == 0


def test_redirect_table_and_hub(spark):
    pages = spark.createDataFrame([(i, f"http://h{i}.com/", None) for i in range(50)], PAGES)
    redirects = spark.createDataFrame([(f"http://h{i}.com/", "http://bad.net/") for i in range(49)] + [(None, "x")],
                                      "source_url string, target_url string")
    got = {r.page_id: r.verdict for r in urlfilter.judge(pages, redirects=redirects).collect()}
    assert all(got[i] == "block" for i in range(49)) and got[49] == "allow"


def expected_text(page: str) -> str:
    article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    article = re.sub(r"</?b>", "", article).replace("<br>", " ")
    blocks = [" ".join(html.unescape(x).split()) for x in re.split(r"</?(?:h1|p)>", article)]
    return "\n".join(b for b in blocks if b)


def test_html_query_gives_the_articles(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    out = E.queries()["op6_wrapper_text"](spark, SF_SMALL)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    rows = out.collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == expected_text(pages[r.page_id].html) and r.n_chars == len(r.text)
        assert r.url == pages[r.page_id].url


def test_template_is_learnt_from_the_host(spark):
    """No semantic mark anywhere: what stays the same over the host's pages is template."""
    page = ("<html><body><div class=x1><p>Welcome to our site</div><div class=x2><p>Story {0} begins<p>and {0} goes on"
            "</div><div class=x3><p>All rights reserved</div></body></html>")
    rows = [(i, f"http://one.com/{i}", page.format(f"n{i}")) for i in range(12)]
    rows += [(100 + i, f"http://two.com/{i}", page.format("same")) for i in range(12)]  # copies: one page
    got = {r.page_id: r.text for r in htmltext.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert all(got[i] == f"Story n{i} begins\nand n{i} goes on" for i in range(12))
    assert got[100] == "Welcome to our site\nStory same begins\nand same goes on\nAll rights reserved"


def test_furniture_and_broken_markup(spark):
    page = ("<html><head><title>t</title></head><body><header><div id=logo>Site</div></header>"
            "<div class='cookie-notice'>We use cookies</div><main><div class=post><h1>T &amp; U</h1>"
            "<p>One <a href=x>link</a> two<p>three&nbsp;four 3 < 5<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>"
            "<form><input><label>mail</label></form></div><div class=comments><p>nice</p></div></main>"
            "<script>if(a<b){}</script><div style='display: none'>gone</div><footer>f</footer>")
    rows = [(1, "http://x.com/", page), (2, None, None), (3, "http://x.com/e", ""), (4, "odd", "plain <b>te"),
            (5, "http://x.com/l", "<article>" + "<p>word &amp; word</p>" * 30_000 + "</article>"),
            (5, "http://x.com/n", "<div>" * 3_000 + "deep")]
    frame = spark.createDataFrame([(*r, "h") for r in rows], PAGES + ", host string")
    got = {r.url: r.text for r in htmltext.extract(frame).collect()}
    assert got["http://x.com/"] == "T & U\nOne link two\nthree four 3 < 5\na\nb\nc\nd"
    assert got[None] == "" and got["http://x.com/e"] == "" and got["odd"] == "plain te"
    assert got["http://x.com/l"] == "\n".join(["word & word"] * 30_000) and got["http://x.com/n"] == "deep"
    assert htmltext.extract(frame.limit(0)).count() == 0


def brute_matching(a, b):
    """Simple tree matching by the published recursion."""
    if a[0] != b[0]:
        return 0
    n, m = len(a[1]), len(b[1])
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            best[i][j] = max(best[i][j - 1], best[i - 1][j], best[i - 1][j - 1] + brute_matching(a[1][i - 1], b[1][j - 1]))
    return best[n][m] + 1


def test_simple_tree_matching():
    a = ["x", [["p", [["#", []]]], ["div", [["a", []], ["b", []]]], ["q", []]]]
    b = ["x", [["div", [["b", []]]], ["p", [["#", []]]], ["q", []], ["r", []]]]
    assert htmltext._matching(a, b, {}) == brute_matching(a, b) == 4
    pairs = htmltext._align(a[1], b[1], {})
    assert pairs[0] == 3 and len(pairs[1]) == 2


def test_very_long_and_unclosed_tags_leave_the_links(spark):
    meta = "<meta http-equiv=x data=" + "x" * 300_000 + ">"
    link = '<link rel="canonical" href="http://b.com/de/1">'
    refresh = "<meta http-equiv='refresh' content=\"0; url='http://example.com/de/2'\">"
    pages = spark.createDataFrame(
        [(1, "http://c.com/", meta + refresh), (2, "http://d.com/", "<link rel=canonical " + "y " * 200_000),
         (3, "http://e.com/", "<link a " * 40_000 + link)], "page_id long, url string, html string")
    edges = {(r.a, r.b) for r in urlfilter.page_edges(pages).where("a <> b").collect()}
    assert edges == {("http://c.com/", "http://example.com/de/2"), ("http://e.com/", "http://b.com/de/1")}
    got = {r.page_id: r.verdict for r in urlfilter.judge(pages).collect()}
    assert got == {1: "block", 2: "allow", 3: "allow"}


def test_very_many_siblings_fold_and_keep_their_texts():
    blocks = [f"<h2 class=c{i}>title {i}</h2><p>text {i}</p>" for i in range(3_000)]
    tree = htmltext.parse("<body><article>" + "".join(blocks) + "</article></body>")
    leaves: list = []
    shape = htmltext.fold(tree, leaves)
    assert [leaf.text for _, leaf in leaves] == [f"{kind} {i}" for i in range(3_000) for kind in ("title", "text")]
    wrapper: list = []
    htmltext.merge_children(wrapper, shape)
    placed = htmltext.place(wrapper, shape)
    assert len({htmltext._slot(placed, path) for path, _ in leaves}) == 2


def main_text(page: str) -> str:
    """The text of a page that is alone on its host."""
    out = next(htmltext._extracted(iter([pd.DataFrame(
        {"key": [1], "url": ["u"], "host": ["h"], "html": [page], "wrapper": [None], "template": [None]})])))
    return out["text"][0]


def test_class_words_do_not_drop_the_main_text():
    body = "<p>One long story</p><p>that goes on</p>"
    want = "One long story\nthat goes on"
    assert main_text(f"<div class='layout has-sidebar'><article>{body}</article><div class=ads>buy</div></div>") == want
    assert main_text(f"<article><div class=entry-header><h1>T</h1></div>{body}</article>") == "T\n" + want
    assert main_text(f"<main><div class=elementor-widget>{body}</div><div class=comments>no</div></main>") == want
    widgets = "".join(f"<div class='elementor-widget'>{p}</div>" for p in re.findall("<p>.*?</p>", body))
    assert main_text(f"<div id=menu>a</div>{widgets}<div class=share>b</div>") == want
    assert main_text("<div class=banner>x</div><div class=widget>y</div><div class=promo>z</div>") == "x\ny\nz"
    related = "<div class=related><article>other</article></div>"
    assert main_text(f"<main><article>{body}</article></main>{related}") == want


def test_icons_formulas_and_objects_keep_the_text_after_and_in_them():
    def text(inner):
        return main_text(f"<article><p>One</p>{inner}<p>two</p></article>").split("\n")

    for empty in ("<svg class=a href='#x'/>", "<svg/>", "<svg>", "<svg><svg/><path/><svg>x</svg>y</svg>", "<math/>", "<iframe />",
                  "<iframe src=x>", "<textarea>", "<object data='x'/>", "<template/>", "<noscript/>", "<math><mi></math>",
                  "<svg><title>icon</title><svg><text>t</text></svg><text>u</text></svg>", "<script src='x' />"):
        assert text(empty) == ["One", "two"], empty
    assert text("<p>if <math><mi>x</mi><mo>=</mo><mrow><mn>2</mn></mrow></math> then") == ["One", "if x=2 then", "two"]
    assert text("<object data=x><p>instead</p><object>nested</object></object>") == ["One", "instead", "nested", "two"]
    assert text("<template><p>kept</p></template>") == ["One", "kept", "two"]
    assert text("<iframe src=/a/>gone</iframe><script src=/b/>gone()</script>") == ["One", "two"]
    assert text("<style>all the rest") == ["One"]
    assert len(htmltext.parse("<svg><iframe><p>x</p>" * 20_000).children) == 20_000


def test_alignment_is_the_best_one():
    rng = random.Random(3)

    def tree(depth):
        return [rng.choice("abc"), [tree(depth - 1) for _ in range(rng.randrange(5))] if depth else []]

    for _ in range(300):
        a, b = ["r", [tree(2) for _ in range(5)]], ["r", [tree(2) for _ in range(6)]]
        assert htmltext._matching(a, b, {}) == brute_matching(a, b)
        size, pairs = htmltext._align(a[1], b[1], {})
        assert size == sum(brute_matching(a[1][i], b[1][j]) for i, j in pairs)
        assert all(i < k and j < m for (i, j), (k, m) in itertools.pairwise(pairs))


def test_long_page_in_the_wrapper_of_short_ones(spark):
    """No mark anywhere: the same blocks are template on a page of very many siblings."""
    def page(n, name):
        parts = "".join(f"<h2>{name} title {i}</h2><p>{name} text {i}</p>" for i in range(n))
        return (f"<body><div>Welcome</div><div class=x1><p>Lead {name}</p></div>{parts}<div class=x2><p>Tell others</p>"
                "</div><div>All rights</div></body>")

    sizes = [3] * 11 + [200]
    rows = [(i, f"http://one.com/{i}", page(n, f"n{i}")) for i, n in enumerate(sizes)]
    got = {r.page_id: r.text for r in htmltext.extract(spark.createDataFrame(rows, PAGES)).collect()}
    for i, n in enumerate(sizes):
        assert got[i].split("\n") == [f"Lead n{i}", *(f"n{i} {k} {x}" for x in range(n) for k in ("title", "text"))]


def test_many_different_siblings_align_in_time():
    names = [f"div.{a}{b}{c}" for a in "abcdefghij" for b in "abcdefghij" for c in "abcdefghij"] * 3
    xs, ys = [[x, [["#", []]]] for x in names], [[x, [["#", []]]] for x in names[500:]]
    assert htmltext._align(xs, ys, {})[0] == 2 * len(ys)


def test_merged_wrappers_hold_every_node_of_every_shape():
    rng = random.Random(5)

    def forest(depth):
        return [[rng.choice("abcd"), forest(depth - 1) if depth else []] for _ in range(rng.randrange(5))]

    def whole(placed):
        return all(at >= 0 and whole(below) for at, below in placed)

    shapes = [forest(2) for _ in range(60)]
    parts = []
    for a in range(0, 60, 20):
        parts.append([])
        for shape in shapes[a:a + 20]:
            parts[-1] = htmltext._merged(parts[-1], shape)
    wrapper = htmltext._merged(htmltext._merged(parts[0], parts[1]), parts[2])
    assert all(whole(htmltext.place(wrapper, shape)) for shape in shapes)


def test_template_of_rare_shapes(spark):
    """Every page has a shape of its own; a block repeats only in the later ones."""
    rows = [(i, f"http://one.com/{i}", f"<body><div class=k{i:03}><p>Story {i} is told</p></div>"
             + ("<div class=zz><p>Tell others</p></div>" if i >= 100 else "")) for i in range(150)]
    got = {r.page_id: r.text for r in htmltext.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {i: f"Story {i} is told" for i in range(150)}


def test_copies_under_changing_menus_and_small_vocabularies_stay(spark):
    def page(host, i, story, inner="div class=x1"):
        story = f"<{inner}><p>The story {story} is told here at some length, to its end.</p></{inner.split()[0]}>"
        return (f"http://{host}/{i}", f"<body><div class=x0><p>Menu {i}</p></div>{story}<div class=x2><p>Part {i % 4}</p>"
                "</div><div class=x3><p>All rights</p></div></body>")

    pages = [page("copies.com", i, "A" if i < 40 else f"n{i}") for i in range(48)]
    pages += [page("one.com", i, "A") for i in range(9)]
    pages += [page("marked.com", i, "A", "article") for i in range(30)]
    pages += [page("many.com", i, f"n{i}") for i in range(100)]
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], PAGES)
    got = {r.url: r.text.split("\n") for r in htmltext.extract(frame).collect()}
    assert len(got) == len(pages)
    for url, html_text in pages:
        story = re.search("The story.*?end[.]", html_text)[0]
        assert story in got[url], url
        assert ("All rights" in got[url]) == ("one.com" in url)
        assert "marked.com" in url or got[url][2] == f"Part {int(url.split('/')[-1]) % 4}"


def test_deep_elements_keep_their_text_and_order():
    for depth in (150, 190, 195, 199, 200, 201, 400, 3_000):
        nested = "".join(f"<div>in{i}" for i in range(depth)) + "deep" + "".join(f"</div>out{i}" for i in range(depth))
        page = f"<div class=page><article><p>head</p>{nested}<nav>menu</nav><p>tail</p></article></div><p>after</p>"
        want = ["head", *(f"in{i}" for i in range(depth - 1)), f"in{depth - 1}deep", *(f"out{i}" for i in range(depth)), "tail"]
        assert main_text(page).split("\n") == want
        hidden = "<div>" * depth + "<nav>menu<p>more</p></nav><p>text</p>" + "</div>" * depth
        assert main_text(f"<article><p>head</p>{hidden}<p>tail</p></article>") == "head\ntext\ntail"


def test_forms_around_articles_and_adverts_inside_them():
    body = "<p>" + "Long text of the article. " * 9 + "</p>"
    want = " ".join(["Long text of the article."] * 9)
    page = f"<form id=f><div>name</div><label>Go</label><article>{body}</article><footer>foot</footer></form>"
    assert main_text(page) == want
    assert main_text(f"<nav>m<form><main>{body}</main></form></nav><p>x</p>") != want  # the menu around it stays one
    assert main_text(f"<article>{body}<form>mail <input></form></article>") == want
    assert main_text(f"<article>{body}<div class=ad>Buy now</div><section class=comments>Nice!</section></article>") == want
    assert main_text(f"<article class=post-ads><div class='has-comments'>{body}</div></article>") == want


def test_dot_segments_bases_and_references_keep_links(spark):
    blocked = "http://x.net/b"
    rows = [(1, "http://a.com/f/g/p.html", "<link rel=canonical href='../r.html'>"),
            (2, "http://a.com/f/r.html", f"<meta http-equiv=refresh content='0; url={blocked}'>"),
            (3, "http://b.com/x/y/z", "<link rel=canonical href='./../../../t/./u/..'>"),
            (4, "http://b.com/t/", f"<link rel=canonical href='{blocked}?q=../s'>"),
            (5, "http://c.com/1", "<base target=_top href='/deep/down/x'><link rel=canonical href='2'>"),
            (6, "http://c.com/deep/down/2", "<link rel=canonical href='http&#58;//x&#x2E;net&#47;b'>"),
            (7, "http://d.com/", "<link rel=canonical href='http://d.com/a&#38;amp;b&#xD800;&#9999999;'>"),
            (8, "http://d.com/a&amp;b&#xD800;&#9999999;", f"<link rel=canonical href={blocked}>"),
            (9, "http://e.com/a/../b", f"<link rel=canonical href={blocked}>"),
            (10, "http://e.com/b", ""), (11, "http://e.com/a/..c/.d", "<link rel=canonical href=...>"), (12, "http://e.com/a/..c/...", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in urlfilter.judge(pages).collect()}
    assert got == {k: "block" if k < 11 else "allow" for k in range(1, 13)}
    con = duckdb.connect()
    con.register("pages", pages.where("page_id in (1, 2, 3, 4, 9, 10, 11, 12)").toPandas())
    ok, msg = compare(urlfilter.judge(pages.where("page_id in (1, 2, 3, 4, 9, 10, 11, 12)")), con, urlfilter.oracle_sql())
    assert ok, msg
