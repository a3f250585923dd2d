"""Template deduction and text of pages."""

from __future__ import annotations

import html
import re
import time

from tidemill.llm import html_extract as he
from tidemill.llm.queries import QUERIES

PAGE = (
    '<!DOCTYPE html><html><head><title>t {n}</title><style>p{{}}</style><script>var a="</p><p>x";</script></head><body>'
    '<header><h1>Site</h1></header><nav><ul><li><a href="/">Home {n}</a><li>Two</ul></nav><!-- c --><div class="top-banner">Buy {n}</div>'
    '<div id="content"><h2>Head {n}</h2><p>First&nbsp;&amp; <b>bold</b>\n text {n}.<p>Second<br>line &#233;&lt;b&gt;</p>{more}</div>'
    '<aside>Side</aside><div class="comments"><p>I agree {n}</p></div><form><p>Search</p><input></form><footer>&copy; me</footer></body></html>'
)


def texts(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id bigint, url string, html string, text string, host string")
    out = he.extract(df).collect()
    assert len(out) == len(rows)
    return {(r["page_id"], r["url"]): r["text"] for r in out}


def test_boilerplate_goes_and_everything_else_stays(spark):
    rows = [(n, f"https://a.example.com/{n}", PAGE.format(n=n, more=f"<ul><li>i{n}</li><li>j</li></ul>tail {n}")) for n in range(6)]
    got = texts(spark, rows)
    assert got[3, "https://a.example.com/3"] == "Head 3\nFirst & bold text 3.\nSecond line é<b>\ni3\nj\ntail 3"
    one = texts(spark, rows[3:4])  # a host with one page has no template
    assert one == {k: v for k, v in got.items() if k[0] == 3}


def test_text_of_the_slot_stays_on_any_number_of_pages(spark):
    for pages in (5, 19, 25):
        rows = [(n, f"http://b.example.com/{n}", PAGE.format(n=n, more="<p>Written by the editors</p>" + ("<p>Often</p>" if n % 3 else ""))) for n in range(pages)]
        got = texts(spark, rows)
        assert all("Written by the editors" in t for t in got.values())


def test_wrappers_do_not_hide_the_article(spark):
    inner = "<article><h1>Head {n}</h1><p>Text {n}</p><p class='market-share'>Sold {n}</p><div class='share'>Tell {n}</div></article>"
    whole = "<div class='menu'><a>Home</a></div><h1>Head {n}</h1><p>Text {n} is long enough to count</p><div class='site-footer'>Foot {n}</div>"
    shapes = {
        "l": "<body><div class='layout with-sidebar'>" + inner + "<div class='sidebar'>Side</div></div></body>",
        "r": "<body><div id='page' class='single related-enabled'><main>" + inner + "</main></div></body>",
        "f": "<body><form action='x'>" + whole + "</form></body>",
        "g": "<body><form action='x'><input>" + inner + "</form></body>",
        "c": "<body><div class='story'><p>Text {n} and more of it</p></div><div class='comments'><article><p>Me {n} too</p></article></div></body>",
    }
    rows = [(n, f"http://{k}.example.com/{n}", shape.format(n=n)) for k, shape in shapes.items() for n in range(3)]
    for found in (texts(spark, rows), texts(spark, [r for r in rows if r[0] == 2])):
        article = "Head 2\nText 2\nSold 2"
        assert found[2, "http://l.example.com/2"] == found[2, "http://r.example.com/2"] == found[2, "http://g.example.com/2"] == article
        assert found[2, "http://f.example.com/2"] == "Head 2\nText 2 is long enough to count"
        assert found[2, "http://c.example.com/2"] == "Text 2 and more of it"


def test_broken_tags_take_time_in_proportion():
    size = 500_000
    for piece in ("<a b ", "<a b=\"", "<a b='x", "</b>", "<b>", "<i></u>", "<!", "<li>", "<p><b>", "<ul><li><p>", "<!-- "):
        start = time.perf_counter()
        he.page_text(he.parse(piece * (size // len(piece))), None)
        assert time.perf_counter() - start < 8, piece


def test_edge_pages(spark):
    rows = [
        (1, None, None),
        (2, "no scheme", ""),
        (3, "http://c.example.com", "plain < text & more &amp"),
        (4, "http://c.example.com/x", "<article><p>cut off in a ta"),
        (5, "http://c.example.com/y", "<p>open <b>never closed<div>block</p></i></div>end <a hre"),
        (6, "http://d.example.com", "<div>" * 3000 + "deep" + "</div>" * 3000),
        (6, "http://d.example.com", "<div>" * 3000 + "deep" + "</div>" * 3000),
        (7, "http://e.example.com", "<article>" + "<p>" + "long text " * 50_000 + "</article>"),
        (8, "http://e.example.com/8", "<article>a</article><article>longer b</article><p>outside</p>"),
        (None, "http://f.example.com", "<main>m<nav>n</nav></main>o"),
    ]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = [(r["page_id"], r["text"]) for r in he.extract(df).collect()]
    assert len(got) == len(rows) and all(t is not None for _, t in got)
    by = dict(got)
    assert by[1] == by[2] == "" and by[3] == "plain < text & more &" and by[4] == "cut off in a ta"
    assert by[5] == "open never closed\nblock\nend" and [t for i, t in got if i == 6] == ["deep", "deep"]
    assert by[7] == ("long text " * 50_000).strip() and by[None] == "m"
    assert by[8] == "a\nlonger b\noutside"  # two articles of one path are no single main slot
    assert he.extract(df.limit(0)).collect() == []


def test_occurrence_vectors(spark):
    rows = [(n, f"http://g.example.com/{n}", f"<body><div><p>{n}</p>{'<p>x</p>' * (n % 2)}</div></body>") for n in range(4)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("host", he.host_of("url"))
    classes = {r["name"]: r for r in he.equivalence_classes(df).where("kind = 'tag'").collect()}
    same = {n: (r["v1"], r["v2"]) for n, r in classes.items()}
    assert same["body"] == same["div"] == same[""] != same["p"]
    assert classes["body"]["once"] and not classes["p"]["once"] and classes["p"]["total"] == 6


def test_whole_table(spark):
    """Every page of the table against the paragraphs of its article."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    got = {r["page_id"]: r for r in QUERIES["op4_html_extract"](spark, "/root/testdata/sf0.01").collect()}
    for page in pages:
        article = re.search(r"<article>(.*?)</article>", page["html"], re.S).group(1)
        parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", article))
        expected = "\n".join(p for p in parts if p)
        assert got[page["page_id"]]["text"] == expected and got[page["page_id"]]["n_chars"] == len(expected)


def test_classes_nest_and_show_the_slot(spark):
    """Unlisted boilerplate outside the slot goes, since template text does not count when the slot is sought."""
    page = "<body><div class='top'>{welcome}</div><div class='story'><h2>Head {n}</h2><p>{n} alone</p><p>Again</p></div></body>"
    rows = [(n, f"http://h.example.com/{n}", page.format(n=n, welcome="Welcome to our pages. " * 9)) for n in range(4)]
    assert texts(spark, rows)[2, "http://h.example.com/2"] == "Head 2\n2 alone\nAgain"
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("host", he.host_of("url"))
    found = [r.asDict() for r in he.equivalence_classes(df).collect()]
    classes, slots, fixed = he.template(found)
    root, inner = (next((r["v1"], r["v2"]) for r in found if r["name"] == n) for n in ("body", "p"))
    assert classes[root].parent is None and classes[inner].parent == root
    assert {r["name"] for r in classes[root].tokens if r["kind"] == "tag"} == {"", "body", "div", "h2"}
    assert len(fixed) == 2 and slots[0] == 4 * len("Head 0" + "0 alone")


def test_text_of_an_article_stays_on_any_number_of_pages(spark):
    byline = "<body><article><p>By the same hand</p><p>Piece {n}</p></article><p>outside {n}</p></body>"
    for pages in (19, 25):
        rows = [(n, f"http://i.example.com/{n}", byline.format(n=n)) for n in range(pages)]
        rows += [(n, f"http://j.example.com/{n}", "<body><article><p>One text</p></article></body>") for n in range(pages)]
        rows += [(n, f"http://k.example.com/{n}", "<body><div><p>One text</p></div></body>") for n in range(pages)]
        got = texts(spark, rows)
        assert got[7, "http://i.example.com/7"] == "By the same hand\nPiece 7"
        assert {t for (_, url), t in got.items() if "//i" not in url} == {"One text"}


def test_an_article_below_many_open_elements_keeps_its_text():
    for tag in ("font", "div"):
        page = he.parse(f"<{tag}>" * 500 + "<article><h1>Deep</h1><p>text</p></article><p>outside</p>")
        assert he.page_text(page, None) == "Deep\ntext"
