"""Main text of web pages by deducing each host's template from equivalence classes of tokens.

A page's tokens are its elements (by the path of tags and class names from the root) and its text nodes
(path and text). The occurrence vector of a token says how often each page of the host has it; tokens
with equal vectors form an equivalence class. Vectors are compared by sums of hashes of (page, count), so
they build up in an ordinary grouped aggregation however many pages a host has.

A class is valid if it is on at least two pages and half of the host's pages. The valid classes of a host
nest by the paths of their tokens (``template``): elements that occur once per page are its fixed tokens, text
with the vector of an element around it is template text, and the rest lies in the slots between. The main slot is
the ``article`` (or else ``main``, or else the deepest fixed element that still holds nine tenths of what is neither
template text nor inside menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments). All
text of the slot is kept but for such elements within it; what is around the slot doesn't count, so a form or a
wrapper named after its sidebar may hold the article. A page without the main slot, or of a host without a
template, uses the same rule on itself alone.

Names are whole words of a class or id (``share``); a box also counts by the last part of a word (``top-banner``), unless
it holds half of the page's text. Parsing takes time in proportion to the page, also where tags are broken.

Text: character references decoded, white space of a block turned into one space, blocks joined by a line
feed. Null html gives an empty text; null or odd urls share the host of that (missing) name; repeated
pages count as pages and come out each; columns other than id, url and html are ignored.
"""

from __future__ import annotations

import html as html_entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.plans.lookup import lookup_join
from tidemill.plans.scratch import materialize

# Fixed values of HTML: elements without content, of raw text, that start a block, and that are no main text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
DROPPED = frozenset("aside button dialog footer form head header input menu nav option select".split()) | RAW
DROPPED_NAMES = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments cookie cookies disqus footer header login "
    "masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted related search share "
    "sharing sidebar skip social sponsor sponsored subscribe toolbar widget".split()
)
# Start tags that end an open element of the second set, as far up as the third.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
SCOPE = frozenset("table td th caption button object html body article section div main nav aside footer header li form".split())

MIN_PAGES, MIN_SHARE, MOST_TEXT, WRAPPER = 2, 0.5, 0.9, 0.5
BOXES = frozenset("article body center details div fieldset form main ol section table td tr ul".split())
WEAK, STRONG = 1, 2
# A tag that is not closed ends where the next one begins.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!?/?[a-zA-Z](?:\"[^\"]*\"|'[^']*'|[^'\"<>])*+(?:>|(?=<))|<[!?][^<>]*(?:>|(?=<))", re.S)
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
CUT_TAG = re.compile(r"<[a-zA-Z/!?][^<>]*\Z")


@dataclass
class Element:
    path: int
    name: str
    depth: int
    dropped: bool
    rank: int = 0  # 2 article, 1 main
    chars: int = 0
    parent: int = 0


@dataclass
class Page:
    """Elements by path with their numbers, elements as (path, place of the one around) in document order, whether each is to be
    dropped by itself, and text nodes as (place of the element, block, dropped, text)."""

    elements: dict[int, Element] = field(default_factory=dict)
    counts: Counter = field(default_factory=Counter)
    nodes: list[tuple[int, int]] = field(default_factory=lambda: [(0, 0)])
    drops: list[int] = field(default_factory=lambda: [0])
    texts: list[tuple[int, int, bool, str]] = field(default_factory=list)


def _hash(*parts: object) -> int:
    return xxhash.xxh64_intdigest("\x00".join(map(str, parts)).encode("utf-8", "surrogatepass")) - 2**63


def _drop(name: str, words: list[str]) -> int:
    """Is an element no main text: for certain, or only if it is no wrapper of most of the page."""
    if name in ("html", "body", "article", "main"):
        return 0
    if (name in DROPPED and name != "form") or any(w in DROPPED_NAMES for w in words):
        return STRONG
    return WEAK if name == "form" or (name in BOXES and any(re.split("[_-]", w)[-1] in DROPPED_NAMES for w in words)) else 0


def parse(source: str) -> Page:
    """Elements and text nodes of a page. Unclosed and misnested tags are put right as far as needed."""
    page = Page()
    page.elements[0] = Element(0, "", 0, False)
    page.counts[0] = 1
    names, places = [""], [0]
    opened: Counter = Counter()
    block = at = 0

    def text(piece: str) -> None:
        if piece.strip():
            page.texts.append((places[-1], block, False, piece))

    def pop_to(size: int) -> None:
        nonlocal block
        block += any(n in BLOCKS for n in names[size:])
        opened.subtract(names[size:])
        del names[size:]
        del places[size:]

    def close(ended, border) -> None:
        """End the nearest open element of ``ended``, unless one of ``border`` is nearer."""
        if any(opened[n] > 0 for n in ended):
            for k in range(len(names) - 1, 0, -1):
                if names[k] in ended:
                    pop_to(k)
                    break
                if names[k] in border:
                    break

    tail = CUT_TAG.search(source, max(source.rfind("<"), 0))
    if tail:
        source = source[: tail.start()]
    while at < len(source):
        found = TOKEN.search(source, at)
        if not found:
            text(source[at:])
            break
        text(source[at : found.start()])
        at, tag = found.end(), found.group()
        named = NAME.match(tag)
        if not named:
            continue
        name = named.group(1).lower()
        if tag[1] == "/":
            close((name,), ())
            continue
        if name in BLOCKS:  # a block ends an open paragraph
            close(("p",), SCOPE)
        if name in CLOSES:
            close(*CLOSES[name])
        if name in VOID:
            if name == "br":
                page.texts.append((places[-1], block, False, " "))
            block += name == "hr"
            continue
        marks = {m[0].lower(): m[1] or m[2] or m[3] for m in ATTRIBUTE.findall(tag)}
        words = f"{marks.get('class', '')} {marks.get('id', '')}".lower().split()
        up = page.nodes[places[-1]][0]
        path = _hash(up, name, marks.get("class", ""))
        rank = 2 if name == "article" else 1 if name == "main" or marks.get("role") == "main" else 0
        block += name in BLOCKS
        page.elements.setdefault(path, Element(path, name, page.elements[up].depth + 1, True, rank=rank, parent=up))
        page.counts[path] += 1
        page.nodes.append((path, places[-1]))
        page.drops.append(_drop(name, words))
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(source, at)
            at = end.end() if end else len(source)
            continue
        names.append(name)
        opened[name] += 1
        places.append(len(page.nodes) - 1)
    _judge(page)
    return page


def _sizes(page: Page, lost: list[bool]) -> list[int]:
    """Characters in each element that are not in a lost one."""
    sizes = [0] * len(page.nodes)
    for place, _, _, piece in page.texts:
        if not lost[place]:
            sizes[place] += len(piece)
    for place in range(len(sizes) - 1, 0, -1):  # what an element holds comes after it
        sizes[page.nodes[place][1]] += sizes[place]
    return sizes


def _judge(page: Page) -> None:
    """Settle what is dropped, and the characters of each element without that."""

    def spread(least: int) -> list[bool]:
        lost = [False]
        for place in range(1, len(page.nodes)):
            lost.append(page.drops[place] >= least or lost[page.nodes[place][1]])
        return lost

    sizes = _sizes(page, spread(STRONG))
    page.drops = [0 if d == WEAK and size >= WRAPPER * sizes[0] else d for d, size in zip(page.drops, sizes, strict=True)]
    lost = spread(WEAK)
    page.texts = [(place, block, lost[place], piece) for place, block, _, piece in page.texts]
    for place, ((path, _), size) in enumerate(zip(page.nodes, _sizes(page, lost), strict=True)):
        element = page.elements[path]
        element.chars += size
        element.dropped = element.dropped and lost[place]  # dropped wherever it is


def text_token(path: int, piece: str) -> int:
    return _hash(path, " ".join(html_entities.unescape(piece).split()))


def main_path(page: Page) -> int:
    """The rule of the main slot on a page by itself."""
    whole = page.elements[0].chars
    once = [e for p, e in page.elements.items() if page.counts[p] == 1 and not e.dropped]
    ranked = [e for e in once if e.rank]
    if ranked:
        return max(ranked, key=lambda e: (e.rank, e.chars, -e.depth)).path
    return max((e for e in once if e.chars >= MOST_TEXT * whole), key=lambda e: e.depth).path


def page_text(page: Page, main: int | None) -> str:
    if main is None or main not in page.elements or page.elements[main].dropped:
        main = main_path(page)
    kept: list[bool] = []  # inside the slot, and below it in nothing that is dropped
    for place, (path, around) in enumerate(page.nodes):
        kept.append(path == main or bool(place and kept[around] and not page.drops[place]))
    blocks: dict[int, list[str]] = {}
    for place, block, _, piece in page.texts:
        if kept[place]:
            blocks.setdefault(block, []).append(piece)
    joined = (" ".join(html_entities.unescape("".join(pieces)).split()) for pieces in blocks.values())
    return "\n".join(b for b in joined if b)


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)), F.lit(""))


TOKENS = "host string, kind string, token bigint, parent bigint, name string, depth int, dropped boolean, rank int, n int, chars bigint, v1 bigint, v2 bigint"


def tokens(pages: DataFrame) -> DataFrame:
    """One row per page and distinct token: its count and the page's part of its occurrence vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 256):
                rows: list[tuple] = []
                part = batch.slice(a, 256)
                for host, page_id, source in zip(part.column("host").to_pylist(), part.column("page_id").to_pylist(), part.column("html").to_pylist(), strict=True):
                    page = parse(source or "")
                    found = [("tag", p, e.parent, e.name, e.depth, e.dropped, e.rank, page.counts[p], e.chars) for p, e in page.elements.items()]
                    texts: dict[int, list[int]] = {}
                    for place, _, dropped, piece in page.texts:
                        if not dropped and piece != " ":
                            path = page.nodes[place][0]
                            known = texts.setdefault(text_token(path, piece), [path, 0, 0])
                            known[1] += 1
                            known[2] += len(piece)
                    found += [("text", t, path, None, 0, False, 0, n, chars) for t, (path, n, chars) in texts.items()]
                    for row in found:
                        v = _hash(page_id, row[7]) % 2**62
                        rows.append((host, *row, v % 2**31, v >> 31))
                columns = list(zip(*rows, strict=True)) if rows else [()] * 12
                types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                names = [c.split()[0] for c in TOKENS.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return pages.select("host", "page_id", "html").mapInArrow(run, TOKENS)


def equivalence_classes(pages: DataFrame) -> DataFrame:
    """Tokens of the valid classes of each host: ``host, kind, token, parent, name, depth, dropped, rank, chars, once``
    (once per page that has it), ``n_pages``, ``host_pages``, ``host_chars`` and the class (``v1, v2``)."""
    grouped = tokens(pages).groupBy("host", "kind", "token").agg(
        F.max("parent").alias("parent"),
        F.max("name").alias("name"),
        F.min("depth").alias("depth"),
        F.min("dropped").alias("dropped"),
        F.max("rank").alias("rank"),
        F.sum("chars").alias("chars"),
        F.sum("n").alias("total"),
        F.count(F.lit(1)).alias("n_pages"),
        F.sum("v1").alias("v1"),
        F.sum("v2").alias("v2"),
    )
    grouped = materialize(grouped.where(f"kind = 'tag' OR n_pages >= {MIN_PAGES}"), "tokens")
    hosts = grouped.where("kind = 'tag' AND token = 0").select("host", F.col("n_pages").alias("host_pages"), F.col("chars").alias("host_chars"))
    known = lookup_join(grouped, materialize(hosts, "hosts"), ["host"], "inner")
    valid = (F.col("n_pages") >= MIN_PAGES) & (F.col("n_pages") >= MIN_SHARE * F.col("host_pages"))
    return known.where(valid).withColumn("once", F.col("total") == F.col("n_pages"))


@dataclass
class Class:
    """Tokens of a host with one occurrence vector."""

    tokens: list[dict] = field(default_factory=list)
    once: bool = False
    parent: tuple[int, int] | None = None  # the class around it


def template(rows: list[dict]) -> tuple[dict[tuple[int, int], Class], dict[int, int], list[dict]]:
    """The valid tokens of one host as nested classes, the characters in the slots of each fixed element, and the
    template text."""
    tags = {row["token"]: row for row in rows if row["kind"] == "tag"}
    classes: dict[tuple[int, int], Class] = {}
    for row in rows:
        found = classes.setdefault((row["v1"], row["v2"]), Class(once=row["once"]))
        found.tokens.append(row)
    slots = {path: row["chars"] for path, row in tags.items()}
    fixed = []

    def above(row: dict) -> Iterator[dict]:
        at = row["parent"] if row["token"] or row["kind"] == "text" else None
        while at is not None and at in tags:  # an element is on every page of what it holds, so its row is valid too
            yield tags[at]
            at = tags[at]["parent"] if at else None

    for vector, found in classes.items():
        outer = min(found.tokens, key=lambda row: row["depth"] if row["kind"] == "tag" else 2**31)
        found.parent = next(((row["v1"], row["v2"]) for row in above(outer) if (row["v1"], row["v2"]) != vector), None)
        for row in found.tokens:
            if row["kind"] == "text" and any((up["v1"], up["v2"]) == vector for up in above(row)):
                fixed.append(row)
                for up in above(row):
                    slots[up["token"]] -= row["chars"]
    return classes, {path: slots[path] for path, row in tags.items() if row["once"] and not row["dropped"]}, fixed


def host_template(rows: list[dict]) -> int | None:
    """The path of a host's main slot, by what its classes leave outside the template."""
    tags = {row["token"]: row for row in rows if row["kind"] == "tag"}
    _, slots, _ = template(rows)
    if not slots.get(0):  # all pages alike: nothing tells the template from what it holds
        slots = {path: tags[path]["chars"] for path in slots}
    ranked = [path for path in slots if tags[path]["rank"]]
    if ranked:
        return max(ranked, key=lambda path: (tags[path]["rank"], tags[path]["chars"], path))
    most = MOST_TEXT * slots.get(0, 0)
    return max((path for path in slots if slots[path] >= most), key=lambda path: (tags[path]["depth"], path), default=None)


def templates(classes: DataFrame) -> DataFrame:
    """``host`` and the path of its main slot. A host's valid tokens are at most twice those of its longest page, since
    each is on half of the pages: they are handled together."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        return pa.table({"host": pa.array([key[0].as_py()], pa.string()), "main": pa.array([host_template(table.to_pylist())], pa.int64())})

    return classes.groupBy("host").applyInArrow(run, "host string, main bigint")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id``, ``url`` and ``text`` of every page."""
    slim = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    slim = slim.withColumn("host", host_of(F.col("url")))
    known = materialize(templates(equivalence_classes(slim)), "templates")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 256):
                part = batch.slice(a, 256)
                columns = (part.column(c).to_pylist() for c in ("html", "main"))
                texts = [page_text(parse(source or ""), main) for source, main in zip(*columns, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return lookup_join(slim, known, ["host"]).select("page_id", "url", "html", "main").mapInArrow(run, "page_id bigint, url string, text string")
