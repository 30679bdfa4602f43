"""Main text of web pages by equivalence classes of template tokens.

Pages of one host with the same kinds of elements have one shape. A token is an element with its path, or a
block of text with its path. Tokens of one shape that occur equally often on each of its pages form a class, and
classes nest as the elements do: a text in the class of the element around it, of the container around
that, or of the whole page stands wherever that stands, so it is template. What stands in the other slots is data. The slot of the
articles is the innermost container that holds most of a shape's text; what stands beside it goes, whatever it is called.
Names of elements decide inside that slot, and on pages of shapes too rare to show a template.

Counts per page meet as sums of page hashes: tokens with equal sums have equal occurrence vectors. So
a shape of any number of pages is summed up where its pages lie.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from hashlib import blake2b
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from fleetspark.llm.common import ship, stored

#: a text is template if it is in a class on so many different pages of its shape; fewer prove nothing, as copies
#: of one article agree too
PAGES = 5
#: inside articles, texts are template only if a shape's template texts make up at most this share of its articles:
#: what repeats beyond that is the articles themselves
SHARE = 0.2
#: a slot is a menu if more than this share of its text is in links
LINKS = 0.5
#: the slot of the articles is sought among so many outer containers of a text
LEVELS = 64
#: an element named like a part around the article is none if it holds the article or, on a page without a marked
#: one, more than this share of the text; elements marked as main yield to articles that hold this share of their text
MOST = 0.5

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(script|style|noscript|template|textarea|title|iframe|svg|math|select|object|canvas|video|audio)\b(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*[^>]*>|\Z)"
    r"|</?([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)|</[^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_MAIN = re.compile(r"(?:^|\s)(?:main|content|main-content|article|article-body|post-content|entry-content|story)(?:$|\s)", re.I)
#: parts of a class or id that name what stands around an article, and those that show another sense (has-sidebar)
_AROUND = re.compile(
    r"ad|ads|advert\w*|sponsor\w*|promo\w*|banner\w*|menu\w*|nav|navbar|navigation|breadcrumbs?|sidebar\w*"
    r"|footer|masthead|cookies?|consent|gdpr|notices?|alerts?|popup|modal|overlay|newsletter|subscribe|signup|login"
    r"|share|sharing|social|related|recommend\w*|widgets?|toolbar|pagination|pager|skip|complementary|contentinfo|search|dialog")
_READERS = re.compile(r"comments?|commentlist|replies|reply|respond|disqus")
_OTHER = {"has", "no", "non", "not", "with", "without", "free", "is", "result", "results", "enabled", "disabled"}

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "button", "center", "dd", "details", "dialog", "dir", "div",
    "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head",
    "header", "hgroup", "hr", "html", "label", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre",
    "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
#: elements that follow each other as rows do; of the others, the first, second, ... have roles of their own
ROWS = {"p", "li", "dt", "dd", "tr", "td", "th", "option", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "br", "hr"}
#: parts around the article whatever they hold; the others only while they don't hold it
AROUND = {"aside", "button", "dialog", "footer", "head", "label", "menu", "nav", "option"}
SOFT = {"fieldset", "form", "header"}
#: an element of these kinds ends an open one of the kinds named, up to the next container
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}), "tfoot": ({"tr", "td", "th", "tbody"}, {"table"}),
}


# --- one page ---------------------------------------------------------------------


@dataclass
class Block:
    """A block of text, the element it stands in and that one's nearest container, ``kind`` 2 inside an article, 1 inside
    another element marked as main, else 0; ``around`` if names put it around the article."""

    text: str
    path: int
    container: int
    linked: int
    kind: int
    around: bool = False
    inside: tuple[int, ...] = ()


@dataclass
class Page:
    """Blocks outside the parts around the article, the paths of all elements, the shape they make up, and the slots: for
    each container of any text the outer containers down to it, the outermost one among them that is marked as
    main (0 for none), and characters of text that is no link."""

    blocks: list[Block] = field(default_factory=list)
    paths: list[int] = field(default_factory=list)
    shape: int = 0
    slots: dict[int, list] = field(default_factory=dict)


def _signed(number: int) -> int:
    return number - 2**64 if number >= 2**63 else number


def step(parent: int, name: str) -> int:
    """The path of an element: that of its parent and one step, hashed, so paths of any depth are one number."""
    return _signed(xxhash.xxh64_intdigest(name, seed=parent % 2**64))


def path_of(path: str) -> int:
    """The number of a path such as ``/html/body/div.note``."""
    out = 0
    for name in path.strip("/").split("/"):
        out = step(out, name)
    return out


def named_like(marks: list[str]) -> str:
    """What the classes and ids of an element call it: "readers" for comments, "around", or nothing."""
    found = ""
    for mark in " ".join(marks).lower().split():
        parts = [p for p in re.split(r"[-_]+", mark) if p]
        if _OTHER.intersection(parts):
            continue
        if any(map(_READERS.fullmatch, parts)):
            return "readers"
        if any(map(_AROUND.fullmatch, parts)):
            found = "around"
    return found


class _Open(NamedTuple):
    """An open element: its path, plain path (without numbers), containers down to it, the outermost of them that is marked,
    whether it is around the article, kind, the doubtful elements it is in, and how many of those began before the article."""

    name: str = ""
    path: int = 0
    plain: int = 0
    containers: tuple[int, ...] = (0,)
    container: int = 0
    marked: int = 0
    around: bool = False
    kind: int = 0
    inside: tuple[int, ...] = ()
    before: int = 0


def parse(page: str) -> Page:
    """Blocks, elements and slots of a page."""
    out = Page()
    found: list[Block] = []
    shape: set[int] = set()
    children: list[dict[int, int]] = [{}]  # of the open elements, how many of each path so far
    stack = [_Open()]
    doubtful: list[list] = []  # of each doubtful element: characters in it, holds the article, is for readers
    parts: list[str] = []
    linked = 0
    links = 0
    marked = False  # whether any element is an article or marked as main

    def end_block() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                top = stack[-1]
                block = Block(text, top.path, top.container, min(linked, len(text)), top.kind, top.around, top.inside)
                found.append(block)
                slot = out.slots.setdefault(top.container, [top.containers, top.marked, 0])
                slot[2] += len(text) - block.linked
                if not top.around:
                    for k in top.inside:
                        doubtful[k][0] += len(text)
                        doubtful[k][1] |= top.kind > 0 and k < top.before
            parts.clear()
        linked = 0

    def leave(at: int) -> None:
        del stack[at:], children[at:]

    def close(name: str) -> None:
        for at in range(len(stack) - 1, 0, -1):
            if stack[at].name == name:
                end_block()
                leave(at)
                return

    def text(raw: str) -> None:
        nonlocal linked
        if raw:
            raw = html.unescape(raw) if "&" in raw else raw
            parts.append(raw)
            if links:
                linked += len(raw.strip())

    at = 0
    for token in _TOKEN.finditer(page):
        text(page[at : token.start()])
        at = token.end()
        if token[1]:
            continue
        name, attributes = (token[2] or token[4] or "").lower(), token[3] or token[5] or ""
        if not name:
            if token[0].startswith("<![CDATA["):
                text(html.escape(token[0][9:].removesuffix("]]>")))
            continue
        closing = page[token.start() + 1] == "/"
        if name == "a":
            links = 0 if closing else 1
        elif name == "br":
            text(" ")
        if name not in BLOCKS:
            continue
        if closing:
            if name == "p" and all(s.name != "p" for s in stack):
                end_block()
            close(name)
            continue
        end_block()
        if stack[-1].name == "p":  # no element of these kinds stands in a paragraph
            leave(len(stack) - 1)
        if name in ENDS:
            ended, bound = ENDS[name]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name in bound:
                    break
                if stack[k].name in ended:
                    leave(k)
                    break
        if name in VOID:
            continue
        marks = [m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)] if attributes else []
        top = stack[-1]
        kind, inside = top.kind, top.inside
        like = named_like(marks) if marks and name not in ("body", "html") else ""
        if name == "article" and like != "readers":
            kind, like = 2, ""
        elif name == "main" or any(map(_MAIN.search, marks)):
            kind, like = max(kind, 1), "" if like != "readers" else like
        marked = marked or kind > 0
        before = top.before if top.kind else len(doubtful)
        if like or name in SOFT and not (name == "header" and kind):
            inside = (*inside, len(doubtful))
            doubtful.append([0, False, like == "readers"])
        called = name + (f".{marks[0].split()[0]}" if marks and marks[0].split() else "")
        plain, path = step(top.plain, called), step(top.path, called)
        container, containers, outer = top.container, top.containers, top.marked
        if name not in ROWS:
            children[-1][path] = nth = children[-1].get(path, 0) + 1
            path = step(top.path, f"{called}{nth}") if nth > 1 else path
            container = path
            if len(containers) <= LEVELS:
                containers = (*containers, path)
                outer = outer or (path if kind else 0)
        stack.append(_Open(name, path, plain, containers, container, outer, top.around or name in AROUND, kind, inside, before))
        children.append({})
        out.paths.append(path)
        shape.add(plain)
    text(page[at:])
    end_block()
    total = sum(len(b.text) for b in found if not b.around)
    gone = {k for k, (chars, holds, readers) in enumerate(doubtful)
            if not holds and (marked or readers or chars <= MOST * total)}
    out.blocks = [b for b in found if not b.around and not gone.intersection(b.inside)]
    out.shape = _signed(xxhash.xxh64_intdigest(" ".join(map(str, sorted(shape)))))
    return out


def best_kind(sizes: list[tuple[int, int]]) -> int:
    """The least kind of block that is main text, of the (kind, characters) of all: articles if they hold enough of what
    is marked as main, else all that is marked, else everything."""
    marked, articles = (sum(n for kind, n in sizes if kind >= least) for least in (1, 2))
    return 2 if articles and articles >= MOST * marked else 1 if marked else 0


def main_text(page: str | None, dropped: Iterable[int] = ()) -> str:
    """The text of a page's article by the page alone. ``dropped`` are tokens of its template that are no data: paths of
    elements and texts. They go only if something is left without them."""
    found = parse(page or "").blocks
    return chosen_text([(b.text, b.path, text_token(b.path, b.text), b.kind) for b in found], dropped)


def chosen_text(blocks: list[tuple[str, int, int, int]], dropped: Iterable[int]) -> str:
    least = best_kind([(kind, len(text)) for text, _, _, kind in blocks])
    main = [(text, path, token) for text, path, token, kind in blocks if kind >= least]
    gone = set(dropped)
    # a menu of links is a matter of pages without a mark; within an article, lists of links are data
    kept = [text for text, path, token in main if token not in gone and (least or path not in gone)]
    return "\n\n".join(kept or [text for text, *_ in main])


def in_region(container: int, containers: Iterable[int], region: list[int]) -> bool:
    """Whether text of a container is in the slot of the articles, or stands directly in a container around it as a
    title may. ``region`` are the containers down to that slot."""
    return region[-1] in containers or container in region


def text_token(path: int, text: str) -> int:
    return _signed(xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), seed=path % 2**64) ^ 1)


# --- tables -----------------------------------------------------------------------


def host_of(url: Column) -> Column:
    """Host of a URL in lower case, without user, port and a leading ``www.``; empty if there is none."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.regexp_replace(host, r"^www\.", "")


BLOCK = "array<struct<text string, path long, container long, linked int, kind int, token long>>"
SLOT = "array<struct<container long, containers array<long>, marked long, chars long>>"


def parsed(pages: DataFrame) -> DataFrame:
    """``page_id, url, host, shape, mark`` (a hash of the page), ``paths`` of its elements, ``blocks`` and ``slots``."""
    fields = [("text", pa.string()), ("path", pa.int64()), ("container", pa.int64()), ("linked", pa.int32()),
              ("kind", pa.int32()), ("token", pa.int64())]
    slot = pa.struct([("container", pa.int64()), ("containers", pa.list_(pa.int64())), ("marked", pa.int64()), ("chars", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [p.as_py() or "" for p in part.column(3)]
                found = [parse(t) for t in texts]
                marks = [_signed(int.from_bytes(blake2b(t.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little"))
                         for t in texts]
                blocks = [[(b.text, b.path, b.container, b.linked, b.kind, text_token(b.path, b.text)) for b in f.blocks] for f in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), pa.array([f.shape for f in found], pa.int64()),
                     pa.array(marks, pa.int64()), pa.array([f.paths for f in found], pa.list_(pa.int64())),
                     pa.array([[dict(zip([n for n, _ in fields], b)) for b in bs] for bs in blocks], pa.list_(pa.struct(fields))),
                     pa.array([[{"container": c, "containers": list(v[0]), "marked": v[1], "chars": v[2]} for c, v in f.slots.items()]
                               for f in found], pa.list_(slot))],
                    names=["page_id", "url", "host", "shape", "mark", "paths", "blocks", "slots"])

    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        host_of(F.col("url")).alias("host"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(
        run, f"page_id long, url string, host string, shape long, mark long, paths array<long>, blocks {BLOCK}, slots {SLOT}")


GROUP = ["host", "shape"]
VECTOR = ["v0", "v1", "v2"]


def _vector(n: Column) -> list[Column]:
    """An occurrence vector as three sums of page hashes of 20 bits, which stay far below 2^63."""
    return [F.sum(n * F.shiftrightunsigned("mark", 20 * i).bitwiseAND(F.lit(0xFFFFF).cast("long"))).alias(v) for i, v in enumerate(VECTOR)]


def element_counts(pages: DataFrame) -> DataFrame:
    """Per shape and element ``path``: its occurrence vector, characters of its own text and of the part in
    links. The page itself is the path 0."""
    paths = pages.select(*GROUP, "mark", F.explode(F.concat("paths", F.array(F.lit(0).cast("long")))).alias("path"))
    vectors = paths.groupBy(*GROUP, "path").agg(*_vector(F.lit(1).cast("long")))
    texts = pages.select(*GROUP, F.inline(F.transform("blocks", lambda b: F.struct(
        b["path"].alias("path"), F.char_length(b["text"]).alias("chars"), b["linked"].alias("linked")))))
    sizes = texts.groupBy(*GROUP, "path").agg(F.sum("chars").alias("chars"), F.sum("linked").alias("linked"))
    return vectors.join(sizes, [*GROUP, "path"], "left").na.fill(0, ["chars", "linked"])


def text_counts(pages: DataFrame) -> DataFrame:
    """Per shape and text ``token``: its vector, ``path`` and ``container``, on how many different ``pages`` it is,
    characters, and those within articles. Only texts on enough pages."""
    rows = pages.select(*GROUP, "mark", F.inline(F.transform("blocks", lambda b: F.struct(
        b["token"].alias("token"), b["path"].alias("path"), b["container"].alias("container"),
        F.char_length(b["text"]).alias("chars"), F.when(b["kind"] > 0, F.char_length(b["text"])).otherwise(0).alias("inside")))))
    per_page = rows.groupBy(*GROUP, "token", "mark").agg(
        F.first("path").alias("path"), F.first("container").alias("container"),
        F.sum("chars").alias("chars"), F.sum("inside").alias("inside"), F.count(F.lit(1)).alias("n"))
    return per_page.groupBy(*GROUP, "token").agg(
        F.first("path").alias("path"), F.first("container").alias("container"), F.count(F.lit(1)).alias("pages"),
        F.sum("chars").alias("chars"), F.sum("inside").alias("inside"), *_vector(F.col("n"))).where(F.col("pages") >= PAGES)


def host_templates(pages: DataFrame) -> DataFrame:
    """``host, shape, dropped``: the tokens of each shape's template that hold no data, from ``parsed`` pages.

    An element most of whose text is in links is a menu. A text is fixed if it is on enough different pages and its class
    is that of its element, of the container around it, or of the page. Fixed texts within articles count only
    while they are a small share of the shape's articles.
    """
    elements = stored(element_counts(pages), "elements")
    menus = elements.where(F.col("linked") > LINKS * F.col("chars")).select(*GROUP, F.col("path").alias("token"))
    texts = stored(text_counts(pages), "texts")
    around = F.array_distinct(F.array("path", "container", F.lit(0).cast("long")))
    classes = texts.select(*GROUP, "token", "inside", *VECTOR, F.explode(around).alias("path"))
    fixed = classes.join(elements.select(*GROUP, "path", *VECTOR), [*GROUP, "path", *VECTOR]).select(*GROUP, "token", "inside").distinct()
    sizes = pages.select(*GROUP, F.aggregate(
        "blocks", F.lit(0).cast("long"), lambda n, b: n + F.when(b["kind"] > 0, F.char_length(b["text"])).otherwise(0)).alias("chars"))
    sizes = sizes.groupBy(*GROUP).agg(F.sum("chars").alias("articles"))
    taken = fixed.groupBy(*GROUP).agg(F.sum("inside").alias("taken"))
    able = taken.join(sizes, GROUP).where(F.col("taken") <= SHARE * F.col("articles")).select(*GROUP, F.lit(True).alias("able"))
    fixed = fixed.join(able, GROUP, "left").where("inside = 0 OR able").select(*GROUP, "token")
    return menus.unionByName(fixed).groupBy(*GROUP).agg(F.sort_array(F.collect_set("token")).alias("dropped"))


def regions(pages: DataFrame) -> DataFrame:
    """``host, shape, region``: for each shape of enough different pages the containers down to the slot of its articles.

    That slot is the innermost container with most of the shape's text that is no link and, if any text is marked as main, with nearly
    all of that; if it is part of a marked one, the outermost such is it.
    """
    able = pages.groupBy(*GROUP).agg(F.count_distinct("mark").alias("pages")).where(F.col("pages") >= PAGES).select(*GROUP)
    slots = pages.select(*GROUP, F.inline("slots")).groupBy(*GROUP, "container").agg(
        F.sum("chars").alias("chars"), F.first("containers").alias("containers"), F.first("marked").alias("marked"))
    slots = stored(slots.join(able, GROUP), "slots")
    main = F.when(F.col("marked") != 0, F.col("chars")).otherwise(0)
    totals = slots.groupBy(*GROUP).agg(F.sum("chars").alias("total"), F.sum(main).alias("total_marked"))
    parts = slots.select(*GROUP, "chars", main.alias("main"), "marked", "containers", F.posexplode("containers").alias("depth", "node"))
    down = F.slice("containers", F.lit(1), F.col("depth") + 1)
    parts = parts.groupBy(*GROUP, "node").agg(
        F.sum("chars").alias("chars"), F.sum("main").alias("main"), F.first("depth").alias("depth"), F.first(down).alias("region"),
        F.max(F.array_position(down, F.col("marked"))).alias("marked_at"))
    holds = parts.join(totals, GROUP).where(
        (F.col("total") > 0) & (F.col("chars") >= MOST * F.col("total")) & (F.col("main") >= (1 - SHARE) * F.col("total_marked")))
    inner = holds.groupBy(*GROUP).agg(F.max_by(F.struct("region", "marked_at"), F.struct("depth", "node")).alias("best"))
    # the root, number 0, is a place in every list but never marked
    outer = F.when((F.col("best.marked_at") > 1), F.slice("best.region", F.lit(1), F.col("best.marked_at").cast("int")))
    return inner.select(*GROUP, F.coalesce(outer, F.col("best.region")).alias("region"))


def templates_of(pages: DataFrame) -> DataFrame:
    """``host, shape, dropped, region`` from ``parsed`` pages (``host_templates``, ``regions``)."""
    return host_templates(pages).join(regions(pages), GROUP, "full")


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every row.

    The text is the article's blocks in order, joined by two line feeds, character references decoded and
    white space within a block turned into one space. Text outside the slot of the articles that the template of the page's
    host and shape shows goes, and so do texts and menus that are part of that template. A page without an
    element marked as article or main is taken whole, but for that.
    NULL html is empty, and so is its text; pages with a NULL or unreadable url are one host; repeated
    rows get the same text; an empty table gives an empty table. Other columns are not read.
    """

    def extracted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for blocks, slots, dropped, region in zip(*(batch.column(i) for i in (2, 3, 4, 5))):
                region = region.as_py()
                down = {x["container"]: x["containers"] for x in slots.as_py()}
                rows = [(b["text"], b["path"], b["token"], b["kind"]) for b in blocks.as_py()
                        if region is None or in_region(b["container"], down[b["container"]], region)]
                found.append(chosen_text(rows, dropped.as_py() or ()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    rows = stored(parsed(pages), "parsed")
    templates = stored(templates_of(rows), "templates")
    return rows.join(templates, GROUP, "left").select("page_id", "url", "blocks", "slots", "dropped", "region").mapInArrow(
        extracted, "page_id long, url string, text string, n_chars long")


ship(__name__)
