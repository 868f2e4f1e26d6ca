"""Main text of web pages by wrappers inferred from pages of the same host.

A page becomes a stream of element and text tokens (scripts, styles, comments
and inline markup leave it).  Streams of a host are aligned one after the other
into a union-free regular expression, the wrapper: equal tokens match; unequal
texts become a text slot; a token that follows an equal one belongs to a
repeated group; a token that only one side has becomes an optional group.  As
groups are balanced, an element is one token of its parent's stream and its own
stream is aligned inside.  The expression is a list
``[token, repeated, optional, text, inner, pages]``; ``text`` is the digest of the
text that all pages have there, or null for a slot; ``pages`` has the digests of
two pages with different texts that have it (of one, if there are no two).

Wrappers are folded in three steps: the pages of a block by host, the distinct
results in ``SALTS`` parts of each host, the parts of a host, so no task sees all
pages of a large host.  A host's wrapper then meets its pages in a join.

A page is read along its wrapper.  Text is dropped in elements that are menus,
headers, footers, sidebars, notices, adverts, forms or comments by their names,
roles, classes and ids.  Where the page has an article (or main) element, only
what is inside it can be main text; elsewhere blocks that are mostly links are
none.  In both the wrapper decides: slots, optional and repeated groups stay, and
text is the template's if at least two pages with different texts have it in the
same place, none there having another, unless it has no link and stands, under the same
element, between texts in which the pages differ, as headings do.  What only one page (or its copies) has is
never the template's, nor is anything in an article in which no text differs.
An article with a name of the list is read where the page has no other, if the
host's pages have it once and differ in it.

* null or empty html: empty text; null url: the host is empty.
* elements nested deeper than ``DEEPEST`` belong to their ancestor's stream.
* unclosed elements end with their parent or the page, stray ends are ignored.
* a host with one page, or copies of one, has no slots to learn from; then only
  the elements' names decide.
* repeated rows and extra columns need no care; an empty table gives no rows.
"""

from __future__ import annotations

import difflib
import functools
import html as entities
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import blocks, map_blocks, prepare

SALTS = 32
#: Elements nested deeper are read as part of the last one above.
DEEPEST = 100
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[(.*?)(?:\]\]>|$)|<[!?][^>]*(?:>|$)|"
                   r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|(?<![\w-])(hidden)(?![\w-])")
#: Elements whose content is no text of the page.
RAW = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "select", "textarea", "button",
       "canvas", "audio", "video"}
#: Elements that other elements lie in.
BOXES = {"html", "head", "body", "nav", "header", "footer", "aside", "main", "article", "section", "div", "form", "ul",
         "ol", "dl", "table", "thead", "tbody", "tfoot", "tr", "figure", "fieldset", "details", "dialog", "menu", "center"}
#: Elements that begin a block of text and need no end.
BLOCKS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "td", "th", "dt", "dd", "pre", "blockquote", "br", "hr",
          "title", "figcaption", "caption", "summary", "address", "legend", "label", "option"}
VOID = {"br", "hr"}
#: Never main text: elements, roles, and words of classes and ids.
ASIDE = {"head", "nav", "footer", "aside", "form", "menu", "dialog", "fieldset"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu",
         "menubar", "form", "toolbar"}
NAMES = set("""ad ads adv advert adverts advertisement advertising adbox sponsor sponsored promo promoted teaser
    breadcrumb breadcrumbs cookie cookies consent gdpr notice notices alert popup modal overlay comment comments
    commentlist respond reply replies discussion disqus share sharing social related recommended recommendations
    newsletter subscribe signup login search pagination pager toolbar skip copyright legal disclaimer""".split())
#: Words that also describe a page's layout: no matter if an article lies inside.
LAYOUT = set("""nav navbar navigation menu menubar footer bottombar sidebar sidebars aside rail banner banners widget
    widgets hidden""".split())
#: Headers: of an article only the headings count.
TOPS = {"header", "masthead", "topbar"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}


# ------------------------------------------------------------------ pages
class Box:
    """An element of a page: name, token, kind and children.  Kinds: never main
    text (``aside``), unless an article is inside (``layout``), a header (``top``), an
article that its class or id speaks against (``named``).
    A child is a Box or a block of text (token, text, characters in links)."""

    __slots__ = ("name", "token", "kind", "children")

    def __init__(self, name: str, token: str, kind: str):
        self.name, self.token, self.kind, self.children = name, token, kind, []

    @property
    def main(self) -> bool:
        return self.name in ("article", "main")


@functools.lru_cache(maxsize=1 << 14)
def token_of(name: str, attributes: str) -> tuple[str, str]:
    """An element's token and kind."""
    aside, words = name in ASIDE, []
    for m in ATTRIBUTE.finditer(attributes):
        key, value = (m[1] or m[5]).lower(), (m[2] or m[3] or m[4] or "").lower()
        if key in ("class", "id"):
            words += re.findall(r"[a-z]+", re.sub(r"\d+", " ", value))
        elif key == "role":
            aside |= value in ROLES
        elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and "display:none" in value.replace(" ", ""):
            aside = True
    token = name + "".join("." + w for w in sorted(set(words))[:3])
    if name in ("html", "body"):
        return token, ""
    if aside or not NAMES.isdisjoint(words):
        return token, "aside" if aside or name not in ("article", "main") else "named"
    if name == "header" or name not in ("article", "main") and not TOPS.isdisjoint(words):
        return token, "top"
    return token, "layout" if name not in ("article", "main") and not LAYOUT.isdisjoint(words) else ""


def parse(page: str) -> Box:
    """The elements and blocks of a page."""
    root = Box("", "", "")
    stack, deep, block, piece, linked, link = [root], 0, "#", [], 0, 0
    unclosed: set[str] = set()

    def flush() -> None:
        nonlocal linked
        text = " ".join(entities.unescape("".join(piece)).split())
        if text:
            stack[-1].children.append((block, text, linked))
        piece.clear()
        linked = 0

    def put(text: str) -> None:
        nonlocal linked
        if text:
            piece.append(text)
            linked += len(text) * link

    at = 0
    while m := TOKEN.search(page, at):
        put(page[at:m.start()])
        at = m.end()
        if m[3] is None:
            put(m[1] or "")
            continue
        name, end = m[3].lower(), m[2]
        if name in RAW:
            if end or name in unclosed or m[4].endswith("/"):
                continue
            if close := re.compile(rf"</{name}\b[^>]*(?:>|$)", re.I).search(page, at):
                at = close.end()
            elif name in ("script", "style", "textarea"):
                at = len(page)
            else:
                unclosed.add(name)
        elif name in BOXES:
            flush()
            block, link = "#", 0
            if not end and len(stack) >= DEEPEST:
                deep += 1
            elif not end:
                box = Box(name, *token_of(name, m[4]))
                stack[-1].children.append(box)
                stack.append(box)
            elif deep:
                deep -= 1
            elif any(b.name == name for b in stack):
                while stack.pop().name != name:
                    pass
        elif name in BLOCKS:
            flush()
            link = 0
            block = block if name in VOID else "#" if end else name
        elif name == "a":
            link = 0 if end else 1
    put(re.sub(r"<[a-zA-Z/!][^>]*$", "", page[at:]))
    flush()
    settle(root)
    return root


def settle(box: Box) -> bool:
    """Whether a box is or has an article; layout around one is no layout."""
    inside = [settle(c) for c in box.children if isinstance(c, Box)]
    if box.kind in ("aside", "named"):
        return False
    if box.kind in ("layout", "top") and any(inside):
        box.kind = ""
    if box.kind == "layout":
        box.kind = "aside"
    return box.kind == "" and (box.main or any(inside))


# --------------------------------------------------------------- wrappers
def digest(text: str) -> str:
    return xxhash.xxh64_hexdigest(text.encode("utf-8", "replace"))


def texts_of(box: Box) -> Iterator[str]:
    for c in box.children:
        if isinstance(c, Box):
            yield from texts_of(c)
        else:
            yield c[1]


def wrapper(box: Box, page: str | None = None) -> list:
    """The expression of one page; ``page`` is the digest of its texts."""
    page = page or digest("\n".join(texts_of(box)))
    inner: list = []
    for c in box.children:
        item = wrapper(c, page) if isinstance(c, Box) else [c[0] + "#", False, False, digest(c[1]), [], [page]]
        inner.append(item)
    return [box.token, False, False, None, repeats(inner), []]


def repeats(items: list) -> list:
    """Neighbours with the same token become a repeated group."""
    out: list = []
    for item in items:
        if out and out[-1][0] == item[0]:
            out[-1] = align(out[-1], item)
            out[-1][1] = True
        else:
            out.append(item)
    return out


@functools.lru_cache(maxsize=1 << 14)
def matches(a: tuple[str, ...], b: tuple[str, ...]) -> tuple[tuple[int, int], ...]:
    """Pairs of places where two streams of tokens agree, in order."""
    m = difflib.SequenceMatcher(None, a, b, autojunk=False)
    return tuple((i + k, j + k) for i, j, n in m.get_matching_blocks() for k in range(n))


def align(a: list, b: list) -> list:
    """The expression that generalises two with the same token."""
    inner, i, j = [], 0, 0
    for x, y in (*matches(tuple(c[0] for c in a[4]), tuple(c[0] for c in b[4])), (len(a[4]), len(b[4]))):
        for c in (*a[4][i:x], *b[4][j:y]):  # only one side has them
            inner.append([c[0], c[1], True, *c[3:]])
        if x < len(a[4]):
            inner.append(align(a[4][x], b[4][y]))
        i, j = x + 1, y + 1
    text = a[3] if a[3] == b[3] else None
    pages = sorted({*a[5], *b[5]})[:2] if text else []
    return [a[0], a[1] or b[1], a[2] or b[2], text, repeats(inner), pages]


def expression(w: list) -> str:
    """A wrapper as a regular expression over tokens, for people."""
    name, repeated, optional, text, inner, _ = w
    body = f"{name}={text}" if text else name if name.endswith("#") else f"<{name}>" + " ".join(map(expression, inner)) + "</>"
    return f"({body})" + ("+" if repeated else "") + ("?" if optional else "") if repeated or optional else body


def has_slots(w: list) -> bool:
    """Whether the pages of a wrapper differ in a text."""
    return any(c[3] is None and not c[1] if c[0].endswith("#") else has_slots(c) for c in w[4])


def fixed(w: list | None, text: str) -> bool:
    """Whether a text is the template's: two different pages have it there, and
    none has another."""
    return w is not None and len(w[5]) > 1 and w[3] == digest(text)


# -------------------------------------------------------------- main text
def find_main(box: Box) -> bool:
    return any(isinstance(c, Box) and c.kind == "" and (c.main or find_main(c)) for c in box.children)


def main_text(page: str, w: list | None) -> str:
    """The main text of a page, read along its host's wrapper."""
    root = parse(page)
    only_main, learned = find_main(root), bool(w) and has_slots(w)
    out: list[str] = []

    def walk(box: Box, w: list | None, inside: bool, titles: bool, template: bool) -> None:
        own = [c.token if isinstance(c, Box) else c[0] + "#" for c in box.children]
        runs = [k for k in range(len(own)) if not k or own[k] != own[k - 1]]  # as in a wrapper
        place = dict(matches(tuple(own[k] for k in runs), tuple(c[0] for c in w[4]))) if w else {}
        run, inners = -1, []
        for k in range(len(own)):
            run += run + 1 < len(runs) and runs[run + 1] == k
            inners.append(w[4][place[run]] if run in place else None)
        # a heading or a quotation that pages share stands between texts in which they differ
        differ = [k for k, (c, inner) in enumerate(zip(box.children, inners)) if template and (
            (c.kind == "" and (inner is None or has_slots(inner))) if isinstance(c, Box) else not fixed(inner, c[1]))]
        for k, (c, inner) in enumerate(zip(box.children, inners)):
            if isinstance(c, Box):
                own_slots = c.main and inner is not None and has_slots(inner)
                if c.kind == "" or c.kind == "top" and inside or (
                        c.kind == "named" and not only_main and own_slots and not inner[1]):
                    walk(c, inner, inside or c.main, titles or c.kind == "top", template or own_slots)
            elif template and fixed(inner, c[1]) and not (differ and differ[0] < k < differ[-1] and not c[2]):
                pass
            elif only_main:
                if inside and (not titles or c[0] in HEADINGS):
                    out.append(c[1])
            elif 2 * c[2] <= len(c[1]):
                out.append(c[1])

    # beside articles no text is looked at, inside one its own slots tell
    walk(root, w, False, False, learned and not only_main)
    return " ".join(out)


# ------------------------------------------------------------------ Spark
def host_of(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1))


def fold(items: Iterator[str]) -> str | None:
    out = None
    for text in items:
        w = json.loads(text)
        out = w if out is None else align(out, w)
    return None if out is None else json.dumps(out, ensure_ascii=False)


def infer(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, wrapper): one expression, as JSON, for every host."""
    prepare(pages.sparkSession)
    rows = pages.select(host_of(F.col(f"`{url}`").cast("string")).alias("host"), F.col(f"`{html}`").cast("string").alias("text"))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            by_host: dict[str, list] = {}
            for host, page in zip(block.column("host").to_pylist(), block.column("text").to_pylist()):
                w = wrapper(parse(page or ""))
                by_host[host] = align(by_host[host], w) if host in by_host else w
            yield pa.RecordBatch.from_arrays([pa.array(list(by_host)), pa.array(
                [json.dumps(w, ensure_ascii=False) for w in by_host.values()])], names=["host", "wrapper"])

    def merge(t: pa.Table) -> pa.Table:
        texts = sorted(t.column("wrapper").to_pylist())
        return pa.table({"host": pa.array([t.column("host")[0].as_py()], pa.string()), "wrapper": [fold(iter(texts))]})

    schema = "host string, wrapper string"
    part = rows.mapInArrow(first, schema).distinct()
    salted = part.groupBy("host", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS))).applyInArrow(merge, schema)
    return salted.groupBy("host").applyInArrow(merge, schema)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text) for every page."""
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
                        F.col(f"`{html}`").cast("string").alias("text"))
    rows = rows.withColumn("host", host_of(F.col("url"))).join(infer(pages, url, html), "host", "left")

    def run(block: pa.RecordBatch) -> dict:
        known: dict[str, list] = {}
        out = []
        for host, page, w in zip(*(block.column(c).to_pylist() for c in ("host", "text", "wrapper"))):
            if host not in known:
                known[host] = json.loads(w) if w else None
            out.append(main_text(page or "", known[host]))
        return {"page_id": block.column("page_id"), "url": block.column("url"), "main": out}

    schema = f"page_id {pages.schema[page_id].dataType.simpleString()}, url string, main string"
    return map_blocks(rows, "text", schema, run).withColumnRenamed("main", "text")
