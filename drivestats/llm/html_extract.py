"""Main text of web pages by nearest-URL differencing (operator 1).

A page is parsed into blocks of text. Pages of a host are put in order of
their URL path and each is compared with its nearest neighbour there, the one
before or after it that shares more leading path parts and whose blocks are
not all the same; a longest common subsequence aligns the blocks of both
pages, and shared blocks are marked as template.

What is kept: where a page marks its article (``article``, ``main`` or an
element that names itself content), the blocks inside it, without those in
elements that by tag, role or class are menus, headers, footers, sidebars,
notices, adverts, forms or comments. Elsewhere all blocks of the body but
those and but the shared ones. A form around the body, and an element that has
such a word only as a part of a name (has-sidebar), are doubtful: their blocks
go if they are shared. Elements that hold the page's only article are kept. Shared blocks inside a marked article stay: on
hosts with copies of articles, differencing alone would delete the copied
text (see README for how often).

Pages are compared with two neighbours only, in an order found by a range
partitioning, so a host with a third of all pages is no harder than others.

Defined cases: a null html gives an empty text; a null url or one without host
is a host of its own that is not compared; equal URLs are ordered by page_id
and html; rows repeated in all of them are each reported; an empty table gives
an empty result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import html as html_lib
import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from drivestats.llm.common import map_arrow, written

# Element names.
RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "title", "svg", "math", "object", "canvas", "audio", "video", "select", "datalist"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q",
    "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "br", "wbr", "img",
}
OUTSIDE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "fieldset", "head"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}
# Words in class, id or role that mark what is not the article.
OUTSIDE_WORDS = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor", "sponsored", "promo", "promotion",
    "nav", "navbar", "navigation", "menu", "menubar", "breadcrumb", "breadcrumbs", "pagination", "pager", "toolbar", "tabs",
    "header", "masthead", "footer", "sidebar", "aside", "widget", "complementary", "contentinfo", "search",
    "cookie", "cookies", "consent", "gdpr", "notice", "notification", "alert", "popup", "modal", "overlay", "dialog",
    "newsletter", "subscribe", "subscription", "signup", "login", "signin", "form", "share", "sharing", "social",
    "related", "recommended", "recommendations", "comment", "comments", "discussion", "disqus", "replies", "respond",
}
MAIN_WORDS = {"content", "article", "post", "entry", "story", "main"}
# What an opening tag closes (elements whose end tag may be left out).
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"'=]|=\s*+"[^"]*"|=\s*+'[^']*'|=|["'])*+)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
WORD = re.compile(r"[a-z]+")
#: What a block lies in: 0 the body, 1 an element that names itself content, 2 main, 3 article; -1 what is left out.
#: With ``DOUBTFUL`` added, inside a wrapper that may be left out: differencing decides.
BODY, NAMED, MAIN, ARTICLE, LEFT_OUT, DOUBTFUL = 0, 1, 2, 3, -1, 10


def _place(tag: str, attributes: str, parent: int, holds: bool) -> int:
    """Where blocks in this element lie, given where the element lies and whether it holds the only article and is kept for it."""
    if parent == LEFT_OUT:
        return LEFT_OUT
    words: set[str] = set()
    roles: set[str] = set()
    names: set[str] = set()
    if attributes and "=" in attributes:
        for name, value in ATTRIBUTE.findall(attributes):
            own = set(WORD.findall(value.lower()))
            words |= own
            names.update(v.strip("0123456789_-") for v in value.strip("\"'").lower().split())
            if name.lower() == "role":
                roles |= own
    if tag in ("html", "body"):
        return parent
    base = parent % DOUBTFUL
    marked = tag == "article" or tag == "main" or "main" in roles
    doubtful = False
    if not holds:
        # A header inside an article holds its title; elsewhere it is the site's.
        titled = tag == "header" and base == ARTICLE
        # The body of a page may stand in a form.
        if tag in OUTSIDE and not titled and not (tag == "form" and base == BODY):
            return LEFT_OUT
        if tag not in HEADINGS and not (titled and not words & OUTSIDE_WORDS - {"header"}):
            if names & OUTSIDE_WORDS and not (tag == "form" and base == BODY):
                return LEFT_OUT
            # A part of a name, as in has-sidebar or comment-open, is no more than a hint.
            doubtful = tag == "form" or bool(words & OUTSIDE_WORDS)
    if tag == "article":
        return max(base, ARTICLE)
    if marked:
        return max(base, MAIN)
    if doubtful or parent >= DOUBTFUL:
        return base + DOUBTFUL
    if tag in ("div", "section", "td") and words & MAIN_WORDS:
        return max(parent, NAMED)
    return parent


def blocks_of(page: str) -> list[tuple[int, str]]:
    """(place, text) of the blocks of a page, in page order."""
    blocks, holders = _parsed(page, set())
    # Articles stand in what is left out (comments, teasers) and stay so, but not where the page has no other.
    if holders and not any(place % DOUBTFUL >= MAIN for place, _ in blocks if place != LEFT_OUT):
        blocks, _ = _parsed(page, holders)
    return blocks


def _parsed(page: str, kept: set[int]) -> tuple[list[tuple[int, str]], set[int]]:
    """The blocks, with the elements ``kept`` (by the place of their tag) never left out; and the elements that are or hold articles that are left out."""
    out: list[tuple[int, str]] = []
    holders: set[int] = set()
    stack: list[tuple[str, int]] = []
    opened: list[int] = []
    parts: list[str] = []
    place = BODY

    def flush() -> None:
        if parts:
            text = " ".join(html_lib.unescape("".join(parts)).split())
            if text:
                out.append((place, text))
            parts.clear()

    at, n = 0, len(page)
    while at < n:
        m = TOKEN.search(page, at)
        if m is None:
            parts.append(page[at:])
            break
        if m.start() > at:
            parts.append(page[at : m.start()])
        at = m.end()
        if m.group(2) is None:
            continue
        closing, tag, attributes = m.group(1), m.group(2).lower(), m.group(3)
        if tag in RAW and not closing:
            if not attributes.rstrip().endswith("/") or tag not in ("svg", "math"):
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, at)
                at = end.end() if end else n
            continue
        if tag == "br" or tag == "img":
            parts.append(" ")
            continue
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    if tag not in INLINE or stack[i][1] != (stack[i - 1][1] if i else BODY):
                        flush()
                        del stack[i:], opened[i:]
                        place = stack[-1][1] if stack else BODY
                    else:
                        del stack[i], opened[i]
                    break
                if tag in INLINE and stack[i][0] not in INLINE:
                    break
            continue
        if tag in VOID:
            if tag not in INLINE:
                flush()
            continue
        if tag not in INLINE:
            flush()
            if stack and tag in CLOSES:
                own, scope = CLOSES[tag]
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in scope:
                        break
                    if stack[i][0] in own:
                        del stack[i:], opened[i:]
                        break
            # A paragraph ends, with what is left open in it, where another block starts.
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    del stack[i:], opened[i:]
                    break
                if stack[i][0] not in INLINE:
                    break
            place = stack[-1][1] if stack else BODY
        new = _place(tag, attributes, place, m.start() in kept)
        if new == LEFT_OUT and (tag == "article" or tag == "main" or _place(tag, attributes, BODY, True) == MAIN):
            holders.update(opened, (m.start(),))
        if new != place:
            flush()
        if not attributes.rstrip().endswith("/") or tag not in ("path", "use"):
            stack.append((tag, new))
            opened.append(m.start())
            place = new
    flush()
    return out, holders


def shared_blocks(a: list[int], b: list[int]) -> list[bool]:
    """Which entries of ``a`` a longest common subsequence with ``b`` aligns."""
    n = min(len(a), len(b))
    head = next((i for i in range(n) if a[i] != b[i]), n)
    tail = next((i for i in range(n - head) if a[-1 - i] != b[-1 - i]), n - head)
    marks = [i < head or i >= len(a) - tail for i in range(len(a))]
    places: dict[int, list[int]] = {}
    for j in range(len(b) - tail - 1, head - 1, -1):
        places.setdefault(b[j], []).append(j)
    # Longest increasing run of places: for each length, the smallest place that ends one.
    ends: list[int] = []
    last: list[tuple] = []
    for i in range(head, len(a) - tail):
        for j in places.get(a[i], ()):
            k = bisect_left(ends, j)
            link = (i, last[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                last.append(link)
            else:
                ends[k], last[k] = j, link
    link = last[-1] if last else None
    while link:
        marks[link[0]] = True
        link = link[1]
    return marks


def _block_hash(text: str) -> int:
    import xxhash

    return int.from_bytes(xxhash.xxh3_64_digest(text.encode("utf-8", "surrogatepass")), "little", signed=True)


def _line_rows(batches):
    for b in batches:
        pages = b.column(b.num_columns - 1).to_pylist()
        hashes = [[_block_hash(text) for _, text in blocks_of(p or "")] for p in pages]
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(hashes, pa.list_(pa.int64()))], [*b.schema.names[:-1], "lines"])


def _shared_parts(a: str, b: str) -> int:
    x, y = a.split("/"), b.split("/")
    return next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))


def _template_rows(batches):
    for b in batches:
        marks = []
        for r in b.to_pylist():
            near = []
            for side in ("before", "after"):
                o = r[side]
                if o and o["host"] == r["host"] and o["lines"] != r["lines"]:
                    near.append((-_shared_parts(r["path"], o["path"]), len(near), o["lines"]))
            marks.append(shared_blocks(r["lines"], min(near)[2]) if near else [False] * len(r["lines"]))
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("html_hash"), b.column("url_hash"), pa.array(marks, pa.list_(pa.bool_()))], ["page_id", "html_hash", "url_hash", "shared"])


def main_text(blocks: list[tuple[int, str]], shared: list[bool]) -> str:
    """The article's blocks, joined; ``shared`` marks those of the template."""
    best = max((place % DOUBTFUL for place, _ in blocks if place != LEFT_OUT), default=BODY)
    wanted = {NAMED, MAIN} if best == MAIN else {best}
    out = []
    for (place, text), s in zip(blocks, shared):
        doubted = place >= DOUBTFUL or best == BODY
        if place != LEFT_OUT and place % DOUBTFUL in wanted and not (doubted and s):
            out.append(text)
    return "\n\n".join(out)


def _text_rows(batches):
    for b in batches:
        out: list[list] = [[] for _ in range(4)]
        for page, shared in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
            blocks = blocks_of(page or "")
            shared = shared or [False] * len(blocks)
            text = main_text(blocks, shared)
            for column, v in zip(out, (text, len(text), len(blocks), sum(shared))):
                column.append(v)
        types = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c, t) for c, t in zip(out, types))], ["page_id", "url", "text", "n_chars", "n_blocks", "n_shared_blocks"])


def template_blocks(pages: DataFrame) -> DataFrame:
    """(page_id, html_hash, url_hash, shared): which blocks of each page its nearest neighbour shares."""
    rest = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)(/[^?#]*)?"
    keyed = pages.select(
        "page_id", F.xxhash64("html").alias("html_hash"), F.xxhash64("url").alias("url_hash"),
        F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), rest, 1)).alias("host"), F.regexp_extract(F.coalesce("url", F.lit("")), rest, 2).alias("path"),
        "html",
    )
    schema = "page_id long, html_hash long, url_hash long, host string, path string, lines array<bigint>"
    lines = map_arrow(keyed, _line_rows, schema).where("host != ''").dropDuplicates(["page_id", "html_hash", "url_hash"])
    order = ["host", "path", "page_id", "html_hash", "url_hash"]
    # Rows of one part in order get consecutive numbers; the parts' sizes make them consecutive over all.
    ordered = written(lines.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("id", F.monotonically_increasing_id()), "ordered_pages")
    part, within = F.shiftright("id", 33).alias("part"), F.col("id").bitwiseAND((1 << 33) - 1)
    sizes = ordered.groupBy(part).agg(F.count("*").alias("n"))
    base = sizes.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    placed = ordered.withColumn("part", part).join(F.broadcast(base), "part").withColumn("place", F.col("base") + within).drop("part", "base", "id")
    near = placed.select("place", F.struct("host", "path", "lines").alias("of"))
    joined = (
        placed.join(near.select((F.col("place") + 1).alias("place"), F.col("of").alias("before")), "place", "left")
        .join(near.select((F.col("place") - 1).alias("place"), F.col("of").alias("after")), "place", "left")
    )
    return map_arrow(joined.drop("place"), _template_rows, "page_id long, html_hash long, url_hash long, shared array<boolean>")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, n_blocks, n_shared_blocks) of every row of ``pages`` (page_id, url, html)."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    marks = template_blocks(pages).withColumnsRenamed({"page_id": "of_page", "html_hash": "of_html", "url_hash": "of_url"})
    joined = pages.join(marks, F.expr("page_id <=> of_page AND xxhash64(html) = of_html AND xxhash64(url) = of_url"), "left").select("page_id", "url", "html", "shared")
    return map_arrow(joined, _text_rows, "page_id long, url string, text string, n_chars long, n_blocks long, n_shared_blocks long")
