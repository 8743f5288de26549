"""Main text of web pages: structural rules in a page, and removal of subtrees that a host repeats.

Pages are parsed twice.  The first pass hashes every block element that the
structural rules leave, and Spark counts for each host and hash on how many
pages of different main text it occurs.  The second pass deletes subtrees that
recur on many pages of the host and joins what is left to text.  Copies of one
page count once, so a copied article is no template of its host.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from zstandard import ZstdCompressor, ZstdDecompressor

from quotewell.llm.common import in_slices, stored

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|textarea|title|noscript|iframe|template|xmp|noembed|noframes)\b(?P<in>[^>]*)>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|</(?P<end>[a-z][^\s/>]*)[^>]*>"
    r"|<(?P<tag>[a-z][^\s/>]*)(?P<attributes>(?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<loose>[a-z][^\s/>]*)[^>]*>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
#: Start tags that end an open paragraph.
ENDS_P = frozenset(
    "address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul".split()
)
#: Start tags that end an open element of one of the kinds named, up to the container named.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
DROPPED = frozenset(
    "head nav footer aside form button select input svg canvas object embed audio video dialog menu math map".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split()
)
#: Words of class names and ids of what isn't article text, anywhere, and outside of the article only.
NOT_TEXT = frozenset(
    "nav navbar navigation menu submenu footer sidebar ad ads adv advert adverts advertisement advertising adsense sponsor "
    "sponsored promo promoted promotion cookie cookies consent gdpr notice notices notification popup modal overlay "
    "newsletter subscribe subscription signup paywall comment comments commentlist reply replies disqus respond "
    "discussion share sharing social related recommended recommendations trending breadcrumb breadcrumbs pagination "
    "pager toolbar widget widgets login".split()
)
OUTSIDE = NOT_TEXT | frozenset("header masthead topbar banner alert search side skip".split())
ROOTS = frozenset("html body main".split())
#: Pages and share of a host's pages that make a template, what links and blocks count beside words, and weights; see site_templates.
FEW, MANY, SHARE, INSIDE = 5, 20, 0.3, 0.05
STRUCTURE, SMALL, LARGE = 3, 3, 10


class Element:
    __slots__ = ("attributes", "children", "parent", "tag")

    def __init__(self, tag: str, parent: Element | None, attributes: str = "") -> None:
        self.tag, self.parent, self.attributes, self.children = tag, parent, attributes, []


def parse(html: str) -> Element:
    """Tree of elements and text; raw elements, comments and declarations are left out."""
    root = top = Element("#page", None)
    for m in TOKEN.finditer(html):
        kind = m.lastgroup
        if kind == "text":
            top.children.append(unescape(m["text"]) if "&" in m["text"] else m["text"])
            continue
        if m["end"]:
            name, at = m["end"].lower(), top
            while at is not root and at.tag != name:
                at = at.parent
            if at is not root:
                top = at.parent
            elif name == "br":
                top.children.append(" ")
            continue
        name = (m["tag"] or m["loose"] or "").lower()
        if not name:
            continue
        if name == "br":
            top.children.append(" ")
            continue
        if name in ENDS_P:
            at = top
            while at.tag in INLINE:
                at = at.parent
            if at.tag == "p":
                top = at.parent
        if name in ENDS:
            same, within = ENDS[name]
            at = top
            while at is not root and at.tag not in within:
                if at.tag in same:
                    top = at.parent
                at = at.parent
        element = Element(name, top, m["attributes"] or "")
        top.children.append(element)
        if name not in VOID and not (m["attributes"] or "").endswith("/") or name in ("p", "div"):
            top = element
    return root


def unwanted(element: Element, inside: bool) -> bool:
    """Whether tag, role, class or id say that it isn't article text; ``inside``: within an article."""
    tag = element.tag
    if tag in DROPPED or tag == "header" and not inside:
        return True
    if not element.attributes or tag in ROOTS:
        return False
    for name, *values in ATTRIBUTE.findall(element.attributes):
        name, value = name.lower(), next(filter(None, values), "")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
        if name == "role" and value.lower() in ROLES:
            return True
        if name in ("class", "id"):
            words = {w.lower() for w in PART.findall(value)}
            if not words.isdisjoint(NOT_TEXT if inside or tag == "article" else OUTSIDE):
                return True
    return False


def roots(page: Element) -> list[Element]:
    """The outermost articles; without one, the main part; else the page."""
    found: dict[str, list[Element]] = {"article": [], "main": []}
    stack = [page]
    while stack:
        element = stack.pop()
        if element is not page and unwanted(element, False):
            continue
        if element.tag == "article":
            found["article"].append(element)
            continue
        if element.tag == "main" or re.search(r"role\s*=\s*[\"']?main\b", element.attributes, re.I):
            found["main"].append(element)
        stack += [c for c in reversed(element.children) if isinstance(c, Element)]
    return found["article"] or found["main"][:1] or [page]


def digest(*parts: str | int) -> int:
    return int.from_bytes(blake2b("\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def walk(html: str, templates: frozenset[int] | set[int], hashes: dict[int, tuple[bool, int, int]] | None) -> list[str]:
    """Blocks of the page's text without ``templates``; puts the hashes of kept block elements into ``hashes``.

    A hash maps to whether it lies within an article, its weight (words, and
    STRUCTURE for each link or block in it) and its words.  Iterative, since
    pages may nest deeply.
    """
    blocks: list[str] = []
    page = parse(html)
    for root in roots(page):
        own: list[str] = []

        def flush() -> None:
            if text := " ".join("".join(own).split()):
                blocks.append(text)
            own.clear()

        inside = root.tag == "article"
        frames: list[tuple[Element, Iterator, list, list[int]]] = [(root, iter(root.children), [], [0, 0])]
        marks: list[tuple[int, list[str]]] = [(0, [])]
        while frames:
            element, children, inner, (weight, words) = frames[-1]
            child = next(children, None)
            if child is None:
                frames.pop()
                mark, before = marks.pop()
                block = element.tag not in INLINE
                if block:
                    flush()
                if block or frames:
                    h = digest(element.tag, *inner)
                    if frames:
                        frames[-1][2].append(h)
                        outer = frames[-1][3]
                        outer[0] += weight + (STRUCTURE if block or element.tag == "a" else 0)
                        outer[1] += words
                    if block and element is not root and inner:
                        if h in templates:
                            del blocks[mark:]
                        elif hashes is not None:
                            hashes[h] = (inside or h in hashes and hashes[h][0], weight, words)
            elif isinstance(child, str):
                own.append(child)
                if text := " ".join(child.split()):
                    inner.append(text)
                    n = text.count(" ") + 1
                    frames[-1][3][0] += n
                    frames[-1][3][1] += n
            elif not unwanted(child, inside):
                if child.tag not in INLINE:
                    flush()
                frames.append((child, iter(child.children), [], [0, 0]))
                marks.append((len(blocks), []))
        flush()
    return blocks


def subtrees_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, host, html) to (key, host, main-text hash, hashes of block elements, what each is).

    That is its weight, at most LARGE, negative within an article; 100 more (or
    less) if it holds over half of the page's words.
    """
    for batch in in_slices(batches, 256):
        mains, lists, kinds = [], [], []
        for html in batch.column(2).to_pylist():
            found: dict[int, tuple[bool, int, int]] = {}
            blocks = walk(html, frozenset(), found)
            mains.append(digest(*blocks))
            half = sum(b.count(" ") + 1 for b in blocks) / 2
            lists.append(list(found))
            kinds.append([(min(weight, LARGE) + (100 if words > half else 0)) * (-1 if inside else 1) for inside, weight, words in found.values()])
        columns = [pa.array(mains, pa.int64()), pa.array(lists, pa.list_(pa.int64())), pa.array(kinds, pa.list_(pa.int8()))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["key", "host", "main", "hashes", "kinds"])


def squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, page_id, url, html) with the html compressed, for the shuffle."""
    packer = ZstdCompressor(level=6)
    for batch in in_slices(batches, 256):
        packed = [packer.compress(html.encode("utf-8", "surrogatepass")) for html in batch.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(packed, pa.binary())], names=["key", "page_id", "url", "packed"])


def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(page_id, url, packed html, templates) to (page_id, url, text)."""
    unpacker = ZstdDecompressor()
    for batch in in_slices(batches, 256):
        rows = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
        out = [" ".join(walk(unpacker.decompress(html).decode("utf-8", "surrogatepass"), frozenset(gone or ()), None)) for html, gone in rows]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], names=["page_id", "url", "text"])


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))


def site_templates(subtrees: DataFrame) -> DataFrame:
    """(host, hash) of block elements that recur on many pages of their host; pages of equal main text count once.

    Outside of articles: on MANY pages, however large the host, or on FEW that
    are SHARE of its pages; a block with over half of the words on most of its
    pages may be an article under changing surroundings and needs the share.
    Within an article: on MANY pages that are INSIDE of the host's, and with a
    weight below LARGE on SHARE of them; with a weight below SMALL never, since
    short lines recur in articles by themselves.
    """
    pages = subtrees.groupBy("host", "main").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("*").alias("pages"))
    seen = (
        subtrees.select("host", "main", F.explode(F.arrays_zip("hashes", "kinds")).alias("x"))
        .select("host", "main", F.col("x.hashes").alias("hash"), F.col("x.kinds").alias("kind"))
        .groupBy("host", "hash", "main")
        .agg(F.min("kind").alias("kind"))
        .groupBy("host", "hash")
        .agg(F.count("*").alias("n"), F.min("kind").alias("kind"), F.count_if(F.abs("kind") >= 100).alias("wide"))
        .where(F.col("n") >= FEW)
    )
    n, weight, share = F.col("n"), F.abs("kind") % 100, F.col("n") >= SHARE * F.col("pages")
    inside = (n >= MANY) & ((weight >= LARGE) & (n >= INSIDE * F.col("pages")) | (weight >= SMALL) & share)
    outside = share | (n >= MANY) & (2 * F.col("wide") <= n)
    return seen.join(pages, "host").where(F.when(F.col("kind") < 0, inside).otherwise(outside)).select("host", "hash")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) for each row of ``pages`` (page_id, url, html).

    Null and empty html give an empty text; a null url belongs to the host
    without a name; repeated rows are one page and extracted alike; tags that are not closed
    or not opened are closed or passed over as browsers do.  Other columns are
    left behind.  Blocks outside of articles, and larger ones within, go if
    many pages of the host have them (see ``site_templates``), so a block of ten
    words that authors repeat in a twentieth of a host's articles is lost as well.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", host_of(F.col("url")).alias("host"), F.coalesce("html", F.lit("")).alias("html")
    )
    rows = rows.withColumn("key", F.md5(F.concat_ws("\x00", F.coalesce(F.col("page_id").cast("string"), F.lit("")), "url", "html").cast("binary")))
    rows = rows.withColumn("key", F.unhex("key"))
    subtrees = stored(
        rows.select("key", "host", "html").mapInArrow(
            subtrees_of, "key binary, host string, main long, hashes array<long>, kinds array<tinyint>"
        ),
        "subtrees",
    )
    gone = (
        subtrees.select("key", "host", F.explode("hashes").alias("hash"))
        .join(site_templates(subtrees), ["host", "hash"])
        .groupBy("key")
        .agg(F.collect_set("hash").alias("templates"))
    )
    packed = rows.select("key", "page_id", "url", "html").mapInArrow(squeezed, "key binary, page_id long, url string, packed binary")
    return (
        packed.join(gone.hint("merge"), "key", "left")
        .select("page_id", "url", "packed", "templates")
        .mapInArrow(extracted, "page_id long, url string, text string")
    )
