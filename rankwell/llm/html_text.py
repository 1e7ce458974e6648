"""Main text of web pages: site templates found by recurring element subtrees, then removed.

1. Every page is parsed once into elements; an element's subtree hash covers its tag, class, id, texts and
   children. Spark counts, per host, the pages with different content that have a subtree (container
   elements only), combined before the shuffle.
2. Subtrees on at least ``SHARE`` of a host's pages, and at least ``MIN_PAGES``, are its template. Their number
   per host is at most the mean number of containers of a page divided by ``SHARE``.
3. Pages get the template of their host (hosts with very many pages by broadcast, see ``frames.attach``; pages
   travel compressed), are parsed again, and lose the template subtrees, then elements whose tag or role says
   menu, header, footer, sidebar, notice, advert, form, script, style or reader comments, and containers of which a
   class or an id says so. A class or an id says so if it is made of such words and of words for places and shapes alone
   (``site-footer``, ``comment-list``); one with other words in it (``share-price``, ``legal-history``) only counts if
   at least half of the container's characters are links. What is left of the outermost ``article`` or ``main``
   elements, or of the whole page if there is none, is the text.

Paragraphs, headings and other text elements are never template and have no telling names: an article that a host publishes many times
is still an article. Copies of one page count once.

Character references are decoded, white space inside a block becomes one space, blocks are trimmed and joined
in page order by one space; line breaks are white space, inline elements add none. The parser copes with
unclosed and stray tags and is linear and free of recursion, for pages of any length and depth.

Defined cases: null html gives an empty text; a null url is the host ''; null page ids and repeated rows are
returned row by row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import re

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwell.llm.frames import attach, cut_lineage, map_batches, read

SHARE = 0.5
MIN_PAGES = 5

#: Names of HTML elements and attributes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code del dfn em font i ins kbd label mark q s samp small span strike strong sub "
                   "sup time tt u var".split())
CONTAINER = frozenset("div section aside nav form footer header ul ol dl table menu dialog figure details center".split())
DROP_TAGS = frozenset("head nav footer aside form button select option dialog menu object canvas audio video".split()) | RAW
DROP_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
DROP_WORDS = frozenset("nav navbar navigation menu sidebar footer header masthead banner cookie cookies consent notice gdpr ad ads advert adverts "
                       "advertisement advertising sponsor sponsored promo promotion popup modal overlay newsletter subscribe subscription share sharing "
                       "social breadcrumb breadcrumbs comment comments reply replies disqus related recommended widget login signup search "
                       "pagination pager toolbar skip copyright legal".split())
PLACE_WORDS = frozenset("site page main top bottom left right center box list wrap wrapper container section block bar area inner outer item items content "
                        "buttons button links link form global primary secondary tertiary post article user reader module group row col column text body title "
                        "icon icons region panel zone slot unit view js the and of to a b c d e f g h i j k l m n o p q r s t u v w x y z".split())
ARTICLE_WORDS = frozenset("comment comments reply replies related promo ad ads advert sponsored teaser".split())
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre hgroup figcaption caption summary address li dt dd td th tr".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
             "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>|</([a-zA-Z][^\s/>]*+)[^>]*+>"
    r"|<([a-zA-Z][^\s/>]*+)([^\"'>]*+(?:\"[^\"]*+\"[^\"'>]*+|'[^']*+'[^\"'>]*+)*+)>", re.S)
ATTRIBUTE = re.compile(r"(class|id|role)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))", re.I)
BREAK = "\0"  # a block's edge; U+0000 in a page is no character of its text


class _Element:
    __slots__ = ("tag", "drop", "hash", "content", "mains", "inside", "maybe", "chars", "linked")

    def __init__(self, tag: str, attributes: str, inside: bool, hashed: bool):
        self.tag, self.inside, self.drop = tag, inside or tag in ("article", "main"), tag in DROP_TAGS
        found = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attributes)} if attributes else {}
        self.maybe, self.chars, self.linked = False, 0, 0
        if found and tag not in ("html", "body"):
            names = [set(re.findall(r"[a-z]+", name)) for name in f"{found.get('class', '')} {found.get('id', '')}".lower().split()]
            role = found.get("role", "").lower()
            if role == "main":
                self.inside = True
            elif tag == "article":
                self.drop = any(n & ARTICLE_WORDS and n <= ARTICLE_WORDS | PLACE_WORDS for n in names)
            elif tag != "main":
                self.drop = self.drop or role in DROP_ROLES
                if tag not in TEXT_TAGS:
                    telling = DROP_WORDS - {"header"} if inside else DROP_WORDS
                    self.drop = self.drop or any(n & telling and n <= DROP_WORDS | PLACE_WORDS for n in names)
                    self.maybe = any(n & telling for n in names)
        if tag == "header" and not inside:
            self.drop = True
        self.hash = hashlib.blake2b(f"{tag} {found.get('class', '')} {found.get('id', '')}\0".encode(errors="replace"), digest_size=8) if hashed else None
        self.content: list[str] = []
        self.mains: list[list[str]] = []


def parse(page: str, template: frozenset[int] = frozenset(), hashed: bool = True) -> tuple[list[str], list[int]]:
    """The page's text pieces (with BREAK between blocks) and the subtree hashes of its containers."""
    root = _Element("", "", False, hashed)
    stack, subtrees = [root], []

    def close() -> None:
        e = stack.pop()
        parent = stack[-1]
        parent.chars += e.chars
        parent.linked += e.chars if e.tag == "a" else e.linked
        if e.maybe and 2 * e.linked >= e.chars:
            e.drop = True
        if e.hash is not None:
            digest = e.hash.digest()
            parent.hash.update(digest)
            if e.tag in CONTAINER:
                subtree = int.from_bytes(digest, "little", signed=True)
                subtrees.append(subtree)
                e.drop = e.drop or subtree in template
        if e.drop:
            if e.tag not in INLINE:
                parent.content.append(BREAK)
            return
        if e.tag in INLINE:
            parent.content += e.content
            parent.mains += e.mains
            return
        if e.inside and not parent.inside:
            e.mains = [e.content]
        parent.content.append(BREAK)
        parent.content += e.content
        parent.content.append(BREAK)
        parent.mains += e.mains

    def text(piece: str) -> None:
        if piece:
            stack[-1].content.append(piece)
            stack[-1].chars += len(piece.strip())
            if stack[-1].hash is not None and (words := " ".join(piece.split())):
                stack[-1].hash.update(words.encode(errors="replace"))

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at:m.start()])
        at = m.end()
        if (tag := m[2]) is not None:
            tag = tag.lower()
            if tag == "br":
                stack[-1].content.append(" ")
                continue
            if tag in VOID:
                if tag == "hr":
                    stack[-1].content.append(BREAK)
                continue
            if tag not in INLINE:
                closes = CLOSED_BY.get(tag, {"p"} if tag not in RAW else ())
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in closes:
                        while len(stack) > i:
                            close()
                        if tag not in ("tr", "tbody"):
                            break
                    elif stack[i].tag not in INLINE and stack[i].tag != "p":
                        break
            stack.append(_Element(tag, m[3], stack[-1].inside, hashed))
            if tag in RAW:
                shut = re.compile(f"</{tag}[^>]*+>", re.I).search(page, at)
                if stack[-1].hash is not None:
                    stack[-1].hash.update(page[at:shut.start() if shut else end].encode(errors="replace"))
                at = shut.end() if shut else end
                close()
            elif m[3].endswith("/") and tag not in INLINE and tag not in CONTAINER and tag not in ("p", "article", "main", "body", "html"):
                close()
        elif (tag := m[1]) is not None:
            tag = tag.lower()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    while len(stack) > i:
                        close()
                    break
                if tag in INLINE and stack[i].tag not in INLINE:
                    break
    while len(stack) > 1:
        close()
    pieces = root.content
    if root.mains:
        pieces = [x for main in root.mains for x in (*main, BREAK)]
    return pieces, subtrees


def main_text(page: str | None, template: frozenset[int] = frozenset()) -> str:
    if not page:
        return ""
    pieces, _ = parse(page.replace(BREAK, ""), template, bool(template))
    blocks = "".join(pieces).split(BREAK)
    return " ".join(b for b in (" ".join(html.unescape(x).split()) for x in blocks) if b)


def _containers(batch: pa.RecordBatch):
    hosts, pages, trees = [], [], []
    for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        _, subtrees = parse((page or "").replace(BREAK, ""))
        digest = int.from_bytes(hashlib.blake2b((page or "").encode(errors="replace"), digest_size=8).digest(), "little", signed=True)
        for tree in set(subtrees) or {0}:
            hosts.append(host)
            pages.append(digest)
            trees.append(tree if subtrees else None)
    yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(pages, pa.int64()), pa.array(trees, pa.int64())],
                                     names=["host", "page", "tree"])


def _pack(batch: pa.RecordBatch):
    z = zstandard.ZstdCompressor(level=1)
    packed = [None if t is None else z.compress(t.encode(errors="replace")) for t in batch.column(3).to_pylist()]
    yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(packed, pa.binary())], names=["page_id", "url", "host", "packed"])


def _extract(batch: pa.RecordBatch):
    z = zstandard.ZstdDecompressor()
    texts = [main_text(None if packed is None else z.decompress(packed).decode(), frozenset(template or ()))
             for packed, template in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())]
    yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def site_templates(pages: DataFrame) -> DataFrame:
    """host, template (subtree hashes), n (the host's rows in ``pages``) for ``pages`` (host, html)."""
    seen = map_batches(pages.select("host", "html"), _containers, "host string, page long, tree long").groupBy("host", "page", "tree").agg(
        F.count(F.lit(1)).alias("rows"))
    seen = cut_lineage(seen)
    sizes = cut_lineage(seen.groupBy("host", "page").agg(F.max("rows").alias("rows")).groupBy("host").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("rows").alias("n")))
    often = cut_lineage(seen.filter("tree is not null").groupBy("host", "tree").agg(F.count(F.lit(1)).alias("on")).filter(F.col("on") >= MIN_PAGES))
    weighed = sizes.join(often.groupBy("host").agg(F.count(F.lit(1)).alias("trees")), "host").select("host", "pages", "trees")
    kept = attach(often, weighed, "host", "trees", often.count()).filter(F.col("on") >= SHARE * F.col("pages"))
    found = kept.groupBy("host").agg(F.collect_list("tree").alias("template"))
    return cut_lineage(sizes.select("host", "n").join(found, "host", "left"))


def html_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row of ``pages``: page_id, url, text, n_chars."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host.alias("host"), F.col(html_col).alias("html"))
    templates = site_templates(rows)
    kind = pages.schema[id_col].dataType.simpleString()
    packed = map_batches(rows, _pack, f"page_id {kind}, url string, host string, packed binary")
    total = templates.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    out = map_batches(attach(packed, templates, "host", "n", total), _extract, f"page_id {kind}, url string, text string")
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_html_text(spark, sf_dir: str) -> DataFrame:
    return html_text(read(spark, sf_dir, "pages"))
