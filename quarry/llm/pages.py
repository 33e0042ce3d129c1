"""Main text of web pages by removal of each site's own template.

Every element of a page has a subtree hash: of its tag, its class and id names,
its text and its children (``_signature``); of a subtree that is mostly links
(a menu) the text is left out, as menus change their labels more than their
shape. Spark counts per host on how many different pages each hash stands. A
subtree that recurs on many pages of its host (``recurring``) belongs to the
site, not to the page, and is deleted before the page is read.

Two more rules settle what counting cannot see: on a host with a handful of
pages nothing recurs, and a notice may say something else on every page. Tags
and class names that declare an element to be no content (``SKIPPED``,
``NAMED``) remove it too, and where a page marks its content (``article``, then
``main``), that is what is read. Inside the marked content a recurring prose
block (paragraph, heading, list item, quotation, ...) stays: copies of articles
repeat their paragraphs, and those are content.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from hashlib import blake2b

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

MIN_PAGES = 5      # a subtree recurs if it stands on that many different pages of its host
SHARE = 0.1        # ... and on that share of them
LINKED = 0.6       # share of a subtree's text in links that makes it a menu

#: Elements without end tag (HTML standard; fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is not parsed as markup.
RAW = "script|style|noscript|template|textarea|title|iframe|noembed|noframes|xmp"
#: Elements that start a new block of text.
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                  "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p "
                  "pre search section summary table tbody tfoot thead tr ul".split())
#: Prose blocks: kept inside marked content even if they recur.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt ul ol dl table tbody thead tfoot tr td th figure "
                  "figcaption caption".split())
#: Elements that are never content.
SKIPPED = frozenset("nav footer aside form button select option datalist menu dialog head object audio video canvas "
                    "map label input svg math".split())
#: Words of class, id and role names that declare an element to be no content.
NAMED = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promoted banner "
                  "banners nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars aside masthead "
                  "footer cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
                  "subscription signup login comment comments commentlist disqus respond replies reply share sharing "
                  "social related recommended recommendations widget widgets pagination pager toolbar complementary "
                  "contentinfo search searchbox form".split())
#: Open elements that a start tag closes, within the given limits.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody", "tfoot"),
          "tfoot": ("tr", "td", "th", "thead", "tbody"), "thead": ("tr", "td", "th", "tbody")}
LIMITS = frozenset("ul ol menu dl table body article main section div aside nav header footer form html".split())

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^<>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>\"']++|\"[^\"]*\"|'[^']*'){0,1000}+|[^<>]*)>"
    r"|<[!?/][^>]*(?:>|\Z)", re.S | re.I)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
DEEPEST = 512      # open elements; deeper ones lie side by side, as in browsers
WORD = re.compile(r"[a-z]+")
DIGITS = re.compile(r"\d+")


class Element:
    __slots__ = ("tag", "names", "parts", "parent", "main", "prose", "sign", "n_text", "n_linked", "depth")

    def __init__(self, tag: str, names: str, parent: "Element | None"):
        self.tag, self.names, self.parent = tag, names, parent
        self.parts: list = []           # texts and elements, in page order
        self.main = tag in ("article", "main") or bool(parent and parent.main)
        self.prose = bool(parent and parent.main) and tag in PROSE
        self.sign = None
        self.depth = parent.depth + 1 if parent else 0


def parse(page: str) -> Element:
    """Element tree of a page. End tags that are left out or misplaced are
    handled as browsers do in the common cases; never fails."""
    root = top = Element("", "", None)
    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            top.parts.append(page[at:m.start()])
        at = m.end()
        tag = m.group(3)
        if tag is None:
            continue
        tag = tag.lower()
        if m.group(2):
            top = _end(top, tag)
            continue
        attributes = m.group(4)
        if tag == "p" or tag in BLOCK:
            top = _close(top, ("p",))
        if tag in CLOSES:
            top = _close(top, CLOSES[tag])
        child = Element(tag, _names(attributes) if "=" in attributes else "", top)
        top.parts.append(child)
        empty = tag in VOID or attributes.endswith("/") and tag not in BLOCK
        if child.depth < DEEPEST and not empty:
            top = child
    if at < len(page):
        top.parts.append(page[at:])
    return root


def _names(attributes: str) -> str:
    found = sorted((k.lower(), a or b or c) for k, a, b, c in ATTRIBUTE.findall(attributes))
    return " ".join(f"{k}={v}" for k, v in found).lower()


def _close(top: Element, tags: tuple[str, ...]) -> Element:
    """The parent of the outermost open element among ``tags``, looked for up to
    the nearest limit; ``top`` if there is none."""
    e, found = top, None
    while e.parent is not None and e.tag not in LIMITS:
        if e.tag in tags:
            found = e
        e = e.parent
    if e.parent is not None and e.tag in tags:
        found = e
    return top if found is None else found.parent


def _end(top: Element, tag: str) -> Element:
    """Where text goes on after an end tag: a block's end tag closes what is open
    in it, an inline one closes nothing across a block; unmatched ones nothing."""
    e = top
    while e.parent is not None:
        if e.tag == tag:
            return e.parent
        if tag not in BLOCK and e.tag in BLOCK:
            return top
        e = e.parent
    return top


def _walk(root: Element) -> list[Element]:
    """All elements in page order, parents first (no recursion: nesting may be deep)."""
    order, stack = [], [root]
    while stack:
        e = stack.pop()
        order.append(e)
        stack.extend(x for x in reversed(e.parts) if type(x) is Element)
    return order


def declared(e: Element) -> bool:
    """Tag, class, id or role says that the element is no content."""
    if e.tag in SKIPPED:
        return True
    if e.tag == "header":
        return not (e.parent and e.parent.main)
    if not e.names or e.tag in ("html", "body", "article", "main"):
        return False
    return any(w in NAMED for k in e.names.split() if not k.startswith("itemprop") for w in WORD.findall(k.split("=", 1)[-1]))


def sign(root: Element) -> list[Element]:
    """Sets every element's subtree hash and text sizes; returns the elements."""
    order = _walk(root)
    for e in reversed(order):
        kids, own, n_text, n_linked = [], [], 0, 0
        for x in e.parts:
            if type(x) is Element:
                kids.append(x.sign)
                n_text += x.n_text
                n_linked += x.n_text if x.tag == "a" else x.n_linked
            else:
                t = " ".join(x.split())
                if t:
                    own.append(t)
                    n_text += len(t)
        e.n_text, e.n_linked = n_text, n_linked
        e.sign = _signature(e, own, kids)
    return order


def _signature(e: Element, own: list[str], kids: list[bytes]) -> bytes:
    menu = e.tag == "a" or e.n_linked >= LINKED * e.n_text > 0
    if menu:    # shape alone; equal neighbours count once
        own, kids = [], [k for i, k in enumerate(kids) if i == 0 or k != kids[i - 1]]
    head = DIGITS.sub("0", "\x00".join([e.tag, e.names, *own]))
    return blake2b(head.encode("utf-8", "replace") + b"\x00".join(kids), digest_size=8).digest()


def _number(sign_: bytes) -> int:
    return int.from_bytes(sign_, "big", signed=True)


def subtree_hashes(page: str) -> tuple[int, set[int]]:
    """(hash of the page as it is, hashes of its subtrees with text that could be template)."""
    root = parse(page)
    order = sign(root)
    whole = blake2b(page.encode("utf-8", "replace"), digest_size=8).digest()
    return _number(whole), {_number(e.sign) for e in order if e.tag in BLOCK and e.n_text and not e.prose
                                and e.tag not in ("html", "body", "article", "main", "head")}


def extract(page: str, template: frozenset[int] | set[int] = frozenset()) -> str:
    """Main text of a page: blocks in page order, joined by a line feed.
    ``template``: subtree hashes of the page's host that are to go."""
    root = parse(page)
    order = sign(root) if template else _walk(root)
    marked: dict[str, list[Element]] = {"article": [], "main": []}
    for e in order:
        if e.tag in marked or "itemprop=articlebody" in e.names or "role=main" in e.names:
            marked[e.tag if e.tag in marked else "main"].append(e)
    for tops in (marked["article"], marked["main"], [root]):
        blocks: list[str] = []
        taken: set[int] = set()
        for e in tops:
            if not _inside(e, taken) and not _dropped_above(e, template):
                taken.add(id(e))
                _blocks(e, template, blocks)
        if blocks:
            return "\n".join(blocks)
    return ""


def _inside(e: Element, taken: set[int]) -> bool:
    while e is not None:
        if id(e) in taken:
            return True
        e = e.parent
    return False


def _gone(e: Element, template) -> bool:
    if declared(e):
        return True
    return bool(template) and not e.prose and e.tag in BLOCK and e.tag not in ("html", "body", "article", "main") \
        and _number(e.sign) in template


def _dropped_above(e: Element, template) -> bool:
    while e is not None:
        if _gone(e, template):
            return True
        e = e.parent
    return False


def _blocks(top: Element, template, out: list[str]) -> None:
    text: list[str] = []

    def flush() -> None:
        if text:
            block = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if block:
                out.append(block)

    stack: list = [(top, iter(top.parts))]
    while stack:
        e, parts = stack[-1]
        for x in parts:
            if type(x) is str:
                text.append(x)
            elif _gone(x, template):
                text.append(" ")
            else:
                if x.tag in BLOCK:
                    flush()
                elif x.tag in ("br", "td", "th", "img"):
                    text.append(" ")
                stack.append((x, iter(x.parts)))
                break
        else:
            stack.pop()
            if e.tag in BLOCK or not stack:
                flush()


def host_of(url: Column) -> Column:
    """Lower-case host name of a URL, without user and port; null if there is none."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#]*)", 1)), F.lit(""))


def _source(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    url = F.col(f"`{url_col}`")
    return pages.select(F.col(f"`{id_col}`").alias("page_id"), url.alias("url"), host_of(url).alias("host"),
                        F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("html"))


def subtree_rows(src: DataFrame) -> DataFrame:
    """(host, page, hash): the candidate subtrees of every page, and one row with
    a null hash per page, by which a host's pages are counted."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            hosts, pages, hashes = [], [], []
            for h, t in zip(b.column(0), b.column(1)):
                page, found = subtree_hashes(t.as_py())
                n = len(found) + 1
                hosts += [h.as_py()] * n
                pages += [page] * n
                hashes += [None, *found]
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(pages, pa.int64()),
                                              pa.array(hashes, pa.int64())], ["host", "page", "hash"])

    return src.filter("host IS NOT NULL").select("host", "html").mapInArrow(run, "host string, page long, hash long")


def recurring(src: DataFrame, min_pages: int = MIN_PAGES, share: float = SHARE) -> DataFrame:
    """(host, hashes): subtrees on at least ``min_pages`` different pages and at
    least ``share`` of the different pages of their host. Equal pages count once.

    The distinct rows are spread by (host, hash, page), then counted within tasks
    before the second shuffle, so that a hot host is no hot task. A host's list
    has at most 1 / share times the mean number of subtrees of its pages.
    """
    counts = subtree_rows(src).distinct().groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n"))
    counts = materialise(counts.filter((F.col("n") >= min_pages) | F.col("hash").isNull()), "subtree-counts")
    totals = counts.filter("hash IS NULL").select("host", F.col("n").alias("pages"))
    often = counts.filter("hash IS NOT NULL").join(totals, "host").filter(F.col("n") >= share * F.col("pages"))
    return often.groupBy("host").agg(F.collect_set("hash").alias("hashes"))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  min_pages: int = MIN_PAGES, share: float = SHARE) -> DataFrame:
    """page_id, url, text, n_chars; one row per input row.

    A null page counts as empty and has the empty text; a null URL or one without
    host has no template to be removed by count; repeated rows count as one page
    and are each returned; unclosed and misplaced tags are read as browsers do;
    an empty table gives an empty result; other columns are not read.
    """
    src = _source(pages, id_col, url_col, html_col)
    template = recurring(src, min_pages, share)
    # read back from a table, so that Spark knows the size of the lists: few hosts are broadcast (under the session's
    # threshold), many are joined by host, and AQE then splits a hot host, whose short list goes to each part
    joined = src.join(materialise(template, "site-templates"), "host", "left").select("page_id", "url", "html", "hashes")
    kind = src.schema["page_id"].dataType.simpleString()
    schema = f"page_id {kind}, url string, text string, n_chars long"

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            texts = [extract(t.as_py(), frozenset(h.as_py() or ())) for t, h in zip(b.column(2), b.column(3))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, schema)
