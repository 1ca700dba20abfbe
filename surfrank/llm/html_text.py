"""Main text of web pages by a site style tree.

The DOMs of a site (the pages of one host) are merged into one tree.  A node of
that tree is a path of presentations (element name, classes, id and role, digits
as ``#``) from the root; equal siblings fall on one node.  Over the m pages that
have a node,

* its presentation importance is the entropy, to base m, of the sequences of
  children it is seen with (runs of one presentation count once): a template
  always lays a node out alike;
* its content importance is 1 - the mean entropy, to base m, of the texts directly
  in it over the pages: a text on every page has 0, a text on one page 1;
* its importance is ``(1 - g^l) * presentation + g^l * content``, l the number of
  its layouts, g = 0.9.

A branch of a page is removed when its importance and that of all nodes below are
under ``LOW``.  Statistics need ``MIN_PAGES`` pages; copies of a page, which show
by their longest block, count as one page.  Some presentations declare themselves
as boilerplate and have importance 0 whatever the statistics: menus, footers,
sidebars, forms, scripts and so on by element, and by words in class, id or role
(``NOISE``).  The main text is what is left of the page's articles, else of its
main element, else of the body; outside articles a list of nothing but links is a
menu.  An article that the statistics would rob of more than half of its text
keeps it, and so does a page without an article that they would empty.

Work: one pass emits a row for each node, layout and text of a page (hashes),
Spark aggregates them by site and node, and only the nodes that a page loses by
statistics travel back to the page, as a written table joined by the page's
128-bit hash.  No task holds a site; a page is parsed on its own, in time linear in
its length, with a stack instead of recursion.

Cases: null or empty html, or a page without main text, gives ''; a null url is a
site of its own; repeated rows give repeated results; broken markup is read as
browsers do for optional end tags, unclosed elements end with their parents; an
empty table gives an empty result; other columns, whatever their names, are not
read.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, ship

LOW = 0.5
MIN_PAGES = 8
DECAY = 0.9
#: Pages that a worker hands on at once.
PAGES = 256
#: Presentations that a worker remembers.
KNOWN = 1 << 15

# Fixed values of HTML: elements without content, with text only, and those that start or end a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select "
    "summary table tbody tfoot thead title tr ul".split()
)
# Fixed values of HTML: open elements that a start tag ends, and where the search for them stops.
ENDS_P = BLOCKS - frozenset("body caption dd dt html legend li optgroup option select summary tbody tfoot thead title tr".split())
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "body": ({"head"}, {"html"}),
}
CLOSED_IN = frozenset(("article", "aside", "blockquote", "button", "div", "footer", "header", "main", "nav", "section", "table", "td", "th"))

# Presentations that declare themselves as something other than the main text.
NOISE_TAGS = frozenset(
    "aside audio button canvas dialog embed footer form head iframe input map math menu nav noembed noframes noscript object "
    "script search select style svg template textarea video".split()
)
NOISE = frozenset(
    "ad ads adsense advert advertisement advertisements advertising adverts alert banner breadcrumb breadcrumbs captcha comment "
    "commentlist comments complementary consent contentinfo cookie cookies copyright dialog disclaimer discussion disqus dropdown "
    "feedback footer form gdpr login masthead menu menubar modal nav navbar navigation newsletter notice notices notification "
    "notifications offcanvas overlay pager pagination paywall popup privacy promo promoted promotion rail recommended "
    "related reply replies respond responses search share sharing sidebar signup skyscraper social sponsor sponsored subscribe "
    "subscription survey tagcloud toc toolbar tooltip widget widgets".split()
)
#: Words that name the main text where they stand beside the word ``banner``, ``header`` and the like.
MAIN_WORDS = frozenset("article body content entry main post story text title headline".split())
HEADS = frozenset(("banner", "masthead"))

_TAG = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?"""
    r"""|<([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<([a-zA-Z][^\s/>]*+)([^>]*+)>?""",
    re.DOTALL,
)
_STOPS = {tag: re.compile(f"</{tag}", re.IGNORECASE) for tag in RAW}
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_TELLING = re.compile(r"class|id|role|hidden|style", re.IGNORECASE)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_DIGITS = re.compile(r"\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


class Node:
    __slots__ = ("above", "children", "declared", "key", "kind", "look", "tag")

    def __init__(self, tag: str, look: str, above: Node | None, declared: bool, kind: str | None) -> None:
        self.tag, self.look, self.above, self.declared, self.kind = tag, look, above, declared, kind
        self.children: list[str] = []
        self.key = _key(above.key if above else None, look)


@lru_cache(KNOWN)
def _key(above: int | None, look: str) -> int:
    return _hash(f"{above}>{look}")


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


@lru_cache(KNOWN)
def _look(tag: str, raw: str) -> tuple[str, bool, str | None]:
    """Presentation of a start tag, whether it declares boilerplate, and ``article`` or ``main`` if it declares that."""
    given = {m[0].lower(): html.unescape(m[1] or m[2] or m[3]) for m in _ATTRIBUTE.findall(raw)} if raw.strip(" /\t\n") else {}
    named = " ".join(given.get(k, "") for k in ("class", "id", "role"))
    words = {w.lower() for w in _WORDS.findall(named)}
    noise = words & NOISE
    if noise <= HEADS and words & MAIN_WORDS:
        noise = set()
    hidden = "hidden" in given or given.get("aria-hidden") == "true" or bool(_HIDDEN.search(given.get("style", "")))
    role = given.get("role", "").lower()
    kind = role if role in ("main", "article") else tag if tag in ("main", "article") else None
    if tag in ("html", "body"):  # site-wide switches, not a part of the page
        noise = set()
    look = _DIGITS.sub("#", f"{tag}.{'.'.join(sorted(given.get('class', '').split()))}#{given.get('id', '')}@{role}")
    return look, hidden or bool(noise) or tag in NOISE_TAGS, None if noise or hidden else kind


class Page:
    """Elements and texts of a page in their order; ``parts`` holds (node, text), and None where a block begins or ends."""

    def __init__(self, source: str) -> None:
        self.nodes: list[Node] = []
        self.parts: list[tuple[Node, str] | None] = []
        self.stack: list[Node] = []
        self.open: dict[str, int] = {}
        self._push("html", "")
        at, end = 0, len(source)
        while at < end:
            lt = source.find("<", at)
            m = None
            while lt >= 0 and not (m := _TAG.match(source, lt)):
                lt = source.find("<", lt + 1)
            self._text(source[at : lt if lt >= 0 else end])
            if lt < 0:
                break
            at = m.end()
            cdata, closing, tag, attributes = m[1], m[2], m[3] or m[5], m[4] or m[6] or ""
            if cdata:
                self.parts.append((self.stack[-1], cdata))
            elif closing:
                self._end(closing.lower())
            elif tag:
                tag = tag.lower()
                self._start(tag, attributes)
                if tag in RAW:
                    stop = stop.start() if (stop := _STOPS[tag].search(source, at)) else end
                    if tag in ("title", "textarea"):
                        self._text(source[at:stop])
                    at = stop

    def _text(self, text: str) -> None:
        if text:
            self.parts.append((self.stack[-1], html.unescape(text)))

    def _push(self, tag: str, attributes: str) -> None:
        look, declared, kind = _look(tag, attributes if attributes and _TELLING.search(attributes) else "")
        above = self.stack[-1] if self.stack else None
        if tag == "header" and not any(self.open.get(k) for k in ("article", "main")):
            declared = True
        node = Node(tag, look, above, declared, kind)
        if above and (not above.children or above.children[-1] != look):
            above.children.append(look)
        self.nodes.append(node)
        self.stack.append(node)
        self.open[tag] = self.open.get(tag, 0) + 1

    def _pop_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            tag = self.stack.pop().tag
            self.open[tag] -= 1
            if tag in BLOCKS:
                self.parts.append(None)

    def _depth_of(self, tags, stops) -> int | None:
        if not any(map(self.open.get, tags)):
            return None
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag in tags:
                return depth
            if self.stack[depth].tag in stops:
                return None
        return None

    def _start(self, tag: str, attributes: str) -> None:
        if tag == "html":
            return
        if tag in ENDS_P and self.open.get("p") and (depth := self._depth_of(("p",), CLOSED_IN)):
            self._pop_to(depth)
        if tag in ENDS and (depth := self._depth_of(*ENDS[tag])):
            self._pop_to(depth)
        if tag in BLOCKS:
            self.parts.append(None)
        elif tag in ("br", "td", "th", "img"):
            self.parts.append((self.stack[-1], " "))
        if tag not in VOID:
            self._push(tag, attributes)

    def _end(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        stops = frozenset() if tag in BLOCKS else BLOCKS  # an inline end tag does not end a block
        if depth := self._depth_of((tag,), stops):
            self._pop_to(depth)


def _blocks(page: Page, kept) -> list[str]:
    out: list[str] = []
    held: list[str] = []
    for part in (*page.parts, None):
        if part is not None:
            if kept(part[0]):
                held.append(part[1])
        elif held:
            if text := " ".join("".join(held).split()):
                out.append(text)
            held = []
    return out


def _without(page: Page, low: set[int]) -> set[int]:
    """Elements (by identity) in branches that are declared or unimportant; a declared branch around an article or main element stays."""
    holds, busy = set(), set()
    for node in reversed(page.nodes):  # children come after their parents
        if id(node) in holds or node.kind:
            holds.add(id(node.above))
        if node.key not in low or id(node) in busy:
            busy.add(id(node.above))
    gone: set[int] = set()
    for node in page.nodes:
        declared = node.declared and id(node) not in holds
        branch = node.key in low and id(node) not in busy
        if declared or branch or id(node.above) in gone:
            gone.add(id(node))
    return gone


def _under(page: Page, roots: set[int]) -> set[int]:
    inside: set[int] = set()
    for node in page.nodes:
        if id(node) in roots or id(node.above) in inside:
            inside.add(id(node))
    return inside


def _menus(page: Page) -> set[int]:
    """Lists that hold two texts or more, all of them links."""
    linked: dict[int, bool] = {}
    texts: dict[int, list[int]] = {}
    for node in page.nodes:  # parents come before their children
        linked[id(node)] = node.tag == "a" or linked.get(id(node.above), False)
        texts[id(node)] = [0, 0]
    for part in page.parts:
        if part is not None and part[1].strip():
            texts[id(part[0])][linked[id(part[0])]] += 1
    menus = set()
    for node in reversed(page.nodes):
        plain, links = texts[id(node)]
        if node.tag in ("ul", "ol") and not plain and links > 1:
            menus.add(id(node))
        if node.above:
            above = texts[id(node.above)]
            above[0] += plain
            above[1] += links
    return menus


def main_text(source: str | None, low: set[int] = frozenset()) -> str:
    """Text of the article of a page; ``low``: keys of the nodes that the site's tree finds unimportant."""
    page = Page(source or "")
    declared = _without(page, frozenset())
    size = lambda keep: sum(map(len, _blocks(page, lambda n: id(n) in keep)))
    every = {id(n) for n in page.nodes} - declared
    inside = {k: _under(page, {id(n) for n in page.nodes if n.kind == k and id(n) not in declared}) - declared for k in ("article", "main")}
    root = every
    if inside["main"]:
        root = inside["main"]
    if inside["article"] and (not inside["main"] or 2 * size(inside["article"] & inside["main"]) >= size(root)):
        root = inside["article"] & inside["main"] if inside["main"] else inside["article"]
    if root is every:
        root = every - _under(page, _menus(page))
    if low:
        left = root - _without(page, low)
        before, after = size(root), size(left)
        if after and (2 * after > before or not (inside["article"] or inside["main"])):
            root = left
    return "\n".join(_blocks(page, lambda n: id(n) in root))


def host(url: str | None) -> str | None:
    found = _HOST.match(url or "")
    return found[1].lower() if found else url


_SEEN = "site long, node long, kind int, feature long, mark long, page long, declared boolean"


def _page_key(page_id, url: str | None, source: str | None) -> tuple[int, int]:
    told = hashlib.blake2b(repr((page_id, url, source)).encode("utf-8", "surrogatepass"), digest_size=16).digest()
    return int.from_bytes(told[:8], "little", signed=True), int.from_bytes(told[8:], "little", signed=True)


def _seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each page its nodes (kind 0, with the page's hash), their layouts (1) and their texts (2)."""
    for batch in batches:
        for start in range(0, batch.num_rows, PAGES):
            rows: list[tuple] = []
            for page_id, url, source in zip(*(batch.column(i)[start : start + PAGES].to_pylist() for i in range(3)), strict=True):
                page, site, (first, second) = Page(source or ""), _hash(f"site {host(url)}"), _page_key(page_id, url, source)
                gone = _without(page, frozenset())
                texts: dict[int, list[str]] = {}
                for part in page.parts:
                    if part is not None and (text := " ".join(part[1].split())):
                        texts.setdefault(id(part[0]), []).append(text)
                blocks = _blocks(page, lambda n: n.tag not in RAW)
                mark = _hash(max(blocks, key=len, default=""))
                told = set()
                for node in page.nodes:
                    if node.tag in RAW:
                        continue
                    told.add((site, node.key, 0, first, mark, second, id(node) in gone))
                    told.add((site, node.key, 1, _hash(" ".join(node.children)), mark, None, None))
                    told.update((site, node.key, 2, _hash(t), mark, None, None) for t in texts.get(id(node), ()))
                rows.extend(told)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
            columns = list(zip(*rows, strict=True)) or [()] * 7
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in _SEEN.split(", ")])


def seen(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    ship(pages.sparkSession)
    return cut(pages.select(F.col(id_col), F.col(url_col), F.col(html_col)).mapInArrow(_seen, _SEEN), "dom")


def importance(found: DataFrame) -> DataFrame:
    """The merged style trees: (site, node, pages, layouts, texts, presentation, content, importance).

    ``texts``: whether any page has text directly in the node.
    """
    of = F.when(F.col("kind") == 0, 0).otherwise(F.col("feature"))
    each = found.groupBy("site", "node", "kind", of.alias("feature")).agg(F.countDistinct("mark").alias("n"))
    n, kind = F.col("n"), F.col("kind")
    sums = each.groupBy("site", "node").agg(
        F.max(F.when(kind == 0, n)).alias("pages"),
        F.count(F.when(kind == 1, 1)).alias("layouts"),
        F.sum(F.when(kind == 1, n)).alias("laid"),
        F.sum(F.when(kind == 1, n * F.ln(n))).alias("spread"),
        F.avg(F.when(kind == 2, F.ln(n))).alias("common"),
    )
    base = F.ln("pages")
    several = F.col("pages") > 1
    presentation = F.when(several, (F.ln("laid") - F.col("spread") / F.col("laid")) / base).otherwise(1.0)
    content = F.when(F.col("common").isNull(), 0.0).when(several, 1 - F.col("common") / base).otherwise(1.0)
    weight = F.pow(F.lit(DECAY), F.col("layouts"))
    known = sums.withColumns({"presentation": presentation, "content": content})
    both = (1 - weight) * F.col("presentation") + weight * F.col("content")
    texts = F.col("common").isNotNull().alias("texts")
    return known.select("site", "node", "pages", "layouts", texts, "presentation", "content", F.round(both, 9).alias("importance"))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, PAGES):
            part = batch.slice(start, PAGES)
            texts = [main_text(source, set(low or ())) for source, low in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)]
            yield pa.record_batch(
                [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [_page_key(*(batch.column(c)[i].as_py() for c in range(3))) for i in range(batch.num_rows)]
        yield pa.record_batch(
            [*(batch.column(c) for c in range(3)), pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64())],
            names=["page_id", "url", "html", "first", "second"],
        )


def extract(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    low: float = LOW,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars."""
    found = seen(pages, id_col, url_col, html_col)
    unimportant = importance(found).filter((F.col("pages") >= min_pages) & (F.col("importance") < low)).select("site", "node", "texts")
    of_page = found.filter("kind = 0 and not declared").select("site", "node", F.col("feature").alias("first"), F.col("page").alias("second"))
    lost = cut(  # only pages that have text in such a node lose anything
        of_page.join(unimportant, ["site", "node"])
        .groupBy("first", "second")
        .agg(F.collect_set("node").alias("low"), F.bool_or("texts").alias("texts"))
        .filter("texts")
        .drop("texts"),
        "lost",
    )
    given = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kind = given.schema["page_id"].dataType.simpleString()
    keyed = given.mapInArrow(_keyed, f"page_id {kind}, url string, html string, first long, second long")
    return (
        keyed.join(lost, ["first", "second"], "left")
        .select("page_id", "url", "html", "low")
        .mapInArrow(_extract, f"page_id {kind}, url string, text string, n_chars long")
    )
