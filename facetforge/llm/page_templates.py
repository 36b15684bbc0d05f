"""Main text of web pages, with the templates of their sites removed.

The element subtrees of every page are hashed and counted for each host;
subtrees that recur across many pages of the host are its template and are
deleted. What page elements say about themselves (menus, adverts, forms, …)
removes the rest that is no article.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetforge.llm.common import map_in_arrow, quoted, spare_name, without
from facetforge.storage import materialise

MIN_PAGES = 3
# A paragraph of at least so many words and without links is content, even where
# copies of an article recur on a host.
CONTENT_WORDS = 25
LINK_SHARE = 0.5

# Fixed values of HTML: elements without content, and elements that are blocks.
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt"
    " fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li"
    " main menu nav ol p pre search section summary table tbody tfoot thead tr ul".split()
)
# Inside an article, only these can be a menu.
_BOXES = frozenset("center dir div dl fieldset ol section table ul".split())
# What a start tag ends: the open element, and where the search for it stops.
_ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
    "body": (("head",), ()),
}
_P_STOPS = ("td", "th", "button", "caption", "table", "object", "#root")
# An end tag does not close across these.
_END_STOPS = ("td", "th", "table", "article", "main", "body", "#root")

# What is never main text.
_DROPPED_TAGS = frozenset(
    "head script style noscript template nav footer aside form button select textarea iframe"
    " object svg canvas dialog menu audio video datalist".split()
)
_DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog menu menubar".split()
)
_DROPPED_NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements adsbox banner sponsor sponsored promo"
    " cookie cookies consent gdpr notice notices newsletter subscribe signup sidebar menu navbar"
    " nav navigation breadcrumb breadcrumbs footer masthead comment comments disqus share sharing"
    " social related popup modal overlay widget pagination pager".split()
)
# What such names are combined with, as in "site-footer" or "related-posts".
_COMMON_NAMES = frozenset(
    "box block wrap wrapper container area section list item items posts links link buttons"
    " button bar inner outer top bottom left right site page global primary secondary fixed"
    " sticky inline slot unit form panel col column mobile desktop header".split()
)
_HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6", "section")
_ROOTS = ("article", "main")
_HOST = re.compile(r"(?i)^\s*[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


def _named_as_no_content(name: str) -> bool:
    """Whether a class or id is made of names of no content, and of words that say
    nothing else: "cookie-notice" is, "cookie-recipe" and "has-sidebar" are not."""
    words = set(re.split("[^a-z0-9]+", name)) - {""}
    return bool(words & _DROPPED_NAMES) and words <= _DROPPED_NAMES | _COMMON_NAMES


class Element:
    __slots__ = (
        "tag", "names", "gone", "named", "holds_root", "kids", "key", "words", "chars", "link_chars"
    )

    def __init__(self, tag: str, attributes: list[tuple[str, str | None]] = ()):
        self.tag = tag
        given = dict(attributes)
        self.names = f"{given.get('class') or ''} {given.get('id') or ''}".lower().strip()
        free = tag not in ("html", "body", *_ROOTS)
        # Ids of headings and sections are made from their words.
        names = self.names if tag not in _HEADINGS else (given.get("class") or "").lower()
        self.named = free and any(map(_named_as_no_content, names.split()))
        self.gone = tag in _DROPPED_TAGS or (
            free
            and (
                (given.get("role") or "").lower() in _DROPPED_ROLES
                or "hidden" in given
                or (given.get("aria-hidden") or "").lower() == "true"
                or "display:none" in (given.get("style") or "").replace(" ", "").lower()
            )
        )
        self.holds_root = False
        self.kids: list[Element | str] = []
        self.key = self.words = self.chars = self.link_chars = 0


class _Page(HTMLParser):
    """Builds the element tree and, as elements end, their hashes."""

    def __init__(self, host: str):
        super().__init__(convert_charrefs=True)
        self.host, self.root = host, Element("#root")
        self.open = [self.root]
        self.open_p = 0  # spares the search for one in deep trees

    def _end_top(self) -> None:
        done = self.open.pop()
        self.open_p -= done.tag == "p"
        digest = xxhash.xxh3_64()
        digest.update(f"{self.host}\n{done.tag}\n{done.names}".encode("utf-8", "replace"))
        for kid in done.kids:
            if isinstance(kid, str):
                words = kid.split()
                done.words += len(words)
                done.chars += sum(map(len, words))
                if words:
                    digest.update(("\n" + " ".join(words)).encode("utf-8", "replace"))
            else:
                done.holds_root = done.holds_root or kid.holds_root or kid.tag in _ROOTS
                done.words += kid.words
                done.chars += kid.chars
                done.link_chars += kid.link_chars
                digest.update(f"\n<{kid.key}>".encode())
        # A name never drops what holds the page's content.
        done.gone = done.gone or done.named and not done.holds_root
        if done.tag == "a":
            done.link_chars = done.chars
        done.key = digest.intdigest() - (1 << 63)

    def _end_open(self, tags: tuple[str, ...], stops: tuple[str, ...]) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            tag = self.open[at].tag
            if tag in tags:
                while len(self.open) > at:
                    self._end_top()
                return
            if tag in stops:
                return

    def handle_starttag(self, tag, attrs):
        if tag in _BLOCKS and self.open_p:
            self._end_open(("p",), _P_STOPS + _ROOTS)
        if tag in _ENDS:
            self._end_open(*_ENDS[tag])
        element = Element(tag, attrs)
        self.open[-1].kids.append(element)
        if tag not in _VOID:
            self.open.append(element)
            self.open_p += tag == "p"

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        stops = () if tag in _END_STOPS else _END_STOPS
        self._end_open((tag,), stops)

    def handle_data(self, data):
        self.open[-1].kids.append(data)


def parse(html: str, host: str) -> Element:
    page = _Page(host)
    page.feed(html)
    page.close()
    while page.open:
        page._end_top()
    return page.root


def _content(element: Element, inside: bool) -> bool:
    """Whether the element is a text of the page and never part of a template."""
    if element.gone:
        return False
    if inside:
        return element.tag not in _BOXES or element.link_chars <= LINK_SHARE * element.chars
    return element.words >= CONTENT_WORDS and not element.link_chars


def template_keys(root: Element) -> set[int]:
    """Hashes of the subtrees that may belong to a template: those with text
    that are no content of their own."""
    keys: set[int] = set()
    todo = [(root, False)]
    while todo:
        element, inside = todo.pop()
        inside = inside or element.tag in _ROOTS
        for kid in element.kids:
            if isinstance(kid, str) or kid.tag in ("head", "script", "style"):
                continue
            if kid.chars and not _content(kid, inside) and kid.tag not in ("html", "body", *_ROOTS):
                keys.add(kid.key)
            todo.append((kid, inside))
    return keys


def _roots(root: Element, template: set[int]) -> list[Element]:
    """The outermost main elements, or else articles, or else the whole page."""
    found: dict[str, list[Element]] = {tag: [] for tag in _ROOTS}
    todo: list[tuple[Element, frozenset[str]]] = [(root, frozenset())]
    while todo:
        element, above = todo.pop()
        if element.tag in _ROOTS and element.tag not in above:
            found[element.tag].append(element)
            above = above | {element.tag}
        for kid in reversed(element.kids):
            if not isinstance(kid, str) and not kid.gone:
                todo.append((kid, above))
    return found["main"] or found["article"] or [root]


def main_text(root: Element, template: set[int]) -> str:
    """Blocks of the page's content in page order, one line each."""
    blocks: list[str] = []
    held: list[str] = []

    def flush() -> None:
        words = "".join(held).split()
        if words:
            blocks.append(" ".join(words))
        held.clear()

    for top in _roots(root, template):
        flush()
        in_root = top.tag in _ROOTS
        todo: list = [(top, in_root)]
        while todo:
            item, inside = todo.pop()
            if item is None:
                flush()
            elif isinstance(item, str):
                held.append(item)
            else:
                if item is not top and (
                    item.gone
                    or not inside and item.tag == "header"
                    or item.key in template and not _content(item, inside) and item.chars
                ):
                    if item.tag in _BLOCKS:
                        flush()
                    continue
                if item.tag == "br" or item.tag in ("td", "th"):
                    held.append(" ")
                inside = inside or item.tag in _ROOTS
                if item.tag in _BLOCKS:
                    flush()
                    todo.append((None, inside))
                todo.extend((kid, inside) for kid in reversed(item.kids))
    flush()
    return "\n".join(blocks)


def site_templates(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(id, keys) of pages (id, url, html): the subtrees of each page that at
    least ``min_pages`` pages of its host have. Hashes include the host, and are
    counted with partial sums, so a host with a third of all pages is no hot
    group."""
    schema = T.StructType([pages.schema["id"], T.StructField("key", T.LongType())])

    def hash_subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, keys = [], []
            for i, (url, html) in enumerate(zip(batch.column(1), batch.column(2), strict=True)):
                found = template_keys(parse(html.as_py() or "", host_of(url.as_py())))
                row.extend([i] * len(found))
                keys.extend(found)
            ids = batch.column(0).take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(keys, pa.int64())], names=["id", "key"])

    hashes = materialise(pages.mapInArrow(hash_subtrees, schema), "subtrees")
    counts = hashes.groupBy("key").agg(F.count("*").alias("n"))
    recurring = materialise(counts.filter(F.col("n") >= min_pages).select("key"), "templates")
    return hashes.join(recurring, "key").groupBy("id").agg(F.collect_set("key").alias("keys"))


def extract_main_text(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """The pages with text and n_chars (code points of text).

    Subtrees that at least ``min_pages`` pages of the same host have are deleted,
    unless they are content: a paragraph of CONTENT_WORDS words without links,
    or anything inside an article that is not mostly links, so copies of an
    article stay whole. Then menus, headers, footers, sidebars, notices,
    adverts, forms, scripts, styles and reader comments go by tag, role, class
    and id. What is left of the main element, or else the articles, or else the
    page is the text: one line for each block, white space made one space,
    character references decoded.

    NULL and empty html give an empty text. Pages without a host share one.
    Rows with the same id share the templates found in any of them. Broken
    markup is read like a browser does for what matters here: open elements end
    where they must. Columns already named text or n_chars are replaced. An
    empty table gives an empty table.
    """
    kept = without(pages.schema, ["text", "n_chars"])
    columns = [quoted(f.name) for f in kept]
    rows = pages.select(
        quoted(id_column).alias("id"),
        quoted(url_column).cast("string").alias("url"),
        quoted(html_column).cast("string").alias("html"),
    )
    key, keys = spare_name(pages, "_page_key"), spare_name(pages, "_template_keys")
    templates = site_templates(rows, min_pages).select(
        F.col("id").alias(key), F.col("keys").alias(keys)
    )
    marked = (
        pages.select(*columns)
        .join(templates, quoted(id_column).eqNullSafe(F.col(key)), "left")
        .select(*columns, keys)
    )
    names = [f.name for f in kept]
    url_at, html_at, size = names.index(url_column), names.index(html_column), len(kept)
    schema = T.StructType(
        [*kept, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for url, html, found in zip(
                batch.column(url_at), batch.column(html_at), batch.column(size), strict=True
            ):
                root = parse(html.as_py() or "", host_of(url.as_py()))
                texts.append(main_text(root, set(found.as_py() or ())))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:size], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=schema.names,
            )

    return map_in_arrow(marked, extract, schema)
