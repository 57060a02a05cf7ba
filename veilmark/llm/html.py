"""Main text of web pages, with a site's templates found by counting element subtrees per host.

1. Every page is parsed once for its hashes, which are stored; each block-level element gives one of its subtree.
2. Spark counts the pages of each host that hold a subtree.  One belongs to the site's template that recurs on
   ``MANY_PAGES`` pages, or on ``LEAST_PAGES`` and ``LEAST_SHARE`` of the host's pages.  Cells and items of an article need
   the share in any case, as short ones (a "yes", a nought) recur on many pages without being a template.  An article's
   own paragraphs and headings need both ``MANY_PAGES`` and ``LEAST_SHARE``.
3. The page is parsed again, without template subtrees and without elements that are boilerplate by name or role (menus,
   forms, controls, adverts, comments, ...).  Names are tokens of a class or id, and of some words (``STRONG``) also
   the parts of a compound token such as ``comment-body``, unless ``no``, ``with`` or the like stands before them
   (``no-sidebar``, ``tag-comments``); they say nothing of articles, main parts and headings.  Text beside an article
   counts like any other, unless a part of a compound token names boilerplate of any kind (``site-header``).  An article within an element that is boilerplate by such a token counts only if the page has
   no other article; paragraphs and headings of an article stay where several pages quote them.

Blocks are joined by line feeds, with white space inside a block as one space.  Null and empty pages give an empty text.
Pages without a host in their url have no template.  Repeated rows count as pages of their own and give equal texts.
Pages of any length are read whole, in time that grows with their length whatever is open or unclosed.  Counts that
reach a bound exactly make a template.  An empty table gives no rows.  Columns other than ``page_id``, ``url`` and
``html`` are not read.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import stored
from .words import slices

LEAST_PAGES, LEAST_SHARE, MANY_PAGES = 5, 0.2, 100

#: Element names by role; names follow the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noframes template svg annotation annotation-xml".split())
#: Elements whose text is taken as it stands; and one that only counts inside an article, where it holds captions.
LITERAL, FALLBACK = "xmp", "noscript"
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote figure figcaption".split())
CELLS = frozenset("caption dd dt legend li option summary tbody td tfoot th thead tr".split())
#: The two lowest bits of a counted hash: cells and paragraphs of articles have other rules than other subtrees.
PLAIN, CELL, PARAGRAPH = 0, 1, 2
ROOTS = frozenset("html body article main".split())
#: Elements that no token of their class or id drops.
UNMARKED = ROOTS | frozenset("h1 h2 h3 h4 h5 h6".split())
LEFT_OUT = frozenset("head nav footer aside form menu dialog search".split())
#: Elements inside a block that are left out without ending it.
CONTROLS = frozenset("button select datalist object video audio canvas map".split())
#: Tokens of a class or id, and roles, that mark boilerplate.
MARKS = frozenset(
    "ad ads advert advertisement advertising adverts banner sponsor sponsored promo promotion menu nav navbar "
    "navigation breadcrumb breadcrumbs header masthead footer sidebar cookie cookies consent notice notices popup modal "
    "newsletter subscribe subscription comment comments disqus reply replies respond share sharing social related "
    "recommended widget toolbar copyright login signup hidden".split()
)
#: Marks that also count as a part of a compound token, and parts before them that take the meaning away.
STRONG = frozenset(
    "comment comments commentlist cookie cookies consent footer sidebar notice notices newsletter breadcrumb breadcrumbs "
    "disqus popup modal navbar advert adverts advertisement".split()
)
#: Marks that count as a part of a compound token only outside the article of a page that has one.
BESIDE = MARKS - STRONG
SPARING = frozenset("no without with has category tag".split())
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
#: Elements that an opening element of the given name ends, unless one of BARRIERS is in between.
ENDS = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
    "optgroup": ("option", "optgroup"),
    "body": ("head",),
}
BARRIERS = frozenset("html body article main div section nav aside footer header form table ul ol dl".split())

_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_UNQUOTED = re.compile(r"[^>\"']*")
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


def _part_of(token: str, words: frozenset[str]) -> bool:
    before = ""
    for part in re.split("[-_]+", token):
        if before in SPARING:
            return False
        if part in words:
            return True
        before = part
    return False


def _tokens(attributes: str) -> list[str]:
    """Tokens of its class and id."""
    found = _ATTRIBUTE.findall(attributes)
    return [t for name, a, b, c in found if name.lower() in ("class", "id") for t in (a or b or c).lower().split()]


def _is_marked(tokens: list[str]) -> bool:
    return any(t in MARKS or t in STRONG or _part_of(t, STRONG) for t in tokens)


def _is_out(attributes: str) -> bool:
    """By its role, or hidden."""
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "role":
            if value.lower() in ROLES:
                return True
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        elif name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
    return False


@dataclass
class Element:
    """An open element, with what its subtree hash is made of."""

    name: str
    out: bool = False
    marked: bool = False
    control: bool = False
    #: 0 outside articles, -1 there in an element with a compound mark, 1 in an article inside a marked element, 2 in
    #: another article.
    content: int = 0
    parts: list[str] = field(default_factory=list)
    first_block: int = 0


class Page:
    """One pass over a page: the hashes of its block subtrees, and the text blocks outside dropped elements."""

    def __init__(self, source: str, template: frozenset[int] = frozenset()):
        self.template = template
        self.hashes: set[int] = set()
        self.blocks: list[tuple[int, str]] = []
        self.article = 0
        self.open = [Element("")]
        self.inline: list[str] = []
        self.controls = 0
        # Places in ``open`` by name, and of the barriers among them.
        self.where: dict[str, list[int]] = {}
        self.barriers = [0]
        # What is known of the rest of the page: its last ">", quotes that never close, a tag that never ended.
        self.last, self.unclosed, self.unquoted = source.rfind(">"), set(), False
        at = 0
        while at < len(source):
            tag = source.find("<", at)
            if tag < 0 or tag > self.last:
                self.text(source[at:])
                break
            self.text(source[at:tag])
            at = self.markup(source, tag)
        while len(self.open) > 1:
            self.close()
        self.flush()

    def markup(self, source: str, at: int) -> int:
        """Take a tag, a comment or a declaration; returns where it ends."""
        if source.startswith("<!--", at):
            end = source.find("-->", at + 4)
            return len(source) if end < 0 else end + 3
        if source[at + 1] in "!?":
            return source.find(">", at) + 1
        found = _NAME.match(source, at)
        if found is None:
            self.text("<")
            return at + 1
        name, end = found[1].lower(), self.tag_end(source, found.end())
        attributes = source[found.end() : end - 1]
        if source[at + 1] == "/":
            self.end(name)
        elif name in RAW or name == LITERAL or (name == FALLBACK and self.open[-1].content <= 0):
            # Only drawings may close themselves; in other tags a slash at the end belongs to a value.
            if name == "svg" and re.search(r"(^|[\s\"'])/\s*$", attributes):
                return end
            close = re.compile(rf"</{re.escape(name)}(?![a-z0-9-])", re.I).search(source, end)
            if name == LITERAL:
                self.flush()
                self.text(entities.escape(source[end : close.start() if close else len(source)]))
                self.flush()
            after = source.find(">", close.end()) if close else -1
            return after + 1 or len(source)
        else:
            self.start(name, attributes)
        return end

    def tag_end(self, source: str, at: int) -> int:
        """Where a tag ends, quoted values passed over.  There is a ">" behind ``at``."""
        place = at
        while not self.unquoted:
            place = _UNQUOTED.match(source, place).end()
            if place == len(source):
                # Quotes do not pair up: from here on the next ">" ends a tag.
                self.unquoted = True
            elif source[place] == ">":
                return place + 1
            elif source[place] in self.unclosed:
                place += 1
            else:
                close = source.find(source[place], place + 1)
                if close < 0:
                    self.unclosed.add(source[place])
                place = max(place, close) + 1
        end = source.find(">", at)
        return end + 1 if end >= 0 else len(source)

    def text(self, raw: str) -> None:
        if raw and not self.controls:
            self.inline.append(raw)

    def flush(self) -> None:
        """End the current block; inside a control there is none to end."""
        if self.controls:
            return
        joined = "".join(self.inline)
        self.inline.clear()
        words = " ".join(entities.unescape(joined).split())
        if words:
            top = self.open[-1]
            top.parts.append(words)
            if not (top.out or top.marked):
                self.blocks.append((top.content, words))

    def start(self, name: str, attributes: str) -> None:
        if name == "br":
            self.inline.append(" ")
        if name in CONTROLS:
            parent = self.open[-1]
            self.controls += 1
            self.push(Element(name, True, parent.marked, True, parent.content, first_block=len(self.blocks)))
        if name not in BLOCK:
            return
        self.flush()
        if name in VOID:
            return
        self._end_open(("p",), name)
        if name in ENDS:
            self._end_open(ENDS[name], name)
        parent = self.open[-1]
        content, marked = parent.content, parent.marked
        if name in ("article", "main") and content <= 0:
            # What contains an article is no boilerplate by its class or id.
            content, marked = 1 if marked else 2, False
        in_article = parent.content > 0 and name == "header"
        out = name in LEFT_OUT or (name == "header" and not in_article)
        out = out or (name not in ("html", "body") and _is_out(attributes))
        if attributes and name not in UNMARKED:
            tokens = _tokens(attributes)
            marked = marked or _is_marked(tokens)
            if content == 0 and any(_part_of(t, BESIDE) for t in tokens):
                content = -1
        element = Element(name, parent.out or out, marked, content=content, first_block=len(self.blocks))
        if content > 0 and not (element.out or element.marked):
            self.article = max(self.article, content)
        self.push(element)

    def push(self, element: Element) -> None:
        place = len(self.open)
        self.open.append(element)
        self.where.setdefault(element.name, []).append(place)
        if element.control or element.name in BARRIERS:
            self.barriers.append(place)

    def close_to(self, place: int) -> None:
        while len(self.open) > place:
            self.close()

    def _end_open(self, names: tuple[str, ...], opening: str) -> None:
        place = max((self.where[n][-1] for n in names if self.where.get(n)), default=0)
        if place > self.barriers[-1]:
            self.close_to(place)

    def end(self, name: str) -> None:
        if name not in BLOCK and name not in CONTROLS:
            return
        places = self.where.get(name)
        if places and not (name in PARAGRAPHS and self.barriers[-1] > places[-1]):
            self.close_to(places[-1])
        elif name in BLOCK:
            self.flush()

    def close(self) -> None:
        """End the innermost open element: its hash is counted, and a template subtree loses its blocks."""
        self.flush()
        element = self.open.pop()
        self.where[element.name].pop()
        if self.barriers[-1] == len(self.open):
            self.barriers.pop()
        self.controls -= element.control
        if element.control or not element.parts:
            return
        digest = hashlib.blake2b(f"{element.name}\0{'\0'.join(element.parts)}".encode(), digest_size=8).digest()
        number = int.from_bytes(digest, "little", signed=True)
        self.open[-1].parts.append(f"<{number}>")
        if element.name in ROOTS:
            return
        kind = PLAIN
        if element.content > 0:
            kind = PARAGRAPH if element.name in PARAGRAPHS else CELL if element.name in CELLS else PLAIN
        number = number & ~3 | kind
        self.hashes.add(number)
        if number in self.template:
            del self.blocks[element.first_block :]

    def main_text(self) -> str:
        counted = (0, self.article) if self.article else (0, -1)
        return "\n".join(words for content, words in self.blocks if content in counted)


HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        found = [list(Page(source or "").hashes) for source in batch.column("html").to_pylist()]
        keys = [batch.column(n) for n in ("host_key", "page_key")]
        yield pa.RecordBatch.from_arrays([*keys, pa.array(found, pa.list_(pa.int64()))], ["host_key", "page_key", "subtrees"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        sources, templates = batch.column("html").to_pylist(), batch.column("template").to_pylist()
        texts = [Page(s or "", frozenset(t or ())).main_text() for s, t in zip(sources, templates, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"]
        )


def main_texts(
    pages: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE, many_pages: int = MANY_PAGES
) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages`` (columns ``page_id, url, html``)."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), HOST, 1))
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html")).withColumn("host", host)
    types = dict(pages.dtypes)
    # Hosts and pages are counted and joined by 64-bit hashes: the rows of subtrees are many.
    keys = [F.xxhash64("host").alias("host_key"), F.xxhash64("page_id", "url").alias("page_key")]
    hosted = rows.filter("host <> ''").select(*keys, "html")
    hashed = stored(hosted.mapInArrow(_hashes, "host_key long, page_key long, subtrees array<long>"), "subtrees")
    subtrees = hashed.select("host_key", "page_key", F.explode("subtrees").alias("subtree"))
    counts = subtrees.groupBy("host_key", "subtree").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_pages)
    sizes = hashed.groupBy("host_key").agg(F.count(F.lit(1)).alias("pages"))
    kind, shared = F.col("subtree").bitwiseAND(F.lit(3)), F.col("n") >= F.col("pages") * least_share
    many = F.col("n") >= many_pages
    recurs = F.when(kind == PLAIN, shared | many).when(kind == CELL, shared).otherwise(shared & many)
    template = counts.join(sizes, "host_key").filter(recurs).select("host_key", "subtree")
    # One short list per page: at most the page's own elements.
    marked = (
        subtrees.join(template, ["host_key", "subtree"])
        .groupBy(F.col("page_key").alias("marked_key"))
        .agg(F.collect_set("subtree").alias("template"))
    )
    same = F.xxhash64("page_id", "url") == F.col("marked_key")
    texts = (
        rows.join(marked, same, "left")
        .select("page_id", "url", "html", "template")
        .mapInArrow(_texts, f"page_id {types['page_id']}, url {types['url']}, text string")
    )
    return texts.withColumn("n_chars", F.length("text").cast("long"))
