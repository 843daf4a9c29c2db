"""Main text of web pages: site templates are element subtrees that recur across many pages of a host.

Every container's source is hashed; Spark counts on how many different pages of its host it stands, and subtrees that recur
are deleted. Elements that are furniture by their kind (menus, forms, scripts) or by their class go
everywhere. Where a page marks its article, that is the main text, and only lists of links are deleted inside it: a paragraph
that many copies of an article share is text, not template.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeweir.llm.common import saved, small_batches

#: A subtree is template on at least so many different pages of a host, and this share of them or many pages.
MIN_PAGES, MIN_SHARE, MANY_PAGES = 10, 0.1, 1000

# HTML element kinds, and class or id words of page furniture.
RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "canvas", "object")
FURNITURE = frozenset("nav header footer aside form button select menu dialog head fieldset audio video map".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article blockquote body caption center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 hr html li "
    "main ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("div section ul ol dl table p figure center blockquote details".split())
CLOSES_P = BLOCKS - {"html", "body"}
SAME_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices pagination "
    "popup promo promotion related respond share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^"'>]++|"[^"]*+"|'[^']*+')*+)>|<[!?/][^>]*+>|<[a-zA-Z][^>]*+(?:>|\Z)""",
    re.S,
)
_SPACE = re.compile(r"\s+")
_NAMES = re.compile(r"""(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_RAW_END = {name: re.compile(rf"</{name}\s*>|\Z", re.I) for name in RAW}


def names_furniture(attributes: str) -> bool:
    return any(
        word in FURNITURE_WORDS
        for value in _NAMES.findall(attributes)
        for word in re.split(r"[^a-z0-9]+", value.lower())
    )


class Element:
    __slots__ = ("furniture", "links", "mark", "name", "start", "text")

    def __init__(self, name: str, start: int, furniture: bool, mark: str):
        self.name, self.start, self.furniture, self.mark = name, start, furniture, mark
        self.text = self.links = 0  # characters of text below, and those in links


class Page:
    """Blocks of text with the subtrees they stand in, from one pass over the source."""

    def __init__(self, source: str):
        self.source = source
        self.stack: list[Element] = []
        self.open: dict[str, int] = {}  # how many elements of a name are open
        self.spans: list[tuple[int, int, bool, str]] = []  # start, end, only links, mark
        self.blocks: list[tuple[str, int, str]] = []  # text, place, mark
        self._parts: list[str] = []
        self._at, self._mark = 0, ""
        self.marks: set[str] = set()
        self._read()

    def _flush(self) -> None:
        if self._parts:
            text = " ".join(html.unescape("".join(self._parts)).split())
            self._parts = []
            if text:
                self.blocks.append((text, self._at, self._mark))

    def _close(self, end: int) -> None:
        e = self.stack.pop()
        self.open[e.name] -= 1
        if e.name in BLOCKS:
            self._flush()
        if e.name in CONTAINERS and not e.furniture:
            self.spans.append((e.start, end, bool(e.text) and e.links * 2 > e.text, e.mark))
        if self.stack:
            self.stack[-1].text += e.text
            self.stack[-1].links += e.text if e.name == "a" else e.links

    def _close_to(self, names: tuple[str, ...], end: int, within: tuple[str, ...]) -> None:
        """Closes the innermost open element of these names, unless one of ``within`` lies between."""
        if not any(self.open.get(n) for n in names):
            return
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k].name in names:
                while len(self.stack) > k:
                    self._close(end)
                return
            if self.stack[k].name in within:
                return

    def _text(self, at: int, text: str) -> None:
        top = self.stack[-1] if self.stack else None
        if top and top.furniture:
            return
        if not self._parts:
            self._at, self._mark = at, top.mark if top else ""
        self._parts.append(text)
        if top:
            top.text += len(text.strip())

    def _open(self, name: str, attributes: str, at: int) -> None:
        if name in CLOSES_P:
            self._close_to(("p",), at, ("article", "body", "table", "td", "th", "button"))
            self._flush()
        if name in SAME_ENDS:
            self._close_to(SAME_ENDS[name], at, ("ul", "ol", "dl", "table", "select"))
        if name == "br":
            if self._parts:
                self._parts.append(" ")
            return
        if name in VOID:
            return
        above = self.stack[-1] if self.stack else None
        furniture = (above is not None and above.furniture) or name in FURNITURE
        furniture = furniture or (name not in ("html", "body") and bool(attributes) and names_furniture(attributes))
        mark = above.mark if above else ""
        if name == "article" and not furniture:
            mark = "article"
        elif mark != "article" and not furniture and (name == "main" or "main" in attributes and re.search(r"role\s*=\s*.?main\b", attributes)):
            mark = "main"
        if mark:
            self.marks.add(mark)
        self.stack.append(Element(name, at, furniture, mark))
        self.open[name] = self.open.get(name, 0) + 1

    def _read(self) -> None:
        source, at = self.source, 0
        while True:
            m = _TAG.search(source, at)
            if m is None:
                break
            if m.start() > at:
                self._text(at, source[at : m.start()])
            at = m.end()
            name = (m[2] or "").lower()
            if not name:
                continue
            if name in _RAW_END and not m[1]:
                at = _RAW_END[name].search(source, at).end()
            elif m[1]:
                self._close_to((name,), at, ())
            else:
                self._open(name, m[3], m.start())
                if m[3].endswith("/") and self.stack and self.stack[-1].start == m.start() and name not in BLOCKS:
                    self._close(at)
        if at < len(source):
            self._text(at, source[at:])
        while self.stack:
            self._close(len(source))
        self._flush()

    @property
    def root(self) -> str:
        return "article" if "article" in self.marks else "main" if "main" in self.marks else ""

    def candidates(self) -> list[tuple[int, int, int]]:
        """(start, end, hash) of subtrees that go where they recur: all, or in a marked article those that are links."""
        root = self.root
        hashes = self._hashes()
        return [(s, e, hashes[s]) for s, e, links, mark in self.spans if (links and mark == root if root else True)]

    def _hashes(self) -> dict[int, int]:
        """Hash of each container by its start: of its own source, runs of white space as one, with its children's hashes
        in their places. Children close, and so are listed, before their parents; each character is read once.
        """
        hashes: dict[int, int] = {}
        waiting: list[tuple[int, int]] = []  # (start, end) of finished containers without a parent so far
        for start, end, _, _ in self.spans:
            first = len(waiting)
            while first and waiting[first - 1][0] >= start:
                first -= 1
            digest, at = xxhash.xxh3_64(), start
            for s, e in waiting[first:]:
                digest.update(_SPACE.sub(" ", self.source[at:s]).encode("utf-8", "surrogatepass"))
                digest.update(b"\0" + (hashes[s] + 2**63).to_bytes(8, "little"))
                at = e
            digest.update(_SPACE.sub(" ", self.source[at:end]).rstrip().encode("utf-8", "surrogatepass"))
            hashes[start] = digest.intdigest() - 2**63
            waiting[first:] = [(start, end)]
        return hashes

    def main_text(self, template: set[int]) -> str:
        # Subtrees lie inside each other or apart: of those that go only the outermost matter.
        gone: list[tuple[int, int]] = []
        for s, e, _ in sorted(x for x in self.candidates() if x[2] in template) if template else []:
            if not gone or s >= gone[-1][1]:
                gone.append((s, e))
        begins = [s for s, _ in gone]
        root = self.root

        def stays(at: int) -> bool:
            k = bisect_right(begins, at) - 1
            return k < 0 or at >= gone[k][1]

        return "\n\n".join(t for t, at, mark in self.blocks if (not root or mark == root) and stays(at))


def host(url):
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or end, A-Z lower-cased; empty if there is none."""
    found = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def _subtrees(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for where, page, source in zip(batch["host"], batch["page"], batch["html"], strict=True):
            rows += [(where, page, h) for h in {h for _, _, h in Page(source).candidates()}]
        yield pd.DataFrame(rows, columns=["host", "page", "subtree"])


def page_digest() -> Column:
    return F.xxhash64("html")


def templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, many_pages: int = MANY_PAGES) -> DataFrame:
    """``host, page, subtrees``: of each different page the hashes that recur on its host; copies of a page count once.

    They stand on ``min_pages`` different pages and on ``min_share`` of the host's, or on ``many_pages`` of however many.
    """
    known = pages.where("html is not null").select(host(F.col("url")).alias("host"), page_digest().alias("page"), "html")
    found = saved(known.mapInPandas(_subtrees, "host string, page long, subtree long").distinct(), "html-subtrees")
    counts = found.groupBy("host", "subtree").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    sizes = known.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    often = counts.join(sizes, "host").where((F.col("n") >= F.col("pages") * min_share) | (F.col("n") >= many_pages))
    often = saved(often.select("host", "subtree"), "html-often")
    return found.join(often, ["host", "subtree"]).groupBy("host", "page").agg(F.collect_list("subtree").alias("subtrees"))


def _extracted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = [
            Page(source).main_text(set() if subtrees is None else set(subtrees)) if source else ""
            for source, subtrees in zip(batch["html"], batch["subtrees"], strict=True)
        ]
        yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]})


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, many_pages: int = MANY_PAGES) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages(page_id, url, html)``.

    Blocks are joined by an empty line; references are decoded and white space inside a block is one space. A null or empty page has an
    empty text; a null url or one without ``://`` has the empty host. Pages that end early are read as far as they go. Repeated
    rows each get their row; other columns are ignored; an empty table gives no rows. Each page's templates are
    written first, so that the join's strategy follows their real size, whatever a host's share of the pages.
    """
    small_batches(pages.sparkSession)
    found = saved(templates(pages, min_pages, min_share, many_pages), "html-templates")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host(F.col("url")).alias("host"), page_digest().alias("page"))
    rows = rows.join(found, ["host", "page"], "left").select("page_id", "url", "html", "subtrees")
    return rows.mapInPandas(_extracted, "page_id long, url string, text string, n_chars long")
