"""Main text of web pages, by the container that a host's pages agree on.

Every page scores its containers by the prose they hold and votes for one, named by its path
of tags and classes. Votes are counted per host in Spark, and each page is extracted from
the containers at the winning path; a page that has none, or no text there, keeps its own.
A container is widened to those around it that hold more of the article.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from functools import lru_cache
from hashlib import md5
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..operators.joins import lookup_join
from .common import stored
from .url_filter import host_of

#: Elements whose text is never the article's.
DROPPED = frozenset("nav header footer aside form button select menu dialog head title annotation annotation-xml".split())
#: Elements whose content is not markup: skipped up to their end tag.
RAW = frozenset("script style noscript template textarea iframe svg object canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split()) | frozenset(
    "math menclose mfenced mfrac mi mn mmultiscripts mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
CONTAINERS = frozenset("article body center div main section td".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag of the key ends an open element of these.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Words in classes, ids and roles of what is not the article, alone or in any compound name.
_ALWAYS = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored cookie cookies consent gdpr newsletter subscribe subscription signup login paywall comment comments commentlist"
    " respond disqus sidebar navbar breadcrumb breadcrumbs masthead topbar toolbar popup modal pagination pager contentinfo complementary".split()
)
#: Words that mean the same alone or beside words of layout, but may also be what an article is about.
_OFTEN = frozenset("nav navigation menu footer share sharing social related recommend recommended recommendations widget promo promotion".split())
#: The same, and parts of an article are named by them too: its header, a notice in it.
_SOMETIMES = frozenset("header notice notices alert banner overlay hidden skip search side".split())
_LAYOUT = frozenset(
    "site page main top bottom left right inner outer global primary secondary sticky fixed box bar block area column col panel row wrapper wrap container group list item items"
    " link links icon icons label count button buttons btn toggle form input results result title logo text content body section module unit slot zone posts articles stories".split()
)
_OF_ARTICLES = frozenset("article post story entry".split())
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']+|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>""", re.S)
_NAME = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
#: Shorter blocks are no prose and don't count for a container.
PROSE_CHARS = 25
#: Longer paths go on from their digest, so that deep nesting costs no more per element.
LONG_PATH = 400


def _names(attributes: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _NAME.finditer(attributes)} if attributes else {}


@lru_cache(maxsize=4096)
def _standing(name: str) -> int:
    """2 if a class, id or role is no article's, 1 if the text below it must tell, else 0."""
    words = [w for w in re.split(r"[\W\d_]+", name.lower()) if w]
    if not _ALWAYS.isdisjoint(words):
        return 2
    often, sometimes = not _OFTEN.isdisjoint(words), not _SOMETIMES.isdisjoint(words)
    if not often and not sometimes:
        return 0
    others = [w for w in words if w not in _OFTEN and w not in _SOMETIMES and w not in _LAYOUT]
    return 2 if not others or often and _OF_ARTICLES.issuperset(others) else 1


class _Open(NamedTuple):
    """An open element; numbers are those of the innermost container and doubted element."""

    tag: str
    path: str
    dropped: bool
    container: int
    doubted: int
    heading: bool
    article: bool


class _Block(NamedTuple):
    text: str
    links: int  # characters in links
    container: int
    doubted: int
    heading: bool

    @property
    def prose(self) -> int:
        return max(0, len(self.text) - 2 * self.links) if len(self.text) - 2 * self.links >= PROSE_CHARS else 0


def _with_inner(sums: list[int], parents: list[int]) -> list[int]:
    """Sums per node to sums per node and all below it; parents come before their children."""
    for node in range(len(sums) - 1, 0, -1):
        sums[parents[node]] += sums[node]
    return sums


class Page:
    """Text blocks of a page outside of dropped elements, and the tree of containers around them.

    Container 0 is the body, open from the start. Elements whose names leave doubt (a header
    inside an article, a section on side effects) are dropped after reading if less than
    half of their text is prose. Time and memory are linear in the page, nested or not.
    """

    def __init__(self, html: str | None):
        self.blocks: list[_Block] = []
        self.paths, self.parents, self._tags = [">body"], [0], ["body"]  # of the containers
        self._doubts = [0]  # per doubted element the one around it; 0 is none
        self._open: list[_Open] = [_Open("", "", False, 0, 0, False, False)]
        self._counts: Counter[str] = Counter()  # of open elements, by tag
        self._text: list[str] = []
        self._links = 0
        if html:
            self._read(html)
            self._flush()
            self._decide()

    def _read(self, html: str) -> None:
        at, n = 0, len(html)
        while at < n:
            m = _TAG.search(html, at)
            if not m:
                self._say(html[at:])
                return
            if m.start() > at:
                self._say(html[at : m.start()])
            at = m.end()
            closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
            if not tag:
                continue
            tag = tag.lower()
            if closing:
                self._end(tag)
            elif tag in RAW:
                if not attributes.endswith("/"):
                    end = re.compile(f"</{tag}[^>]*>", re.I).search(html, at)
                    at = end.end() if end else n
            elif tag == "br" or tag == "hr":
                self._say(" ")
            elif tag not in VOID:
                self._start(tag, attributes)

    def _say(self, text: str) -> None:
        if not self._open[-1].dropped:
            self._text.append(text)
            if self._counts["a"]:
                self._links += len(text)

    def _start(self, tag: str, attributes: str) -> None:
        names = _names(attributes)
        inline = tag in INLINE
        if not inline:
            self._flush()
            for place in range(len(self._open) - 1, 0, -1):
                name = self._open[place].tag
                if name in ENDS.get(tag, ()) or name == "p":
                    self._close(place)
                    break
                if name not in INLINE:
                    break
        _, path, dropped, container, doubted, heading, article = self._open[-1]
        if names and not dropped:
            standing = 0 if tag in ("html", "body", "main", "article") else self._doubt(tag, names, article)
            dropped = standing == 2 or "hidden" in names or names.get("aria-hidden", "").lower() == "true"
            if standing == 1 and not inline and not dropped:
                self._doubts.append(doubted)
                doubted = len(self._doubts) - 1
        dropped = dropped or tag in DROPPED
        if not inline and tag not in ("html", "body"):
            classes = sorted({re.sub(r"\d+", "0", c.lower()) for c in names.get("class", "").split()})
            if len(path) > LONG_PATH:
                path = md5(path.encode("utf-8", "replace")).hexdigest()
            path = f"{path}>{tag}" + "".join("." + c for c in classes)
            if tag in CONTAINERS and not dropped:
                self.parents.append(container)
                container = len(self.paths)
                self.paths.append(path)
                self._tags.append(tag)
        self._open.append(_Open(tag, path, dropped, container, doubted, heading or tag in HEADINGS, article or tag in ("article", "main")))
        self._counts[tag] += 1

    def _doubt(self, tag: str, names: dict[str, str], article: bool) -> int:
        """The standing of an element; of headings, and of an article's paragraphs, by whole names only."""
        values = [v for k in ("class", "id", "role") for v in names.get(k, "").split()]
        if tag in HEADINGS or article and tag in ("p", "figcaption"):
            return 2 if any(v.lower() in words for v in values for words in (_ALWAYS, _OFTEN, _SOMETIMES)) else 0
        return max(map(_standing, values), default=0)

    def _end(self, tag: str) -> None:
        if tag not in INLINE:
            self._flush()
        if not self._counts[tag]:
            return
        for place in range(len(self._open) - 1, 0, -1):
            if self._open[place].tag == tag:
                self._close(place)
                return
            if tag in INLINE and self._open[place].tag not in INLINE:
                return

    def _close(self, place: int) -> None:
        self._counts.subtract(e.tag for e in self._open[place:])
        del self._open[place:]

    def _flush(self) -> None:
        text = " ".join(entities.unescape("".join(self._text)).split()) if self._text else ""
        if text:
            _, _, _, container, doubted, heading, _ = self._open[-1]
            self.blocks.append(_Block(text, self._links, container, doubted, heading))
        self._text, self._links = [], 0

    def _decide(self) -> None:
        """Drop the blocks of doubted elements that are no prose."""
        if len(self._doubts) == 1:
            return
        size, prose = [0] * len(self._doubts), [0] * len(self._doubts)
        for block in self.blocks:
            if not block.heading:
                size[block.doubted] += len(block.text)
                prose[block.doubted] += block.prose
        size, prose = _with_inner(size, self._doubts), _with_inner(prose, self._doubts)
        dropped = [False] * len(self._doubts)
        for node in range(1, len(self._doubts)):
            dropped[node] = dropped[self._doubts[node]] or not prose[node] or 2 * prose[node] < size[node]
        self.blocks = [block for block in self.blocks if not dropped[block.doubted]]

    def best(self) -> str | None:
        """The path of the container that holds most prose, links aside, close around it."""
        scores: dict[str, float] = {}
        for block in self.blocks:
            prose, number = block.prose, block.container
            if prose:
                for weight in (1.0, 0.5, 0.25):
                    path = self.paths[number]
                    scores[path] = scores.get(path, 0) + weight * prose
                    if not number:
                        break
                    number = self.parents[number]
        return max(scores, key=lambda path: (scores[path], path)) if scores else None

    def _widened(self, inside: set[int]) -> set[int]:
        """``inside`` and the outermost containers around them whose further text is prose too.

        Further text is prose if blocks that are prose hold half of its characters at least;
        headings count neither way. The body must add no more prose than it is added to, and
        three quarters of what it adds must be prose.
        """
        size, prose, plain = ([0] * len(self.paths) for _ in range(3))
        for block in self.blocks:
            prose[block.container] += block.prose
            if not block.heading:
                size[block.container] += len(block.text)
                plain[block.container] += len(block.text) if block.prose else 0
        size, prose, plain = (_with_inner(sums, self.parents) for sums in (size, prose, plain))
        held = sum(prose[number] for number in inside if not self._within(number, inside))
        chosen = set()
        for number in inside:
            best = outer = number
            while outer:
                outer = self.parents[outer]
                more, added = size[outer] - size[number], plain[outer] - plain[number]
                if 2 * added >= more and (outer or 4 * added >= 3 * more and prose[0] <= 2 * held):
                    best = outer
            chosen.add(best)
        return inside | chosen

    def _within(self, number: int, inside: set[int]) -> bool:
        while number:
            number = self.parents[number]
            if number in inside:
                return True
        return False

    def text(self, path: str | None = None) -> str:
        """The text at ``path``, or else at the page's own best, or else of the whole page."""
        for wanted in (path, self.best()):
            if wanted is not None:
                chosen = self._widened({i for i, p in enumerate(self.paths) if p == wanted})
                inside = [number in chosen for number in range(len(self.paths))]
                for number in range(1, len(inside)):
                    inside[number] = inside[number] or inside[self.parents[number]]
                found = [block.text for block in self.blocks if inside[block.container]]
                if found:
                    return " ".join(found)
        return " ".join(block.text for block in self.blocks)


def host_paths(pages: DataFrame) -> DataFrame:
    """``host, path``: the container path that most pages of a host vote for; ties: the greater name."""

    def vote(batches):
        for batch in batches:
            paths = [Page(value).best() for value in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(paths, pa.string())], ["host", "path"])

    votes = pages.select(host_of(F.col("url")).alias("host"), "html").where("host IS NOT NULL").mapInArrow(vote, "host string, path string")
    counted = votes.where("path IS NOT NULL").groupBy("host", "path").agg(F.count("*").alias("n"))
    return counted.groupBy("host").agg(F.max(F.struct("n", "path"))["path"].alias("path"))


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars``: a row per row of ``pages`` (page_id, url, html).

    A null html is empty and gives an empty text, as does a page without text. A null or
    odd URL has no host: the page keeps its own container. Repeated pages vote and stay.
    """

    def extract(batches):
        for batch in batches:
            texts = [Page(value).text(path) for value, path in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    winners = stored(host_paths(pages), "hosts")
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("_host"))
    joined = lookup_join(rows, winners.withColumnRenamed("host", "_host"), "_host", "left").select("page_id", "url", "html", "path")
    schema = joined.drop("html", "path").schema.add("text", "string")
    return joined.mapInArrow(extract, schema).withColumn("n_chars", F.length("text").cast("long"))
