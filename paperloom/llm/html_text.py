"""Main text of web pages: rules for page furniture, and removal of subtrees that recur across a host."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import byte_texts, slices
from paperloom.session import cut_lineage

#: A subtree is part of a host's template from so many pages and so large a share of its pages on.
FEWEST_PAGES, SHARE = 5, 0.3
#: Template rows up to which they are broadcast (some 20 bytes each); beyond, pages and templates are shuffled.
FEW_ROWS = 100_000

MARKUP = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*+))")
#: Attributes of a well-formed tag up to its end, and the next attribute of any tag, quotes only behind ``=``.
TIDY = re.compile(r"(?:\s++[^\s\"'<>/=]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'=<>`]++))?+)*+\s*+/?>")
ATTRIBUTE = re.compile(r"[\s/]*+(?:(>)|([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"'][^\s>]*+|(?=>))))?+)")
READ = frozenset(("class", "id", "role", "hidden", "aria-hidden"))

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split())
#: Their content is no markup; all but ``textarea`` never show.
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
DROPPED = RAW | frozenset("head nav footer aside form button select option noscript template svg math canvas object menu dialog audio video map".split())
#: Elements that a new block or item ends by itself.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}}
#: Words of class, id or role that tell page furniture.
FURNITURE = frozenset(
    "ad ads advert advertisement adverts advertising adslot banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disclaimer "
    "disqus footer menu modal nav navbar navigation newsletter notice notification pagination popup promo promoted promotion related replies "
    "respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget alert complementary contentinfo".split())
#: Words beside those in a name, as in ``comments-area``, and words of a layout's state, as in ``with-sidebar``.
NEUTRAL = frozenset(
    "area bar block box bottom bottoms btn button buttons center col column container content form global group icon icons id info inner item items js left "
    "link links list main media outer page panel post posts primary right row secondary section site slot top unit wrap wrapper".split())
STATES = frozenset("with has have no not without is are open closed off hide hides show shows enabled disabled".split())
COMMENTS = frozenset("comment comments commentlist disqus replies reply respond".split())
NEVER = frozenset(("html", "body", "article", "main"))


def told(name: str) -> str | None:
    """The word of a class, id or role that tells what the element is: the last that isn't neutral."""
    words = [w for w in re.split(r"[^a-z]+", name.lower()) if w]
    if any(w in STATES for w in words):
        return None
    return next((w for w in reversed(words) if w not in NEUTRAL), None)


class Element:
    """An open element: where it starts, text and hashes in it, and what held outside of it."""

    __slots__ = ("article", "before", "dropped", "first", "hard", "main", "parts", "soft", "start", "tag")

    def __init__(self, tag: str, start: int, page: Page) -> None:
        self.tag, self.start, self.first, self.before = tag, start, len(page.pieces), page.seen
        self.parts: list[str] = []
        self.soft: set[str] = set()
        self.hard, self.dropped, self.article, self.main = page.hard, page.dropped, page.article, page.main


class Page:
    """Text pieces of a page, each with its block, and elements as ranges of pieces with a hash.

    ``pieces`` are (block, inside an article, inside main, text); ``elements`` are (hash, first piece,
    end).  Furniture adds neither.  Elements that are furniture by their tag or because they are hidden
    always go; those that are by a name stay if they hold ``main``, the page's article, or, where no article
    or ``main`` stands outside, most of the text.  Time is linear in the page, whatever is left unclosed.
    """

    def __init__(self, html: str) -> None:
        self._read(html, frozenset())
        wanted = self._wanted()
        if wanted:
            self._read(html, wanted)

    def _read(self, html: str, wanted: frozenset[int]) -> None:
        self.pieces: list[tuple[int, bool, bool, str]] = []
        self.elements: list[tuple[int, int, int]] = []
        self.block = self.seen = 0  # seen: characters outside elements that always go
        self.hard = self.dropped = self.article = self.main = False
        self.named: list[tuple[int, int, int, set[str]]] = []  # start, end, characters, words
        self.holders: list[tuple[int, int, int, str]] = []
        self._open: list[Element] = []
        self._where: dict[str, list[int]] = {}
        self._wanted_starts = wanted
        at, begun, last, tidy = 0, 0, html.rfind(">"), True
        while match := MARKUP.search(html, at):
            start, at = match.start(), match.end()
            tag = (match[2] or "").lower()
            if not tag:
                end = html.find("-->", start + 2) + 2 if html.startswith("<!--", start) else html.find(">", at)
                if end < 2:
                    if not html.startswith("<!--", start):
                        break
                    end = len(html)
                self._text(html[begun:start])
                at = begun = end + 1
                continue
            if at > last:
                break
            end, attributes = self._attributes(html, at) if tidy else (0, {})
            if not end:
                tidy = False  # the rest of the page holds no end of such a tag: each ends at the next one there is
                end = html.find(">", at) + 1
                attributes = self._attributes(html[at:end], 0)[1]
            self._text(html[begun:start])
            at = begun = end
            if match[1]:
                self._close(tag, end)
                continue
            self._start(tag, attributes, start)
            if tag in RAW:
                found = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*+>?", re.I).search(html, at)
                at = begun = found.end() if found else len(html)
                self._close(tag, at)
        self._text(html[begun:])
        while self._open:
            self._pop(len(html))

    @staticmethod
    def _attributes(html: str, at: int) -> tuple[int, dict[str, str]]:
        """End of the tag, 0 if the page has none, and its attributes of ``READ``; the first of a name counts."""
        if html.startswith(">", at):
            return at + 1, {}
        tidy = TIDY.match(html, at)
        if tidy and "=" not in tidy[0] and "hidden" not in tidy[0].lower():
            return tidy.end(), {}
        found: dict[str, str] = {}
        while match := ATTRIBUTE.match(html, at):
            at = match.end()
            if match[1]:
                return at, found
            name = match[2].lower()
            if name in READ:
                found.setdefault(name, match[3] or match[4] or match[5] or "")
        return 0, found

    def _text(self, raw: str) -> None:
        if self.hard or not raw:
            return
        text = unescape(raw) if "&" in raw else raw
        shown = " ".join(text.split())
        self.seen += len(shown)
        if self.dropped:
            return
        self.pieces.append((self.block, self.article, self.main, text))
        if self._open:
            self._open[-1].parts.append(shown)

    def _start(self, tag: str, attributes: dict[str, str], start: int) -> None:
        if tag == "br" or tag in ("td", "th"):
            self._text(" ")
        if tag in BLOCK:
            self.block += 1
            if tag not in ("html", "body"):
                self._until({"p"}, {"button", "table", "object", "li", "td", "th", "div", "section", "article"}, start)
        if tag in ENDS:
            self._until(ENDS[tag], SCOPES.get(tag, set()), start)
        if tag in VOID:
            return
        element = Element(tag, start, self)
        self._where.setdefault(tag, []).append(len(self._open))
        self._open.append(element)
        self.article |= tag == "article"
        self.main |= tag == "main"
        hidden = "hidden" in attributes or attributes.get("aria-hidden", "").strip().lower() == "true"
        self.hard |= tag in DROPPED or hidden or (tag == "header" and not self.article)
        if attributes and tag not in ("html", "body", "main"):
            names = {told(x) for k in ("class", "id", "role") for x in attributes.get(k, "").split()} - {None}
            if tag == "article":
                element.soft = names & (COMMENTS | {"ad", "advert", "promo", "related"})
            else:
                element.soft = {x for x in names if x in FURNITURE or (x == "header" and not self.article)}
        self.dropped |= self.hard or (bool(element.soft) and start not in self._wanted_starts)

    def _until(self, ends: set[str], scope: set[str], at: int) -> None:
        """Close the innermost open element of ``ends``, unless one of ``scope`` stands inside of it."""
        k = max((self._where[x][-1] for x in ends if self._where.get(x)), default=-1)
        if k >= 0 and k >= max((self._where[x][-1] for x in scope if self._where.get(x)), default=-1):
            while len(self._open) > k:
                self._pop(at)

    def _close(self, tag: str, at: int) -> None:
        if tag in BLOCK:
            self.block += 1
        if self._where.get(tag):
            k = self._where[tag][-1]
            while len(self._open) > k:
                self._pop(at)

    def _pop(self, at: int) -> None:
        element = self._open.pop()
        self._where[element.tag].pop()
        shown, hard = not self.dropped, self.hard
        self.hard, self.dropped, self.article, self.main = element.hard, element.dropped, element.article, element.main
        if not hard:
            size = self.seen - element.before
            if element.soft:
                self.named.append((element.start, at, size, element.soft))
            elif element.tag in ("article", "main"):
                self.holders.append((element.start, at, size, element.tag))
        text = [x for x in element.parts if x]
        if shown and text:
            value = xxhash.xxh3_64_intdigest("\x00".join([element.tag, *text]))
            if element.tag in BLOCK and element.tag not in NEVER:
                self.elements.append((value, element.first, len(self.pieces)))
            if self._open:
                self._open[-1].parts.append(f"\x01{value:x}")

    def _wanted(self) -> frozenset[int]:
        """Starts of the elements that a name calls furniture and that stay."""
        if not self.named:
            return frozenset()
        mains = [h for h in self.holders if h[3] == "main" and h[2]]
        articles = [h for h in self.holders if h[3] == "article"]
        best = max(articles, key=lambda h: h[2], default=None)
        if best and (best[2] * 4 < self.seen or any(best[2] * 2 < m[2] for m in mains)):
            best = None
        # a page's own main and article lie where no comments do
        first, end = min((h[0] for h in self.holders if h[2]), default=-1), max((h[1] for h in self.holders if h[2]), default=-1)
        wanted = set()
        for start, stop, size, words in self.named:
            holds = any(start < m[0] < stop for m in mains)
            if not words & COMMENTS:
                holds |= bool(best) and start < best[0] < stop
                holds |= size * 2 > self.seen and (first < 0 or (start < first and end <= stop))
            if holds:
                wanted.add(start)
        return frozenset(wanted)

    def scope(self) -> int | None:
        """1 where articles hold half of main's text, or a quarter of the page's without a main; 2 for main; else none."""
        sizes = [0, 0, 0]
        for _, article, main, text in self.pieces:
            n = len(text) - text.count(" ")
            sizes[0] += n
            sizes[1] += n * article
            sizes[2] += n * main
        if sizes[1] and (sizes[1] * 2 >= sizes[2] if sizes[2] else sizes[1] * 4 >= sizes[0]):
            return 1
        return 2 if sizes[2] else None

    def text(self, template: frozenset[int] | set[int] = frozenset()) -> str:
        """Blocks in page order, of the part that ``scope`` names."""
        edges = [0] * (len(self.pieces) + 1)
        for value, first, end in self.elements:
            if value in template:
                edges[first] += 1
                edges[end] -= 1
        scope = self.scope()
        blocks: dict[int, list[str]] = {}
        depth = 0
        for piece, edge in zip(self.pieces, edges):
            depth += edge
            if not depth and (scope is None or piece[scope]):
                blocks.setdefault(piece[0], []).append(piece[3])
        lines = (" ".join("".join(parts).split()) for parts in blocks.values())
        return "\n".join(x for x in lines if x)


def sketch(text: str, hashes: dict[str, int]) -> int:
    """Least hash of the text's five-word shingles, equal for copies and for most near copies."""
    words = text.split()
    for w in words:
        if w not in hashes:
            hashes[w] = xxhash.xxh3_64_intdigest(w)
    if len(words) < 5:
        return xxhash.xxh3_64_intdigest(" ".join(words))
    one = np.fromiter((hashes[w] for w in words), np.uint64, len(words))
    mixed = np.zeros(len(words) - 4, np.uint64)
    for k in range(5):
        mixed = (mixed ^ one[k:len(one) - 4 + k]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return int(mixed.min())


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Host, sketch of the page's whole text, and hash of a subtree; a null one stands for the page itself."""
    for batch in slices(batches, "html"):
        hosts, contents, hashes = [], [], []
        words: dict[str, int] = {}
        for host, data in zip(batch.column("host").to_pylist(), byte_texts(batch.column("html"))):
            if host:
                page = Page(data.decode())
                found = [None, *{signed(v) for v, _, _ in page.elements}]
                hosts += [host] * len(found)
                contents += [signed(sketch(page.text(), words))] * len(found)
                hashes += found
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(contents, pa.int64()), pa.array(hashes, pa.int64())], names=["host", "content", "hash"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html"):
        sets: dict[tuple, frozenset[int]] = {}
        texts = []
        for listed, data in zip(batch.column("template").to_pylist(), byte_texts(batch.column("html"))):
            key = tuple(listed or ())
            template = sets.get(key)
            if template is None:
                template = sets[key] = frozenset(v % (1 << 64) for v in key)
            texts.append(Page(data.decode()).text(template))
        columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])


def main_text(pages: DataFrame, fewest: int = FEWEST_PAGES, share: float = SHARE) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``.

    Subtrees outside the page's furniture are hashed by tag, text and the hashes below; one that stands on
    ``fewest`` pages and ``share`` of a host's pages belongs to the host's template and goes.  Pages of a
    host with the same least hash of five-word shingles, before templates go, count as one page, in both
    numbers, so copies and near copies of an article don't make it a template.  A host has at most (subtrees a page) / ``share`` such hashes.  Null html is empty text; a null url, or one
    without a host, has no template; other columns don't matter; an empty table gives no rows.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    known = pages.select("page_id", "url", "html", host.alias("host"))
    found = known.select("host", "html").mapInArrow(_subtrees, "host string, content bigint, hash bigint").distinct()
    counted = cut_lineage(found.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") >= fewest) | F.col("hash").isNull()))
    totals = counted.where("hash IS NULL").select("host", F.col("n").alias("pages"))
    often = counted.where((F.col("n") >= fewest) & F.col("hash").isNotNull()).join(totals, "host").where(F.col("n") >= F.col("pages") * share)
    templates = cut_lineage(often.groupBy("host").agg(F.sort_array(F.collect_set("hash")).alias("template")))
    rows = templates.agg(F.sum(F.size("template") + 1)).first()[0] or 0
    joined = known.join(F.broadcast(templates) if rows <= FEW_ROWS else templates, "host", "left")
    columns = joined.select("page_id", "url", "html", "template")
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return columns.mapInArrow(_texts, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
