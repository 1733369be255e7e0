"""Main text of web pages, with templates of a site removed.

The subtrees of all pages are hashed and counted per host. A subtree that recurs among many
different texts of a host is part of its template and is deleted, as are elements whose tag,
role, id or class says that they are no part of the article. What counts is how many different
texts surround the subtree, so copies of a page, under whatever address or title, make no template. Elements
of running text, such as paragraphs, are no templates by themselves: they may be quoted. Inside an article or main
element only the second kind is deleted, and names decide only about elements with less than half of the
article. An element that holds an article or main element is no template either; its other children may be.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lading.llm.common import stored

# A subtree is a template among so many different texts, on hosts of every size.
LEAST_PAGES = 5

# Templates leave at least this share of a page's text; a page of which they would take more is a copy.
LEAST_LEFT = 1 / 8

# Template hashes that are sent to all tasks at once; of longer lists each page gets its own.
BROADCAST_ROWS = 100_000

# Elements by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p"
    " pre search section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("br body html option td th tr tbody thead tfoot caption".split())
CONTENT = frozenset(("article", "main"))
# Running text, which may be quoted on many pages.
QUOTABLE = frozenset("p blockquote pre h1 h2 h3 h4 h5 h6 li dt dd td th tr tbody figure figcaption caption summary address option".split())
DROPPED = frozenset(
    "nav header footer aside form script style noscript template iframe svg math canvas object embed"
    " button select textarea input dialog menu head title audio video search noembed noframes".split()
)
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar"
    " toolbar".split()
)
DROPPED_NAMES = frozenset(
    "ad ads adsense advert advertisement advertising banner breadcrumb breadcrumbs comment comments"
    " consent cookie cookies disqus disclaimer footer gdpr header login masthead menu modal nav navbar"
    " navigation newsletter notice pager pagination popup promo promoted promotion related reply replies"
    " respond share sharing sidebar signup skip social sponsor sponsored subscribe toolbar topbar"
    " widget".split()
)
# Names that begin or end so tell the state of a page or of what is beside the element.
STATE_HEADS = frozenset("has no with without".split())
STATE_ENDS = frozenset(("open",))
# Parts of names that say how or where something is shown, not what it is.
NEUTRAL_PARTS = frozenset(
    "area articles bar bottom box block body btn button buttons center col column container content count cta"
    " desktop entries form group head heading holder icons inner items label left link links list lists main"
    " message mobile module outer overlay panel posts primary region right row secondary section slot small"
    " stories text thread title top unit view wrap wrapper zone".split()
)
# A start tag ends the innermost open element of these kinds, up to the given container.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
P_SCOPE = frozenset("table td th button caption object article main section div".split())

_TOKEN = re.compile(
    r"<!--(?:.*?--!?>|.*\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"'=]|=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>][^\s>]*)?|[\"'])*)(?:>|\Z)",
    re.DOTALL,
)
_NAMED = re.compile(
    r"(?<![\w-])(class|id|role|hidden|aria-hidden|style)"
    r"(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?",
    re.IGNORECASE,
)
_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


def _dropped_name(value: str) -> bool:
    """Whether one of the names is that of a thing on the list: what the last telling part of a name says."""
    for name in value.split():
        parts = [part.lower() for part in _PARTS.findall(name)]
        if DROPPED_NAMES.isdisjoint(parts) or parts[0] in STATE_HEADS or parts[-1] in STATE_ENDS:
            continue
        while parts[-1] in NEUTRAL_PARTS and parts[-1] not in DROPPED_NAMES:
            parts.pop()
        if parts[-1] in DROPPED_NAMES:
            return True
    return False


def boilerplate(tag: str, attributes: str) -> str:
    """Whether an element is no part of an article: by its ``kind``, only by its ``name``, or not."""
    if tag in DROPPED:
        return "kind"
    if not attributes or tag in ("html", "body", "article", "main"):
        return ""
    found = ""
    for match in _NAMED.finditer(attributes):
        name = match[1].lower()
        value = match[2] or match[3] or match[4] or ""
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return "kind"
        if name == "role" and not DROPPED_ROLES.isdisjoint(value.lower().split()):
            return "kind"
        if name == "style" and _UNSEEN.search(value):
            return "kind"
        if name in ("class", "id") and not found and _dropped_name(value):
            found = "name"
    return found


class Page:
    """One pass over the markup of a page: its blocks of text and the hashes of its subtrees.

    ``templates`` are hashes of subtrees to delete. What is deleted for that, or for its names, is only known
    at the end of the page: of the content elements those with the fewest elements of dropped names around
    them are the article, and both rules look at how much of the text they would take.
    """

    def __init__(self, source: str, templates: frozenset[int] = frozenset()) -> None:
        self.source, self.templates = source, templates
        # Blocks: text, whether inside content, elements around it with dropped names, the innermost one
        # of these inside the content
        self.blocks: list[tuple[str, bool, int, int]] = []
        self.pieces: list[str] = []
        # Sum of the hashes of all blocks up to each, so that what surrounds a subtree has a hash as well
        self.sums: list[int] = [0]
        self.subtrees: dict[int, int] = {}
        # Blocks, from first to last, of subtrees that are templates
        self.deleted: list[tuple[int, int]] = []
        # Open elements: tag, deleted, inside content, first block, digests of children, names as in blocks
        self.stack: list[tuple[str, bool, bool, int, list[bytes], int, int]] = [("", False, False, 0, [], 0, 0)]
        # Where in the stack the open elements of each tag are
        self.places: dict[str, list[int]] = {}
        # The element with a dropped name around each one inside the content
        self.around: list[int] = [0]
        # Open elements, from the outermost, that are known to hold a content element
        self.holding = 1
        self.has_content = False
        # Fewest elements with dropped names around a content element
        self.least_named = 0
        self._read()

    @property
    def hashes(self) -> set[int]:
        return set(self.subtrees)

    def _flush(self, inside: bool, named: int, doubt: int) -> None:
        if self.pieces:
            text = " ".join(html.unescape("".join(self.pieces)).split())
            self.pieces = []
            if text:
                self.blocks.append((text, inside, named, doubt))
                number = xxhash.xxh64_intdigest(text.encode("utf-8", "replace"))
                self.sums.append((self.sums[-1] + number) & 0xFFFFFFFFFFFFFFFF)

    def _text(self, text: str) -> None:
        top = self.stack[-1]
        if not top[1]:
            self.pieces.append(text)
        if not top[2] and not text.isspace():
            top[4].append(" ".join(text.split()).encode("utf-8", "replace"))

    def _open(self, tag: str, attributes: str, empty: bool) -> None:
        ends = ENDS.get(tag)
        if ends:
            self._end_inner(*ends)
        if tag in CLOSES_P:
            self._end_inner({"p"}, P_SCOPE)
        _, deleted, inside, _, _, named, doubt = self.stack[-1]
        if tag in BLOCK:
            self._flush(inside, named, doubt)
        if empty or tag in VOID:
            if not inside:
                self.stack[-1][4].append(tag.encode())
            return
        if not deleted:
            found = boilerplate(tag, attributes)
            # Elements of blocks and custom ones may be wrappers of the article, or of most of it.
            if found == "name" and (tag in BLOCK or "-" in tag):
                self._flush(inside, named, doubt)
                if inside:
                    self.around.append(doubt)
                    doubt = len(self.around) - 1
                else:
                    named += 1
            else:
                deleted = found != ""
        if tag in CONTENT and not deleted:
            if not inside:
                self.holding = len(self.stack)
                self.least_named = min(named, self.least_named) if self.has_content else named
            inside = self.has_content = True
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, deleted, inside, len(self.blocks), [tag.encode(), b"|"], named, doubt))

    def _innermost(self, tags) -> int:
        return max((found[-1] for tag in tags if (found := self.places.get(tag))), default=0)

    def _end_inner(self, tags, scope) -> None:
        place = self._innermost(tags)
        if place and place > self._innermost(scope - tags):
            self._close_to(place)

    def _close_to(self, place: int) -> None:
        while len(self.stack) > place:
            tag, _, inside, first, digests, named, doubt = self.stack[-1]
            if tag in BLOCK or named > self.stack[-2][5] or doubt != self.stack[-2][6]:
                self._flush(inside, named, doubt)
            self.stack.pop()
            self.places[tag].pop()
            # Content is compared with nothing, and neither is what holds it.
            if inside:
                continue
            if len(self.stack) < self.holding:
                self.holding = len(self.stack)
                continue
            digest = xxhash.xxh64_digest(b"\0".join(digests))
            self.stack[-1][4].append(digest)
            last = len(self.blocks)
            if tag in BLOCK and tag not in QUOTABLE and last > first:
                number = int.from_bytes(digest, "little", signed=True)
                self.subtrees.setdefault(number, self.sums[last] - self.sums[first])
                if number in self.templates:
                    self.deleted.append((first, last))

    def _close(self, tag: str) -> None:
        if self.places.get(tag):
            self._close_to(self.places[tag][-1])
        elif tag == "p" or tag == "br":
            self._flush(self.stack[-1][2], *self.stack[-1][5:])

    def _read(self) -> None:
        source, at = self.source, 0
        while True:
            match = _TOKEN.search(source, at)
            if match is None:
                break
            if match.start() > at:
                self._text(source[at : match.start()])
            at = match.end()
            if match[2] is None:
                continue
            tag = match[2].lower()
            if match[1]:
                self._close(tag)
                continue
            self._open(tag, match[3], match[3].endswith("/") and tag not in BLOCK)
            if tag in RAW and self.stack[-1][0] == tag:
                end = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*>?", re.IGNORECASE).search(source, at)
                self._close(tag)
                at = end.end() if end else len(source)
        if at < len(source):
            self._text(source[at:])
        self._flush(self.stack[-1][2], *self.stack[-1][5:])
        self._close_to(1)

    def surroundings(self) -> dict[int, int]:
        """For every subtree a hash of the page's other text, whatever its order."""
        total = self.sums[-1]
        return {number: (total - own) & 0xFFFFFFFFFFFFFFFF for number, own in self.subtrees.items()}

    def _templates(self) -> set[int]:
        """Blocks of templates, unless they are nearly the whole page."""
        # Subtrees end before what is around them does: the last ones hold the others.
        taken, least = set(), len(self.blocks)
        for first, last in reversed(self.deleted):
            if first < least:
                taken.update(range(first, min(last, least)))
                least = first
        size = sum(len(block[0]) for block in self.blocks)
        left = size - sum(len(self.blocks[i][0]) for i in taken)
        return taken if left >= size * LEAST_LEFT else set()

    def _doubtful(self, article: list[tuple[str, bool, int, int]]) -> list[bool]:
        """For every element with a dropped name whether it goes: if no such element holds half of the article."""
        sizes = [0] * len(self.around)
        for text, _, _, doubt in article:
            sizes[doubt] += len(text)
        whole = sum(sizes)
        # An element comes after the one around it.
        for number in range(len(sizes) - 1, 0, -1):
            if self.around[number]:
                sizes[self.around[number]] += sizes[number]
        goes = [False]
        for number in range(1, len(sizes)):
            goes.append(goes[self.around[number]] or 2 * sizes[number] < whole)
        return goes

    def text(self) -> str:
        """The blocks of the article, or of the whole page if it marks none."""
        taken = self._templates() if self.deleted else ()
        article = [
            block
            for i, block in enumerate(self.blocks)
            if block[2] == self.least_named and (block[1] or not self.has_content) and i not in taken
        ]
        goes = self._doubtful(article)
        return " ".join(text for text, _, _, doubt in article if not goes[doubt])


def host_of(url):
    pattern = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), pattern, 1))


def subtrees(pages: DataFrame) -> DataFrame:
    """Rows (host, page_key, hash, other): the distinct subtrees outside the content of every page.

    ``other`` is a hash of the text around the subtree.
    """

    def run(batches):
        for batch in batches:
            hosts, keys, hashes, others = [], [], [], []
            for host, key, source in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = Page(source).surroundings()
                hosts += [host] * len(found)
                keys += [key] * len(found)
                hashes += found.keys()
                others += found.values()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hosts, pa.string()),
                    pa.array(keys, pa.int64()),
                    pa.array(hashes, pa.int64()),
                    pa.array(np.array(others, np.uint64).view(np.int64)),
                ],
                names=["host", "page_key", "hash", "other"],
            )

    return (
        pages.filter("html is not null and html <> ''")
        .select(host_of(F.col("url")).alias("host"), F.xxhash64("html").alias("page_key"), "html")
        .mapInArrow(run, "host string, page_key long, hash long, other long")
    )


def templates(pages: DataFrame, least_pages: int = LEAST_PAGES) -> DataFrame:
    """Rows (host, hash): subtrees that recur among many different texts of a host.

    Pages that say the same around the subtree count once, so a page that is stored many times, with
    whatever title or scripts, makes no template.
    """
    seen = subtrees(pages).groupBy("host", "hash", "other").agg(F.lit(1).alias("one"))
    counts = seen.groupBy("host", "hash").agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") >= least_pages).select("host", "hash")


def extract(pages: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Rows (page_id, url, text, n_chars), one per row of ``pages``.

    Null, empty and blank pages have an empty text. Rows without url are counted as one host.
    Extra columns are not read.
    """
    known = stored(templates(pages), "templates")
    small = known.count() <= broadcast_rows
    by_host: dict[str, frozenset[int]] = {}
    ready = pages.select("page_id", "url", host_of(F.col("url")).alias("_host"), "html")
    if small:
        # No more than broadcast_rows hashes, so every task may hold them.
        lists: dict[str, set[int]] = {}
        for row in known.collect():
            lists.setdefault(row["host"], set()).add(row["hash"])
        by_host = {host: frozenset(found) for host, found in lists.items()}
    else:
        # A list is bounded by the page's own subtrees, however many templates its host has.
        grouped = (
            subtrees(pages)
            .join(known, ["host", "hash"])
            .groupBy(F.col("host").alias("_of"), F.col("page_key").alias("_key"))
            .agg(F.collect_set("hash").alias("_hashes"))
        )
        same = (F.col("_host") == F.col("_of")) & (F.xxhash64("html") == F.col("_key"))
        ready = ready.join(grouped, same, "left").drop("_of", "_key")

    def run(batches):
        none: frozenset[int] = frozenset()
        for batch in batches:
            texts = []
            hosts, sources = batch.column(2).to_pylist(), batch.column(3)
            lists = None if small else batch.column(4)
            for i, host in enumerate(hosts):
                source = sources[i].as_py()
                if not source:
                    texts.append("")
                    continue
                found = by_host.get(host, none) if lists is None else frozenset(lists[i].as_py() or ())
                texts.append(Page(source, found).text())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    return ready.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
