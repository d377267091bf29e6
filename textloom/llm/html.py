"""HTML extraction by differencing pages with the nearest URL.

A page becomes lines: the text of its blocks, white space made single, character
references decoded. Within each host pages are ordered by path; a page is paired with
those of its ``REACH`` neighbours on either side that share the longest start of its
path, the nearest first, leaving out those that have every line of it (copies, print
views), which can't tell text from frame. Lines are aligned by a longest common
subsequence with the nearest such page and with the second nearest, and what both share
is deleted, so that text which only one other page carries stays. With one such page on
the host that one decides.

What differencing deletes: on pages without ``article`` or ``main`` any line; in the story
(the article with most text of its own, and ``main`` around it) every line but prose
(paragraphs, headings, quotes, cells, preformatted text, captions), for a passage that
several pages quote is part of each of them; in other articles on the page any line, prose
too, that either page has anywhere. Other articles that are mostly links are teasers and go.

Elements that are menus, headers, footers, sidebars, forms or scripts by their tag or role
go everywhere. Names of classes and ids decide only outside the story and, inside it, for
containers whose whole name is one of a menu, advert, comment section and so on.

Only hashes and sizes of lines travel to be aligned, in pieces of ``PIECE`` consecutive pages
of a host with ``REACH`` more at both ends, so a large host is spread over tasks. Html
meets what differencing found only where that changes a page.

Defined cases: null and empty html give an empty text; null url is a host of its own; of two
equally near neighbours the one nearer in order comes first, then the one before; rows equal
in page_id, url and html are one page for differencing and each give a row, also where they
share a page_id with others; elements that aren't closed end with the page, script and style
take the rest of it; other columns are ignored.
"""

from __future__ import annotations

import html as _html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators.rows import running
from textloom.scratch import written
from textloom.sizes import spread

#: Neighbours looked at on either side; pages of a host in one piece.
REACH, PIECE = 4, 256
#: A line that a page has oftener than this isn't aligned: it is shared if the other has it.
OFTEN = 16
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>|<[!?][^>]*>|<[/a-zA-Z!?][^>]*\Z", re.S)
RAW = {"script", "style", "iframe", "textarea", "title"}
VOID = {"br", "hr", "img", "input", "meta", "link", "wbr", "area", "base", "col", "embed", "source", "track", "param"}
DROP = {"nav", "footer", "aside", "form", "menu", "button", "dialog", "head", "noscript", "template", "select"}
#: These may be left open around a story, which ends them.
FRAME = {"nav", "header", "footer", "form", "menu", "button", "select", "noscript", "head"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img"}
PROSE = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "td", "th", "figcaption", "caption", "dt", "dd", "math"}
CONTAINERS = {"div", "section", "ul", "ol", "dl", "table"}
CLOSES_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul"}
NAMED = re.compile(r"(?<![a-z0-9])(?:ads?|adverts?|advertisements?|advertising|adsense|sponsor(?:ed|s)?|promo(?:tion)?s?|banner|cookies?|consent|gdpr|notices?|notification|popup|modal|overlay|newsletter|subscribe|subscription|paywall|sidebar|side-?bar|menu|nav|navbar|navigation|breadcrumbs?|footer|masthead|site-?header|page-?header|comments?|comment-?list|disqus|replies|social|share|sharing|related|recommended|widget|toolbar|skip-?link)(?![a-z0-9])", re.I)
IN_STORY = re.compile(r"(?:ads?|adverts?|advertisements?|advertising|adsense|sponsored|promo|cookies?|consent|newsletter|sidebar|menu|nav|navbar|navigation|breadcrumbs?|comments?|disqus|replies|social|share|sharing|related|recommended|toolbar)(?:[-_](?:box|bar|buttons?|links?|list|section|area|block|wrapper|container|notice|form|posts?|articles?|menu))?", re.I)
ROLES = re.compile(r"""\brole\s*=\s*["']?(?:navigation|banner|contentinfo|complementary|search|form|dialog|alert|menu|menubar)\b""", re.I)
ATTRIBUTE = re.compile(r"""(?<![\w-])(?:class|id)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
HIDDEN = re.compile(r"""(?:\s|^)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)


#: Zones of a line: outside any story, in main but in no article; articles count from 1.
OUTSIDE, MAIN = 0, -1


class Line:
    """A block's text; its zone; whether it is prose; how many characters of it are links."""

    __slots__ = ("text", "zone", "prose", "links")

    def __init__(self, text: str, zone: int, prose: bool, links: int):
        self.text, self.zone, self.prose, self.links = text, zone, prose, links


def _dropped(tag: str, rest: str, inside: bool) -> bool:
    if tag in DROP or (tag == "header" and not inside):
        return True
    if not rest:
        return False
    if ROLES.search(rest) or HIDDEN.search(rest):
        return True
    names = ["".join(x) for x in ATTRIBUTE.findall(rest)]
    if not inside:
        return tag not in ("html", "body", "article", "main") and any(NAMED.search(x) for x in names)
    return tag in CONTAINERS and any(IN_STORY.fullmatch(x) for n in names for x in n.split())


def lines(page: str) -> list[Line]:
    """The blocks of a page in order, without those that are dropped whatever other pages have."""
    out: list[Line] = []
    stack: list[tuple] = []  # tag and the state outside it
    held: list[str] = []
    at = articles = link_from = 0
    dropped = zone = prose = anchors = links = 0

    def flush() -> None:
        nonlocal links, link_from
        text = " ".join(_html.unescape("".join(held)).split())
        if text and not dropped:
            out.append(Line(text, zone, prose > 0, min(len(text), links + (sum(map(len, held)) - link_from if anchors else 0))))
        held.clear()
        links = link_from = 0

    def leave(depth: int) -> None:
        nonlocal dropped, zone, prose
        _, dropped, zone, prose = stack[depth]
        del stack[depth:]

    skip = ""
    for m in TOKEN.finditer(page):
        closing, tag, rest = m[1] or m[4], (m[2] or m[5] or "").lower(), m[3] or m[6] or ""
        if skip:
            if closing and tag == skip:
                skip, at = "", m.end()
            continue
        held.append(page[at : m.start()])
        at = m.end()
        if not tag:
            continue
        if tag in RAW and not closing:
            if tag not in INLINE:
                held.append(" ")
            if not rest.endswith("/"):
                skip = tag
            continue
        if tag in INLINE and not dropped and not (rest and (HIDDEN.search(rest) or (not zone and any(NAMED.search("".join(x)) for x in ATTRIBUTE.findall(rest))))):
            if tag == "a" and closing and anchors:
                anchors, links = 0, links + sum(map(len, held)) - link_from
            elif tag == "a" and not closing:
                anchors, link_from = 1, sum(map(len, held))
            if not closing and tag not in VOID:
                stack.append((tag, dropped, zone, prose))
            elif closing and any(t[0] == tag for t in stack[-8:]):
                while stack and stack[-1][0] in INLINE:
                    if stack.pop()[0] == tag:
                        break
            continue
        flush()
        if tag in VOID:
            continue
        if closing:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if depth is not None:
                leave(depth)
            continue
        if tag in CLOSES_P:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] not in INLINE), None)
            if depth is not None and stack[depth][0] == "p":
                leave(depth)
        if tag in ("article", "main") and dropped:
            # a frame that was left open ends where a story begins
            open_ = [i for i, t in enumerate(stack) if t[0] in FRAME]
            if open_ and not stack[open_[0]][1]:
                leave(open_[0])
        stack.append((tag, dropped, zone, prose))
        if _dropped(tag, rest, zone != OUTSIDE):
            dropped += 1
        elif tag == "article" and zone <= 0:
            articles += 1
            zone = articles
        elif tag == "main" and zone == OUTSIDE:
            zone = MAIN
        elif tag in PROSE:
            prose += 1
    if not skip:
        held.append(page[at:])
    flush()
    return out


def common(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``; lines that either has more
    than OFTEN times aren't aligned, but count as common if both have them."""
    often = {x for own in (a, b) for x, n in Counter(own).items() if n > OFTEN}
    if often:
        both = often & set(a) & set(b)
        at = [i for i, x in enumerate(a) if x not in often]
        rest = common([a[i] for i in at], [x for x in b if x not in often])
        return sorted([*(i for i, x in enumerate(a) if x in both), *(at[k] for k in rest)])
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < min(len(a), len(b)) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    where: dict[int, list[int]] = {}
    for j in range(len(b) - hi - 1, lo - 1, -1):
        where.setdefault(b[j], []).append(j)
    tops: list[int] = []
    chain: list[tuple] = []
    for i in range(lo, len(a) - hi):
        for j in where.get(a[i], ()):
            k = bisect_left(tops, j)
            node = (i, chain[k - 1] if k else None)
            if k == len(tops):
                tops.append(j)
                chain.append(node)
            else:
                tops[k], chain[k] = j, node
    found, node = [], chain[-1] if chain else None
    while node:
        found.append(node[0])
        node = node[1]
    return [*range(lo), *reversed(found), *range(len(a) - hi, len(a))]


def host_path(url: str | None) -> tuple[str, str]:
    m = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)([^?#]*)", url or "")
    return (m[1].lower().rsplit("@")[-1], m[2] or "/") if m else ("", url or "")


def _key() -> list:
    return [F.xxhash64(F.lit(n), "page_id", "url", "html").alias(f"k{n}") for n in (1, 2)]


class Shape:
    """A page's lines without their text: hashes, zones, sizes, links, and which are prose."""

    KINDS = (np.int64, np.int32, np.int32, np.int32, np.int32)

    def __init__(self, *columns: np.ndarray):
        self.hash, self.zone, self.size, self.links, self.prose = columns

    @classmethod
    def of(cls, page: list[Line]) -> Shape:
        rows = [(xxhash.xxh64_intdigest(x.text) - (1 << 63), x.zone, len(x.text), x.links, x.prose) for x in page]
        return cls(*(np.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 5, cls.KINDS)))

    def dump(self) -> bytes:
        return b"".join(c.tobytes() for c in (self.hash, self.zone, self.size, self.links, self.prose))

    @classmethod
    def load(cls, blob: bytes) -> Shape:
        n = len(blob) // 24
        return cls(*(np.frombuffer(blob, k, n, at * n) for k, at in zip(cls.KINDS, (0, 8, 12, 16, 20))))


def kept(page: Shape, others: list[Shape]) -> np.ndarray:
    """Which lines of a page are main text, given the nearest pages that can tell (two at most)."""
    n = len(page.hash)
    own = page.hash.tolist()
    shared = [np.isin(np.arange(n), common(own, o.hash.tolist())) for o in others]
    both = np.logical_and.reduce(shared) if shared else np.zeros(n, bool)
    articles = np.unique(page.zone[page.zone > 0])
    if not (page.zone != OUTSIDE).any():
        return ~both
    met = np.isin(page.hash, np.concatenate([o.hash for o in others])) if others else np.zeros(n, bool)
    text = {k: int(page.size[(page.zone == k) & ~met].sum()) for k in articles}
    story = max(text, key=lambda k: (text[k], int(page.size[page.zone == k].sum()), -k)) if text else 0
    keep = np.zeros(n, bool)
    inside = (page.zone == MAIN) | ((page.zone == story) & (story > 0))
    keep[inside] = True
    if len(others) > 1:
        keep[inside & (page.prose == 0) & both] = False
    for k in articles:
        rows = page.zone == k
        if k != story and 2 * page.links[rows].sum() < page.size[rows].sum():
            keep[rows & ~met] = True
    return keep


def start(a: str, b: str) -> int:
    """How many characters two paths begin with in common."""
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def nearest(place: int, pages: list[tuple[str, Shape]]) -> list[Shape]:
    """The two nearest pages, of up to REACH on either side, that lack some line of the page."""
    path, page = pages[place]
    near = [j for j in range(max(0, place - REACH), min(len(pages), place + REACH + 1)) if j != place]
    near.sort(key=lambda j: (-start(path, pages[j][0]), abs(j - place), j))
    own, found = set(page.hash.tolist()), []
    for j in near:
        if not own <= set(pages[j][1].hash.tolist()):
            found.append(pages[j][1])
            if len(found) == 2:
                break
    return found


def changes(pages: DataFrame) -> DataFrame:
    """k1, k2, lost (places of lines): the pages that lose lines by differencing, of those that
    they would have without it, or get others."""

    def shaped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hosts, paths, blobs = [], [], []
            for url, page in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                host, path = host_path(url)
                hosts.append(host)
                paths.append(path)
                blobs.append(Shape.of(lines(page or "")).dump())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(blobs, pa.binary())], names=["k1", "k2", "host", "path", "shape"])

    def piece(key: tuple, held: list[tuple]) -> Iterator[tuple]:
        rows = [(p, Shape.load(s)) for _, _, _, p, s in held]
        for i, (n, k1, k2, _, _) in enumerate(held):
            if n // PIECE == key[1]:
                with_, without = kept(rows[i][1], nearest(i, rows)), kept(rows[i][1], [])
                if (with_ != without).any():
                    yield k1, k2, np.flatnonzero(~with_).astype(np.int32)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for b in batches:
            out = []
            for host, at, *row in zip(*(c.to_pylist() for c in b.columns)):
                if (host, at) != key:
                    out += piece(key, held) if held else []
                    key, held = (host, at), []
                held.append(tuple(row))
            yield _lost(out)
        yield _lost(list(piece(key, held)) if held else [])

    def _lost(rows: list[tuple]) -> pa.RecordBatch:
        k1, k2, lost = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(lost, pa.list_(pa.int32()))], names=["k1", "k2", "lost"])

    rows = pages.select(*_key(), "url", "html").mapInArrow(shaped, "k1 long, k2 long, host string, path string, shape binary")
    shapes = written(rows.groupBy("k1", "k2").agg(*(F.first(c).alias(c) for c in ("host", "path", "shape"))), "page-shapes")
    order = running(shapes.select("host", "path", "k1", "k2", F.lit(0).alias("none")), ["host"], ["path", "k1", "k2"], "none").select("k1", "k2", F.col("_n").alias("n"))
    at, last = F.floor(F.col("n") / PIECE), F.col("n") % PIECE
    # pages at the ends of a piece are the neighbours of the next piece's
    to = F.filter(F.array(at, F.when((last < REACH) & (at > 0), at - 1), F.when(last >= PIECE - REACH, at + 1)), lambda x: x.isNotNull())
    dealt = shapes.join(order, ["k1", "k2"]).select("host", F.explode(to).alias("at"), "n", "k1", "k2", "path", "shape")
    return dealt.repartition("host", "at").sortWithinPartitions("host", "at", "n").mapInArrow(align, "k1 long, k2 long, lost array<int>")


def main_text(page: list[Line], lost: list[int] | None = None) -> str:
    """The kept lines, joined by one space; ``lost`` are the others, where differencing decides."""
    gone = np.flatnonzero(~kept(Shape.of(page), [])).tolist() if lost is None else lost
    out = set(gone)
    return " ".join(x.text for i, x in enumerate(page) if i not in out)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, n_lost (lines that are no main text; null where differencing
    changes nothing): a row for each row of ``pages``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lost = b.column(3).to_pylist()
            text = [main_text(lines(page or ""), x) for page, x in zip(b.column(2).to_pylist(), lost)]
            n = [None if x is None else len(x) for x in lost]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64()), pa.array(n, pa.int64())], names=["page_id", "url", "text", "n_chars", "n_lost"])

    found = written(changes(pages), "page-changes")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", *_key()).join(found, ["k1", "k2"], "left")
    return rows.select("page_id", "url", "html", "lost").mapInArrow(run, "page_id long, url string, text string, n_chars long, n_lost long")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spread(spark.read.parquet(f"{sf_dir}/pages.parquet")))


QUERIES = {"op8_html_extraction": op8_html_extraction}
