"""Main text of web pages, with nearest-URL page differencing.

Pages are sorted by host and URL path, so that each stands beside the pages most like it in address.
A page's lines are aligned by longest common subsequence with those of the nearest page on either side that
is neither a copy nor a near copy; lines that such a neighbour shares are the site's template, except
inside an article element, which marks its content itself.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paytrail.operators.numbering import number_rows
from paytrail.session import materialized

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^'\">]|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")

_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark meta link nobr q rp rt ruby s "
    "samp small source span strike strong sub sup time tt u var wbr "
    "math mfrac mi mn mo mover mrow ms mspace msqrt mstyle msub msubsup msup mtext munder munderover semantics".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title iframe".split())  # hold no markup, so only their end tag ends them
_HIDDEN = frozenset("noscript template svg canvas object annotation annotation-xml".split())  # skipped if they are closed
_BOILERPLATE = frozenset("nav footer aside form button select dialog menu".split())
_CLOSES_ITSELF = {
    "p": {"p"}, "li": {"p", "li"}, "dt": {"p", "dt", "dd"}, "dd": {"p", "dt", "dd"}, "tr": {"p", "td", "th", "tr"},
    "td": {"p", "td", "th"}, "th": {"p", "td", "th"}, "option": {"option"},
}
_ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre "
    "section table ul".split()
)
_HINTS = frozenset(
    "ad ads advert advertisement adverts alert banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer menu modal nav navbar navigation newsletter notice pagination popup promo related respond share "
    "sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
_COMMENTS = frozenset("comment comments disqus respond".split())
_ADS = frozenset("ad ads advert adverts advertisement sponsored".split())
_CONTAINERS = frozenset("div section ul ol dl table".split())
_ROLES = frozenset("alert banner complementary contentinfo dialog form menu navigation search toolbar".split())

ARTICLE, OPEN, BOILERPLATE = 2, 1, 0
#: So many different pages on either side are looked at for one that is no near copy.
REACH = 8
#: A page that shares so much of the text beside the template is a near copy.
NEAR_COPY = 0.75
PAGES_IN_BLOCK = 256
_OUTLINE = np.dtype([("hash", "<u8"), ("size", "<i4"), ("zone", "u1")])


@dataclass
class Line:
    """A block of visible text, and whether it stands in an article, in boilerplate or in neither."""

    text: str
    zone: int


def _hinted(attributes: str, hints: frozenset[str]) -> bool:
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name in ("class", "id"):
            for token in value.split():
                parts = re.split(r"[-_]+", token)
                if hints & {parts[0], parts[-1]} and parts[0] not in ("has", "with", "no", "is", "not"):
                    return True
        elif hints is not _COMMENTS and (
            (name == "role" and value in _ROLES) or name == "hidden" or (name == "aria-hidden" and value == "true")
            or (name == "style" and re.search(r"display\s*:\s*none", value))
        ):
            return True
    return False


def _hinted_inside(tag: str, attributes: str) -> bool:
    """Whether an element within an article is marked as no part of it.

    A name there is more often that of a section ("market-share") than of boilerplate: only class names count that are
    hints throughout ("cookie-notice") and, for containers, names that begin with a word for comments or adverts.
    """
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        tokens = value.split() if name in ("class", "id") else ()
        if name == "class" and any(_HINTS.issuperset(re.split(r"[-_]+", t)) for t in tokens):
            return True
        marked = _COMMENTS | _ADS if name == "class" else _COMMENTS
        if tag in _CONTAINERS and any(re.split(r"[-_]+", t)[0] in marked for t in tokens):
            return True
        if (name == "role" and value in _ROLES) or name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value):
            return True
    return False


def _zone(tag: str, attributes: str, outer: int) -> int:
    """The zone of what an element holds, from its name and attributes and the zone around it."""
    if tag in ("article", "main") or (tag != "body" and 'role="main"' in attributes):
        return BOILERPLATE if outer == BOILERPLATE and tag != "main" or _hinted(attributes, _COMMENTS) else ARTICLE
    if outer == BOILERPLATE or tag in _BOILERPLATE or (tag == "header" and outer != ARTICLE):
        return BOILERPLATE
    if outer == ARTICLE:
        return BOILERPLATE if _hinted_inside(tag, attributes) else outer
    return BOILERPLATE if tag not in ("html", "head", "body") and _hinted(attributes, _HINTS) else outer


def _ends(page: str, tag: str) -> dict[int, int]:
    """Where each element of a name ends, by where it begins; those that are never closed are left out."""
    markup = rf"<!--.*?-->|<(script|style)\b.*?</\1\b|<(/?){tag}\b((?:[^'\">]|\"[^\"]*\"|'[^']*')*)>"
    ends, begun = {}, []
    for m in re.finditer(markup, page, re.I | re.S):
        if m[2] == "/":
            if begun:
                ends[begun.pop()] = m.end()
        elif m[2] is not None and not m[3].rstrip().endswith("/"):
            begun.append(m.start())
    return ends


def lines_of(page: str | None) -> list[Line]:
    """The visible blocks of a page in order: white space as one space, character references decoded."""
    out: list[Line] = []
    stack: list[tuple[str, int]] = []
    buffer: list[str] = []
    page = page or ""
    zone, at = OPEN, 0
    ends: dict[str, dict[int, int]] = {}

    def flush() -> None:
        text = _SPACE.sub(" ", entities.unescape("".join(buffer))).strip()
        buffer.clear()
        if text:
            out.append(Line(text, zone))

    while at < len(page):
        m = _MARKUP.search(page, at)
        if m is None:
            buffer.append(page[at:])
            break
        buffer.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag in _INLINE:
            if tag == "br":
                buffer.append(" ")
            elif m[1] or not m[3] or not (_hinted_inside(tag, m[3]) if zone == ARTICLE else _hinted(m[3], _HINTS)):
                if any(name == tag for name, _ in stack):  # closes a hinted inline element
                    if m[1]:
                        while stack.pop()[0] != tag:
                            pass
                        flush()
                        zone = stack[-1][1] if stack else OPEN
                    else:
                        stack.append((tag, zone))
            elif tag not in _VOID:
                flush()
                stack.append((tag, BOILERPLATE))
                zone = BOILERPLATE
            continue
        if tag in _HIDDEN:
            if tag not in ends and not m[1]:
                ends[tag] = _ends(page, tag)
            at = ends.get(tag, {}).get(m.start(), at)
            continue
        if tag in _RAW:  # what it holds is no text, and it ends no block
            if not m[1] and not m[3].rstrip().endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        flush()
        if m[1]:
            if any(name == tag for name, _ in stack):
                while stack.pop()[0] != tag:
                    pass
                zone = stack[-1][1] if stack else OPEN
            continue
        closes = _CLOSES_ITSELF.get(tag) or ({"p"} if tag in _ENDS_PARAGRAPH else ())
        while stack and stack[-1][0] in closes:
            stack.pop()
        zone = _zone(tag, m[3], stack[-1][1] if stack else OPEN)
        if tag not in _VOID:
            stack.append((tag, zone))
        else:
            zone = stack[-1][1] if stack else OPEN
    flush()
    return out


def common_lines(own: list, other: list) -> set[int]:
    """Places in ``own`` of a longest common subsequence of both lists (Hunt and Szymanski)."""
    start, end = 0, 0
    while start < min(len(own), len(other)) and own[start] == other[start]:
        start += 1
    while end < min(len(own), len(other)) - start and own[-1 - end] == other[-1 - end]:
        end += 1
    found = {*range(start), *range(len(own) - end, len(own))}
    places = defaultdict(list)
    for j in range(len(other) - end - 1, start - 1, -1):
        places[other[j]].append(j)
    tails: list[int] = []
    chain: list[tuple[int, tuple | None]] = []
    for i in range(start, len(own) - end):
        for j in places.get(own[i], ()):
            k = bisect_left(tails, j)
            link = (i, chain[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                chain.append(link)
            else:
                tails[k], chain[k] = j, link
    last = chain[-1] if chain else None
    while last:
        found.add(last[0])
        last = last[1]
    return found


def main_text(lines: list[Line], shared: set[int]) -> str:
    """The lines that are a page's own.

    Lines shared with a neighbour go, unless they stand in an article; so does what is marked as boilerplate.
    On a page with an article the rest around it goes too.
    """
    own = [x for i, x in enumerate(lines) if x.zone == ARTICLE or (x.zone == OPEN and i not in shared)]
    if any(x.zone == ARTICLE for x in own):
        own = [x for x in own if x.zone == ARTICLE]
    return "\n".join(x.text for x in own)


def template_lines(page: np.ndarray, before: list[np.ndarray], after: list[np.ndarray]) -> set[int]:
    """Places of a page's lines that it shares with the nearest page on either side that is no near copy of its body.

    ``before`` and ``after`` hold the pages on either side, nearest first. A page that shares all that could be
    content is a copy. What the least similar page around shares is taken as the template; a page that shares
    ``NEAR_COPY`` of the remaining characters besides is a near copy of the body and says nothing about the template.
    If even the least similar page shares ``NEAR_COPY`` of all content, as within a run of near copies, nothing
    tells body and template apart, and no line goes.
    """
    content = [i for i, zone in enumerate(page["zone"].tolist()) if zone != BOILERPLATE]
    lines, sizes = page["hash"].tolist(), page["size"].tolist()

    def held(other: np.ndarray) -> set[int]:
        theirs = set(other["hash"].tolist())
        return {i for i in content if lines[i] in theirs}

    sides = [[(x, held(x)) for x in side] for side in (before, after)]
    sides = [[(x, common) for x, common in side if len(common) < len(content)] for side in sides]
    around = [common for side in sides for _, common in side]
    if not around:
        return set()
    least = min(around, key=lambda common: sum(sizes[i] for i in common))
    if sum(sizes[i] for i in least) >= NEAR_COPY * sum(sizes[i] for i in content):
        return set()
    rest = [i for i in content if i not in least]
    size = sum(sizes[i] for i in rest)
    out: set[int] = set()
    for side in sides:
        for other, common in side:
            if common is least or sum(sizes[i] for i in rest if i in common) < NEAR_COPY * size:
                out |= common_lines(lines, other["hash"].tolist())
                break
    return out


def _outlines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of pages as hashes, sizes and zones."""
    for batch in batches:
        packed = []
        for html in batch.column("html").to_pylist():
            lines = lines_of(html)
            outline = np.empty(len(lines), dtype=_OUTLINE)
            for i, x in enumerate(lines):
                digest = hashlib.blake2b(x.text.encode("utf-8", "surrogatepass"), digest_size=8).digest()
                outline[i] = int.from_bytes(digest), len(x.text), x.zone
            packed.append(outline.tobytes())
        columns = [batch.column("host"), batch.column("path"), batch.column("page")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(packed, pa.binary())], names=["host", "path", "page", "outline"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The template lines of the pages of each block, whose rows come in order of their place."""
    last: list[tuple] = []
    block = None

    def templates() -> list[tuple[str, list[int]]]:
        pages = [(host, page, own, np.frombuffer(outline, dtype=_OUTLINE)) for host, page, own, outline in last]
        out = []
        for n, (host, page, own, outline) in enumerate(pages):
            if own and not (outline["zone"] == ARTICLE).any():
                before = [x[3] for x in reversed(pages[max(0, n - REACH) : n]) if x[0] == host]
                after = [x[3] for x in pages[n + 1 : n + 1 + REACH] if x[0] == host]
                shared = template_lines(outline, before, after)
                if shared:
                    out.append((page, sorted(shared)))
        return out

    def record(rows: list[tuple]) -> pa.RecordBatch:
        pages, shared = list(zip(*rows)) or [(), ()]
        return pa.RecordBatch.from_arrays([pa.array(pages, pa.string()), pa.array(shared, pa.list_(pa.int32()))], names=["page", "shared"])

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("block", "host", "page", "own", "outline"))):
            if row[0] != block:
                yield record(templates())
                block, last = row[0], []
            last.append(row[1:])
    yield record(templates())


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [
            main_text(lines_of(html), set(shared or ()))
            for html, shared in zip(batch.column("html").to_pylist(), batch.column("shared").to_pylist())
        ]
        columns = [batch.column("page_id"), batch.column("url")]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract_pages(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: ``page_id``, ``url``, ``text``, ``n_chars``.

    A host's pages of different content are numbered by path. Each is compared by its lines' hashes with the ``REACH``
    pages on either side, in blocks of the numbering that overlap by as much; so neither the number of a host's
    pages nor the partitions matter. Template lines are then joined to the pages, which are moved only for that.

    NULL or empty html gives the empty text. Pages without a URL or host have no neighbours. Copies within a host
    are one page, have one text and do not delete each other; near copies do not delete each other's
    body, however many stand side by side: within a long run their template stays with it. Cut-off markup ends where the
    page ends. Other columns are ignored. An empty table gives no rows.
    """
    address = "(?i)^[a-z][a-z0-9+.-]*://([^/?#]+)([^?#]*)"
    host = F.lower(F.regexp_extract("url", address, 1))
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", "html",
        F.when(host != "", host).alias("host"), F.regexp_extract("url", address, 2).alias("path"),
    )
    rows = rows.withColumn("page", F.md5(F.concat_ws("\n", "host", "html").cast("binary")))
    outlines = rows.where("host IS NOT NULL AND html != ''").select("host", "path", "page", "html")
    outlines = outlines.mapInArrow(_outlines, "host string, path string, page string, outline binary")
    outlines = outlines.groupBy("host", "page", "outline").agg(F.min("path").alias("path"))
    placed = number_rows(outlines, [F.col("host"), F.col("path"), F.col("page")], "place")
    block = F.floor(F.col("place") / PAGES_IN_BLOCK)
    blocks = F.array_distinct(F.array(block, *(F.floor((F.col("place") + k) / PAGES_IN_BLOCK) for k in (-REACH, REACH))))
    dealt = placed.select(F.explode(blocks).alias("block"), block.alias("home"), "place", "host", "page", "outline")
    dealt = dealt.select("block", "place", "host", "page", (F.col("block") == F.col("home")).alias("own"), "outline")
    dealt = dealt.repartition("block").sortWithinPartitions("block", "place").drop("place")
    shared = materialized(dealt.mapInArrow(_compare, "page string, shared array<int>"), "template-lines")
    joined = rows.select("page_id", "url", "html", "page").join(shared, "page", "left")
    return joined.select("page_id", "url", "html", "shared").mapInArrow(_extract, "page_id bigint, url string, text string, n_chars bigint")
