"""Main text of raw pages: markup zones, and page differencing where markup says nothing.

Pages are sorted by host and URL path, so each stands beside the page of its host whose path
is nearest. Both are cut into text lines (blocks), the lines are aligned by their longest
common subsequence, and shared lines are deleted, as what two pages of a site share is
its frame. Lines whose zone the markup names are not left to that: menus, adverts and the like are
deleted though they differ on every page, and lines of an article stay though its neighbour
quotes the same passage.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm import arrays
from landfall.llm.common import small_batches, written
from landfall.llm.url_filter import host_of, path_of

FRAME, OPEN, ARTICLE = 0, 1, 2      # zones: delete, difference, keep
SLICE_ROWS = 64     # pages of a slice at least, so that few are sent to a second one

# Elements by role in a page.
_RAW = {"script", "style", "title", "textarea", "noscript", "iframe", "xmp", "noembed", "noframes", "template",
        "svg", "object", "audio", "video", "canvas"}
_FRAMES = {"head", "nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "fieldset", "label"}
_BLOCKS = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option
    p pre section summary table tbody td tfoot th thead tr ul""".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# Classes, ids and roles, or the last words of such, that name a part of the frame.
_FRAME_WORDS = set("""ad ads adsense advert adverts advertisement advertising sponsor sponsored promo promoted
    promotion banner cookie cookies consent gdpr notice notification alert popup overlay modal newsletter subscribe
    subscription signup sidebar menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer masthead
    comment comments commentlist commentform commentbox disqus aside notices reply replies respond share sharing social related recommended widget toolbar topbar
    login search complementary contentinfo""".split())

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
# Words after which a name tells what an element comes with, not what it is.
_BESIDE = {"has", "no", "with", "without", "not", "non"}


def _is_frame_name(token: str) -> bool:
    """Whether a name, or its last word, is a part of the frame."""
    if token.lower() in _FRAME_WORDS:
        return True
    words = [word.lower() for word in _WORD.findall(token)]
    return bool(words) and words[-1] in _FRAME_WORDS and _BESIDE.isdisjoint(words)


def _names_frame(attributes: str) -> bool:
    if not attributes or "=" not in attributes:
        return False
    return any(_is_frame_name(token) for _, value in _NAMES.findall(attributes)
               for token in value.strip("\"'").split())


def _tags(page: str) -> list[tuple[int, int, bool, str, str]]:
    """``(start, end, closing, name, attributes)`` of each tag, a raw element with its content as one
    tag; a comment has no name."""
    tags = []
    at = 0
    for tag in _TAG.finditer(page):
        if tag.start() < at:
            continue
        at = tag.end()
        closing, name, attributes = (tag[1], tag[2], tag[3]) if tag[2] else (tag[4], tag[5], tag[6])
        name = (name or "").lower()
        if name in _RAW and not closing and not attributes.endswith("/"):
            end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
        tags.append((tag.start(), at, bool(closing), name, attributes or ""))
    return tags


def _named_frames(tags: list[tuple[int, int, bool, str, str]]) -> set[int]:
    """Places of the tags whose names open a frame: never an article or main, or what holds one."""
    named = {i for i, (_, _, closing, name, attributes) in enumerate(tags)
             if not closing and name and name not in _VOID and name not in _RAW
             and name not in ("html", "body", "article", "main") and _names_frame(attributes)}
    if not named:
        return named
    held: list[list] = []           # the open elements: place, tag, whether it holds an article or main
    count: dict[str, int] = {}
    for i, (_, _, closing, name, _) in enumerate(tags):
        if not name or name in _VOID or name in _RAW:
            continue
        ends = name if closing else "p" if name in _BLOCKS and held and held[-1][1] == "p" else None
        if not closing and name == "li" and held and held[-1][1] == "li":
            ends = "li"
        if ends and count.get(ends):
            while True:
                last = held.pop()[1]
                count[last] -= 1
                if last == ends:
                    break
        if closing:
            continue
        if name in ("article", "main"):
            for element in reversed(held):
                if element[2]:
                    break
                element[2] = True
                named.discard(element[0])
        held.append([i, name, False])
        count[name] = count.get(name, 0) + 1
    return named


def page_lines(page: str) -> list[tuple[str, int]]:
    """The text lines of a page in order, each with its zone."""
    lines: list[tuple[str, int, bool]] = []
    parts: list[str] = []
    frame: list[list] = []          # the open frame element: its tag, and how deep it is nested
    depth = {"article": 0, "main": 0}
    seen_article = seen_main = False
    heading = False                 # inside a heading of an article's own header
    by_name = False                 # the frame is known by a class, id or role
    at = 0

    def flush() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                inside = (bool(depth["article"]), bool(depth["main"]))
                lines.append((text, inside, bool(frame) and not heading))

    tags = _tags(page)
    named = _named_frames(tags)
    for place, (start, end, closing, name, attributes) in enumerate(tags):
        if start > at:
            parts.append(html.unescape(page[at:start]))
        at = end
        if not name:
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in _BLOCKS:
            flush()
        if name in _RAW and not closing and not attributes.endswith("/"):
            continue
        if name in depth:
            flush()
            depth[name] = max(0, depth[name] + (-1 if closing else 1))
            seen_article |= name == "article"
            seen_main |= name == "main"
            if by_name and not closing:     # what holds this opens no frame, so it has ended
                frame, heading, by_name = [], False, False
        if frame:
            if frame[0] == "header" and re.fullmatch("h[1-6]", name) and depth["article"]:
                heading = not closing
            if name == frame[0] and name not in _VOID:
                if closing:
                    frame[1] -= 1
                elif name in ("p", "li"):       # these end where the next one begins
                    frame[1] = 0
                else:
                    frame[1] += 1
            elif frame[0] == "head" and name == "body":
                frame[1] = 0
            if frame[1] > 0 or closing:
                if frame[1] <= 0:
                    flush()
                    frame, heading, by_name = [], False, False
                continue
            frame, heading, by_name = [], False, False
        by_tag = name in _FRAMES or name == "header"
        if not closing and name not in _VOID and (by_tag or place in named):
            flush()
            frame, by_name = [name, 1], not by_tag
    if at < len(page):
        parts.append(html.unescape(page[at:]))
    flush()

    def zone(inside: tuple[bool, bool], framed: bool) -> int:
        in_article, in_main = inside
        if framed:
            return FRAME
        if in_article or in_main and not seen_article:
            return ARTICLE
        return OPEN if in_main or not (seen_article or seen_main) else FRAME

    return [(text, zone(inside, framed)) for text, inside, framed in lines]


def shared_lines(mine: list[str], theirs: list[str]) -> set[int]:
    """Places of ``mine`` on a longest common subsequence with ``theirs``, by bit-parallel rows."""
    first = 0
    while first < min(len(mine), len(theirs)) and mine[first] == theirs[first]:
        first += 1
    last = 0
    while last < min(len(mine), len(theirs)) - first and mine[-1 - last] == theirs[-1 - last]:
        last += 1
    out = {*range(first), *range(len(mine) - last, len(mine))}
    a, b = mine[first:len(mine) - last], theirs[first:len(theirs) - last]
    both = set(a) & set(b)
    places = [i for i, line in enumerate(a) if line in both]
    other = [line for line in b if line in both]
    match: dict[str, int] = {}
    for j, line in enumerate(other):
        match[line] = match.get(line, 0) | 1 << j
    full = (1 << len(other)) - 1
    row, rows = full, [full]
    for i in places:
        hit = row & match[a[i]]
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    # Walk back: a cleared bit that the row before still has set ends a match.
    k = len(places)
    j = len(other) - 1
    while k and j >= 0:
        if rows[k] >> j & 1:
            j -= 1
        elif rows[k - 1] >> j & 1:
            out.add(places[k - 1] + first)
            k -= 1
            j -= 1
        else:
            k -= 1
    return out


def main_text(lines: list[tuple[str, int]], neighbour: list[tuple[str, int]] | None) -> str:
    """The lines that stay, one to a row."""
    shared: set[int] = set()
    if neighbour and any(zone == OPEN for _, zone in lines):
        shared = shared_lines([text for text, _ in lines], [text for text, _ in neighbour])
    return "\n".join(text for i, (text, zone) in enumerate(lines)
                     if zone == ARTICLE or zone == OPEN and i not in shared)


def _common(a: str, b: str) -> int:
    size = min(len(a), len(b))
    return next((i for i in range(size) if a[i] != b[i]), size)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over the slices of pages sorted by host and path: each page with the nearer of those beside it."""
    before = now = None

    def done(page: dict, after: dict | None) -> tuple:
        beside = [p for p in (before, after) if p is not None and p["host"] == page["host"]]
        nearest = max(beside, key=lambda p: _common(p["path"], page["path"]), default=None)
        text = main_text(page["lines"], nearest and nearest["lines"])
        return page["_id"], page["url"], text, len(text)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64())
        columns = zip(*rows) if rows else ((), (), (), ())
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)],
                                          names=["_id", "url", "text", "n_chars"])

    for batch in batches:
        rows = []
        heads = zip(*(batch.column(c).to_pylist() for c in ("_slice", "_lent", "_id", "url", "host", "path")))
        for (slice_, lent, id_, url, host, path), page in zip(heads, arrays.raw_texts(batch.column("html"))):
            lines = page_lines(page.decode("utf-8", "replace")) if page else []
            coming = {"_slice": slice_, "_lent": lent, "_id": id_, "url": url, "host": host, "path": path,
                      "lines": lines}
            same = now is not None and now["_slice"] == slice_
            if now is not None and not now["_lent"]:
                rows.append(done(now, coming if same else None))
            before, now = now if same else None, coming
        yield batch_of(rows)
    yield batch_of([done(now, None)] if now is not None and not now["_lent"] else [])


_KEYS = ("host", "path", "_url", "_number")


def _slices(pages: DataFrame) -> DataFrame:
    """Every page in its slice of the order by ``_KEYS``, and lent to each slice the page of the same host
    just before its first and just after its last, so that no pair is cut.

    The ends of the slices, a row for each, are found on the keys alone and written.
    """
    most = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = max(1, min(most, pages.count() // SLICE_ROWS))
    key = F.struct(*_KEYS)
    ends = written(pages.select(key.alias("key")).repartitionByRange(slices, "key")
                   .groupBy(F.spark_partition_id().alias("part"))
                   .agg(F.min("key").alias("first"), F.max("key").alias("last")), "page-slices")
    ends = ends.agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("ends"))
    placed = pages.crossJoin(F.broadcast(ends)).withColumns({
        "_slice": F.size(F.filter("ends", lambda end: end["first"] <= key)), "_lent": F.lit(False)}).drop("ends")
    borders = F.transform(
        F.slice("ends", 2, F.greatest(F.size("ends") - 1, F.lit(0))),
        lambda end, i: F.struct(F.get("ends", i)["last"].alias("before"), end["first"].alias("after"),
                                (i + 2).alias("slice")))
    borders = ends.select(F.inline(borders)).where("before.host = after.host")
    wanted = borders.select(F.inline(F.array(
        F.struct(F.col("before").alias("key"), F.col("slice").alias("_slice"), F.lit(True).alias("last")),
        F.struct(F.col("after").alias("key"), (F.col("slice") - 1).alias("_slice"), F.lit(False).alias("last")),
    ))).select("key.*", "_slice", "last")
    # Of pages that tie in all keys the one next to the border.
    near = F.when(F.col("last"), F.col("_hash")).otherwise(F.bitwise_not("_hash"))
    lent = (pages.join(F.broadcast(wanted), list(_KEYS)).groupBy("_slice", "last")
            .agg(F.max_by(F.struct(*pages.columns), near).alias("page"))
            .select("page.*", "_slice", F.lit(True).alias("_lent")))
    return placed.unionByName(lent)


def html_extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The main text of every whole page.

    Returns one row per row of ``df``: the id, ``url``, ``text`` (lines joined by a newline, empty
    if none stays) and ``n_chars`` (its code points). Character references are decoded, blanks
    inside a line are one space. A null page is empty. A null URL has an empty host and path,
    under which such pages are neighbours. Ties of host and path go by URL, then id, then a hash of
    the page, so pairs do not depend on the partitions; a page alone of its host is not
    differenced. Repeated rows are pages like any other; an empty table gives no rows.
    """
    small_batches(df.sparkSession)
    pages = df.select(F.col(id_col).cast("long").alias("_id"), F.col(url_col).cast("string").alias("url"),
                      F.col(html_col).cast("string").alias("html"))
    pages = pages.withColumns({
        "host": host_of(F.col("url")), "path": path_of(F.col("url")), "_url": F.coalesce("url", F.lit("")),
        "_number": F.coalesce("_id", F.lit(-2**63)), "_hash": F.xxhash64("html")})
    return (_slices(pages).repartitionByRange("_slice").sortWithinPartitions("_slice", *_KEYS, "_hash")
            .mapInArrow(_extract, "_id long, url string, text string, n_chars long")
            .withColumnRenamed("_id", id_col).withColumnRenamed("url", url_col))
