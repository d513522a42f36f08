"""Benchmark decontamination by the q-gram lemma, confirmed by banded alignment.

A passage within ``k`` edits of an item of ``m`` characters shares at least
``m + 1 - q (k + 1)`` character q-grams with it, all on diagonals (place in the text minus place
in the item) at most ``k`` away from the passage's own. So shared q-grams are counted
in bands of diagonals, each ``3 k + 1`` wide and overlapping its neighbours, and only a band
with enough of them is aligned, inside that band.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm import arrays
from landfall.llm.common import filter_by_text, text_rows, which_text

GRAM = 8
BUDGET = 0.10               # edits per character of an item
BLOCK_CHARS = 1_000_000     # of items held by a task at once; more items go in more passes
_PIECE = 1 << 20
_BITS = 20
_ZERO = 1 << 30            # keeps diagonals positive


def plain(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points in lower case with each run of blanks as one space, none at the ends,
    and the place of each in the text. A character whose lower case is not one code point stays as it is."""
    low = text.lower()
    if len(low) == len(text):
        points = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
    else:
        odd = [ord(c) for c in set(text) if len(c.lower()) != 1]
        # A letter stands in for them, so that the others are folded as they are beside letters.
        low = text.translate(dict.fromkeys(odd, "I")).lower()
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        points = np.where(np.isin(points, odd), points,
                          np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32))
    blank = (points == 32) | ((points >= 9) & (points <= 13)) | (points == 160)
    keep = ~blank
    keep[1:] |= blank[1:] & ~blank[:-1]
    at = np.flatnonzero(keep)
    out = np.where(blank[at], 32, points[at])
    first, last = 0, len(out)
    if last and out[0] == 32:
        first = 1
    if last > first and out[-1] == 32:
        last -= 1
    return out[first:last], at[first:last]


@dataclass(frozen=True)
class Index:
    """The q-grams of some items, and where each occurs."""

    ids: list[int | None]
    items: list[np.ndarray]
    budgets: np.ndarray
    needed: np.ndarray
    grams: np.ndarray        # distinct, ascending
    first: np.ndarray        # of its places
    owner: np.ndarray
    place: np.ndarray
    maybe: np.ndarray        # bitmap over the top bits of a gram
    short: list[int]         # items too short for a q-gram, looked up as they are


def budget(length: int, share: float, gram: int) -> int:
    """Edits allowed: the share of the length, as far as the lemma still asks for a q-gram."""
    return max(0, min(int(share * length), length // gram - 1))


def build_index(rows: list[tuple[int | None, str]], share: float, gram: int) -> Index:
    ids = [i for i, _ in rows]
    items = [plain(text)[0] for _, text in rows]
    budgets = np.array([budget(len(p), share, gram) for p in items], np.int64)
    needed = np.array([len(p) + 1 - gram * (k + 1) for p, k in zip(items, budgets)], np.int64)
    grams = [arrays.byte_gram_hashes(p, gram) for p in items]
    owner = np.repeat(np.arange(len(items)), [len(g) for g in grams])
    place = np.concatenate([np.arange(len(g)) for g in grams] or [np.zeros(0, np.int64)])
    every = np.concatenate(grams or [np.zeros(0, np.uint64)])
    order = np.argsort(every, kind="stable")
    distinct, first = np.unique(every[order], return_index=True)
    maybe = np.zeros(1 << _BITS, bool)
    maybe[(distinct >> np.uint64(64 - _BITS)).astype(np.int64)] = True
    return Index(ids, items, budgets, needed, distinct, np.append(first, len(every)),
                 owner[order], place[order], maybe,
                 [i for i, p in enumerate(items) if 0 < len(p) < gram])


def align(item: np.ndarray, text: np.ndarray, low: int, high: int, most: int) -> tuple[int, int] | None:
    """``(edits, end)`` of the best match of the item on diagonals ``low`` to ``high`` of the
    text, the earliest end among equals; None beyond ``most`` edits."""
    width = high - low + 1
    ramp = np.arange(width)
    far = len(item) + width + 1
    # Row 0: a match may start on any diagonal that lies in the text.
    row = np.where((ramp + low >= 0) & (ramp + low <= len(text)), 0, far)
    for i, symbol in enumerate(item, 1):
        spot = ramp + low + i - 1                  # the text's place that a diagonal compares
        inside = (spot >= 0) & (spot < len(text))
        same = np.zeros(width, bool)
        same[inside] = text[spot[inside]] == symbol
        step = np.where(inside, row + ~same, far)
        step[:-1] = np.minimum(step[:-1], row[1:] + 1)      # the item's symbol is left out
        step = np.where((spot >= -1) & (spot < len(text)), step, far)
        row = np.minimum.accumulate(step - ramp) + ramp     # a symbol of the text is left out
        row = np.where((spot >= -1) & (spot < len(text)), row, far)
        if not i & 7 and row.min() > most:
            return None
    best = int(row.argmin())
    if row[best] > most:
        return None
    return int(row[best]), best + low + len(item)


def passages(text: np.ndarray, index: Index, gram: int) -> list[tuple[int, int, int, int]]:
    """``(item, start, end, edits)`` of each passage of a plain text, best of those that overlap."""
    found: list[tuple[int, int, int, int]] = []
    longest = max((len(p) for p in index.items), default=0)
    for base in range(0, max(len(text), 1), _PIECE):
        part = text[base:base + _PIECE + 2 * longest]
        found += [(i, a + base, b + base, e) for i, a, b, e in _in_piece(part, index, gram)]
    found.sort(key=lambda m: (m[0], m[3], m[1], m[2]))
    best: list[tuple[int, int, int, int]] = []
    mine: list[tuple[int, int]] = []
    for match in found:
        if best and best[-1][0] != match[0]:
            mine = []
        if all(match[2] <= a or match[1] >= b for a, b in mine):
            best.append(match)
            mine.append(match[1:3])
    return sorted(best)


def _in_piece(text: np.ndarray, index: Index, gram: int) -> Iterator[tuple[int, int, int, int]]:
    for i in index.short:
        item = index.items[i]
        hay, needle = text.astype("<u4").tobytes(), item.astype("<u4").tobytes()
        at = hay.find(needle)
        while at >= 0:
            if at % 4 == 0:
                yield i, at // 4, at // 4 + len(item), 0
            at = hay.find(needle, at + 1)
    grams = arrays.byte_gram_hashes(text, gram)
    if not len(grams) or not len(index.grams):
        return
    spots = np.flatnonzero(index.maybe[(grams >> np.uint64(64 - _BITS)).astype(np.int64)])
    where = np.searchsorted(index.grams, grams[spots])
    where[where == len(index.grams)] = 0
    hit = index.grams[where] == grams[spots]
    spots, where = spots[hit], where[hit]
    if not len(spots):
        return
    many = index.first[where + 1] - index.first[where]
    entry = np.repeat(index.first[where] - np.cumsum(many) + many, many) + np.arange(many.sum())
    item = index.owner[entry]
    # An item with too few hits in all has no band with enough.
    enough = (np.bincount(item, minlength=len(index.items)) >= index.needed)[item]
    if not enough.any():
        return
    entry, item = entry[enough], item[enough]
    diagonal = np.repeat(spots, many)[enough] - index.place[entry]
    # Bands: three bins in a row, a bin as wide as the item's budget.
    wide = np.maximum(index.budgets[item], 1)
    key = (item << 32) + (diagonal + _ZERO) // wide
    order = np.argsort(key, kind="stable")
    key, diagonal, place = key[order], diagonal[order], index.place[entry[order]]
    bins, first, counts = np.unique(key, return_index=True, return_counts=True)
    around = counts.copy()
    for shift in (1, 2):
        at = np.searchsorted(bins, bins + shift)
        at[at == len(bins)] = 0
        around += np.where(bins[at] == bins + shift, counts[at], 0)
    # A band whose first bin is empty holds no more than the one that starts on its next bin.
    likely = bins[around >= index.needed[bins >> 32]]
    last = None
    for start in likely.tolist():
        if last is not None and start <= last:
            continue
        last = start + 3                       # bands this near are aligned together
        i = start >> 32
        item_points, k = index.items[i], max(int(index.budgets[i]), 1)
        held = slice(*np.searchsorted(key, [start, last + 3]))
        if len(np.unique(place[held])) < index.needed[i]:
            continue
        ways, times = np.unique(diagonal[held], return_counts=True)
        exact = [d for d in ways[times >= len(item_points) + 1 - gram].tolist()
                 if 0 <= d and np.array_equal(text[d:d + len(item_points)], item_points)]
        if exact:
            yield from ((i, d, d + len(item_points), 0) for d in exact)
            continue
        low = (start & 0xFFFFFFFF) * k - _ZERO
        match = align(item_points, text, low - k, low + 7 * k, int(index.budgets[i]))
        if match:
            edits, end = match
            back = align(item_points[::-1], text[:end][::-1], -edits, edits, edits)
            yield i, end - back[1], end, edits


def _search(index: Index, gram: int):
    schema = pa.schema([("_id", pa.int64()), ("_which", pa.int32()), ("item", pa.int64()),
                        ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = [], []
            for row, text in enumerate(batch.column("_text")):
                if text.is_valid and (text := text.as_py()):
                    points, at = plain(text)
                    for i, start, end, edits in passages(points, index, gram):
                        rows.append(row)
                        found.append((index.ids[i], int(at[start]), int(at[end - 1]) + 1, edits))
            rows = pa.array(rows, pa.int64())
            columns = [pa.array([f[c] for f in found], pa.int64()) for c in range(4)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id").take(rows), batch.column("which").take(rows), *columns], schema=schema)

    return run


def indexes(benchmark: DataFrame, item_id: str = "item_id", item_text: str = "text", *,
            share: float = BUDGET, gram: int = GRAM, block_chars: int = BLOCK_CHARS) -> list[Index]:
    """The items' q-grams, in as many blocks as their characters need; one block at least."""
    items = benchmark.select(F.col(item_id).cast("long").alias("item"),
                             F.col(item_text).cast("string").alias("text")).where("length(text) > 0")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    out = []
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).orderBy("item", "text")
        out.append(build_index([(r.item, r.text) for r in part.collect()], share, gram))
    return out


def drop_contaminated(df: DataFrame, benchmark: DataFrame, text_col: str = "text", *, item_id: str = "item_id",
                      item_text: str = "text", share: float = BUDGET, gram: int = GRAM,
                      block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``df`` in which ``find_passages`` finds nothing, all columns as they are."""
    out = df
    for index in indexes(benchmark, item_id, item_text, share=share, gram=gram, block_chars=block_chars):
        def clean(texts: list[bytes | None], index: Index = index) -> list[bool]:
            return [not text or not passages(plain(text.decode())[0], index, gram) for text in texts]

        out = filter_by_text(out, text_col, clean)
    return out


def find_passages(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                  item_id: str = "item_id", item_text: str = "text", share: float = BUDGET,
                  gram: int = GRAM, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Passages of ``df`` that come from a benchmark, exact or within the edit budget.

    Returns a row per passage: the id, the item's id under its own name, ``start`` and
    ``end`` (code points of the text, end excluded), ``edits``, ``contaminated`` (true) and
    ``_which`` (a hash of the text). Case and the length of runs of blanks don't count. Of passages of one item
    that overlap the one of fewest edits is given. Null and empty texts and items match
    nothing; an item shorter than a q-gram is looked up as it is; repeated texts and repeated
    items match each for itself. An empty table on either side gives no rows.

    Items are held by the tasks ``block_chars`` at a time; a larger benchmark takes several passes
    over the texts.
    """
    rows = text_rows(df, id_col, text_col).select("_id", which_text().alias("which"), "_text")
    out = None
    for index in indexes(benchmark, item_id, item_text, share=share, gram=gram, block_chars=block_chars):
        found = rows.mapInArrow(_search(index, gram), "_id long, _which int, item long, "
                                "start long, end long, edits long")
        out = found if out is None else out.unionAll(found)
    return out.select(F.col("_id").alias(id_col), F.col("item").alias(item_id), "start", "end", "edits",
                      F.lit(True).alias("contaminated"), "_which")
