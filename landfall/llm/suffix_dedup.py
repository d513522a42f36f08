"""Repeated byte strings, found by column-wise suffix sorting of many strings at once.

Every string of ``window`` bytes is owned by its anchor, the least gram hash inside
it: equal strings have equal anchors at the same place, so only texts around one anchor need
be sorted together. Anchors that occur once are left out by a count. Around the others a
segment of at most 368 bytes holds the strings that the anchor owns; equal segments are one.
What is left are segments that differ but share an anchor.

They are sorted in collections of a bounded number of strings, whole anchors at a time, laid
under each other so that their anchors stand in one column. Each round goes one column to the
left and puts one symbol of every string before its suffix: a stable sort of the suffixes by
these symbols, that is by the collection's Burrows-Wheeler transform at this column, gives
their new order, and the common prefixes of neighbours follow from the least of those between
two rows of one symbol. A round reads the arrays of the last one front to back and writes its own. A
suffix with a neighbour that agrees on ``window`` bytes starts a repeated string. The files
between steps are Spark's shuffles and tables, so an anchor of any frequency is spread over
tasks: beyond ``MOST`` different segments an anchor's strings are dealt by their own hash and counted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm import arrays
from landfall.llm.common import text_rows, which_text, written
from landfall.operators.joins import splittable

WINDOW = 200
GRAM = 32
COLLECTION = 8192   # strings sorted together, more only if one anchor has more
MOST = 100_000      # different segments of one anchor sorted in one task
_PIECE = 1 << 20
_PLACE = np.uint64((1 << 24) - 1)


def anchors(raw: np.ndarray, window: int = WINDOW, gram: int = GRAM):
    """``(key, start, count, at)`` of runs of windows that one anchor owns, in order; ``at`` is
    the anchor's distance from the first window's start."""
    keys, starts, counts, ats = [], [], [], []
    for first in range(0, len(raw) - window + 1, _PIECE):
        grams = arrays.byte_gram_hashes(raw[first:first + _PIECE + window - 1], gram)
        least = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        span, wide = window - gram + 1, 1
        while wide * 2 <= span:
            least = np.minimum(least[:-wide], least[wide:])
            wide *= 2
        if wide < span:
            least = np.minimum(least[:len(least) - (span - wide)], least[span - wide:])
        place = (least & _PLACE).astype(np.int64)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1])
        keys.append(grams[place[cuts]])
        starts.append(cuts + first)
        counts.append(np.diff(np.append(cuts, len(place))))
        ats.append(place[cuts] - cuts)
    if not keys:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none
    return tuple(map(np.concatenate, (keys, starts, counts, ats)))


def _halves(digest: bytes) -> tuple[int, int]:
    return (int.from_bytes(digest[:8], "little", signed=True),
            int.from_bytes(digest[8:], "little", signed=True))


def _anchor_keys(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [anchors(np.frombuffer(text, np.uint8), window)[0]
                     for text in arrays.raw_texts(batch.column("_text")) if text]
            keys = np.concatenate(found) if found else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], names=["key"])

    return run


def _segments(window: int):
    schema = pa.schema([("key", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()),
                        ("_id", pa.int64()), ("which", pa.int32()), ("start", pa.int64()),
                        ("shape", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keys, starts, shapes, digests = [], [], [], [], []
            for row, text in enumerate(arrays.raw_texts(batch.column("_text"))):
                if not text:
                    continue
                key, start, count, at = anchors(np.frombuffer(text, np.uint8), window)
                rows.append(np.full(len(key), row))
                keys.append(key)
                starts.append(start)
                shapes.append((count << 10) + at)
                digests += [xxhash.xxh3_128_digest(text[a:b])
                            for a, b in zip(start.tolist(), (start + count + window - 1).tolist())]
            if not keys:
                continue
            at = pa.array(np.concatenate(rows))
            both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys).view(np.int64)), pa.array(both[:, 0]),
                 pa.array(both[:, 1]), batch.column("_id").take(at), batch.column("which").take(at),
                 pa.array(np.concatenate(starts)), pa.array(np.concatenate(shapes).astype(np.int32))],
                schema=schema)

    return run


def repeated_starts(strings: list[bytes], group: np.ndarray, at: np.ndarray, window: int) -> list[np.ndarray]:
    """For each string the starts of its windows that another of its group has at the same
    distance from its anchor, which stands ``at`` that place. ``group`` numbers are ascending.

    Column by column: a round puts the symbols of one column before the suffixes.
    """
    count = len(strings)
    sizes = np.array([len(s) for s in strings])
    text = np.frombuffer(b"".join(strings), np.uint8)
    zero = np.cumsum(sizes) - sizes + at            # where each string's anchor stands in the text
    joins = np.argsort(-(sizes - at), kind="stable")
    reach = (sizes - at)[joins]                     # columns at and after the anchor, longest first
    rows, lcp, joined = np.zeros(0, np.int64), np.zeros(0, np.uint16), 0
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for column in range(int(reach[0]) - 1, -int(at.max()) - 1, -1):
        # Strings that begin here (an empty suffix stands last), and those that go on.
        upto = int(np.searchsorted(-reach, -column, "left"))
        fresh, joined = joins[joined:upto], upto
        old = np.flatnonzero(at[rows] >= -column)
        ids = np.concatenate([rows[old], fresh])
        if not len(ids):
            rows, lcp = ids, lcp[:0]
            continue
        key = (group[ids] << 8) + text[zero[ids] + column]
        order = np.argsort(key, kind="stable")
        rows, key = ids[order], key[order]
        before = np.concatenate([old, np.full(len(fresh), -1)])[order]
        # Rows of one symbol that both went on: the least prefix on the rows between them.
        pair = np.flatnonzero((key[1:] == key[:-1]) & (before[1:] >= 0)) + 1
        grown = np.zeros(len(rows), np.uint16)
        if len(pair):
            bounds = np.empty(2 * len(pair), np.int64)
            bounds[::2] = before[pair - 1] + 1
            bounds[1::2] = before[pair] + 1
            least = np.minimum.reduceat(np.append(lcp, np.uint16(0)), bounds)[::2]
            grown[pair] = least
        same = np.flatnonzero(key[1:] == key[:-1]) + 1
        grown[same] += 1
        lcp = grown
        long = lcp >= window
        if long.any():
            long[:-1] |= long[1:]
            hit = rows[long]
            found.append((hit, column + at[hit]))
    if not found:
        return [np.zeros(0, np.int64)] * count
    who, where = (np.concatenate(part) for part in zip(*found))
    order = np.lexsort((where, who))
    cuts = np.searchsorted(who[order], np.arange(count + 1))
    return [where[order[a:b]] for a, b in zip(cuts, cuts[1:])]


def _spans(starts: np.ndarray) -> list[int]:
    """Runs of consecutive starts as first, count, first, count, ..."""
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(starts) != 1) + 1, [len(starts)]])
    return np.stack([starts[cuts[:-1]], np.diff(cuts)], axis=1).reshape(-1).tolist()


def _sort_collections(window: int):
    """Over rows sorted by anchor: sort collections of whole anchors, give repeated spans."""
    schema = pa.schema([("key", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()),
                        ("spans", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[tuple[int, int, int]] = []
        strings: list[bytes] = []
        places: list[int] = []

        def flush(end: int) -> pa.RecordBatch:
            out: tuple[list, ...] = ([], [], [], [])
            keys = np.array([name[0] for name in names[:end]])
            group = np.cumsum(np.diff(keys, prepend=keys[0]) != 0)
            at = np.array(places[:end])
            for name, starts in zip(names, repeated_starts(strings[:end], group, at, window)):
                if len(starts):
                    for column, value in zip(out, (*name, _spans(starts))):
                        column.append(value)
            del names[:end], strings[:end], places[:end]
            return pa.RecordBatch.from_arrays(
                [pa.array(column, field.type) for column, field in zip(out, schema)], schema=schema)

        last = None
        for batch in batches:
            ids = zip(*(batch.column(c).to_pylist() for c in ("key", "s1", "s2")))
            for name, at, piece in zip(ids, batch.column("at").to_pylist(),
                                       arrays.raw_texts(batch.column("piece"))):
                if name[0] != last and len(strings) >= COLLECTION:
                    yield flush(len(strings))
                last = name[0]
                names.append(name)
                places.append(at)
                strings.append(piece)
        if strings:
            yield flush(len(strings))

    return run


def _cut(window: int):
    """The bytes of the wanted segments of each text."""
    schema = pa.schema([("key", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()),
                        ("at", pa.int32()), ("piece", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column("wanted")
            flat = wanted.flatten()
            starts = flat.field("start").to_pylist()
            shape = flat.field("shape").to_numpy()
            counts, places = (shape >> 10).tolist(), pa.array(shape & 1023, pa.int32())
            sizes = np.diff(wanted.offsets.to_numpy()).tolist()
            done, cut = 0, []
            for text, size in zip(arrays.raw_texts(batch.column("_text")), sizes):
                cut += [text[starts[i]:starts[i] + counts[i] + window - 1]
                        for i in range(done, done + size)]
                done += size
            for first in range(0, len(cut), 4096):
                part = slice(first, first + 4096)
                yield pa.RecordBatch.from_arrays(
                    [*(flat.field(c)[part] for c in ("key", "s1", "s2")), places[part],
                     pa.array(cut[part], pa.binary())], schema=schema)

    return run


def _windows(window: int):
    """Each window of a segment by its own hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.select(["key", "s1", "s2"])
            for row, piece in enumerate(arrays.raw_texts(batch.column("piece"))):
                count = len(piece) - window + 1
                both = np.frombuffer(b"".join(
                    xxhash.xxh3_128_digest(piece[i:i + window]) for i in range(count)), "<i8")
                at = pa.array(np.full(count, row))
                yield pa.RecordBatch.from_arrays(
                    [*(column.take(at) for column in ids.columns), pa.array(both[::2]),
                     pa.array(both[1::2]), pa.array(np.arange(count, dtype=np.int32))],
                    names=["key", "s1", "s2", "w1", "w2", "at"])

    return run


def remove_spans(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """The text without the spans (merged where they touch), and how many there were."""
    kept, done, count = [], 0, 0
    last = -1
    for start, end in sorted(spans):
        if start > last:
            count += 1
            kept.append(text[done:start])
        last = done = max(last, end)
    kept.append(text[done:])
    return b"".join(kept), count


def _byte_spans(found: list[dict] | None, window: int) -> list[tuple[int, int]]:
    """First and last byte (excluded) of what repeats, from the anchors' windows."""
    spans = []
    for run in found or ():
        inner = run["spans"] if run["spans"] is not None else [0, run["n"]]
        spans += [(run["start"] + a, run["start"] + a + n + window - 1)
                  for a, n in zip(inner[::2], inner[1::2])]
    return spans


def _remove(window: int):
    names = ["_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "_which"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("found").to_pylist()
            out: list[list] = [[] for _ in range(4)]
            for text, runs in zip(arrays.raw_texts(batch.column("_text")), found):
                text = text or b""
                kept, count = remove_spans(text, _byte_spans(runs, window))
                row = len(text), len(text) - len(kept), count, hashlib.sha256(kept).hexdigest()
                for column, value in zip(out, row):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), *(pa.array(c, pa.int64()) for c in out[:3]),
                 pa.array(out[3], pa.string()), batch.column("which")], names=names)

    return run


def repeated_spans(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(_id, which, start, n, spans)``: from ``start`` on, ``n`` windows are of one anchor;
    those in ``spans`` (all, if null) also start elsewhere."""
    rows = rows.select("_id", which_text().alias("which"), "_text").where(
        F.octet_length("_text") >= window)
    keys = rows.select("_text").mapInArrow(_anchor_keys(window), "key long")
    shared = keys.groupBy("key").agg(F.count("*").alias("many")).where("many > 1").select("key")
    segments = rows.mapInArrow(
        _segments(window), "key long, s1 long, s2 long, _id long, which int, start long, shape int")
    found = written(segments.join(splittable(shared, ["key"]), "key", "left_semi"), "segments")
    different = written(found.groupBy("key", "s1", "s2").agg(
        F.count("*").alias("many"), F.min(F.struct("_id", "which", "start", "shape")).alias("first")),
        "different")
    mixed = different.groupBy("key").agg(F.count("*").alias("kinds")).where("kinds > 1")
    wanted = different.join(splittable(mixed, ["key"]), "key").select(
        F.col("first._id").alias("_id"), F.col("first.which").alias("which"),
        F.struct("key", "s1", "s2", F.col("first.start").alias("start"),
                 F.col("first.shape").alias("shape")).alias("one"))
    by_text = wanted.groupBy(F.col("_id").alias("id"), F.col("which").alias("w")).agg(
        F.collect_list("one").alias("wanted"))
    holds = rows["_id"].eqNullSafe(by_text["id"]) & (rows["which"] == by_text["w"])
    pieces = written(rows.join(by_text, holds).select("_text", "wanted").mapInArrow(
        _cut(window), "key long, s1 long, s2 long, at int, piece binary"), "pieces")
    often = mixed.where(F.col("kinds") > MOST).select("key")
    spans = (pieces.join(often, "key", "left_anti").repartition("key").sortWithinPartitions("key")
             .mapInArrow(_sort_collections(window), "key long, s1 long, s2 long, spans array<int>"))
    single = pieces.join(often, "key", "left_semi").mapInArrow(
        _windows(window), "key long, s1 long, s2 long, w1 long, w2 long, at int")
    twice = single.groupBy("w1", "w2").agg(F.count("*").alias("many")).where("many > 1")
    hot = (single.join(twice, ["w1", "w2"], "left_semi").groupBy("key", "s1", "s2")
           .agg(F.flatten(F.array_sort(F.collect_list(F.array("at", F.lit(1))))).alias("spans")))
    partly = written(spans.unionAll(hot), "spans")
    # A segment that occurs twice is repeated whole, whatever the sorting says.
    all_of = different.where("many > 1").select("key", "s1", "s2", F.lit(None).cast("array<int>").alias("spans"))
    some = partly.join(all_of.select("key", "s1", "s2"), ["key", "s1", "s2"], "left_anti")
    repeated = splittable(all_of.unionAll(some), ["key", "s1", "s2"])
    return (found.join(repeated, ["key", "s1", "s2"])
            .select("_id", "which", "start", F.shiftright("shape", 10).alias("n"), "spans"))


def _with_found(rows: DataFrame, keyed: DataFrame, window: int) -> DataFrame:
    """``keyed`` (which has ``_id`` and ``which``) with what repeats in each row's text."""
    spans = repeated_spans(rows, window)
    found = spans.groupBy(F.col("_id").alias("_by"), F.col("which").alias("_w")).agg(
        F.collect_list(F.struct("start", "n", "spans")).alias("found"))
    return keyed.join(found, keyed["_id"].eqNullSafe(found["_by"]) & (keyed["which"] == found["_w"]), "left")


def suffix_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                 window: int = WINDOW) -> DataFrame:
    """Remove each byte of a string of ``window`` bytes that also starts anywhere else.

    Returns one row per row of ``df``: the id, ``n_bytes``, ``n_removed``, ``n_spans``
    (maximal removed runs), ``kept_sha256`` and ``_which`` (a hash of the text).
    Strings do not cross texts and are judged on the input, the same text included. A
    null text counts as empty; texts shorter than ``window`` stay whole; rows that repeat,
    or lack an id, are texts like any other. An empty table gives no rows.
    """
    rows = text_rows(df, id_col, text_col)
    joined = _with_found(rows, rows.select("_id", which_text().alias("which"), "_text"), window)
    schema = "_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, _which int"
    return (joined.select("_id", "which", "_text", "found").mapInArrow(_remove(window), schema)
            .withColumnRenamed("_id", id_col))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                   chars_col: str | None = "n_chars", window: int = WINDOW) -> DataFrame:
    """The rows of ``df`` with their texts as ``suffix_dedup`` leaves them, other columns as they are.

    A character that a cut splits is dropped. ``chars_col``, where the table has it, is set to the
    code points that are left; null texts stay null.
    """
    rows = text_rows(df, id_col, text_col)
    packed = df.select(F.struct("*").alias("_row"), F.col(id_col).cast("long").alias("_id"),
                       F.col(text_col).cast("string").alias("_text"))
    keyed = packed.select("_row", "_id", which_text().alias("which"), "_text")
    columns, schema = df.columns, df.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, runs in zip(arrays.raw_texts(batch.column("_text")), batch.column("found").to_pylist()):
                spans = _byte_spans(runs, window)
                texts.append(text if text is None or not spans
                             else remove_spans(text, spans)[0].decode("utf-8", "ignore").encode())
            kept = pa.array(texts, pa.binary()).cast(pa.string())
            out = dict(zip(columns, batch.column("_row").flatten()))
            out[text_col] = kept
            if chars_col in out:
                counts = pa.array([None if t is None else len(t.decode()) for t in texts], pa.int64())
                out[chars_col] = counts.cast(out[chars_col].type)
            yield pa.RecordBatch.from_arrays([out[c] for c in columns], names=columns)

    return (_with_found(rows, keyed, window).select("_row", "_text", "found").mapInArrow(run, schema))
