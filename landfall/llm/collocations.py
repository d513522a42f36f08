"""Phrase collocation mining by SETM: occurrence relations, counted, semi-joined, merged.

R(k) holds the occurrences of phrases of ``k`` words, sorted by piece and place. Each round merges
R(k-1) with itself shifted by one place into the occurrences of phrases one word longer, counts
their groups over all texts, and keeps the occurrences of those groups that may be frequent
(a semi-join) as R(k), from which the groups are then counted exactly.

A relation is a written table of blocks (see ``blocks``): occurrences as numbers by place, and the
list of groups they number. Adjacent places are adjacent numbers, so merging two sorted
relations compares neighbours. Most phrases of a language are rare, so they never travel as text:
a block sends the sorted hashes of its groups with their counts, cut into ranges; the runs of a
range are merged and counted, and each block learns which of its groups reach the least count.
Hashes that clash only let more groups through to the exact count. A word that makes a third
of all rows is one entry per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.arrays import mix
from landfall.llm.blocks import (
    block_number, byte_classes, cut_words, gathered, pack_numbers, pack_words, text_hashes, unpack_numbers,
    unpack_words,
)
from landfall.llm.common import remove_folder, small_batches, written
from landfall.operators.joins import splittable
from landfall.session import scratch_folder

CLASSES = byte_classes(b" \t", b".,;:!?\n\x0b\x0c\r")
RELATION = "block bigint, lang string, codes binary, words binary, places bigint, n bigint"
NONE = -1            # between pieces, and where no group that may be frequent starts
HASH_BITS = 48
RANGE_GROUPS = 1 << 21   # what one range of hashes is to hold
SHARES = 32              # a language's candidates are ranked in so many shares first


def _row(block: int, lang: str, codes: np.ndarray, words: pa.Array) -> pa.RecordBatch:
    return pa.record_batch({
        "block": pa.array([block], pa.int64()), "lang": pa.array([lang], pa.string()),
        "codes": pa.array([pack_numbers(codes)], pa.binary()), "words": pa.array([pack_words(words)], pa.binary()),
        "places": pa.array([len(codes)], pa.int64()), "n": pa.array([int((codes >= 0).sum())], pa.int64())})


def word_occurrences(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """Every word of every text, by language; a break of pieces is a place without a word."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for made, (lang, held) in enumerate(gathered(batches, "text", "lang")):
            words, _, piece = cut_words([raw for _, raw in held], CLASSES)
            numbers = words.indices.to_numpy()
            places = np.arange(len(numbers))
            if len(numbers):
                places[1:] += np.cumsum(piece[1:] != piece[:-1])
            codes = np.full(places[-1] + 1 if len(places) else 0, NONE, np.int32)
            codes[places] = numbers
            yield _row(block_number(made), lang, codes, words.dictionary)

    return rows.mapInArrow(run, RELATION)


class Groups:
    """The groups of one block at the next length: merged from its relation, or its words."""

    def __init__(self, lang: str, codes: bytes, words: bytes, merge: bool, bits: int):
        self.codes = unpack_numbers(codes)
        letters, self.words = unpack_words(words)
        hashes = text_hashes(letters, self.words)
        self.parts = None
        if merge:
            here = np.flatnonzero((self.codes[:-1] >= 0) & (self.codes[1:] >= 0))
            pairs = self.codes[here].astype(np.int64) * max(len(self.words), 1) + self.codes[here + 1]
            groups, numbers = np.unique(pairs, return_inverse=True)
            self.codes = np.full(max(len(self.codes) - 1, 0), NONE, np.int32)
            self.codes[here] = numbers
            self.parts = groups // max(len(self.words), 1), groups % max(len(self.words), 1)
            hashes = mix(hashes[self.parts[0]] * np.uint64(0x9E3779B97F4A7C15) + hashes[self.parts[1]])
        hashes = mix(hashes ^ np.uint64(xxhash.xxh64_intdigest(lang.encode())))
        self.hashes = hashes >> np.uint64(64 - bits)
        self.order = np.argsort(self.hashes, kind="stable")
        self.counts = np.bincount(self.codes[self.codes >= 0], minlength=len(hashes))

    def phrases(self, kept: np.ndarray) -> pa.Array:
        if self.parts is None:
            return self.words.take(pa.array(kept))
        first, second = (self.words.take(pa.array(part[kept])) for part in self.parts)
        last = pc.replace_substring_regex(second, r"^(?s:.)* ", "")
        return pc.binary_join_element_wise(first, last, pa.scalar(" ", pa.string()))


def hash_runs(relation: DataFrame, merge: bool, ranges: int, bits: int) -> DataFrame:
    """``(span, block, hashes, counts)``: each block's groups as sorted hashes, by range of hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                groups = Groups(row["lang"], row["codes"], row["words"], merge, bits)
                hashes, counts = groups.hashes[groups.order], groups.counts[groups.order]
                spans = (hashes >> np.uint64(bits - (ranges - 1).bit_length())).astype(np.int64)
                cuts = np.flatnonzero(np.r_[True, spans[1:] != spans[:-1]][:len(spans)])
                rows = [(spans[a], pack_numbers(np.diff(hashes[a:b], prepend=np.uint64(0))),
                         pack_numbers(counts[a:b].astype(np.int64)))
                        for a, b in zip(cuts, [*cuts[1:], len(spans)], strict=False)]
                yield pa.record_batch({
                    "span": pa.array([r[0] for r in rows], pa.int64()),
                    "block": pa.array([row["block"]] * len(rows), pa.int64()),
                    "hashes": pa.array([r[1] for r in rows], pa.binary()),
                    "counts": pa.array([r[2] for r in rows], pa.binary())})

    return relation.select("block", "lang", "codes", "words").mapInArrow(
        run, "span bigint, block bigint, hashes binary, counts binary")


def count_runs(least: int):
    """Merge the runs of one range and count: for each block, which of its groups may be frequent."""

    def run(runs: pa.Table) -> pa.Table:
        hashes = [np.cumsum(unpack_numbers(v, np.uint64), dtype=np.uint64) for v in runs.column("hashes").to_pylist()]
        counts = np.concatenate([unpack_numbers(v, np.int64) for v in runs.column("counts").to_pylist()])
        merged = np.concatenate(hashes)
        order = np.argsort(merged, kind="stable")  # merges sorted runs
        starts = np.flatnonzero(np.r_[True, merged[order][1:] != merged[order][:-1]])
        totals = np.add.reduceat(counts[order], starts)
        enough = np.zeros(len(merged), bool)
        enough[order] = np.repeat(totals >= least, np.diff(np.r_[starts, len(merged)]))
        cuts = np.cumsum([len(h) for h in hashes])
        bits = [np.packbits(part).tobytes() for part in np.split(enough, cuts[:-1])]
        return pa.table({"of": runs.column("block"), "span": runs.column("span"),
                         "size": pa.array([len(h) for h in hashes], pa.int64()), "bits": pa.array(bits, pa.binary())})

    return run


def keep_groups(merge: bool, bits: int):
    """The relation of one block at the next length, without the groups that can't be frequent."""

    def run(relation: pa.Table, flags: pa.Table) -> pa.Table:
        if not relation.num_rows or not flags.num_rows:
            return relation.slice(0, 0)
        row = relation.to_pylist()[0]
        groups = Groups(row["lang"], row["codes"], row["words"], merge, bits)
        enough = np.concatenate([np.unpackbits(np.frombuffer(f["bits"], np.uint8), count=f["size"])
                                 for f in flags.sort_by("span").to_pylist()]).astype(bool)
        kept = np.sort(groups.order[enough])
        renamed = np.full(len(groups.order) + 1, NONE, np.int32)  # the last place stands for NONE
        renamed[kept] = np.arange(len(kept))
        return pa.Table.from_batches([_row(row["block"], row["lang"], renamed[groups.codes], groups.phrases(kept))])

    return run


def next_relation(relation: DataFrame, merge: bool, least: int) -> DataFrame:
    """R(k) from R(k-1), or R(1) from all words: merge by place, count, keep what may be frequent."""
    places = relation.agg(F.sum("places")).first()[0] or 0
    ranges = 1 << (max(-(-places // RANGE_GROUPS), 1) - 1).bit_length()
    flags = hash_runs(relation, merge, ranges, HASH_BITS).groupBy("span").applyInArrow(
        count_runs(least), "of bigint, span bigint, size bigint, bits binary")
    return relation.groupBy("block").cogroup(flags.groupBy("of")).applyInArrow(keep_groups(merge, HASH_BITS), RELATION)


def group_counts(relation: DataFrame, least: int) -> DataFrame:
    """``(lang, word, a)``: the groups found ``least`` times or more, counted exactly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes, (_, words) = unpack_numbers(row["codes"]), unpack_words(row["words"])
                counts = np.bincount(codes[codes >= 0], minlength=len(words)).astype(np.int64)
                yield pa.record_batch({"lang": pa.array([row["lang"]] * len(words), pa.string()),
                                       "word": words, "n": pa.array(counts, pa.int64())})

    entries = relation.select("lang", "codes", "words").mapInArrow(run, "lang string, word string, n bigint")
    return entries.groupBy("lang", "word").agg(F.sum("n").alias("a")).where(F.col("a") >= least)


def _whole(name: str) -> Column:
    return F.col(name).cast("decimal(38,0)")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", *,
                 longest: int = 3, least: int = 10, inside: int = 50, top: int = 2000) -> DataFrame:
    """The ``top`` collocations of each language, scored by their weakest cut.

    Returns ``lang, rank, phrase, a, l, r, n, score``. Phrases of 2 to ``longest`` words found
    ``least`` times or more are candidates; one whose words lie inside a longer candidate that
    is found at ``inside`` percent of its own count or more is dropped. Counts and scores are exact.

    A null text has no words and a null language is ``und``; texts without a word, or an empty
    table, give no rows. Repeated rows count as often as they occur. Ties in rank are broken by
    count, then by the phrase's bytes, so no two rows share a rank. A very long text is a block
    of its own: a task holds its numbers, never more than one such text. Other columns are not read.
    """
    spark = docs.sparkSession

    def stored(rows: DataFrame) -> tuple[DataFrame, str]:
        folder = scratch_folder(spark, "occurrences")
        rows.write.parquet(folder)
        return spark.read.schema(RELATION).parquet(folder), folder

    relation, folder = stored(word_occurrences(docs, text_col, lang_col))
    totals = written(relation.groupBy("lang").agg(F.sum("n").alias("n")), "words")
    found = []
    for size in range(1, longest + 1):
        before = folder
        relation, folder = stored(next_relation(relation, size > 1, least))
        remove_folder(spark, before)
        found.append(written(group_counts(relation, least), "phrases"))
    remove_folder(spark, folder)
    # By length: the parts of a candidate are no longer than it is, and as frequent.
    part = [p.withColumnRenamed("word", "part") for p in found]

    def split_at(size: int, k: int) -> tuple[Column, Column]:
        words = F.split("word", " ")
        return (F.array_join(F.slice(words, 1, k), " "), F.array_join(F.slice(words, k + 1, size - k), " "))

    candidates = None
    for size in range(2, longest + 1):
        rows = found[size - 1]
        for k in range(1, size):
            left, right = split_at(size, k)
            rows = rows.withColumns({"_l": left, "_r": right})
            for side, of, name in (("_l", k, f"l{k}"), ("_r", size - k, f"r{k}")):
                known = part[of - 1].select("lang", F.col("part").alias(side), F.col("a").alias(name))
                rows = rows.join(splittable(known, ["lang", side]), ["lang", side])
        # In order of score, then of k: the first cut with the least score.
        cuts = F.array_min(F.array(*[F.struct(
            F.expr(f"(1000000 * cast(a as decimal(38,0)) * cast(a as decimal(38,0))) div "
                   f"(cast(l{k} as decimal(38,0)) * cast(r{k} as decimal(38,0)))").cast("long").alias("score"),
            F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))
            for k in range(1, size)]))
        rows = rows.withColumn("_cut", cuts).select("lang", "word", "a", "_cut.l", "_cut.r", "_cut.score")
        candidates = rows if candidates is None else candidates.unionByName(rows)
    # The most frequent longer candidate around each part of it that could be a candidate.
    around = None
    for size in range(3, longest + 1):
        spans = [(at, of) for of in range(2, size) for at in range(1, size - of + 2)]
        parts = found[size - 1].select("lang", F.col("a").alias("longer"), F.explode(F.array(*[
            F.array_join(F.slice(F.split("word", " "), at, of), " ") for at, of in spans])).alias("word"))
        around = parts if around is None else around.unionByName(parts)
    if around is not None:
        around = around.groupBy("lang", "word").agg(F.max("longer").alias("longer"))
        candidates = candidates.join(around, ["lang", "word"], "left").where(
            F.col("longer").isNull() | (100 * _whole("longer") < inside * _whole("a")))
    # A language may hold most phrases: the first of each share of it, then the first of those.
    order = (F.desc("score"), F.desc("a"), F.col("word"))
    candidates = candidates.withColumn("_share", F.pmod(F.xxhash64("word"), F.lit(SHARES)))
    for within in (["lang", "_share"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*within).orderBy(*order))
        candidates = candidates.withColumn("rank", rank).where(F.col("rank") <= top)
    ranked = candidates
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), F.col("word").alias("phrase"),
        "a", "l", "r", "n", "score")
