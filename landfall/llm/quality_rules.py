"""Quality rules: fixed base rules, and boosted trees over the statistics of a text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm import arrays, boosting
from landfall.llm.common import filter_by_text, text_rows, which_text

TRAIN_ROWS = 20_000     # labelled texts fitted on, those of the least hash of the id
LEAST_SCORE = 0.5
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# A statistic, and whether quality may only rise (+1) or fall (-1) with it.
STATISTICS = {
    "log_words": 0, "word_length": 0, "symbol_share": -1, "dup_line_share": -1,
    "repeat_share": -1, "upper_share": -1, "digit_share": 0, "mark_share": -1,
    "bar_share": -1, "words_per_line": 0, "new_words": 0, "stop_share": 0,
    "odd_share": -1, "long_share": 0,
}
_MONOTONE = np.array(list(STATISTICS.values()))


def counts_and_statistics(text: bytes | None) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """The base counts of a whole text, and its statistics in the order of ``STATISTICS``."""
    text = text or b""
    raw = np.frombuffer(text, np.uint8)
    starts, ends = arrays.word_spans(raw)
    words = len(starts)
    by_byte = np.bincount(raw, minlength=256)
    chars = int(by_byte.sum() - by_byte[0x80:0xC0].sum() - by_byte[list(arrays.BLANKS)].sum())
    symbols = int(by_byte[list(SYMBOLS)].sum())
    lines = [line for line in text.split(b"\n") if line.strip(arrays.BLANKS)]
    dup_lines = len(lines) - len(set(lines))
    hashes = arrays.word_hashes(raw, starts, ends)
    grams = arrays.gram_hashes(hashes, 3)
    repeated = 0
    if len(grams):
        _, back, many = np.unique(grams, return_inverse=True, return_counts=True)
        twice = np.zeros(words + 1, np.int64)
        at = np.flatnonzero(many[back] > 1)
        np.add.at(twice, at, 1)
        np.add.at(twice, at + 3, -1)
        repeated = int((np.cumsum(twice)[:words] > 0).sum())
    some, letters = max(words, 1), max(chars, 1)
    sizes = ends - starts
    last = raw[ends - 1] if words else raw[:0]
    statistics = (
        np.log1p(words), chars / some, symbols / letters, dup_lines / max(len(lines), 1),
        repeated / some, by_byte[65:91].sum() / letters, by_byte[48:58].sum() / letters,
        (by_byte[33] + by_byte[63]) / letters, by_byte[124] / some, words / max(len(lines), 1),
        len(np.unique(hashes)) / some, (sizes <= 3).sum() / some,
        np.isin(last, list(SYMBOLS + b"!")).sum() / some, (sizes > 14).sum() / some)
    return (words, chars, symbols, dup_lines, repeated), tuple(map(float, statistics))


def _rejected(counts: tuple[int, ...]) -> bool:
    """The base rules: too few words, or more than half of them in repeated triples."""
    words, repeated = counts[0], counts[4]
    return words < 50 or 100 * repeated > 50 * words


def _judge(model: boosting.Trees | None, texts: list[bytes | None], least: float):
    """Counts, base verdicts, kept and scores of some texts."""
    told = [counts_and_statistics(text) for text in texts]
    rows = np.array([statistics for _, statistics in told]).reshape(-1, len(STATISTICS))
    score = boosting.sigmoid(model.margin(rows)) if model else np.ones(len(rows))
    failed = np.array([_rejected(counts) for counts, _ in told], bool)
    return [counts for counts, _ in told], failed, ~failed & (score >= least), score


def fit_quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                label_col: str = "quality", train_rows: int = TRAIN_ROWS) -> boosting.Trees | None:
    """Trees fitted on at most ``train_rows`` labelled texts, those whose ids hash lowest; None if
    their labels are of one kind. Ids are drawn from the labels, so only drawn texts are read
    closely and only their statistics travel."""
    known = labels.select(F.col(id_col).cast("long").alias("_id"),
                          (F.col(label_col) > 0).cast("int").alias("label")).dropna()
    last = (known.select(F.xxhash64("_id").alias("draw")).orderBy("draw").limit(train_rows)
            .agg(F.max("draw")).first()[0])
    if last is None:
        return None

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = [counts_and_statistics(text)[1] for text in arrays.raw_texts(batch.column("_text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(told, pa.list_(pa.float64()))], names=["_id", "statistics"])

    sample = (text_rows(df, id_col, text_col).where(F.xxhash64("_id") <= last)
              .mapInArrow(describe, "_id long, statistics array<double>")
              .join(known.where(F.xxhash64("_id") <= last), "_id")
              .orderBy(F.xxhash64("_id"), "_id", "statistics", "label").limit(train_rows)
              .select("statistics", "label").collect())
    target = np.array([row.label for row in sample], float)
    if len(np.unique(target)) < 2:
        return None
    return boosting.fit(np.array([row.statistics for row in sample]), target, monotone=_MONOTONE)


def quality_rules(df: DataFrame, model: boosting.Trees | None, id_col: str = "doc_id",
                  text_col: str = "text", *, least_score: float = LEAST_SCORE) -> DataFrame:
    """Judge texts by base rules and by fitted trees.

    Returns one row per row of ``df``: the id, ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words``, ``base_failed``, ``kept``, ``score`` (the trees' chance
    that the text is good) and ``_which`` (a hash of the text). Null and blank texts have no
    words and fail. Without a model the base rules decide alone. Repeated rows are judged alike;
    an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, failed, kept, score = _judge(
                model, list(arrays.raw_texts(batch.column("_text"))), least_score)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), *(pa.array([c[k] for c in counts], pa.int64()) for k in range(len(COUNTS))),
                 pa.array(failed), pa.array(kept), pa.array(score), batch.column("which")],
                names=["_id", *COUNTS, "base_failed", "kept", "score", "_which"])

    schema = ("_id long, " + ", ".join(f"{c} long" for c in COUNTS)
              + ", base_failed boolean, kept boolean, score double, _which int")
    rows = text_rows(df, id_col, text_col).select("_id", which_text().alias("which"), "_text")
    return rows.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def keep_good(df: DataFrame, model: boosting.Trees | None, text_col: str = "text", *,
              least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``df`` that ``quality_rules`` keeps, all columns as they are."""
    return filter_by_text(df, text_col, lambda texts: _judge(model, texts, least_score)[2].tolist())
