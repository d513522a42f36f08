"""A quality classifier on graded ratings: ordinal cumulative-link regression on hashed text."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from landfall.llm import arrays
from landfall.llm.graded import grade

BITS = 16
SAMPLE = 6_000
LEAST_TAIL = 0.5


def hashed_text(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte 3-grams and words of the whole text, hashed, as damped shares of unit length."""
    raw = np.frombuffer(text, np.uint8)
    size = 1 << BITS
    grams = arrays.byte_gram_hashes(raw, 3) >> np.uint64(64 - BITS)
    words = arrays.word_hashes(raw, *arrays.word_spans(raw)) >> np.uint64(64 - BITS)
    counts = np.bincount(grams.astype(np.int64), minlength=size) + np.bincount(
        words.astype(np.int64), minlength=size)
    ids = np.flatnonzero(counts)
    x = np.sqrt(counts[ids])
    return ids, x / max(np.sqrt((x * x).sum()), 1e-9)


def quality_classifier(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       grade_col: str = "quality", *, least_grade: float | None = None,
                       least_tail: float = LEAST_TAIL, sample: int = SAMPLE,
                       learn_from: DataFrame | None = None) -> DataFrame:
    """Expected grade of every whole text, learned from graded ratings.

    Returns one row per row of ``df``: the id, ``expected_grade``, ``tail`` (the chance of
    ``least_grade`` or better, by default the best grade), ``selected`` (``tail`` reaches
    ``least_tail``) and ``_which`` (a hash of the text). At most ``sample`` ratings are
    learned from, those whose ids hash lowest; ratings without an id or a grade are left out, and
    several ratings of a text all count. A null or empty text gets what a text without features
    gets. If there are no two grades to learn from, both numbers are null and nothing
    is selected. Repeated rows are judged alike; an empty table gives no rows.
    """
    return grade(df, labels, id_col, text_col, grade_col, features=hashed_text, size=1 << BITS,
                 sample=sample, least=least_grade, names=("expected_grade", "tail", "selected"),
                 floor=least_tail, learn_from=learn_from, rate=2.0, lasso=0.02, epochs=6)
