"""Toxicity: expected severity by cumulative-link ordinal regression on the words of a text."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from landfall.llm import arrays
from landfall.llm.graded import grade

BITS = 20
SAMPLE = 12_000
TOXIC = 0.5
# Letters in lower case, punctuation (but no bytes of other letters) as blanks.
_PLAIN = bytes(32 if b < 0x80 and not chr(b).isalnum() else b for b in arrays.LOWER)


def word_presence(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The distinct words of the whole text, hashed; one toxic word counts in a text of any length."""
    raw = np.frombuffer(text.translate(_PLAIN), np.uint8)
    words = arrays.word_hashes(raw, *arrays.word_spans(raw)) >> np.uint64(64 - BITS)
    ids = np.unique(words).astype(np.int64)
    return ids, np.ones(len(ids))


def toxicity(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             grade_col: str = "toxic", *, least_grade: float | None = None, floor: float = TOXIC,
             sample: int = SAMPLE, learn_from: DataFrame | None = None) -> DataFrame:
    """Expected severity of every whole text, learned from severity grades.

    Returns one row per row of ``df``: the id, ``severity`` (expected grade), ``tail`` (the
    chance of ``least_grade`` or worse, by default the worst), ``toxic`` (``tail`` reaches
    ``floor``) and ``_which`` (a hash of the text). At most ``sample`` grades are learned
    from, those whose ids hash lowest; grades without an id or a value are left out, and
    several grades of a text all count. A null or empty text gets what a text without words
    gets. If there are no two grades to learn from, both numbers are null and nothing is
    toxic. Repeated rows are judged alike; an empty table gives no rows.
    """
    return grade(df, labels, id_col, text_col, grade_col, features=word_presence, size=1 << BITS,
                 sample=sample, least=least_grade, names=("severity", "tail", "toxic"), floor=floor,
                 learn_from=learn_from, rate=0.3, lasso=1.5, epochs=4)
