import random
import sys
from pathlib import Path

import pytest
from made_texts import words

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use inside, as columns of the caller's.
CLASHES = "which int, _text string, n int, found int, score double, item int, _row int, key int"


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and blank texts, a very long text, ties and repeated rows."""
    rng = random.Random(5)
    long_text = words(rng, 40_000, "abcdefghijé") + "\n" + words(rng, 300)
    plain = words(rng, 80)
    return [
        (1, plain, "en", "a", len(plain)), (1, plain, "en", "a", len(plain)),
        (2, None, None, None, None), (None, plain + " x", "fr", None, 3), (None, None, None, None, None),
        (3, "", "en", "b", 0), (4, " \n\t ", "en", "b", 4), (5, "é", "fr", "b", 1),
        (6, long_text, "en", "c", len(long_text)), (6, "another text of the same id", "en", "c", 1),
        (7, "1234 5678", "en", "c", 9), (8, words(rng, 120), "fr", "c", 0),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def crowded(spark, odd_rows):
    """The same rows with columns whose names clash."""
    return spark.createDataFrame(
        [(*row, 1, "t", 2, 3, 0.5, 4, 5, 6) for row in odd_rows], f"{SCHEMA}, {CLASHES}")


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    rng = random.Random(8)
    return spark.createDataFrame(
        [(i, rng.randint(0, 1), rng.randint(0, 1)) for i in range(1, 9)] + [(None, 1, 1), (3, None, None)],
        "doc_id long, quality int, toxic int")
