"""What the two graded classifiers share: drawing a bounded sample, scoring whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm import arrays, ordinal
from landfall.llm.common import text_rows, which_text

Features = Callable[[bytes], tuple[np.ndarray, np.ndarray]]


def learn(rows: DataFrame, labels: DataFrame, id_col: str, grade_col: str, features: Features,
          size: int, sample: int, **settings) -> ordinal.Ordinal | None:
    """Train on the ``sample`` labelled texts whose ids hash lowest.

    The ids are drawn first, from the narrow tables, so no more texts than the sample's are read
    into features, and only those features travel.
    """
    known = labels.select(F.col(id_col).cast("long").alias("_id"),
                          F.col(grade_col).cast("double").alias("grade")).dropna()
    last = (known.select(F.xxhash64("_id").alias("draw")).orderBy("draw").limit(sample)
            .agg(F.max("draw")).first()[0])
    if last is None:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(text or b"") for text in arrays.raw_texts(batch.column("_text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"),
                 pa.array([ids.astype("<u4").tobytes() for ids, _ in found], pa.binary()),
                 pa.array([x.astype("<f4").tobytes() for _, x in found], pa.binary())],
                names=["_id", "ids", "x"])

    drawn = (rows.where(F.xxhash64("_id") <= last).select("_id", "_text")
             .mapInArrow(run, "_id long, ids binary, x binary")
             .join(known.where(F.xxhash64("_id") <= last), "_id")
             .orderBy(F.xxhash64("_id"), "ids", "x", "grade").limit(sample)
             .select("ids", "x", "grade").collect())
    texts = [(np.frombuffer(r.ids, "<u4").astype(np.int64), np.frombuffer(r.x, "<f4").astype(float))
             for r in drawn]
    return ordinal.train(texts, [r.grade for r in drawn], size, **settings)


def grade(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, grade_col: str, *,
          features: Features, size: int, sample: int, least: float | None, names: tuple[str, str, str],
          floor: float, learn_from: DataFrame | None = None, **settings) -> DataFrame:
    """Per row of ``df`` the expected grade, the chance of at least ``least`` (the highest grade,
    if None), and whether that reaches ``floor``; columns are called as in ``names``."""
    rows = text_rows(df, id_col, text_col)
    taught = rows if learn_from is None else text_rows(learn_from, id_col, text_col)
    model = learn(taught, labels, id_col, grade_col, features, size, sample, **settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model is None:
                expected = tail = pa.nulls(batch.num_rows, pa.float64())
                chosen = pa.array(np.zeros(batch.num_rows, bool))
            else:
                scores = np.zeros(batch.num_rows)
                for row, text in enumerate(arrays.raw_texts(batch.column("_text"))):
                    ids, x = features(text or b"")
                    scores[row] = model.weights[ids] @ x
                wanted = model.grades[-1] if least is None else least
                at = int(np.searchsorted(model.grades, wanted))
                tails = model.tails(scores)
                chance = (np.ones(len(scores)) if at == 0 else np.zeros(len(scores))
                          if at >= len(model.grades) else tails[:, at - 1])
                expected, tail = pa.array(model.expected(scores)), pa.array(chance)
                chosen = pa.array(chance >= floor)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), expected, tail, chosen, batch.column("which")],
                names=["_id", *names, "_which"])

    asked = rows.select("_id", "_text", which_text().alias("which"))
    return asked.mapInArrow(
        run, f"_id long, {names[0]} double, {names[1]} double, {names[2]} boolean, _which int"
    ).withColumnRenamed("_id", id_col)
