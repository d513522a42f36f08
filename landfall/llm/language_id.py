"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is the mean of the embeddings of its hashed byte 3- and 4-grams; a linear layer and
a softmax give each language's chance. Both layers are trained by stochastic gradient
descent in numpy on a bounded sample. A part of it is held back to calibrate: a temperature
makes the chances honest, and a floor under the chances rejects what looks like no
language that was learned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm import arrays
from landfall.llm.common import small_batches

BITS = 14               # 2^14 hashed subwords
WIDTH = 16              # of an embedding
SAMPLE = 2_000          # texts learned from, those of the least hash of id and text
EPOCHS = 6
REJECTED = 0.01         # share of correct held-back predictions that the floor may reject
_LETTER = regex.compile(r"\p{L}")
_FOLD = bytes(32 if b in arrays.BLANKS else b for b in arrays.LOWER)
_ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    weights: np.ndarray      # (subwords, languages): embedding times output layer
    bias: np.ndarray
    temperature: float
    floor: float


def subword_counts(text: bytes) -> np.ndarray:
    """How often each hashed subword occurs in the whole text."""
    raw = np.frombuffer(text.translate(_FOLD), np.uint8).astype(np.uint64) + np.uint64(1)
    counts = np.zeros(1 << BITS, np.int64)
    for start in range(0, len(raw), 1 << 18):
        part = raw[start:start + (1 << 18) + 3]
        grams = part[:-1] * np.uint64(257) + part[1:]
        for size in (3, 4):
            if len(part) < size:
                break
            grams = grams[:len(part) - size + 1] * np.uint64(257) + part[size - 1:]
            here = grams[:min(len(grams), 1 << 18)]
            counts += np.bincount(((here * _ODD) >> np.uint64(64 - BITS)).astype(np.int64),
                                  minlength=1 << BITS)
    return counts


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, weights = [], []
        for text in arrays.raw_texts(batch.column("_text")):
            counts = subword_counts(text)
            used = np.flatnonzero(counts)
            ids.append(used.astype("<u2").tobytes())
            weights.append((counts[used] / max(counts.sum(), 1)).astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.binary()), pa.array(weights, pa.binary()), batch.column("lang")],
            names=["ids", "weights", "lang"])


def _softmax(logits: np.ndarray) -> np.ndarray:
    out = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return out / out.sum(axis=-1, keepdims=True)


def train(texts: list[tuple[np.ndarray, np.ndarray]], labels: list[str], *, epochs: int = EPOCHS,
          rate: float = 8.0, seed: int = 7) -> Model:
    """Fit embeddings and output layer by SGD, a text at a time; every fifth text calibrates."""
    languages = sorted(set(labels))
    target = np.array([languages.index(x) for x in labels])
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 1 / WIDTH, (1 << BITS, WIDTH)).astype(np.float32)
    layer = np.zeros((WIDTH, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    held = np.arange(len(texts)) % 5 == 4
    if len(texts) < 50:
        held[:] = False
    learn = np.flatnonzero(~held)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(learn):
            ids, share = texts[i]
            if not len(ids):
                continue
            hidden = share @ embed[ids]
            off = _softmax(hidden @ layer + bias)
            off[target[i]] -= 1
            back = layer @ off
            layer -= step * 0.1 * np.outer(hidden, off)
            bias -= step * 0.01 * off
            embed[ids] -= step * np.outer(share, back)
    weights = embed @ layer
    judged = np.flatnonzero(held) if held.any() else learn
    logits = np.array([weights[texts[i][0]].T @ texts[i][1] + bias for i in judged])
    grid = np.geomspace(0.05, 5, 40)
    lost = [-np.log(_softmax(logits / t)[np.arange(len(judged)), target[judged]] + 1e-12).mean() for t in grid]
    temperature = float(grid[int(np.argmin(lost))])
    chance = _softmax(logits / temperature)
    right = chance.argmax(axis=1) == target[judged]
    floor = float(np.quantile(chance.max(axis=1)[right], REJECTED)) if right.any() else 0.0
    return Model(languages, weights, bias, temperature, floor)


def _predict(model: Model | None):
    schema = pa.schema([("_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()),
                        ("score", pa.float64()), ("rejected", pa.bool_()), ("_which", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores, rejected = [], [], []
            for text in arrays.raw_texts(batch.column("_text")):
                if model is None or not text or not _LETTER.search(text.decode("utf-8", "replace")):
                    name, score = "und", 0.0
                else:
                    counts = subword_counts(text)
                    mean = counts @ model.weights / max(counts.sum(), 1)
                    chance = _softmax((mean + model.bias) / model.temperature)
                    best = int(chance.argmax())
                    name, score = model.languages[best], float(chance[best])
                names.append(name)
                scores.append(score)
                rejected.append(name == "und" or score < model.floor)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("held_out"), pa.array(names, pa.string()),
                 pa.array(scores), pa.array(rejected, pa.bool_()), batch.column("which")], schema=schema)

    return run


def learn_languages(rows: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Train on ``sample`` distinct texts of ``(_text, lang)``, those that hash lowest with their
    language: a row that repeats is drawn once, however often it does."""
    keyed = rows.where("lang is not null and octet_length(_text) > 2").select(
        "_text", "lang", F.xxhash64("_text", "lang").alias("draw"))
    last = keyed.select("draw").distinct().orderBy("draw").limit(sample).agg(F.max("draw")).first()[0]
    if last is None:
        return None
    drawn = (keyed.where(F.col("draw") <= last).dropDuplicates(["draw"]).select("_text", "lang")
             .mapInArrow(_features, "ids binary, weights binary, lang string")
             .orderBy("lang", "ids", "weights").collect())
    texts = [(np.frombuffer(r.ids, "<u2").astype(np.int64), np.frombuffer(r.weights, "<f4")) for r in drawn]
    order = np.random.default_rng(1).permutation(len(drawn))
    return train([texts[i] for i in order], [drawn[i].lang for i in order])


def language_id(df: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
                lang_col: str = "lang", *, sample: int = SAMPLE) -> DataFrame:
    """The language of every whole text, learned from the rows that are not held out.

    Returns one row per row of ``df``: the id, ``held_out``, ``lang_pred`` (a learned
    language, or ``und`` for a null text or one without a letter), ``score`` (its calibrated
    chance, 0 for ``und``), ``rejected`` (below the calibrated floor, or ``und``) and
    ``_which`` (a hash of the text). A null ``held_out`` is not learned from and returned as false.
    Without rows to learn from all is ``und``. Repeated rows are judged alike; an
    empty table gives no rows.
    """
    small_batches(df.sparkSession)
    rows = df.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"),
                     F.col(lang_col).cast("string").alias("lang"), held_out.alias("held_out"))
    model = learn_languages(rows.where("not held_out").select("_text", "lang"), sample)
    asked = rows.select("_id", "_text", F.coalesce("held_out", F.lit(False)).alias("held_out"),
                        F.coalesce(F.hash("_text"), F.lit(0)).alias("which"))
    return asked.mapInArrow(
        _predict(model), "_id long, held_out boolean, lang_pred string, score double, "
        "rejected boolean, _which int").withColumnRenamed("_id", id_col)
