"""Centroid clustering with ns-bounds: exact rounds that measure few distances.

Each vector keeps its distance to its own centroid and a lower bound to every other, each with
the round it was measured in. The history of all centroids is kept too, so a bound is loosened
by the norm of the centroid's *total* displacement since that round: where a centroid wanders
back and forth this is far less than the sum of its steps. A vector whose own distance
stays below every other bound keeps its centroid unmeasured; the rest measure exactly what the
bounds leave open. Whole numbers make distances, sums and ties exact.

Vectors travel once, packed into blocks (rows of a written table); each round maps blocks to
blocks and sums by centroid. Only ``k`` sums, ``k`` centroids and their history reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import small_batches, written

BLOCK = 4096
BLOCKS = ("ids array<bigint>, points binary, own int, cluster binary, nearest binary, since binary, "
          "bounds binary, measured_in binary, sums array<bigint>, evaluated bigint")
RESULT = ("vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, "
          "centroid_sha256 string")
SLACK = 1e-6   # relative; covers the rounding of roots and of the bounds' 32 bits
LARGEST = 1 << 26


@dataclass
class Bounds:
    """What one block's vectors know: each array has a row per vector."""

    points: np.ndarray       # whole numbers
    cluster: np.ndarray
    nearest: np.ndarray      # squared distance to the own centroid, as of ``since``
    since: np.ndarray
    bounds: np.ndarray       # distance to each centroid, as of ``measured_in``
    measured_in: np.ndarray
    evaluated: int = 0


def squares(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances row by row, exact."""
    gaps = points.astype(np.int64) - centres
    return np.einsum("ij,ij->i", gaps, gaps)


def first_round(points: np.ndarray, centres: np.ndarray) -> Bounds:
    """Every distance is measured once; of equal ones the smaller number is the nearest."""
    all_of = np.stack([squares(points, centre) for centre in centres], axis=1)
    cluster = all_of.argmin(1).astype(np.int32)
    nearest = all_of[np.arange(len(points)), cluster]
    return Bounds(points, cluster, nearest, np.zeros(len(points), np.uint16),
                  np.sqrt(all_of).astype(np.float32), np.zeros(all_of.shape, np.uint16), all_of.size)


def next_round(now: Bounds, history: np.ndarray) -> None:
    """Assign the block's vectors to the last centroids of the history, in place."""
    last = len(history) - 1
    moved = np.linalg.norm((history[last] - history).astype(float), axis=2)
    numbers = np.arange(history.shape[1])

    def open_pairs(rows: np.ndarray) -> np.ndarray:
        own = now.cluster[rows]
        upper = np.sqrt(now.nearest[rows].astype(float)) + moved[now.since[rows], own]
        lower = now.bounds[rows] - moved[now.measured_in[rows], numbers]
        slack = SLACK * (1 + upper + now.bounds[rows].max(1, initial=0))
        return (lower <= (upper + slack)[:, None]) & (numbers != own[:, None])

    failed = np.flatnonzero(open_pairs(np.arange(len(now.points))).any(1))
    if not len(failed):
        now.evaluated = 0
        return
    stale = failed[now.since[failed] != last]
    now.nearest[stale] = squares(now.points[stale], history[last][now.cluster[stale]])
    now.since[stale] = last
    at, other = np.nonzero(open_pairs(failed))
    found = squares(now.points[failed[at]], history[last][other])
    rows = failed[at]
    now.bounds[rows, other] = np.sqrt(found)
    now.measured_in[rows, other] = last
    now.evaluated = len(stale) + len(found)
    # The nearest measured centroid of each failed vector, its own among them.
    own = now.cluster[failed]
    now.bounds[failed, own] = np.sqrt(now.nearest[failed])
    now.measured_in[failed, own] = last
    rows = np.concatenate([failed, rows])
    numbers_of = np.concatenate([own, other])
    distances = np.concatenate([now.nearest[failed], found])
    order = np.lexsort((numbers_of, distances, rows))
    first = order[np.flatnonzero(np.r_[True, rows[order][1:] != rows[order][:-1]])]
    now.cluster[rows[first]] = numbers_of[first]
    now.nearest[rows[first]] = distances[first]


def measure_own(now: Bounds, history: np.ndarray) -> None:
    """The distance of every vector to its own centroid of the last round."""
    last = len(history) - 1
    stale = np.flatnonzero(now.since != last)
    now.nearest[stale] = squares(now.points[stale], history[last][now.cluster[stale]])
    now.since[stale] = last
    now.evaluated += len(stale)


def _smallest_type(points: np.ndarray) -> np.ndarray:
    for kind in (np.int8, np.int16):
        info = np.iinfo(kind)
        if not points.size or (points.min() >= info.min and points.max() <= info.max):
            return points.astype(kind)
    return points.astype(np.int32)


def _block_row(ids: pa.Array, now: Bounds, k: int) -> pa.RecordBatch:
    """The block as a row; its sums are the points', the counts' and the distances', by centroid."""
    dims = now.points.shape[1]
    sums = np.zeros((k, dims), np.int64)
    np.add.at(sums, now.cluster, now.points.astype(np.int64))
    counts = np.bincount(now.cluster, minlength=k)
    inertia = np.zeros(k, np.int64)
    np.add.at(inertia, now.cluster, now.nearest)
    whole = np.concatenate([sums.ravel(), counts, inertia])

    def one(values: np.ndarray) -> pa.Array:
        return pa.array([np.ascontiguousarray(values).tobytes()], pa.binary())

    def many(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    return pa.record_batch({
        "ids": many(ids), "points": one(now.points), "own": pa.array([now.points.dtype.itemsize], pa.int32()),
        "cluster": one(now.cluster), "nearest": one(now.nearest), "since": one(now.since),
        "bounds": one(now.bounds), "measured_in": one(now.measured_in),
        "sums": many(pa.array(whole, pa.int64())), "evaluated": pa.array([now.evaluated], pa.int64())})


def _read_block(batch: pa.RecordBatch, i: int, k: int) -> tuple[pa.Array, Bounds]:
    def read(name: str, kind) -> np.ndarray:
        return np.frombuffer(batch.column(name)[i].as_buffer(), kind).copy()

    ids = batch.column("ids")[i].values
    kind = {1: np.int8, 2: np.int16, 4: np.int32}[batch.column("own")[i].as_py()]
    return ids, Bounds(
        read("points", kind).reshape(len(ids), -1), read("cluster", np.int32), read("nearest", np.int64),
        read("since", np.uint16), read("bounds", np.float32).reshape(-1, k),
        read("measured_in", np.uint16).reshape(-1, k))


def whole_vectors(df: DataFrame, id_col: str, vector_col: str, dims: int) -> DataFrame:
    """``(vec_id, x)`` of the vectors with ``dims`` components, none null or non-finite."""
    kept = df.select(F.col(id_col).cast("long").alias("vec_id"),
                     F.col(vector_col).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return kept.where(F.col("x").isNotNull() & (F.size("x") == dims) & F.coalesce(finite, F.lit(False)))


def _first_blocks(vectors: DataFrame, scale: int, centres: np.ndarray) -> DataFrame:
    k = len(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, values, held = [], [], 0

        def row() -> pa.RecordBatch:
            points = whole_numbers(np.concatenate(values).reshape(held, -1), scale)
            return _block_row(pa.concat_arrays(ids), first_round(points, centres), k)

        for batch in batches:
            for start in range(0, len(batch), BLOCK):
                part = batch.slice(start, BLOCK)
                if held + len(part) > BLOCK:
                    yield row()
                    ids, values, held = [], [], 0
                ids.append(part.column(0))
                values.append(part.column(1).flatten().to_numpy(zero_copy_only=False))
                held += len(part)
        if held:
            yield row()

    return vectors.mapInArrow(run, BLOCKS)


def whole_numbers(values: np.ndarray, scale: int) -> np.ndarray:
    scaled = np.floor(scale * values)
    if len(scaled) and np.abs(scaled).max() >= LARGEST:
        raise ValueError(f"a component times {scale} is {LARGEST} or more: distances would pass 64 bits")
    return _smallest_type(scaled.astype(np.int64))


def _summed(blocks: DataFrame) -> list[int]:
    """The blocks' sums added up, place by place: first within tasks, then over them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for value in batch.column(0):
                row = value.values.to_numpy()
                total = row if total is None else total + row
        if total is not None:
            yield pa.record_batch({"place": pa.array(np.arange(len(total))), "n": pa.array(total, pa.int64())})

    found = blocks.select("sums").mapInArrow(run, "place bigint, n bigint").groupBy("place").agg(
        F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).collect()
    return [int(n) for _, n in sorted((r.place, r.n) for r in found)]


def centroid_clusters(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *,
                      dims: int = 64, k: int = 16, rounds: int = 3, scale: int = 64,
                      seed: int = 1, evaluations: list[int] | None = None) -> DataFrame:
    """The nearest of ``k`` centroids of every vector after ``rounds`` rounds of exact k-means.

    Returns ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``. Components
    become ``floor(scale * x)``. The first centroids are the vectors whose ids hash lowest.
    ``evaluations`` is filled with the number of distances measured in each assignment.

    Rows whose vector is null, of another length, or holds a null or non-finite component have no
    result; an empty table gives none, and fewer than ``k`` vectors give as many centroids.
    Repeated rows count as often as they occur. A null id is kept but starts no centroid before
    all others have. Ties in distance go to the smaller centroid, ties of equal hashes to the vector that
    sorts first. A component whose whole number reaches 2^26 raises, as squares would not fit. Other columns are not read.
    """
    spark = df.sparkSession
    small_batches(spark)
    vectors = whole_vectors(df, id_col, vector_col, dims)
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    chosen = vectors.orderBy(key.asc_nulls_last(), "x").limit(k).collect()
    if not chosen:
        return spark.createDataFrame([], RESULT)
    history = whole_numbers(np.array([r.x for r in chosen], float), scale).astype(np.int64)[None]
    k = len(chosen)
    blocks = written(_first_blocks(vectors, scale, history[0]), "clusters")
    for done in range(1, rounds + 1):
        total = _summed(blocks)
        counts = total[k * dims:k * dims + k]
        centres = [[total[j * dims + d] // counts[j] for d in range(dims)] if counts[j] else history[-1][j]
                   for j in range(k)]
        history = np.concatenate([history, np.array(centres, np.int64)[None]])

        def assign(batches, history=history, final=done == rounds):
            for batch in batches:
                for i in range(len(batch)):
                    ids, now = _read_block(batch, i, k)
                    next_round(now, history)
                    if final:
                        measure_own(now, history)
                    yield _block_row(ids, now, k)

        if evaluations is not None:
            evaluations.append(blocks.agg(F.sum("evaluated")).first()[0])
        blocks = written(blocks.mapInArrow(assign, BLOCKS), "clusters")
    if evaluations is not None:
        evaluations.append(blocks.agg(F.sum("evaluated")).first()[0])
    inertia = _summed(blocks)[-k:]
    digests = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in history[-1].tolist()]

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                ids, now = _read_block(batch, i, k)
                at = pa.array(now.cluster)
                yield pa.record_batch({
                    "vec_id": ids, "cluster": at, "distance": pa.array(now.nearest),
                    "cluster_inertia": pa.array(inertia, pa.int64()).take(at),
                    "inertia": pa.array([sum(inertia)] * len(ids), pa.int64()),
                    "centroid_sha256": pa.array(digests).take(at)})

    return blocks.mapInArrow(unpack, RESULT)
