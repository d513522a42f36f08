"""Clusters with bounds against plain measuring."""

import hashlib
import math
import random

import numpy as np
import pytest

from landfall.llm.centroids import centroid_clusters

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, dims, k, rounds, scale=64):
    kept = [(i, [math.floor(scale * c) for c in x]) for i, x, _ in rows
            if x is not None and len(x) == dims and all(c is not None and math.isfinite(c) for c in x)]
    key = lambda v: (v[0] is None, hashlib.sha256(f"1:{v[0]}".encode()).hexdigest(), v[1])
    centres = [x for _, x in sorted(kept, key=key)[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        of = [nearest(x)[1] for _, x in kept]
        for j in range(len(centres)):
            mine = [x for (_, x), c in zip(kept, of, strict=True) if c == j]
            if mine:
                centres[j] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    last = [nearest(x) for _, x in kept]
    total = [sum(d for d, c in last if c == j) for j in range(len(centres))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return [(i, c, d, total[c], sum(total), digest[c]) for (i, _), (d, c) in zip(kept, last, strict=True)]


def vectors(rng, count, dims, spread=0.3, centres=6):
    means = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(centres)]
    out = []
    for i in range(count):
        mean = means[rng.randrange(centres)]
        out.append((i, [float(np.float32(rng.gauss(m, spread))) for m in mean], i % 3))
    return out


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("rounds", [0, 3, 8])
def test_equals_plain_measuring(spark, seed, rounds):
    rng = random.Random(seed)
    rows = vectors(rng, 300, 5, rng.choice([0.1, 0.9]))
    rows += [rows[0], rows[7], (None, rows[3][1], 0)]  # repeated rows and one without an id
    got = centroid_clusters(spark.createDataFrame(rows, SCHEMA).repartition(5), dims=5, k=7, rounds=rounds)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain(rows, 5, 7, rounds), key=repr)


def test_bounds_spare_measuring(spark):
    rows = vectors(random.Random(3), 2000, 8, 0.2)
    spent = []
    got = centroid_clusters(spark.createDataFrame(rows, SCHEMA), dims=8, k=10, rounds=6, evaluations=spent)
    assert sorted(map(tuple, got.collect())) == sorted(plain(rows, 8, 10, 6))
    # The last assignment measures every vector once, for its result.
    assert spent[0] == 20_000 and max(spent[3:]) < 10_000


def test_ties_go_to_the_smaller_centroid(spark):
    rows = [(i, [0.5, 0.5], 0) for i in range(9)] + [(20 + i, [float(i % 2), 0.0], 0) for i in range(6)]
    got = centroid_clusters(spark.createDataFrame(rows, SCHEMA), dims=2, k=5, rounds=3)
    assert sorted(map(tuple, got.collect())) == sorted(plain(rows, 2, 5, 3))


def test_vectors_that_are_none(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [i / 7, -i / 3], i) for i in range(1, 6)]
    bad = [(10, None, 1), (11, [], 1), (12, [1.0], 1), (13, [1.0, None], 1), (14, [nan, 1.0], 1),
           (15, [1.0, -inf], 1), (16, [1.0, 2.0, 3.0], None)]
    got = centroid_clusters(spark.createDataFrame(good + bad, SCHEMA), dims=2, k=16, rounds=2)
    assert sorted(map(tuple, got.collect())) == sorted(plain(good, 2, 16, 2))
    for rows in ([], bad):
        empty = centroid_clusters(spark.createDataFrame(rows, SCHEMA), dims=2)
        assert empty.count() == 0 and empty.columns == got.columns


def test_other_columns_and_wide_numbers(spark):
    rows = [(i, [i * 1000.25, -i * 9_000.5], i) for i in range(40)]
    frame = spark.createDataFrame(rows, SCHEMA)
    crowded = frame.selectExpr("*", "1 as x", "2 as cluster", "3 as place", "4 as ids", "'s' as distance")
    want = sorted(plain(rows, 2, 4, 3))
    for given in (frame, crowded, frame.selectExpr("vec_id", "cast(embedding as array<double>) embedding")):
        assert sorted(map(tuple, centroid_clusters(given, dims=2, k=4).collect())) == want
    with pytest.raises(Exception, match="pass 64 bits"):
        centroid_clusters(spark.createDataFrame([(1, [1e30, 1.0], 0)], SCHEMA), dims=2).count()
