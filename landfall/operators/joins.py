"""Joins on keys that may be null, and joins whose large side may be skewed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def splittable(small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Let a hot key of the other side be split.

    A side that was just grouped by the join key would be joined where it lies,
    and adaptive execution only splits between plain shuffles. One more shuffle of
    this, the smaller, side makes both plain. It is not paid where the side turns
    out small enough to broadcast.
    """
    return small.repartition(F.hash(*keys))


def join_null_safe(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str
) -> DataFrame:
    """Join on ``keys`` with null equal to null; the left side's keys remain."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    same = reduce(
        lambda all_of, one: all_of & one,
        [F.col(key).eqNullSafe(F.col(f"_right_{key}")) for key in keys],
    )
    joined = left.join(renamed, same, how)
    return joined.drop(*[f"_right_{key}" for key in keys])
