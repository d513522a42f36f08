"""Landed column names."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def snake_case(name: str) -> str:
    """``updatedAt`` and ``HTTPStatus`` as ``updated_at`` and ``http_status``.

    Leading underscores stay, so ``_deleted`` keeps its meaning.
    """
    body = name.lstrip("_")
    lead = name[: len(name) - len(body)]
    words = re.sub(r"[^0-9A-Za-z]+", "_", body)
    words = re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", words)
    return lead + words.strip("_").lower()


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Rename every column to its landed spelling; two names may not meet."""
    landed = [snake_case(name) for name in df.columns]
    clashes = sorted({name for name in landed if landed.count(name) > 1})
    if clashes:
        raise ValueError(f"columns meet under one landed name: {', '.join(clashes)}")
    return df.toDF(*landed)
