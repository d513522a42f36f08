"""Write dispositions as relations: what a table holds after a load.

A merge never reads and overwrites one place: these functions only describe the
result. ``landfall.plans.warehouse`` stages and switches it.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from landfall.operators.joins import join_null_safe
from landfall.operators.shape import LOAD_ID

# Table formats whose catalogs apply MERGE INTO row by row.
ROW_LEVEL_PROVIDERS = ("delta", "hudi", "iceberg", "paimon")

_UNORDERED = (T.MapType, T.VariantType)


def dedup_latest(rows: DataFrame, keys: Sequence[str], cursor: str | None = None) -> DataFrame:
    """One row per key: the newest by ``cursor``, nulls oldest, all other columns
    in order breaking ties, so the winner does not depend on the run. A row with a null
    in its key is nobody's double: all of them stay.

    The rank filter lets Spark keep one row per key inside every map task before
    it shuffles, so a key that holds much of the table stays small.
    """
    order = [F.col(cursor).desc_nulls_last()] if cursor else []
    order += [
        F.col(field.name).asc_nulls_first()
        for field in rows.schema.fields
        if field.name not in keys
        and field.name != cursor
        and not isinstance(field.dataType, _UNORDERED)
    ]
    newest = Window.partitionBy(*keys).orderBy(*(order or [F.lit(1)]))
    keyed = _has_key(keys)
    winners = (
        rows.filter(keyed)
        .withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )
    if not any(rows.schema[key].nullable for key in keys):
        return winners
    return winners.unionByName(rows.filter(~keyed))


def _has_key(keys: Sequence[str]) -> Column:
    return reduce(lambda all_of, one: all_of & one, [F.col(key).isNotNull() for key in keys])


def merge_upsert(
    target: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    cursor: str | None = None,
    unique_delta: bool = False,
    load_id: str | None = None,
) -> DataFrame:
    """The target with the delta's rows replacing it on key; unseen keys stay.

    Columns only one side knows are null on the other. Null meets null: rows that share a
    key with a null in it are one group, which the delta's group replaces, so merging
    twice is merging once. Given the delta's ``load_id``, rows without a key are records of
    their loads instead: the delta replaces those of its own load, as ``_load_id`` tells, and
    all of other loads stay. The delta is read and shuffled once; a target's key is unique, so
    there is no hot one to split.
    """
    if unique_delta:
        latest, replaced = delta, delta.select(*keys)
    else:
        latest = dedup_latest(delta, keys, cursor)
        replaced = latest.select(*keys)
    # Rows without a key are met apart: an equality on keys as they are keeps the layout of
    # both sides, and a scan for nulls skips every file whose statistics know of none.
    keyed = _has_key(keys)
    keyless = target.filter(~keyed)
    if load_id is None:
        keyless = join_null_safe(keyless, replaced.filter(~keyed).distinct(), keys, "left_anti")
    elif LOAD_ID in target.columns:
        keyless = keyless.filter(~F.col(LOAD_ID).eqNullSafe(load_id))
    kept = target.filter(keyed).join(replaced, list(keys), "left_anti").unionByName(keyless)
    return kept.unionByName(latest, allowMissingColumns=True)


def evolve_add_columns(rows: DataFrame, defaults: Mapping[str, tuple[str, Any]]) -> DataFrame:
    """``{column: (type, default)}`` added where missing, defaulted where null.

    A default of None leaves nulls alone.
    """
    missing = {
        name: F.lit(default).cast(kind)
        for name, (kind, default) in defaults.items()
        if name not in rows.columns
    }
    filled = {
        name: F.coalesce(F.col(name), F.lit(default).cast(kind))
        for name, (kind, default) in defaults.items()
        if name in rows.columns and default is not None
    }
    return rows.withColumns({**missing, **filled}) if missing or filled else rows


# Types in order of what holds what: a value of one fits each later one of its row.
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_REAL = (T.FloatType, T.DoubleType)
# Digits that hold every value of a whole type.
_DIGITS = dict(zip(_WHOLE, (3, 5, 10, 20)))
# What has one plain text, which a text column can hold.
_PLAIN = (*_WHOLE, *_REAL, T.DecimalType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
_MOMENTS = (T.TimestampType, T.TimestampNTZType)


def least_type(known: T.DataType, new: T.DataType) -> T.DataType | None:
    """The least type that holds values of both and that files of the known one can be
    read as; None if there is none.

    Whole numbers grow to the longer one, and to fractions where the reader can follow (not from
    64 bits); decimals grow in digits on both sides of the point; a day becomes a moment
    in a column of moments; a text column takes anything that has one plain text.
    """
    if isinstance(new, T.NullType) or known == new:
        return known
    if isinstance(known, T.StringType):
        return known if isinstance(new, (*_PLAIN, T.StringType)) else None
    if isinstance(known, _MOMENTS):
        return known if isinstance(new, T.DateType) else None
    if isinstance(known, _WHOLE) and isinstance(new, _WHOLE):
        return max(known, new, key=lambda kind: _WHOLE.index(type(kind)))
    if isinstance(known, _REAL) and isinstance(new, (*_REAL, *_WHOLE)):
        return T.DoubleType()
    if isinstance(known, _WHOLE[:-1]) and isinstance(new, _REAL):
        return T.DoubleType()
    return _least_decimal(known, new)


def _least_decimal(known: T.DataType, new: T.DataType) -> T.DataType | None:
    sizes = []
    for kind in (known, new):
        if isinstance(kind, T.DecimalType):
            sizes.append((kind.precision - kind.scale, kind.scale))
        elif type(kind) in _DIGITS:
            sizes.append((_DIGITS[type(kind)], 0))
        else:
            return None
    before, after = max(size[0] for size in sizes), max(size[1] for size in sizes)
    return T.DecimalType(before + after, after) if before + after <= 38 else None


def settle_types(rows: DataFrame, known: T.StructType) -> DataFrame:
    """``rows`` in types that the table's columns can have from now on.

    Where the values of a load and of the table have a least type, the column lands in it: its
    old files are read as that type. What has none lands in a column of its own,
    ``<name>__v_<type>``, and so do the single whole numbers that a fraction can't hold exactly.
    """
    clashing = [f for f in rows.schema.fields if f.name in known.names and f.dataType != known[f.name].dataType]
    inexact = {
        # The greatest whole number rounds up, and back to itself.
        f.name: (F.col(f"`{f.name}`") == 2**63 - 1)
        | (F.col(f"`{f.name}`").cast("double").try_cast("bigint") != F.col(f"`{f.name}`"))
        for f in clashing
        if isinstance(f.dataType, T.LongType) and least_type(known[f.name].dataType, f.dataType) == T.DoubleType()
    }
    if inexact:  # one pass over the load, and only where whole numbers meet fractions
        found = rows.agg(*[F.coalesce(F.bool_or(rule), F.lit(False)).alias(name) for name, rule in inexact.items()]).first()
        inexact = {name: rule for name, rule in inexact.items() if found[name]}
    out = []
    for field in rows.schema.fields:
        column, landed = F.col(f"`{field.name}`"), field.name
        if field in clashing:
            beside = f"{field.name}__v_" + re.sub(r"\W+", "_", field.dataType.simpleString()).strip("_")
            target = least_type(known[field.name].dataType, field.dataType)
            if target is None:
                landed = beside
            elif field.name in inexact:
                out.append(F.when(inexact[field.name], column).alias(beside))
                column = F.when(~inexact[field.name], column).cast(target)
            else:
                column = column.cast(target)
        out.append(column.alias(landed))
    return rows.select(*out)


def supports_merge_into(spark: SparkSession, table: str) -> bool:
    """Whether the table's format takes row-level ``MERGE INTO``; plain files do not."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    provider = described.filter(F.lower("col_name") == "provider").select("data_type").first()
    return bool(provider) and provider[0].lower() in ROW_LEVEL_PROVIDERS


def merge_into(
    delta: DataFrame, table: str, keys: Sequence[str], cursor: str | None = None
) -> None:
    """The same upsert for a catalog that applies it row by row."""
    view = "_landfall_delta"
    dedup_latest(delta, keys, cursor).createOrReplaceTempView(view)
    delta.sparkSession.sql(merge_statement(table, view, keys))


def merge_statement(table: str, view: str, keys: Sequence[str]) -> str:
    matched = " AND ".join(f"t.`{key}` <=> s.`{key}`" for key in keys)
    return (
        f"MERGE WITH SCHEMA EVOLUTION INTO {table} t USING {view} s ON {matched} "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )
