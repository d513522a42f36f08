"""From records to rows: exclude, parse and flatten, promote, HTML, tombstone flag.

Every step is a column expression of one projection, so a whole resource is
shaped inside one scan stage; only HTML leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from landfall.contract import Resource
from landfall.functions.html import strip_html
from landfall.functions.jsontext import as_json_text, dig, field_named, is_nested
from landfall.functions.naming import snake_case, snake_case_columns
from landfall.functions.timestamps import parse_timestamp

DELETED = "_deleted"
LOAD_ID = "_load_id"


def exclude_fields(df: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """Drop fields before anything else can read them."""
    return df.drop(*fields)


def flatten_json(df: DataFrame, timestamp_columns: tuple[str, ...] = ()) -> DataFrame:
    """Nested values as JSON text, the named columns as timestamps, the rest as is."""
    return df.select(
        *[
            _flat(field, timestamp_columns).alias(field.name)
            for field in df.schema.fields
        ]
    )


def promote_fields(
    df: DataFrame,
    promote: Mapping[str, str],
    timestamp_targets: tuple[str, ...] = (),
) -> DataFrame:
    """Add ``{path: target}`` columns; the nested originals stay."""
    columns = {name: F.col(f"`{name}`") for name in df.columns}
    columns.update(_promoted(df.schema, promote, timestamp_targets))
    return df.select(*[value.alias(name) for name, value in columns.items()])


def contain_open_map(
    df: DataFrame, map_column: str, allowed: Mapping[str, str]
) -> DataFrame:
    """A map of unbounded keys as one JSON column, with only the allowed keys
    as columns of their own. ``allowed`` maps a key to its column."""
    return df.select(
        *[F.col(f"`{name}`") for name in df.columns if name != map_column],
        F.to_json(map_column, {"ignoreNullFields": "false"}).alias(map_column),
        *[F.col(map_column).getItem(key).alias(target) for key, target in allowed.items()],
    )


def add_tombstone_flag(df: DataFrame) -> DataFrame:
    """``_deleted`` false on every row that does not bring its own value.

    A row that lands again is live again. A null from the source counts as live.
    """
    return df.withColumn(DELETED, _tombstone_flag(df.schema))


def cast_hinted(df: DataFrame, resource: Resource) -> DataFrame:
    """Fixed types for exactly the columns something compares."""
    hints = column_hints(resource)
    return df.select(
        *[
            (F.col(f"`{name}`").cast(hints[name]) if name in hints else F.col(f"`{name}`"))
            .alias(name)
            for name in df.columns
        ]
    )


def column_hints(resource: Resource) -> dict[str, T.DataType]:
    hints: dict[str, T.DataType] = dict.fromkeys(resource.hint_columns, T.TimestampType())
    if resource.soft_delete:
        hints[DELETED] = T.BooleanType()
    return hints


def inject_parent(
    children: DataFrame, parent_id: Column, changed_at: Column, id_name: str, changed_name: str
) -> DataFrame:
    """Parent id and parent changed-at on every child row, always overwritten."""
    return children.withColumns({id_name: parent_id, changed_name: changed_at})


def shape(
    resource: Resource, types: Mapping[str, T.DataType | str] | None = None
) -> Callable[[DataFrame], DataFrame]:
    """The whole chain for one resource, for ``DataFrame.transform``.

    ``types`` fixes the landed type of columns dug out of JSON text, which are
    text otherwise.
    """
    promoted_timestamps = tuple(
        target for target in resource.promote.values() if target in resource.hint_columns
    )
    hints = {**column_hints(resource), **(types or {})}

    def shaped(records: DataFrame) -> DataFrame:
        kept = exclude_fields(records, resource.exclude_columns)
        columns = {
            field.name: _flat(field, resource.timestamp_columns) for field in kept.schema.fields
        }
        columns.update(_promoted(kept.schema, resource.promote, promoted_timestamps))
        for source, target in resource.html_text.items():
            present = field_named(kept.schema, source) is not None
            columns[target] = (
                strip_html(F.col(f"`{source}`")) if present else F.lit(None).cast("string")
            )
        if resource.soft_delete:
            columns[DELETED] = _tombstone_flag(kept.schema)
        return kept.select(
            *[
                (value.cast(hints[name]) if name in hints else value).alias(name)
                for name, value in columns.items()
            ]
        )

    return shaped


def landed_rows(
    records: DataFrame,
    resource: Resource,
    load_id: str,
    types: Mapping[str, T.DataType | str] | None = None,
) -> DataFrame:
    """Rows as they land: shaped, in landed spelling, stamped with the load."""
    rows = snake_case_columns(records.transform(shape(resource, types)))
    return rows.withColumn(LOAD_ID, F.lit(load_id))


def landed_key(resource: Resource) -> tuple[str, ...]:
    return tuple(snake_case(name) for name in resource.primary_key)


def sample_landed(rows: DataFrame, keys: tuple[str, ...], n: int) -> DataFrame:
    """The first ``n`` rows by key, as they land: a top-n per task, never a full sort."""
    others = [name for name in rows.columns if name not in keys]
    return rows.orderBy(*keys, *others).limit(n)


def _flat(field: T.StructField, timestamp_columns: tuple[str, ...]) -> Column:
    value = F.col(f"`{field.name}`")
    if field.name in timestamp_columns:
        return parse_timestamp(value, field.dataType)
    return as_json_text(value, field.dataType) if is_nested(field.dataType) else value


def _promoted(
    schema: T.StructType, promote: Mapping[str, str], timestamp_targets: tuple[str, ...]
) -> dict[str, Column]:
    columns = {}
    for path, target in promote.items():
        value, kind = dig(schema, path, typed=target in timestamp_targets)
        if target in timestamp_targets:
            value = parse_timestamp(value, kind)
        elif is_nested(kind):
            value = as_json_text(value, kind)
        columns[target] = value
    return columns


def _tombstone_flag(schema: T.StructType) -> Column:
    if field_named(schema, DELETED) is None:
        return F.lit(False)
    return F.coalesce(F.col(DELETED).cast("boolean"), F.lit(False))
