"""Nested values: as JSON text, and one step at a time along a dotted path."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

_NESTED = (T.StructType, T.ArrayType, T.MapType)


def is_nested(data_type: T.DataType) -> bool:
    return isinstance(data_type, (*_NESTED, T.VariantType))


def as_json_text(value: Column, data_type: T.DataType) -> Column:
    """A nested value as compact JSON text that keeps null fields."""
    if isinstance(data_type, T.VariantType):
        return value.cast("string")
    return F.to_json(value, {"ignoreNullFields": "false"})


def json_path(steps: list[str]) -> str:
    for step in steps:
        if "'" in step:
            raise ValueError(f"a path step cannot hold a quote: {step!r}")
    return "$" + "".join(f"['{step}']" for step in steps)


def field_named(schema: T.StructType, name: str) -> T.StructField | None:
    return next((field for field in schema.fields if field.name == name), None)


def dig(schema: T.StructType, dotted: str, typed: bool = False) -> tuple[Column, T.DataType]:
    """The value at ``a.b.c`` and its type; null where a step does not exist.

    A value inside JSON text comes out as text, or with ``typed`` as a VARIANT,
    which still knows a number from a string.
    """
    head, *rest = dotted.split(".")
    found = field_named(schema, head)
    if found is None:
        return _nothing()
    return _descend(F.col(f"`{head}`"), found.dataType, rest, typed)


def _nothing() -> tuple[Column, T.DataType]:
    return F.lit(None).cast("string"), T.StringType()


def _descend(
    value: Column, kind: T.DataType, rest: list[str], typed: bool
) -> tuple[Column, T.DataType]:
    if not rest:
        return value, kind
    if isinstance(kind, T.StringType) and typed:
        value, kind = F.try_parse_json(value), T.VariantType()
    if isinstance(kind, T.StringType):
        return F.get_json_object(value, json_path(rest)), kind
    if isinstance(kind, T.VariantType):
        return F.try_variant_get(value, json_path(rest), "variant"), kind
    if isinstance(kind, T.StructType):
        found = field_named(kind, rest[0])
        if found is not None:
            return _descend(value.getField(rest[0]), found.dataType, rest[1:], typed)
    if isinstance(kind, T.MapType) and isinstance(kind.keyType, T.StringType):
        return _descend(value.getItem(rest[0]), kind.valueType, rest[1:], typed)
    return _nothing()
