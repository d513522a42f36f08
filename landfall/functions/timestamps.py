"""Timestamps as sources send them: ISO text, epoch seconds, epoch milliseconds."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Fixed value: a number of this size or more counts milliseconds, below it seconds.
MILLIS_THRESHOLD = 10**12

# Fixed value: the text form of a cursor for sources that filter on wall-clock text.
CURSOR_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def parse_timestamp(value: Column, source_type: T.DataType) -> Column:
    """``value`` as a UTC instant, by the type it arrived with.

    Null and empty text give null, zero is 1970, booleans and timestamps pass
    through, and text that is no timestamp raises. Needs a UTC session zone for
    text without an offset.
    """
    if isinstance(source_type, T.StringType):
        return _from_text(value)
    if isinstance(source_type, _INTEGRAL):
        return _from_whole_number(value.cast("bigint"))
    if isinstance(source_type, _FRACTIONAL):
        return _from_fraction(value.cast("double"))
    if isinstance(source_type, T.VariantType):
        return _from_variant(value)
    return value


def _from_text(value: Column) -> Column:
    # Most text casts directly. The basic form without separators is rewritten first.
    # Text without a date would be read against today's.
    dated = F.when(value.rlike(r"^\s*[+-]?\d{4}"), value)
    dashed = F.regexp_replace(dated, r"^(\d{4})(\d{2})(\d{2})(?=T|$)", "$1-$2-$3")
    spelled = F.regexp_replace(dashed, r"T(\d{2})(\d{2})(\d{2})?", "T$1:$2:$3")
    spelled = F.regexp_replace(spelled, r":(?=$|[Z+-])", "")
    complaint = F.concat(F.lit("not a timestamp: "), value)
    return F.when(value.isNull() | (value == ""), F.lit(None).cast("timestamp")).otherwise(
        F.coalesce(
            dated.try_cast("timestamp"),
            spelled.try_cast("timestamp"),
            F.raise_error(complaint).cast("timestamp"),
        )
    )


def _from_whole_number(value: Column) -> Column:
    return F.when(F.abs(value) >= MILLIS_THRESHOLD, F.timestamp_millis(value)).otherwise(
        F.timestamp_seconds(value)
    )


def _from_fraction(value: Column) -> Column:
    scale = F.when(F.abs(value) >= MILLIS_THRESHOLD, F.lit(1e3)).otherwise(F.lit(1e6))
    return F.timestamp_micros(F.bround(value * scale).cast("bigint"))


def _from_variant(value: Column) -> Column:
    kind = F.schema_of_variant(value)
    return (
        F.when(kind == "STRING", _from_text(F.try_variant_get(value, "$", "string")))
        .when(kind == "BIGINT", _from_whole_number(F.try_variant_get(value, "$", "bigint")))
        .when(
            kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"),
            _from_fraction(F.try_variant_get(value, "$", "double")),
        )
        .when(value.isNull() | (kind == "VOID"), F.lit(None).cast("timestamp"))
        .otherwise(
            F.raise_error(F.concat(F.lit("not a timestamp: "), kind)).cast("timestamp")
        )
    )


def format_cursor(cursor: Column, form: str, lookback_seconds: int = 0) -> Column:
    """A cursor as the source wants to be asked: wall-clock ``text`` or ``epoch_ms``."""
    bound = cursor.cast("timestamp") - F.make_dt_interval(secs=F.lit(lookback_seconds))
    if form == "text":
        return F.date_format(bound, CURSOR_TEXT_FORMAT)
    if form == "epoch_ms":
        return F.unix_millis(bound)
    raise ValueError(f"unknown cursor form {form!r}; known are text, epoch_ms")
