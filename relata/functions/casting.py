"""Casts that never fail, with full-shape guards in front of the engine's lenient parsers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from relata.functions.text import col, lower_trimmed, trimmed

NUMERIC = "decimal(38,9)"

# The words read as booleans, trimmed and without regard to case.
TRUE_WORDS = ("true", "t", "1", "yes", "y")
FALSE_WORDS = ("false", "f", "0", "no", "n")

INTEGER_SHAPE = r"^[+-]?\d+\z"
FLOAT_SHAPE = r"^[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|[nN][aA][nN]|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\z"
ISO_DATE_SHAPE = r"^\d{4}-\d{2}-\d{2}\z"
LOOSE_DATE_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}\z"
ISO_TIMESTAMP_SHAPE = (
    r"^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}:\d{2}(\.\d{3}(\d{3})?)?(Z|[+-]\d{2}:\d{2})?)?\z"
)
LOOSE_TIMESTAMP_SHAPE = (
    r"^\d{4}-\d{1,2}-\d{1,2}(T\d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?\s?(UTC|Z|[+-]\d{1,2}(:\d{2})?)?)?\z"
)
ZONE_SHAPE = r"(UTC|Z|[+-]\d{1,2}(:\d{2})?)\z"


def _shaped(text: Column, shape: str) -> Column:
    return F.when(text.rlike(shape), text)


def _instant(text: Column, shape: str) -> Column:
    """Text to an instant; a text without a zone is read as UTC whatever the session zone is."""
    iso = _shaped(F.regexp_replace(text, r"^(\d{4}-\d{1,2}-\d{1,2})[ tT]", "$1T"), shape)
    with_time = F.when(iso.contains("T"), iso).otherwise(F.concat(iso, F.lit("T00:00:00")))
    zone_given = F.substring_index(with_time, "T", -1).rlike(ZONE_SHAPE) | with_time.endswith("UTC")
    return F.when(zone_given, with_time).otherwise(F.concat(with_time, F.lit("Z"))).try_cast("timestamp")


def contract_integer(value: Column | str) -> Column:
    return _shaped(trimmed(value), INTEGER_SHAPE).try_cast("bigint")


def contract_float(value: Column | str) -> Column:
    return _shaped(trimmed(value), FLOAT_SHAPE).try_cast("double")


def contract_bool(value: Column | str) -> Column:
    word = lower_trimmed(value)
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))


def contract_date(value: Column | str) -> Column:
    return _shaped(col(value), ISO_DATE_SHAPE).try_cast("date")


def contract_timestamp(value: Column | str) -> Column:
    with_seconds = F.regexp_replace(col(value), r"([ T]\d{2}:\d{2})(?=Z|[+-]|$)", "$1:00")
    return _instant(with_seconds, ISO_TIMESTAMP_SHAPE)


#: contract type -> (Spark type, cast of a text column)
CONTRACT_CASTS = {
    "STRING": (T.StringType(), lambda value: col(value)),
    "INTEGER": (T.LongType(), contract_integer),
    "FLOAT": (T.DoubleType(), contract_float),
    "BOOL": (T.BooleanType(), contract_bool),
    "DATE": (T.DateType(), contract_date),
    "TIMESTAMP": (T.TimestampType(), contract_timestamp),
}


def safe_cast(value: Column | str, target: str, source: str = "string") -> Column:
    """The warehouse's SAFE_CAST: NULL where the value cannot be read as ``target``.

    ``source`` is the Spark type name of the input. Text is checked against the whole shape first;
    fractions become integers by rounding half away from zero, as in the warehouse.
    """
    column = col(value)
    textual = source == "string"
    if target == "numeric":
        return (trimmed(column) if textual else column).try_cast(NUMERIC)
    if target == "double":
        return contract_float(column) if textual else column.try_cast("double")
    if target == "int64":
        if textual:
            return contract_integer(column)
        fractional = source in ("double", "float") or source.startswith("decimal")
        return (F.round(column, 0) if fractional else column).try_cast("bigint")
    if target == "bool":
        word = lower_trimmed(column)
        return (
            F.when(word == "true", F.lit(True)).when(word == "false", F.lit(False))
            if textual
            else column.try_cast("boolean")
        )
    if target == "date":
        return _shaped(trimmed(column), LOOSE_DATE_SHAPE).try_cast("date") if textual else column.try_cast("date")
    if target == "timestamp":
        return _instant(trimmed(column), LOOSE_TIMESTAMP_SHAPE) if textual else column.try_cast("timestamp")
    raise ValueError(f"no safe cast to {target}")
