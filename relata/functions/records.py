"""Rows as JSON evidence, their hashes, fallback keys, and calendar helpers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F, types as T

from relata.functions.text import col, filled

JSON_OPTIONS = {"ignoreNullFields": "false"}


def utc(moment: datetime) -> datetime:
    """The moment with a zone; one without is meant as UTC, wherever the driver runs."""
    return moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)


def instant(moment: datetime) -> Column:
    """A literal instant that depends neither on the driver's nor on the session's zone."""
    return F.lit(utc(moment).astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")).cast("timestamp")


def utc_text(value: Column | str) -> Column:
    """An instant as ``yyyy-MM-ddTHH:mm:ss[.ffffff]Z`` with trailing zeros of the fraction dropped."""
    text = F.date_format(col(value), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(F.rtrim(F.rtrim(text, F.lit("0")), F.lit(".")), F.lit("Z"))


def _json_ready(field: T.StructField, column: Column) -> Column:
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return utc_text(column).alias(field.name)
    return column.alias(field.name)


def row_json(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """The row as one JSON object: all columns in order, NULLs written out."""
    wanted = columns or df.columns
    fields = {field.name: field for field in df.schema.fields}
    packed = F.struct(*[_json_ready(fields[name], F.col(f"`{name}`")) for name in wanted])
    return F.to_json(packed, JSON_OPTIONS)


def sorted_json(df: DataFrame) -> Column:
    """Like ``row_json`` but with the keys in alphabetical order."""
    return row_json(df, sorted(df.columns))


def hash_hex(text: Column | str) -> Column:
    return F.sha2(col(text).cast("binary"), 256)


def fallback_key(columns: Sequence[str], last_resort: Column) -> Column:
    """The first column with something in it, else ``last_resort``."""
    return F.coalesce(*[filled(name) for name in columns], last_resort)


def days_between(later: Column | str, earlier: Column | str) -> Column:
    return F.datediff(F.to_date(col(later)), F.to_date(col(earlier)))


def compact_day(day: Column | str) -> Column:
    return F.date_format(col(day), "yyyyMMdd")


def hours_before(moment: Column, hours: int) -> Column:
    return moment - F.expr(f"interval {int(hours)} hours")
