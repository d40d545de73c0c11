"""Cells, subjects and tokens as column expressions, and the byte measure of a payload."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def hex_text(data: Column) -> Column:
    return F.lower(F.hex(data))


def bytes_text(data: Column) -> Column:
    """Binary cells: their text if it is UTF-8, else hex: and lower-case hex digits."""
    return F.when(F.is_valid_utf8(data.cast("string")), data.cast("string")).otherwise(F.concat(F.lit("hex:"), hex_text(data)))


def cell_json(cell: Column, kind: str) -> Column:
    """A cell as JSON text. kind: a log column type. Decimals, times and dates are strings, timestamps microseconds."""
    if kind in ("tiny", "short", "long", "longlong", "float", "double", "year", "bit", "set", "enum"):
        text = cell.cast("string")
    elif kind == "timestamp":
        text = F.unix_micros(cell).cast("string")
    elif kind in ("string", "blob", "json"):
        text = quoted(bytes_text(cell.cast("binary")))
    elif kind in ("decimal", "time", "date", "datetime"):
        text = quoted(cell.cast("string"))
    else:
        raise ValueError(f"unknown column type {kind}")
    return F.coalesce(text, F.lit("null"))


def quoted(text: Column) -> Column:
    """A JSON string. Null stays null."""
    escaped = F.to_json(F.struct(text.alias("t")))
    return F.when(text.isNotNull(), F.substr(escaped, F.lit(6), F.char_length(escaped) - 6))


def column_names(names: Column, n_values: Column) -> Column:
    """The names of a row image's cells: missing and empty ones, and those beyond the list, are col_ and their place."""
    places = F.when(n_values > 0, F.sequence(F.lit(0), n_values - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.coalesce(F.get(names, i), F.concat(F.lit("col_"), i.cast("string"))))


def row_image(names: Column, cells: Column) -> Column:
    """A JSON object of cells that are JSON text; null if there is no image. Null cells stay as null values."""
    pairs = F.zip_with(column_names(names, F.size(cells)), cells, lambda n, c: F.concat(quoted(n), F.lit(":"), F.coalesce(c, F.lit("null"))))
    return F.when(cells.isNotNull(), F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}")))


def subject(database: Column, table: Column) -> Column:
    """database.table, or the database alone where the table is empty or null."""
    return F.when(F.coalesce(table, F.lit("")) == "", database).otherwise(F.concat(database, F.lit("."), table))


def parse_subject(text: str) -> tuple[str, str]:
    database, dot, table = text.strip().partition(".")
    if not (database and dot and table):
        raise ValueError(f"{text!r} isn't database.table")
    return database, table


def token_time(token: Column) -> Column:
    """The cluster time in a resume token's data: struct<t, i>, null if it isn't in the expected form."""
    part = lambda at: F.conv(F.substring(token, at, 8), 16, 10).cast("long")
    return F.when(token.rlike("^82[0-9A-Fa-f]{16}"), F.struct(part(3).alias("t"), part(11).alias("i")))


def epoch_millis(time: Column) -> Column:
    """Milliseconds since 1970 of a time without a zone, or of one in the session's zone."""
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), time.cast("timestamp_ntz"))


def approx_bytes(value) -> int:
    """Bytes that a JSON value takes at least: strings by their length, containers by their parts and keys, others 8."""
    if isinstance(value, str):
        return len(value.encode())
    if isinstance(value, list):
        return sum(map(approx_bytes, value))
    if isinstance(value, dict):
        return sum(len(key.encode()) + approx_bytes(part) for key, part in value.items())
    return 8


def json_bytes(text: Column) -> Column:
    """approx_bytes of JSON text, for payloads of any shape."""
    @F.pandas_udf("long")
    def measured(some: pd.Series) -> pd.Series:
        return some.map(lambda x: None if x is None else approx_bytes(json.loads(x)))

    return measured(text)


def cell_bytes(cell: Column) -> Column:
    """approx_bytes of a cell that is JSON text: a string's length without quotes and escapes, 8 for all others."""
    told = F.when(F.instr(cell, "\\") == 0, F.octet_length(cell) - 2).otherwise(F.octet_length(F.get_json_object(F.concat(F.lit("["), cell, F.lit("]")), "$[0]")))
    return F.when(F.startswith(cell, F.lit('"')), told).otherwise(8).cast("long")


def image_bytes(names: Column, cells: Column) -> Column:
    """approx_bytes of a row image; a missing one is a null, 8."""
    each = F.zip_with(column_names(names, F.size(cells)), cells, lambda n, c: F.octet_length(n) + F.coalesce(cell_bytes(c), F.lit(8)))
    return F.coalesce(F.aggregate(each, F.lit(0).cast("long"), lambda total, x: total + x), F.lit(8).cast("long"))


def row_bytes(op: Column, names: Column, before: Column, after: Column, mode: str = "full") -> Column:
    """approx_bytes of the payload that envelopes.row_data makes, from its columns and without making it."""
    size = F.octet_length(op) + len("op")
    if mode == "signal":
        return (size + len("signal") + 8).cast("long")
    size += F.when(op.isin("update", "delete"), image_bytes(names, before) + len("before")).otherwise(0)
    return (size + F.when(op.isin("insert", "update"), image_bytes(names, after) + len("after")).otherwise(0)).cast("long")
