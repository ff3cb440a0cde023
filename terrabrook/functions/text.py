"""Text column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHITE = " \t\n\x0b\x0c\r"


def trim_white(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITE))


def address_of(title: Column, address: Column) -> Column:
    """The address without a leading "title,", trimmed."""
    prefix = F.concat(title, F.lit(","))
    return trim_white(F.when(F.startswith(address, prefix), F.substring(address, F.length(prefix) + 1, F.length(address))).otherwise(address))


def no_spaces(col: Column) -> Column:
    return F.replace(col, F.lit(" "), F.lit(""))


def after_first_line(col: Column) -> Column:
    """What follows the first newline; empty without one."""
    at = F.instr(col, "\n")
    return F.when(at > 0, F.substring(col, at + 1, F.length(col))).otherwise("")


def without_guard(col: Column) -> Column:
    """A payload without its anti-hijack prefix."""
    return F.regexp_replace(col, r"^\)\]\}'\n?", "")


def file_name(id_: Column, name: Column) -> Column:
    """"id-name.json" with all but letters, digits, - and _ of the name replaced by _; "results" if empty."""
    safe = F.regexp_replace(name, "[^A-Za-z0-9_-]", "_")
    return F.concat(id_.cast("string"), F.lit("-"), F.when(safe == "", "results").otherwise(safe), F.lit(".json"))


def client_file_name(keyword: Column) -> Column:
    """Trimmed and lower-cased, without punctuation, white space as _, at most 100 characters."""
    clean = F.regexp_replace(F.lower(trim_white(keyword)), r"[^\w\s-]", "")
    return F.left(F.regexp_replace(clean, r"\s+", "_"), F.lit(100))


def duration_text(seconds: Column) -> Column:
    """"Nd Nh Nm"; days only from one day, hours only from one hour."""
    s = seconds.cast("long")
    d, h, m = F.floor(s / 86400), F.floor(F.pmod(s, F.lit(86400)) / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60)
    return F.when(d > 0, F.format_string("%dd %dh %dm", d, h, m)).when(h > 0, F.format_string("%dh %dm", h, m)).otherwise(F.format_string("%dm", m))


def display_time(ts: Column) -> Column:
    return F.date_format(ts, "MMM dd, yyyy HH:mm:ss")


def float_text(col: Column) -> Column:
    """A double with six decimals, "" for null."""
    return F.coalesce(F.format_string("%f", col.cast("double")), F.lit(""))


# Characters that are escaped in JSON text, and their escapes.
JSON_ESCAPES = {"<": "\\u003c", ">": "\\u003e", "&": "\\u0026", "\u2028": "\\u2028", "\u2029": "\\u2029"}


def json_text(col: Column, kind: T.DataType | None = None) -> Column:
    """Compact JSON; null collections are the text null, <, > and & are escaped.

    With the column's type the keys of maps are sorted as text.
    """
    out = F.to_json(col if kind is None else with_sorted_keys(col, kind), {"ignoreNullFields": "false"})
    for character, escape in JSON_ESCAPES.items():
        out = F.replace(out, F.lit(character), F.lit(escape))
    return F.coalesce(out, F.lit("null"))


def with_sorted_keys(c: Column, kind: T.DataType) -> Column:
    """The value with every map's entries in order of the keys' text."""
    if isinstance(kind, T.MapType):
        entries = F.transform(F.map_entries(c), lambda e: F.struct(e["key"].cast("string").alias("key"), with_sorted_keys(e["value"], kind.valueType).alias("value")))
        return F.map_from_entries(F.array_sort(entries, lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: with_sorted_keys(x, kind.elementType))
    if isinstance(kind, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[with_sorted_keys(c[f.name], f.dataType).alias(f.name) for f in kind]))
    return c


def listed(col: Column) -> Column:
    return F.coalesce(F.array_join(col, ", "), F.lit(""))


def review_date(parts: Column) -> Column:
    """"Y-M-D" of three numbers, unpadded; "" of fewer."""
    return F.when(F.size(parts) >= 3, F.concat_ws("-", *[F.get(parts, i).cast("long") for i in range(3)])).otherwise("")


# Day names from 1.
DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def day_name(number: Column) -> Column:
    """1 is Monday, 7 Sunday; others are empty."""
    return F.coalesce(F.get(F.array(*[F.lit(d) for d in DAYS]), (number - 1).cast("int")), F.lit(""))
