"""Typed access to positional JSON: total, strict in type, zero value when anything is off."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


NUMBER = "^(BIGINT|DECIMAL|DOUBLE|FLOAT|INT)"


def parsed(raw: Column) -> Column:
    """A variant, null if the text isn't JSON."""
    return F.try_parse_json(raw)


def at(v: Column, *path: int) -> Column:
    """The variant at an integer path, null where it leaves the arrays."""
    return F.try_variant_get(v, "$" + "".join(f"[{i}]" for i in path), "variant") if path else v


def kind(v: Column) -> Column:
    """Only for leaves: the schema of a large tree would merge all its elements."""
    return F.schema_of_variant(v)


def text(v: Column, *path: int) -> Column:
    leaf = at(v, *path)
    return F.coalesce(F.when(kind(leaf) == "STRING", F.try_variant_get(leaf, "$", "string")), F.lit(""))


def number(v: Column, *path: int) -> Column:
    leaf = at(v, *path)
    return F.coalesce(F.when(kind(leaf).rlike(NUMBER), F.try_variant_get(leaf, "$", "double")), F.lit(0.0))


def is_number(v: Column, *path: int) -> Column:
    return F.coalesce(kind(at(v, *path)).rlike(NUMBER), F.lit(False))


def whole(v: Column, *path: int) -> Column:
    """A number without its fraction."""
    return number(v, *path).cast("long")


def items(v: Column, *path: int) -> Column:
    """array<variant>; empty where there is no array."""
    return F.coalesce(F.try_variant_get(at(v, *path), "$", "array<variant>"), F.array().cast("array<variant>"))


def is_array(v: Column, *path: int) -> Column:
    return F.try_variant_get(at(v, *path), "$", "array<variant>").isNotNull()


def last_wins(entries: Column) -> Column:
    """A map of array<struct<key,value>> in which a later entry replaces an earlier one of its key."""
    kept = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda o: o["key"] == e["key"]))
    return F.map_from_entries(kept)
