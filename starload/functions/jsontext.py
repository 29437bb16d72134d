"""JSON field access that keeps "missing" apart from "present but null"."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OBJECT = "map<string,variant>"
STRICT = {"mode": "FAILFAST", "allowSingleQuotes": "false"}


def object_or_null(body: Column) -> Column:
    """Top-level JSON object as name -> value; NULL for anything else, trailing text included."""
    whole = F.when(body.rlike(r"\}\s*\z"), body)
    return F.try_variant_get(F.try_parse_json(whole), "$", OBJECT)


def object_or_fail(body: Column) -> Column:
    """As `object_or_null`, but anything that is not an object ends the job."""
    return F.coalesce(object_or_null(body), F.raise_error(F.lit("not a JSON object")))


def nested_object(value: Column) -> Column:
    """A nested value as an object; NULL when it is missing, null, or another type."""
    return F.try_variant_get(value, "$", OBJECT)


def has(obj: Column, name: str | Column) -> Column:
    """Is the field present, null or not? False for a NULL object."""
    return F.coalesce(F.map_contains_key(obj, name), F.lit(False))


def field(obj: Column, name: str | Column) -> Column:
    key = F.lit(name) if isinstance(name, str) else name
    return F.try_element_at(obj, key)


def once(*columns: Column) -> Column:
    """The columns of a parsed row, computed once.

    Without this, a later filter on a parsed column would be pushed below the parsing, and every
    mention of the column in it would parse the text again.
    """
    return F.inline(F.array(F.struct(*columns)))


def text(value: Column) -> Column:
    return F.variant_get(value, "$", "string")


def whole_number(value: Column) -> Column:
    """A JSON number as int, fractions rounded half away from zero; out of range fails."""
    return F.round(F.variant_get(value, "$", "double")).cast("int")


def with_default(obj: Column, name: str, default: Column, read) -> Column:
    """The default only stands in for a missing field; a null field stays NULL."""
    return F.when(has(obj, name), read(field(obj, name))).otherwise(default)


def is_truthy(value: Column) -> Column:
    """False for missing, null, false, zero and empty values (fixed list)."""
    shown = F.to_json(value)
    empty = ["null", "false", "0", "0.0", "-0.0", '""', "[]", "{}"]
    return value.isNotNull() & ~shown.isin(empty)


def is_one(value: Column) -> Column:
    """Equal to the number one: 1, 1.0 or true, but not the text "1"."""
    return F.coalesce(F.to_json(value).isin("1", "1.0", "true"), F.lit(False))


def dump(value: Column) -> Column:
    """JSON text of a value; a JSON null becomes the text null."""
    return F.to_json(value)


def strict_list(column: Column) -> Column:
    """Stored JSON list as an array of text; malformed or non-list text ends the job."""
    parsed = F.when(column.rlike(r"\]\s*\z"), F.from_json(column, "array<string>", STRICT))
    wrong = F.raise_error(F.concat(F.lit("not a JSON list: "), F.left(column, F.lit(80))))
    return F.when(column.isNotNull(), F.coalesce(parsed, wrong))


def clean_names(column: Column) -> Column:
    """Distinct, space-trimmed, non-blank elements of a stored JSON list."""
    trimmed = F.transform(strict_list(column), lambda name: F.trim(name))
    return F.filter(F.array_distinct(trimmed), lambda name: name != "")
