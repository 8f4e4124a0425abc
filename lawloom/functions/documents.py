"""JSON texts as VARIANT values: parsed once, then read by path with a type."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parsed(text: Column) -> Column:
    """A JSON text as a VARIANT value; null if it is malformed."""
    return F.try_parse_json(text)


def is_malformed(text: Column, value: Column) -> Column:
    """Whether there was a text that could not be parsed."""
    return text.isNotNull() & value.isNull()


def at(value: Column, path: str, kind: str) -> Column:
    """What stands at a path, as `kind`; null if there is nothing or something of another kind."""
    return F.try_variant_get(value, path, kind)


def seen_schema(value: Column) -> Column:
    """Aggregate: the schema that fits all values."""
    return F.schema_of_variant_agg(value)
