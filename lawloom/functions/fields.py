"""Projections that turn bill fields into export fields."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from lawloom.constants import BILL_TYPE_WORDS, BILL_URL_FORMAT, MEMBER_URL_PREFIX
from lawloom.functions.keys import last_segment


def lookup(code: Column, table: Mapping) -> Column:
    """Value for `code` in a fixed table, null when it is unknown."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), code)


def member_url(member_id: Column, prefix: str = MEMBER_URL_PREFIX) -> Column:
    return F.concat(F.lit(prefix), member_id)


def member_id_of_url(url: Column) -> Column:
    return last_segment(url)


def bill_url(congress: Column, bill_type: Column, number: Column, words: Mapping = BILL_TYPE_WORDS) -> Column:
    """Public page of a bill; null for a type without words."""
    word = lookup(bill_type, words)
    text = F.format_string(BILL_URL_FORMAT, congress.cast("string"), word, number.cast("string"))
    return F.when(word.isNotNull(), text)


def bracket_part(name: Column, n: int) -> Column:
    """n-th dash-separated part of the bracketed tail of a name such as `Rep. X [D-MA-2]`."""
    inner = F.regexp_extract(name, r"\[([^\]]*)\]", 1)
    return F.when(name.rlike(r"\[[^\]]*\]"), F.nullif(F.split_part(inner, F.lit("-"), F.lit(n)), F.lit("")))


def date_part(stamp: Column) -> Column:
    """Date of an ISO date-time text, null kept."""
    return F.split_part(stamp, F.lit("T"), F.lit(1))


def sorted_join(values: Column, sep: str = " | ") -> Column:
    return F.array_join(F.array_sort(values), sep)


def first_of(items: Column) -> Column:
    """First element, null for an empty list."""
    return F.get(items, 0)


def first_field(items: Column, field: str, default: str | None = None) -> Column:
    value = first_of(items)[field]
    return value if default is None else F.coalesce(value, F.lit(default))


def piped(items: Column, field: str, sep: str = "|") -> Column:
    """One field of every list item, joined; a null field prints as nothing but keeps its place."""
    return F.array_join(F.transform(items, lambda x: F.coalesce(x[field], F.lit(""))), sep)


def overlay(base: Column, over: Column) -> Column:
    """Merge two maps; on equal keys the second wins."""
    return F.map_concat(F.map_filter(base, lambda k, _: ~F.map_contains_key(over, k)), over)


def nulls_as_text(record: Column, text: str = "None") -> Column:
    return F.transform_values(record, lambda _, v: F.coalesce(v, F.lit(text)))


def printed_key(*parts: Column) -> Column:
    """Dash-joined key in which a missing part prints as `nan`."""
    return F.concat_ws("-", *[F.coalesce(p.cast("string"), F.lit("nan")) for p in parts])


def stamp_text(stamp: Column) -> Column:
    """Timestamp as text: no fraction when it is zero, else six digits."""
    whole = F.date_format(stamp, "yyyy-MM-dd HH:mm:ss")
    fraction = F.date_format(stamp, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.when(F.endswith(fraction, F.lit(".000000")), whole).otherwise(fraction)
