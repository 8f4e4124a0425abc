"""Keys and document classes taken from paths, names and markup."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from lawloom.constants import BILL_NAME_PATTERN, LAW_NAME_PATTERN, ROOT_TAGS, STATUS_PATH_PATTERN


def last_segment(path: Column, sep: str = "/") -> Column:
    """Text after the last separator: a file's base name, a URL's last part."""
    return F.split_part(path, F.lit(sep), F.lit(-1))


def parent_folder(path: Column) -> Column:
    return F.regexp_replace(path, r"/[^/]*$", "")


def stem(name: Column) -> Column:
    """A name up to its first dot."""
    return F.split_part(name, F.lit("."), F.lit(1))


def relative_path(path: Column, root: str) -> Column:
    """`path` without everything up to and including `root/`, whatever scheme either has."""
    folder = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", root).rstrip("/")
    return F.regexp_replace(path, "^.*?\\Q" + folder + "\\E/", "")


def dashed(*parts: Column) -> Column:
    """Composite key: the parts joined by dashes; null when any part is null."""
    pieces = [p.cast("string") for p in parts]
    missing = pieces[0].isNull()
    for p in pieces[1:]:
        missing = missing | p.isNull()
    return F.when(~missing, F.concat_ws("-", *pieces))


def status_path_parts(path: Column) -> Column:
    """Bill keys in a status file's relative path, null when the path has another form."""
    def group(n: int) -> Column:
        return F.regexp_extract(path, STATUS_PATH_PATTERN, n)

    return F.when(
        path.rlike("^" + STATUS_PATH_PATTERN),
        F.struct(
            group(1).cast("int").alias("congress_num"),
            group(2).alias("legis_class"),
            group(3).alias("legis_type"),
            group(5).cast("int").alias("legis_num"),
        ),
    )


def text_name_parts(name: Column) -> Column:
    """Keys, class and version in a text file's name; bill names are tried before law names."""
    def parts(pattern: str, legis_class: str, version: Column) -> Column:
        return F.struct(
            F.regexp_extract(name, pattern, 1).cast("int").alias("congress_num"),
            F.lit(legis_class).alias("legis_class"),
            F.regexp_extract(name, pattern, 2).alias("legis_type"),
            F.regexp_extract(name, pattern, 3).cast("int").alias("legis_num"),
            version.alias("legis_version"),
        )

    return F.when(
        name.rlike("^" + BILL_NAME_PATTERN),
        parts(BILL_NAME_PATTERN, "bills", F.regexp_extract(name, BILL_NAME_PATTERN, 4)),
    ).when(name.rlike("^" + LAW_NAME_PATTERN), parts(LAW_NAME_PATTERN, "plaw", F.lit("plaw")))


def markup_kind(path: Column, marker: str = "/uslm/", inside: str = "uslm", outside: str = "dtd") -> Column:
    return F.when(F.contains(path, F.lit(marker)), inside).otherwise(outside)


def root_tag(xml: Column) -> Column:
    """Name of the first element, without namespace prefix; empty when there is none."""
    body = F.regexp_replace(xml, r"(?s)<!--.*?-->", "")
    return F.regexp_extract(body, r"<(?:[A-Za-z_][\w.-]*:)?([A-Za-z_][\w.-]*)", 1)


def known_root(tag: Column, allowed: tuple[str, ...] = ROOT_TAGS) -> Column:
    return tag.isin(*allowed)
