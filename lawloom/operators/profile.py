"""Corpus profiles: tag counts and document shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lawloom.functions.text import child_names


def tag_counts(df: DataFrame, xml: str, parent: str) -> DataFrame:
    """How often each tag occurs among the children of the elements named `parent`, which hold none of their own name."""
    elements = F.regexp_extract_all(xml, F.lit(rf"(?s)<{parent}(?:\s[^>]*)?>.*?</{parent}\s*>"), 0)
    tags = df.select(F.explode(elements).alias("element")).select(F.explode(child_names(F.col("element"))).alias("tag"))
    return tags.groupBy("tag").agg(F.count("*").alias("n"))


def tag_shapes(df: DataFrame, xml: str, sep: str = ">") -> DataFrame:
    """How often each ordered list of root children occurs."""
    shapes = df.select(F.array_join(child_names(F.col(xml)), sep).alias("shape"))
    return shapes.groupBy("shape").agg(F.count("*").alias("n"))
