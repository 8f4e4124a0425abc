"""Retrieved passages as one context text per question."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lawloom.constants import PASSAGE_FORMAT


def passage(number: Column, legis_id: Column, text: Column) -> Column:
    return F.format_string(PASSAGE_FORMAT, number, legis_id, text)


def build_context(
    hits: DataFrame,
    question: str = "query_id",
    rank: str = "rank",
    legis_id: str = "legis_id",
    text: str = "text",
) -> DataFrame:
    """One text per question: its passages in rank order, numbered from 0, blank line between.

    A question has at most k passages, so each collected list is small.
    """
    number = (F.col(rank) - 1).cast("int")
    rows = hits.select(
        question, F.struct(number.alias("n"), passage(number, F.col(legis_id), F.col(text)).alias("p")).alias("x")
    )
    packed = rows.groupBy(question).agg(F.sort_array(F.collect_list("x")).alias("xs"))
    return packed.select(
        question, F.array_join(F.transform("xs", lambda x: x["p"]), "\n\n").alias("context"), F.size("xs").alias("n")
    )
