"""Member table: CSV scan, filters, keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from lawloom.constants import MEMBER_SCORES, PARTY_NAMES, REQUIRED_SCORES
from lawloom.functions.fields import lookup, member_url, printed_key
from lawloom.schemas import MEMBERS


def checked_members(spark: SparkSession, path: str) -> DataFrame:
    """Members from a CSV with a header, declared columns only, in whatever order the file has, and `violations`.

    A value that is there but is not of its column's type reads as null and names its column.
    """
    raw = spark.read.csv(path, header=True)
    text = {f.name: F.trim(F.col(f.name)) for f in MEMBERS.fields}
    values = {f.name: text[f.name].try_cast(f.dataType) for f in MEMBERS.fields}
    bad = [F.when((text[n] != "") & v.isNull(), F.lit(f"{n}:type")) for n, v in values.items()]
    return raw.select(*[v.alias(n) for n, v in values.items()], F.array_compact(F.array(*bad)).alias("violations"))


def read_members(spark: SparkSession, path: str) -> DataFrame:
    return checked_members(spark, path).drop("violations")


def quarantined_members(checked: DataFrame, required: Sequence[str] = REQUIRED_SCORES) -> DataFrame:
    """Members with a value of a wrong type; `is_dropped` tells which of them lack a required score by it."""
    lost = F.arrays_overlap("violations", F.array(*[F.lit(f"{c}:type") for c in required]))
    return checked.where(F.size("violations") > 0).withColumn("is_dropped", lost)


def filter_members(
    df: DataFrame,
    drop_president: bool = True,
    chamber: str = "chamber",
    president: str = "President",
    required: Sequence[str] = REQUIRED_SCORES,
) -> DataFrame:
    """Drop presidents (a missing chamber stays) and members without the required scores."""
    if drop_president:
        df = df.where(~F.col(chamber).eqNullSafe(F.lit(president)))
    return df.dropna(subset=list(required))


def member_rows(df: DataFrame) -> DataFrame:
    """Filtered members with page URL, party name and row id."""
    return (
        filter_members(df)
        .withColumn("bioguide_url", member_url(F.col("bioguide_id")))
        .withColumn("party_name", lookup(F.col("party_code"), PARTY_NAMES))
        .withColumn(
            "row_id",
            printed_key(F.col("congress"), F.col("bioguide_id"), F.col("icpsr"), F.col("district_code")),
        )
        .select(
            "row_id", "congress", "chamber", "bioguide_id", "bioguide_url", "icpsr", "district_code",
            "party_code", "party_name", *MEMBER_SCORES,
        )
    )
