"""Keyed tables stored by buckets of their key: upserts and joins on the key do not shuffle the stored side.

A table is kept as numbered versions in the catalog, `<name>__000001` and so on. An upsert reads the newest
one bucket by bucket, merges the incoming rows that hash to the bucket, and writes the next version the same
way; only incoming rows are shuffled. A version is complete before it gets its number, so readers and
restarted runs find a whole table. The version before the newest is kept for readers under way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from lawloom.operators.upsert import latest_rows
from lawloom.session import scratch_path

KEPT_VERSIONS = 2


def versions(spark: SparkSession, name: str) -> list[str]:
    """Catalog names of a table's versions, oldest first."""
    rows = spark.sql(f"SHOW TABLES LIKE '{name.lower()}__*'").collect()
    return sorted(r["tableName"] for r in rows if r["tableName"].rsplit("__", 1)[1].isdigit())


def stored(spark: SparkSession, name: str) -> DataFrame:
    """The newest version."""
    return spark.table(versions(spark, name)[-1])


def write_buckets(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> str:
    """Write `df` as the next version of a table; returns its catalog name.

    Rows that are already dealt by the key into as many partitions are not dealt again.
    """
    spark = df.sparkSession
    known = versions(spark, name)
    number = int(known[-1].rsplit("__", 1)[1]) + 1 if known else 1
    fresh = f"{name.lower()}__{number:06d}"
    folder = path or scratch_path(spark, fresh)
    df.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", folder).saveAsTable(fresh)
    for old in known[: -(KEPT_VERSIONS - 1) or None]:
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    return fresh


def create_buckets(df: DataFrame, name: str, key: str, buckets: int) -> str:
    """First version: rows are dealt by their key once, so every bucket is one file."""
    return write_buckets(df.repartition(buckets, key), name, key, buckets)


def merged_buckets(
    held: DataFrame, incoming: DataFrame, key: str, order: Sequence[str], buckets: int, keep: Sequence[str] = ()
) -> DataFrame:
    """`held` (in so many buckets, one row per key) with `incoming` applied: the same rule as `merge_latest`.

    An incoming row replaces the stored one unless that is newer; `keep` columns of a stored row stay. Incoming
    rows are dealt as the buckets are, which serves both their grouping and the join.
    """
    newest = latest_rows(incoming.select(*held.columns).repartition(buckets, key), [key], order)
    old, new = held.select(key, F.struct(*held.columns).alias("__old")), newest.select(key, F.struct(*held.columns).alias("__new"))
    both = old.join(new, key, "full_outer")
    rank = lambda side: F.struct(*[F.col(f"{side}.{c}") for c in order])
    known, came = F.col("__old").isNotNull(), F.col("__new").isNotNull()
    taken = came & (~known | (rank("__new") >= rank("__old")))

    def value(c: str):
        fresh = F.when(known, F.col(f"__old.{c}")).otherwise(F.col(f"__new.{c}")) if c in keep else F.col(f"__new.{c}")
        return F.when(taken, fresh).otherwise(F.col(f"__old.{c}")).alias(c)

    return both.select(F.col(key), *[value(c) for c in held.columns if c != key]).select(*held.columns)


def upsert_buckets(
    incoming: DataFrame, name: str, key: str, order: Sequence[str], buckets: int, keep: Sequence[str] = ()
) -> DataFrame:
    """Apply `incoming` to a bucketed table (made if it does not exist); returns the new version."""
    spark = incoming.sparkSession
    if versions(spark, name):
        write_buckets(merged_buckets(stored(spark, name), incoming, key, order, buckets, keep), name, key, buckets)
    else:
        create_buckets(latest_rows(incoming, [key], order), name, key, buckets)
    return stored(spark, name)
