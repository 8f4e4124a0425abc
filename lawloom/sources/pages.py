"""Pages of a table in key order, out of a stored copy whose ranges of keys and row counts are indexed.

The copy is sorted once: each range of keys is a folder, and the index has one row for each with its number of
rows and how many come before. A page looks up its ranges, reads one or two of them and sorts nothing else. A
hundred rows and a hundred million cost the same at any depth.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lawloom.sources.tables import PAGE_ROWS

#: Rows of one range, about. A page reads that many at least.
RANGE_ROWS = 100_000
_RANGE = "page_range"


def write_pages(df: DataFrame, order: Sequence[str], path: str, rows_per_range: int = RANGE_ROWS) -> None:
    """Write `df` in ranges of `order`, which ends in a unique key, and the index of the ranges. Nulls come first."""
    spark = df.sparkSession
    ranges = max(1, -(-df.count() // rows_per_range))
    (
        df.repartitionByRange(ranges, *order).withColumn(_RANGE, F.spark_partition_id()).sortWithinPartitions(*order)
        .write.mode("overwrite").partitionBy(_RANGE).parquet(f"{path}/rows")
    )
    df.limit(0).write.mode("overwrite").parquet(f"{path}/schema")
    counts = _rows(spark, path).groupBy(_RANGE).agg(F.count("*").alias("n"))
    # One row per range: their running sum fits one task.
    before = F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy(_RANGE)) - F.col("n")
    counts.withColumn("before", before).coalesce(1).write.mode("overwrite").parquet(f"{path}/index")


def _rows(spark: SparkSession, path: str) -> DataFrame:
    schema = spark.read.parquet(f"{path}/schema").schema
    return spark.read.schema(schema.add(_RANGE, "integer")).parquet(f"{path}/rows")


def page_of(
    spark: SparkSession, path: str, order: Sequence[str], offset: int, length: int, max_length: int = PAGE_ROWS
) -> DataFrame:
    """Rows `offset` to `offset + length` in key order."""
    if length > max_length:
        raise ValueError(f"a page has at most {max_length} rows; {length} were asked for")
    index = spark.read.parquet(f"{path}/index")
    # The index's own filter gives only the ranges of the page: as a rule one or two.
    met = index.where((F.col("before") < offset + length) & (F.col("before") + F.col("n") > offset)).collect()
    rows = _rows(spark, path)
    if not met:
        return rows.drop(_RANGE).limit(0)
    first = min(r["before"] for r in met)
    wanted = rows.where(F.col(_RANGE).isin([r[_RANGE] for r in met]))
    return wanted.orderBy(_RANGE, *order).offset(offset - first).limit(length).drop(_RANGE)
