"""Row numbers that hold at any size: no task has to see all rows, or all rows of one key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from lawloom.session import cut_lineage

_ID_SHIFT = 33  # monotonically_increasing_id: partition number above, row number below


def number_rows(df: DataFrame, order: Sequence[Column], name: str = "row_num", start: int = 0) -> DataFrame:
    """Number rows in `order`, which must decide every tie that matters.

    Rows are split by ranges of `order` and sorted per range. The numbered ranges are written once;
    each range's offset comes from the row counts of the ranges before it.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(
        df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id())
    )
    part = F.shiftright("__id", _ID_SHIFT)
    # At most one row per range, so at most spark.sql.shuffle.partitions rows reach the driver.
    sizes = sorted((r[0], r[1]) for r in ranged.groupBy(part).count().collect())
    offsets, seen = [], 0
    for p, n in sizes:
        offsets.append((p, seen - (p << _ID_SHIFT)))
        seen += n
    offset_rows = spark.createDataFrame(offsets, "__part bigint, __offset bigint")
    placed = (
        ranged.withColumn("__part", part)
        .join(F.broadcast(offset_rows), "__part")
        .withColumn(name, F.col("__id") + F.col("__offset") + F.lit(start))
        .drop("__part", "__offset", "__id")
    )
    return placed


def number_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "row_num", start: int = 0
) -> DataFrame:
    """Number rows within keys, by ranges of (keys, order): a key with many rows lies in many tasks.

    A window numbers the rows of a key inside each range. Only the key a range begins with can have
    rows in ranges before it; how many is known from one count per range, so the rows are never joined
    or gathered by the key alone.
    """
    spark = df.sparkSession
    by = [F.col(k) for k in keys] + list(order)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(
        df.repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumn("__id", F.monotonically_increasing_id())
    ).withColumn("__part", F.shiftright("__id", _ID_SHIFT))
    key = F.struct(*keys)
    # One row per range: its first and last key, and how many rows they have there.
    counts = ranged.groupBy("__part", *keys).agg(F.count("*").alias("__n")).groupBy("__part").agg(
        F.min(F.struct(key.alias("k"), "__n")).alias("first"), F.max(F.struct(key.alias("k"), "__n")).alias("last")
    )
    carried, open_key, seen = [], None, 0
    for row in sorted(counts.collect(), key=lambda r: r["__part"]):
        first, last = row["first"], row["last"]
        before = seen if open_key is not None and first["k"] == open_key else 0
        carried.append((row["__part"], tuple(first["k"]), before))
        seen = last["__n"] + (before if first["k"] == last["k"] else 0)
        open_key = last["k"]
    schema = T.StructType(
        [T.StructField("__p", T.LongType()), T.StructField("__k", T.StructType([df.schema[k] for k in keys])), T.StructField("__before", T.LongType())]
    )
    # At most one row per range.
    before = F.broadcast(spark.createDataFrame(carried, schema))
    same = F.col("__part") == F.col("__p")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__k.{k}"))
    here = F.row_number().over(Window.partitionBy("__part", *keys).orderBy("__id"))
    return (
        ranged.withColumn("__here", here).join(before, same, "left")
        .withColumn(name, F.col("__here") - 1 + F.coalesce("__before", F.lit(0)) + F.lit(start))
        .drop("__here", "__id", "__part", "__p", "__k", "__before")
    )


def batch_ids(df: DataFrame, order: Sequence[Column], size: int, name: str = "batch_id") -> DataFrame:
    """Consecutive batches of `size` rows in `order`."""
    numbered = number_rows(df, order, name="__row")
    return numbered.withColumn(name, F.floor(F.col("__row") / F.lit(size)).cast("bigint")).drop("__row")
