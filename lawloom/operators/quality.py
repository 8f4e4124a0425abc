"""Reports on keys and joins, distinct counts from sketches, checks made while writing."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F


def key_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row count, distinct keys, and whether the key is unique."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("__n"))
    return per_key.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("n_rows"),
        F.count("*").alias("n_keys"),
        (F.coalesce(F.max("__n"), F.lit(0)) <= 1).alias("is_unique"),
    )


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Fail when a key occurs twice."""
    report = key_report(df, keys).first()
    if not report["is_unique"]:
        raise ValueError(f"{','.join(keys)}: {report['n_rows']} rows but {report['n_keys']} keys")


def join_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row counts on both sides of a join, in one row."""
    sides = before.select(F.lit("before").alias("side")).unionAll(after.select(F.lit("after").alias("side")))
    counts = sides.agg(
        F.count_if(F.col("side") == "before").alias("n_before"),
        F.count_if(F.col("side") == "after").alias("n_after"),
    )
    return counts.withColumn("is_kept", F.col("n_before") == F.col("n_after"))


def rows_per(df: DataFrame, split: str) -> DataFrame:
    return df.groupBy(split).agg(F.count("*").alias("n_rows"))


#: Base-2 logarithm of a sketch's registers: 4 KiB a sketch, standard error of a union 1.6 %.
SKETCH_SIZE = 12
#: Standard errors within which an estimate is taken to lie.
SKETCH_ERRORS = 3


def distinct_sketches(df: DataFrame, split: str, key: str, size: int = SKETCH_SIZE) -> DataFrame:
    """One mergeable sketch of the distinct keys per split: split, sketch, n_rows (with a key).

    A sketch has a fixed size, so tasks send a few KiB per split however many keys there are, and stored
    sketches of splits answer for any span of them without reading the rows again.
    """
    return df.groupBy(split).agg(F.hll_sketch_agg(key, size).alias("sketch"), F.count(key).alias("n_rows"))


def distinct_over(sketches: DataFrame, spans: DataFrame, split: str, span: str, size: int = SKETCH_SIZE) -> DataFrame:
    """Estimated distinct keys of spans of splits: span, n_rows, n_keys, n_low, n_high.

    `spans` has a row for every split of a span. The bounds are SKETCH_ERRORS standard errors away.
    """
    united = sketches.join(spans, split).groupBy(span).agg(F.sum("n_rows").alias("n_rows"), F.hll_union_agg("sketch").alias("__s"))
    off = SKETCH_ERRORS * 1.04 / 2 ** (size / 2)
    n = F.hll_sketch_estimate("__s")
    return united.select(
        span, "n_rows", n.alias("n_keys"), F.floor(n * (1 - off)).alias("n_low"), F.ceil(n * (1 + off)).alias("n_high")
    )


def observed_write(df: DataFrame, checks: dict[str, Column], write: Callable[[DataFrame], None]) -> dict[str, int]:
    """Write `df` and count rows and the rows that meet each check in the same pass.

    The figures are gathered while the rows pass by, so nothing is read or made a second time.
    """
    watch = Observation()
    counts = [F.count_if(check).alias(name) for name, check in checks.items()]
    write(df.observe(watch, F.count(F.lit(1)).alias("n_rows"), *counts))
    return watch.get
