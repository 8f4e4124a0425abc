"""Stage tables: scans, point lookups, pages and heads."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, functions as F

from lawloom.operators.numbering import number_rows


#: Rows of a page at most.
PAGE_ROWS = 100
#: Large tables are brought together in rounds, each with its share of the keys: one round for each so many bytes of
#: stored files, so that what is shuffled at a time is a part of them. Each round scans them, hence not too many.
ROUND_BYTES, MOST_ROUNDS = 512 << 20, 4


def read_stage(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A stage's parquet data; name columns to read only those."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def _hadoop_path(spark: SparkSession, path: str):
    """A path and its file system, as Spark's own readers see them."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a folder; nothing below it is listed."""
    where, store = _hadoop_path(spark, path)
    return store.exists(where)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Take away a folder of files, as that of a split without rows."""
    where, store = _hadoop_path(spark, path)
    store.delete(where, True)


def save(writer: DataFrameWriter, path: str) -> None:
    """Write a kept table's files: ids and URLs repeat long stretches of each other, which zstd leaves out."""
    writer.option("compression", "zstd").parquet(path)


def replace_splits(spark: SparkSession, parts: Iterable[DataFrame], path: str, split: str) -> set[str]:
    """Replace the splits of the folder at `path` that any of `parts` has rows of; the names of their folders.

    The parts are written one after another beside the splits, which are replaced when all are complete.
    """
    staged = f"{path}.staged-{uuid4().hex}"
    try:
        for df in parts:
            save(df.write.mode("append").partitionBy(split), staged)
    except BaseException:
        drop_folder(spark, staged)
        raise
    where, store = _hadoop_path(spark, staged)
    store.mkdirs(_hadoop_path(spark, path)[0])
    names = {f.getPath().getName() for f in store.listStatus(where) if f.isDirectory()}
    for name in names:
        old, new = (_hadoop_path(spark, f"{p}/{name}")[0] for p in (path, staged))
        store.delete(old, True)
        if not store.rename(new, old):
            raise OSError(f"{new} could not be renamed to {old}")
    drop_folder(spark, staged)
    return names


def round_count(*frames: DataFrame) -> int:
    """In how many rounds to bring tables together, by the size of the files they are read from."""
    leaves = [f._jdf.queryExecution().optimizedPlan().collectLeaves() for f in frames]
    sizes = [int(x.apply(i).stats().sizeInBytes()) for x in leaves for i in range(x.size())]
    # What is in memory has no size or one that nobody knows.
    return min(MOST_ROUNDS, 1 + sum(s for s in sizes if s < 1 << 60) // ROUND_BYTES)


def round_of(keys: Sequence[str], rounds: int) -> Column:
    """The round that a row's keys are in."""
    return F.pmod(F.xxhash64(*keys), F.lit(rounds)).cast("int")


def of_round(df: DataFrame, keys: Sequence[str], n: int, rounds: int) -> DataFrame:
    return df if rounds == 1 else df.where(round_of(keys, rounds) == n)


def select_splits(df: DataFrame, splits: Sequence, column: str = "congress_num") -> DataFrame:
    """Rows of the named splits; on a table partitioned by `column` other splits are not read."""
    return df.where(F.col(column).isin(*splits))


def chosen_splits(df: DataFrame, wanted: DataFrame, column: str = "congress_num") -> DataFrame:
    """Rows of the splits that a filtered table names; on a table partitioned by `column` the planner reads
    only those, though they are known only when it runs."""
    return df.join(wanted.select(column), column, "left_semi")


def union_splits(parts: Sequence[DataFrame]) -> DataFrame:
    """Frames kept apart, put together by column name."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def filtered(df: DataFrame, where: Column | None, order: Sequence[str]) -> DataFrame:
    """Filter, then sort on the keys."""
    kept = df if where is None else df.where(where)
    return kept.orderBy(*order)


def point_lookup(df: DataFrame, key: str, value) -> DataFrame:
    """Rows with one key; the comparison reaches the file scan."""
    return df.where(F.col(key) == F.lit(value))


def page_rows(df: DataFrame, order: Sequence[str], offset: int, length: int, max_length: int = PAGE_ROWS) -> DataFrame:
    """Rows `offset` to `offset + length` in key order.

    `order` ends in a unique key. Only the order columns are numbered, by ranges, so that no task holds
    all rows before the page; the page's keys, at most `max_length`, then fetch their rows. Nulls come
    first, as any other key.
    """
    if length > max_length:
        raise ValueError(f"a page has at most {max_length} rows; {length} were asked for")
    numbered = number_rows(df.select(*order), [F.col(c) for c in order], name="__row")
    page = numbered.where(F.col("__row").between(offset, offset + length - 1)).drop("__row")
    keys = page.toDF(*[f"__{c}" for c in order])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in order])
    return df.join(F.broadcast(keys), same, "left_semi").orderBy(*order).limit(length)


def list_splits(df: DataFrame, column: str = "congress_num") -> DataFrame:
    """Distinct split values in order."""
    return df.select(column).distinct().orderBy(column)


def head_rows(df: DataFrame, order: Sequence[str], n: int | None) -> DataFrame:
    """The first `n` rows in key order, all of them when `n` is None."""
    return df if n is None else df.orderBy(*order).limit(n)
