"""Helpers the operators share: Arrow batch bounds, staged tables, slices of long batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lawloom.session import scratch_path

#: Rows and bytes of one Arrow batch handed to Python: bounds a task's memory where texts are long.
BATCH_ROWS = 1_000
BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for the Python workers, whatever the length of the texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once below the shared folder and go on from the written table.

    Later steps then read what was decided once, also after an executor is lost, and Spark knows
    the table's true size when it plans a join with it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def slices(batch: pa.RecordBatch, text: str = "text", most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of a piece are about `most` bytes (one longer text is a piece)."""
    if batch.num_rows == 0:
        return
    sizes = np.diff(offsets_of(batch.column(text)))
    piece = (np.cumsum(sizes) - sizes) // most
    starts = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
    for a, b in zip(starts, np.r_[starts[1:], batch.num_rows]):
        yield batch.slice(a, b - a)


def offsets_of(array: pa.Array) -> np.ndarray:
    """Byte offsets of a string or binary array, from its own buffers."""
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    kind = np.int64 if wide else np.int32
    if len(array) == 0:
        return np.zeros(1, kind)
    return np.frombuffer(array.buffers()[1], kind)[array.offset : array.offset + len(array) + 1]


def strings(column: pa.Array) -> pa.Array:
    """A string column with 64-bit offsets and no nulls: null counts as empty."""
    return column.cast(pa.large_string()).fill_null("")


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing function (the finaliser of splitmix64) over an array of unsigned integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def unit(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1)."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def runs(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of consecutive runs of the given lengths, and each element's run."""
    ends = np.cumsum(lengths)
    return ends - lengths, np.repeat(np.arange(len(lengths)), lengths)
