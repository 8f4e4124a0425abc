"""Incremental ingest: arriving files become keyed rows, newest row per key.

Arrivals are appended to a log of batches; reading takes the newest row per key. A batch that is
written again after a failure replaces its own folder, so nothing counts twice, and no batch
rewrites the table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lawloom.operators.upsert import latest_rows

BATCH = "ingest_batch"


def log_batch(batch: DataFrame, batch_id: int, path: str, keys: Sequence[str], order: Sequence[str]) -> None:
    """Write one batch to its own folder of the log, one row per key."""
    latest_rows(batch, keys, order).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def start_ingest(
    arrivals: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[str],
    prepare: Callable[[DataFrame], DataFrame] | None = None,
):
    """Start a run over everything that has arrived since the last one; it ends by itself."""
    def write(batch: DataFrame, batch_id: int) -> None:
        log_batch(prepare(batch) if prepare else batch, batch_id, path, keys, order)

    return (
        arrivals.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_current(
    spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Newest row per key over all batches; on equal order the later batch wins."""
    log = spark.read.schema(StructType([*schema.fields, StructField(BATCH, LongType())])).parquet(path)
    return latest_rows(log, keys, [*order, BATCH]).drop(BATCH)


def compact(spark: SparkSession, path: str, target: str, schema: StructType, keys: Sequence[str], order: Sequence[str]) -> None:
    """Write the current rows as the first batch of a new log, to go on from there."""
    read_current(spark, path, schema, keys, order).write.mode("overwrite").parquet(f"{target}/{BATCH}=-1")


def file_arrivals(
    spark: SparkSession, folder: str, schema: StructType, glob: str = "*.parquet", per_batch: int | None = None
) -> DataFrame:
    """Parquet files arriving in a folder, as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.parquet(folder)


def xml_arrivals(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """XML files arriving anywhere below a folder, whole, as a stream of (path, body)."""
    files = (
        spark.readStream.option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .text(root, wholetext=True)
    )
    raw_path = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return files.select(F.url_decode(raw_path).alias("path"), F.col("value").alias("body"))
