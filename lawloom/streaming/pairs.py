"""Pairing two streams of arrivals: files and their side files, by stem, each waiting for the other.

Both streams carry the time of arrival. A file waits `wait` for its side file and the other way round; then it
is given alone, for quarantine, and its state is dropped. The watermark follows the slower stream, less `late`
for arrivals out of order. The same function pairs stored tables, which is what the stream must equal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from lawloom.session import scratch_path
from lawloom.streaming.ingest import BATCH

#: Time of the rows that mark the end of arrivals.
END = "2100-01-01"
KEPT, NO_SIDE, NO_FILE = "kept", "side:missing", "file:missing"


def paired(files: DataFrame, sides: DataFrame, on: str, at: str, wait: str, late: str) -> DataFrame:
    """Pairs that came within `wait` of each other, and what found none: `state`, and both sides' columns.

    Columns of the side files get `side_` before their names. Rows without stem pair with nothing.
    """
    left = files.withWatermark(at, late)
    right = sides.select([F.col(c).alias(f"side_{c}") for c in sides.columns]).withWatermark(f"side_{at}", late)
    near = F.expr(f"side_{at} BETWEEN {at} - INTERVAL {wait} AND {at} + INTERVAL {wait}")
    # The join of streams takes null keys for equal ones.
    same = (F.col(on) == F.col(f"side_{on}")) & F.col(on).isNotNull()
    both = left.join(right, same & near, "full_outer")
    state = F.when(F.col(f"side_{at}").isNull(), NO_SIDE).when(F.col(at).isNull(), NO_FILE).otherwise(KEPT)
    return both.withColumn("state", state)


def start_pairing(files: DataFrame, sides: DataFrame, path: str, checkpoint: str, on: str, at: str, wait: str, late: str):
    """Pair two streams over all that has arrived since the last run; it ends by itself.

    Every batch has its own folder of the log, so one that is made again after a failure replaces itself. What
    still waits at the end stays in the state and goes on waiting in the next run.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return (
        paired(files, sides, on, at, wait, late).writeStream.outputMode("append").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def read_pairs(spark: SparkSession, path: str, schema: StructType, at: str) -> DataFrame:
    """All pairs and singles given so far, end marks apart."""
    rows = spark.read.schema(schema).parquet(path).select(*schema.names)
    return rows.where(F.coalesce(at, f"side_{at}") < F.lit(END).cast("timestamp"))


def write_arrivals(df: DataFrame, folder: str) -> None:
    """Append rows to a folder of arrivals."""
    df.write.mode("append").parquet(folder)


def write_end(spark: SparkSession, schema: StructType, folder: str, at: str) -> None:
    """Append an end mark to a folder of arrivals: a row of the time END and nothing else.

    With one in both folders the watermark passes all arrivals, and none is left waiting.
    """
    mark = [F.lit(END).cast("timestamp").alias(f.name) if f.name == at else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    write_arrivals(spark.range(1).select(*mark), folder)


def folders(spark: SparkSession, name: str) -> tuple[str, str, str, str]:
    """Fresh folders for files, side files, log and state."""
    return tuple(scratch_path(spark, f"{name}-{kind}") for kind in ("files", "sides", "log", "state"))
