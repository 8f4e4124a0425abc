"""Operator 3: token counts by a separator scan over flat, unindexed token files.

A flat file is nothing but token ids, one document after another, each closed by the end-of-document
id. Files are cut into blocks of equal size; each block is searched for the id with one vectorised
comparison and says how many documents end in it, and what lies before the first and after the last
end. A prefix scan over these block summaries (within runs of blocks, then over runs) gives every
block the number of documents before it and the tokens carried into it, which close its first document.

The end id must not occur inside documents: `write_flat` encodes the text of special tokens as ordinary
text. What follows the last end in a file is its open last document (`closed` false). Empty files have no
documents; an empty document counts its end id only when `with_end` is set. Null texts are empty.
Repeated rows are documents of their own; further columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lawloom.llm.common import bound_batches, slices, stage, strings
from lawloom.llm.tokens_out import _open
from lawloom.llm.vocab import default_path, encoder
from lawloom.session import scratch_path

#: `<|endoftext|>` of the production tokenizer.
END = 49_407
BLOCK_TOKENS = 1 << 20
RUN_BLOCKS = 1 << 12


def write_flat(docs: DataFrame, folder: str, path: str | None = None, end: int = END) -> tuple[DataFrame, DataFrame]:
    """Flat files of the documents. Returns files (file, n_tokens, width) and, apart from the flat files,
    which document stands where (file, nth, doc_id)."""
    path = path or default_path()
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, ordinary_specials=True)
        name = f"{folder}/{uuid.uuid4().hex}.bin"
        sink, nth, total = None, 0, 0
        for whole in batches:
            for batch in slices(whole):
                if sink is None:
                    files, where = _open(name)
                    files.create_dir(where.rsplit("/", 1)[0], recursive=True)
                    sink = files.open_output_stream(where)
                ids = enc.encode(strings(batch.column("text")).to_pylist(), end)
                for i in ids:
                    sink.write(i)
                    total += len(i) // enc.dtype.itemsize
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * n), pa.array(np.arange(nth, nth + n)), batch.column("doc_id").cast(pa.int64()),
                     pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32())],
                    ["file", "nth", "doc_id", "n_tokens", "width"],
                )
                nth += n
        if sink is not None:
            sink.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([total], pa.int64()),
                 pa.array([enc.dtype.itemsize], pa.int32())],
                ["file", "nth", "doc_id", "n_tokens", "width"],
            )

    written = stage(
        docs.select("doc_id", "text").mapInArrow(run, "file string, nth long, doc_id long, n_tokens long, width int"), "flat"
    )
    return written.where("n_tokens IS NOT NULL").select("file", "n_tokens", "width"), written.where(
        "nth IS NOT NULL"
    ).select("file", "nth", "doc_id")


def _scan(end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                files, where = _open(row["file"])
                with files.open_input_file(where) as source:
                    source.seek(row["first"] * row["width"])
                    ids = np.frombuffer(source.read(row["size"] * row["width"]), f"<u{row['width']}")
                at = np.flatnonzero(ids == end)
                tail = len(ids) - (at[-1] + 1 if len(at) else 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["file"]]), pa.array([row["block"]], pa.int64()), pa.array([row["first"]], pa.int64()),
                     pa.array([len(at)], pa.int64()), pa.array([tail], pa.int64()), pa.array([at.astype(np.int32)], pa.list_(pa.int32()))],
                    ["file", "block", "first", "n_ends", "tail", "ends"],
                )

    return run


def _carried(blocks: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Documents ended before each row of a group, and tokens left open before it.

    Open tokens are the tails since the last row with an end: a running total of tails in which each
    row with an end starts anew from its own tail.
    """
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    since = Window.partitionBy(*keys, "_stretch").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        blocks.withColumn("_stretch", F.sum(F.when(F.col("n_ends") > 0, 1).otherwise(0)).over(upto))
        .withColumn("_open", F.sum("tail").over(since))
        .withColumn("docs_before", F.coalesce(F.sum("n_ends").over(before), F.lit(0)))
        .withColumn("open_before", F.coalesce(F.lag("_open").over(Window.partitionBy(*keys).orderBy(order)), F.lit(0)))
        .withColumn("any_before", F.coalesce(F.lag("_stretch").over(Window.partitionBy(*keys).orderBy(order)), F.lit(0)) > 0)
        .withColumn("open_after", F.col("_open"))
        .drop("_stretch", "_open")
    )


def count(files: DataFrame, end: int = END, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Per document: file, nth, start (within its file), n_tokens (without the end id), closed."""
    spark = files.sparkSession
    bound_batches(spark)
    n_blocks = F.ceil(F.col("n_tokens") / block_tokens)
    cut = files.where("n_tokens > 0").select(
        "file", "n_tokens", "width", F.explode(F.sequence(F.lit(0).cast("long"), n_blocks - 1)).alias("block")
    )
    cut = cut.select(
        "file", "width", "block", (F.col("block") * block_tokens).alias("first"),
        F.least(F.lit(block_tokens), F.col("n_tokens") - F.col("block") * block_tokens).alias("size"),
    ).repartition("file", "block")
    schema = "file string, block long, first long, n_ends long, tail long, ends array<int>"
    scanned = stage(cut.mapInArrow(_scan(end), schema), "ends")
    # Summaries only: one narrow row per block, scanned in runs, then the runs.
    blocks = scanned.select("file", "block", "n_ends", "tail", F.expr(f"block div {RUN_BLOCKS}").alias("run"))
    within = _carried(blocks, ["file", "run"], "block")
    runs = blocks.groupBy("file", "run").agg(F.sum("n_ends").alias("n_ends")).join(
        within.groupBy("file", "run").agg(F.max_by("open_after", "block").alias("tail")), ["file", "run"]
    )
    over = _carried(runs, ["file"], "run").select(
        "file", "run", F.col("docs_before").alias("run_docs"), F.col("open_before").alias("run_open")
    )
    placed = within.join(over, ["file", "run"]).select(
        "file", "block",
        (F.col("docs_before") + F.col("run_docs")).alias("docs_before"),
        (F.col("open_before") + F.when(F.col("any_before"), 0).otherwise(F.col("run_open"))).alias("open_before"),
    )
    each = scanned.join(placed, ["file", "block"])
    closed = each.select(
        "file", "docs_before", "first", "open_before", "ends", F.posexplode("ends").alias("i", "at")
    ).select(
        "file", (F.col("docs_before") + F.col("i")).alias("nth"),
        F.when(F.col("i") == 0, F.col("first") - F.col("open_before"))
        .otherwise(F.col("first") + F.get("ends", F.col("i") - 1) + 1).cast("long").alias("start"),
        (F.col("first") + F.col("at")).alias("_end"),
    ).select("file", "nth", "start", (F.col("_end") - F.col("start")).alias("n_tokens"), F.lit(True).alias("closed"))
    # The last block tells whether its file ends inside a document.
    last = each.groupBy("file").agg(F.max_by(F.struct("docs_before", "n_ends", "first", "tail", "open_before"), "block").alias("b"))
    left = F.col("b.tail") + F.when(F.col("b.n_ends") > 0, 0).otherwise(F.col("b.open_before"))
    sizes = files.select("file", F.col("n_tokens").alias("_size"))
    still_open = last.join(sizes, "file").where(left > 0).select(
        "file", (F.col("b.docs_before") + F.col("b.n_ends")).alias("nth"), (F.col("_size") - left).alias("start"),
        left.alias("n_tokens"), F.lit(False).alias("closed"),
    )
    return closed.unionByName(still_open)


def document_counts(docs: DataFrame) -> DataFrame:
    """Flat files of all documents written, scanned, and each document's count: doc_id, start, n_tokens, closed."""
    files, places = write_flat(docs, scratch_path(docs.sparkSession, "token-flat"))
    return count(files).join(places, ["file", "nth"]).select("doc_id", "file", "nth", "start", "n_tokens", "closed")
