"""Operator 2: token ids as Arrow files of fixed-size lists.

The ids of all documents, in ascending doc_id order and each followed by an end id, are cut into
sequences of equal length and written as Arrow IPC files without compression. A record batch has the
columns `ids` (fixed-size list of the vocabulary's smallest integer type) and `mask` (fixed-size list
of bool, false on the padding that ends a file). Every sequence lies at a known place: a reader maps
the file and slices the flat child buffer, without copying. Beside each file lies an index file, Arrow
too, with doc_id and end offset of its documents.

Files hold consecutive ranges of documents. A task attempt writes files of its own name and reports
them; only reported files belong to the result, so a lost executor or a repeated task leaves no double
rows. Position of a file in the whole (ids before it) follows from the files' counts.

Null and empty texts have only the end id. Rows of one doc_id stay together, in the order of a
hash of their texts. Null doc_ids come first. Further columns are ignored. No documents: no files, an empty result.
A document longer than a file's share makes a longer file; ids are written batch by batch.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lawloom.llm.common import bound_batches, slices, stage, strings
from lawloom.llm.vocab import default_path, encoder
from lawloom.session import scratch_path

LENGTH = 2_048
END = 1
#: Sequences in one record batch, and characters of text in one file, about.
BATCH_SEQUENCES = 512
FILE_CHARS = 32 << 20


def _open(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pa.fs.LocalFileSystem(), path)


class Writer:
    """One file of sequences: takes flat ids, writes full record batches, pads the last sequence."""

    def __init__(self, path: str, dtype: np.dtype, length: int):
        files, name = _open(path)
        files.create_dir(name.rsplit("/", 1)[0], recursive=True)
        self.sink = files.open_output_stream(name)
        self.length, self.dtype, self.rest, self.total = length, dtype, [], 0
        self.schema = pa.schema(
            [("ids", pa.list_(pa.from_numpy_dtype(dtype), length)), ("mask", pa.list_(pa.bool_(), length))]
        )
        self.file = pa.ipc.new_file(self.sink, self.schema)
        self.held = 0

    def add(self, ids: bytes) -> None:
        self.rest.append(ids)
        self.held += len(ids) // self.dtype.itemsize
        if self.held >= BATCH_SEQUENCES * self.length:
            self.flush(False)

    def flush(self, last: bool) -> None:
        flat = np.frombuffer(b"".join(self.rest), self.dtype)
        full = len(flat) // self.length * self.length
        out, rest = flat[:full], flat[full:]
        mask = np.ones(full, bool)
        if last and len(rest):
            pad = self.length - len(rest)
            out = np.concatenate([flat, np.zeros(pad, self.dtype)])
            mask = np.r_[np.ones(len(flat), bool), np.zeros(pad, bool)]
            full, rest = len(flat), flat[:0]
        for a in range(0, len(out), BATCH_SEQUENCES * self.length):
            b = a + BATCH_SEQUENCES * self.length
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(x[a:b]), self.length) for x in (out, mask)]
            self.file.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
        self.total += full
        self.rest, self.held = [rest.tobytes()], len(rest)

    def close(self) -> int:
        self.flush(True)
        self.file.close()
        self.sink.close()
        return self.total


def write(docs: DataFrame, folder: str, path: str | None = None, length: int = LENGTH, end: int = END) -> DataFrame:
    """Write the files; the manifest: file, index, part (order of the files), n_docs, n_tokens."""
    path = path or default_path()
    spark = docs.sparkSession
    bound_batches(spark)
    size = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    files = max(1, spark.sparkContext.defaultParallelism, -(-size // FILE_CHARS))
    # Range bounds come from sampled keys, so no text is among the keys.
    order = ("doc_id", "turn")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, out, ids_of, ends, total = encoder(path), None, [], [], 0
        name = f"{folder}/{uuid.uuid4().hex}"
        for whole in batches:
            part = whole.column("part")[0].as_py()
            for batch in slices(whole):
                out = out or Writer(f"{name}.arrow", enc.dtype, length)
                for ids in enc.encode(strings(batch.column("text")).to_pylist(), end):
                    out.add(ids)
                    total += len(ids) // enc.dtype.itemsize
                    ends.append(total)
                ids_of.append(batch.column("doc_id").cast(pa.int64()))
        if out is None:
            return
        out.close()
        index = pa.table({"doc_id": pa.chunked_array(ids_of), "end": pa.array(ends, pa.int64())})
        files, where = _open(f"{name}.index.arrow")
        with files.open_output_stream(where) as sink, pa.ipc.new_file(sink, index.schema) as file:
            file.write_table(index, 1 << 16)
        yield pa.RecordBatch.from_pydict(
            {"file": [f"{name}.arrow"], "index": [f"{name}.index.arrow"], "part": pa.array([part], pa.int32()),
             "n_docs": pa.array([len(ends)], pa.int64()), "n_tokens": pa.array([total], pa.int64())}
        )

    dealt = docs.select("doc_id", "text", F.xxhash64("text").alias("turn")).repartitionByRange(files, *order).sortWithinPartitions(*order)
    written = dealt.drop("turn").withColumn("part", F.spark_partition_id()).mapInArrow(
        run, "file string, index string, part int, n_docs long, n_tokens long"
    )
    return stage(written, "token-files")


def read_documents(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    # One row per file: its start is the running total of the files before it.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    placed = placed.repartitionByRange(max(1, manifest.count()), "part").select("file", "index", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from read_file(row["file"], row["index"], row["start"])

    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_file(file: str, index: str, start: int) -> Iterator[pa.RecordBatch]:
    """Documents of one file. Sequences are sliced from the flat buffers, a few record batches at a time."""
    files, name = _open(index)
    with files.open_input_file(name) as source:
        docs = pa.ipc.open_file(source).read_all()
    ends = docs.column("end").to_numpy()
    starts = np.r_[0, ends[:-1]]
    crc = np.zeros(len(ends), np.int64)
    files, name = _open(file)
    with files.open_input_file(name) as source:
        sequences, at, doc = pa.ipc.open_file(source), 0, 0
        for n in range(sequences.num_record_batches):
            batch = sequences.get_batch(n)
            flat = batch.column("ids").flatten().to_numpy()
            used = batch.column("mask").flatten().true_count
            wide = flat[:used].astype("<u4")
            while doc < len(ends) and starts[doc] < at + used:
                a, b = max(starts[doc] - at, 0), min(ends[doc] - at, used)
                crc[doc] = zlib.crc32(wide[a:b].data, int(crc[doc]))
                if ends[doc] > at + used:
                    break
                doc += 1
            at += used
    for a in range(0, len(ends), 1 << 16):
        b = a + (1 << 16)
        yield pa.RecordBatch.from_arrays(
            [docs.column("doc_id")[a:b].combine_chunks(), pa.array(starts[a:b] + start), pa.array((ends - starts)[a:b]), pa.array(crc[a:b])],
            ["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def sequence(file: str, number: int) -> tuple[pa.Array, pa.Array]:
    """Ids and mask of one sequence, at random access: record batches hold BATCH_SEQUENCES each, but the last."""
    files, name = _open(file)
    source = pa.memory_map(name) if isinstance(files, pa.fs.LocalFileSystem) else files.open_input_file(name)
    batch = pa.ipc.open_file(source).get_batch(number // BATCH_SEQUENCES)
    return batch.column("ids")[number % BATCH_SEQUENCES].values, batch.column("mask")[number % BATCH_SEQUENCES].values


def write_and_read(docs: DataFrame) -> DataFrame:
    spark: SparkSession = docs.sparkSession
    return read_documents(write(docs, scratch_path(spark, "token-arrow")))
