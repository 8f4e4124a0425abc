"""The document flow: XML tree to tables, unified bills, texts, chunks, vectors, search records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from lawloom.operators.chunking import chunk_documents, chunk_table
from lawloom.operators.embed import as_questions, embed_hashing
from lawloom.operators.enrich import export_rows, export_with_scores, flat_record
from lawloom.operators.neighbours import nearest
from lawloom.operators.context import build_context
from lawloom.operators.splits import assign_splits, drop_empty_text, text_rows, write_splits
from lawloom.operators.unify import newest_version, refresh_folder, unify
from lawloom.operators.upsert import latest_rows, upsert_folder
from lawloom.sources.sinks import chunk_tag, export_by
from lawloom.sources.treesource import stream_tree
from lawloom.sources.xmltree import TEXT_NAMES, read_status, read_texts, status_rows, text_rows as tree_text_rows
from lawloom.streaming.ingest import BATCH
from lawloom.constants import PASSAGES_PER_QUESTION, STATUS_FILE_NAME
from lawloom.session import cut_lineage

BILL_ORDER = ("legis_type", "legis_num")


def _with_state(rows: DataFrame) -> DataFrame:
    return rows.withColumn("state", F.when(F.size("violations") > 0, "quarantined").otherwise("kept"))


def land(spark: SparkSession, root: str, out: str) -> None:
    """Read the XML tree once into parquet; rows that break a rule go to a folder of their own."""
    for name, read in (("billstatus", read_status), ("textversion", read_texts)):
        _with_state(read(spark, root)).write.mode("overwrite").partitionBy("state").parquet(f"{out}/{name}")


# Table, names of its files, rows made of them, key.
STREAMS = (
    ("billstatus", STATUS_FILE_NAME, status_rows, "legis_id"),
    ("textversion", TEXT_NAMES, tree_text_rows, "tv_id"),
)


def ingest_arrivals(spark: SparkSession, root: str, out: str, state: str, settle: float = 0.0) -> None:
    """Land what is new or changed in the tree since the last run, as batches of a log.

    The tree is a stream of files paired with their side files: an XML file rewritten in place and a side
    file that comes late both count. A batch that is made again after a failure replaces its own folder.
    """
    def started(name, names, make):
        def write(batch: DataFrame, batch_id: int) -> None:
            if not batch.isEmpty():
                rows = _with_state(make(batch, root))
                rows.write.mode("overwrite").partitionBy("state").parquet(f"{out}/{name}/{BATCH}={batch_id}")

        stream = stream_tree(spark, root, names, settle=settle).writeStream.foreachBatch(write)
        return stream.option("checkpointLocation", f"{state}/{name}").trigger(availableNow=True).start()

    for run in [started(name, names, make) for name, names, make, _ in STREAMS]:
        run.awaitTermination()


def ingested(spark: SparkSession, out: str, name: str) -> DataFrame:
    """Current rows of an ingested table: the newest per key over all batches."""
    key = {n: k for n, _, _, k in STREAMS}[name]
    log = spark.read.parquet(f"{out}/{name}").where(F.col("state") == "kept").drop("state", "violations")
    return latest_rows(log, [key], ["lastmod", "scrape_path", BATCH]).drop(BATCH)


def arrived(spark: SparkSession, out: str, name: str) -> DataFrame:
    """Landed rows that keep all rules."""
    return spark.read.parquet(f"{out}/{name}").where(F.col("state") == "kept").drop("state", "violations")


def quarantined(spark: SparkSession, out: str, name: str) -> DataFrame:
    """Landed rows that break a rule, with the rules' names."""
    return spark.read.parquet(f"{out}/{name}").where(F.col("state") == "quarantined").drop("state")


def upsert_landed(spark: SparkSession, out: str, tables: str, changes: str | None = None) -> None:
    """Apply landed rows to the tables; only congresses that have arrivals are rewritten.

    With `changes`, the changed rows as they were and as they are now are left there for `refresh_unified`.
    """
    for name, key in (("billstatus", "legis_id"), ("textversion", "tv_id")):
        upsert_folder(
            arrived(spark, out, name), f"{tables}/{name}", [key], ["lastmod", "scrape_path"], "congress_num",
            changes=changes and f"{changes}/{name}",
        )


def refresh_unified(spark: SparkSession, tables: str, changes: str, path: str) -> None:
    """Bring the unified bills at `path` (by congress, without texts) up to date with the tables."""
    refresh_folder(spark, path, f"{tables}/billstatus", f"{tables}/textversion", f"{changes}/billstatus", f"{changes}/textversion")


def write_unified(spark: SparkSession, tables: str, out: str) -> None:
    """Unified bills with text, in one folder per congress."""
    status, texts = spark.read.parquet(f"{tables}/billstatus"), spark.read.parquet(f"{tables}/textversion")
    export_by(unify(status, texts, text_columns=("tv_xml", "tv_txt")), f"{out}/unified", BILL_ORDER)


def first_versions(spark: SparkSession, tables: str) -> DataFrame:
    """Bills with `tvs` holding only the newest version: what texts and chunks need."""
    status, texts = spark.read.parquet(f"{tables}/billstatus"), spark.read.parquet(f"{tables}/textversion")
    return newest_version(status, texts).withColumn("tvs", F.array("tv")).drop("tv")


def write_texts(spark: SparkSession, tables: str, out: str) -> None:
    rows = text_rows(first_versions(spark, tables), keep=("congress_num", *BILL_ORDER))
    write_splits(drop_empty_text(assign_splits(rows)), f"{out}/texts")


def write_chunks(spark: SparkSession, tables: str, out: str, settings: Sequence[tuple[int, int]]) -> None:
    """Chunk tables for several (size, overlap) settings, all from documents that are put together once."""
    docs = cut_lineage(chunk_documents(first_versions(spark, tables)))
    for size, overlap in settings:
        chunks = chunk_table(docs, size, overlap).withColumn("congress_num", F.col("metadata.congress_num"))
        export_by(chunks, f"{out}/{chunk_tag(size, overlap)}", ("chunk_id",))


def search_records(chunks: DataFrame, bills: DataFrame) -> DataFrame:
    """id, document, vector and flat metadata, as a vector index takes them."""
    joined = chunks.join(bills.select("legis_id", "bs"), "legis_id")
    fields = [(f, F.col(f"metadata.{f}")) for f in chunks.schema["metadata"].dataType.names]
    return joined.select(
        F.col("chunk_id").alias("id"),
        F.col("text").alias("document"),
        "vec",
        flat_record(F.col("bs"), fields).alias("metadata"),
    )


def export_records(chunks: DataFrame, bills: DataFrame, members: DataFrame, with_vectors: bool = False) -> DataFrame:
    return export_with_scores(export_rows(chunks, bills, with_vectors), members)


def answer_context(
    questions: DataFrame, chunks: DataFrame, k: int = PASSAGES_PER_QUESTION, embed=embed_hashing
) -> DataFrame:
    """Context text per question out of its k nearest chunks. `chunks` has vectors."""
    asked = embed(as_questions(questions), "text")
    hits = nearest(asked, chunks, k, "query_id", "chunk_id", skip_self=False)
    passages = hits.join(
        chunks.select(F.col("chunk_id").alias("neighbour_id"), "legis_id", "text"), "neighbour_id"
    )
    return build_context(passages)
