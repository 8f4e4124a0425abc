"""Overlapping text chunks."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from lawloom.constants import SEPARATORS
from lawloom.functions.keys import dashed
from lawloom.functions.text import SPACE_CHARS, bind, strip_spaces
from lawloom.operators.numbering import number_within

# Task functions travel with the job, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK_TYPE = "array<struct<text:string,start_index:int>>"
#: Characters of the texts that are split at once in a task, about.
SPLIT_AT_ONCE = 1 << 20
DOC_FIELDS = (
    "tv_id", "legis_version", "legis_class", "legis_id", "congress_num", "legis_type", "legis_num", "text_date",
)


def chunk_documents(unified: DataFrame, tvs: str = "tvs") -> DataFrame:
    """Each bill's first text version as a document with its eight metadata fields.

    Bills without versions are skipped; `skipped_count` tells how many.
    """
    first = F.get(F.col(tvs), 0)
    return unified.where(F.size(tvs) > 0).select(
        first["tv_id"].alias("tv_id"),
        first["legis_version"].alias("legis_version"),
        first["legis_class"].alias("legis_class"),
        "legis_id",
        "congress_num",
        "legis_type",
        "legis_num",
        first["bs_tv"]["date"].cast("string").alias("text_date"),
        first["tv_txt"].alias("text"),
    )


def skipped_count(unified: DataFrame, tvs: str = "tvs") -> DataFrame:
    return unified.agg(F.count_if(F.coalesce(F.size(tvs), F.lit(0)) <= 0).alias("n_skipped"))


def _pieces(text: str, lo: int, hi: int, sep: str) -> Iterator[tuple[int, int]]:
    """Spans between separators in text[lo:hi]; a separator heads the piece after it."""
    if not sep:
        yield from ((i, i + 1) for i in range(lo, hi))
        return
    begin, at = lo, text.find(sep, lo, hi)
    while at >= 0:
        if at > begin:
            yield begin, at
        begin, at = at, text.find(sep, at + len(sep), hi)
    if begin < hi:
        yield begin, hi


def _packed(pieces: list[tuple[int, int]], size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Adjoining pieces packed into spans of at most `size`; trailing pieces of at most `overlap`
    characters open the next span."""
    if not pieces:
        return
    first = 0
    for last, (lo, hi) in enumerate(pieces):
        if hi - pieces[first][0] > size and last > first:
            yield pieces[first][0], lo
            while first < last and (lo - pieces[first][0] > overlap or hi - pieces[first][0] > size):
                first += 1
    yield pieces[first][0], pieces[-1][1]


def _spans(text: str, lo: int, hi: int, size: int, overlap: int, seps: Sequence[str]) -> Iterator[tuple[int, int]]:
    at = next((i for i, s in enumerate(seps) if not s or text.find(s, lo, hi) >= 0), len(seps) - 1)
    rest = seps[at + 1 :] if seps[at] else ()
    run: list[tuple[int, int]] = []
    for piece in _pieces(text, lo, hi, seps[at]):
        if piece[1] - piece[0] < size:
            run.append(piece)
            continue
        yield from _packed(run, size, overlap)
        run = []
        if rest:
            yield from _spans(text, *piece, size, overlap, rest)
        else:
            yield piece
    yield from _packed(run, size, overlap)


def split_text(text: str, size: int, overlap: int, seps: Sequence[str] = SEPARATORS) -> list[tuple[str, int]]:
    """(chunk, start) pairs of one text; starts count code points and rise from chunk to chunk."""
    chunks: list[tuple[str, int]] = []
    last = -1
    for lo, hi in _spans(text, 0, len(text), size, overlap, seps):
        piece = text[lo:hi].strip()
        if piece:
            found = text.find(piece, last + 1)
            last = found if found >= 0 else text.index(piece, lo)
            chunks.append((piece, last))
    return chunks


def split_batch(texts: pa.Array, size: int, overlap: int, seps: Sequence[str] = SEPARATORS) -> Iterator[pa.Array]:
    """Chunks of each text, in arrays of about SPLIT_AT_ONCE characters of text (one longer text is an array)."""
    pieces: list[str] = []
    starts: list[int] = []
    ends, absent = [0], []
    room = SPLIT_AT_ONCE

    def made() -> pa.Array:
        chunk = pa.StructArray.from_arrays([pa.array(pieces, pa.string()), pa.array(starts, pa.int32())], ["text", "start_index"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), chunk, mask=pa.array(absent, pa.bool_()))

    for value in texts:
        text = value.as_py()
        for piece, start in split_text(text or "", size, overlap, seps):
            pieces.append(piece)
            starts.append(start)
        ends.append(len(pieces))
        absent.append(text is None)
        room -= len(text or "")
        if room <= 0:
            yield made()
            pieces, starts, ends, absent, room = [], [], [0], [], SPLIT_AT_ONCE
    if absent:
        yield made()


def recursive_chunks(text: Column, size: int, overlap: int, seps: Sequence[str] = SEPARATORS) -> Column:
    """Chunks of a text column, split at the most preferred separator that occurs and packed to size.

    The one place that needs Python: piece boundaries depend on all earlier ones. Each document is
    independent, so the work spreads with the documents.
    """
    if overlap >= size:
        raise ValueError("overlap must be smaller than size")
    seps = tuple(seps)

    @F.arrow_udf(CHUNK_TYPE)
    def chunks(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield from split_batch(batch, size, overlap, seps)

    return chunks(text)


def fixed_chunks(text: Column, size: int, overlap: int) -> Column:
    """Chunks by character count alone, with built-in expressions, linear in the text's length."""
    if overlap >= size:
        raise ValueError("overlap must be smaller than size")
    step = size - overlap
    reach = 1 + -(-overlap // step)

    def windows(parts: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(parts) - 1),
            lambda i: F.struct(
                F.substring(F.array_join(F.slice(parts, i + 1, F.lit(reach)), ""), 1, size).alias("raw"),
                (i * step).alias("at"),
            ),
        )

    n = F.length(text)
    count = F.when(n <= size, F.lit(1)).otherwise(F.lit(1) + F.ceil((n - size) / F.lit(step)).cast("int"))
    parts = F.regexp_extract_all(text, F.lit(r"(?s).{1," + str(step) + "}"), F.lit(0))
    raw = F.slice(bind(parts, windows), F.lit(1), count)
    placed = F.transform(
        raw,
        lambda w: F.struct(
            strip_spaces(w["raw"]).alias("text"),
            (w["at"] + F.length(w["raw"]) - F.length(F.ltrim(w["raw"], F.lit(SPACE_CHARS))))
            .cast("int")
            .alias("start_index"),
        ),
    )
    kept = F.filter(placed, lambda w: F.length(w["text"]) > 0)
    return F.when(n > 0, kept).otherwise(F.array().cast(CHUNK_TYPE))


def explode_chunks(docs: DataFrame, chunks: Column, key: str = "tv_id") -> DataFrame:
    """One row per chunk: the document's columns without its text, chunk_index, chunk_id, chunk.

    An outer explode with a filter above it: for an inner one the planner adds a size check below,
    which would split every text twice.
    """
    rows = docs.withColumn("__chunks", chunks)
    rows = rows.select(
        *[c for c in docs.columns if c != "text"], F.posexplode_outer("__chunks").alias("chunk_index", "__chunk")
    )
    return rows.where(F.col("__chunk").isNotNull()).select(
        *[c for c in docs.columns if c != "text"],
        "chunk_index",
        dashed(F.col(key), F.col("chunk_index")).alias("chunk_id"),
        F.col("__chunk.text").alias("text"),
        F.col("__chunk.start_index").alias("start_index"),
    )


def chunk_table(docs: DataFrame, size: int, overlap: int, seps: Sequence[str] = SEPARATORS) -> DataFrame:
    """chunk_id, tv_id, legis_id, text, metadata of every document chunk."""
    rows = explode_chunks(docs, recursive_chunks(F.col("text"), size, overlap, seps))
    fields = sorted([*DOC_FIELDS, "chunk_id", "chunk_index", "start_index"])
    return rows.select("chunk_id", "tv_id", "legis_id", "text", F.struct(*fields).alias("metadata"))


def index_chunks(df: DataFrame, key: str = "tv_id", order: Sequence[str] = ("start_index",)) -> DataFrame:
    """chunk_index from 0 and chunk_id for chunks that come already split."""
    numbered = number_within(df, [key], [F.col(c) for c in order], name="chunk_index")
    return numbered.withColumn("chunk_id", dashed(F.col(key), F.col("chunk_index")))
