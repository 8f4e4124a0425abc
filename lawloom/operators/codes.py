"""Approximate neighbours by product-quantised codes: compact vectors scanned by table lookup, the best scored again.

A unit vector is cut into PIECES pieces; each is replaced by the number of the nearest of 256 centres, so a
vector of 64 floats takes 16 bytes. Codes lie in cells of similar vectors. A query looks into its nearest
cells, adds up table entries for every code there, and the best candidates are scored again with their whole
vectors. Centres are fitted on a bounded sample (SAMPLE rows of least id hash); all rows are indexed. How many
cells are looked into is chosen by recall measured on a sample of queries against the exact search, and stored
with the index.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lawloom.operators import neighbours as N

# Task functions travel with the job, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIECES, CENTRES = 16, 256
#: Rows on which centres are fitted, at most, and rounds of fitting.
SAMPLE, ROUNDS = 20_000, 12
#: Candidates scored again, for each neighbour wanted.
RESCORED = 12
#: Queries on which recall is measured, at most, and the recall wanted there.
MEASURED, WANTED = 128, 0.95


def fit_centres(rows: np.ndarray, number: int, seed: int) -> np.ndarray:
    """Centres of `number` groups of rows (Lloyd's method from a random start; empty groups keep their centre)."""
    rng = np.random.default_rng(seed)
    centres = rows[rng.permutation(len(rows))[:number]].copy()
    for _ in range(ROUNDS):
        own = nearest_centre(rows, centres)
        size = np.bincount(own, minlength=len(centres))
        total = np.stack([np.bincount(own, x, len(centres)) for x in rows.T], axis=1)
        centres[size > 0] = total[size > 0] / size[size > 0][:, None]
    return centres


def nearest_centre(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1)[None, :] - 2 * rows @ centres.T).argmin(axis=1)


@dataclass
class Codebook:
    cells: np.ndarray  # centres of the cells
    pieces: list[np.ndarray]  # centres of each piece

    def cut(self, vecs: np.ndarray) -> list[np.ndarray]:
        return np.split(vecs, np.cumsum([p.shape[1] for p in self.pieces])[:-1], axis=1)

    def encode(self, vecs: np.ndarray) -> np.ndarray:
        return np.stack([nearest_centre(x, c) for x, c in zip(self.cut(vecs), self.pieces)], axis=1).astype(np.uint8)

    def tables(self, vecs: np.ndarray) -> np.ndarray:
        """Products of each query's pieces with all centres: queries x pieces x centres."""
        out = np.zeros((len(vecs), len(self.pieces), CENTRES), np.float32)
        for k, (x, c) in enumerate(zip(self.cut(vecs), self.pieces)):
            out[:, k, : len(c)] = x @ c.T
        return out


@dataclass
class Index:
    path: str
    book: Codebook
    probes: int
    recall: float


def fit(rows: DataFrame, n_cells: int, seed: int = 7) -> Codebook:
    """Centres from the sample; `rows` has neighbour_id and vec."""
    sample = rows.orderBy(F.xxhash64("neighbour_id"), "neighbour_id").limit(SAMPLE).select("vec").toArrow()
    column = sample.column("vec").combine_chunks()
    if not len(column):
        raise ValueError("there are no vectors to index")
    vecs = N._unit_rows(N._matrix(column, len(column[0])))
    pieces = np.array_split(vecs, min(PIECES, vecs.shape[1]), axis=1)
    return Codebook(fit_centres(vecs, n_cells, seed), [fit_centres(p, CENTRES, seed) for p in pieces])


def write_index(
    corpus: DataFrame, path: str, n_cells: int, corpus_id: str = "vec_id", vec: str = "vec",
    queries: DataFrame | None = None, query_id: str = "query_id", k: int = 10, wanted: float = WANTED,
) -> Index:
    """Index all rows of `corpus` that have a vector: codes by cell, whole vectors beside them.

    The number of cells to look into is the least (doubling) whose recall on at most MEASURED queries (of
    `queries`, else of the corpus) reaches `wanted`.
    """
    spark = corpus.sparkSession
    rows = corpus.where(F.col(vec).isNotNull()).select(F.col(corpus_id).alias("neighbour_id"), F.col(vec).alias("vec"))
    book = fit(rows, n_cells)
    shared = spark.sparkContext.broadcast(book)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                column = batch.column("vec")
                vecs = N._unit_rows(N._matrix(column, len(column[0])))
                codes = shared.value.encode(vecs)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("neighbour_id"), pa.array([c.tobytes() for c in codes], pa.binary()),
                     pa.array(nearest_centre(vecs, shared.value.cells).astype(np.int32))],
                    ["neighbour_id", "code", "cell"],
                )

    kind = rows.schema["neighbour_id"].dataType
    coded = T.StructType().add("neighbour_id", kind).add("code", "binary").add("cell", "integer")
    # Ranges of (cell, id): a large cell lies in many files.
    rows.mapInArrow(encode, coded).repartitionByRange("cell", "neighbour_id").write.mode("overwrite").partitionBy("cell").parquet(f"{path}/codes")
    rows.write.mode("overwrite").parquet(f"{path}/vectors")
    asked = rows.withColumnRenamed("neighbour_id", "query_id") if queries is None else N._asked(queries, query_id, "vec")
    some = asked.orderBy(F.xxhash64("query_id", F.lit(1)), "query_id").limit(MEASURED).cache()
    exact = N.nearest(some, rows, k, "query_id", "neighbour_id", skip_self=queries is None).select("query_id", "neighbour_id").cache()
    index, total = Index(path, book, n_cells, 0.0), exact.count()
    probes = 1
    while True:
        index.probes = min(probes, n_cells)
        hits = search(some, index, k, skip_self=queries is None).join(exact, ["query_id", "neighbour_id"], "left_semi").count()
        index.recall = hits / total if total else 1.0
        if index.recall >= wanted or index.probes == n_cells:
            break
        probes *= 2
    report = json.dumps({"probes": index.probes, "cells": n_cells, "k": k, "recall": index.recall, "wanted": wanted, "queries": some.count()})
    spark.createDataFrame([(report,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/measured")
    return index


def search(queries: DataFrame, index: Index, k: int, query_id: str = "query_id", skip_self: bool = True) -> DataFrame:
    """query_id, neighbour_id, score, rank: about the k nearest by cosine, ties by id.

    Queries go to their cells in blocks, a cell's codes come in slices, and every block meets every slice of
    its cell in a task of bounded size, whatever the number of queries. Scores are exact; which rows are scored
    is not.
    """
    spark = queries.sparkSession
    stored, vectors = spark.read.parquet(f"{index.path}/codes"), spark.read.parquet(f"{index.path}/vectors")
    asked = N._asked(queries, query_id, "vec")
    out = N._result(asked, stored)
    book, wanted = spark.sparkContext.broadcast(index.book), k * RESCORED

    def block(asking: pd.DataFrame, coded: pd.DataFrame) -> pd.DataFrame:
        if asking.empty or coded.empty:
            return pd.DataFrame(columns=["query_id", "neighbour_id", "score"])
        q_ids, ids = N._sortable(asking["query_id"].to_numpy()), N._sortable(coded["neighbour_id"].to_numpy())
        vecs = N._unit_rows(np.stack(asking["vec"].to_numpy()).astype(np.float64))
        codes = np.frombuffer(b"".join(coded["code"]), np.uint8).reshape(len(ids), -1)
        parts = []
        for at in range(0, len(q_ids), 32):
            table = book.value.tables(vecs[at : at + 32])
            scores = np.zeros((len(table), len(ids)), np.float32)
            for piece in range(codes.shape[1]):
                scores += table[:, piece, codes[:, piece]]
            if skip_self:
                scores[q_ids[at : at + 32, None] == ids[None, :]] = -np.inf
            some = np.argpartition(-scores, min(wanted, len(ids)) - 1, axis=1)[:, :wanted]
            row = np.repeat(np.arange(len(some)), some.shape[1])
            col = some.ravel()
            fine = np.isfinite(scores[row, col])
            parts.append(pd.DataFrame({"query_id": q_ids[at + row[fine]], "neighbour_id": ids[col[fine]], "score": scores[row[fine], col[fine]].astype(float)}))
        return pd.concat(parts)

    found = N.dealt_by_cell(asked, stored, ("neighbour_id", "code"), index.book.cells, out, wanted, index.probes, True, block)
    near = found.select("query_id", "neighbour_id").join(vectors, "neighbour_id").join(
        asked.select("query_id", F.col("vec").alias("__asked")), "query_id"
    )

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = batch.column("vec"), batch.column("__asked")
                size = len(a[0])
                score = (N._unit_rows(N._matrix(a, size)) * N._unit_rows(N._matrix(b, size))).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("query_id"), batch.column("neighbour_id"), pa.array(np.round(score, N.SCORE_DIGITS) + 0.0)],
                    ["query_id", "neighbour_id", "score"],
                )

    return N._top(near.mapInArrow(exact, out), k)
