"""Exact nearest neighbours for many queries, leaving out what the triangle inequality rules out.

Vectors are taken at unit length, so the order by cosine is the order by distance. Corpus rows belong to the
nearest of some centres and there to a ring of distances from it: a slice. A query first searches the slices
of its own centre, which bounds how far its k-th neighbour can be. From a query's distance to a centre follows
how near any row of a ring can come; slices that cannot come within the bound are left out, all others are
searched. The result is that of the full comparison; how much of it was made is reported.

Queries of near centres lie in blocks, neighbouring slices in blocks of the corpus, both of bounded size; a block
of queries meets a block of the corpus in one task, if any of its queries wants any slice there. So a query is
copied once for each block of the corpus it looks into at most, never for each slice.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

from lawloom.operators import codes, neighbours as N
from lawloom.session import cut_lineage

# Task functions travel with the job, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Centres, and rings around each. Their table, which goes to every task, has at most so many rows.
MOST_CENTRES, RINGS = 1_024, 8
#: Rows of a slice, about, as far as centres suffice.
SLICE_ROWS = 4_096
#: Queries whose slices are chosen at once in a task.
ROUTED_AT_ONCE = 512
#: Greatest distance of two unit vectors, and what rounding may take from a bound.
FARTHEST, SLACK = 2.0, 1e-6


def _vectors(column: pa.Array) -> np.ndarray:
    return N._unit_rows(N._matrix(column, len(column[0])))


def _away(vecs: np.ndarray, centres: np.ndarray) -> np.ndarray:
    square = (vecs**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1)[None, :] - 2 * vecs @ centres.T
    return np.sqrt(np.maximum(square, 0))


def _floors(batch: pa.RecordBatch) -> np.ndarray | None:
    """The score of each query's k-th row so far, none as minus infinity; None before the first search."""
    if "floor" not in batch.schema.names:
        return None
    return batch.column("floor").fill_null(-np.inf).to_numpy(zero_copy_only=False)


def placed(rows: DataFrame, key: str, centres) -> DataFrame:
    """Rows with their centre and their distance from it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                away = _away(_vectors(batch.column("vec")), centres.value)
                own = away.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(own.astype(np.int32)), pa.array(away[np.arange(len(own)), own])], [*batch.schema.names, "centre", "away"]
                )

    schema = T.StructType([*rows.schema.fields]).add("centre", "integer").add("away", "double")
    return rows.mapInArrow(run, schema)


def packed(sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(first block, number of blocks) of each of some groups in turn: small ones share a block, large ones take several."""
    parts = np.maximum(1, -(-sizes // most))
    first, block, room = np.zeros(len(sizes), np.int64), -1, 0
    for i, size in enumerate(sizes):
        if parts[i] > 1 or size > room:
            block, room = block + 1, most
        first[i] = block
        block, room = block + parts[i] - 1, room - size if parts[i] == 1 else 0
    return first, parts


def _dealt(rows: DataFrame, group: str, id_: str, groups: np.ndarray, first: np.ndarray, parts: np.ndarray, name: str) -> DataFrame:
    """Rows with the block that their group, and in large groups their id, falls to. At most MOST_CENTRES x RINGS groups."""
    table = rows.sparkSession.createDataFrame(
        pa.table({"__g": pa.array(groups, pa.int64()), "__first": pa.array(first, pa.int64()), "__parts": pa.array(parts, pa.int64())})
    )
    own = (F.col("__first") + F.pmod(F.xxhash64(id_), F.col("__parts"))).alias(name)
    return rows.join(F.broadcast(table), F.col(group) == F.col("__g")).select(*rows.columns, own)


def nearest_pruned(
    queries: DataFrame, corpus: DataFrame, k: int, query_id: str = "vec_id", corpus_id: str = "vec_id", vec: str = "vec",
    skip_self: bool = True, slice_rows: int = SLICE_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """query_id, neighbour_id, score, rank as `nearest` gives them; and one row: pairs, compared (of queries and rows)."""
    spark = corpus.sparkSession
    rows = corpus.where(F.col(vec).isNotNull()).select(F.col(corpus_id).alias("neighbour_id"), F.col(vec).alias("vec"))
    asked = N._asked(queries, query_id, vec)
    out = N._result(asked, rows)
    total = rows.count()
    if not total:
        empty = T.StructType([*out.fields, T.StructField("rank", T.IntegerType())])
        return spark.createDataFrame([], empty), spark.createDataFrame([(0, 0)], "pairs long, compared long")
    number = min(MOST_CENTRES, max(1, total // (slice_rows * RINGS)), total)
    shared = spark.sparkContext.broadcast(codes.fit(rows, number).cells)
    near = placed(rows, "neighbour_id", shared)
    widest = near.groupBy("centre").agg(F.max("away").alias("most"), F.min("away").alias("least"))
    ring = F.least(F.floor((F.col("away") - F.col("least")) / (F.col("most") - F.col("least") + 1e-12) * RINGS), F.lit(RINGS - 1))
    kept = cut_lineage(near.join(widest, "centre").withColumn("slice", (F.col("centre") * RINGS + ring).cast("long")).drop("most", "least"))
    # At most MOST_CENTRES x RINGS rows, in the order of slices.
    table = kept.groupBy("slice").agg(F.min("away").alias("low"), F.max("away").alias("high"), F.count("*").alias("n")).toArrow().sort_by("slice")
    slices, low, high, size = (table.column(c).to_numpy() for c in ("slice", "low", "high", "n"))
    first, parts = packed(size, N.CORPUS_SLICE // 2)
    corpus_rows = _dealt(kept, "slice", "neighbour_id", slices, first, parts, "cs").select("slice", "neighbour_id", "vec", "cs")
    # Each slice once for each of its blocks, in the order of blocks.
    entry = np.repeat(np.arange(len(slices)), parts)
    entry_block = np.repeat(first, parts) + np.arange(len(entry)) - np.repeat(np.cumsum(parts) - parts, parts)
    starts = np.flatnonzero(np.r_[True, entry_block[1:] != entry_block[:-1]])
    bounds = spark.sparkContext.broadcast((slices, low, high, size, entry, starts))

    # Queries of near centres in blocks: at most MOST_CENTRES rows tell how many each has.
    homes = placed(asked, "query_id", shared).withColumnRenamed("centre", "home").drop("away")
    per_home = homes.groupBy("home").count().toArrow().sort_by("home")
    blocks = packed(per_home.column("count").to_numpy(), N.QUERY_BLOCK // 2)
    homes = _dealt(homes, "home", "query_id", per_home.column("home").to_numpy(), *blocks, "qb")

    def wanted(vecs: np.ndarray, home: np.ndarray, floor: np.ndarray | None, some: np.ndarray) -> np.ndarray:
        """Which of some slices (places in the table) each query must search: those of its centre, or, given the
        score of its k-th row so far, what else may hold a neighbour."""
        slices, low, high, *_ = bounds.value
        centre = slices[some] // RINGS
        mine = centre[None, :] == home[:, None]
        if floor is None:
            return mine
        held, at = np.unique(centre, return_inverse=True)
        to = _away(vecs, shared.value[held])[:, at]
        bound = np.where(np.isfinite(floor), np.sqrt(np.maximum(2 - 2 * (floor - 10.0**-N.SCORE_DIGITS), 0)), FARTHEST)
        return ~mine & (np.maximum(to - high[some], low[some] - to) <= (bound + SLACK)[:, None])

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Queries with the blocks of the corpus they must go to, and the number of rows they meet there."""
        *_, size, entry, starts = bounds.value
        every = np.arange(len(size))
        for whole in batches:
            for at in range(0, whole.num_rows, ROUTED_AT_ONCE):
                batch = whole.slice(at, ROUTED_AT_ONCE)
                floor = _floors(batch)
                mine = wanted(_vectors(batch.column("vec")), batch.column("home").to_numpy(), floor, every)
                go = np.logical_or.reduceat(mine[:, entry], starts, axis=1)
                ends = np.r_[0, np.cumsum(go.sum(axis=1))].astype(np.int32)
                to = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.nonzero(go)[1].astype(np.int64)))
                yield pa.RecordBatch.from_arrays([*batch.columns, to, pa.array(mine @ size)], [*batch.schema.names, "to", "n"])

    def block(asking: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        """The best k between a block of queries and one of the corpus, slice by slice."""
        if asking.empty or rows.empty:
            return pd.DataFrame(columns=["query_id", "neighbour_id", "score"])
        q_ids, ids = N._sortable(asking["query_id"].to_numpy()), N._sortable(rows["neighbour_id"].to_numpy())
        q_vecs, vecs = (N._unit_rows(np.stack(df["vec"].to_numpy()).astype(np.float64)) for df in (asking, rows))
        floor = asking["floor"].to_numpy() if "floor" in asking else None
        order = np.lexsort((ids, rows["slice"].to_numpy()))
        ids, vecs, own = ids[order], vecs[order], rows["slice"].to_numpy()[order]
        begins = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        some = np.searchsorted(bounds.value[0], own[begins])
        known = None if floor is None else np.where(np.isnan(floor), -np.inf, floor)
        mine = wanted(q_vecs, asking["home"].to_numpy(), known, some)
        best = N.Best(q_ids, q_vecs, k, skip_self, known)
        for a, b, col in zip(begins, np.r_[begins[1:], len(own)], mine.T):
            if col.any():
                best.add(np.flatnonzero(col), ids[a:b], vecs[a:b])
        at, found, scores = best.result()
        return pd.DataFrame({"query_id": q_ids[at], "neighbour_id": found, "score": scores})

    def searched(asking: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The best k of each query in its wanted slices; and the queries with what they meet."""
        sent = cut_lineage(asking.mapInArrow(routed, T.StructType([*asking.schema.fields]).add("to", T.ArrayType(T.LongType())).add("n", "long")))
        # One row for each block of queries and block of the corpus that meet: both are of bounded size.
        pairs = sent.select(F.col("qb").alias("block"), F.explode("to").alias("cs")).distinct()
        left = sent.drop("n").withColumn("cs", F.explode("to")).drop("to").groupBy("qb", "cs")
        right = corpus_rows.join(F.broadcast(pairs), "cs").groupBy("block", "cs")
        return left.cogroup(right).applyInPandas(block, out), sent.select("n")

    first_found, first_met = searched(homes)
    first_found = cut_lineage(first_found)
    # The k-th best so far; a query that has not found k may find the rest anywhere.
    ranked = N._top(first_found, k).where(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
    more_found, more_met = searched(homes.join(ranked, "query_id", "left"))
    report = first_met.select("n", F.lit(1).alias("q")).unionByName(more_met.select("n", F.lit(0).alias("q"))).agg(
        (F.coalesce(F.sum("q"), F.lit(0)) * total).alias("pairs"), F.coalesce(F.sum("n"), F.lit(0)).alias("compared")
    )
    return N._top(first_found.unionByName(more_found), k), report
