"""Nearest neighbours by cosine or dot product, exact or within cells of similar vectors.

Scores are matrix products over Arrow batches; every task keeps only its best k rows per query, so
what is shuffled grows with queries times tasks, never with queries times vectors.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lawloom.functions.vectors import unit

# Task functions travel with the job, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BROADCAST_QUERIES = 4_096
# A block of queries meets a slice of the corpus in one task; the corpus is copied once for each block.
QUERY_BLOCK = 16_384
CORPUS_SLICE = 65_536
SCORE_DIGITS = 9  # scores equal to this many digits are ties, broken by id
# Columns and scores of a tile: 16 MB of scores, whatever the sizes of block and slice.
_COLUMNS_AT_ONCE, _SCORES_AT_ONCE = 4_096, 2 << 20


def _unit_rows(m: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, length, out=np.zeros_like(m), where=length > 0)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _sortable(ids: np.ndarray) -> np.ndarray:
    """Text ids as fixed-width text: compared by code point, as the engine compares them."""
    return ids.astype(str) if ids.dtype == object else ids


class Best:
    """The best k rows of each query among those given so far, ties by id.

    Scores are made in tiles of bounded size, and what is kept of a tile is at most a few rows per query, however
    many rows tie. `floor`: a score that a query's rows must reach at least.
    """

    def __init__(self, q_ids: np.ndarray, q_vecs: np.ndarray, k: int, skip_self: bool, floor: np.ndarray | None = None):
        self.q_ids, self.q_vecs, self.k, self.skip_self = q_ids, q_vecs, k, skip_self
        self.floor = np.full(len(q_ids), -np.inf) if floor is None else floor.copy()
        self.parts, self.waiting = [], 0

    def add(self, at: np.ndarray, ids: np.ndarray, vecs: np.ndarray, allowed: np.ndarray | None = None) -> None:
        """Rows, ascending by id, for the queries at positions `at`; `allowed` (those by rows) leaves pairs out."""
        for left in range(0, len(ids), _COLUMNS_AT_ONCE):
            cols = slice(left, left + _COLUMNS_AT_ONCE)
            step = max(1, _SCORES_AT_ONCE // len(ids[cols]))
            for top in range(0, len(at), step):
                rows = slice(top, top + step)
                self._tile(at[rows], ids[cols], vecs[cols], None if allowed is None else allowed[rows, cols])

    def _tile(self, at: np.ndarray, ids: np.ndarray, vecs: np.ndarray, allowed: np.ndarray | None) -> None:
        scores = self.q_vecs[at] @ vecs.T
        if self.skip_self:
            asked = self.q_ids[at]
            low = np.searchsorted(ids, asked)
            n = np.where(asked == asked, np.searchsorted(ids, asked, "right") - low, 0)
            scores[np.repeat(np.arange(len(at)), n), np.arange(n.sum()) + np.repeat(low - np.cumsum(n) + n, n)] = -np.inf
        if allowed is not None:
            scores[~allowed] = -np.inf
        floor = self.floor[at]
        # What rounding may lift to the floor is taken along and rounded below.
        hit = scores >= (floor - 10.0**-SCORE_DIGITS - 1e-15 * np.abs(np.where(np.isfinite(floor), floor, 0)))[:, None]
        if np.count_nonzero(hit) > 4 * self.k * len(at):
            np.round(scores, SCORE_DIGITS, out=scores)
            scores[~np.isfinite(scores)] = -np.inf
            n = scores.shape[1]
            if n > self.k:
                floor = np.maximum(floor, np.partition(scores, n - self.k, axis=1)[:, n - self.k])
            hit = scores > floor[:, None]
            tied = scores == floor[:, None]
            hit |= tied & (np.cumsum(tied, axis=1, dtype=np.int32) <= (self.k - hit.sum(axis=1))[:, None])
        rows, cols = np.nonzero(hit)
        found = np.round(scores[rows, cols], SCORE_DIGITS) + 0.0
        good = np.isfinite(found) & (found >= floor[rows])
        if good.any():
            self.parts.append((at[rows[good]], ids[cols[good]], found[good]))
            self.waiting += int(good.sum())
        if self.waiting > self.k * len(self.q_ids) // 2:
            self._merge()

    def _merge(self) -> None:
        rows, found, scores = (np.concatenate(p) for p in zip(*self.parts))
        order = np.lexsort((found, -scores, rows))
        rows, found, scores = rows[order], found[order], scores[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        last = place == self.k - 1
        self.floor[rows[last]] = np.maximum(self.floor[rows[last]], scores[last])
        kept = place < self.k
        self.parts, self.waiting = [(rows[kept], found[kept], scores[kept])], 0

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query position, id, score), by position, score and id."""
        if not self.parts:
            return np.zeros(0, np.int64), self.q_ids[:0], np.zeros(0)
        self._merge()
        return self.parts[0]


def _best(q_ids, q_vecs, ids, vecs, k: int, skip_self: bool, allowed: np.ndarray | None = None):
    """(query position, id, score) of the best k rows per query, ties by id.

    `allowed` (queries by rows) leaves the other pairs out.
    """
    order = np.argsort(ids, kind="stable")
    best = Best(q_ids, q_vecs, k, skip_self)
    best.add(np.arange(len(q_ids)), ids[order], vecs[order], None if allowed is None else allowed[:, order])
    return best.result()


def _scan(batches: Iterator[pa.RecordBatch], held, k: int, size: int, cosine: bool, skip_self: bool,
          schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Best k per query over one partition, carried from batch to batch."""
    q_ids, q_vecs, probes = held.value
    kept = None
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = _sortable(batch.column(0).to_numpy(zero_copy_only=False))
        vecs = _matrix(batch.column(1), size)
        # probes: queries by cells; a third column then names each row's cell.
        allowed = None if probes is None else probes[:, batch.column(2).to_numpy()]
        rows, found, scores = _best(q_ids, q_vecs, ids, _unit_rows(vecs) if cosine else vecs, k, skip_self, allowed)
        if kept is not None:
            rows, found, scores = (np.concatenate(p) for p in zip(kept, (rows, found, scores)))
            order = np.lexsort((found, -scores, rows))
            rows, found, scores = rows[order], found[order], scores[order]
            top = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
            rows, found, scores = rows[top], found[top], scores[top]
        kept = (rows, found, scores)
    if kept is not None:
        rows, found, scores = kept
        yield pa.RecordBatch.from_arrays(
            [pa.array(q_ids[rows].tolist(), schema.field(0).type), pa.array(found.tolist(), schema.field(1).type),
             pa.array(scores)],
            schema=schema,
        )


def _block(queries: pd.DataFrame, corpus: pd.DataFrame, k: int, cosine: bool, skip_self: bool) -> pd.DataFrame:
    """Best k per query between one block of queries and one slice of the corpus."""
    names = ["query_id", "neighbour_id", "score"]
    if queries.empty or corpus.empty:
        return pd.DataFrame(columns=names)
    q_ids, ids = _sortable(queries["query_id"].to_numpy()), _sortable(corpus["neighbour_id"].to_numpy())
    q_vecs = np.stack(queries["vec"].to_numpy()).astype(np.float64)
    vecs = np.stack(corpus["vec"].to_numpy()).astype(np.float64)
    if cosine:
        q_vecs, vecs = _unit_rows(q_vecs), _unit_rows(vecs)
    rows, found, scores = _best(q_ids, q_vecs, ids, vecs, k, skip_self)
    return pd.DataFrame({"query_id": q_ids[rows], "neighbour_id": found, "score": scores})


def _top(found: DataFrame, k: int) -> DataFrame:
    """Final ranks out of the tasks' best rows."""
    window = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("neighbour_id"))
    return found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def _result(queries: DataFrame, rows: DataFrame) -> T.StructType:
    return (
        T.StructType()
        .add("query_id", queries.schema["query_id"].dataType)
        .add("neighbour_id", rows.schema["neighbour_id"].dataType)
        .add("score", "double")
    )


def _asked(queries: DataFrame, query_id: str, vec: str) -> DataFrame:
    return queries.where(F.col(vec).isNotNull()).select(F.col(query_id).alias("query_id"), F.col(vec).alias("vec"))


def hold_queries(asked: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Ids and vectors of at most `limit` queries; None when there are more.

    The limit bounds what reaches the driver, whatever the size of the query table.
    """
    held = asked.limit(limit + 1).toArrow()
    if held.num_rows > limit:
        return None
    column = held.column("vec").combine_chunks()
    size = len(column[0]) if held.num_rows else 0
    return _sortable(held.column("query_id").to_numpy()), _matrix(column, size) if size else np.zeros((0, 0))


def scan_rows(rows: DataFrame, held, out: T.StructType, k: int, cosine: bool, skip_self: bool,
              probes: np.ndarray | None = None) -> DataFrame:
    """Best k rows per held query: one pass over `rows`, no shuffle before the tasks' best rows."""
    q_ids, q_vecs = held
    sent = rows.sparkSession.sparkContext.broadcast((q_ids, _unit_rows(q_vecs) if cosine else q_vecs, probes))
    scan = partial(
        _scan, held=sent, k=k, size=q_vecs.shape[1], cosine=cosine, skip_self=skip_self, schema=to_arrow_schema(out)
    )
    return _top(rows.mapInArrow(scan, out), k)


def nearest(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    query_id: str = "vec_id",
    corpus_id: str = "vec_id",
    vec: str = "vec",
    cosine: bool = True,
    skip_self: bool = True,
    broadcast_queries: int = BROADCAST_QUERIES,
) -> DataFrame:
    """query_id, neighbour_id, score, rank: the k best corpus rows of every query, ties by id.

    Up to `broadcast_queries` queries are sent to every task and the corpus is read once without a
    shuffle. More queries are cut into blocks and the corpus into slices, both by a hash of the
    unique id; every block meets every slice in one task of bounded size. Both ways are exact.
    """
    spark = corpus.sparkSession
    asked = _asked(queries, query_id, vec)
    rows = corpus.where(F.col(vec).isNotNull()).select(
        F.col(corpus_id).alias("neighbour_id"), F.col(vec).alias("vec")
    )
    out = _result(asked, rows)
    held = hold_queries(asked, broadcast_queries)
    if held is not None:
        if not len(held[0]):
            return spark.createDataFrame([], T.StructType([*out.fields, T.StructField("rank", T.IntegerType())]))
        return scan_rows(rows, held, out, k, cosine, skip_self)
    number = asked.count()
    # Few queries: blocks enough for all cores.
    blocks = max(1, -(-number // (QUERY_BLOCK // 2)), min(spark.sparkContext.defaultParallelism, number // 1_024))
    slices = max(1, -(-rows.count() // (CORPUS_SLICE // 2)))

    def spread_over(df: DataFrame, own: str, n_own: int, other: str, n_other: int, key: str) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64(key), F.lit(n_own)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))
        )

    left = spread_over(asked, "qb", blocks, "cs", slices, "query_id")
    right = spread_over(rows, "cs", slices, "qb", blocks, "neighbour_id")
    found = left.groupBy("qb", "cs").cogroup(right.groupBy("qb", "cs")).applyInPandas(
        lambda q, c: _block(q, c, k, cosine, skip_self), out
    )
    return _top(found, k)


def write_cells(
    corpus: DataFrame, path: str, n_cells: int, corpus_id: str = "vec_id", vec: str = "vec",
    cosine: bool = True, seed: int = 7,
) -> np.ndarray:
    """Write the corpus as a folder per cell of similar vectors; returns the cells' centres.

    Centres are fitted on all rows; for cosine search, on unit vectors. Ranges of (cell, id) spread a large cell
    over many tasks and files.
    """
    rows = corpus.where(F.col(vec).isNotNull()).select(F.col(corpus_id).alias("neighbour_id"), F.col(vec).alias("vec"))
    placed = F.col("vec").cast("array<double>")
    points = rows.withColumn("__v", array_to_vector(unit(placed) if cosine else placed))
    fitted = KMeans(k=n_cells, seed=seed, featuresCol="__v", predictionCol="cell").fit(points)
    (
        fitted.transform(points)
        .drop("__v")
        .repartitionByRange("cell", "neighbour_id")
        .write.mode("overwrite")
        .partitionBy("cell")
        .parquet(path)
    )
    return np.array(fitted.clusterCenters())


def nearest_centres(vecs: np.ndarray, centres: np.ndarray, probes: int, cosine: bool) -> np.ndarray:
    """The `probes` nearest centres of each vector."""
    vecs = _unit_rows(vecs) if cosine else vecs
    away = (centres**2).sum(axis=1)[None, :] - 2 * vecs @ centres.T
    return np.argsort(away, axis=1, kind="stable")[:, :probes]


def measured_probes(
    queries: DataFrame, corpus: DataFrame, path: str, centres: np.ndarray, k: int, query_id: str = "vec_id",
    corpus_id: str = "vec_id", skip_self: bool = True, wanted: float = 0.95, most: int = 128, **how,
) -> tuple[int, float]:
    """The least number of cells (doubling) with which at most `most` of the queries reach the wanted recall, and that recall."""
    some = queries.orderBy(F.xxhash64(query_id), query_id).limit(most).cache()
    exact = nearest(some, corpus, k, query_id, corpus_id, skip_self=skip_self, **how).select("query_id", "neighbour_id").cache()
    total, probes = exact.count(), 1
    while True:
        probes = min(probes, len(centres))
        found = nearest_in_cells(some, path, centres, k, probes, query_id, skip_self=skip_self, **how)
        recall = found.join(exact, ["query_id", "neighbour_id"], "left_semi").count() / total if total else 1.0
        if recall >= wanted or probes == len(centres):
            return probes, recall
        probes *= 2


def _by_cell(asked: DataFrame, stored: DataFrame, centres: np.ndarray, out: T.StructType, k: int, probes: int,
             cosine: bool, skip_self: bool) -> DataFrame:
    """Search in cells for any number of queries."""
    search = lambda q, c: _block(q, c, k, cosine, skip_self)
    return dealt_by_cell(asked, stored, ("neighbour_id", "vec"), centres, out, k, probes, cosine, search)


def dealt_by_cell(asked: DataFrame, stored: DataFrame, columns: tuple[str, ...], centres: np.ndarray, out: T.StructType,
                  k: int, probes: int, cosine: bool, search: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """The best k of what `search` finds between blocks of queries and slices of the cells they look into."""
    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                near = nearest_centres(np.stack(frame["vec"].to_numpy()).astype(np.float64), centres, probes, cosine)
                yield frame.assign(cell=list(near.astype(np.int32))).explode("cell").astype({"cell": "int32"})

    left = asked.mapInPandas(deal, T.StructType([*asked.schema, T.StructField("cell", T.IntegerType())]))
    right = stored.select(*columns, F.col("cell").cast("int").alias("cell"))

    def parts(df: DataFrame, most: int) -> list[int]:
        sizes = dict(map(tuple, df.groupBy("cell").count().collect()))  # at most one row per cell
        return [max(1, -(-sizes.get(c, 0) // (most // 2))) for c in range(len(centres))]

    def spread_over(df: DataFrame, own: str, n_own: list[int], other: str, n_other: list[int], key: str) -> DataFrame:
        number = lambda n: F.get(F.array(*map(F.lit, n)), F.col("cell"))
        return df.withColumn(own, F.pmod(F.xxhash64(key), number(n_own)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), number(n_other) - 1))
        )

    blocks, slices = parts(left, QUERY_BLOCK), parts(right, CORPUS_SLICE)
    left = spread_over(left, "qb", blocks, "cs", slices, "query_id").groupBy("cell", "qb", "cs")
    right = spread_over(right, "cs", slices, "qb", blocks, "neighbour_id").groupBy("cell", "qb", "cs")
    return _top(left.cogroup(right).applyInPandas(lambda q, c: search(q, c), out), k)


def nearest_in_cells(
    queries: DataFrame,
    path: str,
    centres: np.ndarray,
    k: int,
    probes: int,
    query_id: str = "vec_id",
    vec: str = "vec",
    cosine: bool = True,
    skip_self: bool = True,
    broadcast_queries: int = BROADCAST_QUERIES,
) -> DataFrame:
    """Approximate k best: each query looks only into its `probes` nearest cells.

    Only those cells' folders are read. With as many probes as cells the result is exact. Up to
    `broadcast_queries` queries are sent to every task; more of them are dealt to their cells, each
    cell's queries in blocks and its vectors in slices, and every block meets every slice of its cell.
    """
    spark = queries.sparkSession
    asked = _asked(queries, query_id, vec)
    held = hold_queries(asked, broadcast_queries)
    stored = spark.read.parquet(path)
    out = _result(asked, stored)
    if held is None:
        return _by_cell(asked, stored, centres, out, k, probes, cosine, skip_self)
    if not len(held[0]):
        return spark.createDataFrame([], T.StructType([*out.fields, T.StructField("rank", T.IntegerType())]))
    near = nearest_centres(held[1], centres, probes, cosine)
    wanted = np.zeros((len(near), len(centres)), dtype=bool)
    np.put_along_axis(wanted, near, True, axis=1)
    cells = [int(c) for c in np.flatnonzero(wanted.any(axis=0))]
    rows = stored.where(F.col("cell").isin(cells)).select("neighbour_id", "vec", F.col("cell").cast("int").alias("cell"))
    return scan_rows(rows, held, out, k, cosine, skip_self, wanted)
