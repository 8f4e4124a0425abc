"""Queries over trees of files, paired arrivals, tables kept current, indexed pages, sketches, codes and JSON values."""

from __future__ import annotations

import posixpath
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lawloom.constants import LASTMOD_SUFFIX, STATUS_FILE_NAME
from lawloom.functions import documents
from lawloom.operators import codes, neighbours, pruned, quality, topics, unify, upsert
from lawloom.plans import inputs as I
from lawloom.plans.document_queries import _ALL_QUERIES, _COS, _ranked, _sql_top
from lawloom.plans.registry import ORACLES, query
from lawloom.plans.table_queries import _LATEST_LINE, _LINE_COLUMNS, _LINE_RANK, _line_out, _spark_stamp, _stamp, _unified_rows
from lawloom.session import scratch_path
from lawloom.sources import buckets, pages, tables, treesource
from lawloom.sources.xmltree import lastmod_of
from lawloom.streaming import pairs
from lawloom.streaming.ingest import file_arrivals

T = I.table


# ---- trees and arrivals ----

def write_document_tree(docs: DataFrame, root: str) -> None:
    """A file per document below `root`, by language; every seventh has no side file."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top, _ = treesource.opened(root)
        for batch in batches:
            for key, lang, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "lang", "text"))):
                folder = posixpath.join(top, f"data/118/bills/{lang}/{lang}{key}")
                store.create_dir(folder, recursive=True)
                files = {STATUS_FILE_NAME: text or ""}
                if key % 7:
                    files[STATUS_FILE_NAME.split(".")[0] + LASTMOD_SUFFIX] = f" 2024-01-01T00:00:{key % 60:02d}Z\n"
                for name, body in files.items():
                    with store.open_output_stream(posixpath.join(folder, name)) as file:
                        file.write(body.encode())
        yield pa.RecordBatch.from_arrays([pa.array([], pa.int64())], ["n"])

    docs.select("doc_id", "lang", "text").mapInArrow(run, "n long").count()


@query(
    "q_tree_source",
    """SELECT doc_id, lang, CASE WHEN doc_id % 7 <> 0 THEN '2024-01-01 00:00:' || lpad(CAST(doc_id % 60 AS VARCHAR), 2, '0') END AS lastmod,
         md5(coalesce(text, '')) AS body_md5 FROM documents""",
)
def q_tree_source(spark, d):
    root = scratch_path(spark, "tree")
    write_document_tree(T(spark, d, "documents"), root)
    found = treesource.read_tree(spark, root, STATUS_FILE_NAME)
    place = r"/([^/]+)/[^/0-9]*([0-9]+)/[^/]+$"
    return found.select(
        F.regexp_extract("path", place, 2).cast("bigint").alias("doc_id"),
        F.regexp_extract("path", place, 1).alias("lang"),
        _spark_stamp(lastmod_of(F.col("stamp_text"))).alias("lastmod"),
        F.md5(F.col("body").cast("binary")).alias("body_md5"),
    )


_WAIT_DAYS = 90
#: Arrivals come in this many portions, by time.
_PORTIONS = ("1997-01-01", "1999-01-01")


@query(
    "q_stream_pairs",
    f"""WITH f AS (SELECT o_orderkey AS stem, o_orderdate AS at FROM orders),
         s AS (SELECT l_orderkey AS stem, min(l_shipdate) AS at FROM lineitem WHERE l_linenumber = 1 GROUP BY 1)
       SELECT coalesce(f.stem, s.stem) AS stem, {_stamp('f.at')} AS at, {_stamp('s.at')} AS side_at,
         CASE WHEN s.stem IS NULL THEN 'side:missing' WHEN f.stem IS NULL THEN 'file:missing' ELSE 'kept' END AS state
       FROM f FULL OUTER JOIN s ON f.stem = s.stem
         AND s.at BETWEEN f.at - INTERVAL {_WAIT_DAYS} DAY AND f.at + INTERVAL {_WAIT_DAYS} DAY""",
)
def q_stream_pairs(spark, d):
    """Orders as files, first line items as side files, arriving in three portions and two runs."""
    files = T(spark, d, "orders").select(F.col("o_orderkey").alias("stem"), F.col("o_orderdate").cast("timestamp").alias("at"))
    lines = T(spark, d, "lineitem").where("l_linenumber = 1").groupBy(F.col("l_orderkey").alias("stem"))
    sides = lines.agg(F.min("l_shipdate").cast("timestamp").alias("at"))
    file_folder, side_folder, log, state = pairs.folders(spark, "pairs")
    bounds = [F.lit(b).cast("timestamp") for b in _PORTIONS]
    portions = [F.col("at") < bounds[0], (F.col("at") >= bounds[0]) & (F.col("at") < bounds[1]), F.col("at") >= bounds[1]]

    def run():
        left = file_arrivals(spark, file_folder, files.schema, per_batch=None)
        right = file_arrivals(spark, side_folder, sides.schema, per_batch=None)
        pairs.start_pairing(left, right, log, state, "stem", "at", f"{_WAIT_DAYS} DAYS", "1 DAY").awaitTermination()
        return left, right

    for portion in portions:
        pairs.write_arrivals(files.where(portion), file_folder)
        pairs.write_arrivals(sides.where(portion), side_folder)
        run()
    for folder, rows in ((file_folder, files), (side_folder, sides)):
        pairs.write_end(spark, rows.schema, folder, "at")
    left, right = run()
    schema = pairs.paired(left, right, "stem", "at", f"{_WAIT_DAYS} DAYS", "1 DAY").schema
    return pairs.read_pairs(spark, log, schema, "at").select(
        F.coalesce("stem", "side_stem").alias("stem"), _spark_stamp("at").alias("at"), _spark_stamp("side_at").alias("side_at"), "state"
    )


# ---- tables kept current ----

def delta_tables(spark: SparkSession, d: str) -> tuple[list[tuple[DataFrame, DataFrame]], str]:
    """Bills and texts as three arrivals, and the folder they are kept in.

    At first some bills list fewer versions, some are missing, some texts are missing and some are older. Early
    years are put right by the second arrival, late ones by the third.
    """
    root = scratch_path(spark, "delta")
    bills = I.order_bills(T(spark, d, "orders")).withColumn("stage", F.lit(1))
    # Bare line items meet their years; texts, ids and names are made of them after that.
    lines = T(spark, d, "lineitem").join(bills.select(F.col("legis_num").alias("l_orderkey"), "congress_num"), "l_orderkey")
    texts = I.lineitem_texts(lines, "congress_num", F.col("l_linenumber").cast("int").alias("number"))
    texts = texts.where(F.col("tv_id").isNotNull()).withColumn("stage", F.lit(1))
    fewer, absent = F.col("legis_num") % 5 == 0, F.col("legis_num") % 7 == 0
    early = F.col("congress_num") <= 1997
    first_bills = bills.where(~absent).withColumns(
        {"text_versions": F.when(fewer, F.slice("text_versions", 1, 3)).otherwise(F.col("text_versions")), "stage": F.lit(0)}
    )
    older = F.col("number") == 3
    first_texts = texts.where("number <> 2").withColumns(
        {"lastmod": F.when(older, F.col("lastmod") - F.expr("INTERVAL 1000 DAYS")).otherwise(F.col("lastmod")), "stage": F.lit(0)}
    )
    arrivals = [(first_bills, first_texts.drop("number"))]
    for when in (early, ~early):
        arrivals.append((bills.where(when & (fewer | absent)), texts.where(when & F.col("number").isin(2, 3)).drop("number")))
    return arrivals, root


@query("q_unified_delta", ORACLES["q_unified"])
def q_unified_delta(spark, d):
    arrivals, root = delta_tables(spark, d)
    for n, (bills, texts) in enumerate(arrivals):
        for rows, name, key in ((bills, "status", "legis_id"), (texts, "texts", "tv_id")):
            upsert.upsert_folder(rows, f"{root}/{name}", [key], ["stage"], "congress_num", changes=f"{root}/changes-{n}/{name}")
        paths = [f"{root}/{p}" for p in ("unified", "status", "texts", f"changes-{n}/status", f"changes-{n}/texts")]
        unify.refresh_folder(spark, *paths, versions="text_versions")
    return _unified_rows(spark.read.parquet(f"{root}/unified"))


@query("q_upsert_bucketed", _LATEST_LINE)
def q_upsert_bucketed(spark, d):
    rows = T(spark, d, "lineitem").select("l_linestatus", *_LINE_COLUMNS)
    name = f"lines_{scratch_path(spark, 'b').rsplit('-', 1)[1]}"
    number = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for is_open in (True, False):
        arrived = rows.where((F.col("l_linestatus") == "O") == F.lit(is_open)).drop("l_linestatus")
        kept = buckets.upsert_buckets(arrived, name, "l_orderkey", _LINE_RANK, number)
    return _line_out(kept)


@query("q_page_rows_indexed", ORACLES["q_page_rows_deep"])
def q_page_rows_indexed(spark, d):
    names = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    order, path = [*names, "l_extendedprice"], scratch_path(spark, "pages")
    pages.write_pages(T(spark, d, "lineitem").select(*order), order, path, rows_per_range=10_000)
    return pages.page_of(spark, path, order, 30000, 100).select(*names)


def split_copy(spark: SparkSession, d: str) -> DataFrame:
    """Line items in a folder per month of shipping."""
    path = scratch_path(spark, "splits")
    lines = T(spark, d, "lineitem").withColumn("month", F.month("l_shipdate"))
    lines.repartition("month").write.partitionBy("month").parquet(path)
    return spark.read.parquet(path)


@query(
    "q_pruned_splits",
    """SELECT month(l_shipdate) AS month, count(*) AS n, sum(CAST(l_quantity AS BIGINT))::BIGINT AS quantity FROM lineitem
       WHERE month(l_shipdate) IN (2, 3) GROUP BY 1""",
)
def q_pruned_splits(spark, d):
    """Two of twelve splits of a table stored by split."""
    chosen = tables.select_splits(split_copy(spark, d), [2, 3], "month")
    return chosen.groupBy(F.col("month").cast("bigint").alias("month")).agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))


@query(
    "q_splits_of_join",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE month(l_shipdate) IN
         (SELECT month(o_orderdate) FROM orders WHERE o_orderkey < 3)""",
)
def q_splits_of_join(spark, d):
    """The splits that a filtered table names: known only when it runs, and only they are read."""
    few = T(spark, d, "orders").where("o_orderkey < 3").select(F.month("o_orderdate").alias("month"))
    return tables.chosen_splits(split_copy(spark, d), few, "month").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


# ---- profiles and checks ----

@query(
    "q_distinct_sketch",
    """WITH s AS (SELECT event_type AS span, user_id FROM events UNION ALL SELECT 'all', user_id FROM events
         UNION ALL SELECT 'first ' || event_type[1], user_id FROM events)
       SELECT span, count(user_id) AS n_rows, count(DISTINCT user_id) AS n_exact, true AS is_within FROM s GROUP BY span""",
)
def q_distinct_sketch(spark, d):
    """Distinct users per kind of event, of all events, and of kinds with one first letter, from one sketch per kind."""
    events = T(spark, d, "events")
    kinds = events.select("event_type").distinct()
    name = F.col("event_type")
    spans = kinds.select(F.explode(F.array(name, F.lit("all"), F.concat(F.lit("first "), F.substring(name, 1, 1)))).alias("span"), name)
    sketched = quality.distinct_over(quality.distinct_sketches(events, "event_type", "user_id"), spans, "event_type", "span")
    exact = events.join(F.broadcast(spans), "event_type").groupBy("span").agg(F.countDistinct("user_id").alias("n_exact"))
    return sketched.join(exact, "span").select("span", "n_rows", "n_exact", F.col("n_exact").between(F.col("n_low"), F.col("n_high")).alias("is_within"))


@query(
    "q_observed_checks",
    """SELECT count(*) AS n_rows, count(*) FILTER (o_orderkey IS NULL) AS null_keys, count(*) FILTER (o_totalprice < 20000) AS cheap,
         count(*) FILTER (o_orderstatus NOT IN ('O', 'F')) AS odd_status, count(*) AS n_written FROM orders""",
)
def q_observed_checks(spark, d):
    """Counts gathered while orders are exported, beside what is found in the export."""
    path = scratch_path(spark, "observed")
    checks = {
        "null_keys": F.col("o_orderkey").isNull(), "cheap": F.col("o_totalprice") < 20000,
        "odd_status": ~F.col("o_orderstatus").isin("O", "F"),
    }
    seen = quality.observed_write(T(spark, d, "orders"), checks, lambda df: df.write.partitionBy("o_orderpriority").parquet(path))
    written = spark.read.parquet(path).agg(F.count("*").alias("n_written"))
    return written.select(*[F.lit(seen[c]).cast("bigint").alias(c) for c in ("n_rows", *checks)], "n_written")


_JSON_TEXT = """'{"id":' || CAST(event_id AS VARCHAR) || ',"kind":"' || event_type || '","props":' || props || ',"tags":["a","' || event_type || '"]'
  || CASE WHEN event_id % 17 = 0 THEN '' ELSE '}' END"""


@query(
    "q_json_variant",
    f"""WITH j AS (SELECT event_id, {_JSON_TEXT} AS t FROM events)
       SELECT event_id, NOT json_valid(t) AS is_malformed,
         CASE WHEN json_valid(t) THEN CAST(json_extract_string(t, '$.props.k') AS INTEGER) END AS k,
         CASE WHEN json_valid(t) THEN json_extract_string(t, '$.kind') END AS kind,
         CASE WHEN json_valid(t) THEN json_extract_string(t, '$.tags[1]') END AS tag,
         CASE WHEN json_valid(t) THEN json_extract_string(t, '$.absent') END AS absent FROM j""",
)
def q_json_variant(spark, d):
    """Nested JSON texts, one in seventeen cut short, parsed once and read by four paths."""
    text = F.concat(
        F.lit('{"id":'), F.col("event_id").cast("string"), F.lit(',"kind":"'), "event_type", F.lit('","props":'), "props",
        F.lit(',"tags":["a","'), "event_type", F.lit('"]'), F.when(F.col("event_id") % 17 == 0, "").otherwise("}"),
    )
    rows = T(spark, d, "events").select("event_id", text.alias("text")).withColumn("value", documents.parsed(F.col("text")))
    value = F.col("value")
    return rows.select(
        "event_id", documents.is_malformed(F.col("text"), value).alias("is_malformed"),
        documents.at(value, "$.props.k", "int").alias("k"), documents.at(value, "$.kind", "string").alias("kind"),
        documents.at(value, "$.tags[1]", "string").alias("tag"), documents.at(value, "$.absent", "string").alias("absent"),
    )


# ---- approximate search and fitted models: what must hold ----

RECALL = 0.9


@query(
    "q_knn_recall",
    f"""SELECT m AS method, count(*) AS n_queries, true AS is_good FROM embeddings, (VALUES ('cells'), ('codes')) v(m)
        WHERE vec_id % 20 = 0 GROUP BY m""",
)
def q_knn_recall(spark, d):
    """Recall at ten of both approximate searches over every twentieth vector: is it RECALL or more?"""
    rows = I.vectors(T(spark, d, "embeddings"))
    asked = rows.where("vec_id % 20 = 0")
    exact = neighbours.nearest(asked, rows, 10).select("query_id", "neighbour_id")
    cells_at, codes_at = scratch_path(spark, "cells"), scratch_path(spark, "codes")
    centres = neighbours.write_cells(rows, cells_at, 8)
    probes, _ = neighbours.measured_probes(asked, rows, cells_at, centres, 10)
    index = codes.write_index(rows, codes_at, 8)
    found = neighbours.nearest_in_cells(asked, cells_at, centres, 10, probes).withColumn("method", F.lit("cells")).unionByName(
        codes.search(asked, index, 10, "vec_id").withColumn("method", F.lit("codes"))
    )
    hit = exact.withColumn("hit", F.lit(1))
    judged = found.select("method", "query_id", "neighbour_id").join(hit, ["query_id", "neighbour_id"], "left").groupBy("method")
    seen = judged.agg(F.countDistinct("query_id").alias("n_queries"), F.count("hit").alias("hits"))
    return seen.select("method", "n_queries", (F.col("hits") >= RECALL * 10 * F.col("n_queries")).alias("is_good"))


@query("q_knn_codes")
def q_knn_codes(spark, d):
    """About the ten nearest of every twentieth vector, by codes."""
    rows = I.vectors(T(spark, d, "embeddings"))
    index = codes.write_index(rows, scratch_path(spark, "codes"), 8)
    found = codes.search(rows.where("vec_id % 20 = 0"), index, 10, "vec_id")
    return found.select("query_id", "rank", "neighbour_id", F.round("score", 6).alias("score"))


_ALL_COSINE = _sql_top(_ALL_QUERIES, _COS, 5, skip="q.query_id <> c.vec_id")


@query("q_knn_all_pruned", _ALL_COSINE)
def q_knn_all_pruned(spark, d):
    """The five nearest of every vector, by slices that bounds do not rule out."""
    rows = I.vectors(T(spark, d, "embeddings"))
    return _ranked(pruned.nearest_pruned(rows, rows, 5, slice_rows=64)[0])


@query("q_pca_axes", "SELECT count(*) AS n_rows, true AS is_ordered, true AS is_orthogonal FROM embeddings")
def q_pca_axes(spark, d):
    """Projected points: more variance along the first axis than the second, and no covariance."""
    points = topics.project_2d(I.vectors(T(spark, d, "embeddings")))
    return points.agg(
        F.count("*").alias("n_rows"), (F.var_pop("x") >= F.var_pop("y")).alias("is_ordered"),
        (F.abs(F.covar_pop("x", "y")) <= 1e-9 * F.var_pop("x")).alias("is_orthogonal"),
    )


@query(
    "q_topic_nesting",
    "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_split_finest, CAST(0 AS BIGINT) AS n_split_finer FROM embeddings",
)
def q_topic_nesting(spark, d):
    """Every finer topic lies in one coarser topic: how many do not."""
    rows = topics.nested_topics(I.vectors(T(spark, d, "embeddings")))
    own = lambda n: F.element_at(F.split(f"topic_depth_{n}", "-"), -1).alias(f"t{n}")
    parts = rows.groupBy(own(3), own(2), own(1)).agg(F.count("*").alias("n"))
    finest = parts.groupBy("t3").agg(F.countDistinct("t2").alias("up"), F.sum("n").alias("n")).select(F.lit(3).alias("level"), "up", "n")
    finer = parts.groupBy("t2").agg(F.countDistinct("t1").alias("up")).select(F.lit(2).alias("level"), "up", F.lit(0).cast("long").alias("n"))
    split = lambda level: F.count_if((F.col("level") == level) & (F.col("up") > 1))
    return finest.union(finer).agg(F.sum("n").alias("n_rows"), split(3).alias("n_split_finest"), split(2).alias("n_split_finer"))
