"""Queries over scans, sinks, keys, joins, numbering and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from lawloom.constants import BILL_TYPE_WORDS, PARTY_NAMES
from lawloom.functions import fields as P, keys as K
from lawloom.operators import enrich, numbering, quality, splits, unify, upsert
from lawloom.operators.chunking import index_chunks, skipped_count
from lawloom.plans import inputs as I
from lawloom.plans.registry import query
from lawloom.session import scratch_path
from lawloom.sources import members, sinks, tables
from lawloom.sources.xmltree import join_sidecar, unmatched_names
from lawloom.streaming import ingest

T = I.table


def _stamp(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S')"


def _spark_stamp(col: str):
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


# ---- scans ----

@query(
    "q_sidecar_join",
    """SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN NULL
         ELSE '2024-01-0' || CAST(1 + l.quality AS VARCHAR) || ' 0' || CAST(l.toxic AS VARCHAR) || ':30:00' END AS lastmod,
         l.doc_id IS NULL AS is_missing
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def q_sidecar_join(spark, d):
    files = T(spark, d, "documents").select("doc_id", F.col("doc_id").cast("string").alias("stem"))
    stamp = F.concat(
        F.lit(" 2024-01-0"), (F.col("quality") + 1).cast("string"), F.lit("T0"), F.col("toxic").cast("string"), F.lit(":30:00Z\n")
    )
    side = T(spark, d, "labels").select(F.col("doc_id").cast("string").alias("stem"), stamp.alias("stamp_text"))
    joined = join_sidecar(files, side, ["stem"])
    return joined.select("doc_id", _spark_stamp("lastmod").alias("lastmod"), F.col("lastmod").isNull().alias("is_missing"))


@query("q_scan_parquet", "SELECT p_partkey, p_brand, p_size FROM part")
def q_scan_parquet(spark, d):
    return tables.read_stage(spark, f"{d}/part.parquet", ["p_partkey", "p_brand", "p_size"])


@query(
    "q_multi_split_scan",
    "SELECT doc_id, lang, n_chars FROM documents WHERE lang IN ('en', 'fr')",
)
def q_multi_split_scan(spark, d):
    return tables.select_splits(T(spark, d, "documents"), ["en", "fr"], "lang").select("doc_id", "lang", "n_chars")


@query(
    "q_filtered_table_scan",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_linestatus = 'F'
       ORDER BY l_orderkey, l_linenumber, l_partkey""",
)
def q_filtered_table_scan(spark, d):
    rows = T(spark, d, "lineitem").where(F.col("l_linestatus") == "F")
    rows = rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return tables.filtered(rows, None, ["l_orderkey", "l_linenumber", "l_partkey"])


@query("q_point_lookup", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey = 42")
def q_point_lookup(spark, d):
    return tables.point_lookup(T(spark, d, "orders"), "o_orderkey", 42).select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "q_page_rows",
    "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 10 OFFSET 1000",
)
def q_page_rows(spark, d):
    return tables.page_rows(T(spark, d, "orders"), ["o_orderkey"], 1000, 10).select("o_orderkey", "o_custkey")


@query(
    "q_page_rows_deep",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
       ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice LIMIT 100 OFFSET 30000""",
)
def q_page_rows_deep(spark, d):
    names = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    rows = T(spark, d, "lineitem").select(*names, "l_extendedprice")
    return tables.page_rows(rows, [*names, "l_extendedprice"], 30000, 100).select(*names)


@query("q_list_splits", "SELECT DISTINCT event_type FROM events ORDER BY event_type")
def q_list_splits(spark, d):
    return tables.list_splits(T(spark, d, "events"), "event_type")


@query("q_head_n", "SELECT event_id, user_id, event_type FROM events ORDER BY ts, event_id LIMIT 50")
def q_head_n(spark, d):
    return tables.head_rows(T(spark, d, "events"), ["ts", "event_id"], 50).select("event_id", "user_id", "event_type")


# ---- sinks and upserts ----

_LINE_RANK = ["l_shipdate", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
_LINE_COLUMNS = ["l_orderkey", *_LINE_RANK, "l_quantity"]
_LINE_OUT = f"l_orderkey, {_stamp('l_shipdate')} AS l_shipdate, l_partkey, l_suppkey, l_linenumber, l_quantity"
_LATEST_LINE = f"""SELECT {_LINE_OUT} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY
    l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_linenumber DESC, l_extendedprice DESC) AS rn
  FROM lineitem) WHERE rn = 1"""


def _line_out(df):
    return df.select(
        "l_orderkey", _spark_stamp("l_shipdate").alias("l_shipdate"), "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"
    )


@query("q_upsert_latest", _LATEST_LINE)
def q_upsert_latest(spark, d):
    rows = T(spark, d, "lineitem").select("l_linestatus", *_LINE_COLUMNS)
    stored = upsert.latest_rows(rows.where(F.col("l_linestatus") == "O").drop("l_linestatus"), ["l_orderkey"], _LINE_RANK)
    incoming = rows.where(F.col("l_linestatus") != "O").drop("l_linestatus")
    return _line_out(upsert.merge_latest(stored, incoming, ["l_orderkey"], _LINE_RANK))


@query(
    "q_upsert_keep_cols",
    f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linestatus = 'O' ORDER BY
          l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_linenumber DESC, l_extendedprice DESC) AS rn FROM lineitem),
        o AS (SELECT * FROM r WHERE rn = 1 AND l_linestatus = 'O'),
        n AS (SELECT * FROM r WHERE rn = 1 AND l_linestatus <> 'O'),
        w AS (SELECT n.*, o.l_orderkey IS NOT NULL AS hit, o.l_quantity AS old_quantity FROM n LEFT JOIN o USING (l_orderkey)
              WHERE o.l_orderkey IS NULL OR (n.l_shipdate, n.l_partkey, n.l_suppkey, n.l_linenumber, n.l_extendedprice)
                 >= (o.l_shipdate, o.l_partkey, o.l_suppkey, o.l_linenumber, o.l_extendedprice))
        SELECT l_orderkey, {_stamp('l_shipdate')} AS l_shipdate, l_partkey, l_suppkey, l_linenumber,
          CASE WHEN hit THEN old_quantity ELSE l_quantity END AS l_quantity FROM w
        UNION ALL
        SELECT {_LINE_OUT} FROM o WHERE l_orderkey NOT IN (SELECT l_orderkey FROM w)""",
)
def q_upsert_keep_cols(spark, d):
    rows = T(spark, d, "lineitem").select("l_linestatus", *_LINE_COLUMNS)
    stored = upsert.latest_rows(rows.where(F.col("l_linestatus") == "O").drop("l_linestatus"), ["l_orderkey"], _LINE_RANK)
    incoming = rows.where(F.col("l_linestatus") != "O").drop("l_linestatus")
    return _line_out(upsert.merge_latest(stored, incoming, ["l_orderkey"], _LINE_RANK, keep=["l_quantity"]))


@query(
    "q_export_roundtrip",
    f"SELECT o_orderkey, o_custkey, {_stamp('o_orderdate')} AS o_orderdate, o_totalprice, o_orderpriority FROM orders",
)
def q_export_roundtrip(spark, d):
    path = scratch_path(spark, "export")
    sinks.export_by(T(spark, d, "orders"), path, ["o_orderkey"], split="o_orderpriority")
    return spark.read.parquet(path).select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority")


@query(
    "q_to_json_append",
    "SELECT c_custkey, c_name, c_nationkey AS nation, c_acctbal AS balance FROM customer "
    "UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier",
)
def q_to_json_append(spark, d):
    path = scratch_path(spark, "append")
    stage = f"stage-{path.rsplit('-', 1)[1]}"
    for name, p in (("customer", "c"), ("supplier", "s")):
        key = "c_custkey" if p == "c" else "s_suppkey"
        rows = T(spark, d, name).select(
            F.col(key).alias("c_custkey"),
            F.col(f"{p}_name").alias("c_name"),
            F.struct(F.col(f"{p}_nationkey").alias("nation"), F.col(f"{p}_acctbal").alias("balance")).alias("metadata"),
        )
        written = sinks.append_stage(rows, stage, ["metadata"], path=path)
    back = F.from_json("metadata", "nation int, balance double")
    return spark.table(written).withColumn("m", back).select("c_custkey", "c_name", "m.nation", "m.balance")


@query(
    "q_manifest",
    """SELECT event_type, count(*) AS n_rows, min(event_id) AS min_key, max(event_id) AS max_key,
         'data/events-' || event_type || '.parquet' AS path FROM events GROUP BY event_type""",
)
def q_manifest(spark, d):
    return sinks.manifest(T(spark, d, "events"), "event_type", "event_id", "data/events-%s.parquet")


@query("q_stream_upsert", _LATEST_LINE)
def q_stream_upsert(spark, d):
    schema = T(spark, d, "lineitem").schema
    path, state = scratch_path(spark, "ingest"), scratch_path(spark, "ingest-state")
    arrivals = ingest.file_arrivals(spark, d, schema, "lineitem.parquet").select(*_LINE_COLUMNS)
    ingest.start_ingest(arrivals, path, state, ["l_orderkey"], _LINE_RANK).awaitTermination()
    return _line_out(ingest.read_current(spark, path, arrivals.schema, ["l_orderkey"], _LINE_RANK))


# ---- keys ----

@query(
    "q_url_parse",
    r"""SELECT page_id, nullif(regexp_extract(url, '^https?://([^/]+)/([a-z]+)/(\d+)', 1), '') AS host,
          nullif(regexp_extract(url, '^https?://([^/]+)/([a-z]+)/(\d+)', 2), '') AS lang,
          try_cast(regexp_extract(url, '^https?://([^/]+)/([a-z]+)/(\d+)', 3) AS INTEGER) AS number FROM pages""",
)
def q_url_parse(spark, d):
    form = r"^https?://([^/]+)/([a-z]+)/(\d+)"

    def part(n):
        return F.nullif(F.regexp_extract("url", form, n), F.lit(""))

    return T(spark, d, "pages").select(
        "page_id", part(1).alias("host"), part(2).alias("lang"), part(3).try_cast("int").alias("number")
    )


def _file_name():
    kind = F.col("o_orderstatus")
    num = F.col("o_orderkey").cast("string")
    return (
        F.when(kind == "F", F.concat(F.lit("BILLS-113hr"), num, F.lit("ih.xml")))
        .when(kind == "O", F.concat(F.lit("PLAW-114publ"), num, F.lit(".xml")))
        .otherwise(F.concat(F.lit("NOTE-"), F.col("o_orderpriority"), F.lit(".xml")))
    )


@query(
    "q_file_names",
    """SELECT o_orderkey,
         CASE o_orderstatus WHEN 'F' THEN 'bills' WHEN 'O' THEN 'plaw' END AS legis_class,
         CAST(CASE o_orderstatus WHEN 'F' THEN 113 WHEN 'O' THEN 114 END AS INTEGER) AS congress_num,
         CASE o_orderstatus WHEN 'F' THEN 'hr' WHEN 'O' THEN 'publ' END AS legis_type,
         CAST(CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderkey END AS INTEGER) AS legis_num,
         CASE o_orderstatus WHEN 'F' THEN 'ih' WHEN 'O' THEN 'plaw' END AS legis_version FROM orders""",
)
def q_file_names(spark, d):
    rows = T(spark, d, "orders").select("o_orderkey", K.text_name_parts(_file_name()).alias("p"))
    return rows.select("o_orderkey", "p.legis_class", "p.congress_num", "p.legis_type", "p.legis_num", "p.legis_version")


@query(
    "q_status_paths",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN '113-hr-' || CAST(o_orderkey AS VARCHAR) END AS legis_id FROM orders""",
)
def q_status_paths(spark, d):
    num = F.col("o_orderkey").cast("string")
    base = F.concat(F.lit("data/113/bills/hr/hr"), num)
    path = F.when(F.col("o_orderstatus") != "P", F.concat(base, F.lit("/fdsys_billstatus.xml"))).otherwise(base)
    rows = T(spark, d, "orders").select("o_orderkey", K.status_path_parts(path).alias("p"))
    return rows.select("o_orderkey", K.dashed(F.col("p.congress_num"), F.col("p.legis_type"), F.col("p.legis_num")).alias("legis_id"))


@query(
    "q_unmatched_counts",
    """SELECT 'NOTE-' || o_orderpriority || '.xml' AS file_name, count(*) AS n FROM orders
       WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 1""",
)
def q_unmatched_counts(spark, d):
    named = T(spark, d, "orders").select(_file_name().alias("file_name"))
    return unmatched_names(named.withColumn("part", K.text_name_parts(F.col("file_name"))))


@query(
    "q_classify_contains",
    "SELECT page_id, CASE WHEN contains(url, '/en/') THEN 'uslm' ELSE 'dtd' END AS xml_type FROM pages",
)
def q_classify_contains(spark, d):
    return T(spark, d, "pages").select("page_id", K.markup_kind(F.col("url"), "/en/").alias("xml_type"))


@query(
    "q_composite_key",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderkey AS VARCHAR) || '-' || o_orderstatus
         || '-' || CAST(year(o_orderdate) AS VARCHAR) END AS legis_id FROM orders""",
)
def q_composite_key(spark, d):
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return T(spark, d, "orders").select(
        "o_orderkey", K.dashed(F.col("o_orderkey"), status, F.year("o_orderdate")).alias("legis_id")
    )


@query(
    "q_url_last_segment",
    "SELECT page_id, split_part(url, '/', -1) AS last, split_part(split_part(url, '/', -1), '.', 1) AS stem FROM pages",
)
def q_url_last_segment(spark, d):
    last = K.last_segment(F.col("url"))
    return T(spark, d, "pages").select("page_id", last.alias("last"), K.stem(last).alias("stem"))


# ---- unified build ----

_MATCHED = """
  listed AS (SELECT 'o-' || CAST(o_orderkey AS VARCHAR) AS bill, n, o_orderdate,
      'https://example.org/' || CAST(o_orderkey AS VARCHAR) || '/' || 'O-' || CAST(o_orderkey AS VARCHAR) || '-' || CAST(n AS VARCHAR) || '.xml' AS url
    FROM orders, unnest(range(1, 8)) AS u(n) WHERE n <> 6),
  tv AS (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR)
      || '-' || CAST(l_suppkey AS VARCHAR) || '-' || CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) AS tv_id,
      CASE WHEN l_returnflag = 'R' THEN 'p-' ELSE 'o-' END || CAST(l_orderkey AS VARCHAR) AS legis_id,
      'O-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '.xml' AS file_name,
      l_shipdate AS lastmod,
      CASE WHEN l_returnflag = 'N' THEN '' ELSE 'part ' || CAST(l_partkey AS VARCHAR) || ' of ' || CAST(l_suppkey AS VARCHAR) END AS txt
    FROM lineitem WHERE l_linestatus <> 'O'),
  placed AS (SELECT tv.*, url, n, o_orderdate,
      row_number() OVER (PARTITION BY legis_id ORDER BY lastmod DESC, tv_id, url) - 1 AS pos,
      count(*) OVER (PARTITION BY legis_id) AS n_versions
    FROM tv JOIN listed ON tv.file_name = split_part(listed.url, '/', -1)
    WHERE legis_id IN (SELECT bill FROM listed))"""


def _unified_rows(unified):
    rows = unified.select("legis_id", "congress_num", F.posexplode("tvs").alias("i", "tv"))
    return rows.select(
        "legis_id",
        "congress_num",
        F.col("i").cast("bigint").alias("pos"),
        F.col("tv.tv_id").alias("tv_id"),
        _spark_stamp("tv.lastmod").alias("lastmod"),
        F.col("tv.bs_tv.url").alias("url"),
        F.col("tv.bs_tv.type").alias("type"),
        *([F.col("tv.tv_txt").alias("tv_txt")] if "tv_txt" in unified.schema["tvs"].dataType.elementType.names else []),
    )


@query(
    "q_unified",
    f"""WITH {_MATCHED} SELECT legis_id, CAST(year(o_orderdate) AS INTEGER) AS congress_num, pos, tv_id,
          {_stamp('lastmod')} AS lastmod, url, 'v' || CAST(n AS VARCHAR) AS type FROM placed""",
)
def q_unified(spark, d):
    bills, texts = I.order_bills(I.spread(spark, d, "orders")), I.lineitem_texts(I.spread(spark, d, "lineitem"))
    return _unified_rows(unify.unify(bills, texts, "text_versions"))


@query(
    "q_unified_with_text",
    f"""WITH {_MATCHED} SELECT legis_id, CAST(year(o_orderdate) AS INTEGER) AS congress_num, pos, tv_id,
          {_stamp('lastmod')} AS lastmod, url, 'v' || CAST(n AS VARCHAR) AS type, txt AS tv_txt FROM placed""",
)
def q_unified_with_text(spark, d):
    bills, texts = I.order_bills(I.spread(spark, d, "orders")), I.lineitem_texts(I.spread(spark, d, "lineitem"))
    unified = unify.unify(bills, texts, "text_versions", text_columns=("tv_txt",))
    return _unified_rows(unified).withColumn("tv_txt", F.trim(F.replace("tv_txt", F.lit("\n"), F.lit(" "))))


@query(
    "q_explode_array",
    "SELECT doc_id AS legis_id, unnest(string_split(text, chr(10))) AS line FROM documents",
)
def q_explode_array(spark, d):
    docs = T(spark, d, "documents").withColumnRenamed("doc_id", "legis_id")
    return unify.explode_versions(docs, F.split("text", "\n")).select(
        F.col("listed_id").alias("legis_id"), F.col("bs_tv").alias("line")
    )


@query(
    "q_latest_text",
    f"""WITH {_MATCHED} SELECT legis_id, url, txt AS text FROM placed WHERE pos = 0 AND txt <> ''""",
)
def q_latest_text(spark, d):
    bills, texts = I.order_bills(I.spread(spark, d, "orders")), I.lineitem_texts(I.spread(spark, d, "lineitem"))
    newest = unify.newest_version(bills, texts, "text_versions").withColumn("tvs", F.array("tv"))
    return splits.drop_empty_text(splits.text_rows(newest)).select("legis_id", "url", "text")


@query(
    "q_splits",
    """WITH b AS (SELECT 'o-' || CAST(o_orderkey AS VARCHAR) AS legis_id, year(o_orderdate) AS y, o_orderpriority, o_orderkey, o_orderstatus FROM orders),
       m AS (SELECT max(y) AS held FROM b),
       r AS (SELECT b.*, held, row_number() OVER (PARTITION BY y ORDER BY o_orderpriority, o_orderkey, legis_id) - 1 AS rn FROM b, m)
       SELECT legis_id, CASE WHEN y < held THEN 'train' WHEN rn % 2 = 0 THEN 'validation' ELSE 'test' END AS split
       FROM r WHERE o_orderstatus <> 'P'""",
)
def q_splits(spark, d):
    orders = T(spark, d, "orders")
    years = [r[0] for r in tables.list_splits(orders.select(F.year("o_orderdate").alias("y")), "y").collect()]
    bills = orders.select(
        K.dashed(F.lit("o"), F.col("o_orderkey")).alias("legis_id"),
        F.year("o_orderdate").alias("congress_num"),
        F.col("o_orderpriority").alias("legis_type"),
        F.col("o_orderkey").alias("legis_num"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus")).alias("text"),
    )
    cut = splits.assign_splits(bills, train=years[:-1], held_out=years[-1])
    return splits.drop_empty_text(cut).select("legis_id", "split")


# ---- joins ----

@query(
    "q_vec_meta_join",
    """SELECT e.vec_id AS legis_id, e.label, d.source, d.lang, d.n_chars FROM embeddings e JOIN documents d ON e.vec_id = d.doc_id""",
)
def q_vec_meta_join(spark, d):
    chunks = T(spark, d, "embeddings").select(F.col("vec_id").alias("legis_id"), "label")
    bills = T(spark, d, "documents").withColumnRenamed("doc_id", "legis_id")
    return enrich.join_bills(chunks, bills, ["source", "lang", "n_chars"])


@query(
    "q_topic_merge",
    """SELECT CAST(label AS VARCHAR) || '-' || CAST(vec_id AS VARCHAR) AS chunk_id, CAST(label AS VARCHAR) AS congress_num,
         'a' || CAST(label AS VARCHAR) AS topic_depth_1, 'b' || CAST(vec_id AS VARCHAR) AS topic_depth_2, 'c' AS topic_depth_3,
         round(CAST(embedding[1] AS DOUBLE), 6) AS proj_x, round(CAST(embedding[2] AS DOUBLE), 6) AS proj_y,
         CAST(len(embedding) AS INTEGER) AS dim, d.n_chars
       FROM embeddings JOIN documents d ON d.doc_id = vec_id""",
)
def q_topic_merge(spark, d):
    vecs = T(spark, d, "embeddings").withColumn("chunk_id", K.dashed(F.col("label"), F.col("vec_id")))
    points = vecs.select("chunk_id", F.col("embedding")[0].alias("x"), F.col("embedding")[1].alias("y"), F.col("embedding").alias("vec"))
    topics = vecs.select(
        "chunk_id",
        F.concat(F.lit("a"), F.col("label").cast("string")).alias("topic_depth_1"),
        F.concat(F.lit("b"), F.col("vec_id").cast("string")).alias("topic_depth_2"),
        F.lit("c").alias("topic_depth_3"),
    )
    docs = T(spark, d, "documents")
    chunks = vecs.select("chunk_id", F.col("vec_id").alias("legis_id")).join(
        docs.select(F.col("doc_id").alias("legis_id"), "text", F.struct("n_chars").alias("metadata")), "legis_id"
    )
    empty = F.array().cast("array<string>")
    bills = docs.select(
        F.col("doc_id").alias("legis_id"),
        F.struct(
            F.col("source").alias("introduced_date"), F.lit("House").alias("origin_chamber"), F.col("lang").alias("policy_area"),
            empty.alias("subjects"), empty.alias("sponsors"),
        ).alias("bs"),
    )
    rows = enrich.topic_export(enrich.merge_topics(points, topics), chunks, bills)
    return rows.select(
        "chunk_id", "congress_num", "topic_depth_1", "topic_depth_2", "topic_depth_3",
        F.round(F.col("proj_x").cast("double"), 6).alias("proj_x"), F.round(F.col("proj_y").cast("double"), 6).alias("proj_y"),
        F.size("vec").alias("dim"), F.col("chunk_metadata.n_chars").alias("n_chars"),
    )


_SEGMENT_SQL = "list_extract(['BUILDING', 'MACHINERY', 'HOUSEHOLD', 'NONE'], CAST(1 + s_suppkey % 4 AS BIGINT))"


@query(
    "q_member_left_join",
    f"""WITH m AS (SELECT c_nationkey, c_mktsegment, c_acctbal, row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey) AS rn FROM customer)
        SELECT s_suppkey, {_SEGMENT_SQL} AS segment, c_acctbal AS score FROM supplier
        LEFT JOIN m ON rn = 1 AND c_nationkey = s_nationkey AND c_mktsegment = {_SEGMENT_SQL}""",
)
def q_member_left_join(spark, d):
    return _with_members(spark, d).select("s_suppkey", F.col("bioguide_id").alias("segment"), F.col("c_acctbal").alias("score"))


def _suppliers(spark, d):
    segment = F.element_at(F.array(*[F.lit(x) for x in ("BUILDING", "MACHINERY", "HOUSEHOLD", "NONE")]), (F.col("s_suppkey") % 4 + 1).cast("int"))
    return T(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("congress"), segment.alias("bioguide_id"))


def _with_members(spark, d):
    people = T(spark, d, "customer").select(
        F.col("c_nationkey").alias("congress"), F.col("c_mktsegment").alias("bioguide_id"), F.col("c_custkey").alias("icpsr"), "c_acctbal"
    )
    return enrich.attach_members(_suppliers(spark, d), people, scores=["c_acctbal"])


@query(
    "q_join_preserves_rows",
    "SELECT count(*) AS n_before, count(*) AS n_after, true AS is_kept FROM supplier",
)
def q_join_preserves_rows(spark, d):
    return quality.join_report(_suppliers(spark, d), _with_members(spark, d))


@query(
    "q_code_lookup",
    """SELECT c_custkey, n_name FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) n ON c_nationkey = n_nationkey""",
)
def q_code_lookup(spark, d):
    codes = T(spark, d, "nation").where(F.col("n_regionkey") != 2).select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return enrich.code_lookup(T(spark, d, "customer"), codes, "c_nationkey").select("c_custkey", "n_name")


_PARTIES_SQL = ", ".join(f"({c}, '{n}')" for c, n in PARTY_NAMES.items())


@query(
    "q_party_lookup",
    f"SELECT p_partkey, n AS party_name FROM part LEFT JOIN (VALUES {_PARTIES_SQL}) v(c, n) ON p_partkey = c",
)
def q_party_lookup(spark, d):
    return T(spark, d, "part").select("p_partkey", P.lookup(F.col("p_partkey").cast("int"), PARTY_NAMES).alias("party_name"))


# ---- counts and checks ----

@query(
    "q_key_uniqueness",
    """SELECT 'orders' AS name, count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys, count(*) = count(DISTINCT o_orderkey) AS is_unique FROM orders
       UNION ALL SELECT 'lineitem', count(*), count(DISTINCT (l_orderkey, l_linenumber)), count(*) = count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem""",
)
def q_key_uniqueness(spark, d):
    def report(name, *keys):
        return quality.key_report(T(spark, d, name), keys).select(F.lit(name).alias("name"), "*")

    return report("orders", "o_orderkey").unionByName(report("lineitem", "l_orderkey", "l_linenumber"))


@query("q_rows_per_split", "SELECT event_type, count(*) AS n_rows FROM events GROUP BY event_type")
def q_rows_per_split(spark, d):
    return quality.rows_per(T(spark, d, "events"), "event_type")


_NO_LONG_LINE = "len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> ''))"


@query("q_skipped_count", f"SELECT count(*) FILTER (WHERE {_NO_LONG_LINE} = 0) AS n_skipped FROM conversations")
def q_skipped_count(spark, d):
    return skipped_count(I.turn_bills(T(spark, d, "conversations")))


@query(
    "q_filter_nullsafe",
    """SELECT c_custkey FROM (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS chamber, nullif(c_nationkey, 3) AS s1, nullif(c_nationkey, 4) AS s2 FROM customer)
       WHERE chamber IS DISTINCT FROM 'MACHINERY' AND s1 IS NOT NULL AND s2 IS NOT NULL""",
)
def q_filter_nullsafe(spark, d):
    rows = T(spark, d, "customer").select(
        "c_custkey",
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("chamber"),
        F.nullif(F.col("c_nationkey"), F.lit(3)).alias("s1"),
        F.nullif(F.col("c_nationkey"), F.lit(4)).alias("s2"),
    )
    return members.filter_members(rows, president="MACHINERY", required=["s1", "s2"]).select("c_custkey")


# ---- numbering ----

@query(
    "q_chunk_index",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, chunk_index,
         CAST(l_orderkey AS VARCHAR) || '-' || CAST(chunk_index AS VARCHAR) AS chunk_id FROM (
         SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS chunk_index FROM lineitem)""",
)
def q_chunk_index(spark, d):
    rows = T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return index_chunks(rows, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]).drop("l_extendedprice")


@query(
    "q_batch_ids",
    "SELECT o_orderkey, CAST((row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 1000 AS BIGINT) AS batch_id FROM orders",
)
def q_batch_ids(spark, d):
    rows = T(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return numbering.batch_ids(rows, [F.col("o_orderdate"), F.col("o_orderkey")], 1000).drop("o_orderdate")


@query(
    "q_dedupe_first",
    "SELECT c_nationkey, arg_min(c_custkey, c_custkey) AS c_custkey, arg_min(c_name, c_custkey) AS c_name FROM customer GROUP BY c_nationkey",
)
def q_dedupe_first(spark, d):
    rows = T(spark, d, "customer").select("c_nationkey", "c_custkey", "c_name")
    return upsert.latest_rows(rows, ["c_nationkey"], ["c_custkey"], newest=False)


@query(
    "q_union_splits",
    """SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation FROM customer
       UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier""",
)
def q_union_splits(spark, d):
    one = T(spark, d, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_nationkey AS nation")
    two = T(spark, d, "supplier").selectExpr("s_nationkey AS nation", "s_name AS name", "s_suppkey AS id")
    return tables.union_splits([one, two])


# ---- projections ----

@query(
    "q_url_build_parse",
    """SELECT c_custkey, 'https://bioguide.congress.gov/search/bio/' || c_name AS url, c_name AS member_id FROM customer""",
)
def q_url_build_parse(spark, d):
    url = P.member_url(F.col("c_name"))
    return T(spark, d, "customer").select("c_custkey", url.alias("url"), P.member_id_of_url(url).alias("member_id"))


_TYPES = [*BILL_TYPE_WORDS, "none"]
_TYPE_CASE = "CASE t " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in BILL_TYPE_WORDS.items()) + " END"


@query(
    "q_bill_url",
    f"""SELECT o_orderkey, 'https://www.congress.gov/bill/' || CAST(year(o_orderdate) AS VARCHAR) || 'th-congress/' || {_TYPE_CASE}
          || '/' || CAST(o_orderkey AS VARCHAR) AS url
        FROM (SELECT *, list_extract({_TYPES}, CAST(1 + o_orderkey % {len(_TYPES)} AS BIGINT)) AS t FROM orders)""",
)
def q_bill_url(spark, d):
    kind = F.element_at(F.array(*[F.lit(x) for x in _TYPES]), (F.col("o_orderkey") % len(_TYPES) + 1).cast("int"))
    return T(spark, d, "orders").select("o_orderkey", P.bill_url(F.year("o_orderdate"), kind, F.col("o_orderkey")).alias("url"))


@query(
    "q_bracket_parts",
    """SELECT c_custkey, CASE WHEN c_nationkey <> 9 THEN substr(c_mktsegment, 1, 1) END AS party,
         CASE WHEN c_nationkey <> 9 THEN CAST(c_nationkey AS VARCHAR) END AS state FROM customer""",
)
def q_bracket_parts(spark, d):
    tail = F.concat(F.lit(" ["), F.substring("c_mktsegment", 1, 1), F.lit("-"), F.col("c_nationkey").cast("string"), F.lit("-2]"))
    name = F.when(F.col("c_nationkey") != 9, F.concat(F.col("c_name"), tail)).otherwise(F.col("c_name"))
    return T(spark, d, "customer").select("c_custkey", P.bracket_part(name, 1).alias("party"), P.bracket_part(name, 2).alias("state"))


@query(
    "q_date_part",
    "SELECT event_id, CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d') END AS day FROM events",
)
def q_date_part(spark, d):
    iso = F.when(F.col("event_type") != "error", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return T(spark, d, "events").select("event_id", P.date_part(iso).alias("day"))


@query(
    "q_sorted_join",
    "SELECT doc_id, array_to_string(list_sort(string_split(text, ' ')), ' | ') AS subjects FROM documents",
)
def q_sorted_join(spark, d):
    return T(spark, d, "documents").select("doc_id", P.sorted_join(F.split("text", " ")).alias("subjects"))


@query(
    "q_first_element",
    """SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN 'M' || CAST(c_custkey AS VARCHAR) END AS sponsor,
         CASE WHEN c_acctbal >= 0 THEN c_name || ' [' || substr(c_mktsegment, 1, 1) || '-' || CAST(c_nationkey AS VARCHAR) || '-1]' ELSE '' END AS full_name
       FROM customer""",
)
def q_first_element(spark, d):
    bills = I.customer_bills(T(spark, d, "customer"))
    return bills.select(
        "c_custkey",
        P.first_field(F.col("bs.sponsors"), "bioguide_id").alias("sponsor"),
        P.first_field(F.col("bs.sponsors"), "full_name", "").alias("full_name"),
    )


@query(
    "q_pipe_flatten",
    """SELECT c_custkey, array_to_string(string_split(c_name, '0'), '|') AS ids,
         array_to_string(list_transform(string_split(c_name, '0'), lambda x: coalesce(nullif(x, ''), '')), '|') AS states FROM customer""",
)
def q_pipe_flatten(spark, d):
    bills = I.customer_bills(T(spark, d, "customer"))
    co = F.col("bs.cosponsors")
    return bills.select("c_custkey", P.piped(co, "bioguide_id").alias("ids"), P.piped(co, "state").alias("states"))


@query(
    "q_meta_flat",
    """SELECT c_custkey, 'chunk_id=' || CAST(c_custkey AS VARCHAR) || '-0;cosponsor_bioguide_ids=' || array_to_string(string_split(c_name, '0'), '|')
         || ';introduced_date=2024-01-01;policy_area=' || CASE WHEN c_nationkey <> 7 THEN c_mktsegment ELSE 'None' END
         || ';sponsor_party=' || CASE WHEN c_acctbal >= 0 THEN substr(c_mktsegment, 1, 1) ELSE 'None' END
         || ';sponsor_state=' || CASE WHEN c_acctbal >= 0 AND c_nationkey > 4 THEN CAST(c_nationkey AS VARCHAR) ELSE 'None' END
         || ';subjects=' || c_mktsegment || '|n' || CAST(c_nationkey AS VARCHAR) || ';title=over' AS record, 14 AS n_keys FROM customer""",
)
def q_meta_flat(spark, d):
    bills = I.customer_bills(T(spark, d, "customer"))
    chunk = [
        ("chunk_id", K.dashed(F.col("c_custkey"), F.lit("0"))),
        ("title", F.lit("over")),
        ("text_date", F.lit(None).cast("string")),
    ]
    shown = ("chunk_id", "cosponsor_bioguide_ids", "introduced_date", "policy_area", "sponsor_party", "sponsor_state", "subjects", "title")
    rows = bills.withColumn("m", enrich.flat_record(F.col("bs"), chunk))
    pairs = [F.concat(F.lit(f"{k}="), F.col("m")[k]) for k in shown]
    return rows.select("c_custkey", F.concat_ws(";", *pairs).alias("record"), F.size(F.map_keys("m")).alias("n_keys"))


@query(
    "q_meta_drop_nulls",
    """SELECT c_custkey, array_to_string(list_sort(list_filter(['text', 'cosponsor_bioguide_ids', 'introduced_date', 'title', 'subjects', 'chunk_id',
           CASE WHEN c_nationkey <> 7 THEN 'policy_area' END,
           CASE WHEN c_acctbal >= 0 THEN 'sponsor_bioguide_id' END, CASE WHEN c_acctbal >= 0 THEN 'sponsor_full_name' END,
           CASE WHEN c_acctbal >= 0 THEN 'sponsor_party' END, CASE WHEN c_acctbal >= 0 AND c_nationkey > 4 THEN 'sponsor_state' END],
         lambda x: x IS NOT NULL)), ',') AS names,
         c_mktsegment AS subject, c_name AS text FROM customer""",
)
def q_meta_drop_nulls(spark, d):
    bills = I.customer_bills(T(spark, d, "customer"))
    chunk = [("chunk_id", K.dashed(F.col("c_custkey"), F.lit("0"))), ("text_date", F.lit(None).cast("string"))]
    rows = bills.withColumn("j", enrich.nested_record(F.col("bs.title"), F.col("bs"), chunk))
    return rows.select(
        "c_custkey",
        F.array_join(F.array_sort(F.json_object_keys("j")), ",").alias("names"),
        F.get_json_object("j", "$.subjects[0]").alias("subject"),
        F.get_json_object("j", "$.text").alias("text"),
    )


@query(
    "q_keep_cols",
    """SELECT l_orderkey || '-0' AS chunk_id, CAST(l_orderkey AS VARCHAR) AS tv_id, CAST(c_custkey AS VARCHAR) AS legis_id,
         113 AS congress_num, 'hr' AS legis_type, CAST(c_custkey AS INTEGER) AS legis_num, c_name AS title, 't' AS text,
         'https://www.congress.gov/bill/113th-congress/house-bill/' || CAST(c_custkey AS VARCHAR) AS congress_gov_url,
         CASE WHEN c_acctbal >= 0 THEN c_name || ' [' || substr(c_mktsegment, 1, 1) || '-' || CAST(c_nationkey AS VARCHAR) || '-1]' ELSE '' END AS sponsor_name,
         CASE WHEN c_acctbal >= 0 THEN 'https://bioguide.congress.gov/search/bio/M' || CAST(c_custkey AS VARCHAR) END AS sponsor_url,
         '2024-01-01' AS introduced_date, '2024-02-03' AS update_date, 'House' AS origin_chamber,
         CASE WHEN c_acctbal >= 0 THEN substr(c_mktsegment, 1, 1) END AS sponsor_party,
         CASE WHEN c_acctbal >= 0 THEN CAST(c_nationkey AS VARCHAR) END AS sponsor_state,
         CASE WHEN c_nationkey <> 7 THEN c_mktsegment END AS policy_area,
         c_mktsegment || ' | n' || CAST(c_nationkey AS VARCHAR) AS subjects
       FROM (SELECT DISTINCT o_orderkey AS l_orderkey, o_custkey FROM orders) JOIN customer ON o_custkey = c_custkey""",
)
def q_keep_cols(spark, d):
    bills = I.customer_bills(T(spark, d, "customer")).select(
        F.col("c_custkey").cast("string").alias("legis_id"),
        F.lit(113).alias("congress_num"),
        F.lit("hr").alias("legis_type"),
        F.col("c_custkey").cast("int").alias("legis_num"),
        F.col("bs")
        .withField("origin_chamber", F.lit("House"))
        .withField("update_date", F.lit("2024-02-03 04:05:06").cast("timestamp"))
        .alias("bs"),
    )
    chunks = I.wide(spark, d, "orders").select(
        K.dashed(F.col("o_orderkey"), F.lit("0")).alias("chunk_id"),
        F.col("o_orderkey").cast("string").alias("tv_id"),
        F.col("o_custkey").cast("string").alias("legis_id"),
        F.lit("t").alias("text"),
    )
    return enrich.export_rows(chunks, bills)


@query(
    "q_row_id",
    """SELECT c_custkey, CAST(c_nationkey AS VARCHAR) || '-' || CASE WHEN c_mktsegment = 'BUILDING' THEN 'nan' ELSE c_name END || '-'
         || CAST(c_custkey AS VARCHAR) || '-' || CAST(c_nationkey AS VARCHAR) AS row_id FROM customer""",
)
def q_row_id(spark, d):
    name = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name"))
    return T(spark, d, "customer").select(
        "c_custkey", P.printed_key(F.col("c_nationkey"), name, F.col("c_custkey"), F.col("c_nationkey")).alias("row_id")
    )


@query(
    "q_struct_project",
    """SELECT c_custkey, c_name AS title, CASE WHEN c_nationkey <> 7 THEN c_mktsegment END AS policy_area,
         CAST(len(string_split(c_name, '0')) AS INTEGER) AS n_cosponsors FROM customer""",
)
def q_struct_project(spark, d):
    bills = I.customer_bills(T(spark, d, "customer"))
    return bills.select("c_custkey", "bs.title", "bs.policy_area", F.size("bs.cosponsors").alias("n_cosponsors"))


@query(
    "q_json_access",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         json_extract_string(props, '$.absent') AS absent, event_type AS made FROM events""",
)
def q_json_access(spark, d):
    made = F.to_json(F.struct(F.col("event_type").alias("type"), F.from_json("props", "k int").alias("props")))
    return T(spark, d, "events").select(
        "event_id",
        F.from_json("props", "k int")["k"].alias("k"),
        F.get_json_object("props", "$.absent").alias("absent"),
        F.get_json_object(made, "$.type").alias("made"),
    )


@query(
    "q_row_metadata",
    f"""SELECT legis_id, CASE WHEN n > 0 THEN legis_id || '-0' END AS tv_id, CASE WHEN n > 0 THEN 'M1' END AS sponsor,
          CASE WHEN n > 0 THEN '2024-01-01' END AS text_date, CASE WHEN n > 0 THEN role END AS legis_type
        FROM (SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS legis_id, role, {_NO_LONG_LINE} AS n FROM conversations)""",
)
def q_row_metadata(spark, d):
    bills = I.turn_bills(T(spark, d, "conversations"))
    bs = F.struct(
        F.lit("House").alias("origin_chamber"), F.lit("2024-01-02").alias("update_date"), F.lit("2024-01-01").alias("introduced_date"),
        F.array(F.struct(F.lit("M1").alias("bioguide_id"))).alias("sponsors"),
    )
    legis = [F.col(c) for c in ("legis_id", "congress_num", "legis_type", "legis_num")]
    rows = bills.withColumn("bs", bs).withColumn("m", enrich.row_metadata(F.col("bs"), F.col("tvs"), legis))
    return rows.select("legis_id", "m.tv_id", "m.sponsor", "m.text_date", F.col("m.legis_type").alias("legis_type"))
