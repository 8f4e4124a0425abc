"""Queries over markup, text, chunks and vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from lawloom.functions import keys as K, text as X, vectors as V
from lawloom.operators import chunking, context, decode, embed, neighbours, profile, topics
from lawloom.operators.enrich import join_rows
from lawloom.plans import inputs as I
from lawloom.plans.registry import query
from lawloom.session import scratch_path
from lawloom.sources.tables import select_splits

T = I.table

_SP = X.SPACES
_LINES = "list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')"


def _sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_SP}|{_SP}$', '', 'g')"


def _sql_text_of(x: str) -> str:
    flat = f"regexp_replace({x}, '(<!--.*?-->|<[^>]+>)+', ' ', 'gs')"
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "''"), ("amp", "&")):
        flat = f"replace({flat}, '&{name};', '{char}')"
    return _sql_strip(flat)


def _sql_element(x: str, tag: str) -> str:
    form = rf"(?s)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>"
    return f"CASE WHEN regexp_matches({x}, '{form}') THEN {_sql_text_of(f'''regexp_extract({x}, '{form}', 1)''')} END"


def _sql_singular(x: str) -> str:
    return f"trim(regexp_replace({x}, '{_SP}', ' ', 'g'))"


# ---- decode ----

@query(
    "q_xml_decode_nested",
    f"""SELECT doc_id, CAST(doc_id AS INTEGER) AS number, lang AS type, source AS title, pos, line,
          'https://example.org/' || CAST(doc_id AS VARCHAR) || '.xml' AS url, 0 AS n_violations
        FROM (SELECT doc_id, lang, source, unnest({_LINES}) AS line, unnest(range(0, len({_LINES}))) AS pos FROM documents)""",
)
def q_xml_decode_nested(spark, d):
    docs = decode.decode_status(I.status_documents(I.wide(spark, d, "documents")))
    rows = docs.select(
        "doc_id", "bs.number", "bs.type", "bs.title", F.posexplode("bs.actions").alias("pos", "action"),
        F.get("bs.text_versions", 0)["url"].alias("url"), F.size("violations").alias("n_violations"),
    )
    return rows.select(
        "doc_id", "number", "type", "title", F.col("pos").cast("bigint").alias("pos"), F.col("action.text").alias("line"),
        "url", "n_violations",
    )


#: What each nested record of `inputs.FULL_STATUS` decodes to, as JSON with the same marks.
_RECORDS = {
    "committees": '[{"system_code":"hs@K","name":"Committee @S","chamber":"House","type":"Standing","subcommittees":[{"system_code":"ss@K","name":"Sub @N",'
    '"activities":[{"name":"Referred","date":"2024-01-01T05:00:00.000Z"}]}],"activities":[{"name":"Markup","date":"2024-01-02T05:00:00.000Z"}]}]',
    "committee_reports": '[{"citation":"Report @K"}]',
    "related_bills": '[{"title":"Like @S","congress":117,"number":@K,"type":"S","latest_action":{"action_date":"2024-01-03","text":"Read @N","committees":[]},'
    '"relationship_details":[{"type":"Identical","identified_by":"CRS @N"}]}]',
    "actions": '[{"action_date":"2024-01-04","text":"Sent @K","type":"Floor","action_code":"A@N","source_system":{"name":"House @S","code":"9"},"committees":[]}]',
    "sponsors": '[{"bioguide_id":"M@K","full_name":"Rep. @S","first_name":"Ann","last_name":"@S","party":"D","state":"S@N",'
    '"identifiers":{"bioguide_id":"M@K","lis_id":"@N","gpo_id":"7"},"district":"@N","is_by_request":"N"}]',
    "cosponsors": '[{"bioguide_id":"C@K","full_name":"Rep. Co @S","first_name":"Co","last_name":"@S","party":"R","state":"T@N","middle_name":"Q",'
    '"sponsorship_date":"2024-01-05","is_original_cosponsor":true}]',
    "laws": '[{"type":"Public Law","number":"118-@K"}]',
    "notes": '[{"text":"Note @S","links":[{"name":"n@N","url":"https://example.org/@K"}]}]',
    "cbo_cost_estimates": '[{"pub_date":"2024-01-06T05:00:00.000Z","title":"Cost @S","url":"https://example.org/c/@K","description":"d@N"}]',
    "subjects": '["@S","n@N"]',
    "summaries": '[{"version_code":"00","action_date":"2024-01-07","action_desc":"As @S","update_date":"2024-01-08T05:00:00.000Z","text":"Sum @K"}]',
    "titles": '[{"title_type":"Short","title":"T @S","chamber_code":"H","chamber_name":"House"}]',
    "amendments": '[{"number":@K,"congress":118,"type":"HAMDT","description":"am @N","update_date":"2024-01-09T05:00:00.000Z","sponsors":[],'
    '"submitted_date":"2024-01-10T05:00:00.000Z","chamber":"House","amended_bill":{"congress":118,"type":"HR","origin_chamber":"House",'
    '"origin_chamber_code":"H","number":@K,"title":"@S"},"links":[{"name":"l@N","url":"https://example.org/a/@K"}],"actions":[{"action_date":"2024-01-11",'
    '"text":"Agreed @N","links":[],"recorded_votes":[{"roll_number":@N,"chamber":"House","congress":118,"date":"2024-01-12T05:00:00.000Z",'
    '"session_number":2,"url":"https://example.org/v/@K"}]}]}]',
    "dublin_core": '{"dc_format":"f","dc_language":"l@N","dc_rights":"r","dc_contributor":"c@K","dc_description":"d"}',
}


def _filled(record: str) -> str:
    return (
        f"replace(replace(replace('{record}', '@K', CAST(c_custkey AS VARCHAR)), '@S', c_mktsegment), '@N', CAST(c_nationkey AS VARCHAR))"
    )


@query(
    "q_status_records",
    "SELECT c_custkey, c_mktsegment AS policy_area, " + ", ".join(f"{_filled(r)} AS {n}" for n, r in _RECORDS.items()) + ", 0 AS n_violations FROM customer",
)
def q_status_records(spark, d):
    """Every kind of nested record, all of its values compared."""
    docs = decode.decode_status(I.full_status_documents(I.wide(spark, d, "customer")))
    return docs.select(
        "c_custkey", "bs.policy_area", *[F.to_json(f"bs.{n}").alias(n) for n in _RECORDS], F.size("violations").alias("n_violations")
    )


@query(
    "q_xml_quarantine",
    """SELECT doc_id, list_extract(['', 'malformed', 'number:differs', 'introduced_date:missing', 'congress:int'],
         CAST(1 + doc_id % 5 AS BIGINT)) AS violations, doc_id % 5 = 0 AS is_kept FROM documents""",
)
def q_xml_quarantine(spark, d):
    xml = F.col("bs_xml")
    kind = F.col("doc_id") % 5
    damaged = (
        F.when(kind == 1, F.substring(xml, F.lit(1), F.length(xml) - 20))
        .when(kind == 2, F.replace(xml, F.lit("</number>"), F.lit("</number><billNumber>-1</billNumber>")))
        .when(kind == 3, F.replace(xml, F.lit("<introducedDate>2024-01-01</introducedDate>"), F.lit("")))
        .when(kind == 4, F.replace(xml, F.lit("<congress>118</congress>"), F.lit("<congress>x</congress>")))
        .otherwise(xml)
    )
    docs = I.status_documents(I.wide(spark, d, "documents")).withColumn("bs_xml", damaged)
    good, bad = decode.split_quarantine(decode.decode_status(docs))
    kept = good.select("doc_id", F.lit("").alias("violations"), F.lit(True).alias("is_kept"))
    return kept.unionByName(bad.select("doc_id", F.array_join("violations", ",").alias("violations"), F.lit(False).alias("is_kept")))


@query(
    "q_legacy_number_coalesce",
    """SELECT o_orderkey, CASE WHEN a IS NOT NULL AND b IS NOT NULL AND a <> b THEN NULL ELSE coalesce(a, b) END AS number,
         coalesce(a <> b, false) AS differs FROM (
         SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'P') THEN o_orderkey END AS a,
           CASE WHEN o_orderstatus IN ('O', 'P') THEN o_orderkey + CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END END AS b FROM orders)""",
)
def q_legacy_number_coalesce(spark, d):
    rows = T(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus").isin("F", "P"), F.col("o_orderkey")).alias("a"),
        F.when(
            F.col("o_orderstatus").isin("O", "P"),
            F.col("o_orderkey") + F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0),
        ).alias("b"),
    )
    return rows.select(
        "o_orderkey", F.expr(decode.agreed("a", "b")).alias("number"), F.expr(decode.disagree("a", "b")).alias("differs")
    )


@query(
    "q_distinct_url_rule",
    """SELECT p_partkey, CASE WHEN a IS NULL OR b IS NULL OR a = b THEN coalesce(a, b) END AS url, coalesce(a <> b, false) AS several
       FROM (SELECT p_partkey, CASE WHEN p_size > 5 THEN p_type END AS a, CASE WHEN p_size < 25 THEN CASE WHEN p_size % 2 = 0 THEN p_type ELSE p_brand END END AS b FROM part)""",
)
def q_distinct_url_rule(spark, d):
    size = F.col("p_size")
    one = F.struct(F.when(size > 5, F.col("p_type")).alias("url"))
    two = F.struct(F.when(size < 25, F.when(size % 2 == 0, F.col("p_type")).otherwise(F.col("p_brand"))).alias("url"))
    rows = T(spark, d, "part").select("p_partkey", F.array(one, two, one).alias("formats"))
    return rows.select(
        "p_partkey",
        F.expr(decode.single_url("formats")).alias("url"),
        F.expr(decode.several_urls("formats")).alias("several"),
    )


@query(
    "q_resolution_attributes",
    """SELECT c_custkey, c_mktsegment AS key, CAST(c_nationkey AS INTEGER) AS stage_count, c_name AS official_title,
         CASE WHEN c_acctbal < 0 THEN 'attrs.star_print:missing' ELSE '' END AS violations FROM customer""",
)
def q_resolution_attributes(spark, d):
    star = F.when(F.col("c_acctbal") < 0, "").otherwise(' star-print="no"')
    xml = F.concat(
        F.lit('<resolution dms-id="A1" public-private="public" resolution-stage="in" resolution-type="r" key="'),
        F.col("c_mktsegment"), F.lit('" stage-count="'), F.col("c_nationkey").cast("string"), F.lit('"'), star,
        F.lit('><metadata><dublinCore xmlns:dc="http://purl.org/dc/elements/1.1/"><dc:title>t</dc:title><dc:publisher>p</dc:publisher>'
              "<dc:date>2024-01-01</dc:date><dc:format>f</dc:format><dc:language>EN</dc:language><dc:rights>r</dc:rights></dublinCore></metadata>"
              "<form><distribution-code>I</distribution-code><congress>118th</congress><session>1st</session><legis-num>1</legis-num>"
              "<current-chamber>H</current-chamber><legis-type>R</legis-type><official-title>"),
        F.col("c_name"), F.lit("</official-title></form><resolution-body/></resolution>"),
    )
    rows = decode.decode_resolution(T(spark, d, "customer").select("c_custkey", xml.alias("tv_xml")))
    r = F.col("resolution")
    return rows.select(
        "c_custkey", r["attrs"]["key"].alias("key"), r["attrs"]["stage_count"].alias("stage_count"),
        r["form"]["official_title"].alias("official_title"), F.array_join("violations", ",").alias("violations"),
    )


# ---- markup and text ----

@query(
    "q_root_tag_profile",
    "SELECT 'html' AS root_tag, false AS is_known, count(*) AS n FROM pages "
    "UNION ALL SELECT 'bill', true, count(*) FROM documents",
)
def q_root_tag_profile(spark, d):
    both = I.wide(spark, d, "pages").select(F.col("html").alias("xml")).unionAll(
        I.text_documents(I.wide(spark, d, "documents")).select("tv_xml")
    )
    tagged = both.select(K.root_tag(F.col("xml")).alias("root_tag"))
    counted = tagged.groupBy("root_tag").agg(F.count("*").alias("n"))
    return counted.select("root_tag", K.known_root(F.col("root_tag")).alias("is_known"), "n")


@query(
    "q_tag_counts",
    """SELECT unnest(['number', 'type', 'updateDate', 'originChamber', 'introducedDate', 'congress', 'title', 'actions', 'textVersions',
         'latestAction']) AS tag, count(*) AS n FROM documents GROUP BY 1""",
)
def q_tag_counts(spark, d):
    return profile.tag_counts(I.status_documents(I.wide(spark, d, "documents")), "bs_xml", "bill")


@query(
    "q_text_quarantine",
    """SELECT doc_id, CASE WHEN doc_id % 4 IN (1, 2, 3) THEN true ELSE false END AS is_malformed FROM documents""",
)
def q_text_quarantine(spark, d):
    xml, kind = F.col("tv_xml"), F.col("doc_id") % 4
    damaged = (
        F.when(kind == 1, F.substring(xml, F.lit(1), F.length(xml) - 12))
        .when(kind == 2, F.replace(xml, F.lit("</legis-body>"), F.lit("</legis-boody>")))
        .when(kind == 3, F.replace(xml, F.lit("</form>"), F.lit("")))
        .otherwise(xml)
    )
    docs = I.text_documents(I.wide(spark, d, "documents"))
    return docs.select("doc_id", X.is_malformed(damaged).alias("is_malformed"))


@query(
    "q_tag_shape_counts",
    """SELECT CASE WHEN lang = 'en' THEN 'metadata>' ELSE '' END || 'form>empty>legis-body' AS shape, count(*) AS n FROM documents GROUP BY 1""",
)
def q_tag_shape_counts(spark, d):
    return profile.tag_shapes(I.text_documents(I.wide(spark, d, "documents")), "tv_xml")


@query("q_singular_ws", f"SELECT doc_id, {_sql_singular('text')} AS text FROM documents")
def q_singular_ws(spark, d):
    return I.wide(spark, d, "documents").select("doc_id", X.singular_spaces(F.col("text")).alias("text"))


@query("q_text_all", f"SELECT page_id, {_sql_text_of('html')} AS text FROM pages")
def q_text_all(spark, d):
    return I.wide(spark, d, "pages").select("page_id", X.all_text(F.col("html")).alias("text"))


@query("q_text_element", f"SELECT page_id, {_sql_element('html', 'article')} AS text, {_sql_element('html', 'aside')} AS absent FROM pages")
def q_text_element(spark, d):
    html = F.col("html")
    return I.wide(spark, d, "pages").select(
        "page_id", X.element_text(html, "article").alias("text"), X.element_text(html, "aside").alias("absent")
    )


_PAGE_TAGS = ("footer", "aside", "title", "article")


@query(
    "q_text_sections",
    f"""SELECT page_id, array_to_string(list_filter([{', '.join(_sql_singular(_sql_element('html', t)) for t in _PAGE_TAGS)}], lambda x: x IS NOT NULL),
          chr(10) || chr(10)) AS text FROM pages""",
)
def q_text_sections(spark, d):
    return I.wide(spark, d, "pages").select("page_id", X.section_text(F.col("html"), _PAGE_TAGS).alias("text"))


@query(
    "q_text_root_children",
    f"""SELECT doc_id, '118 ' || source || CASE WHEN len({_LINES}) > 0 THEN chr(10) || chr(10) || trim(regexp_replace(
          replace(array_to_string({_LINES}, ' '), chr(160), ' '), ' {{2,}}', ' ', 'g')) ELSE '' END AS text, true AS is_balanced FROM documents""",
)
def q_text_root_children(spark, d):
    # Through one-element rows, so that text and balance come from one scan.
    docs = I.text_documents(I.wide(spark, d, "documents")).select("doc_id", F.inline(F.array(X.scanned(F.col("tv_xml")))))
    return docs.select("doc_id", X.text_of_children(F.col("children")).alias("text"), "is_balanced")


# ---- chunks ----

@query(
    "q_chunk_docs",
    """SELECT legis_id || '-0' AS tv_id, legis_id, congress_num, legis_type, legis_num, '2024-01-01' AS text_date, list_extract(ls, 1) AS text FROM (
         SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS legis_id, conv_id AS congress_num, role AS legis_type, turn AS legis_num,
           list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS ls FROM conversations) WHERE len(ls) > 0""",
)
def q_chunk_docs(spark, d):
    docs = chunking.chunk_documents(I.turn_bills(T(spark, d, "conversations")))
    return docs.select("tv_id", "legis_id", "congress_num", "legis_type", "legis_num", "text_date", "text")


@query(
    "q_chunk_fixed",
    f"""WITH s AS (SELECT doc_id, substr(text, CAST(i * 768 + 1 AS BIGINT), 1024) AS raw, i FROM documents,
          unnest(range(0, CASE WHEN length(text) <= 1024 THEN 1 ELSE 1 + CAST(ceil((length(text) - 1024) / 768.0) AS BIGINT) END)) AS u(i) WHERE length(text) > 0)
        SELECT doc_id, {_sql_strip('raw')} AS text,
          CAST(i * 768 + length(raw) - length(regexp_replace(raw, '^{_SP}', '')) AS INTEGER) AS start_index
        FROM s WHERE {_sql_strip('raw')} <> ''""",
)
def q_chunk_fixed(spark, d):
    rows = I.wide(spark, d, "documents").select("doc_id", F.explode(chunking.fixed_chunks(F.col("text"), 1024, 256)).alias("c"))
    return rows.select("doc_id", "c.text", "c.start_index")


def _sql_levels(size: int) -> str:
    """Pieces of each text: split at the first separator present, longer pieces by the later ones.

    A row is a piece; `path` orders pieces, `run` names the neighbours it may be packed with, and a
    piece with `short` false goes on to the next separator.
    """
    made = ["p0 AS (SELECT doc_id, text AS p, [0] AS path, [0] AS run, false AS short FROM documents WHERE text <> '')"]
    names = ("chr(10) || chr(10)", "';'", "chr(10)", "' '", None)
    for n, sep in enumerate(names):
        if sep is None:
            parts, head, has, cut = "string_split(p, '')", "part", "true", "true"
        else:
            parts = f"string_split(p, {sep})"
            head = f"CASE WHEN k > 1 THEN {sep} ELSE '' END || part"
            has, cut = f"contains(p, {sep})", f"length(q) < {size}"
        made.append(
            f"""c{n} AS (SELECT doc_id, q AS p, list_append(path, CAST(k AS INTEGER)) AS path, path AS parent, {cut} AS short, k FROM (
                  SELECT doc_id, path, k, {head} AS q FROM (SELECT doc_id, p, path, unnest({parts}) AS part, generate_subscripts({parts}, 1) AS k
                    FROM p{n} WHERE NOT short AND {has})) WHERE q <> '')"""
        )
        made.append(
            f"""p{n + 1} AS (SELECT * FROM p{n} WHERE short OR NOT {has}
                UNION ALL SELECT doc_id, p, path, list_append(parent, CAST(count(*) FILTER (WHERE NOT short) OVER (PARTITION BY doc_id, parent ORDER BY k) AS INTEGER)) AS run, short FROM c{n})"""
        )
    return ",\n".join(made)


def _sql_chunks(size: int, overlap: int) -> str:
    """Recursive splitting in plain SQL: one recursion step per packed chunk, then one per start."""
    return f"""WITH RECURSIVE {_sql_levels(size)},
      placed AS (SELECT doc_id, run, path, sum(length(p)) OVER (PARTITION BY doc_id ORDER BY path) AS hi, length(p) AS n FROM p5),
      runs AS (SELECT doc_id, run, list(CAST(hi - n AS BIGINT) ORDER BY path) AS los, list(CAST(hi AS BIGINT) ORDER BY path) AS his FROM placed GROUP BY doc_id, run),
      pack AS (
        SELECT doc_id, run, los, his, 1 AS f, 1 AS j, CAST(NULL AS BIGINT) AS lo, CAST(NULL AS BIGINT) AS hi, false AS done FROM runs
        UNION ALL
        SELECT doc_id, run, los, his,
          CASE WHEN e IS NULL THEN f ELSE list_filter(range(f, e + 1), lambda g: g = e OR (los[e] - los[g] <= {overlap} AND his[e] - los[g] <= {size}))[1] END,
          coalesce(e, j), los[f], coalesce(los[e], his[len(his)]), e IS NULL
        FROM (SELECT *, list_filter(range(j + 1, len(his) + 1), lambda i: his[i] - los[f] > {size})[1] AS e FROM pack WHERE NOT done)),
      cut AS (SELECT doc_id, lo, trimmed, row_number() OVER (PARTITION BY doc_id ORDER BY lo, hi) AS k FROM (
        SELECT pack.doc_id, lo, hi, {_sql_strip('substr(text, lo + 1, hi - lo)')} AS trimmed FROM pack JOIN documents USING (doc_id) WHERE lo IS NOT NULL) WHERE trimmed <> ''),
      found AS (
        SELECT doc_id, CAST(0 AS BIGINT) AS k, '' AS trimmed, CAST(-1 AS BIGINT) AS start_at FROM documents
        UNION ALL
        SELECT cut.doc_id, cut.k, cut.trimmed, found.start_at + strpos(substr(text, found.start_at + 2), cut.trimmed)
        FROM found JOIN cut ON cut.doc_id = found.doc_id AND cut.k = found.k + 1 JOIN documents d ON d.doc_id = cut.doc_id)
      SELECT doc_id, CAST(k - 1 AS INTEGER) AS chunk_index, CAST(doc_id AS VARCHAR) || '-' || CAST(k - 1 AS VARCHAR) AS chunk_id,
        trimmed AS text, CAST(start_at AS INTEGER) AS start_index FROM found WHERE k > 0"""


def _recursive(spark, d, size, overlap):
    docs = I.wide(spark, d, "documents").select("doc_id", "text")
    return chunking.explode_chunks(docs, chunking.recursive_chunks(F.col("text"), size, overlap), key="doc_id")


@query("q_chunk_recursive", _sql_chunks(1024, 256))
def q_chunk_recursive(spark, d):
    return _recursive(spark, d, 1024, 256)


@query("q_chunk_recursive_2048", _sql_chunks(2048, 256))
def q_chunk_recursive_2048(spark, d):
    return _recursive(spark, d, 2048, 256)


# ---- vectors ----

@query(
    "q_embed_hashing",
    """SELECT doc_id, 384 AS dim, round(CASE WHEN len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) > 0 THEN CAST(1 AS DOUBLE) ELSE 0 END, 4) AS norm,
         true AS is_repeatable FROM documents""",
)
def q_embed_hashing(spark, d):
    docs = I.wide(spark, d, "documents").select("doc_id", "text")
    twice = embed.embed_hashing(embed.embed_hashing(docs), out="again")
    return twice.select(
        "doc_id", F.size("vec").alias("dim"), F.round(V.norm(F.col("vec")), 4).alias("norm"),
        (F.col("vec") == F.col("again")).alias("is_repeatable"),
    )


@query(
    "q_l2_normalize",
    """SELECT vec_id, round(sqrt(list_sum(list_transform(u, lambda x: x * x))), 6) AS norm, round(u[1], 6) AS first, round(u[64], 6) AS last FROM (
         SELECT vec_id, list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)))) AS u FROM (
           SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE) * (1 + label)) AS v FROM embeddings))""",
)
def q_l2_normalize(spark, d):
    scaled = F.transform("embedding", lambda x: x.cast("double") * (1 + F.col("label")))
    rows = T(spark, d, "embeddings").select("vec_id", V.unit(scaled).alias("u"))
    return rows.select(
        "vec_id", F.round(V.norm(F.col("u")), 6).alias("norm"),
        F.round(F.get("u", 0), 6).alias("first"), F.round(F.get("u", 63), 6).alias("last"),
    )


_DOT = "list_inner_product(CAST(q.vec AS DOUBLE[]), CAST(c.embedding AS DOUBLE[]))"
_COS = f"{_DOT} / (sqrt(list_inner_product(CAST(q.vec AS DOUBLE[]), CAST(q.vec AS DOUBLE[]))) * sqrt(list_inner_product(CAST(c.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[]))))"
_CENTRES = """cells AS (SELECT label, unnest(range(1, 65)) AS i, unnest(embedding) AS x FROM embeddings),
  means AS (SELECT label, i, avg(CAST(x AS DOUBLE)) AS m FROM cells GROUP BY label, i),
  q AS (SELECT CAST(label AS BIGINT) AS query_id, list(m ORDER BY i) AS vec FROM means GROUP BY label)"""


def _sql_top(queries: str, score: str, k: int, corpus: str = "embeddings", skip: str = "true") -> str:
    return f"""SELECT query_id, neighbour_id, rank, round(score, 6) AS score FROM (
      SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, neighbour_id) AS INTEGER) AS rank FROM (
        SELECT q.query_id, c.vec_id AS neighbour_id, round({score}, 9) AS score FROM {queries} q JOIN {corpus} c ON {skip}))
      WHERE rank <= {k}"""


def _ranked(hits):
    return hits.select("query_id", "neighbour_id", "rank", F.round("score", 6).alias("score"))


_ALL_QUERIES = "(SELECT vec_id AS query_id, embedding AS vec FROM embeddings)"


@query("q_knn_by_id", _sql_top(_ALL_QUERIES, _DOT, 5, skip="q.query_id <> c.vec_id"))
def q_knn_by_id(spark, d):
    rows = I.vectors(T(spark, d, "embeddings"))
    return _ranked(neighbours.nearest(rows, rows, 5, cosine=False))


@query("q_cosine_topk", f"WITH {_CENTRES} " + _sql_top("q", _COS, 10))
def q_cosine_topk(spark, d):
    vecs = T(spark, d, "embeddings")
    return _ranked(neighbours.nearest(I.label_centres(vecs), I.vectors(vecs), 10, "query_id", skip_self=False))


@query("q_retrieve_topk", f"WITH {_CENTRES} " + _sql_top("q", _DOT, 16))
def q_retrieve_topk(spark, d):
    vecs = T(spark, d, "embeddings")
    return _ranked(
        neighbours.nearest(I.label_centres(vecs), I.vectors(vecs), 16, "query_id", cosine=False, skip_self=False)
    )


@query(
    "q_knn_filtered",
    f"WITH {_CENTRES} " + _sql_top("q", _COS, 5, corpus="(SELECT * FROM embeddings WHERE label = 3)"),
)
def q_knn_filtered(spark, d):
    vecs = T(spark, d, "embeddings")
    corpus = select_splits(I.vectors(vecs), [3], "label")
    return _ranked(neighbours.nearest(I.label_centres(vecs), corpus, 5, "query_id", skip_self=False))


@query("q_knn_cells_all", f"WITH {_CENTRES} " + _sql_top("q", _COS, 10))
def q_knn_cells_all(spark, d):
    """Search by cells with every cell probed, which must equal the exact search."""
    return _by_cells(spark, d, lambda *_: (8, 1.0))


@query("q_knn_cells")
def q_knn_cells(spark, d):
    """Approximate search in as many of eight cells as the recall measured on a sample of the queries asks for."""
    return _by_cells(spark, d, lambda *index: neighbours.measured_probes(*index, 10, "query_id", skip_self=False))


def _by_cells(spark, d, probes_for):
    vecs = T(spark, d, "embeddings")
    path = scratch_path(spark, "cells")
    centres = neighbours.write_cells(I.vectors(vecs), path, 8)
    asked = I.label_centres(vecs)
    probes, _ = probes_for(asked, I.vectors(vecs), path, centres)
    return _ranked(neighbours.nearest_in_cells(asked, path, centres, 10, probes, "query_id", skip_self=False))


@query(
    "q_neighbor_rows",
    "WITH t AS ("
    + _sql_top(_ALL_QUERIES, _DOT, 5, skip="q.query_id <> c.vec_id")
    + ") SELECT query_id, rank, neighbour_id, label FROM t JOIN embeddings e ON e.vec_id = t.neighbour_id",
)
def q_neighbor_rows(spark, d):
    rows = I.vectors(T(spark, d, "embeddings"))
    hits = neighbours.nearest(rows, rows, 5, cosine=False)
    found = join_rows(hits, rows.select(F.col("vec_id").alias("neighbour_id"), "label"), "neighbour_id")
    return found.select("query_id", "rank", "neighbour_id", "label")


@query(
    "q_rag_context",
    f"WITH {_CENTRES}, t AS ("
    + _sql_top("q", _DOT, 16)
    + """) SELECT query_id, md5(string_agg('Snippet ' || CAST(rank - 1 AS VARCHAR) || chr(10) || 'Legislation ID: ' || CAST(neighbour_id AS VARCHAR) || chr(10)
           || ' ... ' || text || ' ...', chr(10) || chr(10) ORDER BY rank)) AS context_hash, CAST(count(*) AS INTEGER) AS n
         FROM t JOIN documents d ON d.doc_id = t.neighbour_id GROUP BY query_id""",
)
def q_rag_context(spark, d):
    vecs = T(spark, d, "embeddings")
    hits = neighbours.nearest(I.label_centres(vecs), I.vectors(vecs), 16, "query_id", cosine=False, skip_self=False)
    docs = I.wide(spark, d, "documents").select(
        F.col("doc_id").alias("neighbour_id"), F.col("doc_id").cast("string").alias("legis_id"), "text"
    )
    made = context.build_context(join_rows(hits, docs, "neighbour_id"))
    return made.select("query_id", F.md5("context").alias("context_hash"), "n")


@query("q_retrieve_text")
def q_retrieve_text(spark, d):
    """Benchmark texts as questions over document chunks; vectors come from word hashing, so no SQL."""
    docs = I.wide(spark, d, "documents").select(F.col("doc_id").cast("string").alias("tv_id"), "text")
    chunks = chunking.explode_chunks(docs, chunking.recursive_chunks(F.col("text"), 1024, 256))
    corpus = embed.embed_hashing(chunks.select("chunk_id", "text"))
    asked = embed.embed_hashing(embed.as_questions(T(spark, d, "benchmark").select(F.col("item_id").cast("string").alias("query_id"), "text")))
    return _ranked(neighbours.nearest(asked, corpus, 16, "query_id", "chunk_id", skip_self=False))


@query("q_pca_2d")
def q_pca_2d(spark, d):
    rows = topics.project_2d(I.vectors(T(spark, d, "embeddings")))
    return rows.select("vec_id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query("q_topic_cluster")
def q_topic_cluster(spark, d):
    rows = topics.nested_topics(I.vectors(T(spark, d, "embeddings")))
    return rows.select("vec_id", "topic_depth_1", "topic_depth_2", "topic_depth_3")
