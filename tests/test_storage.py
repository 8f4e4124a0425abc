"""File trees with side files, paired arrivals, tables kept current, pages, sketches, checks, codes, JSON values."""

import collections
import os
import pathlib
import random
import time

import numpy as np
import pytest
from lawloom.functions import documents
from lawloom.operators import codes, neighbours, pruned, quality, unify, upsert
from lawloom.plans import storage_queries as Q, table_queries
from lawloom.sources import buckets, members, pages, tables as stored_tables, treesource
from lawloom.streaming import pairs
from lawloom.streaming.ingest import file_arrivals
from pyspark.sql import functions as F
from tree import put

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- trees ----

def found(spark, root, **options):
    return {r["path"].split("/in/")[1]: (r["body"], r["stamp_text"]) for r in treesource.read_tree(spark, root, "*.xml", **options).collect()}


@pytest.mark.parametrize("options", [{}, {"levels": 0, "shares": 1}, {"levels": 1, "shares": 7}, {"levels": 9}])
def test_every_file_is_read_once_with_its_side_file(spark, tmp_path, options):
    root = str(tmp_path / "in")
    want = {}
    for n in range(60):
        place = ["one.xml", "a/f%d.xml", "a/b/c/d/f%d.xml", "a/hot/f%d.xml"][n % 4]
        place = place % n if "%" in place else place
        side = None if n % 3 == 0 else f"2024-01-01T00:00:{n:02d}Z\n"
        body = f"<x>é {n}</x>\n"
        put(root, place, body, side)
        if place not in want or side is not None:
            want[place] = (body, side)
        else:
            want[place] = (body, want[place][1])
    put(root, "a/notes.txt", "no", None)
    rows = treesource.read_tree(spark, root, "*.xml", **options)
    assert rows.count() == len(want) and found(spark, root, **options) == want
    assert rows.where(~F.startswith("path", F.lit("file:///"))).count() == 0


def test_a_missing_tree_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="no folder"):
        treesource.read_tree(spark, str(tmp_path / "none")).count()


def test_stream_gives_new_changed_and_late(spark, tmp_path):
    root, seen = str(tmp_path / "in"), []

    def run():
        seen.clear()
        stream = treesource.stream_tree(spark, root, "*.xml").writeStream.foreachBatch(lambda b, _: seen.extend(b.collect()))
        stream.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
        return {(r["path"].rsplit("/", 1)[1], r["body"], r["stamp_text"]) for r in seen}

    put(root, "a/one.xml", "1", "s1")
    put(root, "a/two.xml", "2", None)
    assert run() == {("one.xml", "1", "s1"), ("two.xml", "2", None)}
    assert run() == set()
    put(root, "a/b/three.xml", "3", "s3")
    os.utime(os.path.join(root, "a/b/three.xml"), (1, 1))  # copied with its old time
    assert run() == {("three.xml", "3", "s3")}
    pathlib.Path(root, "a/two-lastmod.txt").write_text("late")
    pathlib.Path(root, "a/one.xml").write_text("rewritten")
    assert run() == {("one.xml", "rewritten", "s1"), ("two.xml", "2", "late")}


# ---- paired arrivals ----

def stamp(day):
    return f"2024-{1 + day // 28:02d}-{1 + day % 28:02d} 00:00:00"


def test_pairs_equal_the_batch_join_in_any_order(spark, tmp_path):
    rng = random.Random(1)
    rows = {"files": [], "sides": []}
    for stem in range(40):
        day = rng.randrange(200)
        if stem % 5:
            rows["files"].append((stem, stamp(day)))
        if stem % 7:
            rows["sides"].append((stem, stamp(day + rng.choice([0, 3, 9, 10, 11, 60]))))
    tables = {k: spark.createDataFrame(v, "stem long, at string").withColumn("at", F.to_timestamp("at")) for k, v in rows.items()}
    how = ("stem", "at", "10 DAYS", "400 DAYS")
    want = {tuple(map(str, r)) for r in pairs.paired(tables["files"], tables["sides"], *how).collect()}
    folders = {k: str(tmp_path / k) for k in tables}

    def run():
        streams = [file_arrivals(spark, folders[k], tables[k].schema, per_batch=1) for k in ("files", "sides")]
        pairs.start_pairing(*streams, str(tmp_path / "log"), str(tmp_path / "state"), *how).awaitTermination()
        return pairs.paired(*streams, *how).schema

    for k in tables:
        shuffled = list(rows[k])
        rng.shuffle(shuffled)
        for part in (shuffled[:9], shuffled[9:20]):
            some = spark.createDataFrame(part, "stem long, at string").withColumn("at", F.to_timestamp("at"))
            pairs.write_arrivals(some, folders[k])
    run()
    for k in tables:
        done = spark.read.parquet(folders[k])
        pairs.write_arrivals(tables[k].join(done, "stem", "left_anti").select("stem", "at"), folders[k])
    run()  # a restart
    for k in tables:
        pairs.write_end(spark, tables[k].schema, folders[k], "at")
    schema = run()
    got = [tuple(map(str, r)) for r in pairs.read_pairs(spark, str(tmp_path / "log"), schema, "at").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert {g[-1] for g in got} == {"kept", "side:missing", "file:missing"}


# ---- tables kept current ----

def test_refresh_reads_touched_splits_and_makes_touched_rows_only(spark, tmp_path):
    arrivals, _ = Q.delta_tables(spark, FOLDER)
    root = str(tmp_path)
    paths = lambda n: [f"{root}/{p}" for p in ("unified", "status", "texts", f"c{n}/status", f"c{n}/texts")]
    for n, (bills, texts) in enumerate(arrivals[:2]):
        for rows, name, key in ((bills, "status", "legis_id"), (texts, "texts", "tv_id")):
            upsert.upsert_folder(rows, f"{root}/{name}", [key], ["stage"], "congress_num", changes=f"{root}/c{n}/{name}")
        before = {p.parent.name: p.name for p in pathlib.Path(root, "unified").rglob("*.parquet")} if n else {}
        unify.refresh_folder(spark, *paths(n), versions="text_versions")
    after = {p.parent.name: p.name for p in pathlib.Path(root, "unified").rglob("*.parquet")}
    assert {k for k in after if after[k] != before.get(k)} == {"congress_num=1995", "congress_num=1996", "congress_num=1997"}
    changes = [spark.read.parquet(p).drop("is_new") for p in paths(1)[3:]]
    tables = [spark.read.parquet(p).where(F.col("congress_num").isin(1995, 1996, 1997)) for p in paths(1)[:3]]
    touched = unify.touched_bills(tables[2], *changes, versions="text_versions")
    assert 0 < tables[1].join(touched, "legis_id", "left_semi").count() < tables[1].count()
    text = plan(unify.refresh(*tables, touched, "text_versions"))
    assert text.count("Location") == 0 or "congress_num" in text
    assert text.count("congress_num#") and "PartitionFilters: []" not in text.split("FileScan")[1]
    # A bill that is not touched keeps the very row it had, right or wrong.
    untouched = tables[0].join(touched, "legis_id", "left_anti").limit(1).select("legis_id").first()[0]
    marked = tables[0].withColumn("legis_type", F.when(F.col("legis_id") == untouched, "MARK").otherwise(F.col("legis_type")))
    made = unify.refresh(marked, *tables[1:], touched, "text_versions")
    assert made.where("legis_type = 'MARK'").count() == 1


def test_changed_listings_reach_other_owners(spark):
    """A record that lists a file no more, and a version that changes its owner."""
    status = spark.createDataFrame(
        [("b1", 1, [("t", "d", "u/f1")]), ("b2", 1, [("t", "d", "u/f2")]), ("b3", 1, [])],
        "legis_id string, congress_num int, tvs_listed array<struct<type string, date string, url string>>",
    )
    texts = spark.createDataFrame(
        [("v1", "b1", "f1", "2024-01-01", "dtd"), ("v2", "b2", "f2", "2024-01-01", "dtd"), ("v3", "b3", "f3", "2024-01-01", "dtd")],
        "tv_id string, legis_id string, file_name string, lastmod string, xml_type string",
    )
    listing_of = lambda df: {r["legis_id"]: [t["tv_id"] for t in r["tvs"]] for r in df.collect()}
    unified = unify.unify(status, texts, "tvs_listed").cache()
    assert listing_of(unified) == {"b1": ["v1"], "b2": ["v2"]}
    # b1's record lists b3's file instead of its own; version v2 becomes b3's.
    new_status = status.where("legis_id <> 'b1'").unionByName(
        spark.createDataFrame([("b1", 1, [("t", "d", "u/f3")])], status.schema)
    )
    new_texts = texts.withColumn("legis_id", F.when(F.col("tv_id") == "v2", "b3").otherwise(F.col("legis_id")))
    changed_status = status.where("legis_id = 'b1'").unionByName(new_status.where("legis_id = 'b1'"))
    changed_texts = texts.where("tv_id = 'v2'").unionByName(new_texts.where("tv_id = 'v2'"))
    touched = unify.touched_bills(new_texts, changed_status, changed_texts, "tvs_listed")
    assert {r[0] for r in touched.collect()} == {"b1", "b2", "b3"}
    got = listing_of(unify.refresh(unified, new_status, new_texts, touched, "tvs_listed"))
    assert got == listing_of(unify.unify(new_status, new_texts, "tvs_listed")) == {"b3": ["v2", "v3"]}


def test_a_split_without_bills_goes(spark, tmp_path):
    schema = "legis_id string, congress_num int, lists array<struct<type string, date string, url string>>, stage int"
    text_schema = "tv_id string, legis_id string, file_name string, lastmod string, xml_type string, congress_num int, stage int"
    root = str(tmp_path)
    for n, listed in enumerate(([("t", "d", "u/f1")], [])):
        bills = spark.createDataFrame([("b1", 1, listed, n), ("b2", 2, [("t", "d", "u/f2")], 0)], schema).where(F.lit(n == 0) | (F.col("congress_num") == 1))
        texts = spark.createDataFrame([(f"v{k}", f"b{k}", f"f{k}", "2024", "dtd", k, 0) for k in (1, 2)], text_schema).where(F.lit(n == 0))
        for rows, name, key in ((bills, "status", "legis_id"), (texts, "texts", "tv_id")):
            upsert.upsert_folder(rows, f"{root}/{name}", [key], ["stage"], "congress_num", changes=f"{root}/c{n}/{name}")
        unify.refresh_folder(spark, *[f"{root}/{p}" for p in ("unified", "status", "texts", f"c{n}/status", f"c{n}/texts")], versions="lists")
        want = {"b1", "b2"} if n == 0 else {"b2"}
        assert {r["legis_id"] for r in spark.read.parquet(f"{root}/unified").collect()} == want


def test_bucketed_upsert_shuffles_only_what_comes(spark):
    schema, name = "k long, t int, v string, w string", f"kept_{random.randrange(1 << 40)}"
    rows = lambda *x: spark.createDataFrame(list(x), schema)
    buckets.upsert_buckets(rows(*[(i, 1, f"v{i}", "w") for i in range(50)], (3, 0, "older", "w")), name, "k", ["t"], 4)
    held = buckets.stored(spark, name)
    incoming = rows((3, 2, "new", "x"), (4, 0, "older", "x"), (5, 1, "same time", "x"), (99, 1, "v99", "x"), (99, 0, "v98", "x"))
    merged = buckets.merged_buckets(held, incoming, "k", ["t"], 4, keep=["w"])
    merged.collect()
    final = plan(merged).split("== Initial Plan ==")[0]
    stored_side = [x for x in final.split("\n") if "FileScan parquet" in x]
    assert len(stored_side) == 1 and "Bucketed: true" in stored_side[0]
    # One shuffle groups the incoming rows; none stands between the scan and the join.
    depth = lambda line: len(line) - len(line.lstrip(" :+-*"))
    lines = final.split("\n")
    at = next(i for i, x in enumerate(lines) if "FileScan parquet" in x)
    above = []
    for line in reversed(lines[:at]):
        if not above or depth(line) < depth(above[-1]):
            above.append(line)
    joined = next(i for i, x in enumerate(above) if "SortMergeJoin" in x or "HashJoin" in x)
    assert not any("Exchange" in x for x in above[:joined])
    kept = buckets.upsert_buckets(incoming, name, "k", ["t"], 4, keep=["w"])
    got = {r["k"]: (r["v"], r["w"]) for r in kept.collect()}
    assert len(got) == 51 == kept.count()
    assert (got[3], got[4], got[5], got[99]) == (("new", "w"), ("v4", "w"), ("same time", "w"), ("v99", "x"))
    for _ in range(3):
        buckets.upsert_buckets(incoming, name, "k", ["t"], 4)
    assert len(buckets.versions(spark, name)) == buckets.KEPT_VERSIONS
    # A join of two tables with the same buckets shuffles neither.
    other = f"{name}_other"
    buckets.create_buckets(rows((3, 0, "x", "y")), other, "k", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = buckets.stored(spark, name).join(buckets.stored(spark, other).select("k", F.col("v").alias("u")), "k")
        assert joined.count() == 1 and "Exchange" not in plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_indexed_pages(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 1, 2, 7]), n, f"x{n}") for n in range(1000)]
    rng.shuffle(rows)
    path, order = str(tmp_path / "p"), ["k", "n"]
    pages.write_pages(spark.createDataFrame(rows, "k int, n int, v string"), order, path, rows_per_range=64)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for offset, length in ((0, 100), (60, 10), (127, 2), (500, 100), (995, 100), (1000, 5), (4000, 5)):
        got = [tuple(r) for r in pages.page_of(spark, path, order, offset, length).collect()]
        assert got == want[offset : offset + length], (offset, length)
    text = plan(pages.page_of(spark, path, order, 500, 20))
    assert "page_range" in text.split("PartitionFilters:")[1] and "Exchange rangepartitioning" not in text
    with pytest.raises(ValueError):
        pages.page_of(spark, path, order, 0, 101)
    pages.write_pages(spark.createDataFrame([], "k int, n int, v string"), order, str(tmp_path / "none"))
    assert pages.page_of(spark, str(tmp_path / "none"), order, 0, 5).count() == 0


def test_only_wanted_splits_are_read(spark):
    fixed = plan(Q.q_pruned_splits(spark, FOLDER))
    assert "PartitionFilters: [month#" in fixed and "IN (2,3)" in fixed.split("PartitionFilters")[1]
    joined = plan(Q.q_splits_of_join(spark, FOLDER))
    assert "dynamicpruning" in joined.split("PartitionFilters")[1]


# ---- profiles and checks ----

def test_sketches_of_splits_unite(spark, tmp_path):
    rows = spark.range(40_000).select((F.col("id") % 8).alias("split"), F.when(F.col("id") % 9 > 0, F.col("id") % 15_000).alias("key"))
    quality.distinct_sketches(rows, "split", "key").write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    spans = spark.createDataFrame([(s, str(s)) for s in range(8)] + [(s, "all") for s in range(8)] + [(s, "low") for s in range(3)], "split long, span string")
    got = {r["span"]: r for r in quality.distinct_over(stored, spans, "split", "span").collect()}
    exact = rows.join(spans, "split").groupBy("span").agg(F.countDistinct("key").alias("n"), F.count("key").alias("rows")).collect()
    assert len(exact) == len(got) == 10
    assert all(got[r["span"]]["n_low"] <= r["n"] <= got[r["span"]]["n_high"] and got[r["span"]]["n_rows"] == r["rows"] for r in exact)


def test_checks_are_made_while_writing(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    rows = spark.range(100).select(F.when(F.col("id") % 10 > 0, F.col("id")).alias("k")).mapInArrow(count, "k long")
    seen = quality.observed_write(rows, {"null_keys": F.col("k").isNull(), "large": F.col("k") > 89}, lambda df: df.write.parquet(str(tmp_path / "o")))
    assert seen == {"n_rows": 100, "null_keys": 10, "large": 9} and made.value == 100
    assert spark.read.parquet(str(tmp_path / "o")).count() == 100


def test_json_is_parsed_once(spark):
    rows = table_queries.T(spark, FOLDER, "events")
    df = Q.q_json_variant(spark, FOLDER)
    assert df._jdf.queryExecution().optimizedPlan().toString().lower().replace("_", "").count("parsejson(") == 1
    assert df.where("is_malformed").count() == rows.where("event_id % 17 = 0").count()
    texts = spark.createDataFrame([('{"a": {"b": [1, "x"]}}',), ('{"a": 1',), (None,), ("[]",)], "t string").withColumn("v", documents.parsed(F.col("t")))
    got = texts.select(documents.at(F.col("v"), "$.a.b[0]", "int"), documents.at(F.col("v"), "$.a.b[1]", "int"), documents.is_malformed(F.col("t"), F.col("v")))
    assert [tuple(r) for r in got.collect()] == [(1, None, False), (None, None, True), (None, None, False), (None, None, False)]
    assert "b: " in texts.where("t LIKE '{%'").agg(documents.seen_schema(F.col("v"))).first()[0]


def test_bad_member_numbers_are_told(spark, tmp_path):
    names = [f.name for f in members.MEMBERS.fields]
    lines = [",".join(names)]
    for values in ({"icpsr": "1", "nominate_dim1": "0.5", "nominate_dim2": "x"}, {"icpsr": "two", "nominate_dim1": "1", "nominate_dim2": "1"}, {"icpsr": "3"}):
        lines.append(",".join(values.get(n, "") for n in names))
    (tmp_path / "m.csv").write_text("\n".join(lines) + "\n")
    checked = members.checked_members(spark, str(tmp_path / "m.csv"))
    got = [(r["icpsr"], r["violations"], r["is_dropped"]) for r in members.quarantined_members(checked).collect()]
    assert sorted(got, key=str) == [(1, ["nominate_dim2:type"], True), (None, ["icpsr:type"], False)]
    assert members.read_members(spark, str(tmp_path / "m.csv")).schema == members.MEMBERS


# ---- codes ----

def folder_bytes(path):
    return sum(p.stat().st_size for p in pathlib.Path(path).rglob("*.parquet"))


def test_codes_find_the_nearest_and_are_small(spark, tmp_path):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(30, 64))
    vecs = (centres[rng.integers(0, 30, 6000)] + rng.normal(size=(6000, 64)) * 0.7).astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)] + [(9999, None)], "vec_id long, vec array<float>")
    index = codes.write_index(rows, str(tmp_path), 12)
    assert spark.read.parquet(f"{tmp_path}/codes").count() == 6000
    assert folder_bytes(f"{tmp_path}/codes") * 4 <= folder_bytes(f"{tmp_path}/vectors")
    assert index.recall >= codes.WANTED or index.probes == 12
    assert f'"recall": {index.recall}' in spark.read.text(f"{tmp_path}/measured").first()[0]
    asked = rows.where("vec_id % 20 = 0")
    exact = {(r.query_id, r.neighbour_id): r.score for r in neighbours.nearest(asked, rows, 10).collect()}
    got = {(r.query_id, r.neighbour_id): r.score for r in codes.search(asked, index, 10, "vec_id").collect()}
    assert len(got) == 3000 and all(abs(exact[p] - s) < 1e-9 for p, s in got.items() if p in exact)
    assert len(exact.keys() & got.keys()) >= 0.9 * len(exact)


def test_few_vectors_and_none(spark, tmp_path):
    rows = spark.createDataFrame([(i, [float(i), 1.0, 0.0]) for i in range(5)], "vec_id long, vec array<float>")
    index = codes.write_index(rows, str(tmp_path / "few"), 8)
    got = collections.Counter(r.query_id for r in codes.search(rows, index, 3, "vec_id").collect())
    assert got == {i: 3 for i in range(5)}
    assert codes.search(rows.limit(0), index, 3, "vec_id").count() == 0
    with pytest.raises(ValueError):
        codes.write_index(rows.limit(0), str(tmp_path / "none"), 8)


def test_probes_follow_the_measured_recall(spark, tmp_path):
    rng = np.random.default_rng(6)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(800, 16)))], "vec_id long, vec array<float>")
    centres = neighbours.write_cells(rows, str(tmp_path), 8)
    asked = rows.where("vec_id % 20 = 0")
    probes, recall = neighbours.measured_probes(asked, rows, str(tmp_path), centres, 10)
    assert recall >= 0.95 and 1 < probes <= 8
    assert neighbours.measured_probes(asked, rows, str(tmp_path), centres, 10, wanted=0.01)[0] == 1


@pytest.mark.parametrize("spread", [0.05, 5.0])
def test_pruned_search_is_exact(spark, spread):
    """Clustered vectors leave most slices out, spread ones few; the result is the same as in full."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(20, 12))
    vecs = (centres[rng.integers(0, 20, 1500)] + spread * rng.normal(size=(1500, 12))).astype(np.float32)
    vecs[700:720] = vecs[700]  # ties
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)] + [(5000, None)], "vec_id long, vec array<float>")
    asked = rows.where("vec_id % 3 = 0")
    got, report = pruned.nearest_pruned(asked, rows, 5, slice_rows=10)
    want = neighbours.nearest(asked, rows, 5)
    key = lambda df: sorted((r.query_id, r.rank, r.neighbour_id, r.score) for r in df.collect())
    assert key(got) == key(want)
    pairs, compared = report.first()
    assert pairs == 500 * 1500 and 0 < compared <= pairs and (spread > 1 or compared < pairs / 4)


def test_pruned_search_copies_no_query_for_each_slice(spark, monkeypatch):
    """Spread vectors rule no slice out; what is kept grows with the queries, not with queries times slices."""
    counts, cut = [], pruned.cut_lineage

    def counted(df):
        out = cut(df)
        counts.append(out.count())
        return out

    monkeypatch.setattr(pruned, "cut_lineage", counted)
    vecs = np.random.default_rng(4).normal(size=(600, 16)).astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)], "vec_id long, vec array<float>")
    got, report = pruned.nearest_pruned(rows, rows, 5, slice_rows=4)
    assert got.count() == 3_000
    assert max(counts) <= 5 * 600
    assert report.first()["compared"] <= report.first()["pairs"]


def test_groups_are_packed_into_blocks_of_bounded_size():
    first, parts = pruned.packed(np.array([3, 4, 25, 2, 8, 1]), 10)
    assert first.tolist() == [0, 0, 1, 4, 4, 5] and parts.tolist() == [1, 1, 3, 1, 1, 1]


def test_pruned_search_of_few(spark):
    rows = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(4)], "vec_id long, vec array<float>")
    assert pruned.nearest_pruned(rows, rows, 5)[0].count() == 12
    assert pruned.nearest_pruned(rows, rows.limit(0), 5)[0].count() == 0
    assert pruned.nearest_pruned(rows.limit(0), rows, 5)[0].count() == 0


def test_first_unified_build_looks_for_no_touched_bills(spark, tmp_path, monkeypatch):
    """Without a stored result every bill is made; which ones have changed is not asked."""
    status = spark.createDataFrame([("o-1", 7, [("v1", "d", "https://example.org/1/a.xml")])],
                                   "legis_id string, congress_num int, text_versions array<struct<type:string,date:string,url:string>>")
    texts = spark.sql("SELECT 't-1' AS tv_id, 'o-1' AS legis_id, 'a.xml' AS file_name, DATE'2024-01-01' AS lastmod, 'dtd' AS xml_type, 7 AS congress_num")
    paths = [str(tmp_path / n) for n in ("unified", "status", "texts", "new_status", "new_texts")]
    for rows, path in ((status, paths[1]), (texts, paths[2])):
        rows.write.partitionBy("congress_num").parquet(path)
        rows.withColumn("is_new", F.lit(True)).write.parquet(path.replace("/status", "/new_status").replace("/texts", "/new_texts"))
    monkeypatch.setattr(unify, "touched_bills", None)
    unify.refresh_folder(spark, *paths, versions="text_versions")
    assert [(r["legis_id"], len(r["tvs"])) for r in spark.read.parquet(paths[0]).collect()] == [("o-1", 1)]


def three_arrivals(spark):
    """Bills and texts of two splits; later arrivals change lists, owners and dates, and bring new keys."""
    bills = "legis_id string, congress_num int, lists array<struct<type string, date string, url string>>, stage int"
    texts = "tv_id string, legis_id string, file_name string, lastmod string, xml_type string, congress_num int, stage int"
    listed = lambda *files: [("t", "d", f"u/{f}") for f in files]
    split = lambda k: 1 + k % 2
    first = [(f"b{k}", split(k), listed(f"f{k}", f"g{k}"), 0) for k in range(40)]
    second = [(f"b{k}", split(k), listed(f"g{k}", f"f{k + 2}"), 1) for k in range(30, 50)]
    third = [(f"b{k}", 1, listed(), 2) for k in range(0, 20, 2)]
    made = [(f"v{k}{x}", f"b{k}", f"{x}{k}", "2024", "dtd", split(k), 0) for k in range(40) for x in "fg"]
    moved = [(f"v{k}f", f"b{k + 2}", f"f{k}", "2025", "dtd", split(k), 1) for k in range(10, 45)]
    older = [(f"v{k}g", f"b{k}", f"g{k}", "2026", "dtd", 1, -1) for k in range(0, 20, 2)]
    return [tuple(spark.createDataFrame(rows, s) for rows, s in zip(x, (bills, texts))) for x in ((first, made), (second, moved), (third, older))]


def kept_current(spark, root, arrivals):
    for n, arrived in enumerate(arrivals):
        for rows, name, key in zip(arrived, ("status", "texts"), ("legis_id", "tv_id")):
            upsert.upsert_folder(rows, f"{root}/{name}", [key], ["stage"], "congress_num", changes=f"{root}/c{n}/{name}")
        unify.refresh_folder(spark, *[f"{root}/{p}" for p in ("unified", "status", "texts", f"c{n}/status", f"c{n}/texts")], versions="lists")
    return [spark.read.parquet(f"{root}/{name}") for name in ("unified", "status", "texts")]


@pytest.mark.parametrize("round_bytes", [1, 1 << 40])
def test_tables_kept_current_in_rounds_equal_a_whole_build(spark, tmp_path, monkeypatch, round_bytes):
    monkeypatch.setattr(stored_tables, "ROUND_BYTES", round_bytes)
    arrivals = three_arrivals(spark)
    unified, status, texts = kept_current(spark, str(tmp_path), arrivals)
    assert stored_tables.round_count(status) == (stored_tables.MOST_ROUNDS if round_bytes == 1 else 1)
    plain = lambda df: sorted(repr(r) for r in df.select(*sorted(df.columns)).collect())
    for n, (table, key) in enumerate(((status, "legis_id"), (texts, "tv_id"))):
        came = arrivals[0][n].unionByName(arrivals[1][n]).unionByName(arrivals[2][n])
        assert plain(table) == plain(upsert.latest_rows(came, [key], ["stage"]))
    assert plain(unified) == plain(unify.unify(status, texts, "lists").select(*unified.columns))
    changed = spark.read.parquet(f"{tmp_path}/c1/texts")
    assert changed.groupBy("is_new").count().orderBy("is_new").collect() == [(False, 30), (True, 35)]
    assert {p.name for p in tmp_path.iterdir()} == {"unified", "status", "texts", "c0", "c1", "c2"}


def test_keeping_tables_current_leaves_no_second_copy(spark, tmp_path, monkeypatch):
    """What is kept beside the tables and their changes: ids of touched bills; shuffle files go with their step."""
    cuts, cut = [], unify.cut_lineage
    for module in (upsert, unify):
        monkeypatch.setattr(module, "cut_lineage", lambda df: cuts.append(df.columns) or cut(df))
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {p.name for d in disk.localDirsString() for p in pathlib.Path(d).rglob("shuffle_*.data")}
    before = shuffles()
    kept_current(spark, str(tmp_path), three_arrivals(spark)[:2])
    assert cuts == [["legis_id"]]
    until = time.time() + 30
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert shuffles() - before == set()
