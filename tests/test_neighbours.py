import numpy as np
import pytest
from lawloom.operators import neighbours as N
from lawloom.operators.embed import as_questions, embed_hashing, embed_with
from lawloom.session import scratch_path


@pytest.fixture(scope="module")
def vecs(spark):
    """Random vectors, every third one a copy of the first, one zero vector."""
    rng = np.random.default_rng(5)
    m = rng.normal(size=(400, 8)).astype("float32")
    m[::3] = m[0]
    m[7] = 0
    df = spark.createDataFrame([(f"v{i:03d}", row.tolist()) for i, row in enumerate(m)], "vec_id string, vec array<float>")
    return m.astype("float64"), df.repartition(7)


def brute(m, k, cosine, skip_self):
    if cosine:
        length = np.linalg.norm(m, axis=1, keepdims=True)
        m = np.divide(m, length, out=np.zeros_like(m), where=length > 0)
    out = set()
    for i in range(len(m)):
        scored = sorted((-round(float(m[i] @ m[j]), 9), f"v{j:03d}") for j in range(len(m)) if not (skip_self and i == j))
        out |= {(f"v{i:03d}", j, r + 1) for r, (_, j) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize(("cosine", "skip_self"), [(True, True), (False, False)])
@pytest.mark.parametrize("limit", [4096, 10])
def test_exact_both_ways(vecs, cosine, skip_self, limit, monkeypatch):
    monkeypatch.setattr(N, "QUERY_BLOCK", 200)
    monkeypatch.setattr(N, "CORPUS_SLICE", 150)
    m, df = vecs
    hits = N.nearest(df, df, 6, cosine=cosine, skip_self=skip_self, broadcast_queries=limit).collect()
    assert {(h["query_id"], h["neighbour_id"], h["rank"]) for h in hits} == brute(m, 6, cosine, skip_self)


def test_fewer_rows_than_k_and_no_queries(vecs):
    _, df = vecs
    two = df.where("vec_id in ('v001', 'v002')")
    assert N.nearest(two, two, 6).count() == 2
    assert N.nearest(df.limit(0), df, 6).count() == 0


def test_cells(spark, vecs, monkeypatch):
    m, df = vecs
    path = scratch_path(spark, "cells-test")
    centres = N.write_cells(df, path, 5)
    exact = {(h["query_id"], h["neighbour_id"]) for h in N.nearest(df, df, 5).collect()}
    every = {(h["query_id"], h["neighbour_id"]) for h in N.nearest_in_cells(df, path, centres, 5, probes=5).collect()}
    assert every == exact
    some = {(h["query_id"], h["neighbour_id"]) for h in N.nearest_in_cells(df, path, centres, 5, probes=2).collect()}
    assert len(some & exact) / len(exact) > 0.6
    # More queries than are sent to every task: the same rows, by cells.
    monkeypatch.setattr(N, "QUERY_BLOCK", 60)
    monkeypatch.setattr(N, "CORPUS_SLICE", 80)
    dealt = {(h["query_id"], h["neighbour_id"]) for h in N.nearest_in_cells(df, path, centres, 5, 2, broadcast_queries=10).collect()}
    assert dealt == some


def test_only_probed_cells_are_read(spark, vecs):
    _, df = vecs
    path = scratch_path(spark, "cells-test")
    centres = N.write_cells(df, path, 5)
    plan = N.nearest_in_cells(df.where("vec_id = 'v000'"), path, centres, 5, probes=1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan or "PartitionFilters: [cell" in plan


def test_embedding(spark):
    df = spark.createDataFrame([(1, "Tax the air"), (2, "air  tax THE"), (3, ""), (4, None)], "i int, text string")
    rows = {r["i"]: np.array(r["vec"]) for r in embed_hashing(df).collect()}
    assert len(rows[1]) == 384 and abs(np.linalg.norm(rows[1]) - 1) < 1e-6
    assert np.allclose(rows[1], rows[2]) and not rows[3].any() and not rows[4].any()
    assert as_questions(df).first()["text"].startswith("Represent this question")


def test_embedding_with_a_model(spark):
    def make():
        import numpy

        return lambda texts: numpy.array([[float(len(t)), 1.0] for t in texts], dtype="float32")

    df = spark.createDataFrame([(1, "abc"), (2, "a")], "i int, text string")
    assert {r["i"]: r["vec"] for r in embed_with(df, make, partitions=2).collect()} == {1: [3.0, 1.0], 2: [1.0, 1.0]}


def test_retrieval_by_text_equals_brute_force(spark):
    from lawloom.operators import chunking
    from lawloom.plans import document_queries as Q
    from pyspark.sql import functions as F

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select(F.col("doc_id").cast("string").alias("tv_id"), "text")
    chunks = chunking.explode_chunks(docs, chunking.recursive_chunks(F.col("text"), 1024, 256))
    corpus = {r["chunk_id"]: r["vec"] for r in embed_hashing(chunks.select("chunk_id", "text")).collect()}
    items = spark.read.parquet(f"{folder}/benchmark.parquet").select(F.col("item_id").cast("string").alias("query_id"), "text")
    asked = {r["query_id"]: r["vec"] for r in embed_hashing(as_questions(items)).collect()}
    unit = lambda rows: (lambda m: m / np.linalg.norm(m, axis=1, keepdims=True))(np.array(list(rows), float))
    scores, names = np.round(unit(asked.values()) @ unit(corpus.values()).T, 9), list(corpus)
    want = {}
    for row, query in zip(scores, asked):
        best = sorted(zip(-row, names))[:16]
        want |= {(query, rank): (name, round(-score, 6)) for rank, (score, name) in enumerate(best, 1)}
    got = {(r["query_id"], r["rank"]): (r["neighbour_id"], round(r["score"], 6)) for r in Q.q_retrieve_text(spark, folder).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k][1] - want[k][1]) < 2e-6 for k in want) and sum(got[k][0] == want[k][0] for k in want) >= 0.99 * len(want)


def test_scoring_holds_tiles_not_whole_blocks():
    """A block of queries against a slice of many rows, most of them copies: bounded memory, ties by id."""
    import tracemalloc

    rng = np.random.default_rng(3)
    rows = rng.normal(size=(40_000, 4))
    rows[1_000:] = rows[7]
    ids = rng.permutation(40_000)
    asked = np.arange(600)
    tracemalloc.start()
    at, found, scores = N._best(asked, rows[np.argsort(ids)[asked]], ids, rows, 5, True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150 << 20
    full = np.round(rows[np.argsort(ids)[asked[::50]]] @ rows.T, 9)
    for query, line in zip(asked[::50], full):
        best = [(i, s) for s, i in sorted(zip(-line, ids)) if i != query][:5]
        assert [(i, -s) for i, s in zip(found[at == query], scores[at == query])] == best
