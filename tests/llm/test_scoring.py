"""Language-model scores and importance resampling."""

import collections
import math

import numpy as np
import pyarrow as pa

from lawloom.llm import lm_scoring, quality
from lawloom.llm.vocab import default_path, encoder


def test_scores_equal_brute_force(spark, smoke, odd_docs):
    first = smoke("documents").limit(60).select("doc_id", "text")
    odd = odd_docs.where("doc_id > 0").selectExpr("doc_id + 100000", "text")
    labels = smoke("labels")
    # Rows of one doc_id with other texts, and rows without doc_id, whose texts belong to target documents.
    again = first.where("doc_id IN (0, 1)").selectExpr("doc_id + 1", "text")
    nameless = first.limit(5).selectExpr("CAST(NULL AS LONG)", "text")
    docs = first.union(odd).union(again).union(nameless)
    got = collections.defaultdict(list)
    for r in lm_scoring.score(docs, labels).collect():
        got[r.doc_id].append(r)
    enc = encoder(default_path(), True)
    size = len(enc.ends) + 1
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    texts = [(r.doc_id, np.frombuffer(enc.encode([r.text])[0], enc.dtype).tolist()) for r in docs.collect()]
    pairs = [collections.Counter(), collections.Counter()]
    for i, ids in texts:
        for k in (0, 1):
            if k == 0 or i in good:
                pairs[k].update(zip([size - 1, *ids], ids))
    total = [sum(c.values()) for c in pairs]
    scale = [total[1] / total[0], 1.0]
    loss = {}
    token, context = ([collections.Counter(), collections.Counter()] for _ in range(2))
    for k in (0, 1):
        for (u, w), n in pairs[k].items():
            token[k][w] += n * scale[k]
            context[k][u] += n * scale[k]
    for i, ids in texts:
        assert got[i]
        if not ids:
            assert all(r.difference is None for r in got[i] if r.n_tokens == 0) and any(r.n_tokens == 0 for r in got[i])
            continue
        loss = []
        for k in (0, 1):
            whole = sum(token[k].values()) + lm_scoring.TOKEN_WEIGHT * size
            kappa = lm_scoring.CONTEXT_WEIGHT
            loss.append(-sum(
                math.log((pairs[k][u, w] * scale[k] + kappa * (token[k][w] + lm_scoring.TOKEN_WEIGHT) / whole) / (context[k][u] + kappa))
                for u, w in zip([size - 1, *ids], ids)
            ) / len(ids))
        assert any(r.n_tokens == len(ids) and abs(r.difference - (loss[1] - loss[0])) < 1e-9 for r in got[i])
    assert sum(map(len, got.values())) == docs.count()


def test_no_target_and_no_rows(spark, smoke):
    docs, labels = smoke("documents").limit(20), smoke("labels")
    assert {r.difference for r in lm_scoring.score(docs, labels.limit(0)).collect()} == {0.0}
    assert lm_scoring.score(docs.limit(0), labels).count() == 0


def test_kth_is_exact(spark):
    values = [5, 5, 5, -(10**15), 10**15, 3, 3, 0, 7, 7, 7, 7]
    rows = spark.createDataFrame([(v,) for v in values], "x long")
    order = sorted(values, reverse=True)
    for k in range(1, len(values) + 1):
        value, within = quality.kth(rows, "x", k)
        assert value == order[k - 1] and within == k - sum(v > value for v in values)


def test_features_do_not_depend_on_the_batch():
    texts = ["The cat. The Cat!! 12 AB", "", "x x x", "a"]
    for i, t in enumerate(texts):
        whole, owner = quality.features(pa.array(texts, pa.large_string()))
        alone, _ = quality.features(pa.array([t], pa.large_string()))
        assert sorted(whole[owner == i]) == sorted(alone)


def test_held_out_accuracy_and_sample_size(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.score(docs, labels).join(labels, "doc_id").collect()
    right = [r.selected == (r.quality == 1) for r in rows]
    assert np.mean(right) > 0.98
    assert np.mean([r.selected for r in rows if r.quality == 1]) > 0.99


def test_odd_rows(spark, odd_docs, smoke):
    labels = smoke("labels")
    got = quality.score(odd_docs, labels).collect()
    assert len(got) == odd_docs.count() and all(r.selected is not None for r in got)
    assert quality.keep(odd_docs, labels.limit(0)).count() == odd_docs.count()
    assert quality.keep(odd_docs, labels).columns == odd_docs.columns
    assert quality.score(odd_docs.limit(0), labels).count() == 0


def test_weights_keys_and_sample_equal_a_plain_version(spark, smoke):
    docs, labels = smoke("documents").select("doc_id", "text"), smoke("labels")
    got = {r.doc_id: r for r in quality.score(docs, labels, fit_rows=20).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = {i: quality.features(pa.array([t or ""], pa.large_string()))[0].tolist() for i, t in texts.items()}
    marked = labels.where("quality = 1").selectExpr("doc_id", f"{quality.FITTED} AS fitted", "xxhash64(doc_id) AS h").collect()
    target = [r.doc_id for r in sorted((r for r in marked if r.fitted), key=lambda r: (r.h, r.doc_id))][:20]
    raw = collections.Counter(b for f in found.values() for b in f)
    good = collections.Counter(b for i in target for b in found.get(i, ()))
    family = lambda b: (b >= quality.WORD_BUCKETS) + (b >= quality.WORD_BUCKETS + quality.PAIR_BUCKETS)
    totals = [[sum(n for b, n in c.items() if family(b) == k) for k in range(3)] for c in (raw, good)]
    matched = lambda b: raw[b] * totals[1][family(b)] / max(totals[0][family(b)], 1)
    ratio = lambda b: math.log(good[b] + quality.SMOOTHING) - math.log(matched(b) + quality.SMOOTHING)
    weight = {i: sum(map(ratio, f)) / max(len(f), 1) * min(len(f), quality.EFFECTIVE) for i, f in found.items()}
    assert all(abs(got[i].log_weight - w) < 1e-9 for i, w in weight.items())
    noise = {i: got[i].key * quality.KEY_UNIT - w / 0.25 for i, w in weight.items()}
    assert abs(np.mean(list(noise.values())) - 0.5772) < 0.3 and 0.8 < np.std(list(noise.values())) < 1.8  # Gumbel: 0.577, 1.28
    again = {r.doc_id: r.key for r in quality.score(docs.limit(50), labels, temperature=1.0).collect()}
    assert len(again) == 50
    held = labels.where(f"NOT ({quality.FITTED})").where("quality IS NOT NULL").collect()
    cost = lambda b: sum(quality.LOST_GOOD * (weight[r.doc_id] < b) if r.quality else weight[r.doc_id] >= b for r in held if r.doc_id in weight)
    borders = [k * quality.BORDER_STEP for k in range(-400, 402)]
    costs = [cost(b) for b in borders]
    best = [b for b, c in zip(borders, costs) if c == min(costs)]
    border = best[(len(best) - 1) // 2]
    k = sum(w >= border for w in weight.values())
    order = sorted(weight, key=lambda i: (-got[i].key, i))
    assert 0 < k < len(order) and {i for i in order if got[i].selected} == set(order[:k])


def test_rows_of_one_doc_id_are_judged_each(spark, smoke):
    docs, labels = smoke("documents").select("doc_id", "text"), smoke("labels")
    verdict = {r.doc_id: r.selected for r in quality.score(docs, labels).collect()}
    bad = next(i for i, chosen in verdict.items() if not chosen)
    good = next(i for i, chosen in verdict.items() if chosen)
    mixed = docs.where(f"doc_id <> {bad}").union(docs.where(f"doc_id = {bad}").selectExpr(f"{good}L", "text"))
    kept = quality.keep(mixed, labels).where(f"doc_id = {good}")
    assert [r.text for r in kept.collect()] == [docs.where(f"doc_id = {good}").first().text]


def test_labels_do_not_move_tokens(spark, smoke, monkeypatch):
    """Tokens are dealt out twice, for counting and for judging; the join with labels takes row numbers alone."""
    plans, kept = [], lm_scoring.stage

    def seen(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return kept(df, name)

    monkeypatch.setattr(lm_scoring, "stage", seen)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lm_scoring.score(smoke("documents"), smoke("labels"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plans[0] and "Join" not in plans[0]
