from lawloom.operators.quality import join_report, key_report, require_unique
from lawloom.operators.upsert import latest_rows, merge_latest
import pytest

S = "k string, t int, p string, v string"


def test_newest_wins_either_way_round(spark):
    stored = spark.createDataFrame([("a", 1, "x", "old"), ("b", 5, "x", "stays"), ("c", 1, None, "null path")], S)
    new = spark.createDataFrame([("a", 2, "x", "new"), ("a", 2, "y", "newest"), ("b", 4, "z", "late"), ("c", 1, "a", "path"), ("d", 0, "x", "added")], S)
    got = {r["k"]: r["v"] for r in merge_latest(stored, new, ["k"], ["t", "p"]).collect()}
    assert got == {"a": "newest", "b": "stays", "c": "path", "d": "added"}


def test_kept_columns(spark):
    stored = spark.createDataFrame([("a", 1, "x", "kept"), ("b", 1, "x", None)], S)
    new = spark.createDataFrame([("a", 2, "y", "lost"), ("b", 2, "y", "lost"), ("c", 1, "x", "own")], S)
    got = {r["k"]: (r["t"], r["v"]) for r in merge_latest(stored, new, ["k"], ["t", "p"], keep=["v"]).collect()}
    assert got == {"a": (2, "kept"), "b": (2, None), "c": (1, "own")}


def test_one_row_per_key_leaves_each_task(spark):
    df = spark.range(1000).selectExpr("'hot' AS k", "CAST(id AS int) AS t", "'x' AS p", "'v' AS v")
    plan = latest_rows(df, ["k"], ["t", "p"])
    assert "partial_max_by" in plan._jdf.queryExecution().executedPlan().toString()
    assert plan.first()["t"] == 999
    assert latest_rows(df, ["k"], ["t", "p"], newest=False).first()["t"] == 0


def test_reports(spark):
    df = spark.createDataFrame([("a", 1, "x", "v"), ("a", 2, "x", "v"), ("b", 1, "x", "v")], S)
    assert tuple(key_report(df, ["k"]).first()) == (3, 2, False)
    assert tuple(key_report(df.limit(0), ["k"]).first()) == (0, 0, True)
    require_unique(df, ["k", "t"])
    with pytest.raises(ValueError):
        require_unique(df, ["k"])
    assert tuple(join_report(df, df.limit(1)).first()) == (3, 1, False)
