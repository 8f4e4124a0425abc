"""Every registered query at the smallest scale: equal to its oracle, with a plan that holds at scale."""

import re

import __spark_entry__ as entry
import pytest
from compare import connect, differences
from lawloom.plans.registry import ORACLES, QUERIES

FOLDER = entry.SMOKE_FOLDER
# Queries with Python in tasks: text splitting and vector scoring.
PYTHON = {
    "q_chunk_recursive", "q_chunk_recursive_2048", "q_retrieve_text", "q_knn_by_id", "q_cosine_topk", "q_retrieve_topk",
    "q_knn_filtered", "q_knn_cells", "q_knn_cells_all", "q_neighbor_rows", "q_rag_context", "q_knn_codes", "q_knn_recall",
    "q_knn_all_pruned",
}
# Totals: the result is one row (per branch), summed from partial counts.
TOTALS = {"q_join_preserves_rows", "q_key_uniqueness", "q_skipped_count", "q_observed_checks", "q_pca_axes", "q_topic_nesting"}
MODELS = {"q_topic_cluster", "q_pca_2d", "q_pca_axes", "q_topic_nesting"}


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def check_plan(df, name):
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text  # no row-at-a-time functions
    if name not in TOTALS:
        assert "SinglePartition" not in text
    if name not in PYTHON | MODELS:
        assert not re.search(r"ArrowEvalPython|MapInArrow|MapInPandas|FlatMap", text)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_oracle(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    check_plan(df, name)
    assert differences(df, duck, entry.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    df = entry.queries()[name](spark, FOLDER)
    check_plan(df, name)
    assert df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
