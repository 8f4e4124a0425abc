import pytest
from lawloom.operators import numbering as N
from lawloom.operators.splits import assign_splits
from lawloom.sources.tables import page_rows
from pyspark.sql import Window, functions as F


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows under one key, one null key."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") == 1, None).otherwise((F.col("id") % 97).cast("string"))
    return spark.range(3000).select(key.alias("k"), F.xxhash64("id").alias("v"), "id")


def test_numbers_within_keys(skewed):
    order = [F.col("v").desc(), F.col("id")]
    got = N.number_within(skewed, ["k"], order, name="n")
    want = skewed.withColumn("n", (F.row_number().over(Window.partitionBy("k").orderBy(*order)) - 1).cast("bigint"))
    assert got.exceptAll(want.select(got.columns)).count() == 0
    assert got.count() == 3000


def test_hot_key_stays_spread_after_numbering(spark):
    """A key with two thirds of the rows lies in several partitions of the numbered table."""
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 < 2, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    numbered = N.number_within(rows, ["k"], [F.col("id")], name="n")
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "SortMergeJoin" not in plan
    spread = numbered.withColumn("p", F.spark_partition_id()).where("k = 'hot'").groupBy("p").count().collect()
    assert len(spread) > 2 and max(r["count"] for r in spread) < 15_000
    assert numbered.where("k = 'hot'").agg(F.max("n"), F.countDistinct("n")).first() == (19_999, 20_000)


def test_global_numbers_and_batches(skewed):
    rows = N.number_rows(skewed, [F.col("id").desc()], name="n", start=1).collect()
    assert all(r["n"] == 3000 - r["id"] for r in rows)
    sizes = N.batch_ids(skewed, [F.col("id")], 700).groupBy("batch_id").count().collect()
    assert sorted((r[0], r[1]) for r in sizes) == [(0, 700), (1, 700), (2, 700), (3, 700), (4, 200)]


def test_empty(skewed):
    assert N.number_within(skewed.limit(0), ["k"], [F.col("id")]).count() == 0


def test_deep_page(spark):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_000).alias("id"))
    assert [r[0] for r in page_rows(df, ["id"], 15_000, 100).collect()] == list(range(15_000, 15_100))
    with pytest.raises(ValueError):
        page_rows(df, ["id"], 15_000, 500)
    holes = df.select(F.when(F.col("id") >= 100, F.col("id")).alias("id"))
    assert [r[0] for r in page_rows(holes, ["id"], 90, 12).collect()] == [None] * 12
    assert [r[0] for r in page_rows(df, ["id"], 30, 5).collect()] == [30, 31, 32, 33, 34]


def test_split_parity(spark):
    rows = [(f"b{i}", c, "hr", i) for c in (112, 113, 118) for i in range(7)]
    df = spark.createDataFrame([(f"{r[0]}-{r[1]}", *r[1:]) for r in rows], "legis_id string, congress_num int, legis_type string, legis_num int")
    got = {r["legis_id"]: r["split"] for r in assign_splits(df).collect()}
    assert len(got) == 14 and all(got[f"b{i}-113"] == "train" for i in range(7))
    assert [got[f"b{i}-118"] for i in range(7)] == ["validation", "test"] * 3 + ["validation"]
