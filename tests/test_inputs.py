"""Inputs of the checked queries."""

from lawloom.plans import inputs


def test_a_table_that_is_split_already_is_not_moved(spark, tmp_path):
    spark.range(1_000).repartition(16).write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(10).coalesce(1).write.parquet(str(tmp_path / "few.parquet"))
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))
    try:
        plans = {n: inputs.spread(spark, str(tmp_path), n)._jdf.queryExecution().executedPlan().toString() for n in ("orders", "few")}
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert "Exchange" not in plans["orders"] and "Exchange" in plans["few"]
