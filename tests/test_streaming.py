from lawloom.streaming import ingest
from pyspark.sql.types import IntegerType, StringType, StructType

SCHEMA = StructType().add("k", StringType()).add("t", IntegerType()).add("v", StringType())


def write(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def current(spark, log):
    return {r["k"]: r["v"] for r in ingest.read_current(spark, log, SCHEMA, ["k"], ["t"]).collect()}


def run(spark, source, log, state):
    arrivals = ingest.file_arrivals(spark, source, SCHEMA, per_batch=1)
    ingest.start_ingest(arrivals, log, state, ["k"], ["t"]).awaitTermination()


def test_batches_accumulate_and_restart(spark, tmp_path):
    source, log, state = (str(tmp_path / n) for n in ("in", "log", "state"))
    write(spark, [("a", 1, "a1"), ("b", 9, "b9"), ("a", 0, "a0")], source)
    write(spark, [("a", 2, "a2"), ("b", 3, "b3")], source)
    run(spark, source, log, state)
    assert current(spark, log) == {"a": "a2", "b": "b9"}
    write(spark, [("c", 1, "c1"), ("a", 2, "same time, later batch")], source)
    run(spark, source, log, state)
    assert current(spark, log) == {"a": "same time, later batch", "b": "b9", "c": "c1"}


def test_a_repeated_batch_counts_once(spark, tmp_path):
    log = str(tmp_path / "log")
    batch = spark.createDataFrame([("a", 1, "x")], SCHEMA)
    for _ in range(2):
        ingest.log_batch(batch, 0, log, ["k"], ["t"])
    assert spark.read.parquet(log).count() == 1
    ingest.compact(spark, log, str(tmp_path / "next"), SCHEMA, ["k"], ["t"])
    ingest.log_batch(spark.createDataFrame([("a", 2, "y")], SCHEMA), 0, str(tmp_path / "next"), ["k"], ["t"])
    assert current(spark, str(tmp_path / "next")) == {"a": "y"}


def test_xml_files_arrive_whole(spark, tmp_path):
    from tree import put

    put(str(tmp_path / "in"), "data/x/one.xml", "<a>\n<b/>\n</a>", None)
    seen = []
    arrivals = ingest.xml_arrivals(spark, str(tmp_path / "in"), "*.xml")
    query = (
        arrivals.writeStream.foreachBatch(lambda b, _: seen.extend(b.collect()))
        .option("checkpointLocation", str(tmp_path / "s")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert [(r["path"].rsplit("/", 1)[1], r["body"]) for r in seen] == [("one.xml", "<a>\n<b/>\n</a>")]
