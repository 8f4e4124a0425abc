import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def smoke(spark):
    return lambda name: spark.read.parquet(f"{SMOKE}/{name}.parquet")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, repeated rows, and columns whose names operators might use."""
    long = " ".join(f"word{i} of the long text number {i % 97}" for i in range(20_000))
    texts = [(1, None), (2, ""), (3, "  \n "), (4, long), (5, "one two"), (6, "one two"), (6, "one two"), (None, "no id here"), (8, long + " more")]
    rows = [Row(doc_id=i, text=t, lang=None, source="s", n_chars=None if t is None else len(t)) for i, t in texts]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    extra = {name: F.lit(None).cast("string") for name in ("words", "key", "label", "_id", "bucket", "score", "node", "spans", "_row2")}
    return spark.createDataFrame(rows, schema).withColumns(extra)
