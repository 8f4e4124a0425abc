import pytest
from lawloom.constants import PARTY_NAMES
from lawloom.schemas import MEMBERS, VECTORS
from lawloom.sources import sinks
from lawloom.sources.members import filter_members, member_rows, read_members
from pyspark.sql import functions as F

CSV = """chamber,congress,icpsr,state_icpsr,district_code,party_code,bioguide_id,nominate_dim1,nominate_dim2,nominate_log_likelihood,nominate_geo_mean_probability,nominate_number_of_votes,nominate_number_of_errors,conditional,nokken_poole_dim1,nokken_poole_dim2
House,117,1,81,2,100,M001,0.1,0.2,-3.5,0.9,100,3,,0.3,0.4
President,117,2,0,0,200,P001,0.1,0.2,,,,,,,
,117,3,0,1,9999,X001,0.1,0.2,,,,,,,
Senate,117,4,0,0,328,S001,,0.2,,,,,,,
House,117,5,0,3,200,,0.5,0.6,,,,,,,
"""


@pytest.fixture(scope="module")
def members(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("csv") / "members.csv"
    path.write_text(CSV)
    return read_members(spark, str(path))


def test_scan(members):
    assert members.schema == MEMBERS and members.count() == 5
    assert members.where("icpsr = 1").first()["nominate_number_of_votes"] == 100.0


def test_filters(members):
    assert sorted(r["icpsr"] for r in filter_members(members).collect()) == [1, 3, 5]  # a missing chamber stays
    assert sorted(r["icpsr"] for r in filter_members(members, drop_president=False).collect()) == [1, 2, 3, 5]


def test_rows(members):
    rows = {r["icpsr"]: r for r in member_rows(members).collect()}
    assert rows[1]["row_id"] == "117-M001-1-2" and rows[5]["row_id"] == "117-nan-5-3"
    assert rows[1]["party_name"] == PARTY_NAMES[100] and rows[3]["party_name"] is None
    assert rows[1]["bioguide_url"].endswith("/M001") and rows[5]["bioguide_url"] is None


def test_names():
    assert sinks.index_name("org/model-small-v1.5", [113, 118], 1024, 256) == "usc-113to118-s1024-o256-model-small-v1p5"
    assert sinks.vector_tag(1024, 256, "org/model") == "vecs-s1024-o256-org-model"
    assert sinks.table_name("chunks-s1024-o256") == "chunks_s1024_o256"


def test_tables(spark):
    sinks.reset_table(spark, "t_members", MEMBERS)
    assert spark.table("t_members").schema == MEMBERS
    spark.createDataFrame([(1,)], "a int").write.mode("overwrite").saveAsTable("t_kept")
    sinks.create_table(spark, "t_kept", MEMBERS)
    assert spark.table("t_kept").count() == 1
    nested = spark.createDataFrame([(1, (2, None))], "id int, m struct<a:int,b:string>")
    for _ in range(2):
        name = sinks.append_stage(nested, "stage-one", ["m"])
    assert [r["m"] for r in spark.table(name).collect()] == ['{"a":2}'] * 2


def test_export_order_and_spread(spark, tmp_path):
    df = spark.range(5000).select((F.col("id") % 2).cast("int").alias("congress_num"), (F.col("id") * 31 % 5000).alias("n"))
    path = str(tmp_path / "x")
    sinks.export_by(df, path, ["n"], rows_per_file=700)
    back = spark.read.parquet(path)
    assert back.count() == 5000
    spans = back.withColumn("f", F.input_file_name()).groupBy("congress_num", "f").agg(F.min("n").alias("a"), F.max("n").alias("b"), F.count("*").alias("c"))
    rows = sorted(map(tuple, spans.select("congress_num", "a", "b", "c").collect()))
    assert len(rows) >= 8 and max(r[3] for r in rows) <= 700
    assert all(x[2] < y[1] for x, y in zip(rows, rows[1:]) if x[0] == y[0])  # files hold key ranges
    pruned = back.where("congress_num = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(congress_num" in pruned


def test_manifest_features():
    features = sinks.feature_list(VECTORS)
    assert features[0] == {"name": "chunk_id", "dtype": "string"}
    assert features[-1] == {"name": "vec", "list": {"dtype": "float32"}}
    meta = next(f for f in features if f["name"] == "metadata")
    assert {"name": "start_index", "dtype": "int32"} in meta["struct"]


def test_manifest_files(spark, tmp_path):
    df = spark.createDataFrame([(117, "a"), (117, "c"), (118, "b")], "congress_num int, k string")
    rows = sinks.manifest(df, "congress_num", "k", "data/%s.parquet")
    sinks.write_manifest(spark, rows, df.schema, str(tmp_path / "m"))
    back = {r["congress_num"]: (r["n_rows"], r["min_key"], r["max_key"], r["path"]) for r in spark.read.json(str(tmp_path / "m/splits")).collect()}
    assert back == {117: (2, "a", "c", "data/117.parquet"), 118: (1, "b", "b", "data/118.parquet")}
    assert '"name": "k", "dtype": "string"' in spark.read.text(str(tmp_path / "m/features")).first()[0]
