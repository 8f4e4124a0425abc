"""Writers: tables, exports by congress, appended stage sets, manifests."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lawloom.functions.fields import stamp_text
from lawloom.session import cut_lineage

ROWS_PER_FILE = 1_000_000


def reset_table(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """Create an empty table with a declared schema, replacing what was there."""
    spark.createDataFrame([], schema).write.mode("overwrite").format("parquet").saveAsTable(name)


def create_table(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """Create an empty table unless it exists."""
    if not spark.catalog.tableExists(name):
        reset_table(spark, name, schema)


def stamps_as_text(df: DataFrame) -> DataFrame:
    """Top-level timestamps as text, as export files hold them."""
    stamps = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    return df.withColumns({c: stamp_text(F.col(c)) for c in stamps})


def export_by(
    df: DataFrame,
    path: str,
    order: Sequence[str],
    split: str = "congress_num",
    rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """One folder per split, rows in key order across and within its files.

    Ranges of (split, order) are spread over all tasks, so a large split is written by many of them.
    Range bounds are sampled from rows that are written first, so what made the rows runs once.
    """
    keys = [split, *[c for c in order if c != split]]
    (
        cut_lineage(stamps_as_text(df))
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(split)
        .parquet(path)
    )


def nested_as_json(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.to_json(c) for c in columns})


def table_name(stage: str) -> str:
    """SQL table name of a stage."""
    return stage.replace("-", "_")


def append_stage(df: DataFrame, stage: str, nested: Sequence[str] = (), path: str | None = None) -> str:
    """Append a stage to the table of the same name, nested columns as JSON text.

    `path` keeps the table's files in a folder of one's own instead of the warehouse.
    """
    name = table_name(stage)
    writer = nested_as_json(df, nested).write.mode("append").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return name


def append_stage_jdbc(df: DataFrame, stage: str, url: str, nested: Sequence[str] = (), **options: str) -> str:
    """Append a stage to an external SQL table; writes run in parallel, one connection per task."""
    name = table_name(stage)
    nested_as_json(df, nested).write.mode("append").options(**options).jdbc(url, name)
    return name


def manifest(df: DataFrame, split: str, key: str, path_format: str) -> DataFrame:
    """One row per split: its data path, row count and key range."""
    return (
        df.groupBy(split)
        .agg(F.count("*").alias("n_rows"), F.min(key).alias("min_key"), F.max(key).alias("max_key"))
        .withColumn("path", F.format_string(path_format, F.col(split).cast("string")))
    )


def feature_list(schema: T.StructType) -> list[dict]:
    """Schema as nested feature entries: name with dtype, struct or list."""
    def kind(dtype: T.DataType) -> dict:
        if isinstance(dtype, T.StructType):
            return {"struct": feature_list(dtype)}
        if isinstance(dtype, T.ArrayType):
            inner = kind(dtype.elementType)
            return {"list": inner.get("struct", inner)}
        names = {"int": "int32", "bigint": "int64", "float": "float32", "double": "float64"}
        return {"dtype": names.get(dtype.simpleString(), dtype.simpleString())}

    return [{"name": f.name, **kind(f.dataType)} for f in schema.fields]


def write_manifest(spark: SparkSession, splits: DataFrame, schema: T.StructType, path: str) -> None:
    """Manifest rows and the feature list as JSON files; there are only as many rows as splits."""
    splits.coalesce(1).write.mode("overwrite").json(f"{path}/splits")
    features = spark.createDataFrame([(json.dumps(feature_list(schema)),)], "value string")
    features.coalesce(1).write.mode("overwrite").text(f"{path}/features")


def model_tag(model: str) -> str:
    return model.replace("/", "-")


def chunk_tag(size: int, overlap: int) -> str:
    return f"chunks-s{size}-o{overlap}"


def vector_tag(size: int, overlap: int, model: str) -> str:
    return f"vecs-s{size}-o{overlap}-{model_tag(model)}"


def index_name(model: str, congresses: Sequence[int], size: int, overlap: int, prefix: str = "usc") -> str:
    """Index name: congress span, chunk settings, and the model's last path part with dots as `p`."""
    short = model.split("/")[-1].replace(".", "p")
    return f"{prefix}-{congresses[0]}to{congresses[-1]}-s{size}-o{overlap}-{short}"
