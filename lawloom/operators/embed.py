"""Attach a vector to every chunk's text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.sql import DataFrame, functions as F, types as T

from lawloom.constants import QUERY_INSTRUCTION, VECTOR_SIZE


def embed_hashing(df: DataFrame, text: str = "text", out: str = "vec", size: int = VECTOR_SIZE) -> DataFrame:
    """Hashed word counts at length one: needs no model, runs in the JVM, same text same vector."""
    rows = df.withColumn("__text", F.coalesce(text, F.lit("")))
    for stage in (
        RegexTokenizer(inputCol="__text", outputCol="__words", pattern=r"\s+"),
        HashingTF(inputCol="__words", outputCol="__counts", numFeatures=size),
        Normalizer(inputCol="__counts", outputCol="__unit", p=2.0),
    ):
        rows = stage.transform(rows)
    return rows.withColumn(out, vector_to_array("__unit", "float32")).drop("__text", "__words", "__counts", "__unit")


def embed_with(
    df: DataFrame,
    make_predict: Callable,
    text: str = "text",
    out: str = "vec",
    batch_size: int = 256,
    partitions: int | None = None,
) -> DataFrame:
    """Vectors from a model: `make_predict` loads it once per worker and returns batch -> matrix.

    Only the text enters the Python worker. Few large input files make few tasks; give `partitions`
    to spread the inference.
    """
    encode = predict_batch_udf(make_predict, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size)
    if partitions:
        df = df.repartition(partitions)
    return df.withColumn(out, encode(text))


def as_questions(df: DataFrame, text: str = "text", instruction: str = QUERY_INSTRUCTION) -> DataFrame:
    """Question texts with the instruction some encoders expect before a query."""
    return df.withColumn(text, F.concat(F.lit(instruction), text))
