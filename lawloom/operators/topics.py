"""Optional producers of the projection points and topic labels that exports take as input."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F


def project_2d(df: DataFrame, vec: str = "vec") -> DataFrame:
    """First two principal components as x and y. The fit moves one d-by-d matrix, not the rows."""
    points = df.withColumn("__v", array_to_vector(F.col(vec).cast("array<double>")))
    model = PCA(k=2, inputCol="__v", outputCol="__p").fit(points)
    xy = vector_to_array("__p")
    return model.transform(points).withColumns({"x": xy[0], "y": xy[1]}).drop("__v", "__p")


def nested_topics(
    df: DataFrame, vec: str = "vec", sizes: tuple[int, int, int] = (4, 8, 16), seed: int = 7
) -> DataFrame:
    """Three nested topic labels per row.

    The finest topics come from one clustering of the rows; their centres, of which there are only
    sizes[2], are clustered again for the two coarser levels.
    """
    spark = df.sparkSession
    points = df.withColumn("__v", array_to_vector(F.col(vec).cast("array<double>")))
    model = KMeans(k=sizes[2], seed=seed, featuresCol="__v", predictionCol="__t3").fit(points)
    rows = model.transform(points)
    centres = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    level = spark.createDataFrame(centres, "__t3 int, centre array<double>")
    for name, k in (("__t2", sizes[1]), ("__t1", sizes[0])):
        held = level.withColumn("__c", array_to_vector("centre"))
        fitted = KMeans(k=min(k, len(centres)), seed=seed, featuresCol="__c", predictionCol=name).fit(held)
        level = fitted.transform(held).drop("__c")
        means = {i: [float(x) for x in c] for i, c in enumerate(fitted.clusterCenters())}
        table = spark.createDataFrame(list(means.items()), f"{name} int, __mean array<double>")
        # The next level clusters these means, so equal finer topics stay together.
        level = level.join(table, name).drop("centre").withColumnRenamed("__mean", "centre")
    labels = level.select("__t3", "__t2", "__t1")
    return rows.join(F.broadcast(labels), "__t3").select(
        *df.columns,
        F.format_string("topic-%d", "__t1").alias("topic_depth_1"),
        F.format_string("topic-%d-%d", "__t1", "__t2").alias("topic_depth_2"),
        F.format_string("topic-%d-%d-%d", "__t1", "__t2", "__t3").alias("topic_depth_3"),
    )
