"""Training, validation and test texts out of unified bills."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lawloom.constants import HELD_OUT_CONGRESS, TRAIN_CONGRESSES
from lawloom.functions.text import strip_spaces
from lawloom.operators.numbering import number_rows


def latest_text(tvs: Column) -> Column:
    """Stripped text of the first version; empty when there is none."""
    return F.coalesce(strip_spaces(F.get(tvs, 0)["tv_txt"]), F.lit(""))


def latest_url(tvs: Column) -> Column:
    return F.when(F.size(tvs) > 0, F.get(tvs, 0)["bs_tv"]["url"]).otherwise(F.lit(""))


def text_rows(unified: DataFrame, tvs: str = "tvs", keep: Sequence[str] = ()) -> DataFrame:
    """legis_id, url, text of every bill's first version, bills without text included."""
    return unified.select(
        "legis_id", *keep, latest_url(F.col(tvs)).alias("url"), latest_text(F.col(tvs)).alias("text")
    )


def assign_splits(
    df: DataFrame,
    key: str = "legis_id",
    split: str = "congress_num",
    order: Sequence[str] = ("legis_type", "legis_num"),
    train: Sequence[int] = TRAIN_CONGRESSES,
    held_out: int = HELD_OUT_CONGRESS,
) -> DataFrame:
    """Add `split`: train for the training congresses; in the held-out one, even rows are validation
    and odd rows test, counted in export order. Other congresses drop.

    Only keys of the held-out congress are numbered; texts move once, in the join on the key.
    """
    trained = df.where(F.col(split).isin(*train)).withColumn("split", F.lit("train"))
    held = df.where(F.col(split) == held_out)
    by = [F.col(c) for c in (*order, key)]
    numbered = number_rows(held.select(key, *[c for c in order if c != key]), by, name="__row")
    side = numbered.select(
        key, F.when(F.col("__row") % 2 == 0, "validation").otherwise("test").alias("split")
    )
    return trained.unionByName(held.join(side, key))


def drop_empty_text(df: DataFrame, text: str = "text") -> DataFrame:
    """Parity is taken before this filter, so call it after `assign_splits`."""
    return df.where(F.length(text) > 0)


def write_splits(df: DataFrame, path: str) -> None:
    """legis_id, url, text in one folder per split."""
    df.select("legis_id", "url", "text", "split").write.mode("overwrite").partitionBy("split").parquet(path)
