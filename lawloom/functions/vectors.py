"""Vector arithmetic on array columns, in double precision."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def unit(v: Column) -> Column:
    """The vector at length one; a zero vector is left as it is."""
    def scaled(pair: Column) -> Column:
        return F.transform(
            pair["v"], lambda x: F.when(pair["n"] > 0, x.cast("double") / pair["n"]).otherwise(x.cast("double"))
        )

    held = F.transform(F.array(F.struct(v.alias("v"), norm(v).alias("n"))), scaled)
    return F.element_at(held, 1)
