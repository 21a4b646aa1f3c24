"""Vectors kept as arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Null for null, unequally long or zero vectors."""
    norms = F.sqrt(dot(a, a) * dot(b, b))
    return F.when((F.size(a) == F.size(b)) & (norms > 0), dot(a, b) / norms)


def vector_mean(df: DataFrame, key: str, vec: str) -> DataFrame:
    """(key, mean vector, n) over the vectors of a key; positions a shorter vector lacks count those that have them."""
    cells = df.filter(F.col(vec).isNotNull()).select(key, F.posexplode(vec).alias("pos", "x"))
    mean = cells.groupBy(key, "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    n = df.filter(F.col(vec).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return mean.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias(vec)).join(n, key)
