"""Ranks, top lists with ties, batches that do not cut a group, permutations and strata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_with_ties(df: DataFrame, k: int, by: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows with one of the k largest values of ``by``, all of those tied with the k-th; null values are never among
    them. With ``keys``, per key. Without, the threshold comes from a top-k sort and the rest is a filter against
    that one row: no single-task window over the table."""
    if keys:
        w = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(by))
        return df.filter(F.col(by).isNotNull()).withColumn("_r", F.rank().over(w)).filter(F.col("_r") <= k).drop("_r")
    floor = df.filter(F.col(by).isNotNull()).select(by).orderBy(F.desc(by)).limit(k).agg(F.min(by).alias("_floor"))
    return df.crossJoin(F.broadcast(floor)).filter(F.col(by) >= F.col("_floor")).drop("_floor")


def batch_whole_groups(df: DataFrame, limit: int, order: Sequence[Column], group: str) -> DataFrame:
    """The first ``limit`` rows, and the rest of the groups among them."""
    first = df.orderBy(*order).limit(limit).select(group).distinct()  # at most `limit` rows
    return df.join(F.broadcast(first), group, "left_semi")


def latest(df: DataFrame, keys: Sequence[str], time: str, tie: str) -> DataFrame:
    """The row with the latest time per key, the largest ``tie`` among equals."""
    w = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(time), F.desc_nulls_last(tie))
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def permuted(df: DataFrame, key: str, seed: str = "0", name: str = "priority") -> DataFrame:
    """A repeatable random order: numbers from 1 by the hash of key and seed. The numbers come from a range sort and
    per-partition offsets, not from one task."""
    hashed = df.withColumn("_h", F.md5(F.concat(F.col(key).cast("string"), F.lit("|" + seed))))
    return numbered(hashed, ["_h", key], name).drop("_h")


def numbered(df: DataFrame, order: Sequence[str], name: str = "n") -> DataFrame:
    """Row numbers from 1 over the whole table in ``order``: rows are range-partitioned, numbered within partitions,
    and shifted by the partitions' running counts (one row per partition)."""
    spread = df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order]).sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order])
    spread = spread.withColumn("_id", F.monotonically_increasing_id())
    # The id is the partition in the upper bits and the row in the lower 33.
    part = spread.withColumn("_p", F.shiftright("_id", 33)).withColumn("_i", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)))
    before = F.coalesce(F.sum("_c").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = part.groupBy("_p").agg(F.count("*").alias("_c")).withColumn("_before", before).select("_p", "_before")
    return part.join(F.broadcast(offsets), "_p").withColumn(name, (F.col("_before") + F.col("_i") + 1).cast("bigint")).drop("_p", "_i", "_id", "_before")


def stratified(df: DataFrame, strata: Sequence[str], per: int, key: str, seed: str = "0") -> DataFrame:
    """At most ``per`` rows of each stratum, chosen by the hash of key and seed."""
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit("|" + seed)))
    w = Window.partitionBy(*strata).orderBy(h, key)
    return df.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= per).drop("_n")


def first_keys(df: DataFrame, key: str, n: int, order: Sequence[Column]) -> DataFrame:
    """Rows whose key is among the first n distinct keys in ``order``."""
    keys = df.select(key).distinct().orderBy(*order).limit(n)  # n rows
    return df.join(F.broadcast(keys), key, "left_semi")
