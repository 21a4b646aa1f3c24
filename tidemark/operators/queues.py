"""Caches by content, readiness, queues with reasons, stopping at the first hit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def content_key(*parts: Column) -> Column:
    """md5 over the parts with a separator that no part holds; null counts as ''."""
    return F.md5(F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def misses(wanted: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """The distinct keys that the cache lacks."""
    return wanted.filter(F.col(key).isNotNull()).dropDuplicates([key]).join(cache.select(key), key, "left_anti")


def readiness(wanted: DataFrame, cache: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each wanted row with ``ready``: cached or to_do."""
    held = cache.select(*keys).distinct().withColumn("_hit", F.lit(True))
    return wanted.join(held, list(keys), "left").withColumn("ready", F.when(F.col("_hit"), "cached").otherwise("to_do")).drop("_hit")


def work_queue(current: DataFrame, done: DataFrame, key: str, member: str, extra_reason: Column | None = None) -> DataFrame:
    """(key, set_hash, n, reason, priority) of every key whose members changed since it was done.

    ``current``: key, member; ``done``: key, set_hash, status, n_cached. Reasons in order of priority: pending (left open),
    new (never done), changed (another set of members), incomplete (fewer results than members); others are up to date and left
    out."""
    from tidemark.operators.aggregates import set_hash

    sets = current.groupBy(key).agg(set_hash(F.col(member).cast("string")).alias("set_hash"), F.count_distinct(member).alias("n"))
    joined = sets.join(done.select(key, F.col("set_hash").alias("_hash"), F.col("status").alias("_status"), F.col("n_cached").alias("_cached")), key, "left")
    reason = (
        F.when(F.col("_status") == "pending", "pending").when(F.col("_hash").isNull(), "new").when(F.col("_hash") != F.col("set_hash"), "changed")
        .when(F.coalesce("_cached", F.lit(0)) < F.col("n"), "incomplete")
    )
    rank = F.array_position(F.array(*[F.lit(x) for x in ("pending", "new", "changed", "incomplete")]), F.col("reason"))
    return joined.withColumn("reason", reason).filter("reason is not null").withColumn("priority", rank.cast("int")).select(key, "set_hash", "n", "reason", "priority")


def first_hit(results: DataFrame, key: str, order: Sequence[str], positive: Column, failed: Column) -> DataFrame:
    """What a run that stops at the first positive would report: (key, outcome, hit): 1 with the hit's place in ``order``, else
    retry if something failed, else 0."""
    at = F.min(F.when(positive, F.struct(*order)))
    per = results.groupBy(key).agg(at.alias("hit"), F.count_if(F.coalesce(failed, F.lit(False))).alias("_failed"))
    return per.select(key, F.when(F.col("hit").isNotNull(), "1").when(F.col("_failed") > 0, "retry").otherwise("0").alias("outcome"), "hit")


def priority_rollup(rows: DataFrame, key: str, label: str, ranking: Sequence[str], order: Sequence[str]) -> DataFrame:
    """(key, label, representative): the label that comes first in ``ranking``, and the first row that bears it."""
    rank = F.array_position(F.array(*[F.lit(x) for x in ranking]), F.col(label))
    rank = F.when(F.coalesce(rank, F.lit(0)) > 0, rank).otherwise(len(ranking) + 1)
    best = F.min(F.struct(rank.alias("k"), F.col(label).alias("label"), *[F.col(c) for c in order]))
    return rows.groupBy(key).agg(best.alias("b")).select(key, F.col("b.label").alias(label), *[F.col(f"b.{c}").alias(c) for c in order])


def drop_prefix(cache: DataFrame, key: str, prefixes: DataFrame, prefix: str) -> DataFrame:
    """The cache without entries whose key begins with one of the prefixes up to its first '|'."""
    return cache.withColumn("_p", F.split_part(F.col(key), F.lit("|"), F.lit(1))).join(prefixes.select(F.col(prefix).alias("_p")), "_p", "left_anti").drop("_p")
