"""Candidates for a review: scored, merged over the records of a group, gated by top lists whose ties are kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Weights of a candidate's score (fixed values): start, each agreeing attribute, cosine of the summaries, each day apart.
START, PER_MATCH, PER_COSINE, PER_DAY = 1.2, 0.8, 1.7, -0.01
#: How many candidates pass the gate, over all and for each anchor text (fixed values).
TOP, TOP_PER_ANCHOR = 5, 3


def score(matches: Sequence[Column], cosine: Column, days: Column) -> Column:
    """Attributes that are unknown on a side agree with nothing; an unknown cosine adds nothing."""
    agreeing = sum((F.coalesce(m.cast("int"), F.lit(0)) for m in matches), F.lit(0))
    return F.lit(START) + PER_MATCH * agreeing + PER_COSINE * F.coalesce(cosine, F.lit(0.0)) + PER_DAY * days


def merge(rows: DataFrame, keys: Sequence[str], by: str = "score", weight: str = "weight", variant: str = "variant", tie: str = "record") -> DataFrame:
    """One row per candidate (``keys``) of those the records of a group brought up: the content of the best-scored row
    (ties: the smallest ``tie``), the largest ``weight``, and every ``variant`` it was found by. All are aggregates
    that combine before the shuffle."""
    rest = [c for c in rows.columns if c not in (*keys, weight, variant)]
    best = F.min_by(F.struct(*rest), F.struct(-F.coalesce(F.col(by), F.lit(float("-inf"))), F.col(tie)))
    merged = rows.groupBy(*keys).agg(best.alias("_b"), F.max(weight).alias(weight), F.array_sort(F.collect_set(variant)).alias("variants"))
    return merged.select(*keys, "_b.*", weight, "variants")


def gate(candidates: DataFrame, group: Sequence[str], anchor: str, by: str = "score", weight: str = "weight", top: int = TOP, per_anchor: int = TOP_PER_ANCHOR) -> DataFrame:
    """The candidates among the ``top`` of their group by score or by weight, or among the ``per_anchor`` of their anchor by
    either, all ties with the last included. A missing weight ranks last and ties with the other missing ones."""
    low = float("-inf")
    keep = F.lit(False)
    for keys, k in ((group, top), ((*group, anchor), per_anchor)):
        for c in (by, weight):
            keep = keep | (F.rank().over(Window.partitionBy(*keys).orderBy(F.desc(F.coalesce(F.col(c), F.lit(low))))) <= k)
    return candidates.withColumn("_keep", keep).filter("_keep").drop("_keep")
