"""Consolidating pairwise matches into groups: hash-to-min on a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import Scratch


def hash_to_min(edges: DataFrame, left: str = "l", right: str = "r", hot_rows: int = 1_000_000, max_rounds: int = 60) -> DataFrame:
    """Connected components: (id, cluster_id) for every vertex of a component of two or more.

    Every vertex keeps a cluster set, at first its neighbours. In a round it sends the set to the set's smallest
    member and that member to all the others; after O(log n) rounds the smallest member of each component holds the
    whole component and everyone else only that member. Sets are rows (v, u), never arrays, so a component that
    holds a third of all vertices is spread over many tasks: the minimum combines before its shuffle, and the
    vertices whose sets exceed ``hot_rows`` rows, at most rows / hot_rows of them, are looked up by a broadcast
    of that proven size instead of being joined in one task. Every round is a written table.

    Defined cases: null ids and a record paired with itself link nothing; repeated and reversed pairs count once;
    no edges, no rows; ids are ordered by code point; other columns are ignored.
    """
    spark = edges.sparkSession
    scratch = Scratch(spark)
    l, r = F.col(f"`{left}`"), F.col(f"`{right}`")
    clean = edges.filter(l.isNotNull() & r.isNotNull() & (l != r)).select(F.least(l, r).alias("a"), F.greatest(l, r).alias("b")).distinct()
    both = F.inline(F.array(F.struct(F.col("a").alias("v"), F.col("b").alias("u")), F.struct(F.col("b").alias("v"), F.col("a").alias("u"))))
    state = scratch.keep(clean.select(both), "edges")
    for _ in range(max_rounds):
        mins = scratch.keep(state.groupBy("v").agg(F.least(F.col("v"), F.min("u")).alias("m"), F.count("*").alias("n")), "min")
        loose = F.count_if((F.col("v") != F.col("m")) & (F.col("n") > 1))  # vertices that know more than their minimum
        seen = mins.agg(F.max("n"), F.sum("n"), loose).first()
        if seen[1] is None or (not seen[2] and _settled(mins)):
            break
        if seen[0] > hot_rows:
            hot = F.broadcast(mins.filter(F.col("n") > hot_rows).select("v", "m"))  # at most rows / hot_rows
            known = state.join(hot, "v").unionByName(state.join(hot, "v", "left_anti").join(mins.filter(F.col("n") <= hot_rows).select("v", "m"), "v"))
        else:
            known = state.join(mins.select("v", "m"), "v")
        # (v, u, m): m learns u, u learns m; and v itself is one of the set's others.
        sent = known.select(F.inline(F.array(F.struct(F.col("m").alias("v"), F.col("u").alias("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))))
        own = mins.filter(F.col("v") != F.col("m")).select(F.inline(F.array(F.struct(F.col("m").alias("v"), F.col("v").alias("u")), F.struct(F.col("v").alias("v"), F.col("m").alias("u")))))
        new = scratch.keep(sent.unionByName(own).filter("v != u").distinct(), "state")
        scratch.drop(state)
        scratch.drop(mins)
        state = new
    else:
        raise RuntimeError(f"not stable after {max_rounds} rounds")
    return mins.select(F.col("v").alias("id"), F.col("m").alias("cluster_id"))


def _settled(mins: DataFrame) -> bool:
    """Where every vertex but the minima knows one other only: whether that one is a minimum each time. Then each component is
    a star (a round never parts what is linked), and another round changes nothing."""
    roots = mins.filter("v = m").select(F.col("v").alias("m"))
    return mins.filter("v != m").select("m").distinct().join(roots, "m", "left_anti").isEmpty()
