"""Two clusterings of one set of records compared: unchanged, split, merged, reduced, extended, new, gone."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.aggregates import set_hash
from tidemark.operators.clustering import connected_components


def signatures(clusters: DataFrame, cluster: str, member: str) -> DataFrame:
    """(cluster, signature, n): equal for clusters of equal members."""
    return clusters.groupBy(cluster).agg(set_hash(F.col(member).cast("string")).alias("signature"), F.count_distinct(member).alias("n"))


def diff_clusters(old: DataFrame, new: DataFrame, cluster: str = "cluster_id", member: str = "member_id") -> DataFrame:
    """One row per cluster of either side that changed: side, cluster, n, kind, family.

    kind of an old cluster: gone (no member is in a new one), split (members in several new clusters), reduced (in one, but
    some in none), merged (in one, together with members of other old clusters), extended (in one, with members that are
    new), other (merged or extended as well as reduced or split). A new cluster with none of the old members is new, else it
    is named by its own view of the old ones the same way (merged = members of several old clusters). ``family``
    joins clusters that share members, directly or through others."""
    o = old.select(F.col(cluster).cast("string").alias("c"), F.col(member).cast("string").alias("m")).distinct()
    n = new.select(F.col(cluster).cast("string").alias("c"), F.col(member).cast("string").alias("m")).distinct()
    same = signatures(o, "c", "m").join(signatures(n, "c", "m").select("signature", "n"), ["signature", "n"], "left_semi").select("c")
    changed_old = o.join(same, "c", "left_anti")
    same_new = signatures(n, "c", "m").join(signatures(o, "c", "m").select("signature", "n"), ["signature", "n"], "left_semi").select("c")
    changed_new = n.join(same_new, "c", "left_anti")
    both = changed_old.withColumnRenamed("c", "oc").join(changed_new.withColumnRenamed("c", "nc"), "m", "full_outer")

    def view(side: str, mine: str, theirs: str) -> DataFrame:
        per = both.filter(F.col(mine).isNotNull()).groupBy(mine).agg(F.count("*").alias("n"), F.count_distinct(theirs).alias("others"), F.count_if(F.col(theirs).isNull()).alias("lost"))
        # What the one other cluster holds besides: members of further clusters, or members the other side lacks.
        met = both.filter(F.col(theirs).isNotNull()).groupBy(theirs).agg(F.count_distinct(mine).alias("owners"), F.count_if(F.col(mine).isNull()).alias("fresh"))
        best = both.filter(F.col(mine).isNotNull() & F.col(theirs).isNotNull()).select(mine, theirs).distinct().join(met, theirs)
        around = best.groupBy(mine).agg(F.max("owners").alias("owners"), F.max("fresh").alias("fresh"))
        joined = per.join(around, mine, "left").na.fill(0, ["owners", "fresh"])
        many, lost, shared, fresh = F.col("others") > 1, F.col("lost") > 0, F.col("owners") > 1, F.col("fresh") > 0
        if side == "old":
            kind = (
                F.when(F.col("others") == 0, "gone").when(many & ~lost & ~shared & ~fresh, "split").when(~many & lost & ~shared & ~fresh, "reduced")
                .when(~many & ~lost & shared & ~fresh, "merged").when(~many & ~lost & ~shared & fresh, "extended").otherwise("other")
            )
        else:
            kind = (
                F.when(F.col("others") == 0, "new").when(many & ~lost & ~shared & ~fresh, "merged").when(~many & lost & ~shared & ~fresh, "extended")
                .when(~many & ~lost & shared & ~fresh, "split").when(~many & ~lost & ~shared & fresh, "reduced").otherwise("other")
            )
        return joined.select(F.lit(side).alias("side"), F.col(mine).alias("cluster"), "n", kind.alias("kind"))

    rows = view("old", "oc", "nc").unionByName(view("new", "nc", "oc"))
    links = both.filter("oc is not null and nc is not null").select(F.concat(F.lit("old:"), "oc").alias("a"), F.concat(F.lit("new:"), "nc").alias("b"))
    family = connected_components(links, "a", "b")
    keyed = rows.withColumn("id", F.concat_ws(":", "side", "cluster")).join(family, "id", "left")
    return keyed.select("side", "cluster", "n", "kind", F.coalesce("component", "id").alias("family"))


def banded(df: DataFrame, group: str, bands: int = 4) -> DataFrame:
    """``band``: a running number of the group modulo ``bands``, for alternating colours in a report of bounded size."""
    order = df.select(group).distinct().withColumn("band", ((F.dense_rank().over(Window.orderBy(group)) - 1) % bands).cast("int"))
    return df.join(order, group)
