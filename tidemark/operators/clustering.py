"""Groups of linked records: connected components, and greedy clusters that never unite records barred from one another."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import Scratch


def connected_components(edges: DataFrame, left: str, right: str, max_rounds: int = 60) -> DataFrame:
    """(id, component) with the smallest id of each component, by alternating large and small stars.

    Edges point from larger to smaller ids and are re-hung on the smallest neighbour until nothing moves; their
    number never grows, minima combine before the shuffle, and every round is a written table. Nulls and loops link
    nothing; only linked ids are returned."""
    scratch = Scratch(edges.sparkSession)
    l, r = F.col(left), F.col(right)
    linked = edges.filter(l.isNotNull() & r.isNotNull() & (l != r)).select(F.greatest(l, r).alias("a"), F.least(l, r).alias("b"))
    state, mark = scratch.keep(linked.distinct(), "edges"), None
    for _ in range(max_rounds):
        ways = state.select(F.inline(F.array(F.struct(F.col("a").alias("v"), F.col("b").alias("u")), F.struct(F.col("b").alias("v"), F.col("a").alias("u")))))
        lows = ways.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        large = ways.filter("u > v").join(lows, "v").select(F.col("u").alias("a"), F.col("m").alias("b")).distinct()
        small_low = large.groupBy("a").agg(F.min("b").alias("m"))
        met = large.join(small_low, "a")
        small = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small_low.select("a", F.col("m").alias("b"))).filter("a != b").distinct()
        new = scratch.keep(small, "stars")
        seen = tuple(new.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        scratch.drop(state)
        state = new
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError(f"not stable after {max_rounds} rounds")
    stars = state.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("id"), "component").distinct())


def _greedy(edges: list[tuple], barred: dict) -> tuple[dict, list[tuple], list[tuple]]:
    """Unites along edges (l, r, p) from the most probable down unless both sides hold a common exclusion id."""
    parent, members, ids = {}, {}, {}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for l, r, _ in edges:
        for x in (l, r):
            if x not in parent:
                parent[x], members[x], ids[x] = x, [x], set(barred.get(x, ()))
    accepted, blocked = [], []
    for l, r, p in sorted(edges, key=lambda e: (-e[2], e[0], e[1])):
        a, b = find(l), find(r)
        if a == b:  # already one group: such an edge unites nothing and is nobody's provenance
            continue
        shared = ids[a] & ids[b]
        if shared:
            blocked.append((l, r, p, ",".join(sorted(map(str, shared)))))
            continue
        if len(members[a]) < len(members[b]):
            a, b = b, a
        parent[b] = a
        members[a] += members.pop(b)
        ids[a] |= ids.pop(b)
        accepted.append((l, r, p))
    return {x: find(x) for x in parent}, accepted, blocked


def _provenance(cluster: list, links: dict) -> list[tuple]:
    """(member, linked from, probability) breadth first from the smallest member, neighbours in order."""
    root = min(cluster)
    out, queue, seen = [(root, None, None)], [root], {root}
    while queue:
        x = queue.pop(0)
        for y in sorted(links.get(x, {})):
            if y not in seen:
                seen.add(y)
                queue.append(y)
                out.append((y, x, links[x][y]))
    return out


def constrained_clusters(edges: DataFrame, left: str, right: str, probability: str, exclusions: DataFrame | None = None, threshold: float = 0.0) -> dict[str, DataFrame]:
    """clusters (cluster_id, member_id, linked_from, linked_prob), blocked (id_l, id_r, match_probability,
    shared_exclusion_ids) and sizes (cluster_id, n).

    Greedy over the edges by probability, then ids; two groups are not united if they share an exclusion id
    (``exclusions``: member_id, exclusion_id). The order only matters within a connected component, so components
    are found first, distributed, and each runs alone. A component is sequential by nature and one task's work;
    raise ``threshold`` if one grows beyond that. The cluster id is the smallest member."""
    spark = edges.sparkSession
    scratch = Scratch(spark)
    kind = edges.schema[left].dataType.simpleString()
    l, r = F.col(left), F.col(right)
    clean = edges.filter(l.isNotNull() & r.isNotNull() & (l != r) & (F.col(probability) >= threshold))
    clean = clean.groupBy(F.least(l, r).alias("l"), F.greatest(l, r).alias("r")).agg(F.max(probability).cast("double").alias("p"))
    clean = scratch.keep(clean, "edges")
    part = connected_components(clean, "l", "r")
    work = clean.join(part.select(F.col("id").alias("l"), "component"), "l").select("component", "l", "r", "p", F.lit(None).cast("string").alias("x"))
    if exclusions is not None:
        own = exclusions.filter(F.col("exclusion_id").isNotNull()).select(F.col("member_id").alias("id"), F.col("exclusion_id").cast("string").alias("x")).distinct()
        held = own.join(part, "id").select("component", F.col("id").alias("l"), F.lit(None).cast(kind).alias("r"), F.lit(None).cast("double").alias("p"), "x")
        work = work.unionByName(held)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        links = pdf[pdf["r"].notna()]
        barred: dict = {}
        for i, x in zip(*[pdf.loc[pdf["x"].notna(), c] for c in ("l", "x")]):
            barred.setdefault(i, set()).add(x)
        root, accepted, blocked = _greedy(list(zip(links["l"], links["r"], links["p"])), barred)
        neighbours: dict = {}
        for a, b, p in accepted:
            neighbours.setdefault(a, {})[b] = p
            neighbours.setdefault(b, {})[a] = p
        groups: dict = {}
        for x, top in root.items():
            groups.setdefault(top, []).append(x)
        rows = []
        for cluster in groups.values():
            rows += [("member", min(cluster), m, f, p, None) for m, f, p in _provenance(cluster, neighbours)]
        rows += [("blocked", a, b, None, p, s) for a, b, p, s in blocked]
        return pd.DataFrame(rows, columns=["what", "a", "b", "c", "p", "x"])

    done = scratch.keep(work.groupBy("component").applyInPandas(run, f"what string, a {kind}, b {kind}, c {kind}, p double, x string"), "clusters")
    clusters = done.filter("what = 'member'").select(F.col("a").alias("cluster_id"), F.col("b").alias("member_id"), F.col("c").alias("linked_from"), F.col("p").alias("linked_prob"))
    blocked = done.filter("what = 'blocked'").select(F.col("a").alias("id_l"), F.col("b").alias("id_r"), F.col("p").alias("match_probability"), F.col("x").alias("shared_exclusion_ids"))
    return {"clusters": clusters, "blocked": blocked, "sizes": clusters.groupBy("cluster_id").agg(F.count("*").alias("n"))}


def exclusion_lists(blocked: DataFrame) -> DataFrame:
    """(id, exclusion_ids): both directions of the blocked edges, for a second pass that never pairs them."""
    both = F.inline(F.array(F.struct(F.col("id_l").alias("id"), F.col("id_r").alias("x")), F.struct(F.col("id_r").alias("id"), F.col("id_l").alias("x"))))
    return blocked.select(both).groupBy("id").agg(F.array_sort(F.collect_set("x")).alias("exclusion_ids"))
