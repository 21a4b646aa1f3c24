"""Entities and their canonical records from clusters of rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.categories import WEAPON_FAMILY, WEAPON_PRIORITY, family
from tidemark.operators.aggregates import best_row, grouped_mode, joined_set, mean_of_modes, modal_value, specific_mode


def members(clusters: DataFrame, rows: DataFrame, cluster: str, member: str, row_id: str) -> DataFrame:
    """Every row with its entity id: the cluster's, or its own if it is in none."""
    slim = clusters.select(F.col(cluster).alias("entity_id"), F.col(member).alias(row_id))
    return rows.join(slim, row_id, "left").withColumn("entity_id", F.coalesce("entity_id", F.col(row_id)))


def entity_view(rows: DataFrame, key: str, modes: Sequence[str], days: str | None = None) -> DataFrame:
    """(key, n, first and last day, modal value of each column)."""
    extra = [F.min(days).alias("min_event_day"), F.max(days).alias("max_event_day")] if days else []
    out = rows.groupBy(key).agg(F.count("*").alias("n"), *extra)
    for c in modes:
        out = out.join(modal_value(rows, [key], c), key, "left")
    return out


def canonical_date(rows: DataFrame, key: str, date: str, midpoint: str, precision: str) -> DataFrame:
    """(key, date_precision, date, midpoint): from the rows of the best precision (day, month, year), the modal date and
    midpoint."""
    level = F.when(F.col(precision) == "day", 1).when(F.col(precision) == "month", 2).when(F.col(precision) == "year", 3)
    best = rows.filter(level.isNotNull()).groupBy(key).agg(F.min(level).alias("_best"))
    chosen = rows.join(best, key).filter(level == F.col("_best"))
    name = F.when(F.col("_best") == 1, "day").when(F.col("_best") == 2, "month").otherwise("year").alias("date_precision")
    out = best.select(key, name)
    return out.join(modal_value(chosen, [key], date), key, "left").join(modal_value(chosen, [key], midpoint), key, "left")


def canonical_records(rows: DataFrame, key: str, row_id: str, modes: Sequence[str], dates: tuple[str, str, str], articles: str, place_order: Sequence[Column], place: Sequence[str], weapon: str = "weapon", relationship: str = "relationship", age: str = "offender_age") -> DataFrame:
    """One record per entity: size, modes, date of the best precision, weapon by family, most specific relationship, mean of
    the modal offender ages, the best place, article ids. Each part is an aggregation of its own, joined by the key."""
    out = rows.groupBy(key).agg(F.count("*").alias("n_members"), joined_set(articles).alias("article_ids_csv"))
    parts: list[DataFrame] = [modal_value(rows, [key], c) for c in modes]
    parts.append(canonical_date(rows, key, *dates))
    parts.append(grouped_mode(rows, [key], weapon, family(F.col(weapon), WEAPON_FAMILY), WEAPON_PRIORITY))
    parts.append(specific_mode(rows, [key], relationship))
    parts.append(mean_of_modes(rows, [key], age))
    parts.append(best_row(rows, [key], [*place_order, F.col(row_id)]).select(key, *place))
    for p in parts:
        out = out.join(p, key, "left")
    return out


def integrate(entities: DataFrame, added: DataFrame, key: str, sums: Sequence[str], lows: Sequence[str], highs: Sequence[str], sets: Mapping[str, str]) -> DataFrame:
    """Entities with newly matched rows worked in (sizes add up, days widen, csv sets unite); rows of new keys become entities
    of their own. Only affected keys are recomputed: the union is aggregated by key once."""
    from tidemark.functions.text import csv_members

    both = entities.select(key, *sums, *lows, *highs, *sets).unionByName(added.select(key, *sums, *lows, *highs, *sets))
    aggs = [F.sum(c).alias(c) for c in sums] + [F.min(c).alias(c) for c in lows] + [F.max(c).alias(c) for c in highs]
    aggs += [F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(csv_members(F.col(c)))))), ",").alias(c) for c in sets]
    return both.groupBy(key).agg(*aggs)


def apply_overrides(overrides: DataFrame, entities: DataFrame, orphans: DataFrame, machine: DataFrame) -> DataFrame:
    """Each manual link with its status: missing_entity, missing_orphan, duplicate (an earlier one of the orphan counts),
    already_matched (the machine linked it so), conflict (the machine linked it elsewhere) or applied."""
    first = F.row_number()
    from pyspark.sql import Window

    order = overrides.withColumn("_n", first.over(Window.partitionBy("orphan_id").orderBy("decided_at", "entity_id")))
    known_e = entities.select("entity_id").distinct().withColumn("_e", F.lit(True))
    known_o = orphans.select("orphan_id").distinct().withColumn("_o", F.lit(True))
    linked = machine.groupBy("orphan_id").agg(F.min("entity_id").alias("_machine"))
    joined = order.join(known_e, "entity_id", "left").join(known_o, "orphan_id", "left").join(linked, "orphan_id", "left")
    status = (
        F.when(F.col("_o").isNull(), "missing_orphan").when(F.col("_e").isNull(), "missing_entity").when(F.col("_n") > 1, "duplicate")
        .when(F.col("_machine") == F.col("entity_id"), "already_matched").when(F.col("_machine").isNotNull(), "conflict").otherwise("applied")
    )
    return joined.withColumn("status", status).drop("_n", "_e", "_o", "_machine")


def merge_links(machine: DataFrame, applied: DataFrame) -> DataFrame:
    """Machine links first, then applied manual ones of orphans the machine left alone, with their origin."""
    own = machine.select("orphan_id", "entity_id", F.lit("machine").alias("origin"))
    more = applied.filter("status = 'applied'").join(own.select("orphan_id"), "orphan_id", "left_anti")
    return own.unionByName(more.select("orphan_id", "entity_id", F.lit("manual").alias("origin")))


def member_union(named: DataFrame, matched: DataFrame, clusters: DataFrame, single: DataFrame) -> DataFrame:
    """(entity_id, member_id, origin): the rows that make up each final entity. ``named`` and ``matched`` are (entity_id,
    member_id); ``clusters`` (cluster_id, member_id) become entities under their smallest member where they have two members or
    more; ``single`` (member_id) are entities of their own. A member named twice under one entity counts once."""
    sizes = clusters.groupBy("cluster_id").agg(F.min("member_id").alias("entity_id"), F.count_distinct("member_id").alias("_n")).filter("_n >= 2")
    parts = [
        named.select("entity_id", "member_id", F.lit("named").alias("origin")),
        matched.select("entity_id", "member_id", F.lit("matched").alias("origin")),
        clusters.join(sizes, "cluster_id").select("entity_id", "member_id", F.lit("cluster").alias("origin")),
        single.select(F.col("member_id").alias("entity_id"), "member_id", F.lit("single").alias("origin")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("entity_id", "member_id").agg(F.min("origin").alias("origin"))
