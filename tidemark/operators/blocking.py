"""Blocking rules compiled to equi-joins: keys on both sides, a residual condition, each pair by its first rule."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Records meet where all ``keys`` (SQL over a record) are equal and not null, and ``where`` (SQL over l.x, r.x) holds.
    Ranges and inequalities belong in ``where``; without any key a rule would compare everything and is refused.
    ``near``: a number (SQL over a record) and by how much it may differ at most in pairs that ``where`` lets pass. A block
    is then cut into cells as wide as that, and records only meet those of their own and the two adjacent cells."""

    name: str
    keys: tuple[str, ...]
    where: str = "true"
    near: tuple[str, float] | None = None


def date_bucket_rules(name: str, day: str, width: int, more: tuple[str, ...] = (), where: str = "true") -> tuple[Rule, Rule]:
    """Two rules that together let dates less than half a width apart meet: buckets, and buckets moved by half."""
    half = width // 2
    return (
        Rule(name, (*more, f"floor({day} / {width})"), where),
        Rule(f"{name}_shifted", (*more, f"floor(({day} + {half}) / {width})"), where),
    )


def _side(df: DataFrame, columns: Sequence[str], rule: Rule, side: str) -> DataFrame:
    """The records as structs beside their keys; columns beyond ``columns`` stay outside the struct, named by the side."""
    keys = [F.expr(k).alias(f"_k{i}") for i, k in enumerate(rule.keys)]
    if rule.near:
        # A little wider than the difference, so that rounding puts no pair two cells apart; ends are no cells' overflow.
        most = F.lit(2.0**61)
        cell = F.floor(F.greatest(F.least(F.expr(rule.near[0]).cast("double") / (rule.near[1] * 1.0001), most), -most)).cast("long")
        keys.append((cell if side == "l" else F.explode(F.sequence(cell - 1, cell + 1))).alias(f"_k{len(keys)}"))
    out = df.select(F.struct(*[F.col(c) for c in columns]).alias(side), *[F.col(c).alias(f"{c}_{side}") for c in df.columns if c not in columns], *keys)
    for i in range(len(keys)):
        out = out.filter(F.col(f"_k{i}").isNotNull())
    return out


def _with_barred(df: DataFrame, id_col: str, barred: DataFrame, columns: tuple[str, str]) -> DataFrame:
    """The records with the ids each is not to be linked with (``_barred``). Of a listed pair the one that stands in fewer
    holds it: a record that is barred from very many is an entry of each of those, and no list is longer than the root of
    twice the number of pairs."""
    a, b = F.col(columns[0]), F.col(columns[1])
    listed = barred.filter(a.isNotNull() & b.isNotNull()).select(F.least(a, b).alias("_a"), F.greatest(a, b).alias("_b")).distinct()
    often = listed.select(F.explode(F.array("_a", "_b")).alias("_x")).groupBy("_x").count()
    both = listed.join(often.toDF("_a", "_na"), "_a").join(often.toDF("_b", "_nb"), "_b")
    lists = both.groupBy(F.when(F.col("_na") <= F.col("_nb"), F.col("_a")).otherwise(F.col("_b")).alias("_held")).agg(
        F.collect_list(F.when(F.col("_na") <= F.col("_nb"), F.col("_b")).otherwise(F.col("_a"))).alias("_barred")
    )
    return df.join(lists, F.col(id_col) == F.col("_held"), "left").drop("_held")


def block_pairs(left: DataFrame, right: DataFrame | None, id_col: str, rules: Sequence[Rule], keep: Sequence[str] | None = None, barred: tuple[DataFrame, tuple[str, str]] | None = None) -> DataFrame:
    """Candidate pairs: structs l and r of the records, and the number and name of the first rule that joins them.

    Without ``right`` a table is paired with itself, each pair once with the smaller id left. A pair that an earlier
    rule also finds is dropped in the later rule's own join by that rule's condition, written out on the pair, so that
    no shuffle of pairs is needed to keep each once. Every rule is one equi-join, spread over its keys' values; hot
    keys are split by the adaptive skew join. ``keep`` narrows the records to the columns that rules and later steps read.
    ``barred``: a do-not-link list and its two columns of ids, either way round. The records carry their entries into the
    join, where barred pairs are dropped (as ``drop_listed`` does for pairs that are there already, by a shuffle of them).
    """
    if not rules or any(not r.keys for r in rules):
        raise ValueError("every blocking rule needs at least one equality key")
    if keep is not None:
        left = left.select(id_col, *[c for c in keep if c != id_col])
        right = right.select(id_col, *[c for c in keep if c != id_col]) if right is not None else None
    columns = left.columns
    other_columns = columns if right is None else right.columns
    if barred is not None:
        left = _with_barred(left, id_col, *barred)
        right = _with_barred(right, id_col, *barred) if right is not None else None
    other, out = left if right is None else right, None
    for n, rule in enumerate(rules):
        on = [f"_k{i}" for i in range(len(rule.keys) + bool(rule.near))]
        met = _side(left, columns, rule, "l").join(_side(other, other_columns, rule, "r"), on)
        if right is None:
            met = met.filter(F.col(f"l.{id_col}") < F.col(f"r.{id_col}"))
        met = met.filter(F.coalesce(F.expr(rule.where), F.lit(False)))
        for earlier in rules[:n]:
            met = met.filter(~F.coalesce(_holds(earlier, columns), F.lit(False)))
        if barred is not None:
            for held, met_with in (("_barred_l", "r"), ("_barred_r", "l")):
                met = met.filter(~F.coalesce(F.array_contains(held, F.col(f"{met_with}.{id_col}")), F.lit(False)))
        part = met.select("l", "r", F.lit(n).alias("rule_no"), F.lit(rule.name).alias("rule"))
        out = part if out is None else out.unionByName(part)
    return out


def _holds(rule: Rule, columns: Sequence[str]) -> Column:
    cond = F.expr(rule.where)
    for k in rule.keys:
        cond = cond & (F.expr(_qualified(k, columns, "l")) == F.expr(_qualified(k, columns, "r")))
    return cond


def _qualified(sql: str, columns: Sequence[str], side: str) -> str:
    """The key expression with its columns taken from one side's struct."""
    import re

    names = "|".join(sorted(map(re.escape, columns), key=len, reverse=True))
    return re.sub(rf"(?<![\w.'])({names})(?![\w'(])", rf"{side}.\1", sql)


def drop_listed(pairs: DataFrame, listed: DataFrame, l_id: Column, r_id: Column, columns: tuple[str, str]) -> DataFrame:
    """Pairs that are not on a do-not-link list, whichever way round it has them: both sides are put in order, and
    what is left is an equi anti-join."""
    a, b = F.col(columns[0]), F.col(columns[1])
    barred = listed.select(F.least(a, b).alias("_a"), F.greatest(a, b).alias("_b")).distinct()
    return pairs.withColumns({"_a": F.least(l_id, r_id), "_b": F.greatest(l_id, r_id)}).join(barred, ["_a", "_b"], "left_anti").drop("_a", "_b")
