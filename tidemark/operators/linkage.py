"""The Fellegi-Sunter model: comparison levels, prior, u and m probabilities, term frequencies, scores, explanations."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.blocking import Rule


@dataclass(frozen=True)
class Level:
    """A condition over l.x and r.x with m and u probabilities. The first true level counts; a null condition is not true."""

    name: str
    when: str
    m: float = 0.5
    u: float = 0.5


@dataclass(frozen=True)
class Comparison:
    """Levels from strongest to weakest. ``missing``: where it holds there is no evidence (gamma -1). The last level is what
    is left. ``tf``: column whose value frequency replaces u in level 0."""

    name: str
    missing: str
    levels: tuple[Level, ...]
    tf: str | None = None

    def gamma(self) -> Column:
        """Number of the level, from len(levels) - 1 (strongest) down to 0 (else); -1 where values are missing."""
        out, n = F.when(F.expr(self.missing), F.lit(-1)), len(self.levels)
        for i, level in enumerate(self.levels[:-1]):
            out = out.when(F.expr(level.when), F.lit(n - 1 - i))
        return out.otherwise(F.lit(0))

    def level_of(self, gamma: int) -> Level:
        return self.levels[len(self.levels) - 1 - gamma]


@dataclass(frozen=True)
class Model:
    prior: float
    comparisons: tuple[Comparison, ...]
    meta: Mapping[str, str] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(asdict(self), indent=1)

    @staticmethod
    def from_json(text: str, expect: Mapping[str, str] | None = None) -> Model:
        """A saved model; refused without a prior or any m and u, or where its meta differs from ``expect``."""
        d = json.loads(text)
        comparisons = tuple(Comparison(c["name"], c["missing"], tuple(Level(**v) for v in c["levels"]), c.get("tf")) for c in d.get("comparisons", []))
        if not 0 < d.get("prior", 0) < 1 or not any(v.m and v.u for c in comparisons for v in c.levels):
            raise ValueError("a model needs a prior and at least one level with m and u")
        for k, v in (expect or {}).items():
            if d.get("meta", {}).get(k) != v:
                raise ValueError(f"the model was made with {k}={d.get('meta', {}).get(k)}, not {v}")
        return Model(d["prior"], comparisons, d.get("meta", {}))


def compare(pairs: DataFrame, comparisons: Sequence[Comparison]) -> DataFrame:
    return pairs.withColumns({f"gamma_{c.name}": c.gamma() for c in comparisons})


def term_frequencies(df: DataFrame, column: str) -> DataFrame:
    """(value, tf): the share of each value among the known ones."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return counts.crossJoin(F.broadcast(counts.agg(F.sum("n").alias("_all")))).select("value", (F.col("n") / F.col("_all")).alias("tf"))


def level_weight(c: Comparison) -> Column:
    """log2(m/u) of the pair's level; none where values are missing."""
    out = F.when(F.col(f"gamma_{c.name}") == -1, F.lit(0.0))
    for g in range(len(c.levels)):
        v = c.level_of(g)
        out = out.when(F.col(f"gamma_{c.name}") == g, F.lit(math.log2(v.m / v.u)))
    return out.otherwise(F.lit(0.0))


def score(pairs: DataFrame, model: Model, frequencies: Mapping[str, DataFrame] | None = None, threshold: float | None = None, least_u: float = 0.001, tf_broadcast_rows: int = 1_000_000) -> DataFrame:
    """match_weight = log2 of the prior odds plus the levels' weights, and match_probability. Sums of literals by level: the
    whole score stays in generated code. Comparisons with ``tf`` swap u for max(frequency of the value left and
    right, least_u) in their strongest level; a frequency table is broadcast while it has at most
    ``tf_broadcast_rows`` rows, and joined beyond."""
    out = compare(pairs, model.comparisons)
    weight = F.lit(math.log2(model.prior / (1 - model.prior)))
    for c in model.comparisons:
        weight = weight + level_weight(c)
        if c.tf and frequencies and c.tf in frequencies:
            table = frequencies[c.tf]
            small = table.count() <= tf_broadcast_rows
            for side in "lr":
                t = table.select(F.col("value").alias(f"_v{side}"), F.col("tf").alias(f"_tf_{side}_{c.name}"))
                out = out.join(F.broadcast(t) if small else t, F.col(f"{side}.{c.tf}") == F.col(f"_v{side}"), "left").drop(f"_v{side}")
            top = len(c.levels) - 1
            tf = F.greatest(F.col(f"_tf_l_{c.name}"), F.col(f"_tf_r_{c.name}"), F.lit(least_u))
            adjust = F.when((F.col(f"gamma_{c.name}") == top) & (F.col(f"_tf_l_{c.name}").isNotNull() | F.col(f"_tf_r_{c.name}").isNotNull()), F.log2(F.lit(c.level_of(top).u) / tf)).otherwise(F.lit(0.0))
            out = out.withColumn(f"tf_{c.name}", adjust)
            weight = weight + F.col(f"tf_{c.name}")
    drop = [x for x in out.columns if x.startswith("_tf_")]
    out = out.withColumn("match_weight", weight).drop(*drop)
    out = out.withColumn("match_probability", 1 / (1 + F.pow(F.lit(2.0), -F.col("match_weight"))))
    return out if threshold is None else out.filter(F.col("match_probability") >= threshold)


def best_per_right(scored: DataFrame, l_id: Column, r_id: Column) -> DataFrame:
    """The best left record of each right one: probability, weight, then the smaller left id."""
    w = Window.partitionBy(r_id).orderBy(F.desc("match_probability"), F.desc("match_weight"), l_id)
    return scored.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def prior_from_rules(matched_pairs: int, recall: float, all_pairs: float) -> float:
    """The chance that two records match: deterministic matches over their recall over all pairs; no such match counts as
    half a one, as it does not prove that there are none."""
    return min(max(max(matched_pairs, 0.5) / recall / max(all_pairs, 1.0), 1e-12), 1 - 1e-12)


def estimate_u(left: DataFrame, right: DataFrame | None, comparisons: Sequence[Comparison], pairs: int = 1_000_000, seed: int = 1) -> tuple[Comparison, ...]:
    """u probabilities from about ``pairs`` random pairs: both sides are dealt at random into equally many hands, and only hands
    of the same number are paired, so the sample is spread over the cluster."""
    other = left if right is None else right
    nl, nr = left.count(), other.count()
    hands = max(1, int(nl * nr / max(pairs, 1)))
    hand = lambda df, s: df.select(F.struct(*df.columns).alias(s), F.floor(F.rand(seed + (s == "r")) * hands).cast("bigint").alias("_h"))
    sampled = hand(left, "l").join(hand(other, "r"), "_h")
    rows = _pattern_counts(compare(sampled, comparisons), comparisons)
    return tuple(_with(c, "u", _shares(c, rows, [n for *_, n in rows], i)) for i, c in enumerate(comparisons))


def _pattern_counts(compared: DataFrame, comparisons: Sequence[Comparison]) -> list[tuple]:
    """Gamma patterns with their counts: as many rows as there are combinations of levels, whatever the number of pairs."""
    names = [f"gamma_{c.name}" for c in comparisons]
    return [tuple(r) for r in compared.groupBy(*names).agg(F.count("*").alias("n")).orderBy(*names).collect()]


def _shares(c: Comparison, rows: Sequence[tuple], weights: Sequence[float], i: int) -> list[float]:
    n = np.full(len(c.levels), 1e-6)
    for row, w in zip(rows, weights):
        if row[i] >= 0:
            n[row[i]] += w
    return list(n / n.sum())


def _with(c: Comparison, what: str, by_gamma: Sequence[float]) -> Comparison:
    from dataclasses import replace

    top = len(c.levels) - 1
    return replace(c, levels=tuple(replace(v, **{what: float(by_gamma[top - k])}) for k, v in enumerate(c.levels)))


@dataclass(frozen=True)
class Training:
    """A block to learn m from, the pairs of one or several rules. ``fixed``: comparisons the block says nothing about, besides those that read a column it makes
    equal. ``implied``: for comparisons whose upper levels the block implies, how many; they raise the prior inside it."""

    rules: tuple[Rule, ...]
    fixed: tuple[str, ...] = ()
    implied: Mapping[str, int] = field(default_factory=dict)

    def excluded(self, comparisons: Sequence[Comparison]) -> tuple[str, ...]:
        equal = set.intersection(*[{k for k in r.keys if k.isidentifier()} for r in self.rules])
        return tuple(c.name for c in comparisons if c.name in self.fixed or equal & columns_of(c))


def columns_of(c: Comparison) -> set[str]:
    """The columns a comparison reads on either side."""
    return set(re.findall(r"\b[lr]\.(\w+)", " ".join([str(c.missing), *(str(v.when) for v in c.levels)])))


def patterns(pairs: DataFrame, comparisons: Sequence[Comparison], fixed: Sequence[str] = ()) -> list[tuple]:
    """What ``train_m`` needs of a block's pairs: the counts of the free comparisons' gamma patterns, one aggregation."""
    free = [c for c in comparisons if c.name not in fixed]
    return _pattern_counts(compare(pairs, free), free)


def train_m(rows: Sequence[tuple], model: Model, fixed: Sequence[str] = (), rounds: int = 100, stop: float = 1e-4, share: float | None = None) -> tuple[Model, int]:
    """m probabilities (and the prior inside the block) by expectation-maximisation over the ``patterns`` of one training
    block; the iterations run on those few rows. ``fixed`` are the comparisons whose columns the block makes equal: they
    tell nothing there and keep their values. ``share``: the prior inside the block to start from. Stops when no
    log2(m/u) moves by more than ``stop``. Returns the model with its own prior, and the rounds used."""
    free = [c for c in model.comparisons if c.name not in fixed]
    if not rows:
        return model, 0
    n = np.array([r[-1] for r in rows], float)
    gamma = np.array([r[:-1] for r in rows], int)
    m = [np.array([c.level_of(g).m for g in range(len(c.levels))]) for c in free]
    u = [np.array([c.level_of(g).u for g in range(len(c.levels))]) for c in free]
    share, used = share or (model.prior if model.prior > 0.01 else 0.1), 0
    for used in range(1, rounds + 1):
        ratio = np.full(len(rows), math.log(share / (1 - share)))
        for i in range(len(free)):
            known = gamma[:, i] >= 0
            ratio[known] += np.log(m[i][gamma[known, i]]) - np.log(u[i][gamma[known, i]])
        p = 1 / (1 + np.exp(-np.clip(ratio, -500, 500)))
        moved = 0.0
        for i, c in enumerate(free):
            new = np.array(_shares(c, rows, p * n, i))
            moved = max(moved, float(np.abs(np.log2(new) - np.log2(m[i])).max()))
            m[i] = new
        share = float(min(max((p * n).sum() / n.sum(), 1e-9), 1 - 1e-9))
        if moved < stop:
            break
    trained = {c.name: _with(c, "m", m[i]) for i, c in enumerate(free)}
    return Model(model.prior, tuple(trained.get(c.name, c) for c in model.comparisons), model.meta), used


def train_runs(blocks: Sequence[tuple[Training, Sequence[tuple]]], model: Model, most: int = 3, least: int = 1, stop: float = 0.002, rounds: int = 100) -> tuple[Model, list[float]]:
    """Outer runs over all training blocks (with their ``patterns``). In a run each block starts from the run's model, with the
    prior raised by what the block implies and put back afterwards; the blocks' m are averaged where they are free. Runs end
    when, after ``least``, no level's log2(m/u) has moved by ``stop``, at the latest after ``most``. Returns the moves, too."""
    moves: list[float] = []
    for run in range(most):
        trained = []
        for t, rows in blocks:
            out = t.excluded(model.comparisons)
            trained.append((train_m(rows, model, out, rounds, share=block_prior(model, t.implied) if t.implied else None)[0], out))
        comparisons = []
        for i, c in enumerate(model.comparisons):
            free = [m.comparisons[i] for m, out in trained if c.name not in out]
            if free:
                logs = np.mean([[math.log(f.level_of(g).m) for g in range(len(c.levels))] for f in free], axis=0)
                c = _with(c, "m", list(np.exp(logs) / np.exp(logs).sum()))
            comparisons.append(c)
        pairs = [(a.level_of(g), b.level_of(g)) for a, b in zip(model.comparisons, comparisons) for g in range(len(a.levels))]
        moves.append(max((abs(math.log2(a.m / a.u) - math.log2(b.m / b.u)) for a, b in pairs), default=0.0))
        model = Model(model.prior, tuple(comparisons), model.meta)
        if run and run + 1 >= least and moves[-1] < stop:
            break
    return model, moves


def block_prior(model: Model, implied: Mapping[str, int]) -> float:
    """The prior inside a block that implies one of the upper levels of some comparisons (name -> how many of them): the odds
    times sum(m) / sum(u) of all these levels."""
    levels = [c.level_of(len(c.levels) - 1 - k) for c in model.comparisons if c.name in implied for k in range(implied[c.name])]
    u = sum(v.u for v in levels)
    odds = model.prior / (1 - model.prior) * (sum(v.m for v in levels) / u if u else 1.0)
    return min(max(odds / (1 + odds), 1e-9), 1 - 1e-9)


def copy_ratio(model: Model, name: str, source: int, target: int) -> Model:
    """u of one level set so that its m/u equals another level's."""
    out = []
    for c in model.comparisons:
        if c.name == name and c.level_of(source).m > 0:
            by = [c.level_of(g).u for g in range(len(c.levels))]
            by[target] = c.level_of(target).m * c.level_of(source).u / c.level_of(source).m
            c = _with(c, "u", by)
        out.append(c)
    return Model(model.prior, tuple(out), model.meta)


def parameter_table(spark, model: Model) -> DataFrame:
    """One row per level: comparison, gamma, level, m, u, weight (the data behind weight and m/u charts)."""
    rows = [(c.name, g, v.name, v.m, v.u, math.log2(v.m / v.u)) for c in model.comparisons for g in range(len(c.levels)) for v in [c.level_of(g)]]
    return spark.createDataFrame(rows, "comparison string, gamma int, level string, m double, u double, weight double")


def explain(scored: DataFrame, model: Model, ids: Sequence[Column]) -> DataFrame:
    """One row per pair and comparison: gamma and the weight it adds (a waterfall in rows)."""
    cells = [F.struct(F.lit(c.name).alias("comparison"), F.col(f"gamma_{c.name}").alias("gamma"), level_weight(c).alias("weight")) for c in model.comparisons]
    return scored.select(*ids, F.inline(F.array(*cells)))


def unlinkables(scored: DataFrame, places: int = 2) -> DataFrame:
    """For each match probability the share of rows with it and the share of rows up to it."""
    p = scored.select(F.round("match_probability", places).alias("p")).groupBy("p").agg(F.count("*").alias("n"))  # 10**places + 1 rows
    share = p.crossJoin(F.broadcast(p.agg(F.sum("n").alias("_all")))).select("p", (F.col("n") / F.col("_all")).alias("prop"))
    return share.withColumn("cumulative", F.sum("prop").over(Window.orderBy("p")))
