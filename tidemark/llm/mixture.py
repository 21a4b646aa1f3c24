"""Matching entities across sources without keys: Gaussian mixtures over similarity vectors, fitted without labels."""

from __future__ import annotations

import logging
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import Scratch, compiled_in_parts


@dataclass
class Component:
    """One class's Gaussian over a block of similarities."""

    mean: np.ndarray
    cov: np.ndarray


@dataclass(frozen=True)
class Block:
    """Similarities whose covariance is fitted; those of different blocks count as independent given the class.
    ``ridge`` is added to every variance, ``keep`` is what is left of covariances."""

    features: tuple[str, ...]
    ridge: float = 0.25
    keep: float = 0.8


@dataclass
class Mixture:
    """The share of matches, and each block's two Gaussians. ``rounds`` of EM were run; ``converged`` says whether the
    last one still moved a mean by more than the tolerance."""

    blocks: tuple[Block, ...]
    share: float
    matched: list[Component]
    unmatched: list[Component]
    rounds: int = 0
    converged: bool = False
    moves: list[float] = field(default_factory=list)

    def log_odds(self) -> Column:
        """Natural log of matched to unmatched density times the prior odds, as an expression: where a similarity is
        null, both densities are those of the others alone (the Gaussians' marginals)."""
        out = F.lit(math.log(self.share / (1 - self.share)))
        for block, m, u in zip(self.blocks, self.matched, self.unmatched):
            out = out + self._block(block.features, m, u)
        return out

    @staticmethod
    def _block(features: tuple[str, ...], matched: Component, unmatched: Component) -> Column:
        k, out = len(features), None
        for mask in range(1, 2**k):
            seen = [i for i in range(k) if mask >> i & 1]
            cond = F.lit(True)
            for i, name in enumerate(features):
                cond = cond & (F.col(name).isNotNull() if mask >> i & 1 else F.col(name).isNull())
            value = _difference([features[i] for i in seen], matched, unmatched, seen)
            out = F.when(cond, value) if out is None else out.when(cond, value)
        return out.otherwise(0.0)


def _difference(names: list[str], matched: Component, unmatched: Component, seen: list[int]) -> Column:
    """The log of the ratio of two Gaussian densities, as one polynomial of the second degree."""
    const, linear, square = 0.0, np.zeros(len(seen)), np.zeros((len(seen), len(seen)))
    for sign, c in ((1, matched), (-1, unmatched)):
        mean, cov = c.mean[seen], c.cov[np.ix_(seen, seen)]
        inverse = np.linalg.inv(cov)
        const -= 0.5 * sign * float(np.linalg.slogdet(cov)[1] + mean @ inverse @ mean)
        linear += sign * (inverse @ mean)
        square -= 0.5 * sign * inverse
    out = F.lit(const)
    for i, a in enumerate(names):
        out = out + F.col(a) * float(linear[i])
        for j in range(i, len(names)):
            out = out + F.col(a) * F.col(names[j]) * float(square[i, j] * (1 if i == j else 2))
    return out


def _moments(blocks: Sequence[Block], p: Column) -> list[Column]:
    """Sums for the M-step: weight, and for each pair of features of a block the weight, sums and products where both
    are seen."""
    out = [F.sum(p)]
    for block in blocks:
        for i, a in enumerate(block.features):
            for b in block.features[i:]:
                w = F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), p)
                out += [F.sum(w), F.sum(w * F.col(a)), F.sum(w * F.col(b)), F.sum(w * F.col(a) * F.col(b))]
    return out


def _components(sums: np.ndarray, blocks: Sequence[Block]) -> list[Component]:
    out, at = [], 1
    for block in blocks:
        k = len(block.features)
        mean, cov = np.zeros(k), np.eye(k) * max(block.ridge, 1e-6)
        for i in range(k):
            for j in range(i, k):
                w, sa, sb, sab = sums[at : at + 4]
                at += 4
                if w <= 1e-9:
                    continue
                value = sab / w - (sa / w) * (sb / w)
                if i == j:
                    mean[i], cov[i, i] = sa / w, max(value, 0.0) + block.ridge
                else:
                    cov[i, j] = cov[j, i] = value * block.keep
        values, vectors = np.linalg.eigh(cov)
        out.append(Component(mean, (vectors * np.maximum(values, max(block.ridge, 1e-6))) @ vectors.T))
    return out


def _split(pairs: DataFrame, total: Column, bins: int = 200) -> float:
    """The value of ``total`` that splits its histogram into two groups with the most variance between them."""
    lo, hi = pairs.agg(F.min(total), F.max(total)).first()
    if lo is None or hi <= lo:
        return lo or 0.0
    width = (hi - lo) / bins
    rows = pairs.groupBy(F.least(F.floor((total - lo) / width), F.lit(bins - 1)).alias("b")).count().collect()  # at most `bins` rows
    n = np.zeros(bins)
    for r in rows:
        n[r["b"]] = r["count"]
    x = lo + (np.arange(bins) + 0.5) * width
    w0, s0 = np.cumsum(n), np.cumsum(n * x)
    w1, s1 = w0[-1] - w0, s0[-1] - s0
    between = np.where((w0 > 0) & (w1 > 0), w0 * w1 * (s0 / np.maximum(w0, 1) - s1 / np.maximum(w1, 1)) ** 2, 0)
    return float(lo + (int(between.argmax()) + 1) * width)


def odds_of(log_odds: Column) -> Column:
    return F.exp(F.least(F.greatest(log_odds, F.lit(-60.0)), F.lit(60.0)))


def constrained(odds: Column, owner: str, target: str | None = None, rival: str | None = None, facts: Sequence[str] = ()) -> Column:
    """The posterior under transitivity. With records A, B of one table and R of the other:

    - two ``target`` records are different entities, so A-R and A-R' exclude one another: the matches of one ``owner``
      compete;
    - A-R and B-R make A and B one entity. Where A and B share a ``rival`` key (they are told apart in one source), or
      state different values of one of ``facts``, they are not, so A-R and B-R compete as well.

    What is left is 'no match'. Among the reasons for which records of one target exclude A, the one with the most
    mass counts."""
    others = F.sum(odds).over(Window.partitionBy(owner))
    if target:
        against = []
        if rival:
            against.append(F.sum(odds).over(Window.partitionBy(target, rival)) - odds)
        for f in facts:
            known = F.when(F.col(f).isNotNull(), odds)
            other = F.sum(known).over(Window.partitionBy(target)) - F.sum(known).over(Window.partitionBy(target, f))
            against.append(F.when(F.col(f).isNotNull(), F.coalesce(other, F.lit(0.0))).otherwise(0.0))
        if against:
            others = others + F.greatest(*against, F.lit(0.0))
    return odds / (1 + others)


def fit_and_score(
    pairs: DataFrame,
    blocks: Sequence[Block],
    owner: str,
    target: str | None = None,
    rival: str | None = None,
    facts: Sequence[str] = (),
    chance: str | None = None,
    rounds: int = 40,
    tolerance: float = 0.02,
) -> tuple[DataFrame, Mixture | None]:
    """Candidate pairs with ``posterior``, and the fitted mixture.

    Expectation-maximisation over all pairs: the E-step is an expression over the similarity columns (null = not
    comparable) followed by the transitivity constraints of ``constrained``; the M-step is one aggregation of weighted
    moments, of which a single row reaches the driver. Covariances are regularised as each ``Block`` says. The prior and
    both components are fitted. Rounds end when no mean moves by ``tolerance``; a fit that has not got there
    after ``rounds`` says so in ``Mixture.converged`` and in the log.

    ``chance`` names a flag of pairs that cannot match but came about as the candidates did (say, by the same search at
    a shifted date). They take part in the fit as unmatched for certain, which keeps the mixture from splitting the
    matches in two where nearly all candidates match, and their number beside the candidates' is the first guess of
    the prior. They are not scored. Without them the start is the best two-way split of the summed similarities.

    The windows hold as many pairs as one record has candidates. Defined cases: no pairs, no rows and no
    mixture; pairs that are all alike keep the prior's posterior; repeated pairs compete with one another, so pass
    distinct ones.
    """
    scratch, blocks = Scratch(pairs.sparkSession), tuple(blocks)
    features = [f for b in blocks for f in b.features]
    if chance:
        with compiled_in_parts(pairs.sparkSession):
            both = scratch.keep(pairs.withColumn("_chance", F.coalesce(F.col(chance), F.lit(False))), "pairs", by="_chance")
        kept, beside = both.filter(~F.col("_chance")).drop("_chance"), both.filter("_chance")
    else:
        kept, beside = scratch.keep(pairs, "pairs"), None
    n = kept.count()
    if not n:
        return kept.withColumn("posterior", F.lit(None).cast("double")), None
    width = len(_moments(blocks, F.lit(1.0)))
    numbers = lambda row: np.array([float(x or 0.0) for x in row])
    anchor = numbers(beside.agg(*_moments(blocks, F.lit(1.0))).first()) if beside is not None else np.zeros(width)
    if anchor[0]:
        share = min(max(1 - anchor[0] / n, 0.01), 0.99)  # only where EM starts
        start = F.lit(share)
    else:
        total = sum((F.coalesce(F.col(f), F.lit(0.0)) for f in features[1:]), F.coalesce(F.col(features[0]), F.lit(0.0)))
        start = F.when(total >= _split(kept, total), 0.95).otherwise(0.05)
    weighted, mixture, moves = kept.withColumn("_p", start), None, []

    def posterior(name: str) -> DataFrame:
        return kept.withColumn("_odds", odds_of(mixture.log_odds())).withColumn(name, constrained(F.col("_odds"), owner, target, rival, facts))

    for _ in range(rounds):
        p = F.col("_p")
        with compiled_in_parts(pairs.sparkSession):
            row = numbers(weighted.agg(*_moments(blocks, p), *_moments(blocks, 1 - p)).first())
        share = min(max(row[0] / n, 1e-6), 1 - 1e-6)
        new = Mixture(blocks, share, _components(row[:width], blocks), _components(row[width:] + anchor, blocks))
        if mixture is not None:
            moves.append(float(max(np.abs(a.mean - b.mean).max() for a, b in zip(new.matched + new.unmatched, mixture.matched + mixture.unmatched))))
        mixture = new
        if moves and moves[-1] < tolerance:
            break
        weighted = posterior("_p")
    mixture.rounds, mixture.moves, mixture.converged = len(moves) + 1, moves, bool(moves) and moves[-1] < tolerance
    if not mixture.converged:
        logging.getLogger(__name__).warning("the mixture still moved by %.3g after %d rounds", moves[-1] if moves else math.nan, mixture.rounds)
    return posterior("posterior").drop("_odds"), mixture
