"""Generalised linear models by distributed Newton steps, with robust standard errors, margins and contrasts."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Fit:
    family: str
    names: tuple[str, ...]
    coef: np.ndarray
    se: np.ndarray
    n: int

    def frame(self, spark) -> DataFrame:
        rows = [(n, float(b), float(s), float(b / s) if s > 0 else None) for n, b, s in zip(self.names, self.coef, self.se)]
        return spark.createDataFrame(rows, "term string, coef double, robust_se double, z double")

    def linear(self, terms: Sequence[Column]) -> Column:
        out = F.lit(float(self.coef[0]))
        for b, t in zip(self.coef[1:], terms):
            out = out + t * float(b)
        return out

    def mean(self, terms: Sequence[Column]) -> Column:
        """The predicted mean of a row."""
        eta = self.linear(terms)
        return {"ols": eta, "poisson": F.exp(eta), "probit": _normal(eta)}[self.family]


def _normal(x: Column) -> Column:
    """The normal distribution function (Abramowitz and Stegun 26.2.17, error below 7.5e-8)."""
    a = F.abs(x)
    t = 1 / (1 + a * 0.2316419)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = F.exp(-a * a / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(x >= 0, 1 - upper).otherwise(upper)


def dummies(column: str, values: Sequence, base: int = 0) -> list[tuple[str, Column]]:
    """Indicator terms for every value but the base one."""
    return [(f"{column}={v}", (F.col(column) == F.lit(v)).cast("double")) for i, v in enumerate(values) if i != base]


def fit(df: DataFrame, y: Column, terms: Sequence[tuple[str, Column]], family: str = "ols", rounds: int = 25, stop: float = 1e-9) -> Fit:
    """ols (linear probability), probit or poisson (pseudo maximum likelihood), with sandwich standard errors.

    Each Newton step is one aggregation to the k + k(k+1)/2 sums of the score and the information, so the data
    stays where it is whatever its size. Rows with a null in y or a term are left out."""
    xs = [F.lit(1.0), *[c.cast("double") for _, c in terms]]
    k = len(xs)
    cols = {f"_x{i}": c for i, c in enumerate(xs)} | {"_y": y.cast("double")}
    data = df.select(*[c.alias(n) for n, c in cols.items()]).na.drop()
    x = [F.col(f"_x{i}") for i in range(k)]
    yy, beta = F.col("_y"), np.zeros(k)
    if family == "poisson":
        beta[0] = math.log(max(data.agg(F.avg("_y")).first()[0] or 1.0, 1e-9))

    def parts(b: np.ndarray) -> tuple[Column, Column]:
        """(factor of the score, weight of the information): sums of s*x_i and w*x_i*x_j."""
        eta = sum((xi * float(bi) for xi, bi in zip(x, b)), F.lit(0.0))
        if family == "ols":
            return yy - eta, F.lit(1.0)
        if family == "poisson":
            mu = F.exp(F.least(eta, F.lit(50.0)))
            return yy - mu, mu
        eta = F.greatest(F.least(eta, F.lit(8.0)), F.lit(-8.0))
        p = F.greatest(F.least(_normal(eta), F.lit(1 - 1e-12)), F.lit(1e-12))
        density = F.exp(-eta * eta / 2) / math.sqrt(2 * math.pi)
        return density * (yy - p) / (p * (1 - p)), density * density / (p * (1 - p))

    def sums(b: np.ndarray, meat: bool) -> tuple[np.ndarray, np.ndarray, int]:
        s, w = parts(b)
        weight = s * s if meat else w
        first = [F.sum(s * xi) for xi in x]
        second = [F.sum(weight * x[i] * x[j]) for i in range(k) for j in range(i, k)]
        row = data.agg(F.count("*"), *first, *second).first()
        m, at = np.zeros((k, k)), 1 + k
        for i in range(k):
            for j in range(i, k):
                m[i, j] = m[j, i] = row[at] or 0.0
                at += 1
        return np.array([v or 0.0 for v in row[1 : 1 + k]]), m, row[0]

    n = 0
    for _ in range(rounds):
        score, info, n = sums(beta, False)
        step = np.linalg.lstsq(info, score, rcond=1e-12)[0]
        beta = beta + step
        if np.abs(step).max() < stop:
            break
    _, info, n = sums(beta, False)
    _, meat, _ = sums(beta, True)
    bread = np.linalg.pinv(info)
    scale = n / max(n - k, 1) if family == "ols" else n / max(n - 1, 1)
    se = np.sqrt(np.maximum(np.diag(bread @ meat @ bread) * scale, 0))
    return Fit(family, ("(intercept)", *[t for t, _ in terms]), beta, se, n)


def margins(df: DataFrame, model: Fit, terms: Sequence[tuple[str, Column]], column: str, values: Sequence) -> DataFrame:
    """(column, margin, contrast): the mean prediction if every row had the value, all else as observed, and its difference
    from the first value's. Rows are scored once per value, side by side in one pass."""
    grid = df.withColumn("_value", F.explode(F.array(*[F.lit(v) for v in values]))).withColumn(column, F.col("_value"))
    means = grid.withColumn("_mean", model.mean([c.cast("double") for _, c in terms])).groupBy("_value").agg(F.avg("_mean").alias("margin"))
    base = means.filter(F.col("_value") == F.lit(values[0])).select(F.col("margin").alias("_base"))
    return means.crossJoin(F.broadcast(base)).select(F.col("_value").alias(column), "margin", (F.col("margin") - F.col("_base")).alias("contrast"))
