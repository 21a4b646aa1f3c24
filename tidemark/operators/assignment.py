"""One-to-one matching of the largest total weight, per group or per connected component."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.clustering import connected_components


def assign(weights: np.ndarray, full: bool = False) -> list[tuple[int, int]]:
    """(row, column) pairs of the largest total weight; NaN = not allowed, pairs of no positive weight stay unmatched.
    With ``full`` as many pairs as can be are matched, whatever their weights, and among such matchings the total is the
    largest.

    Shortest augmenting paths with potentials, O(n^2 m). Among equal totals, rows in order take the smallest columns:
    a preference far below the weights' own differences decides."""
    n, m = weights.shape
    if n > m:
        return sorted((i, j) for j, i in assign(weights.T, full))
    if full and not np.isnan(weights).all():
        low, high = np.nanmin(weights), np.nanmax(weights)
        weights = weights - low + (high - low + 1.0) * (n + 1)  # one pair more outweighs any change of the others
    gain = np.where(np.isnan(weights), 0.0, np.maximum(weights, 0.0))
    top = float(gain.max()) if gain.size else 0.0
    lean = np.add.outer(np.arange(n) * 0.0, np.arange(m, 0, -1)) * (np.arange(n, 0, -1)[:, None]) / (max(n, 1) * max(m, 1) ** 2 * max(n, 1))
    cost = np.zeros((n + 1, m + 1))
    cost[1:, 1:] = -(gain + np.where(gain > 0, lean * max(top, 1.0) * 1e-9, 0.0))
    u, v, match = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        least, way, used = np.full(m + 1, np.inf), np.zeros(m + 1, int), np.zeros(m + 1, bool)
        while True:
            used[j0] = True
            i0 = match[j0]
            open_ = ~used
            open_[0] = False
            slack = cost[i0] - u[i0] - v
            better = open_ & (slack < least)
            least[better], way[better] = slack[better], j0
            j1 = int(np.where(open_, least, np.inf).argmin())
            delta = least[j1]
            u[match[used]] += delta
            v[used] -= delta
            least[~used] -= delta
            j0 = j1
            if match[j0] == 0:
                break
        while j0:
            j1 = way[j0]
            match[j0] = match[j1]
            j0 = j1
    return sorted((int(match[j]) - 1, j - 1) for j in range(1, m + 1) if match[j] and gain[match[j] - 1, j - 1] > 0)


def assign_rows(gains: Callable[[np.ndarray, np.ndarray], np.ndarray], n: int, m: int, ahead: int = 256) -> list[tuple[int, int]]:
    """``assign`` for n <= m without the matrix: ``gains(rows, columns)`` gives a part of it, and pairs of no positive gain are none.

    Of the columns that no row has yet, a row only needs its best, as their potentials are zero; the steps run over the
    columns in use, at most n. A column once in use stays so. Memory: n x n cells and ``ahead`` columns for each row."""
    every = np.arange(m)
    cost = np.full((n, n), np.inf)
    u, v, owner, column = np.zeros(n), np.zeros(n), np.zeros(n, int), np.zeros(n, int)
    taken, held = np.zeros(m, bool), 0
    lists: list[list[tuple[float, int]] | None] = [None] * n

    def free(i: int) -> tuple[float, int]:
        """The best column not in use and its cost; -1 at cost 0: none."""
        while True:
            todo = lists[i]
            if todo is None:
                g = np.where(taken, 0.0, gains(np.array([i]), every)[0])
                at = np.flatnonzero(g > 0)
                if len(at) > ahead:
                    edge = np.partition(g[at], len(at) - ahead)[len(at) - ahead]
                    at = np.concatenate([at[g[at] > edge], at[g[at] == edge][:ahead]])
                todo = lists[i] = [(-g[j], int(j)) for j in at[np.lexsort((-at, g[at]))]] if len(at) else [(0.0, -1)]
            while todo and todo[-1][1] >= 0 and taken[todo[-1][1]]:
                todo.pop()
            if todo:
                return todo[-1]
            lists[i] = None

    for i in range(n):
        near, way, seen = np.full(held, np.inf), np.full(held, -1), np.zeros(held, bool)
        best = free(i)[0]
        u[i] = min(best, (cost[i, :held] - v[:held]).min(initial=np.inf))
        row, at, base, end, scanned = i, -1, 0.0, (np.inf, -1, -1), []
        while True:
            c, j = free(row)
            if base + c - u[row] < end[0]:
                end = base + c - u[row], at, j
            if held:
                slack = base + cost[row, :held] - u[row] - v[:held]
                better = ~seen & (slack < near)
                near[better], way[better] = slack[better], at
                open_ = np.where(seen, np.inf, near)
                k = int(open_.argmin())
                if open_[k] < end[0]:
                    seen[k], base, at, row = True, open_[k], k, owner[k]
                    scanned.append(k)
                    continue
            break
        delta, at, j = end
        done = np.array(scanned, int)
        u[owner[done]] += delta - near[done]
        v[done] += near[done] - delta
        u[i] += delta
        if j >= 0:
            new, taken[j], column[held] = held, True, j
            cost[:, held] = (lambda g: np.where(g > 0, -g, np.inf))(gains(np.arange(n), np.array([j]))[:, 0])
            held += 1
        else:
            new = -1  # the path's last row gives up its column and stays alone
        while True:
            if new >= 0:
                owner[new] = owner[at] if at >= 0 else i
            if at < 0:
                break
            new, at = at, way[at]
    return sorted((int(owner[k]), int(column[k])) for k in range(held))


def match_blocks(left: DataFrame, right: DataFrame, block: str, id_col: str, weigh: Callable[[pd.DataFrame, pd.DataFrame], np.ndarray], names: tuple[str, str, str], full: bool = False) -> DataFrame:
    """(block, left, right, weight), the last three named ``names``: the best one-to-one matching of the records of each block (see ``assign``
    for ``full``), from the records themselves: their pairs are no rows anywhere. ``weigh`` gives the weights of all of some left with
    all of some right records, NaN where two are no pair. Components never reach across blocks, so the total is also the
    largest over all pairs.

    Null ids and blocks take no part; of a record delivered twice a pair's largest weight counts. A block is one task; of n and m
    records, n at most m, it holds n x n cells and weighs about m at a time (see ``assign_rows``)."""
    kind = left.schema[id_col].dataType.simpleString()
    # Columns of their own for either side: both may come from one frame.
    sides = [df.select(*[F.col(c).alias(c) for c in df.columns]).filter(F.col(id_col).isNotNull() & F.col(block).isNotNull()) for df in (left, right)]

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({block: [], names[0]: [], names[1]: [], names[2]: []})
        if not len(a) or not len(b):
            return empty
        a, b = a.sort_values(id_col, ignore_index=True), b.sort_values(id_col, ignore_index=True)
        twice = [not x[id_col].is_unique for x in (a, b)]
        ids = [x[id_col].drop_duplicates().to_numpy() for x in (a, b)]
        starts = [np.flatnonzero(~x[id_col].duplicated().to_numpy()) for x in (a, b)]
        spans = [np.append(s, len(x)) for s, x in zip(starts, (a, b))]

        def some(x: pd.DataFrame, side: int, at: np.ndarray) -> tuple[pd.DataFrame, np.ndarray]:
            if not twice[side]:
                return x if len(at) == len(x) else x.iloc[at], np.arange(len(at))
            rows = [np.arange(spans[side][i], spans[side][i + 1]) for i in at]
            return x.iloc[np.concatenate(rows)], np.cumsum([0, *map(len, rows[:-1])])

        def weights(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            (x, si), (y, sj) = some(a, 0, i), some(b, 1, j)
            w = np.asarray(weigh(x, y), float)
            w = np.fmax.reduceat(w, si, axis=0) if twice[0] else w
            return np.fmax.reduceat(w, sj, axis=1) if twice[1] else w

        # Which records have pairs at all, and the range of the weights, a few rows at a time.
        step, every = max(1, 4_000_000 // len(ids[1])), np.arange(len(ids[1]))
        rows, cols, low, high = np.zeros(len(ids[0]), bool), np.zeros(len(ids[1]), bool), np.inf, -np.inf
        for i in range(0, len(ids[0]), step):
            w = weights(np.arange(i, min(i + step, len(ids[0]))), every)
            ok = ~np.isnan(w)
            rows[i : i + step], cols = ok.any(axis=1), cols | ok.any(axis=0)
            if ok.any():
                low, high = min(low, np.nanmin(w)), max(high, np.nanmax(w))
        if not rows.any():
            return empty
        rows, cols = np.flatnonzero(rows), np.flatnonzero(cols)
        turned = len(rows) > len(cols)
        n, m = sorted((len(rows), len(cols)))
        lift = (high - low + 1.0) * (n + 1) - low if full else 0.0
        top = max(high + lift, 1.0)

        def gains(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            w = weights(rows[j], cols[i]).T if turned else weights(rows[i], cols[j])
            w = np.where(np.isnan(w), 0.0, np.maximum(w + lift, 0.0))
            lean = (m - j)[None, :] * (n - i)[:, None] / (n * m**2 * n)
            return w + np.where(w > 0, lean * top * 1e-9, 0.0)

        picked = assign_rows(gains, n, m)
        picked = sorted((j, i) for i, j in picked) if turned else picked
        got = [(rows[i], cols[j]) for i, j in picked]
        return pd.DataFrame(
            {block: a[block].iloc[0], names[0]: [ids[0][i] for i, _ in got], names[1]: [ids[1][j] for _, j in got], names[2]: [weights(np.array([i]), np.array([j]))[0, 0] for i, j in got]},
            columns=[block, *names],
        )

    right_kind = right.schema[id_col].dataType.simpleString()
    out = f"{block} {left.schema[block].dataType.simpleString()}, {names[0]} {kind}, {names[1]} {right_kind}, {names[2]} double"
    return sides[0].groupBy(block).cogroup(sides[1].groupBy(block)).applyInPandas(run, out)


def match_groups(scored: DataFrame, group: str, left: str, right: str, weight: str, full: bool = False) -> DataFrame:
    """(group, left, right, weight): the best one-to-one matching within each group (see ``assign`` for ``full``). Ties go to
    smaller ids. A group is one task's matrix: n x m cells, n at most m, and n steps over it at worst n x m long."""
    kinds = {c: scored.schema[c].dataType.simpleString() for c in (group, left, right)}
    best = scored.filter(F.col(left).isNotNull() & F.col(right).isNotNull()).groupBy(group, left, right).agg(F.max(F.col(weight).cast("double")).alias(weight))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        wide = pdf.pivot(index=left, columns=right, values=weight).sort_index(axis=0).sort_index(axis=1)
        w = wide.to_numpy()
        picked = assign(w, full)
        return pd.DataFrame(
            {group: pdf[group].iloc[0], left: [wide.index[i] for i, _ in picked], right: [wide.columns[j] for _, j in picked], weight: [w[i, j] for i, j in picked]},
            columns=[group, left, right, weight],
        )

    return best.groupBy(group).applyInPandas(run, ", ".join(f"{c} {k}" for c, k in kinds.items()) + f", {weight} double")


def match_one_to_one(scored: DataFrame, left: str, right: str, weight: str) -> DataFrame:
    """(left, right, weight): the best one-to-one matching of all pairs. Components of the bipartite graph are independent and
    matched side by side."""
    sides = scored.select(F.concat(F.lit("l:"), F.col(left).cast("string")).alias("a"), F.concat(F.lit("r:"), F.col(right).cast("string")).alias("b"))
    part = connected_components(sides, "a", "b").select(F.col("id").alias("_key"), F.col("component").alias("_component"))
    keyed = scored.withColumn("_key", F.concat(F.lit("l:"), F.col(left).cast("string"))).join(part, "_key")
    return match_groups(keyed, "_component", left, right, weight).drop("_component")


def greedy_groups(scored: DataFrame, group: str, left: str, right: str, weight: str) -> DataFrame:
    """Within each group, pairs from the heaviest down, each record used once."""
    kinds = {c: scored.schema[c].dataType.simpleString() for c in (group, left, right)}

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ls, rs, keep = set(), set(), []
        for row in pdf.sort_values([weight, left, right], ascending=[False, True, True]).itertuples():
            l, r = getattr(row, left), getattr(row, right)
            if l not in ls and r not in rs:
                ls.add(l)
                rs.add(r)
                keep.append(row.Index)
        return pdf.loc[keep, [group, left, right, weight]]

    slim = scored.select(group, left, right, F.col(weight).cast("double").alias(weight))
    return slim.groupBy(group).applyInPandas(run, ", ".join(f"{c} {k}" for c, k in kinds.items()) + f", {weight} double")


def brute_force(weights: Sequence[Sequence[float]]) -> float:
    """The largest total by trying every assignment; for tests of small sizes."""
    from itertools import permutations

    w = np.asarray(weights, float)
    if w.shape[0] > w.shape[1]:
        w = w.T
    g = np.where(np.isnan(w), 0.0, np.maximum(w, 0.0))
    return max((sum(g[i, j] for i, j in enumerate(p)) for p in permutations(range(w.shape[1]), w.shape[0])), default=0.0)
