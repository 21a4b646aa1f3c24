"""Jaro-Winkler similarity, which Spark lacks, as an Arrow UDF over distinct texts of a batch."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def jaro_winkler_pair(a: str, b: str, boost_from: float = 0.7, scale: float = 0.1) -> float:
    """Jaro similarity, raised by up to four common leading letters where it exceeds ``boost_from``; 0 for empty texts."""
    if a == b:
        return 1.0 if a else 0.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    taken, mine = [False] * len(b), []
    for i, x in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == x:
                taken[j] = True
                mine.append(x)
                break
    m = len(mine)
    if not m:
        return 0.0
    theirs = [y for y, t in zip(b, taken) if t]
    swaps = sum(x != y for x, y in zip(mine, theirs)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    if jaro <= boost_from:
        return jaro
    prefix = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * scale * (1 - jaro)


@F.pandas_udf(T.DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    seen: dict[tuple, float | None] = {}
    out = []
    for pair in zip(a, b):
        if pair not in seen:
            seen[pair] = None if pair[0] is None or pair[1] is None else jaro_winkler_pair(*pair)
        out.append(seen[pair])
    return pd.Series(out, dtype="float64")
