"""Casts and null rules that behave alike in every engine."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_int(c: Column) -> Column:
    """Text to int: decimals are rounded half away from zero, what is no number is null."""
    return F.round(c.try_cast("double")).cast("int")


def within(c: Column, low: float, high: float) -> Column:
    """The value if it lies in [low, high], else null."""
    return F.when(c.between(low, high), c)


def without(c: Column, sentinels: Iterable) -> Column:
    """Null in place of the sentinels."""
    return F.when(~c.isin(*sentinels), c)


def ordered_like(c: Column, arms: Sequence[tuple[str, str]], default: str | None = None) -> Column:
    """CASE over LIKE '%part%' on the trimmed lower-case text; the first arm that fits wins."""
    s, out = F.lower(F.trim(c)), None
    for part, value in arms:
        cond = s.contains(part)
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out.otherwise(F.lit(default))


def bit(c: Column) -> Column:
    return F.pow(F.lit(2), c).cast("bigint")


def has_bit(mask: Column, n: int) -> Column:
    return mask.bitwiseAND(F.lit(1 << n)) > 0


def log2_odds(p: Column) -> Column:
    return F.log2(p / (1 - p))


def from_log2_odds(w: Column) -> Column:
    return 1 / (1 + F.pow(F.lit(2.0), -w))
