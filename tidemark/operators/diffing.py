"""Differences between two copies of a table, cell by cell."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How a field's values are compared.
KINDS = ("text", "number", "list", "exact")
BLANKS = r"[\s\u00a0]+"


def canonical_text(c: Column, kind: str = "text") -> Column:
    """The text under which two values count as the same: for ``text`` lower case, trimmed, a run of white space one
    blank (a blank lost inside a name is a difference), for ``list`` the sorted members without white space (comma
    separated), the value as it is for ``exact``; null and blank are both ''."""
    s = c.cast("string")
    if kind == "exact":
        return F.coalesce(s, F.lit(""))
    s = F.lower(s)
    if kind == "list":
        s = F.array_join(F.array_sort(F.filter(F.split(F.regexp_replace(s, BLANKS, ""), ","), lambda x: x != "")), ",")
    else:
        s = F.trim(F.regexp_replace(s, BLANKS, " "))
    return F.coalesce(s, F.lit(""))


def diff_tables(
    left: DataFrame,
    right: DataFrame,
    key: str,
    fields: Mapping[str, str],
    tolerance: float = 1e-6,
    labels: tuple[str, str, str] = ("gone", "new", "changed"),
) -> DataFrame:
    """Rows only one copy has and fields that differ: (key, diff_type, field_name).

    Both sides become key-field-value cells with a count of +1 or -1; a cell's counts are added up in the first
    aggregation (which combines before its shuffle, so a key that holds a third of all rows is a few rows per task).
    Cells that come to nought are gone; what does not cancel is judged per key.

    ``fields`` maps a field to its kind: ``text`` (case and surplus white space do not matter), ``number`` (values less
    than ``tolerance`` apart are equal; distances are rounded to a thousandth of it, so that a distance of just the
    tolerance is a difference however its binary form falls), ``list`` (comma-separated, the order does not matter) or
    ``exact``.

    Defined cases: a null key never matches anything and is reported once for each copy that has one, as gone or new; null and
    blank text are equal; null and a number differ, NaN counts as null; rows delivered twice count once; where one
    copy holds several different rows under a key, equal values cancel and the rest must be the same set (numbers: the
    same smallest and largest value); an empty side makes every key gone or new; other columns are ignored.
    """
    unknown = {k: v for k, v in fields.items() if v not in KINDS}
    if unknown:
        raise ValueError(f"unknown kinds: {unknown}")

    def cells(df: DataFrame, sign: int) -> DataFrame:
        def cell(name: str, kind: str) -> Column:
            if kind == "number":
                num = F.nanvl(F.col(f"`{name}`").cast("double"), F.lit(None).cast("double"))
                return F.struct(F.lit(name).alias("f"), F.lit("").alias("v"), num.alias("x"))
            return F.struct(F.lit(name).alias("f"), canonical_text(F.col(f"`{name}`"), kind).alias("v"), F.lit(None).cast("double").alias("x"))

        presence = F.struct(F.lit("").alias("f"), F.lit("").alias("v"), F.lit(None).cast("double").alias("x"))
        every = F.array(presence, *[cell(n, k) for n, k in fields.items()])
        return df.select(F.col(f"`{key}`").alias("k"), F.inline(every)).withColumn("sign", F.lit(sign))

    both = cells(left, 1).unionByName(cells(right, -1))
    # Repeated delivery counts once: a side's count is the largest, or smallest, of its signs.
    plus, minus = F.greatest(F.max("sign"), F.lit(0)), F.least(F.min("sign"), F.lit(0))
    summed = both.groupBy("k", "f", "v", "x").agg((plus + minus).alias("n"))
    # A presence cell stays even when it cancels: a cell that differs counts only where both copies have the key.
    rest = summed.filter((F.col("f") == "") | (F.col("n") != 0))

    def differs(name: str, kind: str) -> Column:
        here = F.col("f") == name
        if kind != "number":
            return F.max(here)
        x = F.when(here, F.col("x"))
        l, r = F.when(F.col("n") > 0, x), F.when(F.col("n") < 0, x)
        lone_null = F.coalesce(F.max(here & F.col("x").isNull()), F.lit(False))
        places = max(0, round(3 - math.log10(tolerance))) if tolerance > 0 else 15
        far = lambda fn: F.round(F.abs(fn(l) - fn(r)), places) >= tolerance
        one_sided = F.max(l).isNull() != F.max(r).isNull()
        return F.max(here) & (one_sided | lone_null | F.coalesce(far(F.min) | far(F.max), F.lit(False)))

    present = F.max(F.when(F.col("f") == "", F.col("n")))
    judged = rest.groupBy("k").agg(present.alias("n"), F.array_compact(F.array(*[F.when(differs(n, k), F.lit(n)) for n, k in fields.items()])).alias("names"))
    gone, new, changed = labels
    mark = lambda label, names: F.transform(names, lambda f: F.struct(F.lit(label).alias("t"), f.alias("f")))
    whole, sides = F.array(F.lit("")), F.col("n")
    cases = (
        F.when(sides > 0, mark(gone, whole)).when(sides < 0, mark(new, whole))
        .when(F.col("k").isNull(), F.concat(mark(gone, whole), mark(new, whole)))  # null is no key: both copies' rows stand alone
        .otherwise(mark(changed, F.col("names")))
    )
    return judged.select("k", F.inline(cases)).select(F.col("k").alias(key), F.col("t").alias("diff_type"), F.col("f").alias("field_name"))
