"""Changes to tables as new tables: upsert, insert-ignore, update-from, delete, refresh, schema growth, outer reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def append(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new, allowMissingColumns=True)


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """New rows replace old ones of their key. Of several new rows of a key the one with the largest ``order`` counts.
    The old table is only anti-joined, so the new side, usually small, can be broadcast by the planner."""
    if order:
        w = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(order))
        new = new.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
    else:
        new = new.dropDuplicates(list(keys))
    return append(old.join(new.select(*keys), list(keys), "left_anti"), new)


def insert_ignore(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New rows whose key the old table lacks are added, once."""
    return append(old, new.dropDuplicates(list(keys)).join(old.select(*keys), list(keys), "left_anti"))


def update_from(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str], keep_where_null: bool = True) -> DataFrame:
    """The columns taken from the row of the same key in ``new``, where there is one (and, by default, where it has a value)."""
    slim = new.dropDuplicates(list(keys)).select(*keys, *[F.col(c).alias(f"_{c}") for c in columns], F.lit(True).alias("_hit"))
    joined = old.join(slim, list(keys), "left")
    value = lambda c: F.coalesce(F.col(f"_{c}"), F.col(c)) if keep_where_null else F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c))
    return joined.select(*[value(c).alias(c) if c in columns else F.col(c) for c in old.columns])


def update_where(old: DataFrame, keys: DataFrame, on: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """The columns set to ``values`` in rows whose key is in ``keys`` (UPDATE ... WHERE key IN subquery)."""
    joined = old.join(keys.select(*on).distinct().withColumn("_hit", F.lit(True)), list(on), "left")
    return joined.select(*[F.when(F.col("_hit"), values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in old.columns])


def delete_keys(old: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return old.join(keys.select(*on), list(on), "left_anti")


def refresh(old: DataFrame, slice_: DataFrame, keys: Sequence[str], touched: DataFrame | None = None) -> DataFrame:
    """Delete-then-insert: all old rows of the touched keys go, the recomputed slice comes in."""
    return append(delete_keys(old, touched if touched is not None else slice_, keys), slice_)


def ensure_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Adds the columns that are missing as typed nulls; casts those of another type."""
    types, out = dict(df.dtypes), {}
    for name, kind in columns.items():
        if name not in types:
            out[name] = F.lit(None).cast(kind)
        elif types[name] != kind:
            out[name] = F.col(name).try_cast(kind)
    return df.withColumns(out) if out else df


def describe(df: DataFrame) -> list[dict[str, str]]:
    """name and type of each column."""
    return [{"name": n, "type": t} for n, t in df.dtypes]


def outer_report(left: DataFrame, right: DataFrame, matches: DataFrame, left_id: str, right_id: str, tag: str = "rec_type") -> DataFrame:
    """Matched pairs, left rows without a match and right rows without, told apart by ``tag``. Columns get the
    prefixes l_ and r_; ``matches`` has left_id and right_id."""
    l = left.select(*[F.col(c).alias(f"l_{c}") for c in left.columns])
    r = right.select(*[F.col(c).alias(f"r_{c}") for c in right.columns])
    m = matches.select(F.col(left_id).alias("_l"), F.col(right_id).alias("_r")).distinct()
    pairs = l.join(m, l[f"l_{left_id}"] == m["_l"], "left")
    both = pairs.join(r, pairs["_r"] == r[f"r_{right_id}"], "full_outer")
    kind = F.when(F.col(f"l_{left_id}").isNull(), "right_only").when(F.col(f"r_{right_id}").isNull(), "left_only").otherwise("match")
    return both.withColumn(tag, kind).drop("_l", "_r")


def decode(df: DataFrame, crosswalk: DataFrame, column: str, domain: str, fallback: int = 6) -> DataFrame:
    """The group code of a category by a crosswalk (domain, raw_value, group_code); unmapped values get ``fallback``.
    The crosswalk's keys are normalised and must be unique. It is small, and broadcast only while it is."""
    norm = lambda c: F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))
    part = crosswalk.filter(F.col("domain") == domain).select(norm(F.col("raw_value")).alias("_k"), F.col("group_code").cast("int").alias("_code"))
    rows = part.agg(F.count("*").alias("n"), F.count_distinct("_k").alias("d")).first()
    if rows["n"] != rows["d"]:
        raise ValueError(f"the crosswalk of {domain} has repeated keys")
    small = F.broadcast(part) if rows["n"] <= 10_000 else part
    return df.withColumn("_k", norm(F.col(column))).join(small, "_k", "left").withColumn(f"{column}_code", F.coalesce("_code", F.lit(fallback))).drop("_k", "_code")
