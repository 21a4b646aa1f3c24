"""Aggregates with a defined result on ties: modes, means of modes, set hashes, bit sets, crosstabs, confusion tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, value, n) without nulls; combines before its shuffle, so hot keys cost what their values do."""
    return df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))


def modal_value(df: DataFrame, keys: Sequence[str], value: str, name: str | None = None) -> DataFrame:
    """The most frequent value per key, the smallest on ties; keys with nulls only have no row."""
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col(value).alias("v")))
    return value_counts(df, keys, value).groupBy(*keys).agg(best["v"].alias(name or value))


def grouped_mode(df: DataFrame, keys: Sequence[str], value: str, family: Column, priority: Sequence[str] = ()) -> DataFrame:
    """The most frequent family wins (ties: smaller name), in it the most frequent member (ties: place in ``priority``,
    then smaller name)."""
    counts = value_counts(df, keys, value).withColumn("_family", family)
    rank = F.coalesce(F.array_position(F.array(*[F.lit(p) for p in priority]).cast("array<string>"), F.col(value)), F.lit(0))
    counts = counts.withColumn("_rank", F.when(rank > 0, rank).otherwise(len(priority) + 1))
    member = F.min(F.struct((-F.col("n")).alias("n"), F.col("_rank").alias("r"), F.col(value).alias("v")))
    families = counts.groupBy(*keys, "_family").agg(F.sum("n").alias("total"), member.alias("m"))
    best = F.min(F.struct((-F.col("total")).alias("t"), F.col("_family").alias("f"), F.col("m.v").alias("v")))
    return families.groupBy(*keys).agg(best.alias("b")).select(*keys, F.col("b.v").alias(value))


def specific_mode(df: DataFrame, keys: Sequence[str], value: str, vague: str = "unknown") -> DataFrame:
    """The most specific value per key: one that does not speak of ``vague`` before one that does before null; then
    the most frequent, then the smallest."""
    level = F.when(F.col(value).isNull(), 0).when(F.lower(value).contains(vague), 1).otherwise(2)
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("n")).withColumn("_level", level)
    best = F.min(F.struct((-F.col("_level")).alias("l"), (-F.col("n")).alias("n"), F.col(value).alias("v")))
    return counts.groupBy(*keys).agg(best.alias("b")).select(*keys, F.col("b.v").alias(value))


def mean_of_modes(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The mean over all values that are equally the most frequent."""
    counts = value_counts(df, keys, value)
    top = F.rank().over(Window.partitionBy(*keys).orderBy(F.desc("n")))
    return counts.withColumn("_r", top).filter("_r = 1").groupBy(*keys).agg(F.avg(value).alias(value))


def best_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in ``order``, which should end in a unique column."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def joined_set(value: Column | str, sep: str = ",") -> Column:
    """The distinct non-null values in order, as text."""
    return F.array_join(F.array_sort(F.collect_set(value)), sep)


def set_hash(value: Column | str) -> Column:
    return F.md5(joined_set(value))


def bit_sum(number: Column | str) -> Column:
    """Sum of 2^number: a bit set as long as no number repeats."""
    return F.sum(F.pow(F.lit(2), number).cast("bigint"))


def crosstab(df: DataFrame, row: str, column: str, normalize: str | None = None) -> DataFrame:
    """(row, column, n) with margins ('All'), in long form; ``share`` of the row, the column or the whole."""
    label = lambda c: F.when(F.grouping(c) == 1, "All").otherwise(F.coalesce(F.col(c).cast("string"), F.lit("∅")))
    cells = df.cube(row, column).agg(F.count("*").alias("n"), label(row).alias("_r"), label(column).alias("_c")).select(F.col("_r").alias(row), F.col("_c").alias(column), "n")
    if normalize is None:
        return cells
    by = {"index": [row], "columns": [column], "all": []}[normalize]
    margin = {"index": F.col(column) == "All", "columns": F.col(row) == "All", "all": (F.col(row) == "All") & (F.col(column) == "All")}[normalize]
    whole = cells.filter(margin).select(*by, F.col("n").alias("_all"))
    joined = cells.join(whole, by) if by else cells.crossJoin(F.broadcast(whole))  # the whole is one row
    return joined.select(row, column, "n", (F.col("n") / F.col("_all")).alias("share"))


def frequent_groups(df: DataFrame, key: str, least_share: float) -> DataFrame:
    """Rows whose key has more than ``least_share`` of all rows."""
    counts = df.groupBy(key).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n").alias("_all"))
    keep = counts.crossJoin(F.broadcast(total)).filter(F.col("_n") > F.col("_all") * least_share).select(key)
    return df.join(keep, key, "left_semi")


def confusion(df: DataFrame, truth: Column, said: Column) -> DataFrame:
    """tp, fp, fn, tn, sensitivity and specificity of two conditions; a null counts as false."""
    t, s = F.coalesce(truth, F.lit(False)), F.coalesce(said, F.lit(False))
    n = lambda c: F.count_if(c)
    cells = df.agg(n(t & s).alias("tp"), n(~t & s).alias("fp"), n(t & ~s).alias("fn"), n(~t & ~s).alias("tn"))
    ratio = lambda a, b: F.try_divide(F.col(a).cast("double"), (F.col(a) + F.col(b)).cast("double"))
    return cells.withColumns({"sensitivity": ratio("tp", "fn"), "specificity": ratio("tn", "fp")})


def full_grid(df: DataFrame, dims: Sequence[str], *aggs: Column) -> DataFrame:
    """The aggregates for every combination of the dimensions' values, absent ones too. For dimensions of few values:
    the grid is as large as their product."""
    grid = None
    for d in dims:
        values = df.select(d).distinct()
        grid = values if grid is None else grid.crossJoin(F.broadcast(values))
    return grid.join(df.groupBy(*dims).agg(*aggs), list(dims), "left")
