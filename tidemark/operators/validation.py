"""Checks of rows that gather all failures instead of stopping at the first."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_failures(df: DataFrame, checks: Mapping[str, Column], name: str = "failures") -> DataFrame:
    """The names of the checks that a row does not pass; a check that is null fails."""
    failed = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(label)) for label, ok in checks.items()]
    return df.withColumn(name, F.array_compact(F.array(*failed)))


def failure_counts(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    return with_failures(df, checks).select(F.explode("failures").alias("check")).groupBy("check").agg(F.count("*").alias("n"))
