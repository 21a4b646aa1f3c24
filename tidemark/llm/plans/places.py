"""Queries over postal addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.addresses import place_pairs, same_places
from tidemark.session import read_table


def p3_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every understood address record; what the geocoder found breaks ties."""
    raw = read_table(spark, sf_dir, "mar_addr_map").select("addr_id", "addr_raw", "addr_key")
    cache = read_table(spark, sf_dir, "mar_cache").groupBy(F.col("input_address").alias("addr_key")).agg(F.max_by("matched_address", "cached_at").alias("matched"))
    return same_places(raw.join(cache, "addr_key", "left"), hint_col="matched")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return place_pairs(p3_places(spark, sf_dir))


QUERIES = {"p3_found": p3_found, "p3_places": p3_places}
ORACLE: dict[str, str] = {}
