"""Queries that match register rows with unnamed victims."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.killings import BLOCKS, candidate_pairs, orphan_records, register_records
from tidemark.llm.mixture import fit_and_score
from tidemark.session import Scratch, read_table


def p1_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate pair with the confidence that both are about the same victim."""
    scratch = Scratch(spark)
    orphans = scratch.keep(orphan_records(read_table(spark, sf_dir, "orphan_link_input")), "orphans")
    register = scratch.keep(register_records(read_table(spark, sf_dir, "shr")), "register")
    pairs = candidate_pairs(orphans, register)
    scored, _ = fit_and_score(pairs, BLOCKS, owner="l_id", target="r_id", rival="incident", facts=("l_sex", "l_race"), chance="chance")
    return scored.select(F.col("r_id").alias("shr_index"), F.col("l_id").alias("unique_id"), "posterior")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_scored(spark, sf_dir).filter("posterior >= 0.5").select("shr_index", "unique_id")


QUERIES = {"p1_found": p1_found, "p1_scored": p1_scored}
ORACLE: dict[str, str] = {}
