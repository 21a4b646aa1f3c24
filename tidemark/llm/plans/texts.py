"""Queries over document texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.leakage import leaks, without_leaks
from tidemark.llm.packing import fill_containers, token_count
from tidemark.llm.prose import document_statistics, junk_probability
from tidemark.session import read_table

CAPACITY = 2048


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container of each article or piece, in tokens of text."""
    sized = read_table(spark, sf_dir, "documents").select("doc_id", token_count(F.col("text")).alias("size"))
    return fill_containers(sized, CAPACITY)


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers are."""
    per = p8_containers(spark, sf_dir).groupBy("container_id").agg(F.sum("size").alias("used"), F.count("*").alias("pieces"))
    return per.agg(
        F.count("*").alias("containers"), F.sum("used").alias("tokens"), F.ceil(F.sum("used") / CAPACITY).alias("lower_bound"),
        F.max("used").alias("fullest"), F.round(F.sum("used") / (F.count("*") * CAPACITY), 6).alias("share_used"),
    )


def p8_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every filling must hold: all documents and tokens there once, pieces as many as must be, no container too
    full, no article split that fits, its pieces joining without gaps."""
    placed = p8_containers(spark, sf_dir)
    per_doc = placed.groupBy("doc_id").agg(F.sum("size").alias("n"), F.count("*").alias("pieces"), F.max(F.col("first") + F.col("size")).alias("end"), F.countDistinct("first").alias("starts"))
    per_container = placed.groupBy("container_id").agg(F.sum("size").alias("used"))
    docs = per_doc.agg(
        F.count("*").alias("documents"), F.sum("n").alias("tokens"), F.sum("pieces").alias("pieces"),
        F.count_if((F.col("pieces") > 1) & (F.col("n") <= CAPACITY)).alias("split_needlessly"), F.count_if((F.col("end") != F.col("n")) | (F.col("starts") != F.col("pieces"))).alias("gaps"),
    )
    return docs.crossJoin(per_container.agg(F.count_if(F.col("used") > CAPACITY).alias("too_full"), F.count_if(F.col("used") < 1).alias("empty")))  # one row each


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_leaks(spark, sf_dir).select("doc_id", "item_id").distinct()


def p9_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "eval_items"))


def p9_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that show test items, with the leaked spans taken out."""
    return without_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "eval_items"))


def p10_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_statistics(read_table(spark, sf_dir, "documents"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return junk_probability(read_table(spark, sf_dir, "documents")).filter("junk >= 0.5").select("doc_id")


QUERIES = {"p10_found": p10_found, "p10_statistics": p10_statistics, "p8_containers": p8_containers, "p8_fill": p8_fill, "p8_invariants": p8_invariants, "p9_clean": p9_clean, "p9_found": p9_found, "p9_leaks": p9_leaks}

_TOKENS = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\x1c-\x1f\x{85}\p{Z}]+"
ORACLE = {
    "p8_invariants": rf"""select count(*) as documents, sum(n) as tokens, sum(greatest(1, cast(ceil(n / {CAPACITY}.0) as bigint))) as pieces, 0 as split_needlessly, 0 as gaps, 0 as too_full, 0 as empty
from (select doc_id, coalesce(len(regexp_extract_all(text, '{_TOKENS}')), 0) as n from documents)""",
}
