"""Reading and writing: parquet, CSV, JSON lines, register files, polygons, model files, report exports."""

from __future__ import annotations

import json
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.cluster_diff import banded

#: The nested incidents of an extracted article.
INCIDENTS = T.ArrayType(T.StructType([
    *[T.StructField(n, T.StringType()) for n in (
        "year", "month", "day", "location", "circumstance", "killing_method", "weapon", "offender_count", "offender_name", "offender_age", "offender_sex", "offender_race",
        "offender_ethnicity", "victim_count", "summary")],
    T.StructField("victim", T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in (
        "victim_name", "victim_age", "victim_sex", "victim_race", "victim_ethnicity", "relationship", "victim_count")]))),
]))


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None, drop: Sequence[str] = ("_band_helper",)) -> DataFrame:
    """CSV with a header. With a schema nothing is scanned twice; without, types are inferred."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    df = (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)
    return df.drop(*drop)


def read_register(spark: SparkSession, path: str, state: str | None = None, years: tuple[int, int] | None = None) -> DataFrame:
    """A register file (CSV or parquet) cut to a state and years, with YearMonth derived from Year and Month."""
    df = spark.read.parquet(path) if path.endswith(".parquet") else read_csv(spark, path)
    if state:
        df = df.filter(F.col("State") == state)
    if years:
        df = df.filter(F.col("Year").between(*years))
    return with_year_month(df)


def with_year_month(df: DataFrame) -> DataFrame:
    stamp = F.try_to_date(F.concat_ws(" ", F.lit("1"), F.col("Month"), F.col("Year").cast("string")), "d MMMM yyyy")
    return df.withColumn("YearMonth", F.date_format(stamp, "yyyy-MM"))


def explode_incidents(articles: DataFrame, article: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(incidents, victims) of the nested JSON, numbered from 0; malformed JSON counts as an empty list.
    victim_row_id is article:incident:victim."""
    parsed = articles.select(F.col(article).alias("article_id"), F.from_json(F.col(text), INCIDENTS).alias("i"))
    incidents = parsed.select("article_id", F.posexplode("i").alias("incident_idx", "inc")).select("article_id", "incident_idx", "inc.*")
    weapon = F.coalesce("killing_method", "weapon")
    incidents = incidents.withColumn("weapon", F.when(weapon == "beating", "personal weapon").otherwise(weapon)).drop("killing_method")
    victims = incidents.select("article_id", "incident_idx", F.posexplode("victim").alias("victim_idx", "v")).select("article_id", "incident_idx", "victim_idx", "v.*")
    return incidents.drop("victim"), victims.withColumn("victim_row_id", F.concat_ws(":", F.col("article_id").cast("string"), "incident_idx", "victim_idx"))


def read_polygons(spark: SparkSession, path: str, name: str = "boro_name") -> DataFrame:
    """(region, ring) of a GeoJSON file: outer rings, one row each. Region files are small and read by the driver."""
    rows = []
    for f in json.loads(Path(path).read_text())["features"]:
        g = f["geometry"]
        shapes = g["coordinates"] if g["type"] == "MultiPolygon" else [g["coordinates"]]
        rows += [(f["properties"][name], [(float(x), float(y)) for x, y, *_ in shape[0]]) for shape in shapes]
    return spark.createDataFrame(rows, "region string, ring array<struct<lon: double, lat: double>>")


def export_report(df: DataFrame, path: str, order: Sequence[str], band: str | None = None) -> None:
    """One CSV with header in order, control characters scrubbed, with a band column for alternating colours. For reports that a
    person reads; larger results are written as parquet."""
    clean = df.select(*[F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "").alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])
    out = banded(clean, band) if band else clean
    out.orderBy(*order).coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def swap_in(df: DataFrame, path: str) -> None:
    """Writes beside the target and renames, so that readers see the old or the new table and never a part."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(path + ".new")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    new, old, target = (jvm.org.apache.hadoop.fs.Path(path + s) for s in (".new", ".old", ""))
    fs = target.getFileSystem(conf)
    fs.delete(old, True)
    if fs.exists(target):
        fs.rename(target, old)
    fs.rename(new, target)
    fs.delete(old, True)


def rows(spark: SparkSession, sql: str, args: Sequence | None = None) -> list[dict]:
    """A parameterised query's rows as dicts; for small results at the edge of a program."""
    return [r.asDict(recursive=True) for r in spark.sql(sql, args=list(args or [])).collect()]


def script(spark: SparkSession, sql: str) -> DataFrame | None:
    """Statements separated by semicolons, run in order; the last one's result."""
    out = None
    for part in (s.strip() for s in sql.split(";")):
        if part:
            out = spark.sql(part)
    return out
