"""Queries of the general data operators: copies of a table compared, points near points."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.diffing import diff_tables
from tidemark.operators.spatial import near_points
from tidemark.session import read_table

#: The compared fields of the match report and how each is compared.
REPORT_FIELDS = {
    "e_mid": "number", "prob": "number", "v_name": "text", "v_age": "number", "v_sex": "text", "v_race": "text",
    "weapon": "text", "circumstance": "text", "article_ids_csv": "list", "matched_on": "exact",
}


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = read_table(spark, sf_dir, "shr_matches_diffs")
    return diff_tables(
        report.filter("source = 1"), report.filter("source = 2"), "match_uid", REPORT_FIELDS,
        labels=("gone_match", "new_match", "changed"),
    )


def p5_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p5_found(spark, sf_dir).groupBy("diff_type", "field_name").agg(F.count("*").alias("n"))


def _near(spark: SparkSession, sf_dir: str, more: list[str]) -> DataFrame:
    orphans = read_table(spark, sf_dir, "orphan_link_input").select("unique_id", "lat", "lon")
    cache = read_table(spark, sf_dir, "nyc_borough_cache").filter("status = 'matched'")
    return near_points(orphans, cache, 0.150, "unique_id", "input_address", right_at=("y_lat", "x_lon"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _near(spark, sf_dir, []).select("unique_id", "input_address")


def borough_name(c):
    return F.initcap(F.regexp_replace(F.trim(F.lower(c)), "^borough of ", ""))


def p7_borough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The borough of each orphan record: that of the nearest cached address (ties to the smaller address)."""
    cache = read_table(spark, sf_dir, "nyc_borough_cache").filter("status = 'matched'")
    named = cache.groupBy("input_address").agg(F.min(borough_name(F.col("borough"))).alias("borough"))
    near = _near(spark, sf_dir, []).join(named, "input_address")
    best = F.min_by("borough", F.struct(F.round("distance_km", 9), "input_address"))
    return near.groupBy("unique_id").agg(best.alias("borough"), F.count("*").alias("n_near"))


QUERIES = {"p5_found": p5_found, "p5_summary": p5_summary, "p7_found": p7_found, "p7_borough": p7_borough}

_P5 = """
with t as (
  select distinct source, match_uid,
    e_mid, prob, cast(v_age as double) as v_age,
    coalesce(lower(trim(regexp_replace(v_name, '\\s+', ' ', 'g'))), '') as v_name,
    coalesce(lower(trim(regexp_replace(v_sex, '\\s+', ' ', 'g'))), '') as v_sex,
    coalesce(lower(trim(regexp_replace(v_race, '\\s+', ' ', 'g'))), '') as v_race,
    coalesce(lower(trim(regexp_replace(weapon, '\\s+', ' ', 'g'))), '') as weapon,
    coalesce(lower(trim(regexp_replace(circumstance, '\\s+', ' ', 'g'))), '') as circumstance,
    coalesce(array_to_string(list_sort(string_split(regexp_replace(article_ids_csv, '\\s+', '', 'g'), ',')), ','), '') as article_ids_csv,
    coalesce(cast(matched_on as varchar), '') as matched_on
  from shr_matches_diffs),
l as (select * from t where source = 1), r as (select * from t where source = 2),
b as (select l.match_uid,
    case when (l.e_mid is null) <> (r.e_mid is null) or round(abs(l.e_mid - r.e_mid), 9) >= 0.000001 then 1 end as e_mid,
    case when (l.prob is null) <> (r.prob is null) or round(abs(l.prob - r.prob), 9) >= 0.000001 then 1 end as prob,
    case when (l.v_age is null) <> (r.v_age is null) or round(abs(l.v_age - r.v_age), 9) >= 0.000001 then 1 end as v_age,
    case when l.v_name <> r.v_name then 1 end as v_name, case when l.v_sex <> r.v_sex then 1 end as v_sex,
    case when l.v_race <> r.v_race then 1 end as v_race, case when l.weapon <> r.weapon then 1 end as weapon,
    case when l.circumstance <> r.circumstance then 1 end as circumstance,
    case when l.article_ids_csv <> r.article_ids_csv then 1 end as article_ids_csv,
    case when l.matched_on <> r.matched_on then 1 end as matched_on
  from l join r on l.match_uid = r.match_uid),
found as (
  select distinct match_uid, 'gone_match' as diff_type, '' as field_name from l where match_uid not in (select match_uid from r)
  union all
  select distinct match_uid, 'new_match', '' from r where match_uid not in (select match_uid from l)
  union all
  select match_uid, 'changed', name from (unpivot b on e_mid, prob, v_name, v_age, v_sex, v_race, weapon, circumstance, article_ids_csv, matched_on into name name value v))
"""

_P7 = """
with o as (select distinct unique_id, lat, lon from orphan_link_input where lat between -90 and 90 and lon between -180 and 180),
c as (select distinct input_address, y_lat, x_lon, borough from nyc_borough_cache where status = 'matched' and y_lat between -90 and 90 and x_lon between -180 and 180),
near as (select unique_id, input_address, borough,
    2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin(radians(y_lat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(y_lat)) * pow(sin(radians(x_lon - lon) / 2), 2)))) as km
  from o join c on abs(y_lat - lat) < 0.0014 where abs(x_lon - lon) < 0.1 or abs(lat) > 80)
"""

ORACLE = {
    "p5_found": _P5 + "select distinct match_uid, diff_type, field_name from found",
    "p5_summary": _P5 + "select diff_type, field_name, count(*) as n from (select distinct * from found) group by all",
    "p7_found": _P7 + "select distinct unique_id, input_address from near where km <= 0.15",
    "p7_borough": _P7
    + """, named as (select input_address, min(b) as borough from (select input_address,
      array_to_string(list_transform(string_split(regexp_replace(trim(lower(borough)), '^borough of ', ''), ' '), lambda w: upper(w[1]) || w[2:]), ' ') as b
      from nyc_borough_cache where status = 'matched') group by input_address),
    near2 as (select distinct unique_id, n.input_address, named.borough, round(km, 9) as km from near n join named on n.input_address = named.input_address where km <= 0.15)
    select unique_id, first(borough order by km, input_address) as borough, count(*) as n_near from near2 group by unique_id""",
}
