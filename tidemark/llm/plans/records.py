"""Queries over records: nearest vectors, best representatives, groups from pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.components import hash_to_min
from tidemark.llm.survivor import RACES, SEXES, field_sources, survivors, usable_code, usable_date, usable_name
from tidemark.llm.vptree import nearest_vectors
from tidemark.session import read_table


#: By how much the pruning ball is shrunk where some loss is acceptable.
RELAXED = 4.0


def entity_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, vec): the summary table's vector, or the linkage input's for entities without a row there."""
    summary = read_table(spark, sf_dir, "entity_summary_vectors").select(F.col("victim_entity_id").alias("id"), F.col("entity_summary_vec").alias("vec"))
    linkage = read_table(spark, sf_dir, "entity_link_input").select(F.col("unique_id").alias("id"), F.col("summary_vec").alias("vec"))
    return summary.unionByName(linkage.join(summary.select("id").distinct(), "id", "left_anti"))


def p2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_vectors(entity_vectors(spark, sf_dir), k=5, width=64)


def p2_relaxed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with balls a little smaller than is safe: less work, a few neighbours missed (see the README)."""
    return nearest_vectors(entity_vectors(spark, sf_dir), k=5, width=64, factor=RELAXED)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = p2_nearest(spark, sf_dir)
    return near.select(F.least("id", "neighbour").alias("victim_entity_id_l"), F.greatest("id", "neighbour").alias("victim_entity_id_r")).distinct()


def _usable() -> dict:
    return {
        "canonical_fullname": usable_name(F.col("canonical_fullname")),
        "canonical_sex": usable_code(F.col("canonical_sex"), SEXES),
        "canonical_race": usable_code(F.col("canonical_race"), RACES),
        "incident_date": usable_date(F.col("incident_date")),
    }


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "victim_entities")
    return field_sources(rows, "victim_entity_id", _usable(), "entity_row_id", "feed_rank", "updated_at").drop("layer")


def p4_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "victim_entities")
    return survivors(rows, "victim_entity_id", _usable(), "entity_row_id", "feed_rank", "updated_at").withColumn("incident_date", F.col("incident_date").cast("string"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = read_table(spark, sf_dir, "postadj_orphan_cluster_pairs").filter("match_probability >= 0.5")
    return hash_to_min(pairs, "unique_id_l", "unique_id_r").withColumnRenamed("id", "unique_id")


QUERIES = {"p2_found": p2_found, "p2_nearest": p2_nearest, "p2_relaxed": p2_relaxed, "p4_found": p4_found, "p4_survivors": p4_survivors, "p6_found": p6_found}

_P4 = """
with n as (select *, lower(trim(regexp_replace(canonical_fullname, '\\s+', ' ', 'g'))) as s from victim_entities),
m as (select *, regexp_replace(regexp_replace(regexp_replace(s, '^(mr|mrs|ms|miss|dr|rev|sgt|det|officer)\\.?\\s+', ''), '[\\s,]+(jr|sr|ii|iii|iv)\\.?$', ''), '^([^,]+), (.+)$', '\\2 \\1') as p from n),
u as (select victim_entity_id, entity_row_id, feed_rank, updated_at,
   regexp_matches(p, '^\\p{L}[\\p{L}''’-]+ (.* )?\\p{L}[\\p{L}''’-]+$') and not regexp_matches(p, '\\b(doe|unidentified|unknown|withheld|victim|unnamed)\\b')
     and not regexp_matches(p, '^baby\\b') and p not in ('not released', 'not stated', 'not known', 'name to be released') as un,
   lower(trim(canonical_sex)) in ('m', 'male', 'man', 'boy', 'f', 'female', 'woman', 'girl') as us,
   lower(trim(canonical_race)) in ('b', 'black', 'african american', 'w', 'white', 'caucasian', 'a', 'asian', 'pacific islander', 'i', 'native', 'native american', 'american indian', 'indian') as ur,
   year(incident_date) between 1976 and 2017 as ud from m),
big as (select victim_entity_id from victim_entities group by 1 having count(distinct entity_row_id) >= 2),
f as (select victim_entity_id, entity_row_id, feed_rank, updated_at, unnest(['canonical_fullname', 'canonical_sex', 'canonical_race', 'incident_date']) as field_name, unnest([un, us, ur, ud]) as ok from u)
select victim_entity_id, field_name, entity_row_id from f where ok and victim_entity_id in (select victim_entity_id from big)
qualify row_number() over (partition by victim_entity_id, field_name order by feed_rank nulls last, updated_at desc nulls last, entity_row_id) = 1
"""

_FIELDS = ("canonical_fullname", "canonical_sex", "canonical_race", "incident_date")

_P2 = """
with e as (
  select victim_entity_id as id, entity_summary_vec as v from entity_summary_vectors
  union all select unique_id, summary_vec from entity_link_input where unique_id not in (select victim_entity_id from entity_summary_vectors)),
d as materialized (select distinct id, v from e where len(v) = 64 and len(list_filter(v, lambda x: x is not null)) = 64 and len(list_filter(v, lambda x: x <> 0)) > 0),
n as (select a.id, b.id as other, round(list_cosine_similarity(a.v, b.v), 9) as s from d a join d b on a.id <> b.id
  qualify row_number() over (partition by a.id order by round(list_cosine_similarity(a.v, b.v), 9) desc, b.id) <= 5)
"""

_P6 = """
with recursive e as (
  select distinct unique_id_l as a, unique_id_r as b from postadj_orphan_cluster_pairs where match_probability >= 0.5 and unique_id_l <> unique_id_r
  union select distinct unique_id_r, unique_id_l from postadj_orphan_cluster_pairs where match_probability >= 0.5 and unique_id_l <> unique_id_r),
walk as (select a as id, a as seen from e union select w.id, e.b from walk w join e on w.seen = e.a)
select id as unique_id, min(seen) as cluster_id from walk group by id
"""

_CHOSEN = _P4[: _P4.index("select victim_entity_id, field_name, entity_row_id from f")].replace("big as (select victim_entity_id from victim_entities group by 1 having count(distinct entity_row_id) >= 2),\n", "")
_P4_WHOLE = (
    _CHOSEN
    + """, c as (select victim_entity_id, field_name, entity_row_id from f where ok
qualify row_number() over (partition by victim_entity_id, field_name order by feed_rank nulls last, updated_at desc nulls last, entity_row_id) = 1)
select c.victim_entity_id, """
    + ", ".join(f"cast(max(case when field_name = '{n}' then v.{n} end) as varchar) as {n}, max(case when field_name = '{n}' then c.entity_row_id end) as {n}_row" for n in _FIELDS)
    + " from c join victim_entities v on c.victim_entity_id = v.victim_entity_id and c.entity_row_id = v.entity_row_id group by 1"
)

ORACLE = {
    "p2_nearest": _P2 + "select id, other as neighbour, s as similarity, cast(row_number() over (partition by id order by s desc, other) as integer) as rank from n",
    "p4_survivors": _P4_WHOLE,
    "p2_found": _P2 + "select distinct least(id, other) as victim_entity_id_l, greatest(id, other) as victim_entity_id_r from n",
    "p4_found": _P4,
    "p6_found": _P6,
}
