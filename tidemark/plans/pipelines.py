"""Whole linkage stages as queries: dedupe named victims, link unnamed ones, link to the register, cluster what is left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import categories, dates
from tidemark.functions.names import name_parts
from tidemark.operators import aggregates as agg
from tidemark.operators import assignment, canonical, clustering, comparisons as cmp, jobs, tables, validation
from tidemark.operators.blocking import Rule
from tidemark.operators.linkage import Training
from tidemark.session import Scratch
from tidemark.session import read_table as T

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn

    return add


def named_victims(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of all feeds that name a victim, with name parts, coded sex and race, and the middle of their days."""
    v = T(spark, sf, "victim_entities").dropDuplicates(["entity_row_id"])
    parts = name_parts(F.regexp_replace("canonical_fullname", r"^\s*([^,]+), *(.+)$", "$2 $1"))
    sex, race = F.substring(F.lower(F.trim("canonical_sex")), 1, 1), F.substring(F.lower(F.trim("canonical_race")), 1, 1)
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.col("min_event_day"))
    return v.select(
        F.col("entity_row_id").alias("unique_id"), "city_id", parts["forename"].alias("victim_forename"), parts["surname"].alias("victim_surname"), parts["full"].alias("victim_fullname"),
        F.when(sex.isin("m", "f", "w"), F.replace(sex, F.lit("w"), F.lit("f"))).alias("victim_sex"), F.when(race.isin("b", "w", "a", "i", "n"), F.replace(race, F.lit("n"), F.lit("i"))).alias("victim_race"),
        ((F.col("min_event_day") + F.col("max_event_day")) / 2).alias("midpoint_day"), F.lit("day").alias("date_precision"), F.year(day).alias("year"), F.month(day).alias("month"), F.col("entity_row_id").cast("string").alias("exclusion_id"),
    ).filter("victim_surname is not null")


@query()
def q_dedupe_named_victims(spark: SparkSession, sf: str) -> DataFrame:
    """Clusters of rows that name the same victim, from blocking to constrained clusters (no two rows of one feed's delivery are
    barred here: feeds repeat themselves)."""
    job = jobs.Job(
        "unique_id", (cmp.name(), cmp.date(), cmp.same("victim_sex", "sex"), cmp.same("victim_race", "race")),
        (*[r for r in cmp.named_victim_rules() if r.name in ("names", "left forename missing", "right forename missing")], Rule("month", ("city_id", "year", "month")), Rule("year and surname sound", ("city_id", "year", "soundex(victim_surname)"))),
        training=(Training((Rule("month", ("city_id", "year", "month")),), ("date",)), Training((Rule("names", ("victim_surname", "victim_forename")),), ("name",))),
        deterministic=(Rule("sure", ("city_id", "victim_surname", "victim_forename", "midpoint_day")),), recall=0.6, predict_threshold=0.6, cluster_threshold=0.75,
    )
    return jobs.run(job, Scratch(spark).keep(named_victims(spark, sf))).clusters.select("cluster_id", "member_id")


def named_victims_with_incidents(spark: SparkSession, sf: str) -> DataFrame:
    """The rows that name a victim with what is known of the incident: age, place, weapon, offender, summary."""
    e = coded(T(spark, sf, "entity_link_input").dropDuplicates(["unique_id"]))
    known = e.select(
        F.col("unique_id").alias("victim_entity_id"), "day", "lat", "lon", "geo_address_norm", "geo_address_short", F.lit(None).cast("string").alias("address_type"), "victim_age", "weapon", "circumstance", "relationship",
        "offender_age", "offender_sex", "summary_vec",
    )
    of = T(spark, sf, "victim_entities").select(F.col("entity_row_id").alias("unique_id"), "victim_entity_id").distinct()
    return named_victims(spark, sf).join(of, "unique_id").join(known, "victim_entity_id", "left").drop("victim_entity_id")


@query()
def q_dedupe_entities(spark: SparkSession, sf: str) -> DataFrame:
    """Clusters of named victims by the whole catalogue of blocks, with its training and deterministic sets; unions the first
    pass blocks are not proposed again."""
    comparisons = (cmp.name(), cmp.date(), cmp.age(), cmp.place(), cmp.same("victim_sex", "sex"), cmp.same("victim_race", "race"), cmp.weapon(), cmp.circumstance(), cmp.age("offender_age", label="offender_age"), cmp.same("offender_sex"))
    job = jobs.Job(
        "unique_id", comparisons, cmp.named_victim_rules(), training=cmp.named_victim_training(), deterministic=cmp.named_victim_sure(), recall=0.6, predict_threshold=0.5, cluster_threshold=0.9, exclusion="exclusion_id", two_passes=True, em_runs=3,
    )
    return jobs.run(job, Scratch(spark).keep(named_victims_with_incidents(spark, sf))).clusters.select("cluster_id", "member_id")


def in_shared_months(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of both sides in the months that both cover. A row known to the year only (no month) may lie in each month of its
    year: it covers them all, and stays if any month of its year is shared."""
    every = F.sequence(F.lit(1), F.lit(12))
    covers = lambda df: df.select("year", F.explode(F.when(F.col("month").isNull(), every).otherwise(F.array("month"))).alias("month")).distinct()
    shared = covers(left).join(covers(right), ["year", "month"]).select(F.col("year").alias("_y"), F.col("month").alias("_m"))
    within = (F.col("year") == F.col("_y")) & (F.col("month").isNull() | (F.col("month") == F.col("_m")))
    return left.join(shared, within, "left_semi"), right.join(shared, within, "left_semi")


def coded(df: DataFrame) -> DataFrame:
    """One word for weapons that articles call differently; what is said to be unknown becomes null."""
    weapon = F.when(F.col("weapon").isin("gun", "pistol", "handgun"), "firearm").when(F.col("weapon").isin("club", "hammer"), "blunt object").when(F.col("weapon").isin("stabbing", "sharp object"), "knife").when(F.col("weapon").isin("fists", "beating"), "personal weapon").when(F.col("weapon") == "arson", "fire").otherwise(F.nullif(F.col("weapon"), F.lit("unknown")))
    return df.withColumns({"weapon": weapon, "circumstance": F.nullif(F.col("circumstance"), F.lit("undetermined")), "relationship": F.nullif(F.col("relationship"), F.lit("unknown relationship"))})


@query()
def q_link_register(spark: SparkSession, sf: str) -> DataFrame:
    """Unnamed victims and register rows one to one, in the months that both sources cover; victims whose date is known to the
    year only take part in every month of it."""
    scratch = Scratch(spark)
    w = Window.partitionBy("YearMonth")
    s = T(spark, sf, "shr").dropDuplicates(["index"])
    town = F.upper(F.regexp_replace("CNTYFIPS", " County$", ""))
    mid = dates.spread_in_month(F.col("YearMonth"), F.dense_rank().over(w.orderBy("Incident")), F.count("*").over(w))
    right = s.select(
        F.concat(F.lit("s"), F.col("index").cast("string")).alias("unique_id"), town.alias("city_id"), mid.alias("midpoint_day"), F.lit("month").alias("date_precision"), F.col("Year").alias("year"),
        F.substring("YearMonth", 6, 2).cast("int").alias("month"), F.nullif(F.col("VicAge"), F.lit(999)).alias("victim_age"), F.when(F.lower("VicSex").startswith("m"), "male").when(F.lower("VicSex").startswith("f"), "female").alias("victim_sex"),
        F.nullif(categories.weapon(F.col("Weapon")), F.lit("unknown")).alias("weapon"), F.nullif(categories.circumstance(F.col("Circumstance")), F.lit("undetermined")).alias("circumstance"), categories.relationship(F.col("Relationship")).alias("relationship"),
        F.nullif(F.col("OffAge"), F.lit(999)).alias("offender_age"),
    )
    o = T(spark, sf, "orphan_link_input").dropDuplicates(["unique_id"])
    towns = agg.modal_value(o.withColumn("t", F.nullif(F.regexp_extract("geo_address_norm", r",\s*([^,]+)$", 1), F.lit(""))), ["city_id"], "t")
    o = coded(o)
    left = o.join(towns, "city_id").select(*[F.col("t").alias("city_id") if c == "city_id" else c for c in right.columns])
    left, right = (scratch.keep(x) for x in in_shared_months(left, right))
    job = jobs.Job(
        "unique_id", (cmp.date(), cmp.age(steps=(0, 1, 2, 5, 10)), cmp.same("victim_sex", "sex"), cmp.weapon(), cmp.circumstance(), cmp.relationship(), cmp.age("offender_age", label="offender_age")), cmp.register_rules(),
        training=cmp.register_training(), deterministic=cmp.register_sure(), recall=0.5, predict_threshold=0.5, one_to_one=True,
    )
    return jobs.run(job, left, right).matches.select("id_l", "id_r", F.round("match_probability", 6).alias("p"))


@query()
def q_link_unnamed_victims(spark: SparkSession, sf: str) -> DataFrame:
    """Unnamed victims (all of them) and the named entities (all of them) they are; none of an entity that stands in the victim's
    own article. Within an article the pairs of the largest total weight, so that no two victims of it are one entity. Unnamed
    victims have no summary vector in these tables: there the summary tells nothing."""
    scratch = Scratch(spark)
    e = coded(T(spark, sf, "entity_link_input").dropDuplicates(["unique_id"])).withColumn("address_type", F.lit(None).cast("string"))
    o = coded(T(spark, sf, "orphan_link_input").dropDuplicates(["unique_id"])).withColumn("summary_vec", F.lit(None).cast("array<double>"))
    articles = e.select(F.col("unique_id").alias("e"), F.explode(F.split("article_ids_csv", ",")).alias("x")).select("e", F.trim("x").try_cast("bigint").alias("article_id"))
    shared = o.select("unique_id", "article_id").join(articles, "article_id").groupBy("unique_id").agg(F.collect_set("e").alias("shared"))
    none = F.array().cast("array<string>")
    o = o.join(shared, "unique_id", "left").withColumn("exclusion_ids", F.array_union(F.coalesce("exclusion_ids", none), F.coalesce("shared", none)))
    columns = [c for c in e.columns if c in o.columns and c != "loaded_at"]
    left, right = scratch.keep(e.select(*columns), "entities"), scratch.keep(o.select(*columns, "article_id"), "orphans")
    job = jobs.Job(
        "unique_id", (cmp.date(), cmp.age(), cmp.place(), cmp.same("victim_sex", "sex"), cmp.offender(), cmp.weapon(), cmp.circumstance(), cmp.relationship(), cmp.summary(), cmp.same("victim_count"), cmp.age("offender_age", label="offender_age"), cmp.same("offender_sex"), cmp.same("victim_race", "race", tf=True)),
        cmp.orphan_rules(),
        training=cmp.orphan_training(), deterministic=cmp.orphan_sure(), recall=0.1, predict_threshold=0.45,
    )
    pairs = jobs.run(job, left, right.drop("article_id")).pairs.join(right.select(F.col("unique_id").alias("id_r"), F.coalesce("article_id", F.lit(-1)).alias("article_id")), "id_r")
    chosen = assignment.match_groups(pairs, "article_id", "id_l", "id_r", "match_weight", full=True).drop("match_weight", "article_id")
    return chosen.join(pairs, ["id_l", "id_r"]).select("id_l", "id_r", F.round("match_probability", 6).alias("p"))


@query()
def q_leftover_clusters(spark: SparkSession, sf: str) -> DataFrame:
    """Clusters of two or more among the unnamed victims that are left, never two of one article; the rest stay single."""
    p = T(spark, sf, "postadj_orphan_cluster_pairs").filter("match_probability >= 0.5")
    ids = p.select(F.col("unique_id_l").alias("member_id")).unionByName(p.select(F.col("unique_id_r").alias("member_id"))).distinct()
    barred = ids.withColumn("exclusion_id", F.split_part("member_id", F.lit(":"), F.lit(1)))
    out = clustering.constrained_clusters(p, "unique_id_l", "unique_id_r", "match_probability", barred, 0.5)
    big = out["sizes"].filter("n >= 2").select("cluster_id")
    absorbed = out["clusters"].join(big, "cluster_id", "left_semi").select(F.col("member_id").alias("unique_id"), F.col("cluster_id").alias("entity_id"), F.lit("cluster").alias("origin"))
    every = T(spark, sf, "orphan_link_input").select("unique_id").distinct()
    single = every.join(absorbed.select("unique_id"), "unique_id", "left_anti").select("unique_id", F.col("unique_id").alias("entity_id"), F.lit("single").alias("origin"))
    return absorbed.unionByName(single)


@query("""with recursive e as (select unique_id, min(city_id) as c, min(midpoint_day) as d from entity_link_input group by 1), o as (select unique_id, min(city_id) as c, min(midpoint_day) as d from orphan_link_input group by 1),
m as (select o.unique_id as member_id, min(e.unique_id) as entity_id from o join e on o.c = e.c and o.d = e.d group by 1),
p as (select unique_id_l as a, unique_id_r as b from postadj_orphan_cluster_pairs where match_probability >= 0.8 and unique_id_l <> unique_id_r and unique_id_l not in (select member_id from m) and unique_id_r not in (select member_id from m)),
g as (select a, b from p union select b, a from p), w as (select a as id, a as s from g union select w.id, g.b from w join g on w.s = g.a), k as (select id, min(s) as entity_id from w group by 1)
select unique_id as entity_id, unique_id as member_id, 'named' as origin from e union all select entity_id, member_id, 'matched' from m union all select entity_id, id, 'cluster' from k
union all select unique_id, unique_id, 'single' from o where unique_id not in (select member_id from m) and unique_id not in (select id from k)""")
def q_entity_members(spark: SparkSession, sf: str) -> DataFrame:
    """The members of every final entity by origin: named rows, unnamed victims matched to an entity (here: same city and day),
    clusters of what is left, and what stays single."""
    first = lambda t: T(spark, sf, t).groupBy("unique_id").agg(F.min("city_id").alias("c"), F.min("midpoint_day").alias("d"))
    e, o = first("entity_link_input"), first("orphan_link_input")
    matched = Scratch(spark).keep(o.withColumnRenamed("unique_id", "member_id").join(e, ["c", "d"]).groupBy("member_id").agg(F.min("unique_id").alias("entity_id")), "matched")
    p = T(spark, sf, "postadj_orphan_cluster_pairs").filter("match_probability >= 0.8")
    for side in ("unique_id_l", "unique_id_r"):
        p = p.join(matched.select(F.col("member_id").alias(side)), side, "left_anti")
    clusters = clustering.connected_components(p, "unique_id_l", "unique_id_r").select(F.col("component").alias("cluster_id"), F.col("id").alias("member_id"))
    left = o.select(F.col("unique_id").alias("member_id")).join(matched, "member_id", "left_anti").join(clusters, "member_id", "left_anti")
    return canonical.member_union(e.select(F.col("unique_id").alias("entity_id"), F.col("unique_id").alias("member_id")), matched, clusters, left)


@query("""with g as (select addr_key, any_value(matched_address) as a, any_value(nullif(y_lat, 0)) as lat, any_value(nullif(x_lon, 0)) as lon from (select distinct input_address as addr_key, matched_address, y_lat, x_lon from mar_cache) group by 1)
select addr_id, m.addr_key, g.a as geo_address_norm, g.lat, g.lon from mar_addr_map m left join g using (addr_key)""")
def q_push_geocodes(spark: SparkSession, sf: str) -> DataFrame:
    """What the geocoder found, pushed to the rows that asked; a coordinate of zero is none."""
    rows = T(spark, sf, "mar_addr_map").select("addr_id", "addr_key").withColumns({"geo_address_norm": F.lit(None).cast("string"), "lat": F.lit(None).cast("double"), "lon": F.lit(None).cast("double")})
    none = F.lit(0.0)
    found = T(spark, sf, "mar_cache").dropDuplicates(["input_address"]).select(F.col("input_address").alias("addr_key"), F.col("matched_address").alias("geo_address_norm"), F.nullif(F.col("y_lat"), none).alias("lat"), F.nullif(F.col("x_lon"), none).alias("lon"))
    return tables.update_from(rows, found, ["addr_key"], ["geo_address_norm", "lat", "lon"])


@query("""with e as (select distinct unique_id, trim(x) as a from entity_link_input, unnest(string_split(article_ids_csv, ',')) u(x)), o as (select distinct unique_id, trim(x) as a from orphan_link_input, unnest(string_split(article_ids_csv, ',')) u(x))
select o.unique_id, string_agg(distinct e.unique_id, ',' order by e.unique_id) as exclusion_ids from o join e on cast(o.a as bigint) % 500000 = cast(e.a as bigint) % 500000 group by 1""")
def q_same_article_exclusions(spark: SparkSession, sf: str) -> DataFrame:
    """For each unnamed victim the entities that stand in one of its articles (ids brought to one range)."""
    split = lambda t: T(spark, sf, t).select("unique_id", F.explode(F.split("article_ids_csv", ",")).alias("x")).select("unique_id", (F.trim("x").cast("bigint") % 500000).alias("a")).distinct()
    e, o = split("entity_link_input").withColumnRenamed("unique_id", "e"), split("orphan_link_input")
    return o.join(e, "a").groupBy("unique_id").agg(agg.joined_set("e").alias("exclusion_ids"))


@query("""select f as "check", count(*) as n from (select unnest(list_filter([case when not coalesce(VicAge between 0 and 110, false) then 'age' end, case when not coalesce(lower(VicSex) in ('m', 'male', 'f', 'female'), false) then 'sex' end,
case when not coalesce(Incident > 0, false) then 'incident' end, case when not coalesce(length(YearMonth) = 7, false) then 'month' end], lambda x: x is not null)) as f from shr) group by 1""")
def q_validation(spark: SparkSession, sf: str) -> DataFrame:
    checks = {"age": F.col("VicAge").between(0, 110), "sex": F.lower("VicSex").isin("m", "male", "f", "female"), "incident": F.col("Incident") > 0, "month": F.length("YearMonth") == 7}
    return validation.failure_counts(T(spark, sf, "shr"), checks)
