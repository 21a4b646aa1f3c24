"""The article catalogue's statements as queries: documents stand in for articles, their source for the article type."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.text import clip
from tidemark.functions import outcomes, vectors
from tidemark.operators import aggregates as agg
from tidemark.operators import candidates, ranking, tables
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


#: Types an article can have that do not make it worth reading (fixed values), in the wider and the narrower form.
POOR_TYPES = (7, 8, 9, 10, 12, 13, 19, 21)
POOR_TYPES_NARROW = tuple(t for t in POOR_TYPES if t != 12)
_A = "(select doc_id as id, title, publication, pub_date, auto_class, lang as label, loaded_at from documents)"
_TYPES = "(select doc_id as id, length(title) % 23 as type_id from documents union select doc_id, length(source) % 23 from documents)"
_LINKS = "(select \"index\" as s, 1 + (\"index\" * 7 + k * 13) % 900 as id from shr, (select unnest([0, 1, 2]) as k) where \"index\" % 4 > k)"


def articles(spark: SparkSession, sf: str) -> DataFrame:
    return T(spark, sf, "documents").select(F.col("doc_id").alias("id"), "title", "publication", "pub_date", "auto_class", F.col("lang").alias("label"), "loaded_at")


def types(spark: SparkSession, sf: str) -> DataFrame:
    d = T(spark, sf, "documents")
    a = d.select(F.col("doc_id").alias("id"), (F.length("title") % 23).alias("type_id"))
    return a.unionByName(d.select(F.col("doc_id").alias("id"), (F.length("source") % 23).alias("type_id"))).distinct()


def links(spark: SparkSession, sf: str) -> DataFrame:
    """(s, id): register rows linked to articles."""
    s = T(spark, sf, "shr").select(F.col("index").alias("s")).withColumn("k", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    return s.filter("s % 4 > k").select("s", (1 + (F.col("s") * 7 + F.col("k") * 13) % 900).alias("id"))


def with_types(spark: SparkSession, sf: str) -> DataFrame:
    """Articles with the number of good types and their bit set: the aggregate first, then one join on the key."""
    per = types(spark, sf).groupBy("id").agg(F.sum(F.when(F.col("type_id").isin(*POOR_TYPES), 0).otherwise(1)).alias("good_types"), agg.bit_sum("type_id").alias("binary_types"))
    return articles(spark, sf).join(per, "id")


_JOINED = f"""select a.*, good_types, binary_types from {_A} a join (select id, sum(case when type_id in (7, 8, 9, 10, 12, 13, 19, 21) then 0 else 1 end) as good_types,
 cast(sum(cast(power(2, type_id) as bigint)) as bigint) as binary_types from {_TYPES} group by 1) t on a.id = t.id"""


@query(f"select id, good_types, binary_types from ({_JOINED})")
def q_article_type_join(spark: SparkSession, sf: str) -> DataFrame:
    return with_types(spark, sf).select("id", "good_types", "binary_types")


@query(f"select id, title from ({_JOINED}) where good_types >= 1 and auto_class is null or (good_types >= 1 and auto_class = 'O' and pub_date = '19901010')")
def q_unverified_articles(spark: SparkSession, sf: str) -> DataFrame:
    rows = with_types(spark, sf).filter("good_types >= 1 and auto_class is null or (good_types >= 1 and auto_class = 'O' and pub_date = '19901010')")
    return rows.select("id", "title")


@query(f"select id from ({_JOINED}) where (binary_types & 128) > 0 and not contains(lower(title), 'ad')")
def q_bitmask_filter(spark: SparkSession, sf: str) -> DataFrame:
    return with_types(spark, sf).filter((F.col("binary_types").bitwiseAND(F.lit(1 << 7)) > 0) & ~F.lower("title").contains("ad")).select("id")


@query(f"select good_types, count(*) as n from (select id, sum(case when type_id in (7, 8, 9, 10, 13, 19, 21) then 0 else 1 end) as good_types from {_TYPES} group by 1) where good_types > 0 group by 1")
def q_good_type_counts(spark: SparkSession, sf: str) -> DataFrame:
    per = types(spark, sf).groupBy("id").agg(F.sum(F.when(F.col("type_id").isin(*POOR_TYPES_NARROW), 0).otherwise(1)).alias("good_types"))
    return per.filter("good_types > 0").groupBy("good_types").agg(F.count("*").alias("n"))


@query(f"""with ready as (select distinct pub_date from {_A} where label = 'en' and pub_date is not null order by pub_date limit 30)
select id, pub_date from {_A} where auto_class is null and pub_date in (select pub_date from ready) or auto_class = 'M' and pub_date in (select pub_date from ready)""")
def q_articles_to_classify(spark: SparkSession, sf: str) -> DataFrame:
    a = articles(spark, sf)
    dates = a.filter("label = 'en' and pub_date is not null").select("pub_date").distinct().orderBy("pub_date").limit(30)
    return a.join(F.broadcast(dates), "pub_date", "left_semi").filter("auto_class is null or auto_class = 'M'").select("id", "pub_date")


@query(f"select id from {_A} where auto_class = 'M' and pub_date >= '19950101' and pub_date <= '19991231' and id not in (select id from {_LINKS})")
def q_articles_to_assign_by_year(spark: SparkSession, sf: str) -> DataFrame:
    a = articles(spark, sf).filter("auto_class = 'M' and pub_date >= '19950101' and pub_date <= '19991231'")
    return a.join(links(spark, sf).select("id"), "id", "left_anti").select("id")


@query(f"select distinct a.id from {_A} a join {_LINKS} l on a.id = l.id join shr on \"index\" = l.s where shr.\"Year\" % 10 = 4")
def q_articles_of_group(spark: SparkSession, sf: str) -> DataFrame:
    group = T(spark, sf, "shr").filter("Year % 10 = 4").select(F.col("index").alias("s"))
    return articles(spark, sf).join(links(spark, sf).join(group, "s", "left_semi"), "id", "left_semi").select("id")


@query("select pub_date from (select pub_date, count(*) filter (where auto_class is null) as open, count(*) as n from documents where pub_date is not null group by 1) where open = 0 and n >= 2")
def q_dates_completed(spark: SparkSession, sf: str) -> DataFrame:
    per = T(spark, sf, "documents").filter("pub_date is not null").groupBy("pub_date").agg(F.count_if(F.col("auto_class").isNull()).alias("open"), F.count("*").alias("n"))
    return per.filter("open = 0 and n >= 2").select("pub_date")


@query("""select s."index" as s, cast(row_number() over (order by s."index") as bigint) as n from (select distinct "index", "Year", "Month" from shr) s where "Year" = 2001 and "Month" = 'May'""")
def q_homicides_by_month(spark: SparkSession, sf: str) -> DataFrame:
    rows = T(spark, sf, "shr").filter("Year = 2001 and Month = 'May'").select(F.col("index").alias("s")).distinct()
    return ranking.numbered(rows, ["s"])


@query("""select distinct "index" as s, coalesce(Victim, '') as victim from shr where Victim ilike '%an%' and CNTYFIPS ilike 'f%'""")
def q_homicides_by_victim_and_county(spark: SparkSession, sf: str) -> DataFrame:
    rows = T(spark, sf, "shr").filter(F.col("Victim").ilike("%an%") & F.col("CNTYFIPS").ilike("f%"))
    return rows.select(F.col("index").alias("s"), F.coalesce("Victim", F.lit("")).alias("victim")).distinct()


@query(f"""select s."index" as s, count(l.id) as articles, max(case when a.auto_class = 'M' then 2 when a.auto_class = 'O' then 1 else 0 end) as status from (select distinct "index" from shr) s left join {_LINKS} l on l.s = s."index" left join {_A} a on a.id = l.id group by 1""".replace("select \"index\" as s, 1 +", "select distinct \"index\" as s, 1 +"))
def q_register_rollup(spark: SparkSession, sf: str) -> DataFrame:
    status = F.when(F.col("auto_class") == "M", 2).when(F.col("auto_class") == "O", 1).otherwise(0)
    linked = links(spark, sf).distinct().join(articles(spark, sf).select("id", status.alias("status")), "id", "left")
    per = linked.groupBy("s").agg(F.count("id").alias("articles"), F.max(F.coalesce("status", F.lit(0))).alias("status"))
    s = T(spark, sf, "shr").select(F.col("index").alias("s")).distinct()
    return s.join(per, "s", "left").select("s", F.coalesce("articles", F.lit(0)).alias("articles"), F.coalesce("status", F.lit(0)).alias("status"))


@query(f"select n, count(*) as rows from (select s.\"index\", count(distinct l.id) as n from (select distinct \"index\" from shr) s left join {_LINKS} l on l.s = s.\"index\" group by 1) group by 1")
def q_links_histogram(spark: SparkSession, sf: str) -> DataFrame:
    per = links(spark, sf).distinct().groupBy("s").agg(F.count("*").alias("n"))
    s = T(spark, sf, "shr").select(F.col("index").alias("s")).distinct()
    return s.join(per, "s", "left").groupBy(F.coalesce("n", F.lit(0)).alias("n")).agg(F.count("*").alias("rows"))


@query("""select source, doc_id, n_tokens from documents where lang is not distinct from 'es' and source not in ('wire desk', 'Valley Sentinel') qualify row_number() over (partition by source order by loaded_at desc nulls last, doc_id desc) = 1""")
def q_latest_results(spark: SparkSession, sf: str) -> DataFrame:
    rows = T(spark, sf, "documents").filter(F.col("lang").eqNullSafe("es") & ~F.col("source").isin("wire desk", "Valley Sentinel"))
    return ranking.latest(rows.select("source", "doc_id", "n_tokens", "loaded_at"), ["source"], "loaded_at", "doc_id").drop("loaded_at")


@query("""select substr(pub_date, 1, 4) as year, count(*) as n, count(distinct pub_date) as dates from documents where auto_class in ('M', 'O') and pub_date is not null group by 1""")
def q_queue_counts_by_year(spark: SparkSession, sf: str) -> DataFrame:
    rows = T(spark, sf, "documents").filter(F.col("auto_class").isin("M", "O") & F.col("pub_date").isNotNull())
    return rows.groupBy(F.substring("pub_date", 1, 4).alias("year")).agg(F.count("*").alias("n"), F.count_distinct("pub_date").alias("dates"))


@query(f"select id, case when id in (select id from {_LINKS}) then 'D' else auto_class end as auto_class, case when id in (select id from {_LINKS}) then 'linked' end as note from {_A}")
def q_set_labels(spark: SparkSession, sf: str) -> DataFrame:
    a = articles(spark, sf).select("id", "auto_class").withColumn("note", F.lit(None).cast("string"))
    return tables.update_where(a, links(spark, sf), ["id"], {"auto_class": F.lit("D"), "note": F.lit("linked")})


@query(f"select s, id from {_LINKS} union select distinct \"index\", 1 + \"index\" % 50 from shr where \"index\" % 3 = 0")
def q_link_and_insert_ignore(spark: SparkSession, sf: str) -> DataFrame:
    more = T(spark, sf, "shr").filter("index % 3 = 0").select(F.col("index").alias("s"), (1 + F.col("index") % 50).alias("id"))
    return tables.insert_ignore(links(spark, sf).distinct(), more, ["s", "id"])


@query("""select "index" as s, rtrim(Agency, ' .') as agency, replace(replace(Homicide, 'Murder and ', ''), 'non-negligent ', '') as kind, substr(Month, 1, 3) as month,
case when instr(coalesce(Victim, ''), ' ') > 0 then 'named' else 'unnamed' end as named, rtrim(coalesce(MSA, ''), 'aer ') as msa from shr""")
def q_register_view(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.regexp_replace(F.regexp_replace("Homicide", "Murder and ", ""), "non-negligent ", "")
    named = F.when(F.instr(F.coalesce("Victim", F.lit("")), " ") > 0, "named").otherwise("unnamed")
    return T(spark, sf, "shr").select(
        F.col("index").alias("s"), clip(F.col("Agency"), " .").alias("agency"), kind.alias("kind"), F.substring("Month", 1, 3).alias("month"), named.alias("named"), clip(F.coalesce("MSA", F.lit("")), "aer ").alias("msa"),
    )


@query("""select auto_class, lang, count(*) as n from documents where publication in (select publication from documents group by 1 having count(*) > 10) group by all""")
def q_label_cross_counts(spark: SparkSession, sf: str) -> DataFrame:
    d = T(spark, sf, "documents")
    big = d.groupBy("publication").count().filter("count > 10").select("publication")
    return d.join(big, "publication", "left_semi").groupBy("auto_class", "lang").agg(F.count("*").alias("n"))


@query("select doc_id from documents d where exists (select 1 from documents x where x.article_id = d.article_id and x.doc_id < d.doc_id)")
def q_superseded_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of an article that has an earlier row."""
    rows = T(spark, sf, "documents").filter("article_id is not null").select("article_id", "doc_id")
    first = rows.groupBy("article_id").agg(F.min("doc_id").alias("first"))
    return rows.join(first, "article_id").filter("doc_id > first").select("doc_id")


@query("""with g as (select city_id, split_part(unique_id, ':', 1) as a, split_part(unique_id, ':', 2) as i, string_agg(unique_id, ',' order by unique_id) as members, count(*) as n from (select distinct city_id, unique_id from orphan_link_input) group by all)
select city_id, a || ':' || i as incident, members, n from g""")
def q_orphan_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Unnamed victims of one incident of an article, as one group."""
    rows = T(spark, sf, "orphan_link_input").select("city_id", "unique_id").distinct()
    incident = F.concat_ws(":", F.split_part("unique_id", F.lit(":"), F.lit(1)), F.split_part("unique_id", F.lit(":"), F.lit(2)))
    return rows.groupBy("city_id", incident.alias("incident")).agg(agg.joined_set("unique_id").alias("members"), F.count("*").alias("n"))


_CANDIDATES = """with e as (select unique_id, any_value(city_id) as city_id, any_value(midpoint_day) as d, any_value(victim_sex) as sx, any_value(weapon) as w, any_value(circumstance) as c, any_value(summary_vec) as v, any_value(string_split(article_ids_csv, ',')) as a from entity_link_input group by 1),
m as (select l.unique_id as o, r.unique_id as e, coalesce(r.w, '') as anchor, round(coalesce(case when len(l.v) = 64 and len(r.v) = 64 and list_max(list_transform(l.v, lambda x: abs(x))) > 0 and list_max(list_transform(r.v, lambda x: abs(x))) > 0 then list_cosine_similarity(l.v, r.v) end, 0), 6) as cosine,
 coalesce(cast(l.sx = r.sx as integer), 0) + coalesce(cast(l.w = r.w as integer), 0) + coalesce(cast(l.c = r.c as integer), 0) as same, abs(l.d - r.d) as gap, split_part(l.unique_id, ':', 1) as article
 from e l join e r on l.city_id = r.city_id and abs(l.d - r.d) <= 90 and l.unique_id <> r.unique_id where not list_has_any(l.a, r.a)),
s as (select *, round(1.2 + 0.8 * same + 1.7 * cosine - 0.01 * gap, 5) as score, case when gap <= 30 then 30 - gap end as weight from m)"""


def _met(spark: SparkSession, sf: str) -> DataFrame:
    """Named entities of a city within 90 days that share no article, scored. Days meet in buckets, so the band is an equality
    join with a check."""
    e = T(spark, sf, "entity_link_input").dropDuplicates(["unique_id"]).filter("midpoint_day is not null")
    e = e.select(F.col("unique_id").alias("id"), "city_id", F.col("midpoint_day").alias("d"), F.col("victim_sex").alias("sx"), F.col("weapon").alias("w"), F.col("circumstance").alias("c"), F.col("summary_vec").alias("v"), F.split("article_ids_csv", ",").alias("a"))
    l = e.select("city_id", F.struct("*").alias("l"), F.explode(F.sequence(F.floor((F.col("d") - 90) / 90), F.floor((F.col("d") + 90) / 90))).alias("b"))
    r = e.select("city_id", F.struct("*").alias("r"), F.floor(F.col("d") / 90).alias("b"))
    gap = F.abs(F.col("l.d") - F.col("r.d"))
    met = l.join(r, ["city_id", "b"]).filter((gap <= 90) & (F.col("l.id") != F.col("r.id")) & ~F.coalesce(F.arrays_overlap("l.a", "r.a"), F.lit(False)))
    whole = (F.size("l.v") == 64) & (F.size("r.v") == 64)
    cosine = F.round(F.coalesce(F.when(whole, vectors.cosine(F.col("l.v"), F.col("r.v"))), F.lit(0.0)), 6)
    scored = met.withColumns({"cosine": cosine, "gap": gap})
    value = candidates.score([F.col("l.sx") == F.col("r.sx"), F.col("l.w") == F.col("r.w"), F.col("l.c") == F.col("r.c")], F.col("cosine"), F.col("gap"))
    return scored.select(
        F.col("l.id").alias("o"), F.col("r.id").alias("e"), F.coalesce("r.w", F.lit("")).alias("anchor"), F.round(value, 5).alias("score"), F.when(F.col("gap") <= 30, 30 - F.col("gap")).alias("weight"), F.split_part("l.id", F.lit(":"), F.lit(1)).alias("article"),
    )


@query(_CANDIDATES + " select o, e, score from (select *, rank() over (partition by o order by score desc) as k from s) where k <= 20")
def q_candidate_scores(spark: SparkSession, sf: str) -> DataFrame:
    """The twenty best candidates of each entity, with ties."""
    return ranking.top_with_ties(_met(spark, sf).select("o", "e", "score"), 20, "score", ["o"])


@query(_CANDIDATES + """, g as (select article, e, anchor, max(score) as score, max(weight) as weight, arg_min(o, (-score, o)) as o, count(distinct o) as n from s group by all),
k as (select *, rank() over (partition by article order by score desc) as a, rank() over (partition by article order by coalesce(weight, '-infinity'::double) desc) as b,
 rank() over (partition by article, anchor order by score desc) as c, rank() over (partition by article, anchor order by coalesce(weight, '-infinity'::double) desc) as d from g)
select article, e, anchor, score, weight, o, n as variants from k where a <= 5 or b <= 5 or c <= 3 or d <= 3""")
def q_candidate_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates merged over the entities of an article, gated by the top lists of the article and of each anchor."""
    rows = _met(spark, sf).withColumns({"variant": F.col("o"), "record": F.col("o")}).drop("o")
    merged = candidates.merge(rows, ["article", "e", "anchor"])
    return candidates.gate(merged, ["article"], "anchor").select("article", "e", "anchor", "score", "weight", F.col("record").alias("o"), F.size("variants").cast("bigint").alias("variants"))


@query("""with p as (select unique_id_l as l, unique_id_r as r, match_probability as s from postadj_orphan_cluster_pairs where match_probability is not null)
select l, max(s) as best, min(s) as worst, round(max(s) - coalesce(max(case when k = 2 then s end), 0), 6) as gap, count(*) as hits, round(max(s) + 0.5 * count(*), 6) as merged
from (select *, row_number() over (partition by l order by s desc) as k from p) group by 1 qualify row_number() over (order by round(max(s) + 0.5 * count(*), 6) desc, l nulls first) <= 200""")
def q_candidate_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """The 200 records with the most and best pairs, each with its best, worst and second-best score. The two best come from an
    aggregate over pre-ranked values, so a record with a tenth of all pairs is no single task."""
    p = T(spark, sf, "postadj_orphan_cluster_pairs").filter("match_probability is not null")
    s = F.col("match_probability")
    values = p.groupBy(F.col("unique_id_l").alias("l"), s.alias("s")).agg(F.count("*").alias("c"))  # combines repeated scores first
    per = values.groupBy("l").agg(F.max("s").alias("best"), F.min("s").alias("worst"), F.sum("c").alias("hits"), F.max_by("c", "s").alias("top"))
    second = values.join(per.select("l", "best"), ["l"]).filter("s < best").groupBy("l").agg(F.max("s").alias("second"))
    per = per.join(second, "l", "left").withColumn("runner", F.when(F.col("top") > 1, F.col("best")).otherwise(F.coalesce("second", F.lit(0.0))))
    merged = per.select("l", "best", "worst", F.round(F.col("best") - F.col("runner"), 6).alias("gap"), "hits", F.round(F.col("best") + 0.5 * F.col("hits"), 6).alias("merged"))
    return merged.orderBy(F.desc("merged"), F.asc_nulls_first("l")).limit(200)


@query("""select count(*) as rows, count(distinct unique_id) as ids, count_if(lat is null or lon is null) as unplaced, (select count(*) from entity_link_input) as entities, (select count(*) from shr) as register from orphan_link_input""")
def q_scalar_counts(spark: SparkSession, sf: str) -> DataFrame:
    o = T(spark, sf, "orphan_link_input").agg(F.count("*").alias("rows"), F.count_distinct("unique_id").alias("ids"), F.count_if(F.col("lat").isNull() | F.col("lon").isNull()).alias("unplaced"))
    one = lambda t, n: T(spark, sf, t).agg(F.count("*").alias(n))
    return o.crossJoin(one("entity_link_input", "entities")).crossJoin(one("shr", "register"))  # rows of one each


@query("""select label, x, n, sum(n) over (partition by label order by x) as running, rank() over (partition by label order by n desc) as r from (select label, floor(embedding[1] * 4) as x, count(*) as n from embeddings group by all)""")
def q_running_sums(spark: SparkSession, sf: str) -> DataFrame:
    per = T(spark, sf, "embeddings").groupBy("label", F.floor(F.col("embedding")[0] * 4).alias("x")).agg(F.count("*").alias("n"))
    w = Window.partitionBy("label")
    return per.withColumns({"running": F.sum("n").over(w.orderBy("x")), "r": F.rank().over(w.orderBy(F.desc("n")))})


_OUTCOMES = "(select doc_id as id, ['none', 'before', 'outside', 'inside', 'failed'][cast(doc_id % 5 as integer) + 1] as outcome, [null, 'vehicular', 'fictional', 'military', 'murder'][cast(doc_id // 5 % 5 as integer) + 1] as kind, nullif(doc_id % 4, 3) as incidents, 1970 + doc_id % 20 as year from documents)"


@query(f"""select id, case when outcome = 'none' then 'N_NOHOM' when outcome = 'before' then 'E' when outcome = 'outside' then 'O' when outcome = 'inside' and kind = 'vehicular' then 'N_VEH' when outcome = 'inside' and kind = 'fictional' then 'N_FIC'
when outcome = 'inside' and kind = 'military' then 'N_MIL' when outcome = 'inside' and kind is null then 'ERR_M_NONE' when outcome = 'inside' then 'M_PRELIM' else 'ERR_OTHER' end as code,
case when coalesce(incidents, 0) = 0 then 'N_NOINC' when year >= 1977 then 'M' else 'E' end as extracted from {_OUTCOMES}""")
def q_outcome_codes(spark: SparkSession, sf: str) -> DataFrame:
    """The codes of a classifier's answers, and of the years of the incidents it extracted."""
    d = T(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    pick = lambda values, i: F.get(F.array(*[F.lit(v).cast("string") for v in values]), i.cast("int"))
    outcome, kind = pick(("none", "before", "outside", "inside", "failed"), F.col("id") % 5), pick((None, "vehicular", "fictional", "military", "murder"), F.floor(F.col("id") / 5) % 5)
    n = F.coalesce(F.nullif(F.col("id") % 4, F.lit(3)), F.lit(0)).cast("int")
    years = F.when(n > 0, F.array_repeat((1970 + F.col("id") % 20).cast("int"), n)).otherwise(F.array().cast("array<int>"))
    return d.select("id", outcomes.answer_code(outcome, kind).alias("code"), outcomes.extract_code(years, 1977).alias("extracted"))


_TOPICS = f"(select s, id, s % 4 as human, nullif((s + id) % 5, 0) as manual, case when (s + id) % 3 = 0 then 'x' || s end as extract from (select distinct s, id from {_LINKS}))"


def topics(spark: SparkSession, sf: str) -> DataFrame:
    """Register rows in articles with the marks and extracts they got."""
    s, i = F.col("s"), F.col("id")
    return links(spark, sf).distinct().select("s", "id", (s % 4).alias("human"), F.nullif((s + i) % 5, F.lit(0)).alias("manual"), F.when((s + i) % 3 == 0, F.concat(F.lit("x"), s.cast("string"))).alias("extract"))


@query("select type_id, count(*) as n from (select doc_id as id, length(title) % 23 as type_id from documents union select doc_id, length(source) % 23 from documents) where id in (select doc_id from documents where publication is not null) group by 1")
def q_retrieve_types(spark: SparkSession, sf: str) -> DataFrame:
    """The types of the articles of a publication."""
    mine = articles(spark, sf).filter("publication is not null").select("id").distinct()
    return types(spark, sf).join(mine, "id", "left_semi").groupBy("type_id").agg(F.count("*").alias("n"))


@query(f"select j.id, t.s, coalesce(t.extract, '') as extract, good_types from ({_JOINED}) j join {_TOPICS} t on t.id = j.id join (select distinct \"index\" as i from shr) r on r.i = t.s where t.s = 17")
def q_articles_from_homicide(spark: SparkSession, sf: str) -> DataFrame:
    """The articles assigned to one register row, with what each says of it."""
    t = topics(spark, sf).filter("s = 17").join(T(spark, sf, "shr").select(F.col("index").alias("s")).distinct(), "s", "left_semi")
    return with_types(spark, sf).join(t, "id").select("id", "s", F.coalesce("extract", F.lit("")).alias("extract"), "good_types")


@query(f"select j.id, t.s, t.extract, binary_types from ({_JOINED}) j join {_TOPICS} t on t.id = j.id where t.s = 17 and t.id = (select min(id) from {_TOPICS} where s = 17)")
def q_article_with_extracts(spark: SparkSession, sf: str) -> DataFrame:
    """One article with the extract about one register row."""
    t = topics(spark, sf).filter("s = 17")
    first = t.agg(F.min("id").alias("id"))  # one row
    return with_types(spark, sf).join(t.join(F.broadcast(first), "id", "left_semi"), "id").select("id", "s", "extract", "binary_types")


@query(f"""select s.i as s, row_number() over (order by s.agency, s.n, s.i) as k, coalesce(t.manual, 0) as manual, coalesce(t.human, 0) as human, coalesce(t.extract, '') as extract
from (select "index" as i, any_value(coalesce(Agency, '')) as agency, any_value(Incident) as n from shr group by 1) s join {_TOPICS} t on t.s = s.i where t.id = (select min(id) from {_TOPICS})""")
def q_homicides_of_article(spark: SparkSession, sf: str) -> DataFrame:
    """The register rows assigned to one article, numbered, with their marks and extracts."""
    t = topics(spark, sf)
    mine = t.join(F.broadcast(t.agg(F.min("id").alias("id"))), "id", "left_semi")
    s = T(spark, sf, "shr").dropDuplicates(["index"]).select(F.col("index").alias("s"), F.coalesce("Agency", F.lit("")).alias("agency"), F.col("Incident").alias("i"))
    rows = ranking.numbered(s.join(mine, "s"), ["agency", "i", "s"], "k")
    return rows.select("s", "k", F.coalesce("manual", F.lit(0)).alias("manual"), F.coalesce("human", F.lit(0)).alias("human"), F.coalesce("extract", F.lit("")).alias("extract"))


@query(f"select s, id, case when s % 10 = 3 then 3 else human end as human, manual from {_TOPICS}")
def q_mark_and_log(spark: SparkSession, sf: str) -> DataFrame:
    """A mark set for some victims; the attempts themselves go to a log (see q_attempts)."""
    return _marked(spark, sf)[0].select("s", "id", "human", "manual")


@query(f"select s, id, 3 as human, manual, 'p' || s as prompt from {_TOPICS} where s % 10 = 3")
def q_attempts(spark: SparkSession, sf: str) -> DataFrame:
    return _marked(spark, sf)[1]


def _marked(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    t = topics(spark, sf)
    tried = t.filter("s % 10 = 3").select("s", "id", F.lit(3).alias("human"), "manual", F.concat(F.lit("p"), F.col("s").cast("string")).alias("prompt"))
    log = spark.createDataFrame([], tried.schema)
    return tables.update_where(t, tried.select("s", "id"), ["s", "id"], {"human": F.lit(3)}), tables.append(log, tried)


@query("select id, cast(row_number() over (order by id) + 100 as bigint) as result_id, prompt, tokens from (select doc_id as id, 'classify' as prompt, n_tokens as tokens from documents where auto_class = 'M' and n_tokens is not null)")
def q_append_results(spark: SparkSession, sf: str) -> DataFrame:
    """Results appended to a table that numbers them itself, after the 100 it holds."""
    new = T(spark, sf, "documents").filter("auto_class = 'M' and n_tokens is not null").select(F.col("doc_id").alias("id"), F.lit("classify").alias("prompt"), F.col("n_tokens").alias("tokens"))
    return ranking.numbered(new, ["id"], "n").select("id", (F.col("n") + 100).alias("result_id"), "prompt", "tokens")


_QUEUED = "(select *, case doc_id % 4 when 0 then 'ERR_M_NONE' when 1 then 'M_PRELIM' when 2 then 'O' end as answer from documents)"


def _queued(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("doc_id") % 4
    return T(spark, sf, "documents").withColumn("answer", F.when(k == 0, "ERR_M_NONE").when(k == 1, "M_PRELIM").when(k == 2, "O"))


@query(f"select doc_id, pub_date from {_QUEUED} where auto_class = 'M' and (answer is null or answer = 'ERR_M_NONE') order by pub_date nulls first, doc_id limit 50")
def q_articles_to_filter(spark: SparkSession, sf: str) -> DataFrame:
    """The next fifty articles to classify: never tried, or tried without an answer."""
    rows = _queued(spark, sf).filter("auto_class = 'M' and (answer is null or answer = 'ERR_M_NONE')")
    return rows.select("doc_id", "pub_date").orderBy(F.asc_nulls_first("pub_date"), "doc_id").limit(50)


@query(f"select doc_id, pub_date from {_QUEUED} where auto_class = 'M' and answer is not distinct from 'M_PRELIM' order by pub_date nulls first, doc_id limit 50")
def q_articles_to_extract(spark: SparkSession, sf: str) -> DataFrame:
    """The next fifty articles to extract from: those whose first answer was yes."""
    rows = _queued(spark, sf).filter((F.col("auto_class") == "M") & F.col("answer").eqNullSafe("M_PRELIM"))
    return rows.select("doc_id", "pub_date").orderBy(F.asc_nulls_first("pub_date"), "doc_id").limit(50)


@query("""select substr(pub_date, 1, 4) as year, count(distinct pub_date) as dates from documents d where regexp_matches(pub_date, '^\\d{8}$') and exists (select 1 from documents a where a.pub_date = d.pub_date and a.auto_class = 'M')
and not exists (select 1 from documents a where a.pub_date = d.pub_date and a.auto_class is null) group by 1""")
def q_dates_ready(spark: SparkSession, sf: str) -> DataFrame:
    """Dates with an article of the queue and none that is still open, by year."""
    d = T(spark, sf, "documents").select("pub_date", "auto_class")
    ready = d.filter("auto_class = 'M'").select("pub_date").distinct()
    open_ = d.filter("auto_class is null").select("pub_date").distinct()
    dates = d.filter(F.col("pub_date").rlike(r"^\d{8}$")).select("pub_date").distinct().join(ready, "pub_date", "left_semi").join(open_, "pub_date", "left_anti")
    return dates.groupBy(F.substring("pub_date", 1, 4).alias("year")).agg(F.count("*").alias("dates"))
