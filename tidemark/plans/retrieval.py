"""Queries of text search, caches, queues and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import queues, regression, search
from tidemark.session import Scratch
from tidemark.session import read_table as T
from tidemark.sources import lookups
from tidemark.streaming.refresh import windowed_counts

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn

    return add


_TOKENS = r"""with t as (select doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') as t from documents),
d as (select doc_id, len(t) as len, len(list_filter(t, lambda x: x = 'judge')) as a, len(list_filter(t, lambda x: x = 'verdict')) as b from t),
s as (select count(*) as n, avg(len) as avg, count_if(a > 0) as da, count_if(b > 0) as db from d)
"""
_ONE = "ln(1 + (n - {df} + 0.5) / ({df} + 0.5)) * {tf} * 2.2 / ({tf} + 1.2 * (0.25 + 0.75 * len / avg))"


@query(_TOKENS + f"select doc_id, round({_ONE.format(df='da', tf='a')} + {_ONE.format(df='db', tf='b')}, 6) as score from d, s where a > 0 or b > 0")
def q_bm25_search(spark: SparkSession, sf: str) -> DataFrame:
    out = search.bm25(T(spark, sf, "documents"), "doc_id", "text", ["judge", "verdict"])
    return out.select("doc_id", F.round("score", 6).alias("score"))


@query(r"""with t as (select doc_id, ' ' || array_to_string(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> ''), ' ') || ' ' as t from documents)
select doc_id, phrase from t, (values ('parish hall'), ('was found dead'), ('street lighting')) p(phrase) where contains(t, ' ' || phrase || ' ')""")
def q_phrase_search(spark: SparkSession, sf: str) -> DataFrame:
    return search.phrase_hits(T(spark, sf, "documents"), "doc_id", "text", ["parish hall", "was found dead", "street lighting"])


@query("""with v(anchor, variant) as (values ('court', 'Judge'), ('court', 'jury'), ('court', 'the'), ('city', 'Fenminster'), ('city', 'Gloudown'))
select anchor, variant, count(*) as df from v join documents on text ilike '%' || variant || '%' group by all having count(*) <= 0.2 * (select count(*) from documents)""")
def q_anchor_doc_freq(spark: SparkSession, sf: str) -> DataFrame:
    return search.anchor_frequencies(T(spark, sf, "documents"), "text", {"court": ["Judge", "jury", "the"], "city": ["Fenminster", "Gloudown"]})


@query(r"""with t as (select doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')) as term from documents)
select term, count(distinct doc_id) as df, count(*) as tf from t group by 1""")
def q_postings(spark: SparkSession, sf: str) -> DataFrame:
    return search.postings(T(spark, sf, "documents"), "doc_id", "text").groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("tf"))


@query(_TOKENS + f"select doc_id, round({_ONE.format(df='da', tf='a')} + {_ONE.format(df='db', tf='b')}, 6) as score from d, s where a > 0 or b > 0")
def q_bm25_postings(spark: SparkSession, sf: str) -> DataFrame:
    """The same ranking from a stored index: only the postings of the query's terms are read."""
    index = Scratch(spark).keep(search.postings(T(spark, sf, "documents"), "doc_id", "text"), "postings")
    lengths = T(spark, sf, "documents").select(F.greatest(F.size(search.token_array(F.col("text"))), F.lit(0)).alias("n")).agg(F.count("*"), F.avg("n")).first()
    return search.bm25_postings(index, "doc_id", ["judge", "verdict"], *lengths).select("doc_id", F.round("score", 6).alias("score"))


@query(r"""with t as (select doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') as t from documents),
d as (select doc_id, len(t) as len, ' ' || array_to_string(t, '  ') || ' ' as f from t),
c as (select doc_id, coalesce(len, 0) as len, coalesce((length(f) - length(replace(f, ' parish  hall ', ''))) // 14, 0) as a, coalesce((length(f) - length(replace(f, ' street  lighting ', ''))) // 18, 0) as b from d),
s as (select count(*) as n, avg(len) as avg, count_if(a > 0) as da, count_if(b > 0) as db from c)
select doc_id, round(""" + f"{_ONE.format(df='da', tf='a')} + {_ONE.format(df='db', tf='b')}" + ", 6) as score from c, s where a > 0 or b > 0")
def q_bm25_phrases(spark: SparkSession, sf: str) -> DataFrame:
    out = search.bm25_phrases(T(spark, sf, "documents"), "doc_id", "text", ["parish hall", "street lighting"])
    return out.select("doc_id", F.round("score", 6).alias("score"))


@query(r"""with n as (select doc_id, case when doc_id % 10 = 0 then coalesce(title, '') || ' revised' else title end as x from documents where doc_id % 17 <> 0),
t as (select doc_id, unnest(list_filter(regexp_split_to_array(lower(x), '[^\p{L}\p{N}]+'), lambda x: x <> '')) as term from n)
select doc_id, term, count(*) as tf from t group by all""")
def q_postings_refreshed(spark: SparkSession, sf: str) -> DataFrame:
    """An index of titles after some changed and some documents went."""
    d = T(spark, sf, "documents").select("doc_id", "title")
    changed = d.filter("doc_id % 10 = 0 and doc_id % 17 != 0").withColumn("title", F.concat(F.coalesce("title", F.lit("")), F.lit(" revised")))
    index = Scratch(spark).keep(search.postings(d, "doc_id", "title"), "postings")
    return search.refresh_postings(index, changed, d.filter("doc_id % 17 = 0"), "doc_id", "title").select("doc_id", "term", "tf")


@query("""select doc_id, case when h then ['jury'] when k then ['judge'] else ['judge', 'jury'] end as variants from
(select doc_id, contains(lower(text), 'jury') and not contains(lower(text), 'judge') as h, contains(lower(text), 'judge') and not contains(lower(text), 'jury') as k from documents where contains(lower(text), 'trial'))""")
def q_variant_matches(spark: SparkSession, sf: str) -> DataFrame:
    hits = T(spark, sf, "documents").filter(F.lower("text").contains("trial"))
    return search.variant_matches(hits, "text", ["judge", "jury"]).select("doc_id", "variants")


# Caches and queues.

_CURRENT = "(select user_id as k, event_type as m from events where event_id % 3 <> 0 group by all)"


@query(f"""with c as (select k, md5(string_agg(m, ',' order by m)) as h, count(*) as n from {_CURRENT} group by 1),
d as (select user_id as k, md5(string_agg(distinct event_type, ',' order by event_type)) as h, case when user_id % 10 = 0 then 'pending' else 'done' end as s, count(distinct event_type) - user_id % 2 as cached from events where user_id % 4 <> 0 group by 1),
r as (select c.*, case when s = 'pending' then 'pending' when d.h is null then 'new' when d.h <> c.h then 'changed' when coalesce(cached, 0) < n then 'incomplete' end as reason from c left join d on c.k = d.k)
select k, h as set_hash, n, reason, case reason when 'pending' then 1 when 'new' then 2 when 'changed' then 3 else 4 end as priority from r where reason is not null""")
def q_cache_queue_reason_codes(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.operators.aggregates import set_hash

    events = T(spark, sf, "events").select(F.col("user_id").alias("k"), F.col("event_type").alias("m"), "event_id")
    done = events.filter("k % 4 != 0").groupBy("k").agg(set_hash("m").alias("set_hash"), (F.count_distinct("m") - F.max(F.col("k") % 2)).alias("n_cached"))
    done = done.withColumn("status", F.when(F.col("k") % 10 == 0, "pending").otherwise("done"))
    return queues.work_queue(events.filter("event_id % 3 != 0"), done, "k", "m")


@query("""select addr_key, case when input_address is null then 'to_do' else 'cached' end as ready, count(*) as n from mar_addr_map left join (select distinct input_address from mar_cache where matched_address is not null) on input_address = addr_key where addr_key is not null group by all""")
def q_cache_readiness(spark: SparkSession, sf: str) -> DataFrame:
    cache = T(spark, sf, "mar_cache").filter("matched_address is not null").select(F.col("input_address").alias("addr_key"))
    wanted = T(spark, sf, "mar_addr_map").filter("addr_key is not null").select("addr_key")
    return queues.readiness(wanted, cache, ["addr_key"]).groupBy("addr_key", "ready").agg(F.count("*").alias("n"))


@query("select distinct addr_key, md5(addr_key) as answer from mar_addr_map where addr_key is not null and addr_key not in (select input_address from mar_cache where matched_address is not null and not (contains(addr_key, 'BLOCK') and not contains(matched_address, 'BLOCK OF') and input_address = addr_key))")
def q_cached_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """What a provider answers for the addresses that the cache lacks, block answers without BLOCK OF counting as lacking."""
    cache = T(spark, sf, "mar_cache").filter("matched_address is not null").select(F.col("input_address").alias("addr_key"), F.col("matched_address").alias("answer"))
    bypass = F.col("addr_key").contains("BLOCK") & ~F.col("answer").contains("BLOCK OF")
    asked = queues.misses(T(spark, sf, "mar_addr_map").select("addr_key"), cache.filter(~bypass), "addr_key")
    return lookups.ask(asked, "addr_key", lookups.stub).select("addr_key", "answer")


@query("""select user_id, case when count_if(value > 95) > 0 then '1' when count_if(value < 2) > 0 then 'retry' else '0' end as outcome, min(case when value > 95 then event_id end) as hit from events group by 1""")
def q_first_hit(spark: SparkSession, sf: str) -> DataFrame:
    out = queues.first_hit(T(spark, sf, "events"), "user_id", ["event_id"], F.col("value") > 95, F.col("value") < 2)
    return out.select("user_id", "outcome", F.col("hit.event_id").alias("hit"))


@query("""select source, auto_class, doc_id from (select *, row_number() over (partition by source order by case auto_class when 'M' then 1 when 'O' then 2 when 'N' then 3 else 4 end, auto_class nulls first, doc_id) as n from documents) where n = 1""")
def q_priority_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return queues.priority_rollup(T(spark, sf, "documents"), "source", "auto_class", ["M", "O", "N"], ["doc_id"])


@query("""select 'a' || (event_id % 50) || '|' || event_type as cache_key, count(*) as n from events where 'a' || (event_id % 50) not in (select 'a' || n_nationkey from nation) group by 1""")
def q_drop_cache_prefix(spark: SparkSession, sf: str) -> DataFrame:
    key = F.concat(F.lit("a"), (F.col("event_id") % 50).cast("string"), F.lit("|"), "event_type").alias("cache_key")
    gone = T(spark, sf, "nation").select(F.concat(F.lit("a"), F.col("n_nationkey").cast("string")).alias("p"))
    return queues.drop_prefix(T(spark, sf, "events").select(key), "cache_key", gone, "p").groupBy("cache_key").agg(F.count("*").alias("n"))


@query("""select doc_id, md5(coalesce(cast(doc_id as varchar), '') || chr(31) || coalesce(title, '') || chr(31) || coalesce(lang, '')) as key,
case when auto_class = 'M' then 40 else 0 end + case when lang is not null then 20 else 0 end + case when length(title) > 25 then 10 else 0 end - 5 * (publication % 3) as score from documents""")
def q_cache_key_and_score(spark: SparkSession, sf: str) -> DataFrame:
    points = F.when(F.col("auto_class") == "M", 40).otherwise(0) + F.when(F.col("lang").isNotNull(), 20).otherwise(0) + F.when(F.length("title") > 25, 10).otherwise(0) - 5 * (F.col("publication") % 3)
    return T(spark, sf, "documents").select("doc_id", queues.content_key(F.col("doc_id"), F.col("title"), F.col("lang")).alias("key"), points.alias("score"))


@query("select time_bucket(interval '1 hour', ts) as start, event_type, count(*) as n from events group by all")
def q_windowed_counts(spark: SparkSession, sf: str) -> DataFrame:
    return windowed_counts(T(spark, sf, "events"), "ts", "event_type").select("start", "event_type", "n")


# Statistics.


def _cases(spark: SparkSession, sf: str) -> tuple[DataFrame, list]:
    rows = T(spark, sf, "shr").filter(F.col("VicAge").between(0, 100)).select(
        (F.col("Solved") == "Yes").cast("double").alias("solved"), (F.col("VicAge") / 10).alias("age"), (F.col("Weapon").ilike("%gun%")).cast("double").alias("gun"), ((F.col("Year") - 1996) / 10).alias("year"), "VicCount",
    )
    return rows, [(n, F.col(n)) for n in ("age", "gun", "year")]


@query("""with d as (select case when Solved = 'Yes' then 1.0 else 0.0 end as y, VicAge / 10 as x from shr where VicAge between 0 and 100)
select '(intercept)' as term, round(regr_intercept(y, x), 6) as coef from d union all select 'age', round(regr_slope(y, x), 6) from d""")
def q_ols_one(spark: SparkSession, sf: str) -> DataFrame:
    rows, terms = _cases(spark, sf)
    return regression.fit(rows, F.col("solved"), terms[:1]).frame(spark).select("term", F.round("coef", 6).alias("coef"))


@query()
def q_ols_robust(spark: SparkSession, sf: str) -> DataFrame:
    rows, terms = _cases(spark, sf)
    return regression.fit(rows, F.col("solved"), terms).frame(spark)


@query()
def q_probit(spark: SparkSession, sf: str) -> DataFrame:
    rows, terms = _cases(spark, sf)
    return regression.fit(rows, F.col("solved"), terms, "probit").frame(spark)


@query()
def q_poisson(spark: SparkSession, sf: str) -> DataFrame:
    rows, terms = _cases(spark, sf)
    return regression.fit(rows, F.col("VicCount"), terms, "poisson").frame(spark)


@query()
def q_margins(spark: SparkSession, sf: str) -> DataFrame:
    rows, terms = _cases(spark, sf)
    model = regression.fit(rows, F.col("solved"), terms, "probit")
    return regression.margins(rows, model, terms, "gun", [0.0, 1.0])
