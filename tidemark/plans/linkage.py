"""Queries of record linkage: blocking, scoring, training, clustering, matching, canonical records, diffs."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import assignment, blocking, canonical, cluster_diff, clustering, linkage, tables
from tidemark.operators.blocking import Rule
from tidemark.operators.linkage import Comparison, Level, Model, Training
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


#: Rules over customers: the block first, then bands of balance as residual conditions.
CUSTOMER_RULES = (
    Rule("nation_segment", ("c_nationkey", "c_mktsegment"), "abs(l.c_acctbal - r.c_acctbal) <= 250", near=("c_acctbal", 250)),
    Rule("nation_band", ("c_nationkey", "floor(c_acctbal / 500)"), "abs(l.c_acctbal - r.c_acctbal) <= 100", near=("c_acctbal", 100)),
    Rule("segment_cents", ("c_mktsegment", "round(c_acctbal, 0)")),
)
_CUSTOMERS = ("c_nationkey", "c_mktsegment", "c_acctbal")
_PAIRS = """
with p as (select l.c_custkey as l, r.c_custkey as r, l.c_nationkey = r.c_nationkey and l.c_mktsegment = r.c_mktsegment and abs(l.c_acctbal - r.c_acctbal) <= 250 as a,
 l.c_nationkey = r.c_nationkey and floor(l.c_acctbal / 500) = floor(r.c_acctbal / 500) and abs(l.c_acctbal - r.c_acctbal) <= 100 as b, l.c_mktsegment = r.c_mktsegment and round(l.c_acctbal, 0) = round(r.c_acctbal, 0) as c,
 abs(l.c_acctbal - r.c_acctbal) as gap, l.c_mktsegment = r.c_mktsegment as seg, l.c_nationkey = r.c_nationkey as nat from customer l join customer r on l.c_custkey < r.c_custkey where (l.c_nationkey = r.c_nationkey or l.c_mktsegment = r.c_mktsegment)),
b as (select *, case when a then 'nation_segment' when b then 'nation_band' else 'segment_cents' end as rule from p where a or b or c)
"""

MODEL = Model(
    0.01,
    (
        Comparison("balance", "l.c_acctbal is null or r.c_acctbal is null", (Level("within 25", "abs(l.c_acctbal - r.c_acctbal) <= 25", 0.6, 0.02), Level("within 100", "abs(l.c_acctbal - r.c_acctbal) <= 100", 0.3, 0.08), Level("else", "true", 0.1, 0.9))),
        Comparison("segment", "l.c_mktsegment is null or r.c_mktsegment is null", (Level("same", "l.c_mktsegment = r.c_mktsegment", 0.9, 0.2), Level("else", "true", 0.1, 0.8)), tf="c_mktsegment"),
        Comparison("nation", "nullif(l.c_nationkey, 3) is null or nullif(r.c_nationkey, 3) is null", (Level("same", "l.c_nationkey = r.c_nationkey", 0.95, 0.04), Level("else", "true", 0.05, 0.96))),
    ),
)
_SCORES = (
    _PAIRS
    + """, k as (select b.*, x.c_nationkey as ln, y.c_nationkey as rn, x.c_mktsegment as ls, y.c_mktsegment as rs from b join customer x on x.c_custkey = b.l join customer y on y.c_custkey = b.r),
g as (select *, case when gap <= 25 then 2 when gap <= 100 then 1 else 0 end as gamma_balance, case when seg then 1 else 0 end as gamma_segment,
 case when nullif(ln, 3) is null or nullif(rn, 3) is null then -1 when nat then 1 else 0 end as gamma_nation from k),
w as (select *, log2(0.01 / 0.99) + case gamma_balance when 2 then log2(0.6 / 0.02) when 1 then log2(0.3 / 0.08) else log2(0.1 / 0.9) end
 + case gamma_segment when 1 then log2(0.9 / 0.2) else log2(0.1 / 0.8) end + case gamma_nation when 1 then log2(0.95 / 0.04) when 0 then log2(0.05 / 0.96) else 0 end as w from g)
"""
)


def _blocked(spark: SparkSession, sf: str, barred: tuple | None = None) -> DataFrame:
    return blocking.block_pairs(T(spark, sf, "customer"), None, "c_custkey", CUSTOMER_RULES, _CUSTOMERS, barred)


def _ids(df: DataFrame, *more) -> DataFrame:
    return df.select(F.col("l.c_custkey").alias("l"), F.col("r.c_custkey").alias("r"), *more)


@query(_PAIRS + "select l, r, rule from b")
def q_block_pairs_multi_rule(spark: SparkSession, sf: str) -> DataFrame:
    return _ids(_blocked(spark, sf), "rule")


@query("""with o as (select o_orderkey as k, o_custkey as c, date_diff('day', date '1970-01-01', cast(o_orderdate as date)) as d from orders)
select l.k as l, r.k as r from o l join o r on l.c = r.c and l.k < r.k where (floor(l.d / 213) = floor(r.d / 213) or floor((l.d + 106) / 213) = floor((r.d + 106) / 213)) and abs(l.d - r.d) <= 90""")
def q_block_date_buckets(spark: SparkSession, sf: str) -> DataFrame:
    rows = T(spark, sf, "orders").select("o_orderkey", "o_custkey", F.unix_date(F.to_date("o_orderdate")).alias("day"))
    rules = blocking.date_bucket_rules("date", "day", 213, ("o_custkey",), "abs(l.day - r.day) <= 90")
    pairs = blocking.block_pairs(rows, None, "o_orderkey", rules)
    return pairs.select(F.col("l.o_orderkey").alias("l"), F.col("r.o_orderkey").alias("r"))


@query(_SCORES + "select l, r, gamma_balance, gamma_segment, gamma_nation, round(w, 6) as weight, round(1 / (1 + power(2, -w)), 6) as p from w where 1 / (1 + power(2, -w)) >= 0.05")
def q_score_pairs_fixed_model(spark: SparkSession, sf: str) -> DataFrame:
    out = linkage.score(_blocked(spark, sf), MODEL, threshold=0.05)
    return _ids(out, "gamma_balance", "gamma_segment", "gamma_nation", F.round("match_weight", 6).alias("weight"), F.round("match_probability", 6).alias("p"))


@query(_SCORES + """, tf as (select c_mktsegment as v, count(*) / (select count(*) from customer) as f from customer group by 1),
t as (select l, r, w + case when gamma_segment = 1 then log2(0.2 / greatest(a.f, c.f, 0.001)) else 0 end as w from w left join tf a on a.v = ls left join tf c on c.v = rs)
select l, r, round(w, 6) as weight from t""")
def q_tf_adjusted_score(spark: SparkSession, sf: str) -> DataFrame:
    tf = {"c_mktsegment": linkage.term_frequencies(T(spark, sf, "customer"), "c_mktsegment")}
    return _ids(linkage.score(_blocked(spark, sf), MODEL, tf), F.round("match_weight", 6).alias("weight"))


_LINK = """with p as (select s_suppkey as l, c_custkey as r, log2(0.01 / 0.99) + case when abs(s_acctbal - c_acctbal) <= 100 then 3 else -1 end as w, abs(s_acctbal - c_acctbal) as gap from supplier join customer on s_nationkey = c_nationkey and abs(s_acctbal - c_acctbal) <= 500)
"""
_LINK_MODEL = Model(0.01, (Comparison("balance", "false", (Level("near", "abs(l.acctbal - r.acctbal) <= 100", 0.8, 0.1), Level("else", "true", 0.25, 0.5))),))


def _accounts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    left = T(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("acctbal"))
    right = T(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("acctbal"))
    return left, right


def _closeness(left, right):
    """By how much two balances are closer than 500; NaN, no pair, where they are farther apart."""
    gap = np.abs(np.subtract.outer(left["acctbal"].to_numpy(float), right["acctbal"].to_numpy(float)))
    return np.where(gap <= 500, 500 - gap, np.nan)


def _linked(spark: SparkSession, sf: str) -> DataFrame:
    return linkage.score(blocking.block_pairs(*_accounts(spark, sf), "id", [Rule("nation", ("nation",), "abs(l.acctbal - r.acctbal) <= 500")]), _LINK_MODEL)


@query(_LINK + "select l, r, round(w, 6) as weight from p qualify row_number() over (partition by r order by w desc, l) = 1")
def q_top1_per_right(spark: SparkSession, sf: str) -> DataFrame:
    best = linkage.best_per_right(_linked(spark, sf), F.col("l.id"), F.col("r.id"))
    return best.select(F.col("l.id").alias("l"), F.col("r.id").alias("r"), F.round("match_weight", 6).alias("weight"))


@query(_PAIRS + "select l, r from b where (l, r) not in (select least(a.c_custkey, a.c_custkey + 7), greatest(a.c_custkey, a.c_custkey + 7) from customer a) and r - l <> 13")
def q_do_not_link_filter(spark: SparkSession, sf: str) -> DataFrame:
    c = T(spark, sf, "customer").select(F.col("c_custkey").alias("a"))
    barred = c.select((F.col("a") + 7).alias("x"), F.col("a").alias("y")).unionByName(c.select(F.col("a").alias("x"), (F.col("a") + 13).alias("y")))
    return _ids(_blocked(spark, sf, (barred, ("x", "y"))))


@query(_SCORES + """select l, r, comparison, gamma, round(weight, 6) as weight from (
 select l, r, 'balance' as comparison, gamma_balance as gamma, case gamma_balance when 2 then log2(0.6 / 0.02) when 1 then log2(0.3 / 0.08) else log2(0.1 / 0.9) end as weight from w
 union all select l, r, 'segment', gamma_segment, case gamma_segment when 1 then log2(0.9 / 0.2) else log2(0.1 / 0.8) end from w
 union all select l, r, 'nation', gamma_nation, case gamma_nation when 1 then log2(0.95 / 0.04) when 0 then log2(0.05 / 0.96) else 0 end from w)""")
def q_pair_explain_unpivot(spark: SparkSession, sf: str) -> DataFrame:
    out = linkage.explain(linkage.score(_blocked(spark, sf), MODEL), MODEL, [F.col("l.c_custkey").alias("l"), F.col("r.c_custkey").alias("r")])
    return out.withColumn("weight", F.round("weight", 6))


@query(_SCORES + """, s as (select round(1 / (1 + power(2, -w)), 2) as p, count(*) as n from w group by 1)
select p, n / sum(n) over () as prop, sum(n) over (order by p) / sum(n) over () as cumulative from s""")
def q_unlinkables_curve(spark: SparkSession, sf: str) -> DataFrame:
    return linkage.unlinkables(linkage.score(_blocked(spark, sf), MODEL)).withColumn("cumulative", F.round("cumulative", 9))


@query()
def q_em_train(spark: SparkSession, sf: str) -> DataFrame:
    """Prior from deterministic pairs, u from random pairs, m by EM over two training blocks; the trained levels."""
    c = T(spark, sf, "customer")
    exact = blocking.block_pairs(c, None, "c_custkey", [Rule("exact", ("c_nationkey", "c_mktsegment", "round(c_acctbal, -1)"))], _CUSTOMERS).count()
    n = c.count()
    prior = linkage.prior_from_rules(exact, 0.6, n * (n - 1) / 2)
    model = Model(prior, linkage.estimate_u(c.select("c_custkey", *_CUSTOMERS), None, MODEL.comparisons, pairs=1_000_000))
    blocks = []
    for rule, fixed in ((Rule("by_segment", ("c_mktsegment", "floor(c_acctbal / 100)")), ("segment",)), (Rule("by_nation", ("c_nationkey", "floor(c_acctbal / 1000)")), ("nation",))):
        t = Training((rule,), fixed)
        blocks.append((t, linkage.patterns(blocking.block_pairs(c, None, "c_custkey", t.rules, _CUSTOMERS), model.comparisons, t.excluded(model.comparisons))))
    model, _ = linkage.train_runs(blocks, model)
    return linkage.parameter_table(spark, model)


# Clusters.


def _scored_orphans(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The scored pairs of unnamed victims, and their article as the id that two members of a cluster must not share."""
    p = T(spark, sf, "postadj_orphan_cluster_pairs").filter("match_probability >= 0.5").select(F.col("unique_id_l").alias("id_l"), F.col("unique_id_r").alias("id_r"), F.col("match_probability").alias("p"))
    ids = p.select(F.col("id_l").alias("member_id")).unionByName(p.select(F.col("id_r").alias("member_id"))).filter("member_id is not null").distinct()
    return p, ids.withColumn("exclusion_id", F.split_part("member_id", F.lit(":"), F.lit(1)))


@query("""with recursive e as (select unique_id_l as a, unique_id_r as b from postadj_orphan_cluster_pairs where match_probability >= 0.8 and unique_id_l <> unique_id_r union select unique_id_r, unique_id_l from postadj_orphan_cluster_pairs where match_probability >= 0.8 and unique_id_l <> unique_id_r),
w as (select a as id, a as s from e union select w.id, e.b from w join e on w.s = e.a) select id, min(s) as component from w group by 1""")
def q_connected_components(spark: SparkSession, sf: str) -> DataFrame:
    return clustering.connected_components(T(spark, sf, "postadj_orphan_cluster_pairs").filter("match_probability >= 0.8"), "unique_id_l", "unique_id_r")


@query()
def q_constrained_clusters(spark: SparkSession, sf: str) -> DataFrame:
    edges, barred = _scored_orphans(spark, sf)
    return clustering.constrained_clusters(edges, "id_l", "id_r", "p", barred)["clusters"].select("cluster_id", "member_id")


_EDGES = """with e as (select least(unique_id_l, unique_id_r) as l, greatest(unique_id_l, unique_id_r) as r, max(match_probability) as p from postadj_orphan_cluster_pairs
where match_probability >= 0.5 and unique_id_l <> unique_id_r group by all)"""


@query(_EDGES + """ select (select count(*) from (select l from e union select r from e)) as members, 0 as members_in_several, 0 as shared_within, 0 as free_between,
0 as links_unknown, 0 as roots_not_smallest, 0 as blocked_within""")
def q_cluster_invariants(spark: SparkSession, sf: str) -> DataFrame:
    """What constrained clusters must hold: every linked record in one cluster; no article twice in one; no edge between two
    clusters that could still be united; every provenance link an edge with its probability; the root the smallest member."""
    edges, barred = _scored_orphans(spark, sf)
    out = clustering.constrained_clusters(edges, "id_l", "id_r", "p", barred)
    c, scratch = out["clusters"], Scratch(spark)
    held = scratch.keep(c.join(barred, "member_id").select("cluster_id", "member_id", "exclusion_id"), "held")
    e = edges.filter("id_l is not null and id_r is not null and id_l != id_r").groupBy(F.least("id_l", "id_r").alias("l"), F.greatest("id_l", "id_r").alias("r")).agg(F.max("p").alias("p"))
    sets = held.groupBy("cluster_id").agg(F.collect_set("exclusion_id").alias("x"))
    ends = e.join(c.select(F.col("member_id").alias("l"), F.col("cluster_id").alias("cl")), "l").join(c.select(F.col("member_id").alias("r"), F.col("cluster_id").alias("cr")), "r").filter("cl != cr")
    between = ends.select("cl", "cr").distinct().join(sets.toDF("cl", "xl"), "cl").join(sets.toDF("cr", "xr"), "cr")
    links = c.filter("linked_from is not null").select(F.least("member_id", "linked_from").alias("l"), F.greatest("member_id", "linked_from").alias("r"), F.col("linked_prob").alias("p"))
    inside = out["blocked"].join(c.select(F.col("member_id").alias("id_l"), F.col("cluster_id").alias("cl")), "id_l").join(c.select(F.col("member_id").alias("id_r"), F.col("cluster_id").alias("cr")), "id_r")
    one = lambda df, name: df.agg(F.count("*").alias(name))
    parts = [
        c.agg(F.count_distinct("member_id").alias("members"), (F.count("*") - F.count_distinct("member_id")).alias("members_in_several")),
        one(held.groupBy("cluster_id", "exclusion_id").count().filter("count > 1"), "shared_within"), one(between.filter(~F.arrays_overlap("xl", "xr")), "free_between"),
        one(links.join(e, ["l", "r", "p"], "left_anti"), "links_unknown"),
        one(c.groupBy("cluster_id").agg(F.min("member_id").alias("low"), F.count_if(F.col("linked_from").isNull()).alias("roots")).filter("low != cluster_id or roots != 1"), "roots_not_smallest"),
        one(inside.filter("cl = cr"), "blocked_within"),
    ]
    return reduce(lambda a, b: a.crossJoin(b), parts)  # rows of one each


@query()
def q_cluster_provenance(spark: SparkSession, sf: str) -> DataFrame:
    edges, barred = _scored_orphans(spark, sf)
    return clustering.constrained_clusters(edges, "id_l", "id_r", "p", barred)["clusters"].filter("linked_from is not null")


@query()
def q_blocked_edges(spark: SparkSession, sf: str) -> DataFrame:
    edges, barred = _scored_orphans(spark, sf)
    return clustering.constrained_clusters(edges, "id_l", "id_r", "p", barred)["blocked"]


@query()
def q_second_pass_exclusions(spark: SparkSession, sf: str) -> DataFrame:
    """The two-pass form: unions blocked in the first pass become exclusion lists, and the second pass clusters without them."""
    edges, barred = _scored_orphans(spark, sf)
    first = clustering.constrained_clusters(edges, "id_l", "id_r", "p", barred)
    lists = clustering.exclusion_lists(first["blocked"])
    pairs = lists.select(F.col("id").alias("x"), F.explode("exclusion_ids").alias("y"))
    left = blocking.drop_listed(edges, pairs, F.col("id_l"), F.col("id_r"), ("x", "y"))
    return clustering.constrained_clusters(left, "id_l", "id_r", "p", barred)["sizes"]


@query()
def q_max_weight_match(spark: SparkSession, sf: str) -> DataFrame:
    return assignment.match_blocks(*_accounts(spark, sf), "nation", "id", _closeness, ("l", "r", "w")).drop("nation").withColumn("w", F.round("w", 6))


@query()
def q_match_within_groups(spark: SparkSession, sf: str) -> DataFrame:
    out = assignment.match_blocks(*_accounts(spark, sf), "nation", "id", _closeness, ("l", "r", "w"), full=True)
    return out.withColumnRenamed("nation", "g").withColumn("w", F.round("w", 6))


@query()
def q_greedy_groups(spark: SparkSession, sf: str) -> DataFrame:
    scored = _linked(spark, sf).select(F.col("l.nation").alias("g"), F.col("l.id").alias("l"), F.col("r.id").alias("r"), (F.lit(500) - F.abs(F.col("l.acctbal") - F.col("r.acctbal"))).alias("w"))
    return assignment.greedy_groups(scored, "g", "l", "r", "w").withColumn("w", F.round("w", 6))


_OLD, _NEW = "(select c_custkey as m, c_nationkey as c from customer where c_custkey % 11 <> 0)", "(select c_custkey as m, case when c_nationkey = 4 then 400 + c_custkey % 2 when c_nationkey = 6 then 5 else c_nationkey end as c from customer where c_custkey % 13 <> 0 or c_nationkey > 20)"


@query(f"""with o as {_OLD}, n as {_NEW}, os as (select c, string_agg(m, ',' order by cast(m as varchar)) as s from o group by 1), ns as (select c, string_agg(m, ',' order by cast(m as varchar)) as s from n group by 1)
select 'old' as side, cast(c as varchar) as cluster, (select count(*) from o x where x.c = os.c) as n from os where s not in (select s from ns)
union all select 'new', cast(c as varchar), (select count(*) from n x where x.c = ns.c) from ns where s not in (select s from os)""")
def q_cluster_changes(spark: SparkSession, sf: str) -> DataFrame:
    return q_cluster_diff(spark, sf).select("side", "cluster", "n")


@query()
def q_cluster_diff(spark: SparkSession, sf: str) -> DataFrame:
    c = T(spark, sf, "customer")
    old = c.filter("c_custkey % 11 != 0").select(F.col("c_nationkey").alias("cluster_id"), F.col("c_custkey").alias("member_id"))
    moved = F.when(F.col("c_nationkey") == 4, 400 + F.col("c_custkey") % 2).when(F.col("c_nationkey") == 6, 5).otherwise(F.col("c_nationkey"))
    new = c.filter("c_custkey % 13 != 0 or c_nationkey > 20").select(moved.alias("cluster_id"), F.col("c_custkey").alias("member_id"))
    return cluster_diff.diff_clusters(old, new)


# Canonical records.


@query("""with v as (select victim_entity_id as k, lower(trim(canonical_sex)) as s, min_event_day as a, max_event_day as b, entity_row_id as i from victim_entities),
m as (select k, s from (select k, s, count(*) as n from v where s is not null group by all) qualify row_number() over (partition by k order by n desc, s) = 1)
select v.k as entity_id, count(*) as n, min(a) as min_event_day, max(b) as max_event_day, any_value(m.s) as sex from v left join m on v.k = m.k group by v.k""")
def q_entity_view(spark: SparkSession, sf: str) -> DataFrame:
    rows = T(spark, sf, "victim_entities").select(F.col("victim_entity_id").alias("entity_id"), F.lower(F.trim("canonical_sex")).alias("sex"), "min_event_day", "max_event_day")
    out = canonical.entity_view(rows, "entity_id", ["sex"], "min_event_day")
    high = rows.groupBy("entity_id").agg(F.max("max_event_day").alias("high"))
    return out.join(high, "entity_id").select("entity_id", "n", "min_event_day", F.col("high").alias("max_event_day"), "sex")


@query("""with o as (select distinct * exclude (loaded_at, exclusion_ids) from orphan_link_input),
lv as (select *, case date_precision when 'day' then 1 when 'month' then 2 when 'year' then 3 end as lv from o),
b as (select city_id, min(lv) as best from lv group by 1),
c as (select lv.* from lv join b on lv.city_id = b.city_id and lv.lv = b.best),
d as (select city_id, incident_date from (select city_id, incident_date, count(*) as n from c where incident_date is not null group by all) qualify row_number() over (partition by city_id order by n desc, incident_date) = 1),
m as (select city_id, midpoint_day from (select city_id, midpoint_day, count(*) as n from c where midpoint_day is not null group by all) qualify row_number() over (partition by city_id order by n desc, midpoint_day) = 1),
sx as (select city_id, victim_sex from (select city_id, victim_sex, count(*) as n from o where victim_sex is not null group by all) qualify row_number() over (partition by city_id order by n desc, victim_sex) = 1),
a as (select city_id, avg(offender_age) as offender_age from (select *, rank() over (partition by city_id order by n desc) as r from (select city_id, offender_age, count(*) as n from o where offender_age is not null group by all)) where r = 1 group by 1),
p as (select city_id, geo_address_norm from o qualify row_number() over (partition by city_id order by address_type = 'ADDRESS' desc nulls last, geo_score desc nulls last, unique_id) = 1)
select b.city_id, (select count(*) from o x where x.city_id = b.city_id) as n_members, case best when 1 then 'day' when 2 then 'month' else 'year' end as date_precision, cast(incident_date as varchar) as incident_date, midpoint_day, victim_sex, offender_age, geo_address_norm
from b left join d using (city_id) left join m using (city_id) left join sx using (city_id) left join a using (city_id) left join p using (city_id)""")
def q_canonical_entity(spark: SparkSession, sf: str) -> DataFrame:
    """The canonical record of each city's orphan records, as if a city were one entity: large groups of known content."""
    rows = T(spark, sf, "orphan_link_input").drop("loaded_at", "exclusion_ids").distinct()
    order = [F.desc_nulls_last(F.col("address_type") == "ADDRESS"), F.desc_nulls_last("geo_score")]
    out = canonical.canonical_records(rows, "city_id", "unique_id", ["victim_sex"], ("incident_date", "midpoint_day", "date_precision"), "article_id", order, ["geo_address_norm"])
    return out.select("city_id", "n_members", "date_precision", F.col("incident_date").cast("string").alias("incident_date"), "midpoint_day", "victim_sex", "offender_age", "geo_address_norm")


@query("""with e as (select victim_entity_id as k, count(*) as n, min(min_event_day) as a, max(max_event_day) as b, string_agg(distinct feed, ',') as f from victim_entities where feed_rank <= 3 group by 1),
x as (select victim_entity_id as k, 1 as n, min_event_day as a, max_event_day as b, feed as f from victim_entities where feed_rank > 3),
u as (select * from e union all select * from x)
select k, cast(sum(n) as bigint) as n, min(a) as a, max(b) as b, (select string_agg(distinct t, ',' order by t) from (select unnest(string_split(string_agg(u.f, ','), ',')) as t)) as f from u group by k""")
def q_integrate_members(spark: SparkSession, sf: str) -> DataFrame:
    v = T(spark, sf, "victim_entities").select(F.col("victim_entity_id").alias("k"), F.col("min_event_day").alias("a"), F.col("max_event_day").alias("b"), F.col("feed").alias("f"), "feed_rank")
    base = v.filter("feed_rank <= 3").groupBy("k").agg(F.count("*").alias("n"), F.min("a").alias("a"), F.max("b").alias("b"), F.array_join(F.array_sort(F.collect_set("f")), ",").alias("f"))
    added = v.filter("feed_rank > 3").select("k", F.lit(1).cast("bigint").alias("n"), "a", "b", "f")
    return canonical.integrate(base, added, "k", ["n"], ["a"], ["b"], {"f": "csv"})


@query("""with o as (select c_custkey as orphan_id, (c_custkey * 7) % 120 as entity_id, c_acctbal as decided_at from customer where c_custkey % 3 = 0 union all select c_custkey, (c_custkey * 7) % 120 + 1, c_acctbal + 1 from customer where c_custkey % 9 = 0),
m as (select c_custkey as orphan_id, (c_custkey * 7) % 120 as entity_id from customer where c_custkey % 5 = 0 union all select c_custkey, 1 from customer where c_custkey % 7 = 0 and c_custkey % 5 <> 0),
l as (select orphan_id, min(entity_id) as machine from m group by 1), n as (select *, row_number() over (partition by orphan_id order by decided_at, entity_id) as k from o)
select n.orphan_id, n.entity_id, case when n.orphan_id % 21 = 0 then 'missing_orphan' when s_suppkey is null then 'missing_entity' when k > 1 then 'duplicate' when machine = n.entity_id then 'already_matched' when machine is not null then 'conflict' else 'applied' end as status
from n left join supplier on s_suppkey = n.entity_id left join l on l.orphan_id = n.orphan_id""")
def q_apply_overrides(spark: SparkSession, sf: str) -> DataFrame:
    c = T(spark, sf, "customer").select(F.col("c_custkey").alias("orphan_id"), ((F.col("c_custkey") * 7) % 120).alias("entity_id"), F.col("c_acctbal").alias("decided_at"))
    more = c.filter("orphan_id % 9 = 0").select("orphan_id", (F.col("entity_id") + 1).alias("entity_id"), (F.col("decided_at") + 1).alias("decided_at"))
    machine = c.filter("orphan_id % 5 = 0").select("orphan_id", "entity_id").unionByName(c.filter("orphan_id % 7 = 0 and orphan_id % 5 != 0").select("orphan_id", F.lit(1).cast("bigint").alias("entity_id")))
    out = canonical.apply_overrides(c.filter("orphan_id % 3 = 0").unionByName(more), T(spark, sf, "supplier").select(F.col("s_suppkey").alias("entity_id")), c.filter("orphan_id % 21 != 0"), machine)
    return out.select("orphan_id", "entity_id", "status")


@query("""with m as (select e_uid, s_uid from (select distinct e_uid, s_uid from shr_matches_diffs where source = 2) qualify row_number() over (partition by s_uid order by e_uid) = 1)
select 'match' as rec_type, count(*) as n from (select distinct e.unique_id, m.s_uid from (select distinct unique_id from entity_link_input) e join m on m.e_uid = e.unique_id join (select distinct "index" as i from shr) s on cast(s.i as varchar) = m.s_uid)
union all select 'left_only', count(*) from (select distinct unique_id from entity_link_input where unique_id not in (select m.e_uid from m join shr on cast("index" as varchar) = m.s_uid))
union all select 'right_only', count(*) from (select distinct "index" as i from shr where cast("index" as varchar) not in (select s_uid from m join entity_link_input on unique_id = e_uid))""")
def q_matched_left_right_union(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.operators.aggregates import best_row

    m = best_row(T(spark, sf, "shr_matches_diffs").filter("source = 2").select("e_uid", "s_uid").distinct(), ["s_uid"], [F.col("e_uid")])
    left = T(spark, sf, "entity_link_input").select(F.col("unique_id").alias("e_uid")).distinct()
    right = T(spark, sf, "shr").select(F.col("index").cast("string").alias("s_uid")).distinct()
    known = m.join(left, "e_uid", "left_semi").join(right, "s_uid", "left_semi")
    return tables.outer_report(left, right, known, "e_uid", "s_uid").groupBy("rec_type").agg(F.count("*").alias("n"))
