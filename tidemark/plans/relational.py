"""Queries of scans, filters, joins, aggregates, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import categories, values
from tidemark.functions.text import contains_any_case, csv_union
from tidemark.operators import aggregates as agg
from tidemark.operators import ranking, tables
from tidemark.session import read_table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with the SQL that gives the same result."""

    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn

    return add


T = read_table


# Scans, sinks and changes of tables.


@query("select o_orderkey, o_orderpriority as priority, o_totalprice from orders where o_orderstatus = 'F' and o_totalprice > 100000")
def q_parameterised_scan(spark: SparkSession, sf: str) -> DataFrame:
    T(spark, sf, "orders").createOrReplaceTempView("orders_scan")
    return spark.sql("select o_orderkey, o_orderpriority as priority, o_totalprice from orders_scan where o_orderstatus = ? and o_totalprice > ?", args=["F", 100000])


@query("select c_custkey, c_name, case when n_name is null then c_mktsegment else n_name end as label, round(c_acctbal + 100, 2) as c_acctbal from customer left join (select n_nationkey, n_name from nation where n_regionkey = 1) on c_nationkey = n_nationkey")
def q_update_from(spark: SparkSession, sf: str) -> DataFrame:
    old = T(spark, sf, "customer").select("c_custkey", "c_name", F.col("c_mktsegment").alias("label"), F.round(F.col("c_acctbal") + 100, 2).alias("c_acctbal"), "c_nationkey")
    new = T(spark, sf, "nation").filter("n_regionkey = 1").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("label"))
    return tables.update_from(old, new, ["c_nationkey"], ["label"]).drop("c_nationkey")


@query("select o_orderkey, case when o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING') then 'X' else o_orderstatus end as o_orderstatus from orders")
def q_update_in_subquery(spark: SparkSession, sf: str) -> DataFrame:
    orders = T(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    keys = T(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return tables.update_where(orders, keys, ["o_custkey"], {"o_orderstatus": F.lit("X")}).drop("o_custkey")


@query("select o_orderkey, o_totalprice from orders where o_custkey not in (select c_custkey from customer where c_acctbal < 0)")
def q_delete_in_subquery(spark: SparkSession, sf: str) -> DataFrame:
    gone = T(spark, sf, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return tables.delete_keys(T(spark, sf, "orders"), gone, ["o_custkey"]).select("o_orderkey", "o_totalprice")


@query("""with new as (select o_orderkey, o_custkey, o_totalprice * 2 as o_totalprice, 'new' as o from orders where o_orderdate >= timestamp '2001-01-01'
  union all select o_orderkey + 100000000, o_custkey, o_totalprice, 'new' from orders where o_orderdate < timestamp '1995-02-01')
select * from new union all select o_orderkey, o_custkey, o_totalprice, 'old' from orders where o_orderkey not in (select o_orderkey from new)""")
def q_upsert(spark: SparkSession, sf: str) -> DataFrame:
    orders = T(spark, sf, "orders")
    late = orders.filter("o_orderdate >= '2001-01-01'").select("o_orderkey", "o_custkey", (F.col("o_totalprice") * 2).alias("o_totalprice"))
    extra = orders.filter("o_orderdate < '1995-02-01'").select((F.col("o_orderkey") + 100000000).alias("o_orderkey"), "o_custkey", "o_totalprice")
    new = late.unionByName(extra).withColumn("o", F.lit("new"))
    return tables.upsert(orders.select("o_orderkey", "o_custkey", "o_totalprice", F.lit("old").alias("o")), new, ["o_orderkey"])


@query("""with b as (select * from orphan_link_input qualify row_number() over (partition by unique_id order by loaded_at desc) = 1)
select unique_id, loaded_at, city_id from b""")
def q_upsert_by_time(spark: SparkSession, sf: str) -> DataFrame:
    rows = T(spark, sf, "orphan_link_input").select("unique_id", "loaded_at", "city_id")
    return tables.upsert(rows.limit(0), rows, ["unique_id"], order="loaded_at")


@query("select s_suppkey, s_name, 'old' as o from supplier union all select c_custkey, c_name, 'new' from customer where c_custkey not in (select s_suppkey from supplier)")
def q_insert_ignore(spark: SparkSession, sf: str) -> DataFrame:
    old = T(spark, sf, "supplier").select("s_suppkey", "s_name", F.lit("old").alias("o"))
    new = T(spark, sf, "customer").select(F.col("c_custkey").alias("s_suppkey"), F.col("c_name").alias("s_name"), F.lit("new").alias("o"))
    return tables.insert_ignore(old, new, ["s_suppkey"])


@query("""select o_custkey, count(*) as n, 'old' as o from orders where o_custkey not in (select o_custkey from orders where o_orderdate >= timestamp '2001-06-01') group by 1
union all select o_custkey, count(*) + 1000, 'new' from orders where o_custkey in (select o_custkey from orders where o_orderdate >= timestamp '2001-06-01') group by 1""")
def q_refresh_slice(spark: SparkSession, sf: str) -> DataFrame:
    orders = T(spark, sf, "orders")
    old = orders.groupBy("o_custkey").agg(F.count("*").alias("n")).withColumn("o", F.lit("old"))
    touched = orders.filter("o_orderdate >= '2001-06-01'").select("o_custkey").distinct()
    fresh = orders.join(touched, "o_custkey", "left_semi").groupBy("o_custkey").agg((F.count("*") + 1000).alias("n")).withColumn("o", F.lit("new"))
    return tables.refresh(old, fresh, ["o_custkey"], touched)


@query("select p_partkey, p_name, cast(null as varchar) as note, try_cast(p_size as varchar) as p_size from part")
def q_add_columns(spark: SparkSession, sf: str) -> DataFrame:
    return tables.ensure_columns(T(spark, sf, "part").select("p_partkey", "p_name", "p_size"), {"note": "string", "p_size": "string"})


@query("""with x(raw, code) as (values ('handgun (pistol, revolver)', 1), ('knife or cutting tool', 2), ('rifle', 1), ('shotgun', 1), ('blunt object (club, hammer)', 3))
select Weapon as weapon, coalesce(code, 6) as code, count(*) as n from shr left join x on lower(trim(regexp_replace(Weapon, '\\s+', ' ', 'g'))) = raw group by all""")
def q_crosswalk(spark: SparkSession, sf: str) -> DataFrame:
    pairs = [("Handgun (pistol, revolver)", 1), ("Knife or cutting tool", 2), ("Rifle", 1), ("Shotgun", 1), ("Blunt object  (club, hammer)", 3)]
    cross = spark.createDataFrame([("weapon", r, c) for r, c in pairs], "domain string, raw_value string, group_code int")
    coded = tables.decode(T(spark, sf, "shr").select("Weapon"), cross, "Weapon", "weapon")
    return coded.groupBy(F.col("Weapon").alias("weapon"), F.col("Weapon_code").alias("code")).agg(F.count("*").alias("n"))


# Filters and predicate forms.


@query("""select "index" as id, Year as year, case when VicAge between 0 and 120 then VicAge end as age, case when OffAge <> 999 then OffAge end as off_age from shr
where Year between 1990 and 1999 and State is not distinct from 'Westmark' and coalesce(VicSex, '') not in ('U', 'Unknown', '')""")
def q_filter_forms(spark: SparkSession, sf: str) -> DataFrame:
    shr = T(spark, sf, "shr").filter(F.col("Year").between(1990, 1999) & F.col("State").eqNullSafe("Westmark") & ~F.coalesce("VicSex", F.lit("")).isin("U", "Unknown", ""))
    return shr.select(F.col("index").alias("id"), F.col("Year").alias("year"), values.within(F.col("VicAge"), 0, 120).alias("age"), values.without(F.col("OffAge"), [999]).alias("off_age"))


@query("select doc_id, pub_date from documents where pub_date between '19900101' and '19951231' and title ilike '%trial%' and title not like '%TRIAL%'")
def q_like_and_range(spark: SparkSession, sf: str) -> DataFrame:
    docs = T(spark, sf, "documents").filter(F.col("pub_date").between("19900101", "19951231") & contains_any_case(F.col("title"), "trial") & ~F.col("title").like("%TRIAL%"))
    return docs.select("doc_id", "pub_date")


@query("""select o_orderkey, o_orderdate from orders where cast(o_orderdate as date) in
(select d from (select distinct cast(o_orderdate as date) as d from orders where o_orderstatus = 'O') order by d desc limit 25)""")
def q_topn_dates_semi(spark: SparkSession, sf: str) -> DataFrame:
    orders = T(spark, sf, "orders").withColumn("d", F.to_date("o_orderdate"))
    dates = orders.filter("o_orderstatus = 'O'").select("d").distinct().orderBy(F.desc("d")).limit(25)
    return orders.join(F.broadcast(dates), "d", "left_semi").select("o_orderkey", "o_orderdate")


@query("select c_custkey from customer where nullif(c_nationkey, 7) not in (select nullif(s_nationkey, -1) from supplier where s_acctbal > 9000)")
def q_null_aware_not_in(spark: SparkSession, sf: str) -> DataFrame:
    T(spark, sf, "customer").createOrReplaceTempView("customer_na")
    T(spark, sf, "supplier").createOrReplaceTempView("supplier_na")
    return spark.sql("select c_custkey from customer_na where nullif(c_nationkey, 7) not in (select nullif(s_nationkey, -1) from supplier_na where s_acctbal > 9000)")


@query("""select strftime(o_orderdate, '%Y-%m') as month from orders group by 1 having sum(case when o_orderstatus = 'O' then 1 else 0 end) = 0""")
def q_complete_dates(spark: SparkSession, sf: str) -> DataFrame:
    orders = T(spark, sf, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    open_ = orders.filter("o_orderstatus = 'O'").select("month")
    return orders.select("month").distinct().join(open_, "month", "left_anti")


@query("""select o_orderkey from orders o where exists (select 1 from lineitem l where l.l_orderkey = o.o_orderkey and l_quantity > 48)
and not exists (select 1 from lineitem l where l.l_orderkey = o.o_orderkey and l_returnflag = 'R')""")
def q_exists_not_exists(spark: SparkSession, sf: str) -> DataFrame:
    orders, items = T(spark, sf, "orders").select("o_orderkey"), T(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity", "l_returnflag")
    return orders.join(items.filter("l_quantity > 48"), "o_orderkey", "left_semi").join(items.filter("l_returnflag = 'R'"), "o_orderkey", "left_anti")


@query("select * exclude (p_comment) from (select p_partkey, p_name, p_size, p_brand as p_comment from part)")
def q_select_except(spark: SparkSession, sf: str) -> DataFrame:
    return T(spark, sf, "part").select("p_partkey", "p_name", "p_size", F.col("p_brand").alias("p_comment")).drop("p_comment")


@query("""select "index" as id, case when lower(trim(Weapon)) like '%knife%' then 'knife' when lower(trim(Weapon)) like '%shotgun%' then 'shotgun' when lower(trim(Weapon)) like '%rifle%' then 'rifle'
 when lower(trim(Weapon)) like '%gun%' or lower(trim(Weapon)) like '%firearm%' then 'firearm' when lower(trim(Weapon)) like '%blunt%' then 'blunt object' when lower(trim(Weapon)) like '%personal%' then 'personal weapon'
 when lower(trim(Weapon)) like '%fire%' then 'fire' when lower(trim(Weapon)) like '%strangulation%' then 'strangulation' when lower(trim(Weapon)) like '%asphyxiation%' then 'asphyxiation'
 when lower(trim(Weapon)) like '%drugs%' then 'drugs' when lower(trim(Weapon)) like '%poison%' then 'poison' when lower(trim(Weapon)) like '%other%' then 'other' else 'unknown' end as weapon,
 case when lower(trim(Circumstance)) like '%narcotic%' then 'narcotics related' when lower(trim(Circumstance)) like '%lover%' then 'lover''s triangle' when lower(trim(Circumstance)) like '%undetermined%' then 'undetermined'
 when lower(trim(Circumstance)) like '%argument%' then 'argument' when lower(trim(Circumstance)) like '%robbery%' then 'robbery' when lower(trim(Circumstance)) like '%brawl%' then 'brawl'
 when lower(trim(Circumstance)) like '%felony%' then 'other felony related' when lower(trim(Circumstance)) like '%gang%' then 'gang killing' when lower(trim(Circumstance)) like '%burglary%' then 'burglary'
 when lower(trim(Circumstance)) like '%other%' then 'other' else 'undetermined' end as circumstance,
 case when lower(trim(Relationship)) in ('acquaintance', 'son', 'daughter', 'husband', 'stranger', 'wife', 'girlfriend', 'boyfriend', 'neighbor', 'friend') then lower(trim(Relationship)) end as relationship from shr""")
def q_category_maps(spark: SparkSession, sf: str) -> DataFrame:
    return T(spark, sf, "shr").select(
        F.col("index").alias("id"), categories.weapon(F.col("Weapon")).alias("weapon"), categories.circumstance(F.col("Circumstance")).alias("circumstance"),
        categories.relationship(F.col("Relationship")).alias("relationship"),
    )


# Joins.


@query("""select coalesce(c.c_nationkey, s.s_nationkey) as nation, case when c.c_nationkey is null then 'right_only' when s.s_nationkey is null then 'left_only' else 'match' end as tag, coalesce(nc, 0) as nc, coalesce(ns, 0) as ns
from (select c_nationkey, count(*) as nc from customer where c_acctbal > 5000 and c_nationkey < 18 group by 1) c full outer join (select s_nationkey, count(*) as ns from supplier where s_nationkey > 4 group by 1) s on c.c_nationkey = s.s_nationkey""")
def q_full_outer_tagged(spark: SparkSession, sf: str) -> DataFrame:
    left = T(spark, sf, "customer").filter("c_acctbal > 5000 and c_nationkey < 18").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count("*").alias("nc"))
    right = T(spark, sf, "supplier").filter("s_nationkey > 4").groupBy(F.col("s_nationkey").alias("nation")).agg(F.count("*").alias("ns"))
    tag = F.when(F.col("nc").isNull(), "right_only").when(F.col("ns").isNull(), "left_only").otherwise("match")
    return left.join(right, "nation", "full_outer").select("nation", tag.alias("tag"), F.coalesce("nc", F.lit(0)).alias("nc"), F.coalesce("ns", F.lit(0)).alias("ns"))


@query("""with l as (select e_uid, trim(x) as article_id from shr_matches_diffs, unnest(string_split(article_ids_csv, ',')) as u(x) where source = 2)
select article_id, count(distinct e_uid) as n, min(e_uid) as first from l where article_id <> '' group by 1""")
def q_csv_membership(spark: SparkSession, sf: str) -> DataFrame:
    rows = T(spark, sf, "shr_matches_diffs").filter("source = 2").select("e_uid", F.explode(F.split("article_ids_csv", ",")).alias("x"))
    ids = rows.select("e_uid", F.trim("x").alias("article_id")).filter("article_id != ''")
    return ids.groupBy("article_id").agg(F.count_distinct("e_uid").alias("n"), F.min("e_uid").alias("first"))


@query("""select c_custkey, (select count(*) from orders where o_custkey = c_custkey) as n, (select o_orderkey from orders where o_custkey = c_custkey order by o_totalprice desc, o_orderkey limit 1) as best from customer""")
def q_scalar_subqueries(spark: SparkSession, sf: str) -> DataFrame:
    per = T(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.max_by("o_orderkey", F.struct("o_totalprice", -F.col("o_orderkey"))).alias("best"))
    return T(spark, sf, "customer").select("c_custkey").join(per, "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n"), "best")


# Aggregates.


@query("""select o_orderpriority as p, count(*) as n, count(*) filter (where o_orderstatus = 'F') as f, count_if(o_totalprice > 200000) as big, round(sum(case when o_orderstatus = 'O' then o_totalprice else 0 end), 2) as open_sum,
count(distinct o_custkey) as c, max(case when o_orderstatus = 'P' then 1 else 0 end) as any_p from orders group by 1 having count(*) > 10""")
def q_conditional_rollup(spark: SparkSession, sf: str) -> DataFrame:
    status = lambda s: F.col("o_orderstatus") == s
    out = T(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("p")).agg(
        F.count("*").alias("n"), F.count_if(status("F")).alias("f"), F.count_if(F.col("o_totalprice") > 200000).alias("big"), F.round(F.sum(F.when(status("O"), F.col("o_totalprice")).otherwise(0)), 2).alias("open_sum"),
        F.count_distinct("o_custkey").alias("c"), F.max(F.when(status("P"), 1).otherwise(0)).alias("any_p"),
    )
    return out.filter("n > 10")


@query("""select user_id, event_type from (select user_id, event_type, count(*) as n from events group by all) qualify row_number() over (partition by user_id order by n desc, event_type) = 1""")
def q_modal_value(spark: SparkSession, sf: str) -> DataFrame:
    return agg.modal_value(T(spark, sf, "events"), ["user_id"], "event_type")


@query("""with c as (select city_id, weapon, case when weapon in ('handgun', 'rifle', 'shotgun', 'firearm') then 'firearm' else weapon end as fam, count(*) as n from orphan_link_input where weapon is not null group by all),
f as (select city_id, fam from (select city_id, fam, sum(n) as t from c group by all) qualify row_number() over (partition by city_id order by t desc, fam) = 1)
select city_id, weapon from c join f using (city_id, fam) qualify row_number() over (partition by city_id order by n desc, case weapon when 'handgun' then 1 when 'rifle' then 2 when 'shotgun' then 3 when 'firearm' then 4 else 5 end, weapon) = 1""")
def q_grouped_mode(spark: SparkSession, sf: str) -> DataFrame:
    rows = T(spark, sf, "orphan_link_input").select("city_id", "weapon")
    return agg.grouped_mode(rows, ["city_id"], "weapon", categories.family(F.col("weapon"), categories.WEAPON_FAMILY), categories.WEAPON_PRIORITY)


@query("""with c as (select city_id, relationship, count(*) as n from orphan_link_input group by all)
select city_id, relationship from c qualify row_number() over (partition by city_id order by case when relationship is null then 0 when lower(relationship) like '%unknown%' then 1 else 2 end desc, n desc, relationship) = 1""")
def q_specificity_mode(spark: SparkSession, sf: str) -> DataFrame:
    return agg.specific_mode(T(spark, sf, "orphan_link_input").select("city_id", "relationship"), ["city_id"], "relationship")


@query("""with c as (select city_id, offender_age, count(*) as n from orphan_link_input where offender_age is not null group by all)
select city_id, avg(offender_age) as offender_age from (select *, rank() over (partition by city_id order by n desc) as r from c) where r = 1 group by 1""")
def q_avg_of_tied_modes(spark: SparkSession, sf: str) -> DataFrame:
    return agg.mean_of_modes(T(spark, sf, "orphan_link_input").select("city_id", "offender_age"), ["city_id"], "offender_age")


@query("""select city_id, unique_id, geo_score from (select distinct city_id, unique_id, geo_score, address_type from orphan_link_input)
qualify row_number() over (partition by city_id order by address_type = 'ADDRESS' desc nulls last, geo_score desc nulls last, unique_id) = 1""")
def q_best_of_row(spark: SparkSession, sf: str) -> DataFrame:
    rows = T(spark, sf, "orphan_link_input").select("city_id", "unique_id", "geo_score", "address_type").distinct()
    return agg.best_row(rows, ["city_id"], [F.desc_nulls_last(F.col("address_type") == "ADDRESS"), F.desc_nulls_last("geo_score"), F.col("unique_id")]).drop("address_type")


@query("""select l_orderkey, sum(cast(power(2, k) as bigint)) as bits, count(*) as n from (select distinct l_orderkey, l_linenumber % 8 as k from lineitem) group by 1 having (cast(sum(cast(power(2, k) as bigint)) as bigint) & 4) > 0""")
def q_bit_types(spark: SparkSession, sf: str) -> DataFrame:
    rows = T(spark, sf, "lineitem").select("l_orderkey", (F.col("l_linenumber") % 8).alias("k")).distinct()
    return rows.groupBy("l_orderkey").agg(agg.bit_sum("k").alias("bits"), F.count("*").alias("n")).filter(values.has_bit(F.col("bits"), 2))


@query("select e_uid, md5(string_agg(distinct s_uid, ',' order by s_uid)) as h, string_agg(distinct s_uid, ',' order by s_uid) as members from shr_matches_diffs group by 1")
def q_set_hash(spark: SparkSession, sf: str) -> DataFrame:
    return T(spark, sf, "shr_matches_diffs").groupBy("e_uid").agg(agg.set_hash("s_uid").alias("h"), agg.joined_set("s_uid").alias("members"))


@query("""with o as (select c_mktsegment as seg, o_orderpriority as pri from orders join customer on o_custkey = c_custkey),
c as (select coalesce(seg, 'All') as seg, coalesce(pri, 'All') as pri, count(*) as n from o group by cube (seg, pri))
select seg, pri, n, n / (select n from c x where x.seg = c.seg and x.pri = 'All') as share from c""")
def q_crosstab_margins(spark: SparkSession, sf: str) -> DataFrame:
    rows = T(spark, sf, "orders").join(T(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_mktsegment").alias("seg"), F.col("o_orderpriority").alias("pri"))
    return agg.crosstab(rows, "seg", "pri", normalize="index")


@query("""select l_returnflag, avg(l_quantity) filter (where l_linestatus = 'O') as o, avg(l_quantity) filter (where l_linestatus = 'F') as f from (select l_returnflag, l_linestatus, cast(l_quantity as double) as l_quantity from lineitem) group by 1""")
def q_pivot_mean(spark: SparkSession, sf: str) -> DataFrame:
    rows = T(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", F.col("l_quantity").cast("double").alias("q"))
    return rows.groupBy("l_returnflag").pivot("l_linestatus", ["O", "F"]).agg(F.avg("q")).toDF("l_returnflag", "o", "f")


@query("select c_nationkey, c_custkey from customer where c_nationkey in (select c_nationkey from customer group by 1 having count(*) > (select count(*) from customer) * 0.04)")
def q_frequent_groups(spark: SparkSession, sf: str) -> DataFrame:
    return agg.frequent_groups(T(spark, sf, "customer").select("c_nationkey", "c_custkey"), "c_nationkey", 0.04)


@query("""with c as (select count_if(t and s) as tp, count_if(not t and s) as fp, count_if(t and not s) as fn, count_if(not t and not s) as tn from
(select coalesce(auto_class = 'M', false) as t, coalesce(lower(title) like '%trial%', false) as s from documents))
select *, tp / nullif(tp + fn, 0) as sensitivity, tn / nullif(tn + fp, 0) as specificity from c""")
def q_confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return agg.confusion(T(spark, sf, "documents"), F.col("auto_class") == "M", F.lower("title").contains("trial"))


@query("""with g as (select * from (select distinct feed from victim_entities), (select distinct canonical_ethnicity as e from victim_entities))
select g.feed, g.e, count(v.entity_row_id) as n, avg(v.city_id) as m from g left join victim_entities v on v.feed = g.feed and v.canonical_ethnicity = g.e where g.e is not null group by g.feed, g.e""")
def q_full_grid(spark: SparkSession, sf: str) -> DataFrame:
    rows = T(spark, sf, "victim_entities").select("feed", F.col("canonical_ethnicity").alias("e"), "city_id", "entity_row_id").filter("e is not null")
    return agg.full_grid(rows, ["feed", "e"], F.count("entity_row_id").alias("n"), F.avg("city_id").alias("m")).withColumn("n", F.coalesce("n", F.lit(0)))


@query("select least(n, 5) as k, count(*) as n from (select victim_entity_id, count(*) as n from victim_entities group by 1) group by 1")
def q_topcoded_histogram(spark: SparkSession, sf: str) -> DataFrame:
    per = T(spark, sf, "victim_entities").groupBy("victim_entity_id").agg(F.count("*").alias("c"))
    return per.groupBy(F.least("c", F.lit(5)).alias("k")).agg(F.count("*").alias("n"))


@query("select publication, auto_class, n, n / sum(n) over (partition by publication) as share from (select publication, auto_class, count(*) as n from documents group by all)")
def q_class_shares(spark: SparkSession, sf: str) -> DataFrame:
    counts = T(spark, sf, "documents").groupBy("publication", "auto_class").agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("publication")))


# Windows and ranks.


@query("""select o_orderkey, row_number() over (order by o_orderdate, o_orderkey) as n from orders""")
def q_global_row_numbers(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.numbered(T(spark, sf, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("""select c_custkey, row_number() over (order by md5(concat(cast(c_custkey as varchar), '|7')), c_custkey) as priority from customer""")
def q_random_permutation(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.permuted(T(spark, sf, "customer").select("c_custkey"), "c_custkey", "7")


@query("""select doc_id, source from documents qualify row_number() over (partition by source, publication order by md5(concat(cast(doc_id as varchar), '|3')), doc_id) <= 5""")
def q_stratified_sample(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.stratified(T(spark, sf, "documents").select("doc_id", "source", "publication"), ["source", "publication"], 5, "doc_id", "3").select("doc_id", "source")


@query("""select "index" as id, dense_rank() over (partition by YearMonth order by Incident) as rank, count(*) over (partition by YearMonth) as n, max(VicAge) over (partition by YearMonth) as oldest from shr""")
def q_whole_partition_windows(spark: SparkSession, sf: str) -> DataFrame:
    w = Window.partitionBy("YearMonth")
    return T(spark, sf, "shr").select(F.col("index").alias("id"), F.dense_rank().over(w.orderBy(F.asc_nulls_last("Incident"))).alias("rank"), F.count("*").over(w).alias("n"), F.max("VicAge").over(w).alias("oldest"))


@query("""select case when o_totalprice > 150000 then 'big' else 'small' end as size, o_orderpriority, o_orderkey from orders qualify row_number() over (partition by case when o_totalprice > 150000 then 'big' else 'small' end, o_orderpriority order by o_orderdate desc, o_orderkey) = 1""")
def q_top1_by_case(spark: SparkSession, sf: str) -> DataFrame:
    rows = T(spark, sf, "orders").withColumn("size", F.when(F.col("o_totalprice") > 150000, "big").otherwise("small"))
    return agg.best_row(rows, ["size", "o_orderpriority"], [F.desc("o_orderdate"), F.col("o_orderkey")]).select("size", "o_orderpriority", "o_orderkey")


@query("""select p_partkey, p_size from part where p_size >= (select min(p_size) from (select p_size from part order by p_size desc limit 20))""")
def q_topk_with_ties(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.top_with_ties(T(spark, sf, "part").select("p_partkey", "p_size"), 20, "p_size")


@query("select p_brand, p_partkey from (select p_brand, p_partkey, rank() over (partition by p_brand order by p_size desc) as r from part) where r <= 3")
def q_topk_ties_by_group(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.top_with_ties(T(spark, sf, "part").select("p_brand", "p_partkey", "p_size"), 3, "p_size", ["p_brand"]).drop("p_size")


@query("""select o_orderkey, o_custkey from orders where o_custkey in (select o_custkey from (select * from orders order by o_orderdate, o_orderkey limit 40))""")
def q_batch_whole_groups(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.batch_whole_groups(T(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), 40, [F.col("o_orderdate"), F.col("o_orderkey")], "o_custkey").select("o_orderkey", "o_custkey")


@query("select source, doc_id, loaded_at from documents qualify row_number() over (partition by source order by loaded_at desc nulls last, doc_id desc) = 1")
def q_latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.latest(T(spark, sf, "documents").select("source", "doc_id", "loaded_at"), ["source"], "loaded_at", "doc_id")


@query("""select doc_id from (select doc_id, row_number() over (order by auto_class is null, case auto_class when 'M' then 1 when 'O' then 2 else 3 end, pub_date desc nulls last, doc_id) as n from documents) where n <= 50""")
def q_ranked_order(spark: SparkSession, sf: str) -> DataFrame:
    rank = F.when(F.col("auto_class") == "M", 1).when(F.col("auto_class") == "O", 2).otherwise(3)
    return T(spark, sf, "documents").orderBy(F.col("auto_class").isNull(), rank, F.desc_nulls_last("pub_date"), "doc_id").limit(50).select("doc_id")


@query("""with d as (select *, row_number() over (order by s desc, id) as a, row_number() over (order by t desc, id) as b, row_number() over (partition by g order by s desc, id) as c from (select c_custkey as id, c_acctbal as s, -c_acctbal as t, c_nationkey as g from customer))
select id from d where a <= 5 or b <= 5 or c <= 3""")
def q_union_of_top_lists(spark: SparkSession, sf: str) -> DataFrame:
    rows = T(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("s"), F.col("c_nationkey").alias("g"))
    a, b = rows.orderBy(F.desc("s"), "id").limit(5), rows.orderBy("s", "id").limit(5)
    c = agg.best_row(rows, ["g"], [F.desc("s"), F.col("id")])
    w = Window.partitionBy("g").orderBy(F.desc("s"), "id")
    c = rows.withColumn("_n", F.row_number().over(w)).filter("_n <= 3")
    return a.select("id").unionByName(b.select("id")).unionByName(c.select("id")).distinct()


# Sets.


@query("""select k, 'both' as w from (select c_nationkey as k from customer intersect select s_nationkey from supplier) union all
select k, 'left' from (select c_nationkey as k from customer except select s_nationkey from supplier where s_acctbal > 0)""")
def q_set_operations(spark: SparkSession, sf: str) -> DataFrame:
    c, s = T(spark, sf, "customer").select(F.col("c_nationkey").alias("k")), T(spark, sf, "supplier")
    both = c.intersect(s.select("s_nationkey")).withColumn("w", F.lit("both"))
    return both.unionByName(c.subtract(s.filter("s_acctbal > 0").select("s_nationkey")).withColumn("w", F.lit("left")))


@query("""select p_partkey, f, v from (select p_partkey, cast(p_size as double) as size, cast(p_retailprice as double) as price from part) unpivot (v for f in (size, price))""")
def q_unpivot(spark: SparkSession, sf: str) -> DataFrame:
    rows = T(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("size"), F.col("p_retailprice").cast("double").alias("price"))
    return rows.unpivot(["p_partkey"], ["size", "price"], "f", "v").filter("v is not null")


@query("""select e_uid, array_to_string(list_sort(list_distinct(flatten(list(list_transform(string_split(article_ids_csv, ','), lambda x: trim(x)))))), ',') as ids from shr_matches_diffs group by 1""")
def q_csv_set_union(spark: SparkSession, sf: str) -> DataFrame:
    per = T(spark, sf, "shr_matches_diffs").groupBy("e_uid").agg(F.array_join(F.collect_list("article_ids_csv"), ",").alias("csv"))
    return per.select("e_uid", csv_union(F.col("csv")).alias("ids"))


@query("""select coalesce(a.k, b.k) as k, case when a.k is null then 'new' else 'gone' end as w from (select distinct o_custkey as k from orders where o_orderdate < timestamp '1996-01-01') a
full outer join (select distinct o_custkey as k from orders where o_orderdate >= timestamp '2001-01-01') b on a.k = b.k where a.k is null or b.k is null""")
def q_new_and_gone(spark: SparkSession, sf: str) -> DataFrame:
    orders = T(spark, sf, "orders").select(F.col("o_custkey").alias("k"), "o_orderdate")
    a, b = orders.filter("o_orderdate < '1996-01-01'").select("k").distinct(), orders.filter("o_orderdate >= '2001-01-01'").select("k").distinct()
    return b.join(a, "k", "left_anti").withColumn("w", F.lit("new")).unionByName(a.join(b, "k", "left_anti").withColumn("w", F.lit("gone")))
