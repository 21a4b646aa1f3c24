"""Queries of scalar functions: names, addresses, dates, text forms, JSON, vectors, distances."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import addresses, dates, names, text, values, vectors
from tidemark.functions.geo import haversine_km
from tidemark.functions.similarity import jaro_winkler
from tidemark.operators.spatial import points_in_regions
from tidemark.session import read_table as T
from tidemark.sources.files import explode_incidents

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn

    return add


_NAMES = r"""
with n as (select entity_row_id as id, nullif(trim(regexp_replace(regexp_replace(regexp_replace(trim(lower(regexp_replace(canonical_fullname, '[^A-Za-z''\- ]', ' ', 'g'))),
  '^(mr|mrs|ms|miss|dr|rev|ofc|officer)\s+', ''), '\s+(jr|sr|ii|iii|iv)$', ''), ' +', ' ', 'g')), '') as c from victim_entities),
p as (select id, c, contains(c, ' ') as sev, regexp_extract(c, '^[a-z] ([a-z''\-]+) ', 1) as bi, regexp_extract(c, '(^| )((de la|del|de|van|von|da|di|la|le|st) [a-z''\-]+)$', 2) as pt from n)
select id, case when sev then case when bi <> '' then bi else regexp_extract(c, '^([a-z''\-]+)', 1) end end as forename,
 coalesce(case when sev then case when pt <> '' then pt else regexp_extract(c, '([a-z''\-]+)$', 1) end end, c) as surname from p
"""


@query(_NAMES)
def q_name_parse(spark: SparkSession, sf: str) -> DataFrame:
    parts = names.name_parts(F.col("canonical_fullname"))
    return T(spark, sf, "victim_entities").select(F.col("entity_row_id").alias("id"), parts["forename"].alias("forename"), parts["surname"].alias("surname"))


@query()
def q_soundex_block(spark: SparkSession, sf: str) -> DataFrame:
    """How many entities share a surname's sound within a city (no Soundex in the other engine)."""
    rows = T(spark, sf, "entity_link_input").dropDuplicates(["unique_id"]).select("city_id", names.phonetic(names.name_parts(F.col("victim_fullname_norm"))["surname"]).alias("sound"))
    return rows.filter("sound is not null").groupBy("city_id", "sound").agg(F.count("*").alias("n"))



def _address_sql(text: str = "addr_raw") -> str:
    full = ", ".join(f"'{k}': '{v}'" for k, v in (addresses.STREET_TYPES | addresses.ORDINALS).items())
    types = ", ".join(f"'{t}'" for t in sorted({*addresses.STREET_TYPES, *addresses.STREET_TYPES.values(), "ST", "STREET", "WAY"}))
    blank = lambda i: rf"coalesce(regexp_matches(p[{i}], '^\s+$'), false)"
    digits = lambda i: rf"coalesce(regexp_matches(p[{i}], '^\d+$'), false)"
    street = lambda i: rf"coalesce(p[{i}] = 'STREET' or (p[{i}] = 'ST' and {i} > 1 and regexp_matches(p[{i} - 1], '\s$')), false)"
    half = lambda j: rf"coalesce({j} > 2 and p[{j}] = '1' and p[{j} + 1] = '/' and p[{j} + 2] = '2' and ({digits(f'{j} - 2')} or regexp_matches(p[{j} - 2], '^\\d+A$') and {j} = 3 or {j} = 5 and {digits('1')} and coalesce(p[2] = '-' and p[3] = 'A', false)) and {blank(f'{j} - 1')} and {blank(f'{j} + 3')} and regexp_matches(p[{j} + 4], '^\w') and {blank(f'{j} + 5')} and p[{j} + 6] in ({types}), false)"
    return rf"""with a as (select addr_id, regexp_extract_all(upper(replace(trim({text}), '.', '')), '\w+|\W+') as p, map {{{full}}} as m from mar_addr_map),
    b as (select addr_id, list_transform(p, lambda x, i: case
      when i = 1 and regexp_matches(x, '^\d+A$') then rtrim(x, 'A')
      when i in (2, 3) and {digits('1')} and coalesce(p[2] = '-' and p[3] = 'A', false) then ''
      when {half('i')} or {half('(i - 1)')} or {half('(i - 2)')} then ''
      when {street('i')} then 'STREET'
      when {digits('i')} and {blank('i + 1')} and {street('(i + 2)')} then cast(cast(x as bigint) as varchar) || case when (cast(x as bigint) // 10) % 10 = 1 then 'TH' else coalesce(['TH', 'ST', 'ND', 'RD'][cast(x as bigint) % 10 + 1], 'TH') end
      when x = 'BLOCK' and not ({blank('i + 1')} and coalesce(p[i + 2] = 'OF', false)) then 'BLOCK OF'
      else coalesce(m[x], x) end) as q from a)
    select addr_id, trim(regexp_replace(array_to_string(q, ''), '\s+', ' ', 'g')) as addr from b"""


@query(_address_sql())
def q_address_norm(spark: SparkSession, sf: str) -> DataFrame:
    return T(spark, sf, "mar_addr_map").select("addr_id", addresses.normal_address(F.col("addr_raw")).alias("addr"))


_RENAMED = " ".join(f"when '{k}' then '{v}'" for k, v in addresses.RENAMED.items())
_CITY = "case when addr_id % 3 = 0 then addr_raw || ', Washington, D.C.' when addr_id % 3 = 1 then 'Good Hope Rd' else addr_raw end"


_WITHOUT_CITY = f"regexp_replace({_CITY}, '{addresses.CAPITAL_TAIL}', '')"


@query(f"select addr_id, case addr {_RENAMED} else addr end as key from ({_address_sql(_WITHOUT_CITY)})")
def q_geocoder_keys(spark: SparkSession, sf: str) -> DataFrame:
    """What the capital's geocoder is asked: without the city, places renamed since."""
    a, k = F.col("addr_raw"), F.col("addr_id") % 3
    said = F.when(k == 0, F.concat(a, F.lit(", Washington, D.C."))).when(k == 1, "Good Hope Rd").otherwise(a)
    return T(spark, sf, "mar_addr_map").select("addr_id", addresses.geocoder_key(said).alias("key"))


@query(r"""with s as (select addr_id, trim(case addr_id % 3 when 0 then '90 New York Avenue, Jamaica' when 1 then 'East ' || addr_raw || ' IRT Subway Station at 5th, Bronx' else addr_raw end) as t from mar_addr_map),
h as (select addr_id, case when regexp_matches(t, '(?i)\b(queens|jamaica)\b') and regexp_matches(t, '(?i)\bnew york (avenue|boulevard)\b') then regexp_replace(t, '(?i)\bnew york (avenue|boulevard)\b', 'GUY R BREWER BOULEVARD', 'g') else t end as t from s),
b as (select addr_id, regexp_replace(t, '(?i)\b((subway|bmt|irt|ind)\s+)+(station\b)', '\3', 'g') as t from h)
select addr_id, regexp_replace(regexp_replace(t, '(?i)^(east|west)\s+', ''), '(?i)(\bstation\b)[^,]*,', '\1,', 'g') as name from b""")
def q_station_names(spark: SparkSession, sf: str) -> DataFrame:
    """Names as a place search wants them: streets renamed since, stations without system, direction and detail."""
    a, k = F.col("addr_raw"), F.col("addr_id") % 3
    said = F.when(k == 0, "90 New York Avenue, Jamaica").when(k == 1, F.concat(F.lit("East "), a, F.lit(" IRT Subway Station at 5th, Bronx"))).otherwise(a)
    return T(spark, sf, "mar_addr_map").select("addr_id", addresses.station_name(said).alias("name"))


_KIND = r"(STREET|AVENUE|ROAD|PLACE|PLAZA|TERRACE|BOULEVARD|PARKWAY|HIGHWAY|DRIVE|COURT|LANE|CIRCLE|WAY|SQUARE)( (NW|NE|SW|SE))?"


@query(rf"""with a as (select input_address, trim(upper(split_part(input_address, ',', 1))) as s, matched_address, address_type from mar_cache),
k as (select *, case when regexp_matches(s, '^[0-9]+(-[0-9]+)? (BLOCK|BLK) OF .+ {_KIND}$') then 'BLOCK' when regexp_matches(s, '^.+ {_KIND} (AND|&|AT) .+ {_KIND}$') then 'INTERSECTION'
 when regexp_matches(s, '^[0-9]+(-[0-9]+)? .+ {_KIND}$') then 'ADDRESS' when regexp_matches(s, '^.+ {_KIND}$') then 'STREET_ONLY' else 'UNRECOGNIZED' end as kind,
 case when not regexp_matches(upper(trim(input_address)), '^[0-9]+(ST|ND|RD|TH)\b') then nullif(regexp_extract(upper(trim(input_address)), '^([0-9]+(-[0-9]+)?)\b', 1), '') end as a,
 case when not regexp_matches(upper(trim(matched_address)), '^[0-9]+(ST|ND|RD|TH)\b') then nullif(regexp_extract(upper(trim(matched_address)), '^([0-9]+(-[0-9]+)?)\b', 1), '') end as b from a)
select input_address, kind, case when trim(matched_address) <> '' and a is not null and b is not null and a <> b then 'house_number_changed' when trim(matched_address) <> '' and a is not null and b is null and address_type = 'ADDRESS' then 'house_number_missing'
 when trim(matched_address) <> '' and a is not null and address_type in ('STREET_ONLY', 'INTERSECTION', 'NAMED_PLACE') then 'input_type_changed' end as review from k""")
def q_address_class(spark: SparkSession, sf: str) -> DataFrame:
    return T(spark, sf, "mar_cache").select(
        "input_address", addresses.address_kind(F.col("input_address")).alias("kind"), addresses.review_code(F.col("input_address"), F.col("matched_address"), F.col("address_type")).alias("review"),
    )


@query(r"""with s as (select input_address, split_part(split_part(upper(matched_address), ',', 1), ' AND ', 1) as f, split_part(split_part(upper(matched_address), ',', 1), ' AND ', 2) as x, upper(matched_address) as m from mar_cache)
select input_address, nullif(trim(regexp_replace(regexp_replace(f, '^[0-9]+(-[0-9]+)? ', ''), '^BLOCK OF ', '')), '') as street, nullif(trim(x), '') as cross_street, nullif(trim(regexp_extract(m, ',([^,]*)$', 1)), '') as locality from s""")
def q_geocoded_view(spark: SparkSession, sf: str) -> DataFrame:
    m = F.col("matched_address")
    return T(spark, sf, "mar_cache").select("input_address", addresses.short_street(m).alias("street"), addresses.cross_street(m).alias("cross_street"), addresses.locality(m).alias("locality"))


@query(r"""with d as (select distinct unique_id, year, case when month between 1 and 12 then month end as m, case when day between 1 and 31 then day end as d from orphan_link_input),
k as (select *, case when year is null then null when m is null then 'year' when d is null then 'month' else 'day' end as p from d),
s as (select unique_id, p, case p when 'day' then try_cast(printf('%04d-%02d-%02d', year, m, d) as date) when 'month' then try_cast(printf('%04d-%02d-01', year, m) as date) when 'year' then try_cast(printf('%04d-01-01', year) as date) end as a,
 case p when 'day' then try_cast(printf('%04d-%02d-%02d', year, m, d) as date) when 'month' then last_day(try_cast(printf('%04d-%02d-01', year, m) as date)) when 'year' then try_cast(printf('%04d-12-31', year) as date) end as b from k)
select unique_id, p, date_diff('day', date '1970-01-01', a) as first, date_diff('day', date '1970-01-01', b) as last, floor((date_diff('day', date '1970-01-01', a) + date_diff('day', date '1970-01-01', b)) / 2) as mid from s""")
def q_event_spans(spark: SparkSession, sf: str) -> DataFrame:
    y, m, d = F.col("year"), F.col("month"), F.col("day")
    first, last, mid = dates.event_span(y, m, d)
    return T(spark, sf, "orphan_link_input").select("unique_id", "year", "month", "day").distinct().select("unique_id", dates.precision(y, m, d).alias("p"), first.alias("first"), last.alias("last"), mid.alias("mid"))


@query("""with r as (select "index" as id, YearMonth as ym, dense_rank() over (partition by YearMonth order by Incident) as k, count(*) over (partition by YearMonth) as n, strptime(YearMonth || '-01', '%Y-%m-%d') as d from shr)
select id, round(date_diff('day', date '1970-01-01', cast(d as date)) - 1 + k * day(last_day(d)) / n) as mid from r""")
def q_register_midpoint(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("YearMonth")
    rank, n = F.dense_rank().over(w.orderBy(F.asc_nulls_last("Incident"))), F.count("*").over(w)
    return T(spark, sf, "shr").select(F.col("index").alias("id"), dates.spread_in_month(F.col("YearMonth"), rank, n).alias("mid"))


@query("""select doc_id, nullif(trim(regexp_replace(regexp_replace(title, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]', '', 'g'), '\\s+', ' ', 'g')), '') as t, case when regexp_matches(pub_date, '^\\d{8}$') then strftime(try_strptime(pub_date, '%Y%m%d'), '%B %d, %Y') end as d,
lower(regexp_replace(replace(initcap_, ' ', ''), '([a-z0-9])([A-Z])', '\\1_\\2', 'g')) as s from (select *, title as initcap_ from documents)""")
def q_summary_norm(spark: SparkSession, sf: str) -> DataFrame:
    d = F.when(F.col("pub_date").rlike(r"^\d{8}$"), text.long_date(F.col("pub_date")))
    return T(spark, sf, "documents").select("doc_id", text.summary_norm(F.col("title")).alias("t"), d.alias("d"), text.snake_case(F.replace(F.col("title"), F.lit(" "), F.lit(""))).alias("s"))


def _homicide_sql() -> str:
    word = lambda roots: "(" + "|".join("[ \\t\\n\\f\\r]?".join(r) for r in roots) + ")"
    either = rf"(?i)\b(?:{word(text.CONDITIONAL_ROOTS)}|(?:{word(text.DEATH_ROOTS)[1:-1]}))\w*"
    return rf"""with k as (select doc_id, text, list_transform(regexp_extract_all(text, '{either}', 1), lambda w: coalesce(w, '') <> '') as c, regexp_split_to_array(text, '{either}') as g from documents),
    n as (select *, len(list_filter(range(1, len(c)), lambda i: c[i] <> c[i + 1] and len(g[i + 1]) <= {text.ROOT_DISTANCE} and not contains(g[i + 1], chr(10)))) > 0 as near from k)
    select doc_id, case when not (regexp_matches(text, '(?i)\b{word(text.ABSOLUTE_ROOTS)}') or near) then 'N' when not regexp_matches(text, '\b(Fenminster|Gloudown|Frodmore|Whitfield|Radchurch)\b') then 'O' else 'M' end as class from n"""


@query(_homicide_sql())
def q_classify_text(spark: SparkSession, sf: str) -> DataFrame:
    place = F.col("text").rlike(r"(?<![A-Za-z0-9_])(?:Fenminster|Gloudown|Frodmore|Whitfield|Radchurch)(?![A-Za-z0-9_])")
    return T(spark, sf, "documents").select("doc_id", F.when(~text.mentions_homicide(F.col("text")), "N").when(~place, "O").otherwise("M").alias("class"))


@query(r"""select doc_id, list_sort(list_distinct(regexp_extract_all(lower(text), '\b(police|judge|detective|court)\b', 1))) as words from documents""")
def q_keywords(spark: SparkSession, sf: str) -> DataFrame:
    return T(spark, sf, "documents").select("doc_id", text.keywords(F.col("text"), ("police", "judge", "detective", "court")).alias("words"))


@query(r"""select doc_id, regexp_replace(title, '[aeiou]', '*') as first_only, regexp_replace(title, '[aeiou]', '*', 'g') as every, rtrim(title, 'ds,. ') as clipped from documents""")
def q_replace_forms(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("title")
    return T(spark, sf, "documents").select("doc_id", text.replace_first(t, "[aeiou]", "*").alias("first_only"), F.regexp_replace(t, "[aeiou]", "*").alias("every"), text.clip(t, "ds,. ").alias("clipped"))


@query("""select p_partkey, cast(round(try_cast(x as double)) as integer) as r, log2(p / (1 - p)) as odds, greatest(p_size, 10) as g, least(cast(nullif(p_size, 1) as integer), 20) as l
from (select p_partkey, p_size, case when p_partkey % 7 = 0 then 'n/a' else cast(p_retailprice as varchar) end as x, p_size / 51.0::double as p from part)""")
def q_casts_and_odds(spark: SparkSession, sf: str) -> DataFrame:
    x = F.when(F.col("p_partkey") % 7 == 0, "n/a").otherwise(F.col("p_retailprice").cast("string"))
    return T(spark, sf, "part").select(
        "p_partkey", values.to_int(x).alias("r"), values.log2_odds(F.col("p_size") / F.lit(51.0)).alias("odds"), F.greatest("p_size", F.lit(10)).alias("g"), F.least(F.nullif(F.col("p_size"), F.lit(1)), F.lit(20)).alias("l"),
    )


@query("""with a as (select user_id, to_json(list({'t': event_type, 'v': cast(value as varchar)} order by event_id)) as js from events group by 1),
e as (select user_id, unnest(json_extract(js, '$[*]')) as j from a)
select user_id, json_extract_string(j, '$.t') as t, count(*) as n, count_if(cast(json_extract_string(j, '$.v') as double) > 50) as high from e group by all""")
def q_json_explode(spark: SparkSession, sf: str) -> DataFrame:
    item = F.struct("event_id", F.struct(F.col("event_type").alias("t"), F.col("value").cast("string").alias("v")).alias("s"))
    arrays = T(spark, sf, "events").groupBy("user_id").agg(F.to_json(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["s"])).alias("js"))
    cells = arrays.select("user_id", F.explode(F.from_json("js", "array<struct<t: string, v: string>>")).alias("j"))
    return cells.groupBy("user_id", F.col("j.t").alias("t")).agg(F.count("*").alias("n"), F.count_if(F.col("j.v").cast("double") > 50).alias("high"))


@query("select event_id, try_cast(json_extract_string(props, '$.k') as bigint) as k, sha256(props) as h, md5(props) as m from events")
def q_json_fields_and_hashes(spark: SparkSession, sf: str) -> DataFrame:
    return T(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"), F.sha2("props", 256).alias("h"), F.md5("props").alias("m"))


@query("""with o as (select article_id, unique_id, any_value(victim_age) as a, any_value(victim_sex) as s, any_value(relationship) as r from orphan_link_input group by all),
n as (select *, row_number() over (partition by article_id order by unique_id) - 1 as i from o where article_id % 50 <> 0)
select article_id || ':' || i || ':0' as victim_row_id, cast(a as integer) as victim_age, s as victim_sex, r as relationship from n""")
def q_incident_staging(spark: SparkSession, sf: str) -> DataFrame:
    """Nested JSON built from orphan records, in the order of their ids, exploded back to victims (malformed JSON is an empty list)."""
    o = T(spark, sf, "orphan_link_input").dropDuplicates(["unique_id"])
    victim = F.struct(F.lit(None).cast("string").alias("victim_name"), F.col("victim_age").cast("string").alias("victim_age"), "victim_sex", "victim_race", "relationship")
    incident = F.struct(F.col("year").cast("string").alias("year"), "weapon", F.array(victim).alias("victim"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("unique_id", incident.alias("i")))), lambda x: x["i"])
    js = o.groupBy("article_id").agg(F.to_json(ordered).alias("js"))
    broken = js.withColumn("js", F.when(F.col("article_id") % 50 == 0, "[{").otherwise(F.col("js")))
    _, victims = explode_incidents(broken, "article_id", "js")
    return victims.select("victim_row_id", values.to_int(F.col("victim_age")).alias("victim_age"), "victim_sex", "relationship")


@query("""select a.vec_id as a, b.vec_id as b, round(list_cosine_similarity(a.e, b.e), 6) as cosine from (select vec_id, cast(embedding as double[]) as e, label from embeddings) a join (select vec_id, cast(embedding as double[]) as e, label from embeddings) b on a.label = b.label and a.vec_id < b.vec_id""")
def q_cosine_pairs(spark: SparkSession, sf: str) -> DataFrame:
    e = T(spark, sf, "embeddings").select("vec_id", "embedding", "label")
    a, b = e.toDF("a", "va", "label"), e.toDF("b", "vb", "label")
    return a.join(b, "label").filter("a < b").select("a", "b", F.round(vectors.cosine(F.col("va"), F.col("vb")), 6).alias("cosine"))


@query("""with a as (select vec_id, cast(embedding as double[]) as e from embeddings where vec_id % 100 = 0), b as (select vec_id, cast(embedding as double[]) as e from embeddings),
s as (select a.vec_id as a, b.vec_id as b, round(list_cosine_similarity(a.e, b.e), 6) as c from a, b where a.vec_id <> b.vec_id)
select a, b, c from (select *, rank() over (partition by a order by c desc) as r from s) where r <= 10""")
def q_cosine_topk_ties(spark: SparkSession, sf: str) -> DataFrame:
    """For each vector whose id is divisible by 100, the ten most similar of all, with ties. The asking vectors are a
    hundredth of the table; they meet it in blocks of at most about 50,000, each small enough to go to every task."""
    e = T(spark, sf, "embeddings").select("vec_id", "embedding")
    asking = e.filter("vec_id % 100 = 0").toDF("a", "va")
    blocks = max(1, -(-asking.count() // 50_000))
    met = [e.toDF("b", "vb").crossJoin(F.broadcast(asking.filter(F.pmod(F.xxhash64("a"), F.lit(blocks)) == k))).filter("a != b") for k in range(blocks)]
    scored = reduce(DataFrame.unionByName, met).select("a", "b", F.round(vectors.cosine(F.col("va"), F.col("vb")), 6).alias("c"))
    from tidemark.operators.ranking import top_with_ties

    return top_with_ties(scored, 10, "c", ["a"])


@query("""with c as (select label, pos, avg(cast(v as double)) as x from (select label, unnest(embedding) as v, generate_subscripts(embedding, 1) as pos from embeddings) group by all)
select label, list(round(x, 6) order by pos) as embedding, (select count(*) from embeddings e where e.label = c.label) as n from c group by label""")
def q_vector_mean(spark: SparkSession, sf: str) -> DataFrame:
    mean = vectors.vector_mean(T(spark, sf, "embeddings"), "label", "embedding")
    return mean.select("label", F.transform("embedding", lambda x: F.round(x, 6)).alias("embedding"), "n")


@query("""select a.s_suppkey as l, b.s_suppkey as r, round(jaro_winkler_similarity(a.n, b.n), 6) as jw from (select s_suppkey, s_nationkey, substr(md5(s_name), 1, 8) as n from supplier) a join (select s_suppkey, s_nationkey, substr(md5(s_name), 1, 8) as n from supplier) b on a.s_nationkey = b.s_nationkey and a.s_suppkey < b.s_suppkey""")
def q_jaro_winkler(spark: SparkSession, sf: str) -> DataFrame:
    s = T(spark, sf, "supplier").select("s_suppkey", "s_nationkey", F.substring(F.md5("s_name"), 1, 8).alias("n"))
    a, b = s.toDF("l", "k", "x"), s.toDF("r", "k", "y")
    return a.join(b, "k").filter("l < r").select("l", "r", F.round(jaro_winkler("x", "y"), 6).alias("jw"))


@query("""select a.input_address as a, b.input_address as b, round(2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin(radians(b.y_lat - a.y_lat) / 2), 2) + cos(radians(a.y_lat)) * cos(radians(b.y_lat)) * pow(sin(radians(b.x_lon - a.x_lon) / 2), 2)))), 6) as km
from nyc_borough_cache a join nyc_borough_cache b on a.borough = b.borough and a.geometry_version = b.geometry_version and a.input_address < b.input_address where a.status = 'boundary'""")
def q_haversine(spark: SparkSession, sf: str) -> DataFrame:
    c = T(spark, sf, "nyc_borough_cache").select("input_address", "y_lat", "x_lon", "borough", "geometry_version", "status")
    a, b = c.toDF("a", "ay", "ax", "borough", "v", "s"), c.drop("status").toDF("b", "by", "bx", "borough", "v")
    met = a.filter("s = 'boundary'").join(b, ["borough", "v"]).filter("a < b")
    return met.select("a", "b", F.round(haversine_km(F.col("ay"), F.col("ax"), F.col("by"), F.col("bx")), 6).alias("km"))


@query("""select distinct unique_id, case when lat is null or lon is null or not (lat between -90 and 90 and lon between -180 and 180) or (lat = 0 and lon = 0) then 'missing_coordinates'
when lat > 43.1 and lat < 43.2 and lon > -75.1 and lon < -74.9 then 'matched' when lat between 43.1 and 43.2 and lon between -75.1 and -74.9 then 'boundary' else 'outside' end as status from orphan_link_input""")
def q_point_in_region(spark: SparkSession, sf: str) -> DataFrame:
    ring = [(-75.1, 43.1), (-74.9, 43.1), (-74.9, 43.2), (-75.1, 43.2)]
    regions = spark.createDataFrame([("centre", ring)], "region string, ring array<struct<lon: double, lat: double>>")
    return points_in_regions(T(spark, sf, "orphan_link_input").select("unique_id", "lat", "lon"), regions, "unique_id").select("unique_id", "status")


@query("select unique_id, nullif(victim_age, 999) as age, cast(floor(victim_age / 5) * 5 as integer) as bucket, nullif(lat, 0) as lat from (select distinct unique_id, victim_age, lat from orphan_link_input)")
def q_buckets_and_nulls(spark: SparkSession, sf: str) -> DataFrame:
    rows = T(spark, sf, "orphan_link_input").select("unique_id", "victim_age", "lat").distinct()
    return rows.select("unique_id", values.without(F.col("victim_age"), [999]).alias("age"), names.age_bucket(F.col("victim_age")).alias("bucket"), F.nullif(F.col("lat"), F.lit(0.0)).alias("lat"))


@query("""with t as (select doc_id, case doc_id % 4 when 0 then strftime(d, '%B %d, %Y') when 1 then strftime(d, '%B %Y') when 2 then strftime(d, '%Y') else 'unknown' end as s, d, doc_id % 4 as k
from (select doc_id, try_strptime(pub_date, '%Y%m%d') as d from documents where regexp_matches(pub_date, '^\\d{8}$')) where d is not null)
select doc_id, case when k < 3 then cast(year(d) as integer) end as y, case when k < 2 then cast(month(d) as integer) end as m, case when k = 0 then cast(day(d) as integer) end as d from t""")
def q_text_dates(spark: SparkSession, sf: str) -> DataFrame:
    docs = T(spark, sf, "documents").filter(F.col("pub_date").rlike(r"^\d{8}$")).withColumn("d", F.try_to_date("pub_date", "yyyyMMdd")).filter("d is not null")
    k = F.col("doc_id") % 4
    s = F.when(k == 0, F.date_format("d", "MMMM dd, yyyy")).when(k == 1, F.date_format("d", "MMMM yyyy")).when(k == 2, F.date_format("d", "yyyy")).otherwise("unknown")
    y, m, d = dates.text_date(F.col("s"))
    return docs.withColumn("s", s).select("doc_id", y.alias("y"), m.alias("m"), d.alias("d"))
