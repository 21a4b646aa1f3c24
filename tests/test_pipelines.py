from pyspark.sql import functions as F

from tidemark.operators import comparisons, jobs
from tidemark.plans import pipelines
from tidemark.session import data_dir, read_table


def test_register_link_keeps_victims_known_to_the_year(spark, monkeypatch):
    seen = {}

    def run(job, left, right):
        seen.update(left=left, right=right)
        return jobs.Result(None, None, matches=left.select(F.col("unique_id").alias("id_l"), F.lit("").alias("id_r"), F.lit(1.0).alias("match_probability")))

    monkeypatch.setattr(pipelines.jobs, "run", run)
    pipelines.q_link_register(spark, data_dir())
    ids = {r[0] for r in seen["left"].select("unique_id").collect()}
    assert len(ids) == seen["left"].count()
    years = {r[0] for r in read_table(spark, data_dir(), "shr").select("Year").collect()}
    o = read_table(spark, data_dir(), "orphan_link_input").select("unique_id", "year", "date_precision").distinct().collect()
    by_year = {r["unique_id"] for r in o if r["date_precision"] == "year" and r["year"] in years}
    assert by_year and by_year <= ids


def test_shared_months(spark):
    make = lambda rows: spark.createDataFrame(rows, "unique_id string, year int, month int")
    left = make([("a", 1980, 1), ("b", 1980, 2), ("c", 1980, None), ("d", 1981, None), ("e", 1982, 5)])
    right = make([("s", 1980, 1), ("t", 1980, 7), ("u", 1982, None), ("v", 1983, 1), ("w", 1982, 6)])
    kept = [{r[0] for r in x.select("unique_id").collect()} for x in pipelines.in_shared_months(left, right)]
    assert kept == [{"a", "c", "e"}, {"s", "t", "u"}]


def test_unnamed_victims_meet_all_named_entities(spark, monkeypatch):
    seen = {}

    def run(job, left, right):
        seen.update(job=job, left=left, right=right)
        a, b = [r[0] for r in left.select("unique_id").orderBy("unique_id").limit(2).collect()]
        pairs = [(a, "x:0:0", 5.0, 0.97), (a, "x:0:1", 4.0, 0.94), (b, "x:0:0", 4.5, 0.96), (a, "y:0:0", -0.2, 0.47)]
        seen.update(a=a, b=b)
        return jobs.Result(None, spark.createDataFrame(pairs, "id_l string, id_r string, match_weight double, match_probability double"))

    whole = {t: read_table(spark, data_dir(), t) for t in ("entity_link_input", "orphan_link_input")}
    first = whole["entity_link_input"].select("unique_id", "article_ids_csv").orderBy("unique_id").first()
    made = whole["orphan_link_input"].limit(1)
    article = int(first["article_ids_csv"].split(",")[0])
    more = [made.withColumns({"unique_id": F.lit(i), "article_id": F.lit(a).cast("bigint")}) for i, a in (("x:0:0", 1), ("x:0:1", 1), ("y:0:0", article))]
    whole["orphan_link_input"] = whole["orphan_link_input"].unionByName(more[0]).unionByName(more[1]).unionByName(more[2])
    monkeypatch.setattr(pipelines, "T", lambda spark, sf, name: whole[name])
    monkeypatch.setattr(pipelines.jobs, "run", run)
    got = {tuple(r) for r in pipelines.q_link_unnamed_victims(spark, data_dir()).collect()}
    a, b = seen["a"], seen["b"]
    assert got == {(a, "x:0:1", 0.94), (b, "x:0:0", 0.96), (a, "y:0:0", 0.47)}
    for side, t in (("left", "entity_link_input"), ("right", "orphan_link_input")):
        assert seen[side].count() == whole[t].select("unique_id").distinct().count()
    assert seen["job"].rules == comparisons.orphan_rules() and {"offender", "place", "summary"} <= {c.name for c in seen["job"].comparisons}
    barred = {r[0]: r[1] for r in seen["right"].select("unique_id", "exclusion_ids").collect()}
    assert first["unique_id"] in barred["y:0:0"] and not barred["x:0:0"]


def test_unnamed_victims_find_the_entity_they_are(spark, monkeypatch):
    sf = data_dir("sf0.01")
    e, o = read_table(spark, sf, "entity_link_input"), read_table(spark, sf, "orphan_link_input")
    known = e.dropDuplicates(["unique_id"]).filter("date_precision = 'day' and lat is not null and victim_age is not null and victim_sex is not null")
    same = known.select(*[c for c in e.columns if c in o.columns]).withColumns({"unique_id": F.concat(F.lit("p:"), "unique_id"), "article_id": F.xxhash64("unique_id"), "weapon": F.lit(None).cast("string"), "victim_age": F.col("victim_age") + 1})
    tables = {"entity_link_input": e, "orphan_link_input": o.unionByName(same, allowMissingColumns=True)}
    monkeypatch.setattr(pipelines, "T", lambda spark, sf, name: tables[name])
    got = [(r["id_l"], r["id_r"]) for r in pipelines.q_link_unnamed_victims(spark, sf).collect()]
    right = sum(r == f"p:{l}" for l, r in got)
    assert right >= 0.9 * known.count() and right >= 0.9 * len(got)


def test_named_victims_are_united_by_the_whole_catalogue(spark):
    """Pairs within clusters against the entity each row belongs to."""
    sf = data_dir("sf0.01")
    entity = {r[0]: r[1] for r in read_table(spark, sf, "victim_entities").select("entity_row_id", "victim_entity_id").collect()}
    clusters: dict = {}
    for r in pipelines.q_dedupe_entities(spark, sf).collect():
        clusters.setdefault(r["cluster_id"], []).append(entity[r["member_id"]])
    together = lambda groups: sum(len(g) * (len(g) - 1) // 2 for g in groups)
    right = sum(together([[e] * members.count(e) for e in set(members)]) for members in clusters.values())
    named = [entity[r[0]] for r in pipelines.named_victims(spark, sf).select("unique_id").collect()]
    assert right >= 0.95 * together(clusters.values()) and right >= 0.95 * together([[e] * named.count(e) for e in set(named)])
