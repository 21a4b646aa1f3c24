from pyspark.sql import functions as F

from tidemark.functions import outcomes
from tidemark.operators import candidates, canonical, search


def test_score_merge_gate(spark):
    df = spark.createDataFrame([("m", "m", 0.5, 10.0), ("m", None, None, 0.0)], "a string, b string, cos double, gap double")
    got = [round(r[0], 6) for r in df.select(candidates.score([F.col("a") == F.col("b")], F.col("cos"), F.col("gap"))).collect()]
    assert got == [round(1.2 + 0.8 + 0.85 - 0.1, 6), 1.2]
    rows = spark.createDataFrame(
        [("g", "e1", "x", 3.0, None, "v1", "r2"), ("g", "e1", "x", 3.0, 0.5, "v2", "r1"), ("g", "e1", "x", 1.0, 0.9, "v1", "r3"), ("g", "e2", "y", 2.0, None, "v1", "r1")],
        "g string, e string, anchor string, score double, weight double, variant string, record string",
    )
    merged = {r["e"]: r for r in candidates.merge(rows, ["g", "e", "anchor"]).collect()}
    assert (merged["e1"]["score"], merged["e1"]["record"], merged["e1"]["weight"], merged["e1"]["variants"]) == (3.0, "r1", 0.9, ["v1", "v2"])
    assert merged["e2"]["weight"] is None
    many = spark.createDataFrame([("g", f"e{i:02d}", "a" if i < 18 else "b", float(20 - min(i, 5)), 1.0 if i == 17 else 0.0 if i < 19 else None) for i in range(20)], "g string, e string, anchor string, score double, weight double")
    kept = {r["e"] for r in candidates.gate(many, ["g"], "anchor", top=2, per_anchor=1).collect()}
    # e00, e01 by score; e17 by weight, with the ties of the second weight (all zeros); b's first by score is tied, by weight e18.
    assert {"e00", "e01", "e17", "e18", "e19"} <= kept
    assert candidates.gate(many.limit(0), ["g"], "anchor").count() == 0


def test_outcomes(spark):
    df = spark.createDataFrame([("none", None), ("inside", None), ("inside", "military"), ("inside", "other"), ("x", None), (None, None)], "o string, k string")
    assert [r[0] for r in df.select(outcomes.answer_code(F.col("o"), F.col("k"))).collect()] == ["N_NOHOM", "ERR_M_NONE", "N_MIL", "M_PRELIM", "ERR_OTHER", "ERR_OTHER"]
    years = spark.createDataFrame([([],), (None,), ([1970, None],), ([1970, 1980],)], "y array<int>")
    assert [r[0] for r in years.select(outcomes.extract_code(F.col("y"), 1977)).collect()] == ["N_NOINC", "N_NOINC", "E", "M"]


def test_index_ranks_as_the_texts_do_and_follows_changes(spark):
    docs = spark.createDataFrame([(1, "a judge and a judge"), (2, "the verdict"), (3, None), (4, "nothing here")], "id int, text string")
    direct = {r["id"]: r["score"] for r in search.bm25(docs, "id", "text", ["judge", "verdict"]).collect()}
    index = search.postings(docs, "id", "text")
    stored = {r["id"]: r["score"] for r in search.bm25_postings(index, "id", ["Judge", "verdict"], 4, 9 / 4).collect()}
    assert set(direct) == set(stored) == {1, 2} and all(abs(direct[i] - stored[i]) < 1e-9 for i in direct)
    phrases = {r["id"]: r["score"] for r in search.bm25_phrases(docs, "id", "text", ["a judge", "the verdict"]).collect()}
    assert set(phrases) == {1, 2}
    new = search.refresh_postings(index, docs.filter("id = 2").withColumn("text", F.lit("a judge")), docs.filter("id = 4").select("id"), "id", "text")
    assert {tuple(r) for r in new.select("id", "term").collect()} == {(1, "a"), (1, "judge"), (1, "and"), (2, "a"), (2, "judge")}


def test_member_union(spark):
    two = lambda rows: spark.createDataFrame(rows, "entity_id string, member_id string")
    clusters = spark.createDataFrame([("k", "o3"), ("k", "o2"), ("lone", "o9")], "cluster_id string, member_id string")
    got = {tuple(r) for r in canonical.member_union(two([("e", "v1"), ("e", "v1")]), two([("e", "o1")]), clusters, spark.createDataFrame([("o5",)], "member_id string")).collect()}
    assert got == {("e", "v1", "named"), ("e", "o1", "matched"), ("o2", "o2", "cluster"), ("o2", "o3", "cluster"), ("o5", "o5", "single")}
