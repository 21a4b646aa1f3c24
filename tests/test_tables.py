import pytest
from pyspark.sql import functions as F

from tidemark.operators import aggregates as agg
from tidemark.operators import canonical, cluster_diff, queues, ranking, regression, search, tables
from tidemark.functions.categories import WEAPON_FAMILY, WEAPON_PRIORITY, family


def rows(df, *order):
    return sorted(map(tuple, df.collect()), key=str)


def test_changes(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    new = spark.createDataFrame([(2, "x"), (2, "y"), (3, "z")], "k int, v string")
    assert rows(tables.upsert(old, new, ["k"], order="v")) == [(1, "a"), (2, "y"), (3, "z"), (None, "n")]
    assert {r["k"] for r in tables.insert_ignore(old, new, ["k"]).collect()} == {1, 2, 3, None}
    assert rows(tables.delete_keys(old, new, ["k"])) == [(1, "a"), (None, "n")]
    assert rows(tables.update_from(old, new.filter("v = 'x'"), ["k"], ["v"])) == [(1, "a"), (2, "x"), (None, "n")]
    assert rows(tables.refresh(old, new.limit(0), ["k"], new)) == [(1, "a"), (None, "n")]
    assert tables.ensure_columns(old, {"k": "bigint", "w": "string"}).dtypes == [("k", "bigint"), ("v", "string"), ("w", "string")]
    assert rows(tables.upsert(old.limit(0), new.limit(0), ["k"])) == []


def test_crosswalk_must_be_unique(spark):
    cross = spark.createDataFrame([("w", "A  b", 1), ("w", "a B", 2)], "domain string, raw_value string, group_code int")
    with pytest.raises(ValueError):
        tables.decode(spark.createDataFrame([("a b",)], "c string"), cross, "c", "w")


def test_modes(spark):
    guns = spark.createDataFrame([(1, w) for w in ["handgun"] * 2 + ["rifle"] * 2 + ["knife"] * 3] + [(2, None)], "k int, w string")
    assert rows(agg.grouped_mode(guns, ["k"], "w", family(F.col("w"), WEAPON_FAMILY), WEAPON_PRIORITY)) == [(1, "handgun")]
    rel = spark.createDataFrame([(1, r) for r in [None] * 5 + ["unknown relationship"] * 3 + ["friend"]] + [(2, None)], "k int, r string")
    assert rows(agg.specific_mode(rel, ["k"], "r")) == [(1, "friend"), (2, None)]
    ages = spark.createDataFrame([(1, a) for a in (20, 20, 30, 30, 40)], "k int, a int")
    assert rows(agg.mean_of_modes(ages, ["k"], "a")) == [(1, 25.0)]
    assert rows(agg.modal_value(ages, ["k"], "a")) == [(1, 20)]


def test_ranking(spark):
    df = spark.createDataFrame([(i, i // 2) for i in range(10)] + [(99, None)], "id int, v int")
    assert {r["id"] for r in ranking.top_with_ties(df, 3, "v").collect()} == {6, 7, 8, 9}
    assert {r["id"] for r in ranking.batch_whole_groups(df, 3, [F.col("id")], "v").collect()} == {0, 1, 2, 3}
    got = {r["id"]: r["n"] for r in ranking.numbered(spark.range(1000).select(F.col("id")), ["id"]).collect()}
    assert got == {i: i + 1 for i in range(1000)}
    assert ranking.numbered(spark.range(0), ["id"]).count() == 0


def test_cluster_diff(spark):
    make = lambda cs: spark.createDataFrame([(c, m) for c, ms in cs.items() for m in ms], "cluster_id string, member_id int")
    out = cluster_diff.diff_clusters(make({"A": [1, 2, 3], "B": [4], "C": [5, 6], "D": [8]}), make({"x": [1, 2], "y": [3], "z": [4, 7], "w": [5, 6], "v": [9]}))
    assert {(r["side"], r["cluster"]): r["kind"] for r in out.collect()} == {
        ("old", "A"): "split", ("old", "B"): "extended", ("old", "D"): "gone", ("new", "x"): "split", ("new", "y"): "split", ("new", "z"): "extended", ("new", "v"): "new",
    }


def test_overrides(spark):
    o = spark.createDataFrame([("o1", "e1", 1), ("o1", "e2", 2), ("o2", "e9", 1), ("o9", "e1", 1), ("o3", "e1", 1), ("o4", "e1", 1)], "orphan_id string, entity_id string, decided_at int")
    e = spark.createDataFrame([("e1",), ("e2",)], "entity_id string")
    orphans = spark.createDataFrame([("o1",), ("o2",), ("o3",), ("o4",)], "orphan_id string")
    machine = spark.createDataFrame([("o3", "e1"), ("o4", "e2")], "orphan_id string, entity_id string")
    out = canonical.apply_overrides(o, e, orphans, machine)
    assert {(r["orphan_id"], r["entity_id"]): r["status"] for r in out.collect()} == {
        ("o1", "e1"): "applied", ("o1", "e2"): "duplicate", ("o2", "e9"): "missing_entity", ("o9", "e1"): "missing_orphan", ("o3", "e1"): "already_matched", ("o4", "e1"): "conflict",
    }
    assert rows(canonical.merge_links(machine, out)) == [("o1", "e1", "manual"), ("o3", "e1", "machine"), ("o4", "e2", "machine")]


def test_queue_reasons(spark):
    current = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1"), ("d", "1"), ("e", "1")], "k string, m string")
    h = "c4ca4238a0b923820dcc509a6f75849b"
    done = spark.createDataFrame([("a", h, "pending", 1), ("c", "other", "done", 1), ("d", h, "done", 0), ("e", h, "done", 1)], "k string, set_hash string, status string, n_cached int")
    assert {r["k"]: r["reason"] for r in queues.work_queue(current, done, "k", "m").collect()} == {"a": "pending", "b": "new", "c": "changed", "d": "incomplete"}


def test_search(spark):
    docs = spark.createDataFrame([(1, "The judge, the JUDGE"), (2, "a verdict"), (3, None), (4, "")], "id int, t string")
    got = {r["id"]: r["score"] for r in search.bm25(docs, "id", "t", ["judge", "verdict"]).collect()}
    assert set(got) == {1, 2} and got[1] > got[2] * 0.5
    assert search.bm25(docs, "id", "t", ["judge", "verdict"], limit_share=0.2).count() == 1


def test_regression_against_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.normal(size=400)
    y = 1 + 2 * x + rng.normal(size=400)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for a, b, c in zip(x, y, rng.poisson(np.exp(0.2 + 0.5 * x)))], "x double, y double, n double")
    X = np.column_stack([np.ones(400), x])
    want = np.linalg.lstsq(X, y, rcond=None)[0]
    fit = regression.fit(df, F.col("y"), [("x", F.col("x"))])
    e = y - X @ want
    bread = np.linalg.inv(X.T @ X)
    se = np.sqrt(np.diag(bread @ (X.T * e**2) @ X @ bread) * 400 / 398)
    assert np.allclose(fit.coef, want) and np.allclose(fit.se, se)
    pois = regression.fit(df, F.col("n"), [("x", F.col("x"))], "poisson")
    assert abs(pois.coef[1] - 0.5) < 0.1
    prob = regression.fit(df, (F.col("y") > 1).cast("int"), [("x", F.col("x"))], "probit")
    assert abs(prob.coef[1] - 2) < 0.5
    m = {r["x"]: r["margin"] for r in regression.margins(df, fit, [("x", F.col("x"))], "x", [0.0, 1.0]).collect()}
    assert m[1.0] - m[0.0] == pytest.approx(fit.coef[1])
