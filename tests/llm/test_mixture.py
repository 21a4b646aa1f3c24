import math

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm.killings import BLOCKS, GROUPS, MONTHS_AFTER, candidate_pairs, orphan_records, register_records
from tidemark.llm.mixture import Block, Component, Mixture, constrained, fit_and_score

AB = (Block(("a", "b")),)


def vectors(spark, n, m, seed=0, owners=None, chance=0):
    rng = np.random.default_rng(seed)
    hit = rng.normal(8, 2, (n, 2))
    miss = rng.normal(2, 2, (m + chance, 2))
    rows = [(i, f"r{i}", float(a), float(b) if i % 5 else None, 1, False) for i, (a, b) in enumerate(hit)]
    rows += [((i + n) if owners is None else i % owners, f"r{i + n}", float(a), float(b), 0, i >= m) for i, (a, b) in enumerate(miss)]
    return spark.createDataFrame(rows, "l bigint, r string, a double, b double, truth int, c boolean")


def test_separates_without_labels(spark):
    scored, m = fit_and_score(vectors(spark, 300, 1500), AB, "l")
    rows = scored.collect()
    assert np.mean([(r["posterior"] >= 0.5) == r["truth"] for r in rows]) > 0.95
    assert abs(m.matched[0].mean[0] - 8) < 1 and abs(m.unmatched[0].mean[0] - 2) < 1


def test_parameters_are_recovered(spark):
    """Pairs drawn from two Gaussians: the fit finds their means, covariances and share."""
    rng, n = np.random.default_rng(4), 4000
    cov = np.array([[3.0, 1.2], [1.2, 2.0]])
    hit, miss = rng.multivariate_normal([9, 7], cov, n // 4), rng.multivariate_normal([2, 1], np.eye(2) * 1.5, n - n // 4)
    near = np.concatenate([rng.normal(-0.2, 0.3, n // 4), rng.normal(-1.2, 0.5, n - n // 4)])
    rows = [(i, float(a), float(b), float(c)) for i, ((a, b), c) in enumerate(zip(np.vstack([hit, miss]), near))]
    df = spark.createDataFrame(rows, "l bigint, a double, b double, c double")
    _, m = fit_and_score(df, (Block(("a", "b"), ridge=0.01, keep=1.0), Block(("c",), ridge=0.0)), "l", tolerance=0.005)
    assert m.converged and m.rounds < 40 and m.moves[-1] < 0.005
    assert abs(m.share - 0.25) < 0.02
    assert np.allclose(m.matched[0].mean, [9, 7], atol=0.2) and np.allclose(m.matched[0].cov, cov, atol=0.4)
    assert np.allclose(m.unmatched[0].mean, [2, 1], atol=0.1) and np.allclose(m.unmatched[0].cov, np.eye(2) * 1.5, atol=0.2)
    assert abs(m.matched[1].mean[0] + 0.2) < 0.05 and abs(m.unmatched[1].cov[0, 0] - 0.25) < 0.03


def test_a_fit_that_stops_early_says_so(spark):
    _, m = fit_and_score(vectors(spark, 100, 300), AB, "l", rounds=1)
    assert not m.converged and m.rounds == 1


def test_chance_pairs_keep_a_pure_class_whole(spark):
    """Where nearly all pairs match, pairs known to be chance stop the mixture from splitting the matches in two."""
    scored, m = fit_and_score(vectors(spark, 1000, 60, 1, chance=60), AB, "l", chance="c")
    rows = scored.collect()
    assert len(rows) == 1060 and np.mean([(r["posterior"] >= 0.5) == r["truth"] for r in rows]) > 0.97
    assert abs(m.share - 1000 / 1060) < 0.02


def test_log_odds_is_the_gaussians(spark):
    ab = (Component(np.array([1.0, 2.0]), np.array([[2.0, 0.5], [0.5, 1.0]])), Component(np.zeros(2), np.eye(2)))
    c = (Component(np.array([0.5]), np.array([[0.2]])), Component(np.array([-1.0]), np.array([[0.7]])))
    m = Mixture((Block(("a", "b")), Block(("c",))), 0.3, [ab[0], c[0]], [ab[1], c[1]])
    df = spark.createDataFrame([(1.0, 2.0, None), (1.0, None, 0.1), (None, None, None)], "a double, b double, c double")
    got = [r[0] for r in df.select(m.log_odds()).collect()]

    def density(c, x, seen):
        cov, d = c.cov[np.ix_(seen, seen)], np.array(x)[seen] - c.mean[seen]
        return -0.5 * (d @ np.linalg.inv(cov) @ d + np.linalg.slogdet(cov)[1] + len(seen) * np.log(2 * np.pi))

    ratio = lambda pair, x, seen: density(pair[0], x, seen) - density(pair[1], x, seen)
    prior = np.log(0.3 / 0.7)
    assert np.allclose(got, [prior + ratio(ab, (1, 2), [0, 1]), prior + ratio(ab, (1, 0), [0]) + ratio(c, (0.1,), [0]), prior])


def test_one_owner_has_one_target(spark):
    df = spark.createDataFrame([(1, "x", 20.0), (1, "y", 20.0), (2, "z", 20.0), (3, "z", 1.0)], "l int, r string, o double")
    got = {(r["l"], r["r"]): r["p"] for r in df.withColumn("p", constrained(F.col("o"), "l", "r")).collect()}
    assert got[1, "x"] < 0.5 and got[1, "y"] < 0.5 and got[2, "z"] > 0.9 and abs(got[3, "z"] - 0.5) < 1e-9


def test_records_of_one_target_must_be_one_entity(spark):
    """A-R and B-R make A and B one: not if they are told apart (same incident) or differ in a known fact."""
    rows = [
        (1, "x", "i1", "m", 20.0), (2, "x", "i1", "m", 20.0),  # two victims of one incident
        (3, "y", "i2", "m", 20.0), (4, "y", "i3", "f", 20.0), (5, "y", "i4", None, 20.0),  # differ in a fact; the third says nothing
        (6, "z", "i5", "m", 20.0), (7, "z", "i6", "m", 20.0),  # the same victim in two incidents' articles
    ]
    df = spark.createDataFrame(rows, "l int, r string, i string, f string, o double")
    p = {r["l"]: r["p"] for r in df.withColumn("p", constrained(F.col("o"), "l", "r", "i", ("f",))).collect()}
    assert max(p[1], p[2], p[3], p[4]) < 0.5 and min(p[5], p[6], p[7]) > 0.9


def test_no_pairs(spark):
    scored, m = fit_and_score(vectors(spark, 0, 0), AB, "l", chance="c")
    assert scored.count() == 0 and m is None and "posterior" in scored.columns


def test_candidates_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    o, s = orphan_records(spark.read.parquet(f"{sf}/orphan_link_input.parquet")), register_records(spark.read.parquet(f"{sf}/shr.parquet"))
    s = s.withColumn("ym", F.when(F.col("r_id") % 9 != 0, F.col("ym")))  # some register rows know the year only
    pairs = candidate_pairs(o, s)
    rows = pairs.filter("not chance").collect()
    assert len(rows) == len({(r["l_id"], r["r_id"]) for r in rows})
    both = o.alias("o").crossJoin(s.alias("s"))
    after, year = F.col("s.ym") - F.col("o.ym"), F.floor((F.col("s.ym") - 1) / 12)
    when = (
        F.when(F.col("o.ym").isNotNull() & F.col("s.ym").isNotNull(), after.isin(*MONTHS_AFTER))
        .when(F.col("s.ym").isNotNull(), (year - F.col("o.year")).isin(0, 1))
        .when(F.col("o.ym").isNotNull(), (F.col("s.year") - F.floor((F.col("o.ym") - 1) / 12)).isin(0, 1))
        .otherwise((F.col("s.year") - F.col("o.year")).isin(0, 1))
    )
    ok = (F.col("o.town") == F.col("s.town")) & when & F.coalesce(F.abs(F.col("o.age") - F.col("s.age")) <= 3, F.lit(True))
    guns = ("firearm", "handgun", "rifle", "shotgun")
    a, b = F.col("o.weapon"), F.col("s.weapon")
    against = F.when(~((a == b) | (a.isin(*guns) & b.isin(*guns) & ((a == "firearm") | (b == "firearm")))), 1).otherwise(0)
    for c in ("race", "ethnicity", "relationship", "circumstance", "o_sex", "o_race", "o_ethnicity", "count", "o_count"):
        against = against + F.when(F.col(f"o.{c}") != F.col(f"s.{c}"), 1).otherwise(0)
    against = against + F.when(F.abs(F.col("o.o_age") - F.col("s.o_age")) > 3, 1).otherwise(0)
    want = {tuple(r) for r in both.filter(ok & (against < 2)).select("l_id", "r_id", against.cast("double"), (F.col("o.sex") == F.col("s.sex")).cast("double")).collect()}
    assert {(r["l_id"], r["r_id"], r["conflict"], r["sex"]) for r in rows} == want and want
    assert {f for b in BLOCKS for f in b.features} >= set(GROUPS) and all(f in pairs.columns for b in BLOCKS for f in b.features)
    months = {round(r["month"], 6) for r in rows if r["month"] is not None}
    assert months <= {0.0, -1.0, round(-math.sqrt(2), 6)}
    met_by_chance = pairs.filter("chance").count()
    assert met_by_chance < 3 * len(rows)
    assert candidate_pairs(o.limit(0), s).count() == 0 and candidate_pairs(o, s.limit(0)).count() == 0


def test_records_without_a_town_or_a_year(spark):
    sf = "/root/testdata/sf0.001"
    raw = spark.read.parquet(f"{sf}/orphan_link_input.parquet").limit(40)
    bare = raw.withColumns({"geo_address_norm": F.lit(None).cast("string"), "victim_sex": F.lit(None).cast("string")})
    o, s = orphan_records(bare), register_records(spark.read.parquet(f"{sf}/shr.parquet"))
    assert o.count() == raw.select("unique_id").distinct().count() and candidate_pairs(o, s).count() == 0
