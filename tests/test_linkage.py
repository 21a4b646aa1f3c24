import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import assignment, blocking, clustering, jobs, linkage
from tidemark.operators.blocking import Rule
from tidemark.operators.linkage import Comparison, Level, Model, Training


def people(spark, n=200, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(i, int(rng.integers(5)), None if rng.random() < 0.1 else int(rng.integers(4)), float(rng.integers(50))) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id int, city int, sex int, day double")


def test_first_rule_wins_against_brute_force(spark):
    rows, df = people(spark)
    rules = [Rule("a", ("city", "sex"), "abs(l.day - r.day) <= 3"), Rule("b", ("city",), "l.day = r.day"), Rule("c", ("sex", "floor(day / 10)"))]
    got = {(r[0], r[1]): r[2] for r in blocking.block_pairs(df, None, "id", rules).select("l.id", "r.id", "rule").collect()}
    want = {}
    for x, y in itertools.combinations(rows, 2):
        sex = x[2] is not None and x[2] == y[2]
        if x[1] == y[1] and sex and abs(x[3] - y[3]) <= 3:
            want[x[0], y[0]] = "a"
        elif x[1] == y[1] and x[3] == y[3]:
            want[x[0], y[0]] = "b"
        elif sex and x[3] // 10 == y[3] // 10:
            want[x[0], y[0]] = "c"
    assert got == want


def test_link_only_and_bad_rules(spark):
    _, df = people(spark, 20)
    pairs = blocking.block_pairs(df, df, "id", [Rule("a", ("city",))])
    assert pairs.filter("l.id = r.id").count() == 20
    with pytest.raises(ValueError):
        blocking.block_pairs(df, None, "id", [Rule("all", ())])


def test_levels_are_three_valued(spark):
    c = Comparison("x", "l.a is null and r.a is null", (Level("same", "l.a = r.a"), Level("close", "abs(l.a - r.a) <= 1"), Level("else", "true")))
    rows = [((1,), (1,)), ((1,), (2,)), ((1,), (5,)), ((1,), (None,)), ((None,), (None,))]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, l struct<a: int>, r struct<a: int>")
    assert [r[0] for r in df.orderBy("i").select(c.gamma()).collect()] == [2, 1, 0, 0, -1]


def test_model_json_round_trip():
    m = Model(0.1, (Comparison("x", "false", (Level("same", "true", 0.9, 0.1), Level("else", "true", 0.1, 0.9))),), {"vectors": "v1"})
    assert Model.from_json(m.to_json()).comparisons == m.comparisons
    with pytest.raises(ValueError):
        Model.from_json(m.to_json(), {"vectors": "v2"})
    with pytest.raises(ValueError):
        Model.from_json('{"prior": 0.0}')


def test_em_recovers_known_probabilities(spark):
    rng = np.random.default_rng(5)
    rows, truth = [], {"m": (0.9, 0.8, 0.95), "u": (0.1, 0.3, 0.05)}
    for i in range(20_000):
        p = truth["m"] if rng.random() < 0.2 else truth["u"]
        rows.append((i, *[(1,) if rng.random() < q else (0,) for q in p]))
    df = spark.createDataFrame(rows, "i int, a struct<v: int>, b struct<v: int>, c struct<v: int>")
    pairs = df.select(F.struct(F.col("a.v").alias("a"), F.col("b.v").alias("b"), F.col("c.v").alias("c")).alias("l"), F.struct(F.lit(1).alias("a"), F.lit(1).alias("b"), F.lit(1).alias("c")).alias("r"))
    comps = tuple(Comparison(n, "false", (Level("same", f"l.{n} = r.{n}", 0.7, u), Level("else", "true", 0.3, 1 - u))) for n, u in zip("abc", truth["u"]))
    model, rounds = linkage.train_m(linkage.patterns(pairs, comps), Model(0.2, comps))
    assert rounds < 100
    assert [round(c.levels[0].m, 1) for c in model.comparisons] == [0.9, 0.8, 0.9] or all(abs(c.levels[0].m - m) < 0.04 for c, m in zip(model.comparisons, truth["m"]))


def two(name, column, m, u):
    return Comparison(name, f"l.{column} is null or r.{column} is null", (Level("same", f"l.{column} = r.{column}", m, u), Level("else", "true", 1 - m, 1 - u)))


def test_what_a_block_makes_equal_is_left_out():
    comps = (two("name", "name", 0.9, 0.1), two("city", "city", 0.9, 0.1), two("age", "age", 0.9, 0.1))
    assert linkage.columns_of(comps[0]) == {"name"}
    month = Training((Rule("a", ("city", "soundex(name)")),), ("age",))
    assert month.excluded(comps) == ("city", "age")
    assert Training((Rule("a", ("city", "name")), Rule("b", ("city", "age")))).excluded(comps) == ("city",)


def test_prior_inside_a_block_and_copied_ratio():
    c = Comparison("date", "false", (Level("day", "true", 0.5, 0.001), Level("month", "true", 0.3, 0.009), Level("else", "true", 0.2, 0.99)))
    m = Model(0.001, (c, two("sex", "sex", 0.95, 0.5)))
    odds = 0.001 / 0.999 * (0.8 / 0.01)
    assert linkage.block_prior(m, {"date": 2}) == pytest.approx(odds / (1 + odds))
    assert linkage.block_prior(m, {}) == pytest.approx(0.001)
    copied = linkage.copy_ratio(m, "date", 2, 1).comparisons[0]
    assert copied.level_of(1).m / copied.level_of(1).u == pytest.approx(500) and copied.level_of(1).m == 0.3


def test_outer_runs_stop_when_nothing_moves(spark):
    rng, rows = np.random.default_rng(6), []
    for _ in range(12_000):
        p = (0.9, 0.85, 0.8) if rng.random() < 0.3 else (0.1, 0.2, 0.3)
        rows.append(tuple(int(rng.random() < q) for q in p))
    df = spark.createDataFrame(rows, "a int, b int, c int")
    pairs = df.select(F.struct("a", "b", "c").alias("l"), F.struct(F.lit(1).alias("a"), F.lit(1).alias("b"), F.lit(1).alias("c")).alias("r"))
    comps = tuple(two(n, n, 0.7, u) for n, u in zip("abc", (0.1, 0.2, 0.3)))
    blocks = [(t, linkage.patterns(pairs, comps, t.excluded(comps))) for t in (Training((Rule("x", ("k",)),)), Training((Rule("y", ("k",)),), implied={"a": 1}))]
    model, moves = linkage.train_runs(blocks, Model(0.05, comps), most=8)
    assert len(moves) < 8 and moves[-1] < 0.002 < moves[0]
    assert [round(c.levels[0].m, 1) for c in model.comparisons] == [0.9, 0.8, 0.8] or max(abs(c.levels[0].m - m) for c, m in zip(model.comparisons, (0.9, 0.85, 0.8))) < 0.04
    assert model.prior == 0.05
    assert len(linkage.train_runs(blocks, Model(0.05, comps), most=1)[1]) == 1


def test_a_saved_model_scores_without_training(spark):
    model = Model(0.2, (two("x", "x", 0.9, 0.1),), {"tables": "t1"})
    job = jobs.Job("id", (), (Rule("k", ("k",)),), predict_threshold=0.0)
    ready = jobs.inference_only(job, model.to_json(), {"tables": "t1"})
    df = spark.createDataFrame([(1, "k", 5), (2, "k", 5), (3, "k", 6)], "id int, k string, x int")
    got = {(r["id_l"], r["id_r"]): r["match_probability"] for r in jobs.run(ready, df).pairs.collect()}
    assert got[1, 2] == pytest.approx(0.25 * 9 / (1 + 0.25 * 9), abs=1e-6) and got[1, 3] < 0.1
    with pytest.raises(ValueError):
        jobs.inference_only(job, model.to_json(), {"tables": "t2"})
    jobs.required_columns(df, ["id", "k"], "left")
    with pytest.raises(ValueError, match="left lacks z"):
        jobs.required_columns(df, ["id", "z"], "left")


def edges(spark, rows):
    return spark.createDataFrame(rows, "l string, r string, p double")


def test_components_against_union_find(spark):
    rng = np.random.default_rng(7)
    rows = [(f"n{a:03d}", f"n{b:03d}", 1.0) for a, b in rng.integers(0, 300, (250, 2))] + [(f"c{i:03d}", f"c{i + 1:03d}", 1.0) for i in range(100)] + [(None, "x", 1.0), ("x", "x", 1.0)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for l, r, _ in rows:
        if l and l != r:
            parent[max(find(l), find(r))] = min(find(l), find(r))
    got = {r["id"]: r["component"] for r in clustering.connected_components(edges(spark, rows), "l", "r").collect()}
    assert got == {x: find(x) for x in parent}
    assert clustering.connected_components(edges(spark, rows[:0]), "l", "r").count() == 0


def test_constrained_clusters(spark):
    e = edges(spark, [("a", "b", 0.9), ("c", "a", 0.8), ("c", "d", 0.7), ("d", "c", 0.6)])
    barred = spark.createDataFrame([("a", "1"), ("c", "1"), ("b", None)], "member_id string, exclusion_id string")
    out = clustering.constrained_clusters(e, "l", "r", "p", barred)
    assert sorted(map(tuple, out["clusters"].collect())) == [("a", "a", None, None), ("a", "b", "a", 0.9), ("c", "c", None, None), ("c", "d", "c", 0.7)]
    assert [tuple(r) for r in out["blocked"].collect()] == [("a", "c", 0.8, "1")]
    lists = {r["id"]: r["exclusion_ids"] for r in clustering.exclusion_lists(out["blocked"]).collect()}
    assert lists == {"a": ["c"], "c": ["a"]}


def test_provenance_is_breadth_first(spark):
    e = edges(spark, [("a", "b", 0.9), ("b", "c", 0.9), ("a", "d", 0.9), ("d", "c", 0.9)])
    got = {r["member_id"]: r["linked_from"] for r in clustering.constrained_clusters(e, "l", "r", "p")["clusters"].collect()}
    assert got == {"a": None, "b": "a", "d": "a", "c": "b"}  # d-c comes last and unites nothing


def test_an_edge_within_a_group_is_no_provenance(spark):
    e = edges(spark, [("1", "2", 0.9), ("2", "3", 0.8), ("1", "3", 0.7)])
    got = {r["member_id"]: (r["linked_from"], r["linked_prob"]) for r in clustering.constrained_clusters(e, "l", "r", "p")["clusters"].collect()}
    assert got == {"1": (None, None), "2": ("1", 0.9), "3": ("2", 0.8)}


@pytest.mark.parametrize("seed", range(12))
def test_full_assignment_matches_as_many_as_can_be(seed):
    from itertools import permutations

    rng = np.random.default_rng(100 + seed)
    w = rng.normal(-3, 4, (rng.integers(1, 5), rng.integers(1, 6)))
    w[rng.random(w.shape) < 0.3] = np.nan
    t = w if w.shape[0] <= w.shape[1] else w.T
    best = max((sum(~np.isnan(c)), np.nansum(c)) for p in permutations(range(t.shape[1]), t.shape[0]) for c in [np.array([t[i, j] for i, j in enumerate(p)])])
    picked = assignment.assign(w, full=True)
    got = [w[i, j] for i, j in picked]
    assert not np.isnan(got).any() and len(picked) == best[0] and sum(got) == pytest.approx(best[1])


@pytest.mark.parametrize("seed", range(12))
def test_assignment_is_optimal(seed):
    rng = np.random.default_rng(seed)
    w = rng.integers(-2, 9, (rng.integers(1, 6), rng.integers(1, 6))).astype(float)
    w[rng.random(w.shape) < 0.2] = np.nan
    picked = assignment.assign(w)
    assert len({i for i, _ in picked}) == len({j for _, j in picked}) == len(picked)
    assert sum(w[i, j] for i, j in picked) == assignment.brute_force(w)


def test_assignment_ties_are_lexicographic():
    assert assignment.assign(np.array([[1.0, 1.0], [1.0, 1.0]])) == [(0, 0), (1, 1)]


def test_one_to_one_and_greedy(spark):
    s = spark.createDataFrame([(1, "a", "x", 5.0), (1, "a", "y", 4.0), (1, "b", "x", 4.5), (2, "c", "z", 1.0), (2, None, "z", 9.0)], "g int, l string, r string, w double")
    assert sorted((x["l"], x["r"]) for x in assignment.match_one_to_one(s.filter("l is not null"), "l", "r", "w").collect()) == [("a", "y"), ("b", "x"), ("c", "z")]
    assert sorted((x["l"], x["r"]) for x in assignment.greedy_groups(s.filter("l is not null"), "g", "l", "r", "w").collect()) == [("a", "x"), ("c", "z")]


def test_near_values_meet_by_cells(spark):
    rows = [(i, 1, v) for i, v in enumerate([0.1, 0.3, 0.2, -0.2, 0.4, 1.0, 1.1, None, float("nan"), float("inf"), -1e300, 0.7, 0.9])]
    df = spark.createDataFrame(rows, "id int, g int, x double")
    where = "abs(l.x - r.x) <= 0.2"
    ids = lambda rule: {(a, b) for a, b in blocking.block_pairs(df, None, "id", [rule]).select("l.id", "r.id").collect()}
    got = ids(Rule("a", ("g",), where, near=("x", 0.2)))
    assert got == ids(Rule("a", ("g",), where)) and {(0, 1), (1, 2), (5, 6)} <= got
    both = blocking.block_pairs(df, df, "id", [Rule("a", ("g",), where, near=("x", 0.2))]).select("l.id", "r.id").collect()
    want = [(a[0], b[0]) for a in rows for b in rows if a[2] is not None and b[2] is not None and abs(a[2] - b[2]) <= 0.2]
    assert sorted(map(tuple, both)) == sorted(want)


def test_customer_blocks_are_cut_into_cells(spark):
    """Within a nation and segment, customers far apart in balance are not compared."""
    from tidemark.plans.linkage import CUSTOMER_RULES

    c = spark.range(4000).selectExpr("id as c_custkey", "1 as c_nationkey", "'A' as c_mktsegment", "cast(id * 5 as double) as c_acctbal")
    pairs = blocking.block_pairs(c, None, "c_custkey", CUSTOMER_RULES[:1])
    plan = pairs._jdf.queryExecution().executedPlan()
    assert pairs.count() == sum(min(50, 3999 - i) for i in range(4000))
    keys = next(line for line in plan.toString().splitlines() if "Join" in line)
    assert keys.count("_k2") >= 2, keys


def test_barred_pairs_are_dropped_within_the_join(spark):
    rows, df = people(spark, 120)
    rules = [Rule("a", ("city", "sex"), "abs(l.day - r.day) <= 3"), Rule("b", ("city",), "l.day <= r.day")]
    listed = [(5, i) for i in range(120)] + [(7, 9), (9, 7), (11, 10), (None, 3), (4, None), (500, 4)]  # 5 with everybody
    barred = spark.createDataFrame(listed, "x int, y int")
    got = blocking.block_pairs(df, None, "id", rules, barred=(barred, ("y", "x"))).select("l.id", "r.id", "rule")
    gone = {frozenset(p) for p in listed}
    want = {tuple(p) for p in blocking.block_pairs(df, None, "id", rules).select("l.id", "r.id", "rule").collect() if frozenset(p[:2]) not in gone}
    assert {tuple(p) for p in got.collect()} == want and got.count() == len(want)
    assert "LeftAnti" not in got._jdf.queryExecution().executedPlan().toString()
    two = blocking.block_pairs(df, df, "id", rules[:1], barred=(barred, ("x", "y"))).select("l.id", "r.id")
    every = blocking.block_pairs(df, df, "id", rules[:1]).select("l.id", "r.id")
    assert sorted(map(tuple, two.collect())) == sorted(tuple(p) for p in every.collect() if frozenset(p) not in gone)


@pytest.mark.parametrize("seed", range(40))
def test_assignment_without_the_matrix(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 8))
    m = int(rng.integers(n, 12))
    w = rng.integers(-2, 9, (n, m)).astype(float) if seed % 2 else rng.normal(1, 3, (n, m))
    w[rng.random(w.shape) < rng.random()] = np.nan
    gain = np.where(np.isnan(w), 0.0, np.maximum(w, 0.0))
    picked = assignment.assign_rows(lambda i, j: gain[np.ix_(i, j)], n, m, ahead=2)
    assert len({i for i, _ in picked}) == len({j for _, j in picked}) == len(picked)
    assert all(gain[i, j] > 0 for i, j in picked)
    assert sum(w[i, j] for i, j in picked) == pytest.approx(sum(w[i, j] for i, j in assignment.assign(w)))


def _near():
    def weigh(l, r):
        gap = np.abs(np.subtract.outer(l["v"].to_numpy(float), r["v"].to_numpy(float)))
        return np.where(gap <= 4, 3.5 - gap, np.nan)

    return weigh  # a function of its own, which workers get by value


@pytest.mark.parametrize("full", [False, True])
def test_matching_of_blocks_is_that_of_their_pairs(spark, full):
    rng = np.random.default_rng(8)
    side = lambda n: [(None if rng.random() < 0.05 else int(rng.integers(n)), None if rng.random() < 0.05 else int(rng.integers(4)), None if rng.random() < 0.1 else float(rng.integers(30))) for _ in range(n)]
    left, right = (spark.createDataFrame(side(n), "id long, g int, v double") for n in (60, 50))
    pairs = left.toDF("l", "g", "a").join(right.toDF("r", "g", "b"), "g").filter("abs(a - b) <= 4").selectExpr("g", "l", "r", "3.5 - abs(a - b) as w")
    want = [tuple(x) for x in assignment.match_groups(pairs, "g", "l", "r", "w", full).collect()]
    got = [tuple(x) for x in assignment.match_blocks(left, right, "g", "id", _near(), ("l", "r", "w"), full).collect()]
    assert len({x[:2] for x in got}) == len({(x[0], x[2]) for x in got}) == len(got) == len(want)
    assert {tuple(x) for x in pairs.collect()} >= set(got)
    for g in range(4):
        assert sum(x[3] for x in got if x[0] == g) == pytest.approx(sum(x[3] for x in want if x[0] == g))
    assert assignment.match_blocks(left.limit(0), right, "g", "id", _near(), ("l", "r", "w"), full).count() == 0


@pytest.mark.parametrize("name", ["q_max_weight_match", "q_match_within_groups"])
def test_matching_queries_make_no_pairs(spark, name):
    import __spark_entry__ as entry

    plan = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "FlatMapCoGroupsInPandas" in plan


def test_ties_of_blocks_go_to_smaller_ids(spark):
    both = spark.createDataFrame([(i, 1, 5.0) for i in range(6)], "id long, g int, v double")
    got = assignment.match_blocks(both.filter("id < 3"), both, "g", "id", _near(), ("l", "r", "w")).select("l", "r").collect()
    assert sorted(map(tuple, got)) == [(0, 0), (1, 1), (2, 2)]
