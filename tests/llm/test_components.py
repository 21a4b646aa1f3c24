import random

from tidemark.llm.components import hash_to_min

SCHEMA = "l string, r string, x int"


def brute(rows):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for l, r, *_ in rows:
        if l is not None and r is not None and l != r:
            a, b = find(l), find(r)
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def run(spark, rows, **kw):
    got = hash_to_min(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA), "l", "r", **kw).collect()
    assert len(got) == len({r["id"] for r in got})
    return {r["id"]: r["cluster_id"] for r in got}


def test_random_graphs_chains_and_stars(spark):
    rng = random.Random(4)
    rows = [(f"n{rng.randrange(200):03d}", f"n{rng.randrange(200):03d}") for _ in range(170)]
    rows += [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(70)] + [("s000", f"s{i:03d}") for i in range(1, 60)]
    rows += [(b, a) for a, b in rows[:30]] + rows[:30] + [(None, "q"), ("q", None), ("q", "q")]
    want = brute(rows)
    assert run(spark, rows) == want
    assert run(spark, rows, hot_rows=10) == want  # hot sets are looked up by the other way


def test_nothing_to_link(spark):
    assert run(spark, []) == {} and run(spark, [("a", "a"), (None, None)]) == {}


def test_order_is_by_code_point(spark):
    assert run(spark, [("a", "B"), ("é", "z"), ("z", "Z")]) == {"a": "B", "B": "B", "é": "Z", "z": "Z", "Z": "Z"}
