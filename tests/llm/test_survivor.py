import itertools
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.llm.survivor import RACES, SEXES, field_sources, survivors, usable_code, usable_date, usable_name

SCHEMA = "g string, id bigint, t int, r timestamp, a string, b string, nc string"


def fields():
    return {"a": F.col("a").isNotNull(), "b": F.col("b").isNotNull()}


def brute(rows):
    out = {}
    for g, rs in itertools.groupby(sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]), key=lambda r: r[0]):
        rs = list(rs)
        if len({r[1] for r in rs}) < 2:
            continue
        for i, f in ((4, "a"), (5, "b")):
            ok = [r for r in rs if r[i] is not None]
            if ok:
                best = min(ok, key=lambda r: (float("inf") if r[2] is None else r[2], -(r[3] or datetime(1, 1, 2)).timestamp() if r[3] else 9e18, r[1]))
                out[g, f] = best[1]
    return out


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    got = field_sources(df, "g", fields(), "id", "t", "r").collect()
    assert len(got) == len({(r["g"], r["field_name"]) for r in got})
    return {(r["g"], r["field_name"]): r["id"] for r in got}


def test_against_brute_force(spark):
    rng = random.Random(1)
    day = datetime(2001, 1, 1)
    rows = [(rng.choice("abcde") if rng.random() < 0.95 else None, i, rng.choice([1, 2, 3, None]), rng.choice([None, day, day + timedelta(rng.randrange(4))]), rng.choice([None, "x"]), rng.choice([None, None, "y"])) for i in range(120)]
    rows += rows[:10] + [("single", 900, 1, day, "x", "y"), ("none", 901, 1, day, None, None), ("none", 902, 2, day, None, "y")]
    assert run(spark, rows) == brute(rows)


def test_empty_and_repeated(spark):
    assert run(spark, []) == {}
    assert run(spark, [("g", 1, 1, None, "x", None), ("g", 1, 1, None, "x", None)]) == {}


def test_hot_group(spark):
    df = spark.range(30_000).selectExpr("'g' as g", "id", "cast(id % 5 as int) as t", "timestamp_seconds(id % 1000) as r", "if(id % 7 = 0, 'x', null) as a", "cast(null as string) as b")
    got = [tuple(r) for r in field_sources(df, "g", fields(), "id", "t", "r").select("field_name", "id").collect()]
    want = min((i for i in range(30_000) if i % 5 == 0 and i % 7 == 0), key=lambda i: (-(i % 1000), i))
    assert got == [("a", want)]


def test_layers(spark):
    day = datetime(2001, 1, 1)
    rows = [("g", 1, 1, day, "x", None), ("g", 2, 2, day, None, "y"), ("g", 3, 1, day + timedelta(1), "x", None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    sources = lambda df, how: {r["field_name"]: (r["id"], r["layer"]) for r in field_sources(df, "g", fields(), "id", "t", "r", completeness=how).collect()}
    assert sources(df, "fields") == {"a": (3, 1), "b": (2, 1)}  # nobody who dominates row 2 has b
    assert sources(df, "count") == {"a": (3, 1), "b": (2, 2)}
    for how in ("fields", "count"):
        whole = survivors(df.drop("nc"), "g", fields(), "id", "t", "r", how).first()
        assert (whole["a"], whole["a_row"], whole["b"], whole["b_row"]) == ("x", 3, "y", 2)
    # By count the row with b pushes the trusted a into the second layer, and a less trusted but newer a is first.
    rows = [("g", 1, 2, day, "x", None), ("g", 2, 1, day + timedelta(1), None, "y"), ("g", 3, 3, day + timedelta(2), "z", None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    assert sources(df, "fields") == {"a": (1, 1), "b": (2, 1)} and sources(df, "count") == {"a": (3, 1), "b": (2, 1)}


def layers_by_peeling(rows, complete):
    """Layer of each row by taking off the undominated ones, again and again."""
    key = lambda r: (float("inf") if r[2] is None else r[2], (-r[3].timestamp() if r[3] else 9e18, r[1]), frozenset(f for f, v in zip("ab", r[4:]) if v is not None))
    beats = lambda q, p: key(q)[0] <= key(p)[0] and key(q)[1] < key(p)[1] and complete(key(q)[2], key(p)[2])
    left, out, k = list(rows), {}, 1
    while left:
        top = [p for p in left if not any(beats(q, p) for q in left)]
        out |= {r[1]: k for r in top}
        left, k = [r for r in left if r not in top], k + 1
    return out, key


def test_layers_against_peeling(spark):
    rng, day = random.Random(8), datetime(2001, 1, 1)
    rows = [(f"g{i % 25}", i, rng.choice([1, 2, 3, None]), rng.choice([None, day, day + timedelta(rng.randrange(4))]), rng.choice([None, "x"]), rng.choice([None, "y"])) for i in range(200)]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    for how, complete in (("fields", lambda q, p: q >= p), ("count", lambda q, p: len(q) >= len(p))):
        want = {}
        for g in {r[0] for r in rows}:
            mine = [r for r in rows if r[0] == g]
            layer, key = layers_by_peeling(mine, complete)
            for i, f in ((4, "a"), (5, "b")):
                ok = [r for r in mine if r[i] is not None]
                if ok:
                    best = min(ok, key=lambda r: (layer[r[1]], key(r)[0], key(r)[1]))
                    want[g, f] = (best[1], layer[best[1]])
        got = field_sources(df, "g", fields(), "id", "t", "r", completeness=how).collect()
        assert {(r["g"], r["field_name"]): (r["id"], r["layer"]) for r in got} == want


def test_usable_values(spark):
    good = ["Victor Lanlobury", "rafael iblokins", "Estesby, Quentin", "Wendell Tavribury Jr.", "Mr. Rafael Fosan", "A. Rafael Percy Estming"[3:], "Calvin R. Eldansby", " Nolan  Yanrilund", "MARY-ANN O'NEIL"]
    bad = [None, "", "   ", "?", "xxx", "N/A", "Unknown", "Victim", "Jane Doe #2", "John Doe", "Mrs. Kormiosa", "S. Fosridahl", "Weretano, S.", "A.J.F.", "Baby Boy", "Unidentified man", "not released"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(good + bad)], "i int, s string")
    assert [r[0] for r in df.orderBy("i").select(usable_name(F.col("s"))).collect()] == [True] * len(good) + [False] * len(bad)
    codes = spark.createDataFrame([(i, s) for i, s in enumerate(["MALE", " f ", "woman", "9", "U", None, "", "W", "native"])], "i int, s string")
    assert [tuple(r) for r in codes.orderBy("i").select(usable_code(F.col("s"), SEXES), usable_code(F.col("s"), RACES)).collect()] == [(True, False), (True, False), (True, False)] + [(False, False)] * 4 + [(False, True)] * 2
    assert spark.sql("select date'1975-12-31' a, date'1976-01-01' b, cast(null as date) c").select(*[usable_date(F.col(x)) for x in "abc"]).first() == (False, True, False)
