import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.functions import addresses, categories, dates, names, text, values, vectors
from tidemark.functions.similarity import jaro_winkler_pair


def column(spark, rows, kind, *exprs):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, c {kind}")
    return [tuple(r) for r in df.orderBy("i").select(*exprs).collect()]


def test_names(spark):
    p = names.name_parts(F.col("c"))
    got = column(spark, ["Dr. John A. Smith Jr", "A Gonzalez", "A Orlando Gonzalez", "Maria de la Cruz", "Madonna", None, ""], "string", p["forename"], p["middle"], p["surname"], p["full"])
    assert got == [
        ("john", "a", "smith", "john smith"), ("a", None, "gonzalez", "a gonzalez"), ("orlando", "orlando", "gonzalez", "orlando gonzalez"), ("maria", None, "de la cruz", "maria de la cruz"),
        (None, None, "madonna", "madonna"), (None, None, None, None), (None, None, None, None),
    ]
    assert column(spark, ["Madonna"], "string", names.name_parts(F.col("c"), lone="forename")["forename"]) == [("madonna",)]


def test_dates(spark):
    rows = [(1985, 2, 14), (1985, 2, None), (1985, None, None), (1985, 13, 1), (None, 1, 1), (1985, 2, 30)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, y int, m int, d int")
    y, m, d = F.col("y"), F.col("m"), F.col("d")
    first, last, mid = dates.event_span(y, m, d)
    got = [tuple(r) for r in df.orderBy("i").select(dates.precision(y, m, d), first, last, mid).collect()]
    assert got == [("day", 5523, 5523, 5523.0), ("month", 5510, 5537, 5523.0), ("year", 5479, 5843, 5661.0), ("year", 5479, 5843, 5661.0), (None, None, None, None), ("day", None, None, None)]
    y, m, d = dates.text_date(F.col("c"))
    assert column(spark, ["March 3, 1999", "March 1999", "1999", "soon", None], "string", y, m, d) == [(1999, 3, 3), (1999, 3, None), (1999, None, None), (None, None, None), (None, None, None)]


def test_text(spark):
    assert column(spark, ["mur der", "shot " + "x" * 290 + " died", "shot " + "x" * 320 + " died", "the verdict", None], "string", text.mentions_homicide(F.col("c"))) == [(True,), (True,), (False,), (False,), (False,)]
    assert column(spark, [" a\x01b \n c", " ", None], "string", text.summary_norm(F.col("c"))) == [("ab c",), (None,), (None,)]
    assert column(spark, ["a  b  c"], "string", text.replace_first(F.col("c"), r"\s+", " "), text.snake_case(F.lit("camelCaseX"))) == [("a b  c", "camel_case_x")]
    assert column(spark, ["2, 1,2", None, ""], "string", text.csv_union(F.col("c"), F.lit("3 ,1"))) == [("1,2,3",), ("1,3",), ("1,3",)]
    assert column(spark, ["9% off", "9x off"], "string", text.contains_any_case(F.col("c"), "9% O")) == [(True,), (False,)]


def test_addresses(spark):
    got = column(spark, ["100 oak st.", "5 BLOCK of Elm Ave", "12 BLOCK Elm Ave", "First Street", "23 STREET", "12-A 1/2 Fir Rd", None], "string", addresses.normal_address(F.col("c")))
    assert [g[0] for g in got] == ["100 OAK STREET", "5 BLOCK OF ELM AVENUE", "12 BLOCK OF ELM AVENUE", "1ST STREET", "23RD STREET", "12 FIR ROAD", None]
    kinds = column(spark, ["5 BLOCK OF ELM AVENUE NW", "ELM ROAD AND OAK LANE", "5 ELM ROAD, X", "ELM ROAD", "CITY HALL", None], "string", addresses.address_kind(F.col("c")))
    assert [k[0] for k in kinds] == ["BLOCK", "INTERSECTION", "ADDRESS", "STREET_ONLY", "UNRECOGNIZED", "UNRECOGNIZED"]
    code = lambda a, b, k: addresses.review_code(F.lit(a), F.lit(b), F.lit(k))
    assert tuple(spark.range(1).select(code("5 A RD", "6 A RD", "ADDRESS"), code("5 A RD", "A RD", "ADDRESS"), code("5 A RD", "A RD", "STREET_ONLY"), code("1ST ST", "A", "ADDRESS")).first()) == ("house_number_changed", "house_number_missing", "input_type_changed", None)


def test_values_and_categories(spark):
    assert column(spark, ["12.7", "12.5", "-1.5", "x", None], "string", values.to_int(F.col("c"))) == [(13,), (13,), (-2,), (None,), (None,)]
    assert column(spark, ["Shotgun", "RIFLE ", "Knife or gun", "Fire", None], "string", categories.weapon(F.col("c"))) == [("shotgun",), ("rifle",), ("knife",), ("fire",), ("unknown",)]
    assert column(spark, ["Common-law wife", "Son", "Pal"], "string", categories.relationship(F.col("c"))) == [("wife",), ("son",), (None,)]


def test_vectors(spark):
    rows = [([1.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [0.0, 1.0]), ([0.0, 0.0], [1.0, 0.0]), (None, [1.0, 0.0]), ([1.0], [1.0, 0.0])]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a array<double>, b array<double>")
    assert [r[0] for r in df.orderBy("i").select(vectors.cosine(F.col("a"), F.col("b"))).collect()] == [1.0, 0.0, None, None, None]


@pytest.mark.parametrize("a,b", [("martha", "marhta"), ("abc", "acb"), ("", ""), ("dixon", "dicksonx"), ("a", "b"), ("jellyfish", "smellyfish"), ("aaaa", "aa")])
def test_jaro_winkler(a, b):
    want = duckdb.sql(f"select jaro_winkler_similarity('{a}', '{b}') as s").fetchall()[0][0]
    assert jaro_winkler_pair(a, b) == pytest.approx(want, abs=1e-9)


def test_roots_near_each_other(spark):
    rows = ["He was sh ot, and a day later he died", "died" + "." * 300 + "shot", "died" + "." * 301 + "shot", "shot\ndied", "shot shot shot dead", "unshot died", "", "the dead slept"]
    assert column(spark, rows, "string", text.mentions_homicide(F.col("c"))) == [(True,), (True,), (False,), (False,), (True,), (False,), (False,), (False,)]


def test_geocoder_forms(spark):
    got = column(spark, ["500 Good Hope Rd, Washington, D.C.", "Good Hope Rd, Washington DC", "12A 1/2 Oak St.", "111 STREET", "St James Pl"], "string", addresses.geocoder_key(F.col("c")))
    assert [g[0] for g in got] == ["500 GOOD HOPE ROAD", "MARION BARRY AVENUE", "12 OAK STREET", "111TH STREET", "ST JAMES PLACE"]
    got = column(spark, ["90 New York Avenue, Jamaica", "90 New York Avenue, Albany", "East Main St IRT Subway Station at 5th, Bronx"], "string", addresses.station_name(F.col("c")))
    assert [g[0] for g in got] == ["90 GUY R BREWER BOULEVARD, Jamaica", "90 New York Avenue, Albany", "Main St Station, Bronx"]
