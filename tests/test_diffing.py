import pytest

from tidemark.operators.diffing import diff_tables

SCHEMA = "k string, name string, x double, ids string, day string, side string, extra string"
FIELDS = {"name": "text", "x": "number", "ids": "list", "day": "exact"}


def run(spark, left, right):
    l, r = (spark.createDataFrame([(*row, "s", "e") for row in rows], SCHEMA) for rows in (left, right))
    return sorted(map(tuple, diff_tables(l, r, "k", FIELDS).collect()), key=str)


def test_kinds_of_difference(spark):
    left = [("a", "Ann Lee", 1.0, "1,2", "2001-01-01"), ("b", None, 2.0, "3", None), ("c", "Cy", None, "4", "x"), ("d", "Di", 1.0, None, "x")]
    right = [("a", "ann  LEE ", 1.0 + 9e-7, " 2, 1", "2001-01-01"), ("b", "  ", 2.000002, "3,5", None), ("c", "Cyd", 0.0, "4", "X"), ("e", "E", 1.0, "", "x")]
    assert run(spark, left, right) == [
        ("b", "changed", "ids"), ("b", "changed", "x"), ("c", "changed", "day"), ("c", "changed", "name"), ("c", "changed", "x"), ("d", "gone", ""), ("e", "new", ""),
    ]


def test_empty_sides_repeats_nulls(spark):
    row = ("a", "n", 1.0, "1", "d")
    assert run(spark, [], []) == []
    assert run(spark, [row, row], []) == [("a", "gone", "")]
    assert run(spark, [row, row], [row]) == []
    assert run(spark, [(None, *row[1:])], [row]) == [("a", "new", ""), (None, "gone", "")]
    assert run(spark, [(None, *row[1:])], [(None, *row[1:])]) == [(None, "gone", ""), (None, "new", "")]
    nan = ("a", "n", float("nan"), "1", "d")
    assert run(spark, [nan], [("a", "n", None, "1", "d")]) == []


def test_several_rows_of_a_key_compare_as_sets(spark):
    a, b = ("a", "n", 1.0, "1", "d"), ("a", "m", 5.0, "1", "d")
    assert run(spark, [a, b], [b, a]) == []
    assert run(spark, [a, b], [a]) == [("a", "changed", "name"), ("a", "changed", "x")]


def test_distance_of_just_the_tolerance_and_lost_blanks(spark):
    left = [(f"k{i}", "Ann Lee", float(i), "1", "d") for i in range(50)]
    right = [(f"k{i}", "Ann Lee" if i else "AnnLee", i + 1e-6, "1", "d") for i in range(50)]
    got = run(spark, left, right)
    assert len(got) == 51 and ("k0", "changed", "name") in got
    assert run(spark, left, [(k, " ann   LEE", x + 9.9e-7, i, d) for k, _, x, i, d in left]) == []


def test_hot_key_and_long_text(spark):
    long = "word " * 200_000
    hot = spark.range(20_000).selectExpr("'k' as k", "'n' as name", "cast(id % 3 as double) as x", "'1' as ids", "'d' as day")
    one = spark.createDataFrame([("k", "n", 0.0, "1", "d"), ("l", long, 0.0, "1", "d")], "k string, name string, x double, ids string, day string")
    assert sorted(map(tuple, diff_tables(hot, one, "k", FIELDS).collect())) == [("k", "changed", "x"), ("l", "new", "")]


def test_unknown_kind(spark):
    with pytest.raises(ValueError):
        diff_tables(spark.range(1), spark.range(1), "id", {"id": "fuzzy"})
