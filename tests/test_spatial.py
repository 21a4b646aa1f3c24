import math

import numpy as np

from tidemark.operators.spatial import near_points, points_in_regions


def km(a, b):
    la, lo, lb, lp = map(math.radians, (a[0], a[1], b[0], b[1]))
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
    return 2 * 6371.0088 * math.asin(min(1, math.sqrt(h)))


def check(spark, left, right, radius):
    l = spark.createDataFrame([(f"l{i}", *p, "x") for i, p in enumerate(left)], "id string, lat double, lon double, iy string")
    r = spark.createDataFrame([(f"r{i}", *p) for i, p in enumerate(right)], "rid string, lat double, lon double")
    got = near_points(l, r, radius, "id", "rid").select("id", "rid").collect()
    assert len(got) == len(set(map(tuple, got)))
    want = {(f"l{i}", f"r{j}") for i, a in enumerate(left) for j, b in enumerate(right) if km(a, b) <= radius}
    assert set(map(tuple, got)) == want
    return want


def test_against_brute_force(spark):
    rng = np.random.default_rng(1)
    left = [(43 + a, -75 + b) for a, b in rng.uniform(0, 0.05, (150, 2)).tolist()]
    right = [(43 + a, -75 + b) for a, b in rng.uniform(0, 0.05, (150, 2)).tolist()]
    assert check(spark, left, right, 0.5)


def test_seam_and_poles(spark):
    rng = np.random.default_rng(2)
    left = [(a, 179.9 + b if b < 0.1 else b - 180.1) for a, b in rng.uniform(0, 0.2, (60, 2)).tolist()] + [(89.9 + a / 3, b * 1700 - 180) for a, b in rng.uniform(0, 0.2, (60, 2)).tolist()]
    right = [(a, 179.9 + b if b < 0.1 else b - 180.1) for a, b in rng.uniform(0, 0.2, (60, 2)).tolist()] + [(89.9 + a / 3, b * 1700 - 180) for a, b in rng.uniform(0, 0.2, (60, 2)).tolist()]
    assert check(spark, left, right, 5.0)
    check(spark, [(0.0, 180.0), (-90.0, 7.0)], [(0.0, -180.0), (-90.0, -100.0)], 0.1)


def test_unusable_and_repeated(spark):
    l = spark.createDataFrame([("a", None, 1.0), ("b", float("nan"), 1.0), ("c", 95.0, 1.0), ("d", 1.0, 1.0), ("d", 1.0, 1.0)], "id string, lat double, lon double")
    r = spark.createDataFrame([("x", 1.0, 1.0), ("x", 1.0, 1.0), ("y", 1.0, None)], "rid string, lat double, lon double")
    assert [tuple(x) for x in near_points(l, r, 1.0, "id", "rid").collect()] == [("d", "x", 0.0)]
    assert near_points(l.limit(0), r, 1.0, "id", "rid").count() == 0


def test_hot_place(spark):
    l = spark.range(3000).selectExpr("id", "43.0 as lat", "-75.0 as lon").selectExpr("id", "cast(lat as double) lat", "cast(lon as double) lon")
    r = spark.createDataFrame([("x", 43.0, -75.0)], "rid string, lat double, lon double")
    assert near_points(l, r, 0.1, "id", "rid").count() == 3000


def test_regions(spark):
    square = lambda x, y: [(x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1)]
    regions = spark.createDataFrame([("A", square(0.0, 0.0)), ("B", square(1.0, 0.0))], "region string, ring array<struct<lon: double, lat: double>>")
    pts = spark.createDataFrame([(1, 0.5, 0.5), (2, 0.5, 1.0), (3, 0.5, 1.5), (4, 5.0, 5.0), (5, None, 1.0), (6, 0.0, 0.0)], "id int, lat double, lon double")
    got = {r["id"]: (r["region"], r["status"]) for r in points_in_regions(pts, regions, "id").collect()}
    assert got == {1: ("A", "matched"), 2: ("A", "boundary"), 3: ("B", "matched"), 4: (None, "outside"), 5: (None, "missing_coordinates"), 6: (None, "missing_coordinates")}
