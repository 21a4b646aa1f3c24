"""Points near points, and points in regions, by an equi-join on grid cells and an exact check."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.geo import EARTH_RADIUS_KM, haversine_km

#: Kilometres of one degree of latitude on the sphere in use.
KM_PER_DEGREE = EARTH_RADIUS_KM * math.pi / 180


def usable_point(lat: Column, lon: Column) -> Column:
    """True for coordinates that lie on the globe; null, NaN and values out of range are not usable."""
    return F.coalesce(lat.between(-90, 90) & lon.between(-180, 180) & ~F.isnan(lat) & ~F.isnan(lon), F.lit(False))


def _band(lat: Column, step: float) -> Column:
    return F.floor((lat + 90) / step).cast("long")


def _lon_step(band: Column, step: float, radius_km: float) -> Column:
    """Width in degrees of a band's cells: the radius at the band's edge farther from the equator, 360 near a pole."""
    south = band * step - 90
    edge = F.least(F.greatest(F.abs(south), F.abs(south + step)), F.lit(90.0))
    width = F.lit(step * 1.0001) / F.cos(F.radians(edge))
    return F.when((edge >= 89.0) | (width > 120), 360.0).otherwise(width)


def near_points(
    left: DataFrame,
    right: DataFrame,
    radius_km: float,
    left_id: str,
    right_id: str,
    left_at: tuple[str, str] = ("lat", "lon"),
    right_at: tuple[str, str] = ("lat", "lon"),
) -> DataFrame:
    """All pairs within ``radius_km`` (great circle): (left_id, right_id, distance_km).

    A band of latitude is as high as the radius, a cell of a band as wide as the radius there. Each left point
    lies in one cell; each right point is laid into the cells its circle can touch (nine, fewer at a pole), so
    every pair meets in exactly one cell and is checked there once. Points of one place are joined once and spread
    to their ids afterwards, so that a place holding a third of all rows is one row in the cell join.

    Pass the smaller table as ``right``. Defined cases: null, NaN or impossible coordinates have no neighbours;
    rows delivered twice give one pair; null ids are kept as such; an empty side gives no rows; other columns, also
    those with clashing names, do not come along.
    """
    step = radius_km / KM_PER_DEGREE * 1.0001

    def places(df: DataFrame, id_: str, at: tuple[str, str], tag: str) -> tuple[DataFrame, DataFrame]:
        lat, lon = F.col(f"`{at[0]}`").cast("double"), F.col(f"`{at[1]}`").cast("double")
        rows = df.filter(usable_point(lat, lon)).select(F.col(f"`{id_}`").alias(f"{tag}_id"), (lat + 0.0).alias(f"{tag}_lat"), (lon + 0.0).alias(f"{tag}_lon")).distinct()
        return rows, rows.select(f"{tag}_lat", f"{tag}_lon").distinct()

    l_rows, l_at = places(left, left_id, left_at, "l")
    r_rows, r_at = places(right, right_id, right_at, "r")

    # lon 180 and -180 are one meridian: cells count from -180, and a circle that crosses it enters at the other end.
    l_cells = l_at.withColumn("iy", _band(F.col("l_lat"), step)).withColumn("ix", F.floor((F.col("l_lon") + 180) / _lon_step(F.col("iy"), step, radius_km)).cast("long"))
    iy = _band(F.col("r_lat"), step)
    r_bands = r_at.withColumn("iy", F.explode(F.sequence(iy - 1, iy + 1))).withColumn("w", _lon_step(F.col("iy"), step, radius_km))
    last = F.floor(F.lit(360.0) / F.col("w")).cast("long")  # the easternmost cell, narrower than the others
    lo = F.floor((F.col("r_lon") + 180 - F.col("w")) / F.col("w")).cast("long")
    hi = F.floor((F.col("r_lon") + 180 + F.col("w")) / F.col("w")).cast("long")
    # Past the seam: everything within one width of it on the other side (two cells, as the last one is narrow).
    east, west = F.col("r_lon") + 180 + F.col("w") >= 360, F.col("r_lon") + 180 - F.col("w") < 0
    ring = F.sequence(F.greatest(lo, F.lit(0)), F.least(hi, last))
    ring = F.array_union(ring, F.when(east, F.sequence(F.lit(0).cast("long"), F.least(F.lit(1).cast("long"), last))).otherwise(F.array().cast("array<bigint>")))
    ring = F.array_union(ring, F.when(west, F.sequence(F.greatest(last - 2, F.lit(0)), last)).otherwise(F.array().cast("array<bigint>")))
    r_cells = r_bands.withColumn("ix", F.explode(ring)).drop("w")

    close = (
        l_cells.join(r_cells, ["iy", "ix"])
        .withColumn("distance_km", haversine_km(F.col("l_lat"), F.col("l_lon"), F.col("r_lat"), F.col("r_lon")))
        .filter(F.col("distance_km") <= radius_km)
        .drop("iy", "ix")
    )
    pairs = close.join(r_rows, ["r_lat", "r_lon"]).join(l_rows, ["l_lat", "l_lon"])
    return pairs.select(F.col("l_id").alias(left_id), F.col("r_id").alias(right_id if right_id != left_id else f"{right_id}_r"), "distance_km")


def _inside(lat: np.ndarray, lon: np.ndarray, ring: list[tuple[float, float]], eps: float = 1e-12) -> np.ndarray:
    """1 inside, 0 on the edge, -1 outside, for a ring of (lon, lat)."""
    inside, edge = np.zeros(len(lat), bool), np.zeros(len(lat), bool)
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        cross = (x2 - x1) * (lat - y1) - (y2 - y1) * (lon - x1)
        edge |= (np.abs(cross) <= eps) & (lon >= min(x1, x2)) & (lon <= max(x1, x2)) & (lat >= min(y1, y2)) & (lat <= max(y1, y2))
        if y1 != y2:
            straddle = (y1 > lat) != (y2 > lat)
            inside ^= straddle & (lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1)
    return np.where(edge, 0, np.where(inside, 1, -1))


def points_in_regions(points: DataFrame, regions: DataFrame, point_id: str, cell_deg: float = 0.05) -> DataFrame:
    """The region that holds each point: (point_id, region, status).

    ``points`` has lat and lon, ``regions`` has region and ring (array of struct<lon, lat>, no edge across the date
    line). A region is laid into the grid cells of its bounding box, points meet regions by cell, and the ray test
    runs only on those. status is matched, boundary (on an edge or in several regions; the first name is given),
    outside, or missing_coordinates (null, NaN, out of range, or both zero).
    """
    lat, lon = F.col("lat").cast("double"), F.col("lon").cast("double")
    fit = usable_point(lat, lon) & ~((lat == 0) & (lon == 0))
    pts = points.select(F.col(f"`{point_id}`").alias("pid"), lat.alias("lat"), lon.alias("lon"), fit.alias("fit")).distinct()
    cell = lambda c: F.floor(c / cell_deg).cast("long")
    boxes = regions.select(
        "region", "ring",
        F.explode(F.sequence(cell(F.array_min("ring.lat")), cell(F.array_max("ring.lat")))).alias("iy"),
        cell(F.array_min("ring.lon")).alias("x0"), cell(F.array_max("ring.lon")).alias("x1"),
    ).select("region", "ring", "iy", F.explode(F.sequence("x0", "x1")).alias("ix"))
    met = pts.filter("fit").withColumns({"iy": cell(F.col("lat")), "ix": cell(F.col("lon"))}).join(boxes, ["iy", "ix"])

    def test(batches):
        for pdf in batches:
            rings = [tuple((p["lon"], p["lat"]) for p in r) for r in pdf["ring"]]
            state = np.full(len(pdf), -1)
            for ring in set(rings):
                at = np.array([r == ring for r in rings], bool)
                state[at] = _inside(pdf["lat"].to_numpy()[at], pdf["lon"].to_numpy()[at], list(ring))
            yield pd.DataFrame({"pid": pdf["pid"], "region": pdf["region"], "state": state})[state >= 0]

    kind = points.schema[point_id].dataType.simpleString()
    held = met.select("pid", "lat", "lon", "region", "ring").mapInPandas(test, f"pid {kind}, region string, state int")
    per = held.groupBy("pid").agg(F.min("region").alias("region"), (F.min("state") == 0).alias("edge"), F.count_distinct("region").alias("n"))
    out = pts.join(per, "pid", "left")
    status = (
        F.when(~F.col("fit"), "missing_coordinates")
        .when(F.col("region").isNull(), "outside")
        .when(F.col("edge") | (F.col("n") > 1), "boundary")
        .otherwise("matched")
    )
    return out.select(F.col("pid").alias(point_id), "region", status.alias("status"))
