"""Nearest facility and service radius for facilities that are a table of any size.

Both sides are DataFrames that meet on grid cells. For the nearest one the search widens: a
point looks at the facilities of its cell and the eight around it, is settled once the best
lies closer than the width of a cell, and else goes on with cells twice as wide.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from haulmetrics.functions.geo import degree_gap, haversine_km
from haulmetrics.operators.warehouse import distance_stats
from haulmetrics.schema import EARTH_RADIUS_KM
from haulmetrics.session import cut_lineage

# Cells of the first round are this much narrower than one with a single facility would be on average.
FINER = 8
# Cells wider than this reach every facility from every point.
WIDEST = 1024.0
FOUND = "struct<gap: double, id: bigint, lat: double, lon: double>"


def _placed(facilities: DataFrame) -> DataFrame:
    """``id, f_lat, f_lon`` of the facilities that have a place."""
    return facilities.where("id IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL").select(
        F.col("id").cast("long").alias("id"), F.col("lat").cast("double").alias("f_lat"), F.col("lon").cast("double").alias("f_lon"))


def _cell(value: Column | str, size: float) -> Column:
    return F.floor((F.col(value) if isinstance(value, str) else value) / size).cast("long")


def _around(rings: int = 1) -> Column:
    steps = range(-rings, rings + 1)
    return F.explode(F.array(*[F.struct(F.lit(y).alias("y"), F.lit(x).alias("x")) for y in steps for x in steps]))


def nearest_of_table(points: DataFrame, facilities: DataFrame) -> DataFrame:
    """``points`` (``lat, lon`` and more) with ``facility_id, facility_lat, facility_lon``: nearest by degrees, lowest id on ties.

    ``facilities`` has ``id, lat, lon``; those without one of them are left out. A point
    without coordinates, or any point if there is no facility, has none. Different places are
    looked up once, however many points share one. In a region without facilities a place
    meets those of ever wider cells; its number of rounds is the logarithm of the distance.
    """
    sites = cut_lineage(_placed(facilities))
    box = sites.agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{k}_{c}") for c in ("f_lat", "f_lon") for k, f in (("a", F.min), ("b", F.max))]).first()
    places = cut_lineage(points.where("lat IS NOT NULL AND lon IS NOT NULL").select("lat", "lon").distinct())
    none = places.limit(0).select("lat", "lon", F.lit(None).cast(FOUND).alias("best"))
    settled = [none]
    if box["n"]:
        area = max((box["b_f_lat"] - box["a_f_lat"]) * (box["b_f_lon"] - box["a_f_lon"]), 1e-9)
        size = max(math.sqrt(area / box["n"]) / FINER, 1e-6)
        left = places.withColumn("best", F.lit(None).cast(FOUND))
        while left.take(1):
            near = left.select("lat", "lon", _around().alias("d")).select(
                "lat", "lon", (_cell("lat", size) + F.col("d.y")).alias("y"), (_cell("lon", size) + F.col("d.x")).alias("x"))
            cells = sites.withColumns({"y": _cell("f_lat", size), "x": _cell("f_lon", size)})
            entry = F.struct(degree_gap("lat", "lon", "f_lat", "f_lon").alias("gap"), "id", F.col("f_lat").alias("lat"), F.col("f_lon").alias("lon"))
            best = near.join(cells, ["y", "x"]).groupBy("lat", "lon").agg(F.min(entry).alias("best"))
            met = cut_lineage(left.select("lat", "lon").join(best, ["lat", "lon"], "left"))
            sure = F.coalesce(F.col("best.gap") < size * size, F.lit(False)) | F.lit(size > WIDEST)
            settled.append(met.where(sure))
            left = cut_lineage(met.where(~sure))
            size *= 2
    found = settled[0]
    for part in settled[1:]:
        found = found.unionByName(part)
    answers = found.select(F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), "best")
    same = (F.col("lat") == F.col("_lat")) & (F.col("lon") == F.col("_lon"))
    return points.join(answers, same, "left").select(
        *[points[c] for c in points.columns], F.col("best.id").alias("facility_id"), F.col("best.lat").alias("facility_lat"),
        F.col("best.lon").alias("facility_lon"))


def facility_stats_of_table(points: DataFrame, facilities: DataFrame) -> DataFrame:
    """Customers, demand and km figures of each facility of a table that serves any point."""
    return distance_stats(nearest_of_table(points, facilities).where("facility_id IS NOT NULL"), [])


def _reach(lat: Column, radius_km: float, size: float) -> Column:
    """Degrees of longitude that the radius spans at most around a latitude."""
    steep = math.sin(min(radius_km / EARTH_RADIUS_KM * 1.0001, math.pi / 2)) / F.greatest(F.cos(F.radians(lat)), F.lit(1e-9))
    return F.when((F.abs(lat) + size >= 90) | (steep >= 1), 180.0).otherwise(F.degrees(F.asin(F.least(steep, F.lit(1.0)))))


def in_range_of_table(points: DataFrame, facilities: DataFrame, radius_km: float) -> DataFrame:
    """``lat, lon, facility_id`` for every different place and facility within ``radius_km`` of each other.

    A facility is put into all cells that its radius can reach, a place into its own, so each
    pair meets once; cells are as wide as the radius and wrap around at 180 degrees.
    """
    size = max(math.degrees(radius_km / EARTH_RADIUS_KM), 1e-6) * 1.0001
    columns = max(1, int(360 // size))
    width = 360.0 / columns
    first = F.floor((F.col("f_lon") + 180 - F.col("reach")) / width)
    last = F.least(F.floor((F.col("f_lon") + 180 + F.col("reach")) / width), first + columns - 1)
    cells = _placed(facilities).withColumn("reach", _reach(F.col("f_lat"), radius_km, size)).select(
        "id", "f_lat", "f_lon", F.explode(F.sequence(_cell(F.col("f_lat") - size, size), _cell(F.col("f_lat") + size, size))).alias("y"),
        first.alias("first"), last.alias("last")).select(
        "id", "f_lat", "f_lon", "y", F.explode(F.sequence("first", "last")).alias("x")).withColumn("x", F.pmod("x", F.lit(columns)))
    places = points.where("lat IS NOT NULL AND lon IS NOT NULL").select("lat", "lon").distinct().withColumns({
        "y": _cell("lat", size), "x": F.pmod(F.floor((F.col("lon") + 180) / width), F.lit(columns))})
    return places.join(cells, ["y", "x"]).where(haversine_km("lat", "lon", "f_lat", "f_lon") <= radius_km).select(
        "lat", "lon", F.col("id").alias("facility_id"))


def coverage_of_table(points: DataFrame, facilities: DataFrame, radius_km: float = 100.0) -> DataFrame:
    """Customers within the radius of each facility of a table, and a row of facility -1 for their union.

    A facility without customers in range is listed with 0; one without a place is left out.
    """
    served = cut_lineage(points.where("lat IS NOT NULL AND lon IS NOT NULL").groupBy("lat", "lon").agg(F.sum("customers").alias("customers")))
    hits = cut_lineage(in_range_of_table(served, facilities, radius_km))
    counts = hits.join(served, ["lat", "lon"]).groupBy("facility_id").agg(F.sum("customers").alias("n"))
    union = served.join(hits.select("lat", "lon").distinct(), ["lat", "lon"], "left_semi").agg(
        F.lit(-1).cast("long").alias("facility_id"), F.coalesce(F.sum("customers"), F.lit(0)).alias("n"))
    all_of = _placed(facilities).select(F.col("id").alias("facility_id")).join(counts, "facility_id", "left").unionByName(union)
    total = points.agg(F.sum("customers")).first()[0] or 0
    n = F.coalesce("n", F.lit(0))
    return all_of.select("facility_id", n.alias("customers_in_range"), F.round(n / F.lit(total) * 100, 2).alias("coverage_pct"),
                         (F.lit(total) - n).alias("customers_out_of_range"))
