"""Stops per region, distance and time matrices, route roll-ups.

A region keeps at most ``max_stops`` locations (the problem size of the route methods),
so anything done per region afterwards is small; regions are what Spark spreads out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from haulmetrics.functions.exprs import dbl, ratio
from haulmetrics.functions.geo import haversine_km
from haulmetrics.schema import MAX_STOPS, NUM_VEHICLES, SERVICE_MINUTES, SINGLE_TOUR_POINTS, SPEED_KMH


def top_regions(df: DataFrame, region: str = "customer_state", n: int = 10) -> DataFrame:
    """Regions by line count, name order on ties."""
    return (df.where(F.col(region).isNotNull()).groupBy(F.col(region).alias("region"))
            .agg(F.count(F.lit(1)).alias("orders")).orderBy(F.desc("orders"), "region").limit(n))


def region_stops(df: DataFrame, region: str = "customer_state", max_stops: int = MAX_STOPS,
                 lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """(region, seq, lat, lon, lines, depot_lat, depot_lon): the busiest distinct locations.

    Ordered by line count, then coordinates; the depot is their plain centroid. Lines are
    counted before the ranking and the ranking keeps only ``max_stops`` rows per task
    ahead of its shuffle.
    """
    counts = (df.where(F.col(region).isNotNull() & F.col(lat).isNotNull() & F.col(lon).isNotNull())
              .groupBy(F.col(region).alias("region"), F.col(lat).alias("lat"), F.col(lon).alias("lon"))
              .agg(F.count(F.lit(1)).alias("lines")))
    rank = Window.partitionBy("region").orderBy(F.desc("lines"), "lat", "lon")
    kept = counts.withColumn("seq", F.row_number().over(rank)).where(F.col("seq") <= max_stops)
    whole = Window.partitionBy("region")
    return kept.select("region", "seq", "lat", "lon", "lines", F.avg("lat").over(whole).alias("depot_lat"),
                       F.avg("lon").over(whole).alias("depot_lon"))


def _nodes(stops: DataFrame) -> DataFrame:
    """(region, nodes): the depot as node 0 and the stops, at most max_stops + 1 entries."""
    depot = F.struct(F.lit(0).alias("i"), F.first("depot_lat").alias("lat"), F.first("depot_lon").alias("lon"))
    listed = F.array_sort(F.collect_list(F.struct(F.col("seq").alias("i"), "lat", "lon")))
    return stops.groupBy("region").agg(F.concat(F.array(depot), listed).alias("nodes"))


def distance_matrix(stops: DataFrame) -> DataFrame:
    """(region, i, j, km) for i != j, both directions; node 0 is the depot."""
    left = _nodes(stops).select("region", "nodes", F.explode("nodes").alias("a"))
    pairs = left.select("region", "a", F.explode(F.filter("nodes", lambda n: n["i"] != F.col("a.i"))).alias("b"))
    first = F.when(F.col("a.i") < F.col("b.i"), F.col("a")).otherwise(F.col("b"))
    last = F.when(F.col("a.i") < F.col("b.i"), F.col("b")).otherwise(F.col("a"))
    return pairs.select("region", F.col("a.i").alias("i"), F.col("b.i").alias("j"),
                        haversine_km(first["lat"], first["lon"], last["lat"], last["lon"]).alias("km"))


def time_matrix(edges: DataFrame, speed_kmh: float = SPEED_KMH, service_min: float = SERVICE_MINUTES) -> DataFrame:
    """Whole minutes per leg; arriving anywhere but the depot includes the service time."""
    service = F.when(F.col("j") != 0, service_min).otherwise(0.0)
    return edges.select("region", "i", "j", F.floor(travel_minutes(F.col("km"), speed_kmh) + service)
                        .cast("int").alias("minutes"))


def travel_minutes(km: Column, speed_kmh: float = SPEED_KMH) -> Column:
    return km / speed_kmh * 60


def problem_choice(stops: DataFrame, limit: int = SINGLE_TOUR_POINTS) -> DataFrame:
    """(region, points, problem_type): one tour up to ``limit`` points, depot included."""
    return stops.groupBy("region").agg((F.count(F.lit(1)) + 1).alias("points")).withColumn(
        "problem_type", F.when(F.col("points") <= limit, "tsp").otherwise("vrp"))


def simple_routes(stops: DataFrame, vehicles: int = NUM_VEHICLES, speed_kmh: float = SPEED_KMH,
                  service_min: float = SERVICE_MINUTES) -> DataFrame:
    """One out-and-back per stop for regions with fewer stops than vehicles.

    Every vehicle is listed; one without a stop has zeros.
    """
    few = _nodes(stops).where(F.size("nodes") - 1 < vehicles)
    each = few.select("region", F.explode(F.sequence(F.lit(0), F.lit(vehicles - 1))).alias("vehicle_id"), "nodes")
    stop, depot = F.get("nodes", F.col("vehicle_id") + 1), F.get("nodes", F.lit(0))
    legs = each.select("region", "vehicle_id", F.coalesce(
        haversine_km(depot["lat"], depot["lon"], stop["lat"], stop["lon"]) * 2, F.lit(0.0)).alias("distance_km"),
        stop.isNotNull().cast("int").alias("num_stops"))
    return with_times(legs, speed_kmh, service_min)


def with_times(routes: DataFrame, speed_kmh: float, service_min: float) -> DataFrame:
    travel, service = travel_minutes(F.col("distance_km"), speed_kmh), F.col("num_stops") * service_min
    return routes.select("*", travel.alias("travel_time_min"), dbl(service).alias("service_time_min"),
                         (travel + service).alias("total_time_min"))


def route_rollup(route_stops: DataFrame, by: tuple[str, ...] = ("region", "vehicle_id"), order: str = "stop_seq",
                 speed_kmh: float = SPEED_KMH, service_min: float = SERVICE_MINUTES) -> DataFrame:
    """Distance, times and stop count of each route from its ordered stop rows.

    Rows flagged ``is_depot`` are way points without service.
    """
    along = Window.partitionBy(*by).orderBy(order)
    leg = haversine_km("lat", "lon", F.lead("lat").over(along), F.lead("lon").over(along))
    routes = route_stops.withColumn("leg_km", leg).groupBy(*by).agg(
        F.coalesce(F.sum("leg_km"), F.lit(0.0)).alias("distance_km"),
        F.count_if(F.col("is_depot") == 0).cast("int").alias("num_stops"))
    return with_times(routes, speed_kmh, service_min)


def region_rollup(routes: DataFrame, vehicles: int = NUM_VEHICLES, by: tuple[str, ...] = ("region",)) -> DataFrame:
    """Totals, longest route, mean per vehicle and balance of each region's routes."""
    total, longest = F.sum("total_time_min"), F.max("total_time_min")
    return routes.groupBy(*by).agg(
        F.sum("distance_km").alias("total_distance_km"), total.alias("total_time_min"),
        longest.alias("max_route_time_min"), (total / vehicles).alias("avg_route_time_min"),
        ratio(longest, total / vehicles, 1.0).alias("time_balance_ratio"),
        F.count_if(F.col("num_stops") > 0).alias("vehicles_used"))
