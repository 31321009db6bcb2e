"""Warehouse placement and routing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from haulmetrics.functions.geo import haversine_km
from haulmetrics.operators import facility_tables, metrics, routing, stops, warehouse
from haulmetrics.plans.gaps import GAP_COLUMNS
from haulmetrics.plans.metric_queries import rounded
from haulmetrics.plans.registry import on_lines, query
from haulmetrics.session import cut_lineage, stored
from haulmetrics.sources.star import order_lines

PLACE = ("latitude", "longitude")
DEMAND = (*PLACE, "order_item_quantity")
# Parameters of the facility queries: five fixed sites and a service radius.
FACILITIES = ((-30.0, -80.0), (10.0, -40.0), (38.0, 0.0), (-10.0, 45.0), (26.0, 90.0))
RADIUS_KM = 900.0
REGION = "customer_state"
STOPS = 15


def hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (f"(2 * 6371.0 * asin(least(1.0, sqrt(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) "
            f"+ cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)))))")


_POINTS = ("points", "SELECT latitude AS lat, longitude AS lon, count(*) AS customers, "
           "CAST(sum(order_item_quantity) AS BIGINT) AS demand FROM ol GROUP BY 1, 2")
_SITES = ("facilities", "SELECT * FROM (VALUES " + ", ".join(
    f"({i}, CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))" for i, (a, b) in enumerate(FACILITIES)) + ") t(id, f_lat, f_lon)")
_NEAREST = ("nearest", """SELECT * FROM (SELECT points.*, facilities.*, row_number() OVER (PARTITION BY lat, lon
  ORDER BY (lat - f_lat) * (lat - f_lat) + (lon - f_lon) * (lon - f_lon), id) AS place FROM points, facilities) WHERE place = 1""")
_STATS = f"""
SELECT CAST(id AS INT) AS facility_id, f_lat AS latitude, f_lon AS longitude, CAST(sum(customers) AS BIGINT) AS customers_served,
  CAST(sum(demand) AS BIGINT) AS total_demand, round(sum(km * customers) / sum(customers), 6) AS avg_distance_km,
  round(sum(km * demand) / sum(demand), 6) AS weighted_avg_distance_km, round(max(km), 6) AS max_distance_km,
  round(sum(km * customers), 3) AS total_distance_km
FROM (SELECT *, {hav('lat', 'lon', 'f_lat', 'f_lon')} AS km FROM {{source}}) GROUP BY id, f_lat, f_lon"""


def _rounded_stats(df):
    return rounded(df, skip=("latitude", "longitude", "total_distance_km", "objective")).withColumn(
        "total_distance_km", F.round("total_distance_km", 3))


def points(spark, sf_dir):
    return warehouse.demand_points(order_lines(spark, sf_dir, DEMAND))


# --- warehouses ---------------------------------------------------------------

@query("w1_kmeans")
def kmeans(spark, sf_dir):
    return warehouse.kmeans_location(points(spark, sf_dir))


@query("w2_nearest_facility", on_lines(
    "SELECT lat, lon, customers, CAST(id AS INT) AS facility_id FROM nearest", _POINTS, _SITES, _NEAREST))
def nearest_facility(spark, sf_dir):
    return warehouse.nearest_facility(points(spark, sf_dir), FACILITIES).select("lat", "lon", "customers", "facility_id")


@query("w3_facility_stats", on_lines(_STATS.format(source="nearest"), _POINTS, _SITES, _NEAREST))
def facility_stats(spark, sf_dir):
    return _rounded_stats(warehouse.facility_stats(points(spark, sf_dir), FACILITIES))


_GRAVITY = f"""
SELECT round(cy, 6) AS latitude, round(cx, 6) AS longitude, CAST(sum(customers) AS BIGINT) AS total_customers,
  CAST(sum(demand) AS BIGINT) AS total_demand, round(sum(km * customers) / sum(customers), 2) AS avg_distance_km,
  round(sum(km * demand) / sum(demand), 2) AS weighted_avg_distance_km, round(max(km), 2) AS max_distance_km,
  round(sum(km * customers), 2) AS total_distance_km
FROM (SELECT *, {hav('lat', 'lon', 'cy', 'cx')} AS km FROM points,
  (SELECT sum(lat * demand) / sum(demand) AS cy, sum(lon * demand) / sum(demand) AS cx FROM points)) GROUP BY cy, cx"""


@query("w4_center_of_gravity", on_lines(_GRAVITY, _POINTS))
def center_of_gravity(spark, sf_dir):
    return warehouse.center_of_gravity(points(spark, sf_dir))


_SPACED = ("spaced", """SELECT row_number() OVER (ORDER BY lat, lon) - 1 AS j, lat AS f_lat, lon AS f_lon FROM (
  SELECT DISTINCT latitude AS lat, lon FROM (SELECT (i * ((SELECT count(*) FROM ol) - 1)) // 29 AS r FROM range(30) t(i))
  JOIN (SELECT *, sum(c) OVER (ORDER BY latitude) AS upto FROM (
    SELECT latitude, min(longitude) AS lon, count(*) AS c FROM ol GROUP BY latitude)) ON r >= upto - c AND r < upto)""")
_KM = ("kms", f"SELECT lat, lon, demand, j, {hav('lat', 'lon', 'f_lat', 'f_lon')} AS km FROM points, spaced")
_BEST_SET = ("best_set", """SELECT a.j AS j1, b.j AS j2, c.j AS j3, sum(a.demand * least(a.km, b.km, c.km)) AS objective
  FROM kms a JOIN kms b ON a.lat = b.lat AND a.lon = b.lon AND a.j < b.j
  JOIN kms c ON a.lat = c.lat AND a.lon = c.lon AND b.j < c.j GROUP BY ALL ORDER BY objective LIMIT 1""")
_OPENED = ("opened", """SELECT row_number() OVER (ORDER BY j) - 1 AS id, f_lat, f_lon, objective
  FROM spaced, best_set WHERE j IN (j1, j2, j3)""")
_SERVED = ("served", f"""SELECT * FROM (SELECT points.*, opened.*, row_number() OVER (PARTITION BY lat, lon
  ORDER BY {hav('lat', 'lon', 'f_lat', 'f_lon')}, id) AS place FROM points, opened) WHERE place = 1""")


@query("w5_p_median", on_lines(
    "SELECT s.*, (SELECT round(objective, 1) FROM best_set) AS objective FROM (" + _STATS.format(source="served") + ") s",
    _POINTS, _SPACED, _KM, _BEST_SET, _OPENED, _SERVED))
def p_median(spark, sf_dir):
    lines = stored(order_lines(spark, sf_dir, DEMAND), "demand-lines")
    sites = warehouse.candidate_sites(lines)
    out = _rounded_stats(warehouse.p_median(warehouse.demand_points(lines), sites, 3))
    return out.withColumn("objective", F.round("objective", 1))


GAP_DEMAND = (*DEMAND, "order_id", "days_real")


def gap_points(spark, sf_dir, missing):
    """Demand points of lines of which some have no quantity."""
    return gap_points_of(order_lines(spark, sf_dir, GAP_DEMAND), missing)


def gap_points_of(lines, missing):
    return warehouse.demand_points(lines.withColumn("order_item_quantity", F.expr(GAP_COLUMNS["order_item_quantity"])), missing=missing)


def _gap_points_sql(quantity: str, condition: str) -> tuple[str, str]:
    return ("points", f"""SELECT latitude AS lat, longitude AS lon, count(*) AS customers, CAST(sum({quantity}) AS BIGINT) AS demand
  FROM (SELECT latitude, longitude, {GAP_COLUMNS["order_item_quantity"]} AS q FROM ol) WHERE {condition} GROUP BY 1, 2""")


@query("w4_center_of_gravity_gaps", on_lines(_GRAVITY, _gap_points_sql("q", "q IS NOT NULL")))
def center_of_gravity_gaps(spark, sf_dir):
    return warehouse.center_of_gravity(gap_points(spark, sf_dir, "drop"))


_BEST_FIVE = ("best_set", """SELECT a.j AS j1, b.j AS j2, c.j AS j3, d.j AS j4, e.j AS j5,
    sum(a.demand * least(a.km, b.km, c.km, d.km, e.km)) AS objective
  FROM kms a JOIN kms b ON a.lat = b.lat AND a.lon = b.lon AND a.j < b.j JOIN kms c ON a.lat = c.lat AND a.lon = c.lon AND b.j < c.j
  JOIN kms d ON a.lat = d.lat AND a.lon = d.lon AND c.j < d.j JOIN kms e ON a.lat = e.lat AND a.lon = e.lon AND d.j < e.j
  GROUP BY ALL ORDER BY objective LIMIT 1""")
_OPENED_FIVE = ("opened", _OPENED[1].replace("(j1, j2, j3)", "(j1, j2, j3, j4, j5)"))


@query("w5_p_median_default", on_lines(
    "SELECT s.*, (SELECT round(objective, 1) FROM best_set) AS objective FROM (" + _STATS.format(source="served") + ") s",
    _gap_points_sql("coalesce(q, 1)", "true"), _SPACED, _KM, _BEST_FIVE, _OPENED_FIVE, _SERVED))
def p_median_default(spark, sf_dir):
    """Five facilities out of thirty candidates, every set of them; lines without a quantity ask for one piece."""
    lines = stored(order_lines(spark, sf_dir, GAP_DEMAND), "demand-lines")
    sites = warehouse.candidate_sites(lines)
    out = _rounded_stats(warehouse.p_median(gap_points_of(lines, "one"), sites))
    return out.withColumn("objective", F.round("objective", 1))


@query("w3_totals", on_lines(f"""
SELECT CAST(5 AS INT) AS n_facilities, CAST(sum(customers) AS BIGINT) AS total_customers, round(sum(km * customers), 2) AS total_distance_km,
  round(sum(km * customers) / sum(customers), 6) AS avg_distance_per_order_km, CAST(5 * 50000 AS DOUBLE) AS facility_cost
FROM (SELECT *, {hav('lat', 'lon', 'f_lat', 'f_lon')} AS km FROM nearest)""", _POINTS, _SITES, _NEAREST))
def facility_totals(spark, sf_dir):
    totals = warehouse.facility_totals(warehouse.facility_stats(points(spark, sf_dir), FACILITIES), len(FACILITIES))
    return totals.withColumns({"total_distance_km": F.round("total_distance_km", 2),
                               "avg_distance_per_order_km": F.round("avg_distance_per_order_km", 6)})


@query("w8_region_summary")
def region_summary(spark, sf_dir):
    return warehouse.region_summary(regional(spark, sf_dir))


@query("w6_coverage", on_lines(f"""
SELECT facility_id, n AS customers_in_range, round(n / total * 100, 2) AS coverage_pct, CAST(total - n AS BIGINT) AS customers_out_of_range
FROM (SELECT CAST(id AS INT) AS facility_id, CAST(coalesce(sum(customers) FILTER (km <= {RADIUS_KM}), 0) AS BIGINT) AS n
      FROM (SELECT *, {hav('lat', 'lon', 'f_lat', 'f_lon')} AS km FROM points, facilities) GROUP BY id
      UNION ALL
      SELECT -1, CAST(sum(customers) AS BIGINT) FROM points WHERE EXISTS (SELECT 1 FROM facilities
        WHERE {hav('lat', 'lon', 'f_lat', 'f_lon')} <= {RADIUS_KM})),
     (SELECT CAST(sum(customers) AS DOUBLE) AS total FROM points)""", _POINTS, _SITES))
def coverage(spark, sf_dir):
    return warehouse.coverage(points(spark, sf_dir), FACILITIES, RADIUS_KM)


# Facilities as a table: at every latitude with customers the westernmost place is one.
_SITE_TABLE = ("facilities", "SELECT CAST(round((lat + 90) * 1000000) AS BIGINT) AS id, lat AS f_lat, min(lon) AS f_lon FROM points GROUP BY lat")
TABLE_RADIUS_KM = 150.0


def site_table(places):
    return places.groupBy("lat").agg(F.min("lon").alias("lon")).select(
        F.round((F.col("lat") + 90) * 1000000).cast("long").alias("id"), "lat", "lon")


@query("w2_nearest_of_table", on_lines(
    "SELECT lat, lon, customers, id AS facility_id FROM nearest", _POINTS, _SITE_TABLE, _NEAREST))
def nearest_of_table(spark, sf_dir):
    places = cut_lineage(points(spark, sf_dir))
    return facility_tables.nearest_of_table(places, site_table(places)).select("lat", "lon", "customers", "facility_id")


@query("w3_stats_of_table", on_lines(_STATS.format(source="nearest").replace("CAST(id AS INT)", "id"), _POINTS, _SITE_TABLE, _NEAREST))
def stats_of_table(spark, sf_dir):
    places = cut_lineage(points(spark, sf_dir))
    return _rounded_stats(facility_tables.facility_stats_of_table(places, site_table(places)))


_TABLE_KM = ("kms", f"SELECT *, {hav('lat', 'lon', 'f_lat', 'f_lon')} AS km FROM points, facilities")


@query("w6_coverage_of_table", on_lines(f"""
SELECT facility_id, n AS customers_in_range, round(n / total * 100, 6) AS coverage_pct, CAST(total - n AS BIGINT) AS customers_out_of_range
FROM (SELECT id AS facility_id, CAST(coalesce(sum(customers) FILTER (km <= {TABLE_RADIUS_KM}), 0) AS BIGINT) AS n FROM kms GROUP BY id
      UNION ALL SELECT -1, CAST(sum(customers) AS BIGINT) FROM (SELECT DISTINCT lat, lon, customers FROM kms WHERE km <= {TABLE_RADIUS_KM})),
     (SELECT CAST(sum(customers) AS DOUBLE) AS total FROM points)""", _POINTS, _SITE_TABLE, _TABLE_KM))
def coverage_of_table(spark, sf_dir):
    places = cut_lineage(points(spark, sf_dir))
    served = facility_tables.coverage_of_table(places, site_table(places), TABLE_RADIUS_KM)
    # Two digits, as the operator gives them, leave shares on the border between two roundings.
    share = F.col("customers_in_range") / (F.col("customers_in_range") + F.col("customers_out_of_range")) * 100
    return served.withColumn("coverage_pct", F.round(share, 6))


@query("w5_p_median_exchange")
def p_median_exchange(spark, sf_dir):
    """Ten facilities out of sixty candidates, whose sets are too many to score."""
    lines = stored(order_lines(spark, sf_dir, DEMAND), "demand-lines")
    sites = warehouse.candidate_sites(lines, 60)
    return _rounded_stats(warehouse.p_median(warehouse.demand_points(lines), sites, 10, method="exchange"))


@query("w7_scenarios")
def scenarios(spark, sf_dir):
    return warehouse.compare_counts(points(spark, sf_dir))


@query("w8_regional")
def regional(spark, sf_dir):
    return warehouse.by_region(order_lines(spark, sf_dir, [*DEMAND, "order_region"]))


# --- geography ----------------------------------------------------------------

@query("g1_haversine", on_lines(
    f"SELECT DISTINCT latitude, longitude, round({hav('latitude', 'longitude', '0.0', '0.0')}, 6) AS km FROM ol"))
def haversine(spark, sf_dir):
    places = order_lines(spark, sf_dir, PLACE).distinct()
    return places.select(*PLACE, F.round(haversine_km("latitude", "longitude", 0, 0), 6).alias("km"))


def _stops_sql(cap: int, region: str = REGION) -> tuple[str, str]:
    return ("stops", f"""SELECT region, seq, lat, lon, lines, avg(lat) OVER (PARTITION BY region) AS depot_lat,
  avg(lon) OVER (PARTITION BY region) AS depot_lon FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY region ORDER BY lines DESC, lat, lon) AS INT) AS seq FROM (
    SELECT {region} AS region, latitude AS lat, longitude AS lon, count(*) AS lines FROM ol GROUP BY ALL)) WHERE seq <= {cap}""")


_NODES = ("nodes", """SELECT region, seq AS i, lat, lon FROM stops
  UNION ALL SELECT DISTINCT region, 0, depot_lat, depot_lon FROM stops""")
_EDGES = ("edges", f"""SELECT a.region, a.i, b.i AS j, {hav('a.lat', 'a.lon', 'b.lat', 'b.lon')} AS km
  FROM nodes a JOIN nodes b ON a.region = b.region AND a.i <> b.i""")


def region_stops(spark, sf_dir, cap=STOPS):
    return stops.region_stops(order_lines(spark, sf_dir, [*PLACE, REGION]), REGION, cap)


@query("g2_distance_matrix", on_lines("SELECT region, i, j, round(km, 6) AS km FROM edges", _stops_sql(STOPS), _NODES, _EDGES))
def distance_matrix(spark, sf_dir):
    return rounded(stops.distance_matrix(region_stops(spark, sf_dir)))


@query("g3_time_matrix", on_lines(
    "SELECT region, i, j, CAST(floor(km / 40 * 60 + CASE WHEN j <> 0 THEN 10 ELSE 0 END) AS INT) AS minutes FROM edges",
    _stops_sql(STOPS), _NODES, _EDGES))
def time_matrix(spark, sf_dir):
    return stops.time_matrix(stops.distance_matrix(region_stops(spark, sf_dir)))


@query("g4_region_stops", on_lines(
    "SELECT region, seq, lat, lon, lines, round(depot_lat, 6) AS depot_lat, round(depot_lon, 6) AS depot_lon FROM stops",
    _stops_sql(50)))
def region_stop_list(spark, sf_dir):
    return rounded(region_stops(spark, sf_dir, 50), skip=("lat", "lon"))


@query("g5_top_regions", on_lines(
    "SELECT customer_state AS region, count(*) AS orders FROM ol GROUP BY 1 ORDER BY orders DESC, region LIMIT 10"))
def top_regions(spark, sf_dir):
    return stops.top_regions(order_lines(spark, sf_dir, [REGION]), REGION)


_AREA_SQL = "concat(customer_city, '/', customer_segment)"


@query("g10_simple_routes", on_lines(f"""
SELECT region, vehicle_id, round(d, 6) AS distance_km, num_stops, round(d / 40 * 60, 6) AS travel_time_min,
  CAST(num_stops * 10 AS DOUBLE) AS service_time_min, round(d / 40 * 60 + num_stops * 10, 6) AS total_time_min
FROM (SELECT r.region, CAST(v.v AS INT) AS vehicle_id, CASE WHEN seq IS NULL THEN 0 ELSE 1 END AS num_stops,
        CASE WHEN seq IS NULL THEN 0 ELSE 2 * {hav('depot_lat', 'depot_lon', 'lat', 'lon')} END AS d
      FROM (SELECT DISTINCT region FROM stops) r CROSS JOIN range(3) v(v)
      LEFT JOIN stops s ON s.region = r.region AND s.seq = v.v + 1)""", ("every_stop", _stops_sql(STOPS, _AREA_SQL)[1]),
                                        ("stops", "SELECT * FROM every_stop WHERE region IN (SELECT region FROM every_stop GROUP BY 1 HAVING count(*) <= 2)")))
def simple_routes(spark, sf_dir):
    """Plain routes of the areas, a city's customer segments, with no more stops than vehicles but one."""
    df = order_lines(spark, sf_dir, [*PLACE, "customer_city", "customer_segment"])
    found = cut_lineage(stops.region_stops(df.withColumn("area", F.expr(_AREA_SQL)), "area", STOPS))
    few = found.groupBy("region").count().where("count <= 2").select("region")
    return rounded(stops.simple_routes(found.join(few, "region", "left_semi")))


_ROUTES = ("routes", f"""SELECT region, vehicle_id, coalesce(sum(leg), 0) AS d, count(*) AS n FROM (
  SELECT region, vehicle_id, CASE WHEN to_lat IS NOT NULL THEN {hav('lat', 'lon', 'to_lat', 'to_lon')} END AS leg
  FROM (SELECT region, (seq - 1) % 3 AS vehicle_id, lat, lon, lead(lat) OVER w AS to_lat, lead(lon) OVER w AS to_lon
        FROM stops WINDOW w AS (PARTITION BY region, (seq - 1) % 3 ORDER BY seq))) GROUP BY ALL""")


def plain_routes(spark, sf_dir):
    """Stops dealt to three vehicles in turn and driven in stop order, without a depot."""
    dealt = region_stops(spark, sf_dir).select(
        "region", ((F.col("seq") - 1) % 3).alias("vehicle_id"), F.col("seq").alias("stop_seq"), "lat", "lon",
        F.lit(0).alias("is_depot"))
    return stops.route_rollup(dealt)


@query("g13_route_rollup", on_lines("""
SELECT region, vehicle_id, round(d, 6) AS distance_km, CAST(n AS INT) AS num_stops, round(d / 40 * 60, 6) AS travel_time_min,
  CAST(n * 10 AS DOUBLE) AS service_time_min, round(d / 40 * 60 + n * 10, 6) AS total_time_min FROM routes""",
                                    _stops_sql(STOPS), _ROUTES))
def route_rollup(spark, sf_dir):
    return rounded(plain_routes(spark, sf_dir))


@query("g16_problem_choice", on_lines("""
SELECT region, count(*) + 1 AS points, CASE WHEN count(*) + 1 <= 15 THEN 'tsp' ELSE 'vrp' END AS problem_type
FROM stops GROUP BY region""", _stops_sql(50, "concat(customer_state, '/', customer_segment)")))
def problem_choice(spark, sf_dir):
    df = order_lines(spark, sf_dir, [*PLACE, REGION, "customer_segment"])
    keyed = df.withColumn("area", F.concat(REGION, F.lit("/"), "customer_segment"))
    return stops.problem_choice(stops.region_stops(keyed, "area", 50))


@query("m8_distance_stats", on_lines("""
SELECT region, round(sum(km), 6) AS total_distance, round(avg(km) FILTER (km > 0), 6) AS avg_distance,
  round(max(km), 6) AS max_distance, round(min(km) FILTER (km > 0), 6) AS min_distance FROM edges GROUP BY region""",
                                     _stops_sql(STOPS), _NODES, _EDGES))
def distance_stats(spark, sf_dir):
    return rounded(metrics.edge_stats(stops.distance_matrix(region_stops(spark, sf_dir))))


@query("m9_route_kpis", on_lines("""
SELECT region, count(*) AS num_routes, round(sum(d), 6) AS total_distance, round(avg(d), 6) AS avg_distance_per_route,
  round(sum(d / 40 * 60 + n * 10), 6) AS total_time, round(avg(d / 40 * 60 + n * 10), 6) AS avg_time_per_route,
  CAST(sum(n) AS BIGINT) AS total_stops, round(avg(n), 6) AS avg_stops_per_route, round(max(d), 6) AS max_route_distance,
  round(min(d), 6) AS min_route_distance FROM routes GROUP BY region""", _stops_sql(STOPS), _ROUTES))
def route_kpis(spark, sf_dir):
    return rounded(metrics.route_kpis(plain_routes(spark, sf_dir), ["region"]))


# --- routes -------------------------------------------------------------------

_WALK = ("walk", """SELECT region, 0 AS step, 0 AS node, [0] AS seen FROM stops GROUP BY region
  UNION ALL SELECT region, step, j, list_append(seen, j) FROM (
    SELECT w.region, w.step + 1 AS step, e.j, w.seen, row_number() OVER (PARTITION BY w.region ORDER BY e.km, e.j) AS place
    FROM walk w JOIN edges e ON e.region = w.region AND e.i = w.node WHERE NOT list_contains(w.seen, e.j)) WHERE place = 1""")
_TOUR = ("tour", """SELECT region, step, node FROM walk UNION ALL SELECT region, max(step) + 1, 0 FROM walk GROUP BY region""")


@query("g6_nearest_neighbour", on_lines("""
SELECT tour.region, 0 AS vehicle_id, step AS stop_seq, node AS loc_seq, round(lat, 6) AS lat, round(lon, 6) AS lon, CAST(node = 0 AS INT) AS is_depot
FROM tour JOIN nodes ON nodes.region = tour.region AND nodes.i = tour.node""", _stops_sql(30), _NODES, _EDGES, _WALK, _TOUR).replace(
    "WITH ", "WITH RECURSIVE ", 1))
def nearest_neighbour(spark, sf_dir):
    return rounded(routing.tour_stops(routing.one_vehicle(region_stops(spark, sf_dir, 30)), "nearest_neighbor"))


@query("g7_two_opt")
def two_opt(spark, sf_dir):
    return routing.tour_stops(routing.one_vehicle(region_stops(spark, sf_dir, 30)))


@query("g8_method_benchmark")
def method_benchmark(spark, sf_dir):
    return routing.benchmark_methods(region_stops(spark, sf_dir, 30))


@query("g9_cluster_routes")
def cluster_routes(spark, sf_dir):
    return stops.route_rollup(routing.strategy_stops(region_stops(spark, sf_dir), "cluster_tsp"))


@query("g11_balanced")
def balanced(spark, sf_dir):
    return stops.route_rollup(routing.strategy_stops(region_stops(spark, sf_dir), "balanced"))


@query("g12_min_total")
def min_total(spark, sf_dir):
    return stops.route_rollup(routing.strategy_stops(region_stops(spark, sf_dir), "min_total"))


@query("g12_fallbacks")
def fallbacks(spark, sf_dir):
    """Which regions meet the route limit."""
    return routing.min_total_fallbacks(region_stops(spark, sf_dir))


@query("g14_strategy_benchmark")
def strategy_benchmark(spark, sf_dir):
    return routing.benchmark_strategies(routing.all_strategies(region_stops(spark, sf_dir)))


@query("g15_one_vs_many")
def one_vs_many(spark, sf_dir):
    return routing.one_vs_many(region_stops(spark, sf_dir))


@query("g17_route_stops")
def route_stops(spark, sf_dir):
    return routing.optimize_regions(region_stops(spark, sf_dir))
