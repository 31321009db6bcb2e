import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from haulmetrics.functions.geo import haversine_km
from haulmetrics.operators import clustering, warehouse

POINTS = "lat double, lon double, customers long, demand long, w double"


def make(spark, rows):
    return spark.createDataFrame([(float(a), float(b), int(c), int(d), float(d)) for a, b, c, d in rows], POINTS)


def km(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6371 * math.asin(min(1, math.sqrt(h)))


def random_points(n, seed, spread=20):
    rng = np.random.default_rng(seed)
    return [(float(a), float(b), int(c), int(d)) for a, b, c, d in zip(
        rng.uniform(-spread, spread, n), rng.uniform(-spread, spread, n), rng.integers(1, 9, n), rng.integers(1, 50, n))]


def test_haversine(spark):
    r = spark.range(1).select(haversine_km(0, 0, 0, 1).alias("d"), haversine_km(0, 0, 0, 180).alias("half")).first()
    gone = spark.range(1).select(haversine_km(0, 0, F.lit(None).cast("double"), 1).alias("d")).first()["d"]
    assert gone is None
    assert r["d"] == pytest.approx(111.195, abs=0.001) and r["half"] == pytest.approx(math.pi * 6371)


def test_demand_points_weights(spark):
    df = spark.createDataFrame([(1.0, 1.0, 10), (1.0, 1.0, 1), (2.0, 2.0, None), (None, 2.0, 5)],
                               "latitude double, longitude double, order_item_quantity int")
    rows = {r["lat"]: r for r in warehouse.demand_points(df).collect()}  # mean quantity 4
    assert (rows[1.0]["customers"], rows[1.0]["demand"], rows[1.0]["w"]) == (2, 11, 3.0)
    assert (rows[2.0]["customers"], rows[2.0]["demand"], rows[2.0]["w"]) == (1, 0, 1.0)


def test_nearest_blocks_agree(spark, monkeypatch):
    pts = make(spark, random_points(50, 3))
    sites = [(a, b) for a, b, *_ in random_points(23, 4)]
    whole = {(r["lat"], r["lon"]): r["facility_id"] for r in warehouse.nearest_facility(pts, sites).collect()}
    monkeypatch.setattr(warehouse, "FACILITIES_PER_ARRAY", 5)
    blocks = {(r["lat"], r["lon"]): r["facility_id"] for r in warehouse.nearest_facility(pts, sites).collect()}
    brute = {(a, b): min(range(23), key=lambda i: ((a - sites[i][0]) ** 2 + (b - sites[i][1]) ** 2, i)) for a, b in whole}
    assert whole == blocks == brute


def test_coverage_edge_and_union(spark):
    pts = make(spark, [(0, 0, 3, 3), (0, 1, 2, 2), (5, 5, 1, 1)])
    radius = spark.range(1).select(haversine_km(0, 0, 0, 1).alias("d")).first()["d"]
    rows = {r["facility_id"]: r for r in warehouse.coverage(pts, [(0, 0), (0, 1), (60, 60)], radius).collect()}
    assert [rows[i]["customers_in_range"] for i in (-1, 0, 1, 2)] == [5, 5, 5, 0]
    assert rows[-1]["customers_out_of_range"] == 1 and rows[-1]["coverage_pct"] == 83.33


@pytest.mark.parametrize("radius", [50, 400, 3000])
def test_coverage_by_cell_agrees(spark, radius):
    rng = np.random.default_rng(radius)
    pts = make(spark, [(a, b, 1, 1) for a, b in zip(rng.uniform(-89.9, 89.9, 400), rng.uniform(-180, 180, 400))]
               + [(0, 179.9, 1, 1), (0, -179.9, 1, 1), (89.95, 10, 1, 1)])
    sites = [(float(a), float(b)) for a, b in zip(rng.uniform(-89, 89, 20), rng.uniform(-180, 180, 20))]
    sites += [(0.0, 179.95), (89.9, -170.0), (-89.99, 0.0)]

    def hits(df):
        return {(r["lat"], r["lon"]): sorted(r["hits"]) for r in df.collect()}
    assert hits(warehouse._in_range_by_cell(pts, sites, radius)) == hits(warehouse._in_range(pts, sites, radius))


def test_coverage_grows_with_radius(spark):
    pts, sites = make(spark, random_points(80, 5)), [(0.0, 0.0), (10.0, 10.0)]
    seen = [warehouse.coverage(pts, sites, r).where("facility_id = -1").first()["customers_in_range"] for r in (100, 500, 1500)]
    assert seen == sorted(seen)


@pytest.mark.parametrize("block", [10_000, 4])
def test_p_median_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(warehouse, "SETS_PER_BLOCK", block)
    rows, sites = random_points(40, 6), [(a, b) for a, b, *_ in random_points(9, 7)]

    def cost(chosen):
        return sum(d * min(km((a, b), sites[j]) for j in chosen) for a, b, _, d in rows)
    best = min(itertools.combinations(range(9), 3), key=cost)
    chosen, objective = warehouse.p_median_sites(make(spark, rows), sites, 3)
    assert chosen == best and objective == pytest.approx(cost(best))
    swapped, value = warehouse.p_median_sites(make(spark, rows), sites, 3, method="exchange")
    assert value >= objective - 1e-6 and value == pytest.approx(cost(swapped))
    for out, new in itertools.product(swapped, range(9)):  # no exchange helps any more
        if new not in swapped:
            assert cost(set(swapped) - {out} | {new}) >= value * (1 - 1e-9)


def test_missing_quantities(spark):
    """A line without a quantity has demand 0, 1 or is left out, as asked for."""
    df = spark.createDataFrame([(0.0, 0.0, 2), (4.0, 0.0, None)], "latitude double, longitude double, order_item_quantity int")
    demand = {m: sorted(r["demand"] for r in warehouse.demand_points(df, missing=m).collect()) for m in ("zero", "one", "drop")}
    assert demand == {"zero": [0, 2], "one": [1, 2], "drop": [2]}
    row = warehouse.center_of_gravity(warehouse.demand_points(df, missing="drop")).first()
    assert (row["total_customers"], row["avg_distance_km"]) == (1, 0.0)


def test_candidates_are_spaced(spark):
    df = spark.range(100).selectExpr("CAST(id AS DOUBLE) AS latitude", "CAST(100 - id AS DOUBLE) AS longitude")
    assert [a for a, _ in warehouse.candidate_sites(df, 4)] == [0.0, 33.0, 66.0, 99.0]
    hot = spark.range(100).selectExpr("5D AS latitude", "CAST(id AS DOUBLE) AS longitude")
    assert warehouse.candidate_sites(hot, 4) == [(5.0, 0.0)]


def inertia(rows, centers):
    return sum(w * min((a - y) ** 2 + (b - x) ** 2 for y, x in centers) for a, b, w in rows)


def test_kmeans_finds_the_best_split(spark):
    rng = np.random.default_rng(8)
    rows = [(float(c + rng.normal(0, .1)), float(-c + rng.normal(0, .1)), float(rng.integers(1, 5))) for c in (0, 5, 9) for _ in range(4)]
    df = spark.createDataFrame(rows, "lat double, lon double, w double")
    got = clustering.best_kmeans(df, [2, 3])

    def best(k):  # every labelling of the 12 points by the cluster they were drawn from and beyond
        options = []
        for labels in itertools.product(range(k), repeat=3):
            if len(set(labels)) == k:
                centers = []
                for c in range(k):
                    part = np.array([r for i, r in enumerate(rows) if labels[i // 4] == c])
                    centers.append(tuple(np.average(part[:, :2], axis=0, weights=part[:, 2])))
                options.append(inertia(rows, centers))
        return min(options)
    for k in (2, 3):
        assert inertia(rows, got[k].centers) == pytest.approx(best(k), rel=1e-6)


@pytest.mark.parametrize("limit", [32 << 20, 0])
def test_grouped_kmeans_both_joins(spark, monkeypatch, limit):
    """Broadcast and salted joins give the same centres; costs match separate runs."""
    monkeypatch.setattr(clustering, "BROADCAST_BYTES", limit)
    rng = np.random.default_rng(9)
    rows = [(g, float(c + rng.normal(0, .2)), float(rng.normal(0, .2)), 1.0) for g in "ab" for c in (0, 10) for _ in range(10)]
    rows += [("one", 1.0, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "region string, lat double, lon double, w double")
    centers = {r["region"]: [(c["lat"], c["lon"]) for c in r["centers"]] for r in clustering.grouped_kmeans(df, "region", 2).collect()}
    assert centers["one"] == [(1.0, 1.0)]
    for g in "ab":
        mine = [r[1:] for r in rows if r[0] == g]
        split = [np.mean([p[:2] for p in mine if (p[0] > 5) == side], axis=0) for side in (False, True)]
        assert np.array(sorted(centers[g])) == pytest.approx(np.array(sorted(map(tuple, split))))


def test_regions_skip_tiny_and_null(spark):
    rows = [("big", float(i % 4), float(i % 3), 1) for i in range(20)] + [("tiny", 1.0, 1.0, 1)] * 9 + [(None, 1.0, 1.0, 1)] * 20
    df = spark.createDataFrame(rows, "order_region string, latitude double, longitude double, order_item_quantity int")
    out = warehouse.by_region(df)
    assert {r["order_region"] for r in out.collect()} == {"big"}
    s = warehouse.region_summary(out).first()
    assert (s["total_regions"], s["total_facilities"], s["total_customers"]) == (1, 2, 20)


def test_scenarios_skip_large_counts(spark):
    out = warehouse.compare_counts(make(spark, [(a, b, 1, d) for a, b, _, d in random_points(40, 10)]), (3, 4, 10))
    assert {r["n_facilities"] for r in out.collect()} == {3, 4}
    r = out.where("is_best = 1").first()
    assert r["total_system_cost"] == pytest.approx(r["n_facilities"] * 50_000 + r["total_distance_km"])


def test_center_of_gravity(spark):
    r = warehouse.center_of_gravity(make(spark, [(0, 0, 1, 1), (0, 4, 1, 3)])).first()
    assert (r["latitude"], r["longitude"], r["total_demand"]) == (0.0, 3.0, 4)
    assert r["weighted_avg_distance_km"] == pytest.approx((km((0, 0), (0, 3)) + 3 * km((0, 4), (0, 3))) / 4, abs=0.01)


def test_repartition_does_not_matter(spark):
    pts = make(spark, random_points(60, 11))
    sites = [(0.0, 0.0), (5.0, 5.0)]
    a = warehouse.facility_stats(pts, sites).orderBy("facility_id").collect()
    b = warehouse.facility_stats(pts.repartition(6, F.col("lon")), sites).orderBy("facility_id").collect()
    for x, y in zip(a, b):
        assert tuple(x) == pytest.approx(tuple(y))
