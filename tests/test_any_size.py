"""Codes, areas, quantiles, samples and facility joins that no task or driver sees whole, against plain versions."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from haulmetrics.functions import grouped_quantiles as gq, labels, ranks
from haulmetrics.operators import facility_tables, preprocess as prep, risk, warehouse
from haulmetrics.plans import place_queries
from haulmetrics.sources import star
from haulmetrics.sources.quality import hash_sample


def test_prefix_sums_over_null_keys_and_many_parts(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), i, rng.randrange(5)) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, at long, n long").repartition(9)
    got = {(r["k"], r["at"]): r["before_n"] for r in ranks.prefix_sums(df, ["k"], ["at"], ["n"]).collect()}
    assert got == {(k, at): sum(m for q, b, m in rows if q == k and b < at) for k, at, _ in rows}


@pytest.mark.parametrize("literal", [0, 100])
def test_codes_of_short_and_long_dictionaries(spark, literal):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 10), ("ü", None), ("a", 2)], "c string, d int")
    fitted = labels.fit_labels(df, ["c", "d", "missing"], literal_levels=literal)
    assert bool(fitted.tables) == (literal == 0)
    new = spark.createDataFrame([("b", 10), ("z", 2), (None, None), ("ü", 7)], "c string, d int")
    got = sorted((str(r["c"]), r["c_encoded"], r["d_encoded"]) for r in fitted.apply(new).collect())
    # Numbers are compared as text: 1, 10, 2.
    assert got == [("None", -1, -1), ("b", 1, 1), ("z", -1, 2), ("ü", 2, -1)]


def test_a_hundred_thousand_levels_stay_in_tables(spark):
    df = spark.range(100_000).select(F.format_string("c%06d", (F.col("id") * 7919) % 100_000).alias("c"), "id")
    fitted = labels.fit_labels(df, ["c"])
    assert not fitted.levels and fitted.tables["c"].count() == 100_000
    wrong = fitted.apply(df).where(F.col("c_encoded") != F.substring("c", 2, 6).cast("int"))
    assert wrong.isEmpty()


def test_one_hot_of_too_many_levels_gives_codes(spark, monkeypatch):
    monkeypatch.setattr(prep.category_levels, "__defaults__", (3,))
    df = spark.createDataFrame([("b", "x"), ("a", "y"), ("d", "x"), ("c", None)], "market string, shipping_mode string")
    out = prep.preprocess(df, ["encode_categorical"]).data
    assert out.columns == ["market", "shipping_mode", "shipping_mode_y", "market_encoded"]
    assert {r["market"]: (r["shipping_mode_y"], r["market_encoded"]) for r in out.collect()} == {
        "a": (1, 0), "b": (0, 1), "c": (0, 2), "d": (0, 3)}


def test_areas_of_many_models(spark):
    rng = random.Random(2)
    rows = [(m, rng.randrange(2), rng.choice([None, *range(9)]) if m != "fine" else rng.random() * 8) for m in ("coarse", "fine") for _ in range(200)]
    rows += [("one class", 1, 0.5), ("one class", 1, 0.7)]
    df = spark.createDataFrame([(m, y, None if s is None else float(s)) for m, y, s in rows], "model string, late_delivery_risk int, score double")
    got = {r["model"]: r["roc_auc"] for r in risk.roc_auc_by(df).collect()}
    for m in ("coarse", "fine"):
        late, timely = ([s for q, y, s in rows if q == m and y == k and s is not None] for k in (1, 0))
        assert got[m] == pytest.approx(np.mean([(a > b) + 0.5 * (a == b) for a in late for b in timely]))
    assert got["one class"] is None


@pytest.mark.parametrize("margin", [gq.MARGIN, -0.01])
def test_quantiles_per_key(spark, monkeypatch, margin):
    """A negative margin draws brackets that miss their ranks, which are then looked for everywhere."""
    monkeypatch.setattr(gq, "MARGIN", margin)
    monkeypatch.setattr(gq, "SMALL_KEY", 300)
    rng = np.random.default_rng(3)
    data = {"wide": rng.normal(size=4000), "ties": rng.integers(0, 4, 2000).astype(float), None: rng.random(50), "one": np.array([5.0])}
    rows = [(k, float(v)) for k, vs in data.items() for v in vs] + [("none", None), ("one", float("nan")), ("one", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    shares = {"low": 0.0, "q1": 0.25, "mid": 0.5, "q99": 0.99, "top": 1.0}
    got = {r["k"]: r for r in gq.grouped_quantiles(df, ["k"], "v", shares).collect()}
    assert set(got) == {*data, "none"} and got["none"]["n"] == 0 and got["none"]["mid"] is None
    for k, vs in data.items():
        assert got[k]["n"] == len(vs)
        assert [got[k][s] for s in shares] == pytest.approx(np.quantile(vs, list(shares.values())))
    assert gq.grouped_quantiles(df.limit(0), ["k"], "v", shares).count() == 0


def test_large_samples_equal_sorted_ones(spark):
    df = spark.range(3000).select((F.col("id") % 2500).alias("k"), "id")
    for n in (0, 7, 1000, 2999, 5000):
        plain = sorted(r["k"] for r in hash_sample(df, "k", n, sorted_rows=10_000).collect())
        assert sorted(r["k"] for r in hash_sample(df, "k", n, sorted_rows=5).collect()) == plain and len(plain) == min(n, 3000)


# --- facilities as a table ------------------------------------------------------

def places(seed, n):
    """A dense town, a scattered rest, the date line and the poles."""
    rng = random.Random(seed)
    spots = [(48 + rng.gauss(0, 0.2), 11 + rng.gauss(0, 0.2)) for _ in range(n // 2)]
    spots += [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(n // 3)]
    spots += [(rng.uniform(-10, 10), rng.choice([-179.9, 179.9])) for _ in range(n // 10)] + [(90.0, 0.0), (-90.0, 10.0), (89.9, 179.0)]
    return sorted({(round(a, 3), round(b, 3)) for a, b in spots})


@pytest.fixture(scope="module")
def both(spark):
    sites, spots = places(4, 400), places(5, 500)
    table = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(sites)] + [(None, 1.0, 1.0), (9999, None, 1.0)], "id long, lat double, lon double")
    points = spark.createDataFrame([(a, b, 1 + i % 3, i % 7) for i, (a, b) in enumerate(spots)], "lat double, lon double, customers long, demand long")
    return sites, table, points


def listed(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_nearest_of_a_table_equals_the_list(spark, both):
    sites, table, points = both
    columns = ("lat", "lon", "facility_id", "facility_lat", "facility_lon")
    assert listed(facility_tables.nearest_of_table(points, table), *columns) == listed(warehouse.nearest_facility(points, sites), *columns)
    stats = ("facility_id", "customers_served", "total_demand")
    assert listed(facility_tables.facility_stats_of_table(points, table), *stats) == listed(warehouse.facility_stats(points, sites), *stats)
    nowhere = spark.createDataFrame([(None, 1.0, 1, 1)], points.schema)
    assert listed(facility_tables.nearest_of_table(nowhere, table), "facility_id") == [(None,)]
    assert {r["facility_id"] for r in facility_tables.nearest_of_table(points, table.limit(0)).collect()} == {None}


@pytest.mark.parametrize("radius", [5.0, 400.0, 9000.0])
def test_coverage_of_a_table_equals_the_list(both, radius):
    sites, table, points = both
    columns = ("facility_id", "customers_in_range", "coverage_pct", "customers_out_of_range")
    assert listed(facility_tables.coverage_of_table(points, table, radius), *columns) == listed(warehouse.coverage(points, sites, radius), *columns)


def test_very_many_facilities(spark):
    """A hundred thousand facilities on a grid; every point's nearest is known."""
    table = spark.range(100_000).selectExpr("id", "CAST(id DIV 400 AS DOUBLE) / 10 AS lat", "CAST(id % 400 AS DOUBLE) / 10 AS lon")
    points = spark.range(2_000).selectExpr("CAST(id * 37 % 250 AS DOUBLE) / 10 + 0.03 AS lat", "CAST(id * 91 % 400 AS DOUBLE) / 10 - 0.04 AS lon",
                                           "id * 37 % 250 * 400 + id * 91 % 400 AS expected")
    assert facility_tables.nearest_of_table(points, table).where("facility_id <> expected").isEmpty()


# --- interchange ----------------------------------------------------------------

def cost(points, sites, chosen):
    km = warehouse.km_matrix(*(np.array(x) for x in zip(*((a, b) for a, b, _ in points))), np.array(sites, float))
    return float((km[:, list(chosen)].min(axis=1) * np.array([d for *_, d in points])).sum())


def test_terms_of_all_swaps_equal_plain_costs(spark):
    rng = random.Random(6)
    points = [(rng.uniform(-50, 50), rng.uniform(-50, 50), rng.randrange(1, 9)) for _ in range(60)]
    sites = [(rng.uniform(-50, 50), rng.uniform(-50, 50)) for _ in range(8)]
    df = spark.createDataFrame(points, "lat double, lon double, demand long").repartition(4)
    for chosen in ([2], [1, 5], [0, 3, 7]):
        terms = warehouse.swap_terms(df, sites, chosen)
        assert terms.cost == pytest.approx(cost(points, sites, chosen))
        for (i, out), new in itertools.product(enumerate(chosen), set(range(8)) - set(chosen)):
            swapped = [c for c in chosen if c != out] + [new]
            profit = terms.gain[new] - terms.loss[i] + terms.extra[i, new]
            assert terms.cost - profit == pytest.approx(cost(points, sites, swapped))
    chosen, value = warehouse.p_median_sites(df, sites, 3, method="exchange")
    assert value == pytest.approx(cost(points, sites, chosen))
    with pytest.raises(ValueError, match="56 sets"):
        warehouse.p_median_sites(df, sites, 3, max_sets=55)
    assert warehouse.p_median_sites(df, sites, 8, method="exchange")[0] == tuple(range(8))
    assert math.isfinite(warehouse.p_median_sites(df.limit(0), sites, 2, method="exchange")[1])


def test_candidate_sites_count_latitudes_and_join_lines_once(spark, small, monkeypatch):
    rng = random.Random(4)
    rows = [(float(rng.randrange(40)), rng.random()) for _ in range(700)] + [(None, 1.0), (3.0, None)]
    df = spark.createDataFrame(rows, "latitude double, longitude double").repartition(7)
    placed = sorted(r for r in rows if None not in r)
    for m in (1, 2, 7, 60):
        ranks = [i * (len(placed) - 1) // (m - 1) for i in range(m)] if m > 1 else [0]
        lats = {placed[r][0] for r in ranks}
        assert warehouse.candidate_sites(df, m) == [(a, min(y for x, y in placed if x == a)) for a in sorted(lats)]
    assert warehouse.candidate_sites(df.limit(0)) == []
    read = []
    monkeypatch.setattr(place_queries, "order_lines", lambda *a, **k: read.append(a) or star.order_lines(*a, **k))
    assert place_queries.p_median_exchange(spark, small).count() == 10 and len(read) == 1
