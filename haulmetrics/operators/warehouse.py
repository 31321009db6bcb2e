"""Warehouse placement: weighted clustering, centre of gravity, p-median, coverage.

Order lines are first collapsed to distinct locations with their line count and demand.
That loses nothing (all measures are sums over lines) and shrinks the iterative work.
Facility lists are short parameters or model results; their distances are expressions
inside the scan, so no join with the locations takes place.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from haulmetrics.functions.exprs import dbl, ratio
from haulmetrics.functions.geo import facility_array, haversine_km, nearest_in
from haulmetrics.functions.ranks import prefix_sums
from haulmetrics.operators.clustering import STARTS, best_kmeans, grouped_kmeans, join_groups
from haulmetrics.operators.scenarios import rank_scenarios
from haulmetrics.operators.tours import km_matrix
from haulmetrics.schema import EARTH_RADIUS_KM, FACILITY_COST, SEED, TRANSPORT_COST_PER_KM
from haulmetrics.session import cut_lineage

FACILITIES_PER_ARRAY = 200
# Candidate sets whose costs one task adds up at once, and points compared with them at once.
SETS_PER_BLOCK = 10_000
POINTS_PER_BLOCK = 512

Places = Sequence[tuple[float, float]]


def demand_points(df: DataFrame, by: Sequence[str] = (), quantity: str = "order_item_quantity",
                  lat: str = "latitude", lon: str = "longitude", missing: str = "zero") -> DataFrame:
    """Distinct locations (lat, lon) with ``customers`` (lines), ``demand`` and weight ``w``.

    ``missing`` says what the demand of a line without a quantity is: ``zero``, ``one``, or
    ``drop`` to leave such lines out. ``w`` adds max(1, floor(quantity / mean quantity)) per
    line, a missing quantity counting as 1; the mean is taken per ``by`` group.
    """
    if missing not in ("zero", "one", "drop"):
        raise ValueError(f"unknown treatment of missing quantities: {missing}")
    placed = df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    if missing == "drop":
        placed = placed.where(F.col(quantity).isNotNull())
    # Lines per (place, quantity) first: a busy place becomes one row per quantity value.
    counts = placed.groupBy(*by, F.col(lat).alias("lat"), F.col(lon).alias("lon"), F.coalesce(F.col(quantity), F.lit(1)).alias("q"),
                            F.col(quantity).isNull().alias("q_missing")).agg(F.count(F.lit(1)).alias("n"))
    # The means follow from the counts, whose shuffle both sides of the join share; a few rows
    # that adaptive execution broadcasts once their size is measured.
    key = list(by) or [F.lit(1).alias("_all")]
    mean = counts.groupBy(*key).agg((F.sum(F.col("q") * F.col("n")) / F.sum("n")).alias("mean_q"))
    weighed = counts.join(mean, list(by)) if by else counts.withColumn("_all", F.lit(1)).join(mean, "_all")
    share = F.floor(dbl("q") / F.col("mean_q"))
    demand = F.when(F.col("q_missing") & F.lit(missing == "zero"), F.lit(0)).otherwise(F.col("q"))
    return weighed.groupBy(*by, "lat", "lon").agg(
        F.sum("n").alias("customers"), F.sum(demand * F.col("n")).cast("bigint").alias("demand"),
        dbl(F.sum(F.greatest(F.lit(1), share) * F.col("n"))).alias("w"))


def nearest_facility(points: DataFrame, facilities: Places) -> DataFrame:
    """Points with ``facility_id, facility_lat, facility_lon``: nearest by degrees.

    Long lists are compared block by block against the best so far, still without a join.
    """
    best = None
    for start in range(0, len(facilities), FACILITIES_PER_ARRAY):
        block = nearest_in(facility_array(facilities[start:start + FACILITIES_PER_ARRAY], start), "lat", "lon")
        best = block if best is None else F.least(best, block)
    return points.withColumn("_f", best).select(
        *points.columns, F.col("_f.id").alias("facility_id"), F.col("_f.lat").alias("facility_lat"),
        F.col("_f.lon").alias("facility_lon"))


def distance_stats(assigned: DataFrame, by: Sequence[str]) -> DataFrame:
    """Figures of each facility from points with ``facility_id, facility_lat, facility_lon``."""
    km = haversine_km("lat", "lon", "facility_lat", "facility_lon")
    return (assigned.withColumn("km", km).groupBy(*by, "facility_id", F.col("facility_lat").alias("latitude"),
                                                  F.col("facility_lon").alias("longitude"))
            .agg(F.sum("customers").alias("customers_served"), F.sum("demand").alias("total_demand"),
                 (F.sum(F.col("km") * F.col("customers")) / F.sum("customers")).alias("avg_distance_km"),
                 ratio(F.sum(F.col("km") * F.col("demand")), F.sum("demand")).alias("weighted_avg_distance_km"),
                 F.max("km").alias("max_distance_km"),
                 F.sum(F.col("km") * F.col("customers")).alias("total_distance_km")))


def facility_stats(points: DataFrame, facilities: Places) -> DataFrame:
    """Customers, demand and km figures of each facility that serves any point."""
    return distance_stats(nearest_facility(points, facilities), [])


def facility_totals(stats: DataFrame, n_facilities: int) -> DataFrame:
    """One row over all facilities: customers, total and mean km per order, cost of the facilities."""
    return stats.agg(F.sum("customers_served").alias("total_customers"), F.sum("total_distance_km").alias("total_distance_km"),
                     (F.sum("total_distance_km") / F.sum("customers_served")).alias("avg_distance_per_order_km")).select(
        F.lit(n_facilities).alias("n_facilities"), "*", F.lit(float(n_facilities * FACILITY_COST)).alias("facility_cost"))


def kmeans_sites(points: DataFrame, ks: Sequence[int], weight_by_demand: bool = True, starts: int = 10,
                 seed: int = SEED) -> dict[int, list[tuple[float, float]]]:
    """Facility places at weighted K-means centres for each facility count."""
    weighted = points.select("lat", "lon", F.col("w" if weight_by_demand else "customers").cast("double").alias("w"))
    best = best_kmeans(weighted, ks, starts, seed)
    return {k: sorted((float(a), float(b)) for a, b in run.centers) for k, run in best.items()}


def kmeans_location(points: DataFrame, k: int = 5, weight_by_demand: bool = True, starts: int = 10,
                    seed: int = SEED) -> DataFrame:
    """Statistics of k facilities at weighted K-means centres."""
    points = points.persist()
    try:
        if points.limit(k).count() < k:
            raise ValueError(f"too few locations for {k} facilities")
        sites = kmeans_sites(points, [k], weight_by_demand, starts, seed)[k]
        return cut_lineage(facility_stats(points, sites))
    finally:
        points.unpersist()


def center_of_gravity(points: DataFrame) -> DataFrame:
    """Demand-weighted centroid and the distances to it, one row.

    Lines without a quantity have no weight to give: take points with ``missing="drop"``.
    """
    weight = dbl("demand")
    row = points.agg(F.sum(F.col("lat") * weight).alias("y"), F.sum(F.col("lon") * weight).alias("x"),
                     F.sum(weight).alias("w")).first()
    if not row["w"]:
        raise ValueError("no located demand")
    lat, lon = row["y"] / row["w"], row["x"] / row["w"]
    km, n = haversine_km("lat", "lon", lat, lon), F.col("customers")
    return points.withColumn("km", km).agg(
        F.lit(round(lat, 6)).alias("latitude"), F.lit(round(lon, 6)).alias("longitude"),
        F.sum(n).alias("total_customers"), F.sum("demand").alias("total_demand"),
        F.round(F.sum(F.col("km") * n) / F.sum(n), 2).alias("avg_distance_km"),
        F.round(F.sum(F.col("km") * F.col("demand")) / F.sum("demand"), 2).alias("weighted_avg_distance_km"),
        F.round(F.max("km"), 2).alias("max_distance_km"),
        F.round(F.sum(F.col("km") * n), 2).alias("total_distance_km"))


# --- p-median -----------------------------------------------------------------

def candidate_sites(df: DataFrame, m: int = 30, lat: str = "latitude", lon: str = "longitude") -> list[tuple[float, float]]:
    """Sites of m lines evenly spaced in latitude order; the smallest longitude stands for
    a latitude. Repeated sites count once, so fewer than m may come back."""
    placed = df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    # Lines are counted per latitude, so ranks are looked up among latitudes and not line by line.
    counts = placed.groupBy(F.lit(1).alias("_all"), dbl(lat).alias("lat")).agg(F.count(F.lit(1)).alias("n"), F.min(lon).alias("lon"))
    ranked = cut_lineage(prefix_sums(counts, ["_all"], ["lat"], ["n"]))
    lines = ranked.agg(F.sum("n")).first()[0] or 0
    shares = [Fraction(i, m - 1) for i in range(m)] if m > 1 else [Fraction(0)]
    ranks = F.array(*[F.lit(rank) for rank in sorted({math.floor(p * (lines - 1)) for p in shares})])
    wanted = F.exists(ranks, lambda rank: (rank >= F.col("before_n")) & (rank < F.col("before_n") + F.col("n")))
    return sorted((r["lat"], r["lon"]) for r in ranked.where(wanted).select("lat", "lon").collect())


def cheapest_set(points: DataFrame, sites: Places, sets: Sequence[Sequence[int]]) -> tuple[tuple[int, ...], float]:
    """The set of site numbers with the least demand x km to its nearest site, the first of equals.

    Every task folds its own points into one cost for each set, block by block; blocks are
    added up and give their best set, so no pair of point and set is ever a row and the
    driver sees one row per block.
    """
    places = np.array(sites, dtype=float)
    members = np.array(sets, dtype=np.int16)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(members))
        for batch in batches:
            for start in range(0, len(batch), POINTS_PER_BLOCK):
                part = batch.iloc[start:start + POINTS_PER_BLOCK]
                # One row per site: picking a set's sites copies whole rows.
                km = np.ascontiguousarray(km_matrix(part["lat"].to_numpy(), part["lon"].to_numpy(), places).T)
                demand = part["demand"].to_numpy(dtype=float)
                for at in range(0, len(members), 1_000):
                    some = members[at:at + 1_000]
                    nearest = km[some[:, 0]]
                    for j in range(1, some.shape[1]):
                        np.minimum(nearest, km[some[:, j]], out=nearest)
                    total[at:at + 1_000] += nearest @ demand
        blocks = range(0, len(total), SETS_PER_BLOCK)
        yield pd.DataFrame({"block": blocks, "costs": [total[b:b + SETS_PER_BLOCK].tobytes() for b in blocks]})

    def add(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        costs = sum(np.frombuffer(c) for c in parts["costs"])
        return pd.DataFrame({"set_id": [key[0] + int(costs.argmin())], "objective": [costs.min()]})
    partial = points.select("lat", "lon", "demand").mapInPandas(fold, "block int, costs binary")
    best = partial.groupBy("block").applyInPandas(add, "set_id int, objective double")
    row = best.agg(F.min(F.struct("objective", "set_id")).alias("b")).first()["b"]
    return tuple(int(j) for j in members[row["set_id"]]), row["objective"]


# Sets of sites that ``exact`` scores at most.
MAX_SETS = 200_000


@dataclass
class SwapTerms:
    """What changes of the open sites cost, for all changes at once.

    Opening site j saves ``gain[j]``; closing open site i costs ``loss[i]``; doing both saves
    ``extra[i, j]`` more than the two together, as points of i may go to j.
    """
    cost: float
    gain: np.ndarray
    loss: np.ndarray
    extra: np.ndarray


def swap_terms(points: DataFrame, sites: Places, chosen: Sequence[int]) -> SwapTerms:
    """One pass over the points: each knows its nearest and second-nearest open site.

    Tasks fold their points into one row of sums for each open site, so the work is points
    times candidates, and the driver gets as many numbers as there are swaps.
    """
    places = np.array(sites, dtype=float)
    order = list(chosen)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cost, gain = 0.0, np.zeros(len(places))
        loss, extra = np.zeros(max(1, len(order))), np.zeros((max(1, len(order)), len(places)))
        for batch in batches:
            for start in range(0, len(batch), POINTS_PER_BLOCK):
                part = batch.iloc[start:start + POINTS_PER_BLOCK]
                km = km_matrix(part["lat"].to_numpy(), part["lon"].to_numpy(), places)
                demand = part["demand"].to_numpy(dtype=float)
                if not order:
                    gain -= demand @ km
                    continue
                open_km = km[:, order]
                nearest = open_km.argmin(axis=1)
                first = open_km[np.arange(len(part)), nearest]
                open_km[np.arange(len(part)), nearest] = np.inf
                second = open_km.min(axis=1)
                cost += demand @ first
                gain += demand @ np.maximum(first[:, None] - km, 0)
                alone = np.isinf(second)
                np.add.at(loss, nearest, demand * np.where(alone, 0, second - first))
                between = np.where(alone[:, None], np.minimum(first[:, None] - km, 0),
                                   np.maximum(second[:, None] - np.maximum(km, first[:, None]), 0))
                np.add.at(extra, nearest, demand[:, None] * between)
        yield pd.DataFrame({"i": range(len(loss)), "loss": loss, "extra": [e.tobytes() for e in extra],
                            "cost": [cost] + [0.0] * (len(loss) - 1), "gain": [gain.tobytes()] + [b""] * (len(loss) - 1)})

    def add(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        total = lambda column: sum(np.frombuffer(x) for x in parts[column] if x)
        gain = total("gain") if key[0] == 0 else np.zeros(0)
        return pd.DataFrame({"i": [key[0]], "loss": [parts["loss"].sum()], "extra": [total("extra").tobytes()],
                             "cost": [parts["cost"].sum()], "gain": [gain.tobytes()]})
    schema = "i int, loss double, extra binary, cost double, gain binary"
    partial = points.select("lat", "lon", "demand").mapInPandas(fold, schema)
    rows = sorted(partial.groupBy("i").applyInPandas(add, schema).collect(), key=lambda r: r["i"])
    return SwapTerms(rows[0]["cost"], np.frombuffer(rows[0]["gain"]), np.array([r["loss"] for r in rows]),
                     np.stack([np.frombuffer(r["extra"]) for r in rows]))


def p_median_sites(points: DataFrame, sites: Places, p: int, method: str = "exact",
                   max_sets: int = MAX_SETS) -> tuple[tuple[int, ...], float]:
    """Site numbers of the chosen set and its objective.

    ``exact`` scores every set of p sites and refuses if there are more than ``max_sets``;
    ``exchange`` adds sites greedily and then swaps one for one while that helps, each step
    one pass that values all candidates.
    """
    m = len(sites)
    if m < p:
        raise ValueError(f"{m} candidate sites are too few for {p} facilities")
    if method not in ("exact", "exchange"):
        raise ValueError(f"unknown method {method}")
    if method == "exact" and math.comb(m, p) > max_sets:
        raise ValueError(f"{math.comb(m, p)} sets of {p} of {m} sites are more than {max_sets}; use method=\"exchange\"")
    # Few rows with much work each: spread them by the cores, not by their bytes.
    points = points.repartition(points.sparkSession.sparkContext.defaultParallelism).persist()
    try:
        if method == "exact":
            return cheapest_set(points, sites, list(itertools.combinations(range(m), p)))
        chosen: list[int] = []
        while len(chosen) < p:
            gain = swap_terms(points, sites, chosen).gain.copy()
            gain[chosen] = -np.inf
            chosen.append(int(gain.argmax()))
        while True:
            chosen.sort()
            terms = swap_terms(points, sites, chosen)
            profit = terms.gain - terms.loss[:, None] + terms.extra
            profit[:, chosen] = -np.inf
            out, new = np.unravel_index(int(profit.argmax()), profit.shape)
            if p == m or profit[out, new] <= terms.cost * 1e-12:
                return tuple(chosen), terms.cost
            chosen[out] = int(new)
    finally:
        points.unpersist()


def nearest_by_km(points: DataFrame, facilities: Places) -> DataFrame:
    """As ``nearest_facility`` but by great-circle distance, for p-median assignment."""
    options = F.array(*[F.struct(haversine_km("lat", "lon", lat, lon).alias("km"), F.lit(i).alias("id"),
                                 F.lit(float(lat)).alias("lat"), F.lit(float(lon)).alias("lon"))
                        for i, (lat, lon) in enumerate(facilities)])
    return points.withColumn("_f", F.array_min(options)).select(
        *points.columns, F.col("_f.id").alias("facility_id"), F.col("_f.lat").alias("facility_lat"),
        F.col("_f.lon").alias("facility_lon"))


def p_median(points: DataFrame, sites: Places, p: int = 5, method: str = "exact", max_sets: int = MAX_SETS) -> DataFrame:
    """Statistics of the chosen sites with the objective on every row; points with ``missing="one"``."""
    # The search and the statistics read the points; what made them runs once.
    points = cut_lineage(points)
    chosen, objective = p_median_sites(points, sites, p, method, max_sets)
    opened = [sites[j] for j in chosen]
    return distance_stats(nearest_by_km(points, opened), []).withColumn("objective", F.lit(objective))


# --- coverage -----------------------------------------------------------------

def _in_range(points: DataFrame, facilities: Places, radius_km: float) -> DataFrame:
    """Points with ``hits``, the facility ids within the radius."""
    near = F.array(*[F.when(haversine_km("lat", "lon", lat, lon) <= radius_km, F.lit(i))
                     for i, (lat, lon) in enumerate(facilities)])
    return points.withColumn("hits", F.array_compact(near))


def _in_range_by_cell(points: DataFrame, facilities: Places, radius_km: float) -> DataFrame:
    """The same for long facility lists: a join on grid cells the radius can reach."""
    size = max(math.degrees(radius_km / EARTH_RADIUS_KM), 1e-6) * 1.0001
    columns = max(1, int(360 // size))
    width = 360.0 / columns
    cells = []
    for i, (lat, lon) in enumerate(facilities):
        for row in range(math.floor((lat - size) / size), math.floor((lat + size) / size) + 1):
            # widest longitude reach inside the circle
            steep = math.sin(min(radius_km / EARTH_RADIUS_KM * 1.0001, math.pi / 2)) / max(math.cos(math.radians(lat)), 1e-9)
            reach = 180.0 if abs(lat) + size >= 90 or steep >= 1 else math.degrees(math.asin(steep))
            first, last = math.floor((lon + 180 - reach) / width), math.floor((lon + 180 + reach) / width)
            spread = range(columns) if last - first + 1 >= columns else range(first, last + 1)
            cells += [(row, c % columns, i, float(lat), float(lon)) for c in spread]
    grid = points.sparkSession.createDataFrame(
        sorted(set(cells)), "cell_y int, cell_x int, id int, f_lat double, f_lon double")
    placed = (points.withColumn("cell_y", F.floor(F.col("lat") / size).cast("int"))
              .withColumn("cell_x", F.pmod(F.floor((F.col("lon") + 180) / width), F.lit(columns)).cast("int")))
    hits = (placed.join(grid, ["cell_y", "cell_x"])
            .where(haversine_km("lat", "lon", "f_lat", "f_lon") <= radius_km)
            .groupBy("lat", "lon").agg(F.collect_set("id").alias("hits")))
    return points.join(hits, ["lat", "lon"], "left").withColumn("hits", F.coalesce("hits", F.array().cast("array<int>")))


def coverage(points: DataFrame, facilities: Places, radius_km: float = 100.0) -> DataFrame:
    """Customers within the radius per facility, and a row of facility -1 for their union.

    A facility without customers in range is listed with 0.
    """
    method = _in_range if len(facilities) <= FACILITIES_PER_ARRAY else _in_range_by_cell
    hit = method(points, facilities, radius_km)
    # Every point counts once for the total (-2), once for the union (-1) and per hit.
    marks = F.concat(F.array(F.lit(-2)), F.when(F.size("hits") > 0, F.array(F.lit(-1)))
                     .otherwise(F.array().cast("array<int>")), "hits")
    counts = hit.select(F.explode(marks).alias("facility_id"), "customers").groupBy("facility_id").agg(
        F.sum("customers").alias("n"))
    total = F.max(F.when(F.col("facility_id") == -2, F.col("n")))
    found = counts.agg(total.alias("total"), F.map_from_entries(F.collect_list(F.struct("facility_id", "n"))).alias("m"))
    ids = F.explode(F.sequence(F.lit(-1), F.lit(len(facilities) - 1)))
    n = F.coalesce(F.try_element_at("m", F.col("facility_id")), F.lit(0))
    return (found.select("total", "m", ids.alias("facility_id"))
            .select("facility_id", n.alias("customers_in_range"),
                    F.round(n / F.col("total") * 100, 2).alias("coverage_pct"),
                    (F.col("total") - n).alias("customers_out_of_range")))


# --- scenarios and regions ----------------------------------------------------

def compare_counts(points: DataFrame, counts: Sequence[int] = (3, 5, 7, 10), starts: int = 10,
                   seed: int = SEED) -> DataFrame:
    """Facility counts ranked by facility cost plus transport cost."""
    points = points.persist()
    try:
        spark = points.sparkSession
        customers = points.agg(F.sum("customers")).first()[0] or 0
        kept = [k for k in counts if k <= customers / 10]
        if not kept:
            raise ValueError("too few customers for any of the facility counts")
        rows = []
        for k, sites in kmeans_sites(points, kept, starts=starts, seed=seed).items():
            km = facility_stats(points, sites).agg(F.sum("total_distance_km")).first()[0]
            fixed, transport = float(k * FACILITY_COST), km * TRANSPORT_COST_PER_KM
            rows.append((f"{k}_facilities", k, km, km / customers, fixed, fixed / customers, transport, fixed + transport))
    finally:
        points.unpersist()
    table = spark.createDataFrame(rows, "scenario string, n_facilities int, total_distance_km double, avg_distance_km double, "
                                        "facility_cost double, cost_per_customer double, transport_cost double, "
                                        "total_system_cost double")
    return rank_scenarios(table, "scenario", "total_system_cost")


def by_region(df: DataFrame, region: str = "order_region", k: int = 2, starts: int = STARTS) -> DataFrame:
    """k facilities per region with their statistics; tiny and null regions are skipped."""
    points = cut_lineage(demand_points(df.where(F.col(region).isNotNull()), by=[region]))
    sizes = points.groupBy(region).agg(F.sum("customers").alias("lines")).where(F.col("lines") >= 5 * k)
    kept = points.join(sizes.select(region), region, "left_semi").persist()
    try:
        centers = grouped_kmeans(kept.select(region, "lat", "lon", "w"), region, k, starts)
        joined = join_groups(kept, centers, region, centers.count(), 32 * k)
        near = nearest_in(F.col("centers"), "lat", "lon")
        assigned = joined.select(region, "lat", "lon", "customers", "demand", near["id"].alias("facility_id"),
                                 near["lat"].alias("facility_lat"), near["lon"].alias("facility_lon"))
        return cut_lineage(distance_stats(assigned, [region]))
    finally:
        kept.unpersist()


def region_summary(facilities: DataFrame, region: str = "order_region") -> DataFrame:
    """Regions, facilities, customers and the plain mean of the regional mean distances."""
    per_region = facilities.groupBy(region).agg(
        F.count(F.lit(1)).alias("n"), F.sum("customers_served").alias("customers"),
        F.round(F.sum("total_distance_km") / F.sum("customers_served"), 2).alias("avg_km"))
    return per_region.agg(F.count(F.lit(1)).alias("total_regions"), F.sum("n").alias("total_facilities"),
                          F.sum("customers").alias("total_customers"), F.round(F.avg("avg_km"), 2).alias("avg_distance_km"))
