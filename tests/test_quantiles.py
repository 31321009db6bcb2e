from fractions import Fraction

import duckdb
import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from haulmetrics.functions import quantiles
from haulmetrics.functions.grouped_quantiles import grouped_quantiles
from haulmetrics.functions.quantiles import exact_quantiles

PROBS = (0.0, 0.25, 0.5, 0.75, 0.9, 1.0)


def check(spark, columns, probs=PROBS):
    names = list(columns)
    rows = list(zip(*columns.values()))
    df = spark.createDataFrame([tuple(None if v is None else float(v) for v in r) for r in rows],
                               ", ".join(f"{n} double" for n in names))
    got = exact_quantiles(df.repartition(5), names, probs)
    for n, values in columns.items():
        present = [v for v in values if v is not None]
        want = np.quantile(np.array(present, float), probs) if present else [None] * len(probs)
        assert got[n] == pytest.approx(list(want)) if present else got[n] == list(want)


def test_small_and_ties(spark):
    check(spark, {"a": [3, 1, 2, 2, 2, 10], "b": [None, 5, None, 5, 5, 7], "c": [None] * 6})


def test_one_row(spark):
    check(spark, {"a": [4.5]})


def test_hot_value_beside_many_others(spark, tight):
    """A rank next to a value with most of the rows must still be reached."""
    check(spark, {"a": np.concatenate([np.linspace(0, 1, 300), np.full(2000, 2.0), np.linspace(3, 4, 300)])},
          (0.05, 0.11, 0.5, 0.9, 0.95))


@pytest.fixture
def tight(monkeypatch):
    """Sketches too coarse and listings too short for the data, to force every retry path."""
    monkeypatch.setattr(quantiles, "SMALL_TABLE", 10)
    monkeypatch.setattr(quantiles, "SKETCH_ACCURACY", 20)
    monkeypatch.setattr(quantiles, "MARGIN", 0.1)
    monkeypatch.setattr(quantiles, "LISTED_VALUES", 60)


def test_narrowing(spark, tight):
    rng = np.random.default_rng(1)
    check(spark, {"a": rng.normal(size=3000), "b": np.round(rng.exponential(5, 3000), 1)}, (0.25, 0.5, 0.9))


def test_hot_value(spark, tight):
    rng = np.random.default_rng(2)
    values = np.where(rng.random(3000) < 0.4, 7.0, rng.normal(7, 3, 3000))
    check(spark, {"a": values}, (0.25, 0.5, 0.75, 0.9))


def test_missed_bracket_is_reopened(spark, monkeypatch):
    """A sketch that lies must cost time only."""
    monkeypatch.setattr(quantiles, "SMALL_TABLE", 10)
    monkeypatch.setattr(quantiles._Bracket, "tighten",
                        lambda self, low, high, margin, calls=[]: calls.append(1) or (
                            len(calls) < 3 and (setattr(self, "low", 1e6), setattr(self, "high", 2e6))))
    check(spark, {"a": np.arange(500.0)}, (0.5,))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5), st.floats(-1e6, 1e6)), min_size=1, max_size=60))
def test_any_values(spark, values):
    check(spark, {"a": values}, (0.1, 0.5, 0.75))


def test_spaced_ranks(spark):
    df = spark.range(101).selectExpr("CAST(id AS DOUBLE) AS x")
    got = exact_quantiles(df, ["x"], [Fraction(i, 7) for i in range(8)], interpolate=False)["x"]
    assert got == [float(i * 100 // 7) for i in range(8)]


def test_values_between_ranks_equal_sql_to_the_last_digit(spark):
    """Amounts of four decimals, in groups of one to sixty; a key without values and infinite ones."""
    rng = np.random.default_rng(7)
    data = [(k, round(float(v), 4) * 0.93) for k in range(1, 61) for v in rng.uniform(900, 100_000, k)]
    data += [(61, None), (62, 1.5), (62, float("inf")), (63, float("-inf")), (63, 2.5)]
    df = spark.createDataFrame(data, "k long, v double")
    con = duckdb.connect()
    con.register("amounts", df.toArrow())
    shares = {"a": 0.25, "b": 0.5, "c": 0.9}
    wanted = ", ".join(f"quantile_cont(v, {p})" for p in shares.values())
    sql = {k: values for k, *values in con.execute(f"SELECT k, {wanted} FROM amounts GROUP BY k").fetchall()}
    got = {r["k"]: [r[name] for name in shares] for r in grouped_quantiles(df, ["k"], "v", shares).collect()}
    assert got == sql
    for k in (2, 11, 30, 47, 60):
        assert exact_quantiles(df.where(df.k == k), ["v"], list(shares.values()))["v"] == sql[k]
