import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from haulmetrics.operators import costs, delivery, metrics, risk
from haulmetrics.operators.scenarios import rank_scenarios

# Published result values for 180,519 lines.
COUNTS = dict(n=180519, high=45079, mid=44871, late=98977, top=18031, current_cost=1551555)


def totals(spark):
    row = dict(COUNTS, top=18031, high=18031 + 27048)
    return spark.createDataFrame([row], "n long, high long, mid long, late long, top long, current_cost long")


def test_policy_goldens(spark):
    got = {r["policy"]: r["total_cost"] for r in costs.compare_policies(totals(spark)).collect()}
    assert got == {"all_standard": 9025950.00, "all_express": 4061677.50, "value_based": 6151180.00,
                   "risk_based": 4469387.50}


def test_recommendation_goldens(spark):
    r = costs.recommendation_effect(totals(spark)).first()
    assert (r["optimized_cost"], r["savings"], r["savings_pct"]) == (1218145.0, 333410.0, 21.49)
    assert r["expected_service_level"] == 0.6024
    assert (r["standard_class_count"], r["second_class_count"], r["first_class_count"]) == (135440, 27048, 18031)


def test_advice(spark):
    fired = {r["rule"]: (r["fired"], r["message"]) for r in costs.recommendations(totals(spark)).collect()}
    assert all(f == 1 for f, _ in fired.values())
    assert "333,410.00 (21.5%)" in fired["switch_modes"][1] and "all_express" in fired["best_policy"][1]


def test_unknown_and_null_modes(spark):
    df = spark.createDataFrame([("Same Day", 10.0, 1.0), ("Drone", 20.0, 2.0), (None, 5.0, 1.0)],
                               "shipping_mode string, order_item_total double, order_profit double")
    by_mode = {r["shipping_mode"]: r["est_shipping_cost"] for r in costs.cost_by_mode(df).collect()}
    assert by_mode == {"Same Day": 25.0, "Drone": 10.0}
    assert costs.cost_summary(df).first()["estimated_shipping_cost"] == 25.0


def test_ties_get_standard(spark):
    df = spark.createDataFrame([(5.0,)] * 10, "order_item_total double")
    assert {r["recommended_mode"] for r in costs.recommend_modes(df).collect()} == {"Standard Class"}


def test_cheapest_mode_by_unit_cost(spark):
    df = spark.range(100)
    out = costs.cheapest_mode(df).agg(F.sum("assigned_cost").alias("c"), F.collect_set("cheapest_mode").alias("m")).first()
    assert (out["c"], out["m"]) == (500.0, ["Standard Class"])


def test_cheapest_mode_tie_goes_to_the_earlier(spark):
    df = spark.createDataFrame([(2, 0)], "days_real int, days_scheduled int")
    r = costs.cheapest_mode(df, costs.expected_cost).first()
    assert (r["cheapest_mode"], r["assigned_cost"]) == ("Same Day", 30.0)


def test_regression_errors(spark):
    y, p = np.array([0.0, 1, 2, 5]), np.array([1.0, 1, 1, 4])
    r = metrics.regression_errors(spark.createDataFrame(list(zip(y.tolist(), p.tolist())), "y double, p double"), "y", "p").first()
    assert r["mape"] == pytest.approx(np.mean(np.abs((y - p) / (y + 1e-10))) * 100)
    assert r["r2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    flat = spark.createDataFrame([(2.0, 2.0, 3.0)] * 3, "y double, same double, off double")
    assert metrics.regression_errors(flat, "y", "same").first()["r2"] == 1.0
    assert metrics.regression_errors(flat, "y", "off").first()["r2"] == 0.0


def test_delivery_kpis_with_nulls_and_prediction(spark):
    df = spark.createDataFrame([(1, 0, 1.0), (4, 1, 3.0), (None, 1, 2.0)], "days_real int, late_delivery_risk int, p double")
    r = metrics.delivery_kpis(df, predicted="p").first()
    assert (r["mean_delivery_days"], r["median_delivery_days"]) == (2.5, 2.5)
    assert r["std_delivery_days"] == pytest.approx(np.std([1, 4], ddof=1))
    assert r["late_delivery_rate"] == pytest.approx(200 / 3) and r["prediction_mae"] == 0.5


def test_accuracy_of_score_arrays(spark):
    df = spark.createDataFrame([(2, [0.1, 0.2, 0.7]), (0, [0.1, 0.8, 0.1])], "label int, score array<double>")
    assert metrics.accuracy(df, "label", "score").first()["accuracy"] == 0.5


def test_savings_and_improvement(spark):
    df = spark.createDataFrame([(100.0, 80.0), (0.0, 5.0), (-10.0, 5.0)], "baseline_cost double, optimized_cost double")
    assert [r["percentage_savings"] for r in metrics.savings(df).collect()] == [20.0, 0.0, 0.0]
    r = df.select(metrics.improvement_pct(F.col("baseline_cost"), F.col("optimized_cost")).alias("up")).collect()
    assert [x["up"] for x in r] == [-20.0, 0.0, 150.0]


def test_ranking_both_ways(spark):
    df = spark.createDataFrame([("g", "a", 0.0), ("g", "b", 0.0), ("g", "c", 5.0)], "grp string, name string, value double")
    low = {r["name"]: (r["rank"], r["vs_best_pct"], r["is_best"]) for r in rank_scenarios(df, "name", "value", ["grp"]).collect()}
    assert low == {"a": (1, 0.0, 1), "b": (2, 0.0, 0), "c": (3, 0.0, 0)}
    high = rank_scenarios(df, "name", "value", ["grp"], lower_is_better=False).where("is_best = 1").first()
    assert high["name"] == "c"


def test_balance(spark):
    df = spark.createDataFrame([("one", 3.0), ("zero", 0.0), ("zero", 0.0), ("same", 2.0), ("same", 2.0), ("mix", 1.0), ("mix", 3.0)],
                               "grp string, v double")
    got = {r["grp"]: r["balance_score"] for r in metrics.balance_score(df, "v", ["grp"]).collect()}
    assert got == {"one": 1.0, "zero": 1.0, "same": 1.0, "mix": pytest.approx(1 / 1.5)}


def test_empty_routes(spark):
    r = metrics.route_kpis(spark.createDataFrame([], "distance_km double, total_time_min double, num_stops int")).first()
    assert set(r) == {0}


def test_segments_and_confusion(spark):
    df = spark.createDataFrame([(0.0,), (0.3,), (0.3001,), (0.6,), (0.8,), (1.0,)], "risk_probability double")
    assert [r["risk_segment"] for r in risk.risk_segments(df).collect()] == [None, "Low", "Medium", "Medium", "High", "Critical"]
    pairs = spark.createDataFrame([(0, 0), (0, 1), (1, 0), (1, 1), (1, 1)], "late_delivery_risk int, prediction int")
    r = risk.classification_metrics(risk.confusion_counts(pairs)).first()
    assert (r["tn"], r["fp"], r["fn"], r["tp"]) == (1, 1, 1, 2)
    assert (r["accuracy"], r["precision"], r["f1"]) == (0.6, pytest.approx(2 / 3), pytest.approx(2 / 3))


def test_auc_counts_ties_half(spark):
    rows = [(0, 0.1), (0, 0.5), (1, 0.5), (1, 0.9), (0, 0.9)]
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    want = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    df = spark.createDataFrame([(float(y), s) for y, s in rows], "late_delivery_risk double, score double")
    assert risk.roc_auc(df, score="score") == pytest.approx(want)


def test_label_codes(spark):
    df = spark.createDataFrame([("b",), ("a",), ("z",), (None,)], "shipping_mode string")
    codes = risk.encode_labels(df, {"shipping_mode": ["a", "b"]}).collect()
    assert [r["shipping_mode_encoded"] for r in codes] == [1, 0, -1, -1]


def test_iqr_needs_over_ten_rows(spark):
    values = [1.0] * 9 + [100.0]
    df = spark.createDataFrame([(v,) for v in values], "days_real double")
    assert delivery.iqr_filter(df).count() == 10
    assert delivery.iqr_filter(df.union(df.limit(1))).count() == 10  # now 11 rows, the outlier goes


def test_daily_series_and_forecast(spark):
    start = dt.datetime(2023, 1, 1, 8)
    rows = [(start + dt.timedelta(days=d, hours=i), 3 + (d % 7 == 0)) for d in range(210) for i in range(5)]
    rows += [(start + dt.timedelta(days=300), 1)] * 4
    df = spark.createDataFrame(rows, "order_ts timestamp_ntz, days_real int")
    assert delivery.daily_series(df).count() == 210
    out = delivery.forecast(df, 14).orderBy("ds").collect()
    assert len(out) == 14 and out[0]["ds"] == (start + dt.timedelta(days=210)).date()
    for r in out:
        assert r["yhat_lower"] <= r["yhat"] <= r["yhat_upper"]
        is_peak = (r["ds"] - start.date()).days % 7 == 0
        assert abs(r["yhat"] - (4 if is_peak else 3)) < 0.5


def test_hash_split_is_repeatable(spark):
    df = spark.range(5000).selectExpr("CAST(id AS STRING) AS line_key")
    train, test = delivery.hash_split(df)
    again, _ = delivery.hash_split(df.repartition(3))
    assert train.count() == again.count() and train.count() + test.count() == 5000
    assert 0.17 < test.count() / 5000 < 0.23
