import datetime as dt

import pytest

from haulmetrics.operators import preprocess as prep

BASE = dt.datetime(2024, 1, 1, 9)


def gaps(spark):
    rows = []
    for i in range(10):
        rows.append((f"k{i}", BASE, BASE, i % 5, 2, 1, None if i == 9 else "C", 10.0,
                     None if i in (1, 2) else i * 10, None if i == 0 else ("b" if i % 2 else "a"),
                     None if i < 6 else 1, None if i < 5 else 2, None))
    return spark.createDataFrame(rows, "line_key string, order_ts timestamp_ntz, shipping_ts timestamp_ntz, days_real int, "
                                 "days_scheduled int, late_delivery_risk int, customer_city string, product_price double, "
                                 "order_item_quantity int, customer_segment string, sixty int, fifty int, empty string")


def test_missing_values(spark):
    out = prep.preprocess(gaps(spark), ["handle_missing_values"])
    assert out.profile.sparse == ["sixty", "empty"]
    assert "fifty" in out.data.columns  # exactly half is kept
    rows = {r["line_key"]: r for r in out.data.collect()}
    assert len(rows) == 9  # the row without a city is gone
    assert rows["k1"]["order_item_quantity"] == 50.0  # median of 0,30..80 after the drop
    assert rows["k0"]["customer_segment"] == "a"  # tie between a and b goes to a


def test_all_null_text_becomes_unknown(spark):
    df = gaps(spark).select("line_key", "empty")
    assert prep.column_modes(df, ["empty"]) == {"empty": "Unknown"}


def test_bad_text(spark):
    df = spark.createDataFrame([(1, "12.5"), (2, "x"), (3, ""), (4, None)], "order_id int, product_price string")
    out = prep.clean_types(df).collect()
    assert [r["product_price"] for r in out] == [12.5, None, None, None]
    assert [r["order_id"] for r in out] == ["1", "2", "3", "4"]


def test_delays(spark):
    df = spark.createDataFrame([(3 + d, 3) for d in (-3, -2, -1, 0, 1, 2, 3)] + [(None, 3)],
                               "days_real int, days_scheduled int")
    rows = prep.delivery_features(df).collect()
    assert [r["delay_category"] for r in rows] == ["Very Early", "Very Early", "On Time", "On Time", "Slightly Late",
                                                   "Slightly Late", "Very Late", None]
    assert [r["is_delayed"] for r in rows] == [0, 0, 0, 0, 1, 1, 1, 0]
    assert rows[0]["delivery_efficiency"] == 3.0  # zero days count as one


def test_zero_divisors(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0, 4.0, 6.0)],
                               "sales double, order_item_total double, order_item_quantity int, order_profit double, order_item_discount double")
    r = prep.cost_features(df).first()
    assert (r["profit_margin_pct"], r["revenue_per_item"], r["discount_impact_pct"]) == (400.0, 0.0, 600.0)


def test_ties_are_not_high_value(spark):
    df = spark.createDataFrame([(5.0, 1)] * 10, "order_item_total double, days_scheduled int")
    out = prep.preprocess(df, ["create_risk_features"]).data
    assert {(r["is_high_value_order"], r["is_rush_order"], r["risk_score"]) for r in out.collect()} == {(0, 1, 1)}


def test_weekdays(spark):
    df = spark.createDataFrame([(BASE + dt.timedelta(days=i),) for i in range(7)], "order_ts timestamp_ntz")
    rows = prep.date_parts(df).collect()
    assert [r["order_dayofweek"] for r in rows] == list(range(7))
    assert [r["is_weekend"] for r in rows] == [0] * 5 + [1] * 2


def test_levels(spark):
    df = spark.createDataFrame([("b",), ("a.x",), ("c",), (None,)], "shipping_mode string")
    out = prep.preprocess(df, ["encode_categorical"]).data
    assert out.columns == ["shipping_mode", "shipping_mode_b", "shipping_mode_c"]
    assert [tuple(r)[1:] for r in out.collect()] == [(1, 0), (0, 0), (0, 1), (0, 0)]


def test_any_number_of_levels(spark):
    df = spark.range(1500).selectExpr("CAST(id AS STRING) AS market")
    assert len(prep.category_levels(df, ["market"])["market"]) == 1500
    assert prep.preprocess(df, ["encode_categorical"]).applied == ["encode_categorical"]


def test_unknown_and_failing_steps(spark):
    df = spark.createDataFrame([(1,)], "order_id int")
    out = prep.preprocess(df, ["clean_data_types", "no_such_step"])
    assert out.applied == ["clean_data_types"] and out.warnings == ["unknown step: no_such_step"]
    items = {r["item"]: r["value"] for r in prep.summary(df, out).collect()}
    assert items["rows_after"] == "1" and items["text_columns"] == "1"


def test_full_run_and_repartition(spark, small):
    from haulmetrics.sources.star import order_lines
    df = order_lines(spark, small)
    out = prep.preprocess(df)
    assert out.applied == list(prep.STEPS) and not out.warnings
    again = prep.preprocess(df.repartition(7))
    assert again.profile == out.profile
    assert out.data.count() == df.count()
