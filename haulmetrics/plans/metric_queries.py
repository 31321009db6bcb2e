"""KPI queries that need no geography."""

from __future__ import annotations

from pyspark.sql import functions as F

from haulmetrics.functions.exprs import dbl
from haulmetrics.operators import costs, metrics
from haulmetrics.operators.scenarios import rank_scenarios
from haulmetrics.plans.registry import on_lines, query
from haulmetrics.sources.star import order_lines


def rounded(df, digits=6, skip=()):
    """Doubles rounded for display; other types as they are."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" and c not in skip else F.col(c)
                       for c, t in df.dtypes])


_DELIVERY = """round(avg(days_real), 6) AS mean_delivery_days,
  quantile_cont(CAST(days_real AS DOUBLE), 0.5) AS median_delivery_days,
  round(stddev_samp(days_real), 6) AS std_delivery_days, min(days_real) AS min_delivery_days,
  max(days_real) AS max_delivery_days, CAST(sum(late_delivery_risk) AS BIGINT) AS late_delivery_count,
  round(sum(late_delivery_risk) / CAST(count(*) AS DOUBLE) * 100, 6) AS late_delivery_rate,
  round(100 - sum(late_delivery_risk) / CAST(count(*) AS DOUBLE) * 100, 6) AS on_time_rate"""
_COST = """round(CAST(sum(sales) AS DOUBLE), 6) AS total_revenue, round(CAST(sum(order_profit) AS DOUBLE), 6) AS total_profit,
  round(CAST(sum(sales) AS DOUBLE) / count(sales), 6) AS avg_order_value,
  round(CAST(sum(order_profit) AS DOUBLE) / count(order_profit), 6) AS avg_profit_per_order,
  round(CAST(sum(order_profit) AS DOUBLE) / CAST(sum(sales) AS DOUBLE) * 100, 6) AS profit_margin,
  count(*) AS total_orders"""


@query("m1_delivery_kpis", on_lines(f"SELECT {_DELIVERY} FROM ol"))
def delivery_kpis(spark, sf_dir):
    return rounded(metrics.delivery_kpis(order_lines(spark, sf_dir, ["days_real", "late_delivery_risk"])))


@query("m1_delivery_kpis_predicted", on_lines(f"""
SELECT {_DELIVERY}, round(avg(abs(e)), 6) AS prediction_mae, round(sqrt(avg(e * e)), 6) AS prediction_rmse,
  round(1 - sum(e * e) / (var_pop(days_real) * count(*)), 6) AS prediction_r2
FROM (SELECT *, CAST(days_real - days_scheduled AS DOUBLE) AS e FROM ol)"""))
def delivery_kpis_predicted(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["days_real", "days_scheduled", "late_delivery_risk"])
    return rounded(metrics.delivery_kpis(df, predicted="days_scheduled"))


@query("m2_cost_kpis", on_lines(f"SELECT {_COST} FROM ol"))
def cost_kpis(spark, sf_dir):
    return rounded(metrics.cost_kpis(order_lines(spark, sf_dir, ["sales", "order_profit"])))


@query("m3_baseline", on_lines(
    f"SELECT {_DELIVERY}, {_COST}, CAST(min(order_ts) AS VARCHAR) AS period_start, "
    "CAST(max(order_ts) AS VARCHAR) AS period_end FROM ol"))
def baseline(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["days_real", "late_delivery_risk", "sales", "order_profit", "order_ts"])
    out = rounded(metrics.baseline(df))
    return out.withColumns({c: F.col(c).cast("string") for c in ("period_start", "period_end")})


@query("m4_regression_errors", on_lines("""
SELECT round(avg(abs(e)), 6) AS mae, round(avg(e * e), 6) AS mse, round(sqrt(avg(e * e)), 6) AS rmse,
  round(avg(abs(e / (y + 1e-10))) * 100, 0) AS mape,
  round(1 - sum(e * e) / (var_pop(y) * count(*)), 6) AS r2
FROM (SELECT CAST(days_real AS DOUBLE) AS y, CAST(days_real - days_scheduled AS DOUBLE) AS e FROM ol)"""))
def regression_errors(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["days_real", "days_scheduled"])
    out = rounded(metrics.regression_errors(df, "days_real", "days_scheduled"), skip=("mape",))
    return out.withColumn("mape", F.round("mape", 0))


@query("m4_errors_of_late_days", on_lines("""
SELECT round(avg(abs(e)), 6) AS mae, round(avg(abs(e / (y + 1e-10))) * 100, 6) AS mape
FROM (SELECT CAST(days_real AS DOUBLE) AS y, CAST(days_real - days_scheduled AS DOUBLE) AS e FROM ol WHERE days_real > 0)"""))
def errors_of_late_days(spark, sf_dir):
    """The relative error where the target is not zero, all digits compared."""
    df = order_lines(spark, sf_dir, ["days_real", "days_scheduled"]).where("days_real > 0")
    return rounded(metrics.regression_errors(df, "days_real", "days_scheduled").select("mae", "mape"))


@query("m5_accuracy_of_class_scores", on_lines("""
SELECT round(avg(CAST(CAST(days_scheduled > 2 AS INT) = late_delivery_risk AS INT)), 6) AS accuracy FROM ol"""))
def accuracy_of_class_scores(spark, sf_dir):
    """One score for each class; the larger one decides, the first of equals."""
    df = order_lines(spark, sf_dir, ["days_scheduled", "late_delivery_risk"])
    scores = F.array((4 - F.col("days_scheduled")).cast("double"), F.col("days_scheduled").cast("double"))
    return rounded(metrics.accuracy(df.select("late_delivery_risk", scores.alias("scores")), "late_delivery_risk", "scores"))


@query("m5_accuracy", on_lines("""
SELECT round(avg(CAST(CAST(days_scheduled / 4.0 >= 0.5 AS INT) = late_delivery_risk AS INT)), 6) AS accuracy FROM ol"""))
def accuracy(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["days_scheduled", "late_delivery_risk"])
    scored = df.select("late_delivery_risk", (F.col("days_scheduled") / 4.0).alias("score"))
    return rounded(metrics.accuracy(scored, "late_delivery_risk", "score"))


@query("m6_m7_savings", on_lines("""
SELECT order_region, baseline_cost, optimized_cost, baseline_cost - optimized_cost AS absolute_savings,
  round((baseline_cost - optimized_cost) / baseline_cost * 100, 6) AS percentage_savings,
  round((baseline_cost - optimized_cost) / abs(baseline_cost) * 100, 6) AS improvement_pct
FROM (SELECT order_region, CAST(count(*) * 5 AS DOUBLE) AS optimized_cost, CAST(sum(CASE shipping_mode
    WHEN 'Same Day' THEN 25 WHEN 'First Class' THEN 15 WHEN 'Second Class' THEN 10 ELSE 5 END) AS DOUBLE) AS baseline_cost
  FROM ol GROUP BY order_region)"""))
def savings(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["order_region", "shipping_mode"])
    paired = df.groupBy("order_region").agg(
        dbl(F.sum(costs.current_cost_column())).alias("baseline_cost"),
        dbl(F.count(F.lit(1)) * costs.MODE_COST["Standard Class"]).alias("optimized_cost"))
    return rounded(metrics.savings(paired).withColumn("improvement_pct", metrics.improvement_pct(
        F.col("baseline_cost"), F.col("optimized_cost"), higher_is_better=False)))


@query("m10_scenario_ranking", on_lines("""
SELECT *, round(value - min(value) OVER (PARTITION BY order_region), 6) AS vs_best,
  round((value - min(value) OVER (PARTITION BY order_region)) / min(value) OVER (PARTITION BY order_region) * 100, 6) AS vs_best_pct,
  CAST(row_number() OVER (PARTITION BY order_region ORDER BY value, shipping_mode) = 1 AS INT) AS is_best,
  CAST(row_number() OVER (PARTITION BY order_region ORDER BY value, shipping_mode) AS INT) AS rank
FROM (SELECT order_region, shipping_mode, CAST(sum(order_item_total) AS DOUBLE) AS value FROM ol GROUP BY ALL)"""))
def scenario_ranking(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["order_region", "shipping_mode", "order_item_total"])
    values = df.groupBy("order_region", "shipping_mode").agg(dbl(F.sum("order_item_total")).alias("value"))
    return rounded(rank_scenarios(values, "shipping_mode", "value", by=["order_region"]), skip=("value",))


@query("m11_balance_score", on_lines("""
SELECT order_region, round(1 / (1 + stddev_pop(n) / avg(n)), 6) AS balance_score
FROM (SELECT order_region, customer_state, count(*) AS n FROM ol GROUP BY ALL) GROUP BY order_region"""))
def balance_score(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["order_region", "customer_state"])
    loads = df.groupBy("order_region", "customer_state").agg(F.count(F.lit(1)).alias("n"))
    return rounded(metrics.balance_score(loads, "n", by=["order_region"]))
