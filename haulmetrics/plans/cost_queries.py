"""Shipping-cost queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from haulmetrics.operators import costs
from haulmetrics.plans.registry import on_lines, query
from haulmetrics.sources.star import order_lines

_UNIT = ("CASE shipping_mode WHEN 'Same Day' THEN 25 WHEN 'First Class' THEN 15 "
         "WHEN 'Second Class' THEN 10 WHEN 'Standard Class' THEN 5 ELSE {default} END")
_CUTS = ("cuts", """SELECT quantile_cont(CAST(order_item_total AS DOUBLE), 0.5) AS q50,
  quantile_cont(CAST(order_item_total AS DOUBLE), 0.75) AS q75,
  quantile_cont(CAST(order_item_total AS DOUBLE), 0.9) AS q90 FROM ol""")
_TOTALS = ("totals", f"""SELECT CAST(count(*) AS DOUBLE) AS n,
  CAST(sum(order_item_total) AS DOUBLE) AS revenue, CAST(sum(order_profit) AS DOUBLE) AS profit,
  CAST(sum({_UNIT.format(default=0)}) AS DOUBLE) AS current_cost,
  CAST(count(*) FILTER (late_delivery_risk = 1) AS DOUBLE) AS late,
  CAST(count(*) FILTER (CAST(order_item_total AS DOUBLE) > q90) AS DOUBLE) AS top,
  CAST(count(*) FILTER (CAST(order_item_total AS DOUBLE) > q75) AS DOUBLE) AS high,
  CAST(count(*) FILTER (CAST(order_item_total AS DOUBLE) > q50 AND CAST(order_item_total AS DOUBLE) <= q75) AS DOUBLE) AS mid
FROM ol, cuts""")
_EFFECT = ("effect", """SELECT current_cost, optimized_cost, current_cost - optimized_cost AS savings,
  round((current_cost - optimized_cost) / current_cost * 100, 2) AS savings_pct,
  round((top*85 + (high-top)*70 + (n-high)*55) / n / 100, 4) AS expected_service_level,
  CAST(top AS BIGINT) AS first_class_count, CAST(high - top AS BIGINT) AS second_class_count,
  CAST(n - high AS BIGINT) AS standard_class_count
FROM (SELECT *, top*15 + (high-top)*10 + (n-high)*5 AS optimized_cost FROM totals)""")
_POLICIES = ("policies", """
  SELECT 'all_standard' AS policy, n*5 AS cost, 0.55 AS expected_ontime_rate, n*0.45*50*2 AS late_penalty FROM totals
  UNION ALL SELECT 'all_express', n*15, 0.85, n*0.15*50 FROM totals
  UNION ALL SELECT 'value_based', high*15 + mid*10 + (n-high-mid)*5,
    round((high*0.85 + mid*0.70 + (n-high-mid)*0.55) / n, 2),
    (n - (high*0.85 + mid*0.70 + (n-high-mid)*0.55)) * 50 * 1.5 FROM totals
  UNION ALL SELECT 'risk_based', late*15 + (n-late)*5, round((late*0.85 + (n-late)*0.55) / n, 2),
    (n - (late*0.85 + (n-late)*0.55)) * 50 FROM totals""")
_RANKED = ("ranked", """SELECT policy, CAST(cost AS DOUBLE) AS cost,
  CAST(expected_ontime_rate AS DOUBLE) AS expected_ontime_rate,
  CAST(round(late_penalty, 2) AS DOUBLE) AS late_penalty, CAST(round(cost + late_penalty, 2) AS DOUBLE) AS total_cost,
  CAST(round(cost + late_penalty - min(cost + late_penalty) OVER (), 2) AS DOUBLE) AS vs_best,
  CAST(row_number() OVER (ORDER BY cost + late_penalty, policy) = 1 AS INT) AS is_best,
  CAST(row_number() OVER (ORDER BY cost + late_penalty, policy) AS INT) AS rank FROM policies""")


def lines(spark, sf_dir):
    return order_lines(spark, sf_dir, costs.COST_COLUMNS)


@query("c1_cost_by_mode", on_lines(f"""
SELECT shipping_mode, count(order_item_total) AS order_count,
  round(CAST(sum(order_item_total) AS DOUBLE), 2) AS total_revenue,
  round(CAST(sum(order_item_total) AS DOUBLE) / count(order_item_total), 2) AS avg_revenue,
  round(CAST(sum(order_profit) AS DOUBLE), 2) AS total_profit,
  round(CAST(sum(order_profit) AS DOUBLE) / count(order_profit), 2) AS avg_profit,
  CAST({_UNIT.format(default=10)} AS DOUBLE) AS cost_per_order,
  CAST({_UNIT.format(default=10)} * count(order_item_total) AS DOUBLE) AS est_shipping_cost
FROM ol WHERE shipping_mode IS NOT NULL GROUP BY shipping_mode"""))
def cost_by_mode(spark, sf_dir):
    return costs.cost_by_mode(order_lines(spark, sf_dir, ["shipping_mode", "order_item_total", "order_profit"]))


@query("c2_cost_by_region", on_lines("""
SELECT order_region, count(order_item_total) AS order_count,
  round(CAST(sum(order_item_total) AS DOUBLE), 2) AS total_revenue,
  round(CAST(sum(order_profit) AS DOUBLE), 2) AS total_profit
FROM ol GROUP BY order_region"""))
def cost_by_region(spark, sf_dir):
    return costs.cost_by_region(order_lines(spark, sf_dir, ["order_region", "order_item_total", "order_profit"]))


@query("c3_late_cost", on_lines("""
SELECT count(*) FILTER (late_delivery_risk = 1) AS late_orders,
  round(count(*) FILTER (late_delivery_risk = 1) / CAST(count(*) AS DOUBLE) * 100, 6) AS late_rate,
  CAST(sum(CASE WHEN late_delivery_risk = 1 THEN greatest(days_real - days_scheduled, 0) END) AS BIGINT) AS total_delay_days,
  CAST(sum(CASE WHEN late_delivery_risk = 1 THEN greatest(days_real - days_scheduled, 0) END) * 50 AS DOUBLE) AS estimated_penalty
FROM ol"""))
def late_cost(spark, sf_dir):
    out = costs.late_cost(order_lines(spark, sf_dir, ["late_delivery_risk", "days_real", "days_scheduled"]))
    return out.withColumn("late_rate", F.round("late_rate", 6))


@query("c4_cost_summary", on_lines(f"""
SELECT round(CAST(sum(order_item_total) AS DOUBLE), 2) AS total_revenue,
  round(CAST(sum(order_profit) AS DOUBLE), 2) AS total_profit,
  CAST(sum({_UNIT.format(default=0)}) AS DOUBLE) AS estimated_shipping_cost,
  round(CAST(sum(order_profit) AS DOUBLE) / CAST(sum(order_item_total) AS DOUBLE) * 100, 2) AS profit_margin_pct
FROM ol"""))
def cost_summary(spark, sf_dir):
    return costs.cost_summary(order_lines(spark, sf_dir, ["shipping_mode", "order_item_total", "order_profit"]))


@query("c5_mode_recommendation", on_lines("""
SELECT line_key, CASE WHEN CAST(order_item_total AS DOUBLE) > q90 THEN 'First Class'
  WHEN CAST(order_item_total AS DOUBLE) > q75 THEN 'Second Class' ELSE 'Standard Class' END AS recommended_mode
FROM ol, cuts""", _CUTS))
def mode_recommendation(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["line_key", "order_item_total"])
    return costs.recommend_modes(df).select("line_key", "recommended_mode")


def _thresholds(spark, sf_dir):
    """Quantiles of one line column: they need no join."""
    return costs.fit_thresholds(order_lines(spark, sf_dir, ["order_item_total"]))


def _totals(spark, sf_dir):
    return costs.cost_totals(lines(spark, sf_dir), _thresholds(spark, sf_dir))


@query("c6_recommendation_effect", on_lines("SELECT * FROM effect", _CUTS, _TOTALS, _EFFECT))
def recommendation_effect(spark, sf_dir):
    return costs.recommendation_effect(_totals(spark, sf_dir))


@query("c7_cheapest_mode", on_lines("""
SELECT line_key, CASE least(a, b, c, d) WHEN a THEN 'Same Day' WHEN b THEN 'First Class'
  WHEN c THEN 'Second Class' ELSE 'Standard Class' END AS cheapest_mode, CAST(least(a, b, c, d) AS DOUBLE) AS assigned_cost
FROM (SELECT line_key, 25 + late_days*50*0.05 AS a, 15 + late_days*50*0.15 AS b,
             10 + late_days*50*0.30 AS c, 5 + late_days*50*0.45 AS d
      FROM (SELECT line_key, greatest(days_real - days_scheduled, 0) AS late_days FROM ol))"""))
def cheapest_mode(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["line_key", "days_real", "days_scheduled"])
    return costs.cheapest_mode(df, costs.expected_cost).select("line_key", "cheapest_mode", "assigned_cost")


@query("c8_c11_cost_benefit", on_lines("SELECT * FROM ranked", _CUTS, _TOTALS, _POLICIES, _RANKED))
def cost_benefit(spark, sf_dir):
    return costs.compare_policies(_totals(spark, sf_dir))


@query("c12_recommendations", on_lines("""
SELECT 'switch_modes' AS rule, CAST(savings > 0 AS INT) AS fired, savings AS value FROM effect
UNION ALL SELECT 'best_policy', 1, total_cost FROM ranked WHERE is_best = 1
UNION ALL SELECT 'late_rate', CAST(late / n * 100 > 50 AS INT), round(late / n * 100, 6) FROM totals
UNION ALL SELECT 'service_level', CAST(expected_service_level < 0.7 AS INT), expected_service_level FROM effect""",
                                       _CUTS, _TOTALS, _EFFECT, _POLICIES, _RANKED))
def recommendations(spark, sf_dir):
    return costs.recommendations(_totals(spark, sf_dir)).select("rule", "fired", F.round("value", 6).alias("value"))


@query("c13_cost_report", on_lines("""
SELECT 'current_state' AS section, 'total_revenue' AS item, round(CAST(revenue AS DOUBLE), 2) AS value FROM sums
UNION ALL SELECT 'current_state', 'total_profit', round(CAST(profit AS DOUBLE), 2) FROM sums
UNION ALL SELECT 'current_state', 'estimated_shipping_cost', current_cost FROM effect
UNION ALL SELECT 'current_state', 'profit_margin_pct', round(CAST(profit AS DOUBLE) / CAST(revenue AS DOUBLE) * 100, 2) FROM sums
UNION ALL SELECT 'optimization', name, value FROM (UNPIVOT (SELECT COLUMNS(*)::DOUBLE FROM effect) ON COLUMNS(*) INTO NAME name VALUE value)
UNION ALL SELECT 'policies', policy, total_cost FROM ranked
UNION ALL SELECT 'recommendations', 'switch_modes', savings FROM effect WHERE savings > 0
UNION ALL SELECT 'recommendations', 'best_policy', total_cost FROM ranked WHERE is_best = 1
UNION ALL SELECT 'recommendations', 'late_rate', round(late / n * 100, 6) FROM totals WHERE late / n * 100 > 50
UNION ALL SELECT 'recommendations', 'service_level', expected_service_level FROM effect WHERE expected_service_level < 0.7""",
                                   _CUTS, _TOTALS, _EFFECT, _POLICIES, _RANKED,
                                   ("sums", "SELECT sum(order_item_total) AS revenue, sum(order_profit) AS profit FROM ol")))
def cost_report(spark, sf_dir):
    report = costs.cost_report(lines(spark, sf_dir), _thresholds(spark, sf_dir))
    return report.withColumn("value", F.round("value", 6))


@query("s6_cost_result_table", on_lines("""
SELECT 'Current Cost' AS metric, current_cost AS value, 'Cost' AS category FROM effect
UNION ALL SELECT 'Optimized Cost', optimized_cost, 'Cost' FROM effect
UNION ALL SELECT 'Savings', savings, 'Savings' FROM effect
UNION ALL SELECT 'Savings Percentage', savings_pct, 'Savings' FROM effect""", _CUTS, _TOTALS, _EFFECT))
def cost_result_table(spark, sf_dir):
    return costs.cost_metric_table(_totals(spark, sf_dir))
