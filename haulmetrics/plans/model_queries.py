"""Delivery-time and late-risk queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from haulmetrics.functions.exprs import dbl
from haulmetrics.functions.grouped_quantiles import grouped_quantiles
from haulmetrics.operators import delivery, preprocess as prep, risk
from haulmetrics.plans.gaps import GAPS_SQL, gap_lines
from haulmetrics.plans.metric_queries import rounded
from haulmetrics.plans.registry import on_lines, query
from haulmetrics.schema import CV_FOLDS, DELIVERY_FEATURES, RISK_NUMERIC_FEATURES
from haulmetrics.session import cut_lineage, stored
from haulmetrics.sources.star import order_lines

# --- analysis -----------------------------------------------------------------


@query("d1_d2_delivery_stats", on_lines("""
SELECT round(avg(days_real), 6) AS mean_delivery_time, quantile_cont(CAST(days_real AS DOUBLE), 0.5) AS median_delivery_time,
  round(stddev_samp(days_real), 6) AS std_delivery_time, min(days_real) AS min_delivery_time,
  max(days_real) AS max_delivery_time, round(avg(CAST(days_real > days_scheduled AS INT)) * 100, 6) AS late_delivery_rate
FROM ol"""))
def delivery_stats(spark, sf_dir):
    df = prep.delivery_features(order_lines(spark, sf_dir, ["days_real", "days_scheduled"]))
    return rounded(delivery.delivery_stats(df))


@query("d3_delivery_by_category", on_lines("\nUNION ALL ".join(f"""
SELECT '{c}' AS dimension, {c} AS value, round(avg(days_real), 6) AS mean,
  quantile_cont(CAST(days_real AS DOUBLE), 0.5) AS median, count(*) AS count, round(stddev_samp(days_real), 6) AS std
FROM ol GROUP BY {c}""" for c in delivery.CATEGORIES)))
def delivery_by_category(spark, sf_dir):
    return rounded(delivery.delivery_by_category(order_lines(spark, sf_dir, [*delivery.CATEGORIES, "days_real"])))


@query("d4_delivery_by_month", on_lines("""
SELECT CAST(month(order_ts) AS INT) AS order_month, round(avg(days_real), 6) AS mean, count(days_real) AS count
FROM ol GROUP BY ALL"""))
def delivery_by_month(spark, sf_dir):
    df = prep.date_parts(order_lines(spark, sf_dir, ["order_ts", "days_real"]))
    return rounded(delivery.delivery_by_month(df))


_FILLED = ("order_item_quantity", "product_price", "sales", "order_month", "order_dayofweek", "order_hour", "shipping_month",
           "shipping_dayofweek", "days_scheduled", "days_real")
_PARTS = ("parts", """SELECT *, month(order_ts) AS order_month, isodow(order_ts) - 1 AS order_dayofweek, hour(order_ts) AS order_hour,
  month(shipping_ts) AS shipping_month, isodow(shipping_ts) - 1 AS shipping_dayofweek FROM gaps""")


@query("d5_feature_fill", on_lines("SELECT line_key, " + ", ".join(
    f"coalesce(CAST({c} AS DOUBLE), (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM parts)) AS {c}"
    for c in _FILLED) + " FROM parts", GAPS_SQL, _PARTS))
def feature_fill(spark, sf_dir):
    df = cut_lineage(prep.date_parts(gap_lines(spark, sf_dir, [
        "line_key", "order_item_quantity", "product_price", "sales", "order_ts", "shipping_ts", "days_scheduled", "days_real"])))
    return delivery.fill_features(df, delivery.fit_feature_fill(df), keep=["line_key"])


@query("d6_iqr_filter", on_lines("""
SELECT line_key, CAST(order_profit AS DOUBLE) AS order_profit
FROM ol, (SELECT quantile_cont(CAST(order_profit AS DOUBLE), 0.25) AS q1,
                 quantile_cont(CAST(order_profit AS DOUBLE), 0.75) AS q3 FROM ol)
WHERE CAST(order_profit AS DOUBLE) BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"""))
def iqr_filter(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["line_key", "order_profit"])
    return delivery.iqr_filter(df, "order_profit").select("line_key", dbl("order_profit").alias("order_profit"))


@query("d15_daily_series", on_lines("""
SELECT CAST(ds AS VARCHAR) AS ds, y, n FROM (
  SELECT CAST(order_ts AS DATE) AS ds, round(avg(days_real), 6) AS y, count(days_real) AS n
  FROM ol GROUP BY 1 HAVING count(days_real) >= 5)"""))
def daily_series(spark, sf_dir):
    out = delivery.daily_series(order_lines(spark, sf_dir, ["order_ts", "days_real"]))
    return rounded(out.withColumn("ds", F.col("ds").cast("string")))


# --- delivery models ----------------------------------------------------------

def train_delivery(df, names=None, folds=0, score=True):
    return delivery.train_delivery_models(df, names, folds=folds, score=score)


def train_risk(df, names=None, score=True):
    return risk.train_risk_models(df, names, score=score)


def fitted(trained, name):
    """The named model by its name; a fit that failed is an error here, since an empty result would look like one."""
    if name not in trained.models:
        raise RuntimeError(f"{name} was not fitted: {trained.errors.get(name, 'unknown model')}")
    return {name: trained.models[name]}


def delivery_lines(spark, sf_dir):
    """Features and target, joined once: fills, scalers, fits and scores read them many times."""
    df = order_lines(spark, sf_dir, ["line_key", "order_item_quantity", "product_price", "sales", "order_ts",
                                     "shipping_ts", "days_scheduled", "days_real"])
    return stored(prep.date_parts(df).select("line_key", *DELIVERY_FEATURES, delivery.TARGET), "delivery-lines")


@query("d9_d10_delivery_models")
def delivery_model_metrics(spark, sf_dir):
    return delivery.model_metrics(spark, train_delivery(delivery_lines(spark, sf_dir)))


@query("d11_cv_mae")
def cv_mae(spark, sf_dir):
    return delivery.cross_validate(delivery_lines(spark, sf_dir))


@query("d12_feature_importance")
def feature_importance(spark, sf_dir):
    trained = train_delivery(delivery_lines(spark, sf_dir), ["random_forest"], score=False)
    return delivery.feature_importance(spark, fitted(trained, "random_forest"), trained.fill.features)


@query("d13_score")
def score(spark, sf_dir):
    lines = delivery_lines(spark, sf_dir)
    return delivery.predict_days(lines, train_delivery(lines, ["linear_regression"], score=False), "linear_regression")


@query("d14_model_comparison")
def model_comparison(spark, sf_dir):
    lines = delivery_lines(spark, sf_dir)
    trained = train_delivery(lines, folds=CV_FOLDS)
    return delivery.model_comparison(delivery.model_metrics(spark, trained), delivery.cv_table(spark, trained))


@query("d16_forecast")
def forecast(spark, sf_dir):
    return delivery.forecast(order_lines(spark, sf_dir, ["order_ts", "days_real"]))


@query("d16_forecast_by_region")
def forecast_by_region(spark, sf_dir):
    """A series and a forecast for every order region."""
    return delivery.forecast_by(order_lines(spark, sf_dir, ["order_region", "order_ts", "days_real"]), ["order_region"])


@query("d15_daily_series_by_region", on_lines("""
SELECT order_region, CAST(ds AS VARCHAR) AS ds, y, n FROM (
  SELECT order_region, CAST(order_ts AS DATE) AS ds, round(avg(days_real), 6) AS y, count(days_real) AS n
  FROM ol GROUP BY 1, 2 HAVING count(days_real) >= 5)"""))
def daily_series_by_region(spark, sf_dir):
    out = delivery.daily_series(order_lines(spark, sf_dir, ["order_region", "order_ts", "days_real"]), by=["order_region"])
    return rounded(out.withColumn("ds", F.col("ds").cast("string")))


@query("d3_order_value_by_category", on_lines("""
SELECT category_name, count(order_item_total) AS n, quantile_cont(CAST(order_item_total AS DOUBLE), 0.25) AS q25,
  quantile_cont(CAST(order_item_total AS DOUBLE), 0.5) AS median, quantile_cont(CAST(order_item_total AS DOUBLE), 0.9) AS q90
FROM ol GROUP BY category_name"""))
def order_value_by_category(spark, sf_dir):
    """Exact quantiles of a column with as many values as rows, per category."""
    df = order_lines(spark, sf_dir, ["category_name", "order_item_total"])
    out = grouped_quantiles(df, ["category_name"], "order_item_total", {"q25": 0.25, "median": 0.5, "q90": 0.9})
    return out


# --- late risk ----------------------------------------------------------------

_RISK_CATEGORIES = ("shipping_mode", "customer_segment", "market", "order_region")


@query("r2_label_encode", on_lines("SELECT line_key, " + ", ".join(
    f"l_{c}.code AS {c}_encoded" for c in _RISK_CATEGORIES) + " FROM ol " + " ".join(
    f"JOIN (SELECT {c}, CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS INT) AS code FROM ol GROUP BY {c}) l_{c} "
    f"ON ol.{c} = l_{c}.{c}" for c in _RISK_CATEGORIES)))
def label_encode(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["line_key", *_RISK_CATEGORIES])
    return risk.encode_labels(df, risk.fit_labels(df, _RISK_CATEGORIES)).drop(*_RISK_CATEGORIES)


_MANY = ("customer_id", "product_id")


@query("r2_large_dictionaries", on_lines("SELECT line_key, " + ", ".join(
    f"l_{c}.code AS {c}_encoded" for c in _MANY) + " FROM ol " + " ".join(
    f"JOIN (SELECT CAST({c} AS VARCHAR) AS v, CAST(dense_rank() OVER (ORDER BY CAST({c} AS VARCHAR)) - 1 AS INT) AS code FROM ol GROUP BY {c}) l_{c} "
    f"ON CAST(ol.{c} AS VARCHAR) = l_{c}.v" for c in _MANY)))
def large_dictionaries(spark, sf_dir):
    """Columns with as many values as customers and products: their codes are tables."""
    df = order_lines(spark, sf_dir, ["line_key", *_MANY])
    return risk.encode_labels(df, risk.fit_labels(df, _MANY)).drop(*_MANY)


# Stand-in scores for the metric queries: plain functions of the order line.
_SCORES = ("""
SELECT line_key, late_delivery_risk, 0 AS model_order, 'scheduled' AS model, days_scheduled / 4.0 AS score FROM ol
UNION ALL SELECT line_key, late_delivery_risk, 1, 'urgency', 1 - days_scheduled / 4.0 FROM ol
UNION ALL SELECT line_key, late_delivery_risk, 2, 'quantity', order_item_quantity / 50.0 FROM ol""")
_CONFUSION = ("confusion", """SELECT model, model_order,
  count(*) FILTER (late_delivery_risk = 0 AND score < 0.5) AS tn, count(*) FILTER (late_delivery_risk = 0 AND score >= 0.5) AS fp,
  count(*) FILTER (late_delivery_risk = 1 AND score < 0.5) AS fn, count(*) FILTER (late_delivery_risk = 1 AND score >= 0.5) AS tp
FROM scores GROUP BY ALL""")


def _confusion(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["late_delivery_risk", "days_scheduled", "order_item_quantity"])
    sched = F.col("days_scheduled") / 4.0
    scores = (("scheduled", sched), ("urgency", 1 - sched), ("quantity", F.col("order_item_quantity") / 50.0))
    rows = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.lit(i).alias("model_order"),
                                        (s >= 0.5).cast("int").alias("prediction"))
                               for i, (m, s) in enumerate(scores)]))
    scored = df.select("late_delivery_risk", rows.alias("r")).select("late_delivery_risk", "r.*")
    return risk.confusion_counts(scored, by=["model", "model_order"])


@query("r6_r8_classification_metrics", on_lines("""
SELECT *, CAST(row_number() OVER (ORDER BY f1 DESC, model_order) = 1 AS INT) AS is_best FROM (
  SELECT *, round((tp + tn) / CAST(tn + fp + fn + tp AS DOUBLE), 6) AS accuracy,
    round(tp / CAST(tp + fp AS DOUBLE), 6) AS precision, round(tp / CAST(tp + fn AS DOUBLE), 6) AS recall,
    round(2 * tp / CAST(2 * tp + fp + fn AS DOUBLE), 6) AS f1 FROM confusion)""", ("scores", _SCORES), _CONFUSION))
def classification_metrics(spark, sf_dir):
    return rounded(risk.mark_best(risk.classification_metrics(_confusion(spark, sf_dir))))


@query("r6_roc_auc", on_lines("""
SELECT model, round((sum(r) FILTER (late_delivery_risk = 1) - p * (p + 1) / 2) / (p * (n - p)), 6) AS roc_auc FROM (
  SELECT model, late_delivery_risk, rank() OVER (PARTITION BY model ORDER BY score) + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0 AS r,
    CAST(sum(late_delivery_risk) OVER (PARTITION BY model) AS DOUBLE) AS p, CAST(count(*) OVER (PARTITION BY model) AS DOUBLE) AS n
  FROM scores) GROUP BY model, p, n""", ("scores", _SCORES)))
def roc_auc(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["late_delivery_risk", "days_scheduled", "order_item_quantity"])
    sched = F.col("days_scheduled") / 4.0
    scores = {"scheduled": sched, "urgency": 1 - sched, "quantity": F.col("order_item_quantity") / 50.0}
    rows = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), dbl(s).alias("score")) for m, s in scores.items()]))
    return rounded(risk.roc_auc_by(df.select("late_delivery_risk", rows.alias("r")).select("late_delivery_risk", "r.*")))


@query("r7_confusion_matrix", on_lines("SELECT model, tn, fp, fn, tp FROM confusion", ("scores", _SCORES), _CONFUSION))
def confusion_matrix(spark, sf_dir):
    return _confusion(spark, sf_dir).drop("model_order")


@query("r11_risk_segments", on_lines("""
SELECT line_key, score AS risk_probability, CASE WHEN score <= 0 THEN NULL WHEN score <= 0.3 THEN 'Low'
  WHEN score <= 0.6 THEN 'Medium' WHEN score <= 0.8 THEN 'High' WHEN score <= 1.0 THEN 'Critical' END AS risk_segment
FROM (SELECT line_key, (order_item_quantity % 50) / 50.0 AS score FROM ol)"""))
def risk_segments(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["line_key", "order_item_quantity"])
    scored = df.select("line_key", ((F.col("order_item_quantity") % 50) / 50.0).alias("risk_probability"))
    return risk.risk_segments(scored)


@query("r12_target_distribution", on_lines("""
SELECT 'late_delivery_risk' AS kind, CAST(late_delivery_risk AS VARCHAR) AS value, count(*) AS n FROM ol GROUP BY ALL
UNION ALL SELECT 'risk_segment', CASE WHEN q = 0 THEN NULL WHEN q <= 15 THEN 'Low' WHEN q <= 30 THEN 'Medium'
  WHEN q <= 40 THEN 'High' ELSE 'Critical' END, count(*) FROM (SELECT order_item_quantity % 50 AS q FROM ol) GROUP BY ALL"""))
def target_distribution(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["late_delivery_risk", "order_item_quantity"])
    scored = df.select("late_delivery_risk", ((F.col("order_item_quantity") % 50) / 50.0).alias("risk_probability"))
    return risk.value_counts(risk.risk_segments(scored), ["late_delivery_risk", "risk_segment"])


def risk_lines(spark, sf_dir):
    """Label and features, joined once: dictionaries, scalers, fits and scores read them many times."""
    df = order_lines(spark, sf_dir, ["line_key", "late_delivery_risk", "days_scheduled", "order_item_quantity",
                                     "product_price", "order_item_total", "sales_per_customer", "order_ts",
                                     *risk.RISK_CATEGORIES])
    return stored(prep.date_parts(df).select("line_key", risk.LABEL, *RISK_NUMERIC_FEATURES, *risk.RISK_CATEGORIES), "risk-lines")


@query("r5_risk_models")
def risk_model_metrics(spark, sf_dir):
    return risk.risk_metrics_table(spark, train_risk(risk_lines(spark, sf_dir)))


@query("r9_risk_factors")
def risk_factors(spark, sf_dir):
    trained = train_risk(risk_lines(spark, sf_dir), ["rf"], score=False)
    table = delivery.feature_importance(spark, fitted(trained, "rf"), trained.encoder.features)
    return table.where("rank <= 10").orderBy("rank")


@query("r10_predict")
def predict_risk(spark, sf_dir):
    lines = risk_lines(spark, sf_dir)
    return risk.risk_segments(risk.predict_risk(lines, train_risk(lines, ["logistic"], score=False), "logistic"))


@query("r12_top_critical", on_lines("""
SELECT line_key, score AS risk_probability, 'Critical' AS risk_segment FROM (
  SELECT line_key, (order_item_quantity % 50) / 50.0 AS score FROM ol) WHERE score > 0.8 ORDER BY score DESC, line_key LIMIT 5"""))
def top_critical(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["line_key", "order_item_quantity"])
    scored = df.select("line_key", ((F.col("order_item_quantity") % 50) / 50.0).alias("risk_probability"))
    return risk.top_critical(risk.risk_segments(scored))
