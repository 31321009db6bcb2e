"""Validation, profile and preprocessing queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from haulmetrics.operators import preprocess as prep
from haulmetrics.plans.gaps import CRITICAL_SQL, GAP_COLUMNS, GAPS_SQL, gap_lines
from haulmetrics.plans.registry import on_lines, query
from haulmetrics.schema import CSV_COLUMNS, NUMBER_COLUMNS
from haulmetrics.session import ensure_checkpoint_dir
from haulmetrics.sources import csv_lines, quality
from haulmetrics.sources.star import COLUMNS, order_lines

CSV_NAMES = {name: header for header, name, _ in CSV_COLUMNS}
_TEXT_TIME = "M/d/yyyy H:mm"
# Compressed text can't be split, so a file and the task that scans it have at most this many lines.
_LINES_PER_FILE = 500_000


@query("s1_csv_scan", on_lines("SELECT " + ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" if e in ("money", "double") else f"CAST({c} AS VARCHAR) AS {c}" if e == "time" else c
    for c, e in (("line_key", ""), ("order_id", ""), ("customer_city", ""), ("shipping_mode", ""), ("market", ""), ("order_ts", "time"),
                 ("shipping_ts", "time"), ("days_real", ""), ("days_scheduled", ""), ("late_delivery_risk", ""), ("latitude", "double"),
                 ("longitude", "double"), ("order_item_quantity", ""), ("product_price", "money"), ("sales", "money"),
                 ("order_item_discount", "money"), ("order_item_total", "money"), ("order_profit", "money"), ("sales_per_customer", "money"))
    ) + " FROM ol"))
def csv_scan(spark, sf_dir):
    """The order lines written as compressed files of the reference layout and scanned again."""
    columns = [c for c in COLUMNS if c in CSV_NAMES]
    df = order_lines(spark, sf_dir, columns)
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/order-lines-{uuid.uuid4().hex}"
    df.select(*[F.col(c).alias(CSV_NAMES[c]) for c in columns]).write.option("header", True).option("encoding", "ISO-8859-1").option(
        "timestampNTZFormat", _TEXT_TIME).option("compression", "gzip").option("maxRecordsPerFile", _LINES_PER_FILE).csv(path)
    got = csv_lines.read_order_lines(spark, path)
    return got.select("line_key", "order_id", "customer_city", "shipping_mode", "market", F.col("order_ts").cast("string").alias("order_ts"),
                      F.col("shipping_ts").cast("string").alias("shipping_ts"), "days_real", "days_scheduled", "late_delivery_risk",
                      "latitude", "longitude", "order_item_quantity", "product_price", "sales", "order_item_discount", "order_item_total",
                      "order_profit", "sales_per_customer")


# --- validation, profile, sample -------------------------------------------


@query("s2_validation_findings", on_lines("""
SELECT 'missing_column' AS "check", 'warning' AS severity, 'customer_country' AS detail
UNION ALL
SELECT 'duplicate_key', 'warning', concat(CAST(count(*) AS VARCHAR), ' repeated order_id values')
FROM (SELECT order_id FROM ol GROUP BY order_id HAVING count(*) > 1) HAVING count(*) > 0"""))
def validation_findings(spark, sf_dir):
    df = order_lines(spark, sf_dir, [c for c in quality.REQUIRED_COLUMNS if c != "customer_country"])
    return quality.validate(df)


_PROFILED = (("line_key", "string"), ("order_id", "string"), ("order_ts", "timestamp_ntz"), ("shipping_ts", "timestamp_ntz"),
             ("days_real", "int"), ("days_scheduled", "int"), ("late_delivery_risk", "int"), ("customer_city", "string"),
             ("product_price", "decimal(12,2)"), ("order_item_quantity", "int"), ("sales", "decimal(12,2)"),
             ("order_item_total", "decimal(18,4)"), ("customer_segment", "string"), ("shipping_mode", "string"),
             ("product_description", "string"))


def _profile_sql() -> str:
    parts = ["SELECT '*' AS \"column\", 'rows' AS stat, CAST(count(*) AS VARCHAR) AS value FROM gaps",
             f"SELECT '*', 'columns', '{len(_PROFILED)}'"]
    for c, t in _PROFILED:
        parts += [f"SELECT '{c}', 'type', '{t}'",
                  f"SELECT '{c}', 'count', CAST(count({c}) AS VARCHAR) FROM gaps",
                  f"SELECT '{c}', 'nulls', CAST(count(*) - count({c}) AS VARCHAR) FROM gaps"]
        if t.startswith("timestamp"):
            parts += [f"SELECT '{c}', '{s}', CAST({s}({c}) AS VARCHAR) FROM gaps" for s in ("min", "max")]
        elif t != "string":
            x = f"CAST({c} AS DOUBLE)"
            stats = {"mean": f"avg({x})", "std": f"stddev_samp({x})", "min": f"min({x})", "max": f"max({x})",
                     "25%": f"quantile_cont({x}, 0.25)", "50%": f"quantile_cont({x}, 0.5)",
                     "75%": f"quantile_cont({x}, 0.75)"}
            parts += [f"SELECT '{c}', '{s}', printf('%.6f', {e}) FROM gaps" for s, e in stats.items()]
    return "\nUNION ALL ".join(parts)


@query("s3_profile", on_lines(_profile_sql(), GAPS_SQL))
def table_profile(spark, sf_dir):
    return quality.profile(gap_lines(spark, sf_dir, [c for c, _ in _PROFILED]))


@query("s5_sample", on_lines("""
SELECT line_key, order_id, shipping_mode, CAST(order_item_total AS DOUBLE) AS order_item_total
FROM ol ORDER BY line_key LIMIT 5"""))
def sample_rows(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["line_key", "order_id", "shipping_mode", "order_item_total"])
    return quality.first_rows(df, "line_key").withColumn("order_item_total", F.col("order_item_total").cast("double"))


# --- cleaning ---------------------------------------------------------------

_MONEY = ("product_price", "sales", "order_item_total")
_KEPT = [c for c in GAP_COLUMNS if c != "product_description"]


@query("p1_drop_sparse_columns", on_lines("SELECT " + ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" if c in _MONEY else f"CAST({c} AS VARCHAR) AS {c}" if c.endswith("_ts") else c for c in _KEPT)
    + " FROM gaps", GAPS_SQL))
def drop_sparse_columns(spark, sf_dir):
    df = gap_lines(spark, sf_dir)
    kept = df.drop(*prep.sparse_columns(prep.null_rates(df)))
    return kept.withColumns({c: F.col(c).cast("double" if c in _MONEY else "string") for c in kept.columns if c in _MONEY or c.endswith("_ts")})


@query("p2_drop_critical", on_lines(
    "SELECT line_key, days_real, customer_city, CAST(product_price AS DOUBLE) AS product_price FROM kept",
    GAPS_SQL, CRITICAL_SQL))
def drop_critical(spark, sf_dir):
    df = gap_lines(spark, sf_dir, ["line_key", *prep.CRITICAL_COLUMNS])
    return prep.drop_critical_nulls(df).select(
        "line_key", "days_real", "customer_city", F.col("product_price").cast("double").alias("product_price"))


_FILL = ["handle_missing_values"]


@query("p3_median_fill", on_lines("""
SELECT line_key, coalesce(CAST(order_item_quantity AS DOUBLE), mq) AS order_item_quantity,
  coalesce(CAST(sales AS DOUBLE), ms) AS sales
FROM kept, (SELECT quantile_cont(CAST(order_item_quantity AS DOUBLE), 0.5) AS mq,
                   quantile_cont(CAST(sales AS DOUBLE), 0.5) AS ms FROM kept)""", GAPS_SQL, CRITICAL_SQL))
def median_fill(spark, sf_dir):
    df = gap_lines(spark, sf_dir, ["line_key", "order_item_quantity", "sales", *prep.CRITICAL_COLUMNS])
    return prep.preprocess(df, _FILL, pin=True).data.select("line_key", "order_item_quantity", "sales")


def _mode_sql(c: str) -> str:
    return f"(SELECT {c} FROM kept WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


@query("p4_mode_fill", on_lines(f"""
SELECT line_key, coalesce(customer_segment, {_mode_sql('customer_segment')}) AS customer_segment,
  coalesce(shipping_mode, {_mode_sql('shipping_mode')}) AS shipping_mode FROM kept""", GAPS_SQL, CRITICAL_SQL))
def mode_fill(spark, sf_dir):
    df = gap_lines(spark, sf_dir, ["line_key", "customer_segment", "shipping_mode", *prep.CRITICAL_COLUMNS])
    return prep.preprocess(df, _FILL, pin=True).data.select("line_key", "customer_segment", "shipping_mode")


_NUMBERS = {c: 23 + 2 * i for i, c in enumerate(NUMBER_COLUMNS)}
_RAW_TEXT = ("raw", "SELECT line_key, CAST(order_id AS BIGINT) AS order_id, " + ", ".join(
    f"CASE WHEN CAST(order_id AS BIGINT) % {k} = 0 THEN '{'x' if k % 4 == 3 else ''}' ELSE CAST({c} AS VARCHAR(20)) END AS {c}"
    for c, k in _NUMBERS.items()) + " FROM (SELECT *, order_profit AS benefit_per_order FROM ol)")


@query("p5_clean_types", on_lines("SELECT line_key, CAST(order_id AS VARCHAR) AS order_id, " + ", ".join(
    f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in _NUMBERS) + " FROM raw", _RAW_TEXT))
def clean_types(spark, sf_dir):
    """All number columns as text with bad cells in each."""
    df = order_lines(spark, sf_dir, ["line_key", "order_id", *[c for c in _NUMBERS if c != "benefit_per_order"]]).withColumn(
        "benefit_per_order", F.col("order_profit"))
    number = F.col("order_id").cast("bigint")
    raw = df.select("line_key", number.alias("order_id"), *[
        F.when(number % k == 0, "x" if k % 4 == 3 else "").otherwise(F.col(c).cast("string")).alias(c) for c, k in _NUMBERS.items()])
    return prep.clean_types(raw)


# --- derived columns ---------------------------------------------------------

def _derived(spark, sf_dir, columns, step, profile=None):
    """The step's new columns beside the line key."""
    df = order_lines(spark, sf_dir, ["line_key", *columns])
    out = step(df, profile)
    return out.select("line_key", *[F.col(f"`{c}`") for c in out.columns if c not in df.columns])


@query("p6_date_parts", on_lines("""
SELECT line_key, CAST(year(order_ts) AS INT) AS order_year, CAST(month(order_ts) AS INT) AS order_month,
  CAST(day(order_ts) AS INT) AS order_day, CAST(isodow(order_ts) - 1 AS INT) AS order_dayofweek,
  CAST(hour(order_ts) AS INT) AS order_hour, CAST(quarter(order_ts) AS INT) AS order_quarter,
  CAST(isodow(order_ts) >= 6 AS INT) AS is_weekend, CAST(year(shipping_ts) AS INT) AS shipping_year,
  CAST(month(shipping_ts) AS INT) AS shipping_month, CAST(day(shipping_ts) AS INT) AS shipping_day,
  CAST(isodow(shipping_ts) - 1 AS INT) AS shipping_dayofweek FROM ol"""))
def date_parts(spark, sf_dir):
    return _derived(spark, sf_dir, ["order_ts", "shipping_ts"], prep.date_parts)


@query("p7_p8_delay_category", on_lines("""
SELECT line_key, days_real - days_scheduled AS delivery_delay, CAST(days_real > days_scheduled AS INT) AS is_delayed,
  CASE WHEN days_real - days_scheduled <= -2 THEN 'Very Early' WHEN days_real <= days_scheduled THEN 'On Time'
    WHEN days_real - days_scheduled <= 2 THEN 'Slightly Late' ELSE 'Very Late' END AS delay_category FROM ol"""))
def delay_category(spark, sf_dir):
    return _derived(spark, sf_dir, ["days_real", "days_scheduled"], prep.delivery_features).drop("delivery_efficiency")


@query("p9_delivery_efficiency", on_lines("""
SELECT line_key, CAST(days_scheduled AS DOUBLE) / CASE days_real WHEN 0 THEN 1 ELSE days_real END
  AS delivery_efficiency FROM ol"""))
def delivery_efficiency(spark, sf_dir):
    return _derived(spark, sf_dir, ["days_real", "days_scheduled"], prep.delivery_features).select(
        "line_key", "delivery_efficiency")


@query("p10_p11_locations", on_lines("""
SELECT line_key, concat(customer_city, ', ', customer_state, ', ', customer_country) AS customer_location,
  concat(order_city, ', ', order_state, ', ', order_country) AS order_location,
  CAST(customer_city = order_city AS INT) AS same_city, CAST(customer_country = order_country AS INT) AS same_country
FROM ol"""))
def locations(spark, sf_dir):
    return _derived(spark, sf_dir, ["customer_city", "customer_state", "customer_country", "order_city",
                                    "order_state", "order_country"], prep.location_features)


@query("p12_p15_cost_features", on_lines("""
SELECT line_key,
  CAST(order_profit AS DOUBLE) / CASE WHEN sales = 0 THEN 1 ELSE CAST(sales AS DOUBLE) END * 100 AS profit_margin_pct,
  CAST(order_item_total AS DOUBLE) / CASE order_item_quantity WHEN 0 THEN 1 ELSE order_item_quantity END AS revenue_per_item,
  CAST(order_profit > 0 AS INT) AS is_profitable,
  CAST(order_item_discount AS DOUBLE) / CASE WHEN order_item_total = 0 THEN 1 ELSE CAST(order_item_total AS DOUBLE) END * 100 AS discount_impact_pct
FROM ol"""))
def cost_features(spark, sf_dir):
    return _derived(spark, sf_dir, ["order_profit", "sales", "order_item_total", "order_item_quantity",
                                    "order_item_discount"], prep.cost_features)


@query("p16_p18_risk_score", on_lines("""
SELECT line_key, CAST(CAST(order_item_total AS DOUBLE) > q75 AS INT) AS is_high_value_order,
  CAST(days_scheduled <= 2 AS INT) AS is_rush_order,
  CAST(CAST(order_item_total AS DOUBLE) > q75 AS INT) + CAST(days_scheduled <= 2 AS INT)
    + CAST(days_real > days_scheduled AS INT) AS risk_score
FROM ol, (SELECT quantile_cont(CAST(order_item_total AS DOUBLE), 0.75) AS q75 FROM ol)"""))
def risk_score(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["line_key", "order_item_total", "days_real", "days_scheduled"])
    totals = order_lines(spark, sf_dir, ["order_item_total"])
    out = prep.preprocess(df, ["create_delivery_features", "create_risk_features"], totals).data
    return out.select("line_key", "is_high_value_order", "is_rush_order", "risk_score")


# The category levels of the star-schema tables without the first of each.
_LEVELS = {
    "payment_type": ("N", "R"),
    "delivery_status": ("Shipping on time",),
    "customer_segment": ("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
    "shipping_mode": ("Same Day", "Second Class", "Standard Class"),
    "order_status": ("O", "P"),
    "order_region": ("AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"),
    "market": ("AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"),
    "category_name": ("LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"),
    "department_name": tuple(sorted(f"Brand#{i}" for i in range(1, 26)))[1:],
}


@query("p19_one_hot", on_lines("SELECT line_key, " + ", ".join(
    f"CAST(coalesce({c} = '{v}', FALSE) AS INT) AS \"{c}_{v}\"" for c, vs in _LEVELS.items() for v in vs) + " FROM ol"))
def one_hot(spark, sf_dir):
    df = order_lines(spark, sf_dir, ["line_key", *_LEVELS])
    return prep.preprocess(df, ["encode_categorical"]).data.drop(*_LEVELS)
