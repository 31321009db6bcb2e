"""Order lines with nulls put in by arithmetic on the keys.

The star-schema tables hold no nulls, so the cleaning queries read this view; the same
text runs on both sides of the comparison.
"""

from __future__ import annotations

from haulmetrics.sources.star import order_lines

_K = "(CAST(order_id AS BIGINT) + days_real * 3 + order_item_quantity)"

GAP_COLUMNS = {
    "line_key": "line_key",
    "order_id": "order_id",
    "order_ts": f"CASE WHEN {_K} % 97 = 0 THEN NULL ELSE order_ts END",
    "shipping_ts": "shipping_ts",
    "days_real": f"CASE WHEN {_K} % 89 = 1 THEN NULL ELSE days_real END",
    "days_scheduled": "days_scheduled",
    "late_delivery_risk": "late_delivery_risk",
    "customer_city": f"CASE WHEN {_K} % 83 = 2 THEN NULL ELSE customer_city END",
    "product_price": f"CASE WHEN {_K} % 79 = 3 THEN NULL ELSE product_price END",
    "order_item_quantity": f"CASE WHEN {_K} % 11 = 4 THEN NULL ELSE order_item_quantity END",
    "sales": f"CASE WHEN {_K} % 13 = 5 THEN NULL ELSE sales END",
    "order_item_total": "order_item_total",
    "customer_segment": f"CASE WHEN {_K} % 7 = 1 THEN NULL ELSE customer_segment END",
    "shipping_mode": f"CASE WHEN {_K} % 19 = 2 THEN NULL ELSE shipping_mode END",
    "product_description": f"CASE WHEN {_K} % 10 = 0 THEN customer_segment END",
}
GAPS_SQL = ("gaps", "SELECT " + ",\n".join(f"{e} AS {c}" for c, e in GAP_COLUMNS.items()) + " FROM ol")
CRITICAL_SQL = ("kept", "SELECT * FROM gaps WHERE order_ts IS NOT NULL AND shipping_ts IS NOT NULL "
                "AND days_real IS NOT NULL AND days_scheduled IS NOT NULL AND late_delivery_risk IS NOT NULL "
                "AND customer_city IS NOT NULL AND product_price IS NOT NULL")


def gap_lines(spark, sf_dir, columns=None):
    names = list(columns or GAP_COLUMNS)
    base = set(n for n in names if n != "product_description") | {"order_id", "days_real", "order_item_quantity"}
    if "product_description" in names:
        base.add("customer_segment")
    return order_lines(spark, sf_dir, sorted(base)).selectExpr(*[f"{GAP_COLUMNS[n]} AS {n}" for n in names])
