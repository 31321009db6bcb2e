"""The wide order-line table assembled from the star-schema Parquet tables.

``order_lines`` joins only the tables whose columns were asked for. The dimension
keys are unique and every fact row has its dimension rows (referential integrity of
the star schema), so leaving out an unused dimension cannot change the rows. Pass
``enforce_keys=True`` to join all of them regardless, which drops orphaned lines.

No join is hinted: Spark broadcasts a dimension only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise, where adaptive
execution splits partitions of a hot order, product or customer key.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

_DAYS_REAL = "(l_orderkey*7 + l_linenumber*3 + l_suppkey) % 7"
_DAYS_SCHEDULED = ("CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 "
                   "WHEN '3-MEDIUM' THEN 2 ELSE 4 END")
_ORDER_TS = "o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey % 24 AS INT)"
_TOTAL = ("CAST(l_extendedprice AS DECIMAL(12,2)) * "
          "(CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2)))")

# column -> (expression, tables needed besides lineitem)
COLUMNS: dict[str, tuple[str, str]] = {
    "order_id": ("CAST(l_orderkey AS STRING)", ""),
    "line_key": ("concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-', "
                 "CAST(l_partkey AS STRING), '-', CAST(l_suppkey AS STRING), '-', "
                 "CAST(CAST(l_quantity AS INT) AS STRING))", ""),
    "customer_id": ("CAST(o_custkey AS STRING)", "orders"),
    "product_id": ("CAST(l_partkey AS STRING)", ""),
    "order_ts": (_ORDER_TS, "orders"),
    "shipping_ts": (f"{_ORDER_TS} + INTERVAL '1' DAY * CAST({_DAYS_REAL} AS INT)", "orders"),
    "days_real": (f"CAST({_DAYS_REAL} AS INT)", ""),
    "days_scheduled": (_DAYS_SCHEDULED, "orders"),
    "late_delivery_risk": (f"CASE WHEN {_DAYS_REAL} > {_DAYS_SCHEDULED} THEN 1 ELSE 0 END", "orders"),
    "shipping_mode": ("CASE o_orderpriority WHEN '1-URGENT' THEN 'Same Day' WHEN '2-HIGH' THEN 'First Class' "
                      "WHEN '3-MEDIUM' THEN 'Second Class' ELSE 'Standard Class' END", "orders"),
    "product_price": ("CAST(p_retailprice AS DECIMAL(12,2))", "part"),
    "order_item_quantity": ("CAST(l_quantity AS INT)", ""),
    "sales": ("CAST(l_extendedprice AS DECIMAL(12,2))", ""),
    "order_item_discount": ("CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))", ""),
    "order_item_total": (_TOTAL, ""),
    "sales_per_customer": (_TOTAL, ""),
    "order_profit": ("CAST(l_extendedprice AS DECIMAL(12,2)) * (CAST(0.25 AS DECIMAL(4,2)) "
                     "- CAST(2 AS DECIMAL(4,2)) * CAST(l_discount AS DECIMAL(4,2)) "
                     "- CAST((l_partkey*11) % 10 AS DECIMAL(4,2)) * CAST(0.01 AS DECIMAL(4,2)))", ""),
    "category_name": ("p_type", "part"),
    "department_name": ("p_brand", "part"),
    "customer_segment": ("c_mktsegment", "customer"),
    "customer_city": ("concat('CITY_', CAST(c_custkey % 50 AS STRING))", "customer"),
    "customer_state": ("c_nation", "customer_geo"),
    "customer_country": ("c_region", "customer_geo"),
    "order_city": ("concat('CITY_', CAST(s_suppkey % 50 AS STRING))", "supplier"),
    "order_state": ("s_nation", "supplier_geo"),
    "order_country": ("s_region", "supplier_geo"),
    "order_region": ("c_region", "customer_geo"),
    "market": ("c_region", "customer_geo"),
    "order_status": ("o_orderstatus", "orders"),
    "payment_type": ("l_returnflag", ""),
    "delivery_status": (f"CASE WHEN {_DAYS_REAL} > {_DAYS_SCHEDULED} THEN 'Late delivery' "
                        "ELSE 'Shipping on time' END", "orders"),
    "latitude": ("CAST(((c_nationkey*13) % 25)*4 - 50 AS DOUBLE) + CAST((c_custkey*53) % 400 AS DOUBLE)/100",
                 "customer"),
    "longitude": ("CAST(c_nationkey*9 - 108 AS DOUBLE) + CAST((c_custkey*37) % 600 AS DOUBLE)/100", "customer"),
}

_NEEDS = {
    "orders": {"orders"},
    "part": {"part"},
    "customer": {"orders", "customer"},
    "customer_geo": {"orders", "customer", "customer_geo"},
    "supplier": {"supplier"},
    "supplier_geo": {"supplier", "supplier_geo"},
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _geography(spark: SparkSession, sf_dir: str, prefix: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("n_nationkey").alias(f"{prefix}_geo_key"),
                    F.col("n_name").alias(f"{prefix}_nation"),
                    F.col("r_name").alias(f"{prefix}_region")))


def order_lines(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None,
                enforce_keys: bool = False) -> DataFrame:
    """One row per order line with the requested columns (all when none are named)."""
    names = list(dict.fromkeys(columns)) if columns is not None else list(COLUMNS)
    tables: set[str] = set()
    for name in (COLUMNS if enforce_keys else names):
        tables |= _NEEDS.get(COLUMNS[name][1], set())

    df = table(spark, sf_dir, "lineitem")
    if "part" in tables:
        df = df.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    if "supplier" in tables:
        supplier = table(spark, sf_dir, "supplier")
        if "supplier_geo" in tables:
            supplier = supplier.join(_geography(spark, sf_dir, "s"),
                                     F.col("s_nationkey") == F.col("s_geo_key"))
        df = df.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    if "orders" in tables:
        orders = table(spark, sf_dir, "orders")
        if "customer" in tables:
            customer = table(spark, sf_dir, "customer")
            if "customer_geo" in tables:
                customer = customer.join(_geography(spark, sf_dir, "c"),
                                         F.col("c_nationkey") == F.col("c_geo_key"))
            orders = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        df = df.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return df.select(*[F.expr(COLUMNS[name][0]).alias(name) for name in names])
