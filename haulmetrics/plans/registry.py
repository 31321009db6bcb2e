"""Registered queries and, where one exists, the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from haulmetrics.sources.star import COLUMNS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The same view with every join, for the SQL side.
ORDER_LINES_SQL = "SELECT " + ",\n".join(f"{expr} AS {name}" for name, (expr, _) in COLUMNS.items()) + """
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN part ON l_partkey = p_partkey
JOIN (SELECT c_custkey, c_nationkey, c_mktsegment, n_name AS c_nation, r_name AS c_region
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
  ON o_custkey = c_custkey
JOIN (SELECT s_suppkey, n_name AS s_nation, r_name AS s_region
      FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
  ON l_suppkey = s_suppkey"""


def on_lines(body: str, *views: tuple[str, str]) -> str:
    """SQL over ``ol`` (the order lines) and further named views."""
    ctes = [f"ol AS ({ORDER_LINES_SQL})"] + [f"{name} AS ({text})" for name, text in views]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return register
