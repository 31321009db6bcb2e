"""Delivery, cost, error, route and balance KPIs.

Statistics of whole days go through a count per day value, which combines before the
shuffle and leaves a table as small as the number of different day counts; median and
deviation are then taken from those counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from haulmetrics.functions.exprs import dbl, flag, ratio

MAPE_EPSILON = 1e-10


def day_statistics(day: str, n: str) -> dict[str, Column]:
    """Mean, median, sample deviation, extremes from (day value, line count) rows."""
    v, k = dbl(day), F.when(F.col(day).isNotNull(), F.col(n))
    count, s1, s2 = F.sum(k), F.sum(v * k), F.sum(v * v * k)
    return {
        "mean": s1 / count, "median": F.percentile(v, 0.5, k), "count": count,
        "std": F.when(count > 1, F.sqrt(F.greatest(F.lit(0.0), (s2 - s1 * s1 / count) / (count - 1)))),
        "min": F.min(day), "max": F.max(day)}


def _delivery_part(day: str, n: str, late: str | None) -> list[Column]:
    stats = day_statistics(day, n)
    out = [stats[s].alias(f"{s}_delivery_days") for s in ("mean", "median", "std", "min", "max")]
    if late:
        total_late, rows = F.sum(late), F.sum(n)
        rate = total_late / rows * 100
        out += [total_late.alias("late_delivery_count"), rate.alias("late_delivery_rate"),
                (100 - rate).alias("on_time_rate")]
    return out


def _cost_part(revenue: Column, profit: Column, sales_rows: Column, profit_rows: Column) -> list[Column]:
    return [dbl(revenue).alias("total_revenue"), dbl(profit).alias("total_profit"),
            (dbl(revenue) / sales_rows).alias("avg_order_value"),
            (dbl(profit) / profit_rows).alias("avg_profit_per_order"),
            F.when(revenue > 0, dbl(profit) / dbl(revenue) * 100).otherwise(0.0).alias("profit_margin")]


def delivery_kpis(df: DataFrame, actual: str = "days_real", late: str = "late_delivery_risk",
                  predicted: str | None = None) -> DataFrame:
    late = late if late in df.columns else None
    aggs = [F.count(F.lit(1)).alias("n")] + ([F.sum(late).alias("late")] if late else [])
    out = df.groupBy(actual).agg(*aggs).agg(*_delivery_part(actual, "n", "late" if late else None))
    if predicted and predicted in df.columns:
        errors = regression_errors(df, actual, predicted).first()
        out = out.select("*", *[F.lit(errors[e]).alias(f"prediction_{e}") for e in ("mae", "rmse", "r2")])
    return out


def cost_kpis(df: DataFrame, sales: str = "sales", profit: str = "order_profit",
              shipping_cost: str = "estimated_shipping_cost") -> DataFrame:
    aggs = _cost_part(F.sum(sales), F.sum(profit), F.count(sales), F.count(profit))
    aggs.append(F.count(F.lit(1)).alias("total_orders"))
    if shipping_cost in df.columns:
        spent = dbl(F.sum(shipping_cost))
        aggs += [spent.alias("total_shipping_cost"), F.avg(dbl(shipping_cost)).alias("avg_shipping_cost"),
                 (ratio(spent, dbl(F.sum(sales))) * 100).alias("shipping_cost_ratio")]
    return df.agg(*aggs)


def baseline(df: DataFrame) -> DataFrame:
    """Delivery and cost KPIs, row count and order-date range in one pass."""
    by_day = df.groupBy("days_real").agg(
        F.count(F.lit(1)).alias("n"), F.sum("late_delivery_risk").alias("late"),
        F.sum("sales").alias("sales"), F.count("sales").alias("sales_rows"),
        F.sum("order_profit").alias("profit"), F.count("order_profit").alias("profit_rows"),
        F.min("order_ts").alias("first_ts"), F.max("order_ts").alias("last_ts"))
    return by_day.agg(
        *_delivery_part("days_real", "n", "late"),
        *_cost_part(F.sum("sales"), F.sum("profit"), F.sum("sales_rows"), F.sum("profit_rows")),
        F.sum("n").alias("total_orders"), F.min("first_ts").alias("period_start"),
        F.max("last_ts").alias("period_end"))


def regression_errors(df: DataFrame, y: str, yhat: str, by: Sequence[str] = ()) -> DataFrame:
    """MAE, MSE, RMSE, MAPE and R2; constant targets give R2 1 when exact and 0 otherwise."""
    truth = dbl(y)
    gap = truth - dbl(yhat)
    squares, spread, n = F.sum(gap * gap), F.var_pop(truth), F.count(gap)
    r2 = F.when(spread > 0, 1 - squares / (spread * n)).otherwise(F.when(squares == 0, 1.0).otherwise(0.0))
    return df.groupBy(*by).agg(
        F.avg(F.abs(gap)).alias("mae"), F.avg(gap * gap).alias("mse"), F.sqrt(F.avg(gap * gap)).alias("rmse"),
        (F.avg(F.abs(gap / (truth + MAPE_EPSILON))) * 100).alias("mape"), r2.alias("r2"))


def predicted_class(score: Column, is_array: bool, threshold: float = 0.5) -> Column:
    """0/1 from a probability, or the index of the largest entry of a score array."""
    if is_array:
        return (F.array_position(score, F.array_max(score)) - 1).cast("int")
    return flag(score >= threshold)


def accuracy(df: DataFrame, label: str, score: str, threshold: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    is_array = isinstance(df.schema[score].dataType, T.ArrayType)
    hit = flag(predicted_class(F.col(score), is_array, threshold) == F.col(label))
    return df.groupBy(*by).agg(F.avg(hit).alias("accuracy"))


def savings(df: DataFrame, baseline_cost: str = "baseline_cost", optimized_cost: str = "optimized_cost") -> DataFrame:
    """Absolute and relative savings of paired rows; 0 % for a baseline of 0 or less."""
    base, new = dbl(baseline_cost), dbl(optimized_cost)
    return df.select("*", (base - new).alias("absolute_savings"),
                     F.when(base > 0, (base - new) / base * 100).otherwise(0.0).alias("percentage_savings"))


def improvement_pct(before: Column, after: Column, higher_is_better: bool = True) -> Column:
    change = after - before if higher_is_better else before - after
    return F.when(before == 0, 0.0).otherwise(change / F.abs(before) * 100)


def edge_stats(edges: DataFrame, by: Sequence[str] = ("region",), km: str = "km") -> DataFrame:
    """Distance-matrix statistics over both directions; mean and minimum of positive cells."""
    positive = F.when(F.col(km) > 0, F.col(km))
    return edges.groupBy(*by).agg(F.sum(km).alias("total_distance"), F.avg(positive).alias("avg_distance"),
                                  F.max(km).alias("max_distance"), F.min(positive).alias("min_distance"))


def route_kpis(routes: DataFrame, by: Sequence[str] = (), distance: str = "distance_km",
               minutes: str = "total_time_min", stops: str = "num_stops") -> DataFrame:
    """Counts, totals, averages and extremes over route rows; zeros without routes."""
    def total(c: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0))
    n = F.count(F.lit(1))
    return routes.groupBy(*by).agg(
        n.alias("num_routes"),
        dbl(total(distance)).alias("total_distance"), ratio(dbl(total(distance)), n).alias("avg_distance_per_route"),
        dbl(total(minutes)).alias("total_time"), ratio(dbl(total(minutes)), n).alias("avg_time_per_route"),
        total(stops).cast("bigint").alias("total_stops"), ratio(dbl(total(stops)), n).alias("avg_stops_per_route"),
        F.coalesce(F.max(dbl(distance)), F.lit(0.0)).alias("max_route_distance"),
        F.coalesce(F.min(dbl(distance)), F.lit(0.0)).alias("min_route_distance"))


def balance_score(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """1 / (1 + CV) with the population deviation; 1.0 under two values or for mean 0."""
    x = dbl(value)
    mean = F.avg(x)
    even = (F.count(x) < 2) | (mean == 0)
    return df.groupBy(*by).agg(F.when(even, 1.0).otherwise(1 / (1 + F.stddev_pop(x) / mean)).alias("balance_score"))
