"""Validation findings, column profile and samples of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from haulmetrics.functions.exprs import dbl, unpivot_rows
from haulmetrics.functions.quantiles import exact_quantiles
from haulmetrics.operators.preprocess import is_number
from haulmetrics.schema import REQUIRED_COLUMNS, SEED


def validate(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS, key: str = "order_id") -> DataFrame:
    """Findings (check, severity, detail): missing columns, duplicate keys.

    An empty table raises. Duplicates are found by a grouped count, which combines a
    frequent key before the shuffle.
    """
    if df.isEmpty():
        raise ValueError("the table has no rows")
    spark = df.sparkSession
    missing = [c for c in required if c not in df.columns]
    findings = spark.createDataFrame([("missing_column", "warning", c) for c in missing],
                                     "check string, severity string, detail string")
    if key in df.columns:
        repeated = df.groupBy(key).count().where("count > 1").agg(F.count(F.lit(1)).alias("n")).where("n > 0")
        findings = findings.unionByName(repeated.select(
            F.lit("duplicate_key").alias("check"), F.lit("warning").alias("severity"),
            F.concat(F.col("n").cast("string"), F.lit(f" repeated {key} values")).alias("detail")))
    return findings


def profile(df: DataFrame) -> DataFrame:
    """Long profile (column, stat, value): row, null and type facts and describe numbers.

    Values are text so that dates, names and numbers fit one column; numbers are rounded
    to six digits.
    """
    numeric = [f.name for f in df.schema.fields if is_number(f.dataType)]
    dates = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType, T.DateType))]
    quartiles = exact_quantiles(df, numeric, (0.25, 0.5, 0.75)) if numeric else {}

    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count(F.col(c)).alias(f"count_{c}") for c in df.columns]
    for c in numeric:
        x = dbl(c)
        aggs += [F.avg(x).alias(f"mean_{c}"), F.stddev_samp(x).alias(f"std_{c}"),
                 F.min(x).alias(f"min_{c}"), F.max(x).alias(f"max_{c}")]
    for c in dates:
        aggs += [F.min(c).cast("string").alias(f"min_{c}"), F.max(c).cast("string").alias(f"max_{c}")]
    row = df.agg(*aggs)

    def num(x):
        return F.format_string("%.6f", x)
    items = [("*", "rows", F.col("rows").cast("string")), ("*", "columns", F.lit(str(len(df.columns))))]
    for f in df.schema.fields:
        c = f.name
        items += [(c, "type", F.lit(f.dataType.simpleString())),
                  (c, "count", F.col(f"count_{c}").cast("string")),
                  (c, "nulls", (F.col("rows") - F.col(f"count_{c}")).cast("string"))]
        if c in numeric:
            items += [(c, s, num(F.col(f"{s}_{c}"))) for s in ("mean", "std", "min", "max")]
            items += [(c, s, num(F.lit(q).cast("double"))) for s, q in zip(("25%", "50%", "75%"), quartiles[c])]
        if c in dates:
            items += [(c, s, F.col(f"{s}_{c}")) for s in ("min", "max")]
    return row.select(unpivot_rows([(c, (F.lit(s), v)) for c, s, v in items], ("column", "stat", "value")))


def first_rows(df: DataFrame, key: str | Sequence[str], n: int = 5) -> DataFrame:
    """The first n rows in key order (Spark rows have no order of their own)."""
    return df.orderBy(*([key] if isinstance(key, str) else key)).limit(n)


# Rows that one task may hold at the border of a sample.
SORTED_ROWS = 10_000


def hash_sample(df: DataFrame, key: str, n: int, seed: int = SEED, sorted_rows: int = SORTED_ROWS) -> DataFrame:
    """A repeatable random sample: the n rows with the least hashes of their key, independent of partitioning.

    The hash below which rows are taken comes from counts of its leading bits, refined until
    what is left of the sample fits ``sorted_rows``; only those few rows are sorted. Rows
    that share one key share a hash and are refined no further.
    """
    h = F.xxhash64(F.col(key), F.lit(seed))
    ordered = lambda rows, count: rows.orderBy(h, F.col(key)).limit(count)
    if n <= sorted_rows:
        return ordered(df, n)
    low, high, left = -(1 << 63), 1 << 63, n
    for shift in (48, 32, 16, 0):
        inside = df.where((h >= low) & (h <= high - 1))
        counts = sorted(inside.groupBy(F.shiftright(h, shift).alias("step")).count().collect())  # 65,536 steps at most
        for step, count in counts:
            if count > left:
                low, high = step << shift, (step + 1) << shift
                break
            left -= count
        else:
            return df
        if left <= sorted_rows:
            break
    below = df.where(h < low)
    return below.unionByName(ordered(df.where((h >= low) & (h <= high - 1)), left)) if left else below
