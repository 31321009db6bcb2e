"""Small column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def dbl(x: Column | str) -> Column:
    return (F.col(x) if isinstance(x, str) else x).cast("double")


def flag(condition: Column) -> Column:
    """0/1 integer; an unknown comparison counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def nonzero(x: Column | str) -> Column:
    """``x`` as double with 0 replaced by 1, the divisor rule of the feature set."""
    x = dbl(x)
    return F.when(x == 0, F.lit(1.0)).otherwise(x)


def lookup(key: Column | str, table: Mapping[str, float | int], default=None) -> Column:
    """Value for ``key`` from a short fixed table, as a CASE expression (no join)."""
    key = F.col(key) if isinstance(key, str) else key
    out = None
    for name, value in table.items():
        out = F.when(key == name, F.lit(value)) if out is None else out.when(key == name, F.lit(value))
    return out.otherwise(F.lit(default)) if default is not None else out


def ratio(numerator: Column, denominator: Column, empty=0.0) -> Column:
    """Division guarded against a zero or missing denominator."""
    return F.when(denominator != 0, numerator / denominator).otherwise(F.lit(empty))


def unpivot_rows(columns: Sequence[tuple[str, Sequence[Column]]], names: Sequence[str]) -> Column:
    """``inline(array(struct(...)))``: turn a one-row result into one row per entry."""
    return F.inline(F.array(*[
        F.struct(F.lit(label).alias(names[0]), *[c.alias(n) for c, n in zip(values, names[1:])])
        for label, values in columns]))


def pin_row(df: DataFrame) -> DataFrame:
    """Evaluate a one-row aggregate now, so that several consumers share the result."""
    row = df.first()
    cells = [F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    return df.sparkSession.range(0, 1, 1, 1).select(*cells)
