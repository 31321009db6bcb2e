"""Codes for the values of category columns, for dictionaries of any size."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from haulmetrics.functions.ranks import dense_codes
from haulmetrics.session import cut_lineage

ENCODED = "{}_encoded"
# Dictionaries up to this many values are literals in the plan, larger ones tables that are joined.
LITERAL_LEVELS = 64


def label_code(column: str, levels: Sequence[str]) -> Column:
    """Position of the value among the sorted levels, -1 for one not seen in fitting."""
    value = F.col(column).cast("string")
    place = F.array_position(F.array(*[F.lit(v) for v in levels]), value) - 1
    return F.coalesce(place, F.lit(-1)).cast("int")


@dataclass
class LabelDictionary:
    """Codes of the values of some columns: short lists, and tables ``value, code`` for long ones."""
    levels: dict[str, list[str]]
    tables: dict[str, DataFrame] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [*self.levels, *self.tables]

    def apply(self, df: DataFrame, keep: Sequence[Column | str] = ("*",)) -> DataFrame:
        """``keep`` and ``<column>_encoded`` for each column that ``df`` has; an unseen or null value is -1.

        A long dictionary is joined; Spark splits the join where a value is frequent, or
        broadcasts the dictionary if it is small enough for that.
        """
        kept = df.select(*keep, *[label_code(c, v).alias(ENCODED.format(c)) for c, v in self.levels.items() if c in df.columns],
                         *[F.col(c).cast("string").alias(f"{ENCODED.format(c)}_") for c in self.tables if c in df.columns])
        for c, table in self.tables.items():
            if c in df.columns:
                spare = f"{ENCODED.format(c)}_"
                codes = table.select(F.col("value").alias(f"{spare}_"), F.col("code").alias(f"{spare}__"))
                kept = kept.join(codes, F.col(spare) == F.col(f"{spare}_"), "left").withColumn(
                    ENCODED.format(c), F.coalesce(f"{spare}__", F.lit(-1)).cast("int")).drop(spare, f"{spare}_", f"{spare}__")
        return kept


def fit_labels(df: DataFrame, columns: Sequence[str], literal_levels: int = LITERAL_LEVELS) -> LabelDictionary:
    """Codes in sorted order for the values that occur; only dictionaries up to ``literal_levels`` reach the driver."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return LabelDictionary({})
    codes = cut_lineage(dense_codes(df, present))
    sizes = {r["name"]: r["n"] for r in codes.groupBy("name").agg(F.count(F.lit(1)).alias("n")).collect()}
    short = {c: [] for c in present if sizes.get(c, 0) <= literal_levels}
    if short:
        for r in codes.where(F.col("name").isin(list(short))).orderBy("name", "code").collect():
            short[r["name"]].append(r["value"])
    return LabelDictionary(short, {c: codes.where(F.col("name") == c).select("value", "code") for c in present if c not in short})
