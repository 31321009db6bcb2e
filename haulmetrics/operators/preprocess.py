"""Cleaning and feature derivation of the order lines.

``fit`` reads the data a bounded number of times and returns a ``Profile`` of plain
numbers and names; every step is then a projection or filter, so ``transform`` adds no
shuffle and gives the same columns on new data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from haulmetrics.functions.exprs import dbl, flag, nonzero
from haulmetrics.functions.labels import LabelDictionary, fit_labels
from haulmetrics.functions.quantiles import exact_quantiles
from haulmetrics.session import cut_lineage
from haulmetrics.schema import CRITICAL_COLUMNS, ID_COLUMNS, NUMBER_COLUMNS, ONE_HOT_COLUMNS

SPARSE_SHARE = 0.5
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass
class Profile:
    """Everything the steps need to know about the data."""
    sparse: list[str] = field(default_factory=list)
    medians: dict[str, float] = field(default_factory=dict)
    modes: dict[str, str] = field(default_factory=dict)
    high_value: float | None = None
    levels: dict[str, list[str]] = field(default_factory=dict)
    codes: LabelDictionary | None = None


def is_number(t: T.DataType) -> bool:
    return isinstance(t, T.NumericType)


def null_rates(df: DataFrame) -> dict[str, float]:
    """Share of nulls per column, one aggregate."""
    row = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in df.columns]).first()
    return {c: row[c] or 0.0 for c in df.columns}


def sparse_columns(rates: dict[str, float], share: float = SPARSE_SHARE) -> list[str]:
    return [c for c, r in rates.items() if r > share]


def drop_critical_nulls(df: DataFrame, critical: Iterable[str] = CRITICAL_COLUMNS) -> DataFrame:
    present = [c for c in critical if c in df.columns]
    return df.na.drop(subset=present) if present else df


def column_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent value per column, the smallest on ties, 'Unknown' without values.

    Counts are aggregated before the pick, so a frequent value or a column of many
    different ones never gathers in one task.
    """
    if not columns:
        return {}
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in columns]))
    counts = df.select(pairs.alias("p")).select("p.*").where("value IS NOT NULL").groupBy("name", "value").count()
    best = counts.groupBy("name").agg(F.min_by("value", F.struct(-F.col("count"), F.col("value"))).alias("mode"))
    found = {r["name"]: r["mode"] for r in best.collect()}
    return {c: found.get(c, "Unknown") for c in columns}


# A column of up to so many levels becomes a column for each level, one of more gets a single column of codes.
MAX_ONE_HOT = 5_000


def category_levels(df: DataFrame, columns: Sequence[str], max_levels: int = MAX_ONE_HOT) -> dict[str, list[str]]:
    """Sorted distinct values of the columns that have at most ``max_levels``; the levels are counted before any is fetched."""
    if not columns:
        return {}
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value"))
                                for c in columns]))
    distinct = cut_lineage(df.select(pairs.alias("p")).select("p.*").where("value IS NOT NULL").distinct())
    sizes = {r["name"]: r["count"] for r in distinct.groupBy("name").count().collect()}
    out: dict[str, list[str]] = {c: [] for c in columns if sizes.get(c, 0) <= max_levels}
    for r in distinct.where(F.col("name").isin(list(out))).collect():
        out[r["name"]].append(r["value"])
    return {c: sorted(v) for c, v in out.items()}


# --- steps -----------------------------------------------------------------

def fill_missing(df: DataFrame, profile: Profile) -> DataFrame:
    """Drop sparse columns and incomplete rows, then fill with medians and modes."""
    df = drop_critical_nulls(df.drop(*profile.sparse))

    def filled(c: str) -> Column:
        if c in profile.medians:
            return F.coalesce(dbl(c), F.lit(profile.medians[c])).alias(c)
        if c in profile.modes:
            return F.coalesce(F.col(c), F.lit(profile.modes[c])).alias(c)
        return F.col(c)
    return df.select(*[filled(c) for c in df.columns])


def clean_types(df: DataFrame, profile: Profile | None = None) -> DataFrame:
    """Ids to text; number columns that hold text to double, bad text to null."""
    types = {f.name: f.dataType for f in df.schema.fields}

    def cleaned(c: str) -> Column:
        if c in ID_COLUMNS:
            return F.col(c).cast("string").alias(c)
        if c in NUMBER_COLUMNS and not is_number(types[c]):
            return F.col(c).try_cast("double").alias(c)
        return F.col(c)
    return df.select(*[cleaned(c) for c in df.columns])


def _add(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in columns],
                     *[value.alias(name) for name, value in columns.items()])


def _has(df: DataFrame, *columns: str) -> bool:
    return all(c in df.columns for c in columns)


def date_parts(df: DataFrame, profile: Profile | None = None) -> DataFrame:
    """Calendar parts of the order and shipping times; weekdays count from Monday 0."""
    new: dict[str, Column] = {}
    for prefix, column in (("order", "order_ts"), ("shipping", "shipping_ts")):
        if not _has(df, column):
            continue
        ts = F.col(column)
        new |= {f"{prefix}_year": F.year(ts), f"{prefix}_month": F.month(ts),
                f"{prefix}_day": F.dayofmonth(ts), f"{prefix}_dayofweek": F.weekday(ts)}
        if prefix == "order":
            new |= {"order_hour": F.hour(ts), "order_quarter": F.quarter(ts),
                    "is_weekend": flag(F.weekday(ts) >= 5)}
    return _add(df, new)


def delay_category(delay: Column) -> Column:
    """Upper edges -2, 0, 2 belong to the lower class."""
    return (F.when(delay <= -2, "Very Early").when(delay <= 0, "On Time")
            .when(delay <= 2, "Slightly Late").when(delay > 2, "Very Late"))


def delivery_features(df: DataFrame, profile: Profile | None = None) -> DataFrame:
    if not _has(df, "days_real", "days_scheduled"):
        return df
    delay = F.col("days_real") - F.col("days_scheduled")
    return _add(df, {"delivery_delay": delay, "is_delayed": flag(delay > 0),
                     "delay_category": delay_category(delay),
                     "delivery_efficiency": dbl("days_scheduled") / nonzero("days_real")})


def location_features(df: DataFrame, profile: Profile | None = None) -> DataFrame:
    new: dict[str, Column] = {}
    for side in ("customer", "order"):
        parts = [f"{side}_city", f"{side}_state", f"{side}_country"]
        if _has(df, *parts):
            new[f"{side}_location"] = F.concat_ws(", ", *[F.coalesce(F.col(p), F.lit("nan")) for p in parts])
    for level in ("city", "country"):
        if _has(df, f"customer_{level}", f"order_{level}"):
            new[f"same_{level}"] = flag(F.col(f"customer_{level}") == F.col(f"order_{level}"))
    return _add(df, new)


def cost_features(df: DataFrame, profile: Profile | None = None) -> DataFrame:
    """Margins and unit revenue; a divisor of 0 counts as 1."""
    new: dict[str, Column] = {}
    if _has(df, "order_profit", "sales"):
        new["profit_margin_pct"] = dbl("order_profit") / nonzero("sales") * 100
    if _has(df, "order_item_total", "order_item_quantity"):
        new["revenue_per_item"] = dbl("order_item_total") / nonzero("order_item_quantity")
    if _has(df, "order_profit"):
        new["is_profitable"] = flag(F.col("order_profit") > 0)
    if _has(df, "order_item_discount", "order_item_total"):
        new["discount_impact_pct"] = dbl("order_item_discount") / nonzero("order_item_total") * 100
    return _add(df, new)


def risk_features(df: DataFrame, profile: Profile) -> DataFrame:
    """High-value and rush flags and their sum with the delay flag."""
    new: dict[str, Column] = {}
    if _has(df, "order_item_total") and profile.high_value is not None:
        new["is_high_value_order"] = flag(dbl("order_item_total") > profile.high_value)
    if _has(df, "days_scheduled"):
        new["is_rush_order"] = flag(F.col("days_scheduled") <= 2)
    parts = ([F.col("is_delayed")] if _has(df, "is_delayed") else []) + list(new.values())
    if parts:
        score = parts[0]
        for part in parts[1:]:
            score = score + part
        new["risk_score"] = score
    return _add(df, new)


def one_hot(df: DataFrame, profile: Profile) -> DataFrame:
    """0/1 column per level except the first; an unknown or null value is all 0.

    A column with too many levels for that gets ``<column>_encoded``, the place of its value
    among the sorted levels, -1 for an unknown or null one.
    """
    wide = _add(df, {f"{c}_{level}": flag(F.col(c) == level)
                     for c, levels in profile.levels.items() if c in df.columns for level in levels[1:]})
    return profile.codes.apply(wide) if profile.codes is not None else wide


STEPS: dict[str, Callable[[DataFrame, Profile], DataFrame]] = {
    "handle_missing_values": fill_missing,
    "clean_data_types": clean_types,
    "create_datetime_features": date_parts,
    "create_delivery_features": delivery_features,
    "create_geographical_features": location_features,
    "create_cost_features": cost_features,
    "create_risk_features": risk_features,
    "encode_categorical": one_hot,
}


def fit(df: DataFrame, steps: Sequence[str] | None = None, totals: DataFrame | None = None) -> Profile:
    """Learn drops, fills, the high-value threshold and category levels.

    Sparse columns are judged on all rows; everything else after incomplete rows are gone.
    ``totals`` may give ``order_item_total`` of the same lines where that is cheaper to read;
    it is used when no rows are dropped.
    """
    steps = list(STEPS) if steps is None else list(steps)
    profile = Profile()
    types = {f.name: f.dataType for f in df.schema.fields}
    kept = df
    if "handle_missing_values" in steps:
        rates = null_rates(df)
        profile.sparse = sparse_columns(rates)
        kept = drop_critical_nulls(df.drop(*profile.sparse))
        gaps = [c for c in kept.columns if rates[c] > 0 and c not in CRITICAL_COLUMNS]
        numeric = [c for c in gaps if is_number(types[c])]
        if numeric:
            medians = exact_quantiles(kept, numeric, [0.5])
            profile.medians = {c: m[0] for c, m in medians.items() if m[0] is not None}
        profile.modes = column_modes(kept, [c for c in gaps if isinstance(types[c], T.StringType)])
    if "create_risk_features" in steps and "order_item_total" in kept.columns:
        total = dbl("order_item_total") if is_number(types["order_item_total"]) else F.col(
            "order_item_total").try_cast("double")
        if "order_item_total" in profile.medians:
            total = F.coalesce(total, F.lit(profile.medians["order_item_total"]))
        source = totals if totals is not None and "handle_missing_values" not in steps else kept
        profile.high_value = exact_quantiles(source, {"order_item_total": total}, [0.75])["order_item_total"][0]
    if "encode_categorical" in steps:
        present = [c for c in ONE_HOT_COLUMNS if c in kept.columns]
        profile.levels = category_levels(kept, present)
        many = [c for c in present if c not in profile.levels]
        profile.codes = fit_labels(kept, many) if many else None
        for c, mode in profile.modes.items():
            if c in profile.levels and mode not in profile.levels[c]:
                profile.levels[c] = sorted(profile.levels[c] + [mode])
    return profile


def transform(df: DataFrame, profile: Profile, steps: Sequence[str] | None = None) -> DataFrame:
    for step in list(STEPS) if steps is None else steps:
        df = STEPS[step](df, profile)
    return df


@dataclass
class Preprocessed:
    data: DataFrame
    profile: Profile
    applied: list[str]
    warnings: list[str]


def preprocess(df: DataFrame, steps: Sequence[str] | None = None, totals: DataFrame | None = None,
               pin: bool = False) -> Preprocessed:
    """Run named steps in order; unknown names and failing steps become warnings.

    ``pin`` writes the input once before the passes that learn from it, for inputs that are
    costlier to compute than to store.
    """
    df = cut_lineage(df) if pin else df
    wanted = list(STEPS) if steps is None else list(steps)
    warnings = [f"unknown step: {s}" for s in wanted if s not in STEPS]
    known = [s for s in wanted if s in STEPS]
    profile = fit(df, known, totals)
    applied, out = [], df
    for step in known:
        try:
            out = STEPS[step](out, profile)
            applied.append(step)
        except Exception as exc:  # a step that does not fit the input is skipped
            warnings.append(f"{step}: {exc}")
    return Preprocessed(out, profile, applied, warnings)


def summary(before: DataFrame, result: Preprocessed) -> DataFrame:
    """Steps, shapes, added columns, null counts and type counts as (item, value) text."""
    after = result.data
    spark = before.sparkSession
    nulls = after.agg(F.count(F.lit(1)).alias("rows"),
                      *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(after.columns)]).first()
    types = [f.dataType for f in after.schema.fields]
    items = [("steps_applied", ", ".join(result.applied)),
             ("warnings", "; ".join(result.warnings)),
             ("rows_before", str(before.count())), ("rows_after", str(nulls["rows"])),
             ("columns_before", str(len(before.columns))), ("columns_after", str(len(after.columns))),
             ("new_columns_added", str(len(after.columns) - len(before.columns))),
             ("numeric_columns", str(sum(is_number(t) for t in types))),
             ("text_columns", str(sum(isinstance(t, T.StringType) for t in types)))]
    items += [(f"nulls:{c}", str(nulls[f"n{i}"])) for i, c in enumerate(after.columns) if nulls[f"n{i}"]]
    return spark.createDataFrame(items, "item string, value string")
