"""Delivery-time analysis, regression models and forecast."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, functions as F

from haulmetrics.functions.exprs import dbl
from haulmetrics.functions.quantiles import exact_quantiles
from haulmetrics.operators.boosting import TaskGBTRegressor
from haulmetrics.operators.forests import FullForestRegressor
from haulmetrics.operators.metrics import day_statistics, regression_errors
from haulmetrics.operators.training import NODE_MEMORY_MB, feature_stages, one_task_first, score_together, side_by_side, training_rows
from haulmetrics.schema import CV_FOLDS, DELIVERY_FEATURES, FORECAST_DAYS, FULL_DEPTH, SEED, TEST_PERCENT

TARGET = "days_real"
CATEGORIES = ("category_name", "department_name", "customer_segment")


def delivery_stats(df: DataFrame, day: str = TARGET) -> DataFrame:
    """Statistics of the delivery days and the delayed share in percent."""
    by_day = df.groupBy(day).agg(F.count(F.lit(1)).alias("n"), F.sum("is_delayed").alias("late"))
    stats = day_statistics(day, "n")
    return by_day.agg(*[stats[s].alias(f"{s}_delivery_time") for s in ("mean", "median", "std", "min", "max")],
                      (F.sum("late") / F.sum("n") * 100).alias("late_delivery_rate"))


def delivery_by_category(df: DataFrame, categories: Sequence[str] = CATEGORIES, day: str = TARGET) -> DataFrame:
    """Mean, median, count, deviation of delivery days per value of each category.

    Lines are first counted per combination of categories and day, so the rows that are
    spread over the dimensions are as few as the combinations, whatever the data size.
    """
    present = [c for c in categories if c in df.columns]
    counts = df.where(F.col(day).isNotNull()).groupBy(*present, day).agg(F.count(F.lit(1)).alias("n"))
    spread = F.explode(F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).alias("value")) for c in present]))
    per_value = (counts.select(spread.alias("d"), day, "n").select("d.*", day, "n").where("value IS NOT NULL")
                 .groupBy("dimension", "value", day).agg(F.sum("n").alias("n")))
    stats = day_statistics(day, "n")
    return per_value.groupBy("dimension", "value").agg(
        *[stats[s].alias(s) for s in ("mean", "median", "count", "std")])


def delivery_by_month(df: DataFrame, day: str = TARGET) -> DataFrame:
    return (df.where(F.col("order_month").isNotNull()).groupBy("order_month")
            .agg(F.avg(day).alias("mean"), F.count(day).alias("count")))


# --- features -----------------------------------------------------------------

@dataclass
class FeatureFill:
    """Medians used for missing features and target."""
    features: list[str]
    medians: dict[str, float]


def fit_feature_fill(df: DataFrame, features: Sequence[str] = DELIVERY_FEATURES, target: str = TARGET) -> FeatureFill:
    """Medians of the features present; one without any value is left out."""
    present = [c for c in features if c in df.columns]
    columns = present + ([target] if target in df.columns else [])
    medians = {c: m[0] for c, m in exact_quantiles(df, columns, [0.5]).items() if m[0] is not None}
    return FeatureFill([c for c in present if c in medians], medians)


def fill_features(df: DataFrame, fill: FeatureFill, keep: Sequence[str] = ()) -> DataFrame:
    """Features (and target) as doubles with missing values at their median."""
    return df.select(*keep, *[F.coalesce(dbl(c), F.lit(m)).alias(c)
                              for c, m in fill.medians.items() if c in df.columns and c not in keep])


def iqr_filter(df: DataFrame, target: str = TARGET, min_rows: int = 10) -> DataFrame:
    """Rows whose target lies within 1.5 interquartile ranges, given over ``min_rows`` rows."""
    if df.where(F.col(target).isNotNull()).limit(min_rows + 1).count() <= min_rows:
        return df
    low, high = exact_quantiles(df, [target], (0.25, 0.75))[target]
    reach = 1.5 * (high - low)
    return df.where(dbl(target).between(low - reach, high + reach))


def hash_split(df: DataFrame, key: str = "line_key", test_percent: int = TEST_PERCENT,
               seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the row key: repeatable, no shuffle."""
    bucket = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(100))
    return df.where(bucket >= test_percent), df.where(bucket < test_percent)


# --- models -------------------------------------------------------------------

def regressors(target: str = TARGET, seed: int = SEED, max_depth: int = FULL_DEPTH) -> dict:
    """The compared models; depth 3 boosting, and for the forest all features per split and full trees."""
    common = {"featuresCol": "scaled", "labelCol": target}
    return {
        "linear_regression": LinearRegression(**common),
        "random_forest": FullForestRegressor(**common, numTrees=100, maxDepth=max_depth, seed=seed,
                                               featureSubsetStrategy="all", cacheNodeIds=True, maxMemoryInMB=NODE_MEMORY_MB),
        "gradient_boosting": TaskGBTRegressor(**common, maxIter=100, maxDepth=3, stepSize=0.1, seed=seed),
    }


@dataclass
class DeliveryModels:
    fill: FeatureFill
    models: dict[str, PipelineModel] = field(default_factory=dict)
    metrics: dict[str, dict[str, float]] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)
    cv_mae: dict[str, float | None] = field(default_factory=dict)

    @property
    def best(self) -> str | None:
        """The model with the lowest MAE, the first by name of equals."""
        return min(self.metrics, key=lambda m: (self.metrics[m]["mae"], m), default=None)


def prepare(df: DataFrame, key: str = "line_key") -> tuple[FeatureFill, DataFrame]:
    fill = fit_feature_fill(df)
    return fill, iqr_filter(fill_features(df, fill, keep=[key]))


@dataclass
class _Table:
    """Scaled train rows with their fold, scaled test rows, and how both were made."""
    fill: FeatureFill
    scaler: PipelineModel
    train: DataFrame
    test: DataFrame


def _training_table(df: DataFrame, key: str, folds: int, fits: int) -> _Table:
    fill, data = prepare(df, key)
    train, test = hash_split(data, key)
    fold = F.pmod(F.xxhash64(F.col(key), F.lit(SEED + 1)), F.lit(folds or 1)).cast("int").alias("fold")
    scaler = Pipeline(stages=feature_stages(fill.features)).fit(train)
    rows = training_rows(scaler.transform(train).select("scaled", TARGET, fold), fits)
    return _Table(fill, scaler, rows, scaler.transform(test).select("scaled", TARGET))


def _fold_mae(estimator, rows: DataFrame, fold: int) -> float:
    """MAE on one fold of a model fitted on the others."""
    model = estimator.fit(rows.where(F.col("fold") != fold))
    mae = regression_errors(model.transform(rows.where(F.col("fold") == fold)), TARGET, "prediction").first()["mae"]
    if hasattr(model, "release"):
        model.release()
    return mae


def _wanted(estimators: Mapping[str, object] | None, names: Sequence[str] | None) -> dict[str, object]:
    return {n: e for n, e in (estimators or regressors()).items() if names is None or n in names}


def train_delivery_models(df: DataFrame, names: Sequence[str] | None = None, key: str = "line_key",
                          estimators: Mapping[str, object] | None = None, folds: int = 0, score: bool = True) -> DeliveryModels:
    """Fit each model on the hash-split train rows and score it on the rest.

    A model that fails is recorded and the others go on. With ``folds`` each model is also
    fitted once for each fold, on the same persisted rows, and ``cv_mae`` has the mean error.
    Without ``score`` the test rows are left alone and no model has metrics.
    """
    wanted = _wanted(estimators, names)
    table = _training_table(df, key, folds, len(wanted) * (folds + 1))
    out = DeliveryModels(table.fill)
    jobs = {(n, k): partial(e.fit, table.train) if k is None else partial(_fold_mae, e, table.train, k)
            for n, e in one_task_first(wanted) for k in (None, *range(folds))}
    try:
        results = side_by_side(jobs)
    finally:
        table.train.unpersist()
    fitted = {n: results[n, None] for n in wanted}
    out.errors = {n: str(m) for n, m in fitted.items() if isinstance(m, Exception)}
    good = {n: m for n, m in fitted.items() if n not in out.errors}
    out.models = {n: PipelineModel(stages=[*table.scaler.stages, m]) for n, m in good.items()}
    out.cv_mae = {n: _mean_error([results[n, k] for k in range(folds)]) for n in wanted} if folds else {}
    if good and score:
        for row in regression_errors(score_together(good, table.test, [TARGET]), TARGET, "prediction", ["model"]).collect():
            out.metrics[row["model"]] = {m: row[m] for m in ("mae", "mse", "rmse", "r2")}
    return out


def _mean_error(errors: list) -> float | None:
    """Mean over the folds; a model that failed on one has no score."""
    return None if any(isinstance(e, Exception) or e is None for e in errors) else sum(errors) / len(errors)


def cross_validate(df: DataFrame, names: Sequence[str] | None = None, folds: int = CV_FOLDS, key: str = "line_key",
                   estimators: Mapping[str, object] | None = None) -> DataFrame:
    """Mean MAE over folds of the train rows, (model, cv_mae); folds come from the row key.

    One fit for each model and fold, all on the same persisted rows, a few side by side; a
    model that fails has no score.
    """
    wanted = _wanted(estimators, names)
    table = _training_table(df, key, folds, len(wanted) * folds)
    try:
        errors = side_by_side({(n, k): partial(_fold_mae, e, table.train, k) for n, e in one_task_first(wanted) for k in range(folds)})
    finally:
        table.train.unpersist()
    rows = [(n, _mean_error([errors[n, k] for k in range(folds)])) for n in wanted]
    return df.sparkSession.createDataFrame(rows, "model string, cv_mae double")


def cv_table(spark, trained: DeliveryModels) -> DataFrame:
    """(model, cv_mae) of models trained with folds."""
    return spark.createDataFrame(list(trained.cv_mae.items()), "model string, cv_mae double")


def model_metrics(spark, trained: DeliveryModels) -> DataFrame:
    """(model, mae, mse, rmse, r2, error); a failed model has only its error."""
    rows = [(name, m["mae"], m["mse"], m["rmse"], m["r2"], None) for name, m in trained.metrics.items()]
    rows += [(name, None, None, None, None, error) for name, error in trained.errors.items()]
    return spark.createDataFrame(rows, "model string, mae double, mse double, rmse double, r2 double, error string")


def model_comparison(metrics: DataFrame, cv: DataFrame | None = None) -> DataFrame:
    """Metrics rounded to 4 digits with the lowest MAE marked best."""
    table = metrics.where("error IS NULL").select("model", "mae", "rmse", "r2")
    if cv is not None:
        table = table.join(cv, "model", "left")
    best = table.agg(F.min_by("model", F.struct("mae", "model")).alias("m")).first()["m"]
    shown = [c for c in table.columns if c != "model"]
    return table.select("model", *[F.round(c, 4).alias(c) for c in shown],
                        (F.col("model") == best).cast("int").alias("is_best"))


def feature_importance(spark, models: Mapping[str, PipelineModel], features: Sequence[str]) -> DataFrame:
    """(model, feature, importance, rank): split importances, or absolute coefficients."""
    rows = []
    for name, model in models.items():
        last = model.stages[-1]
        if hasattr(last, "featureImportances"):
            weights = last.featureImportances.toArray()
        else:
            weights = [abs(float(w)) for w in last.coefficients]
        order = sorted(zip(features, weights), key=lambda p: (-p[1], p[0]))
        rows += [(name, f, float(w), i + 1) for i, (f, w) in enumerate(order)]
    return spark.createDataFrame(rows, "model string, feature string, importance double, rank int")


def predict_days(df: DataFrame, trained: DeliveryModels, model: str | None = None,
                 keep: Sequence[str] = ("line_key",)) -> DataFrame:
    """Predicted days for every row by the named or the best trained model; no row is dropped while scoring."""
    if not trained.models:
        raise ValueError("no model is trained")
    model = model or trained.best or min(trained.models)
    if model not in trained.models:
        raise ValueError(f"model {model} is not trained")
    filled = fill_features(df.drop(TARGET) if TARGET in df.columns else df, trained.fill, keep)
    return trained.models[model].transform(filled).select(*keep, F.col("prediction").alias("predicted_days"))


# --- time series --------------------------------------------------------------

def daily_series(df: DataFrame, min_lines: int = 5, by: Sequence[str] = (), day: str = TARGET) -> DataFrame:
    """Mean delivery days per order date, dates with enough lines only."""
    return (df.where(F.col("order_ts").isNotNull())
            .groupBy(*by, F.to_date("order_ts").alias("ds")).agg(F.avg(day).alias("y"), F.count(day).alias("n"))
            .where(F.col("n") >= min_lines))


YEARLY_TERMS, WEEKLY_TERMS = 10, 3
Z_80 = 1.2815515655446004  # two-sided 80 % band of the normal distribution


def season_terms(ds: Column, start, scale_days: float) -> list[Column]:
    """Trend and Fourier columns of a date."""
    t = F.datediff(ds, F.lit(start)).cast("double")
    absolute = F.datediff(ds, F.lit("1970-01-01").cast("date")).cast("double")
    terms = [(t / scale_days).alias("trend")]
    for label, period, order in (("year", 365.25, YEARLY_TERMS), ("week", 7.0, WEEKLY_TERMS)):
        for k in range(1, order + 1):
            angle = absolute * (2 * math.pi * k / period)
            terms += [F.sin(angle).alias(f"{label}_sin{k}"), F.cos(angle).alias(f"{label}_cos{k}")]
    return terms


def forecast(df: DataFrame, periods: int = FORECAST_DAYS, min_lines: int = 5) -> DataFrame:
    """Next days' delivery time with an 80 % band: (ds, yhat, yhat_lower, yhat_upper).

    A linear model of log(1 + y) on trend, yearly and weekly terms, so that the seasonal
    effects multiply. The series has one row per calendar date however many lines exist.
    """
    spark = df.sparkSession
    series = daily_series(df, min_lines).persist()
    try:
        span = series.agg(F.min("ds").alias("a"), F.max("ds").alias("b"), F.count(F.lit(1)).alias("n")).first()
        if span["n"] < 2:
            raise ValueError("too few dates for a forecast")
        length = max((span["b"] - span["a"]).days, 1)
        terms = season_terms(F.col("ds"), span["a"], float(length))
        names = ["trend"] + [f"{label}_{fn}{k}" for label, order in (("year", YEARLY_TERMS), ("week", WEEKLY_TERMS))
                             for k in range(1, order + 1) for fn in ("sin", "cos")]
        assemble = VectorAssembler(inputCols=names, outputCol="features")
        train = assemble.transform(series.select("ds", F.log1p("y").alias("label"), *terms))
        model = LinearRegression(regParam=1e-6, solver="normal").fit(train)
        spread = model.transform(train).agg(F.stddev_samp(F.col("label") - F.col("prediction")).alias("s")).first()["s"]
    finally:
        series.unpersist()
    future = (spark.range(1, periods + 1, 1, 1)
              .select(F.date_add(F.lit(span["b"]), F.col("id").cast("int")).alias("ds")))
    scored = model.transform(assemble.transform(future.select("ds", *season_terms(F.col("ds"), span["a"], float(length)))))
    half = Z_80 * (spread or 0.0)
    return scored.select("ds", F.expm1("prediction").alias("yhat"), F.expm1(F.col("prediction") - half).alias("yhat_lower"),
                         F.expm1(F.col("prediction") + half).alias("yhat_upper"))


RIDGE = 1e-6
_FORECAST = "ds date, yhat double, yhat_lower double, yhat_upper double"


def season_matrix(days: np.ndarray, start: int, length: float) -> np.ndarray:
    """The columns of ``season_terms`` for day numbers since 1970, with a leading one."""
    columns = [np.ones(len(days)), (days - start) / length]
    for period, order in ((365.25, YEARLY_TERMS), (7.0, WEEKLY_TERMS)):
        for k in range(1, order + 1):
            angle = days * (2 * math.pi * k / period)
            columns += [np.sin(angle), np.cos(angle)]
    return np.stack(columns, axis=1)


def fit_series(days: np.ndarray, y: np.ndarray, periods: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Days ahead, their forecast of log(1 + y), and the deviation of what the fit leaves.

    Normal equations of the scaled terms with a small ridge, so that a short series in which
    terms can't be told apart still has one solution.
    """
    start, end = int(days.min()), int(days.max())
    length = float(max(end - start, 1))
    x, label = season_matrix(days, start, length), np.log1p(y)
    mean, scale = x[:, 1:].mean(axis=0), x[:, 1:].std(axis=0)
    scale[scale == 0] = 1.0
    z = (x[:, 1:] - mean) / scale
    weights = np.linalg.solve(z.T @ z + RIDGE * len(z) * np.eye(z.shape[1]), z.T @ (label - label.mean()))
    left = label - label.mean() - z @ weights
    ahead = np.arange(end + 1, end + 1 + periods)
    return ahead, label.mean() + (season_matrix(ahead, start, length)[:, 1:] - mean) / scale @ weights, float(left.std(ddof=1))


def forecast_by(df: DataFrame, by: Sequence[str], periods: int = FORECAST_DAYS, min_lines: int = 5) -> DataFrame:
    """``forecast`` for the series of every key: (``by``, ds, yhat, yhat_lower, yhat_upper).

    Lines are first averaged per key and date; a key's series has one row per calendar date
    at most, however many lines it has, and is solved on its own. A key with fewer than two
    dates has no forecast; a null key is a key.
    """
    series = daily_series(df, min_lines, by).select(*by, F.datediff("ds", F.lit("1970-01-01").cast("date")).alias("day"), "y")

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        if len(frame) < 2:
            return pd.DataFrame(columns=[*by, "ds", "yhat", "yhat_lower", "yhat_upper"], dtype=object)
        frame = frame.sort_values("day")
        ahead, center, spread = fit_series(frame["day"].to_numpy(np.float64), frame["y"].to_numpy(np.float64), periods)
        half = Z_80 * spread
        out = pd.DataFrame({"ds": pd.to_datetime(ahead, unit="D").date, "yhat": np.expm1(center),
                            "yhat_lower": np.expm1(center - half), "yhat_upper": np.expm1(center + half)})
        for i, c in enumerate(by):
            out.insert(i, c, [frame[c].iloc[0]] * len(out))
        return out
    keys = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in by)
    return series.groupBy(*by).applyInPandas(solve, f"{keys}, {_FORECAST}")
