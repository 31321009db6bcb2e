"""Small fits: the models learn, repeat, and fail one by one."""

import datetime
import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

import __spark_entry__ as entry
from haulmetrics.operators import delivery, preprocess as prep, risk, stages, training
from haulmetrics.plans import model_queries, run_all
from haulmetrics.plans.model_queries import delivery_lines, risk_lines
from haulmetrics.plans.run_queries import RUN_COLUMNS
from haulmetrics.sources.star import order_lines

SCALED = {"featuresCol": "scaled", "labelCol": "days_real"}


@pytest.fixture(scope="module")
def lines(spark, small):
    # Make delivery days learnable: scheduled days plus a weekday effect.
    df = delivery_lines(spark, small)
    return df.withColumn("days_real", F.col("days_scheduled") + F.when(F.col("order_dayofweek") >= 5, 2).otherwise(0)).persist()


@pytest.fixture(scope="module")
def trained(lines):
    return delivery.train_delivery_models(lines, estimators={
        "linear_regression": LinearRegression(**SCALED),
        "random_forest": RandomForestRegressor(**SCALED, numTrees=10, maxDepth=5, seed=1, featureSubsetStrategy="all"),
        "gradient_boosting": GBTRegressor(**SCALED, maxIter=5, maxDepth=3, seed=1),
        "broken": LinearRegression(featuresCol="no_such_column", labelCol="days_real")})


def test_delivery_lines_are_joined_once(spark, small):
    """Fills, scalers, fits and scores read a stored table and never join the source tables again."""
    stored = delivery_lines(spark, small)
    assert stored.inputFiles() and not any(t in f for f in stored.inputFiles() for t in ("lineitem", "orders", "part.parquet"))
    joined = prep.date_parts(order_lines(spark, small, [
        "line_key", "order_item_quantity", "product_price", "sales", "order_ts", "shipping_ts", "days_scheduled", "days_real"]))
    joined = joined.select(stored.columns)
    assert stored.exceptAll(joined).isEmpty() and stored.count() == joined.count()


def test_risk_lines_are_joined_once_and_scored_only_if_asked(spark, small, monkeypatch):
    """Importances and scores of a named model need no metrics: the test rows are not scored for them."""
    stored = risk_lines(spark, small)
    assert stored.inputFiles() and not any(t in f for f in stored.inputFiles() for t in ("lineitem", "orders", "customer"))
    joined = prep.date_parts(order_lines(spark, small, RUN_COLUMNS)).select(stored.columns)
    assert stored.exceptAll(joined).isEmpty() and stored.count() == joined.count()
    common = {"featuresCol": "scaled", "labelCol": risk.LABEL}
    some = {"logistic": LogisticRegression(**common, maxIter=20)}
    scored = risk.train_risk_models(stored, estimators=some)
    monkeypatch.setattr(risk, "score_together", None)
    plain = risk.train_risk_models(stored, estimators=some, score=False)
    assert plain.metrics == {} and plain.best is None
    assert np.allclose(plain.models["logistic"].stages[-1].coefficients, scored.models["logistic"].stages[-1].coefficients)
    assert risk.predict_risk(stored, plain, "logistic").count() == stored.count()


def test_delivery_models_beat_the_mean(lines, trained):
    assert set(trained.models) == {"linear_regression", "random_forest", "gradient_boosting"} and "broken" in trained.errors
    for m in trained.metrics.values():
        assert 0 < m["r2"] <= 1 and m["mae"] <= m["rmse"]


def test_comparison_and_importance(spark, trained):
    table = delivery.model_comparison(delivery.model_metrics(spark, trained))
    best = min(trained.metrics, key=lambda m: trained.metrics[m]["mae"])
    assert [r["model"] for r in table.where("is_best = 1").collect()] == [best]
    top = delivery.feature_importance(spark, trained.models, trained.fill.features).where("rank = 1").collect()
    assert {r["feature"] for r in top} == {"days_scheduled"}


def test_scoring_keeps_every_row(lines, trained):
    odd = lines.withColumn("sales", F.lit(None).cast("double"))
    out = delivery.predict_days(odd, trained)
    assert out.count() == lines.count() and out.where("predicted_days IS NULL").isEmpty()
    with pytest.raises(ValueError):
        delivery.predict_days(lines, trained, "nobody")


def test_cross_validation(lines):
    r = delivery.cross_validate(lines, folds=3, estimators={"linear_regression": LinearRegression(**SCALED)}).first()
    assert r["model"] == "linear_regression" and 0 < r["cv_mae"] < 2


def test_risk_models(spark, small):
    df = risk_lines(spark, small)
    common = {"featuresCol": "scaled", "labelCol": risk.LABEL}
    trained = risk.train_risk_models(df, estimators={
        "logistic": LogisticRegression(**common, maxIter=50),
        "rf": RandomForestClassifier(**common, numTrees=10, maxDepth=5, seed=1)})
    for m in trained.metrics.values():
        assert m["roc_auc"] > 0.6 and m["tn"] + m["fp"] + m["fn"] + m["tp"] > 0
    assert trained.metrics[trained.best]["f1"] == max(m["f1"] for m in trained.metrics.values())
    unseen = df.withColumn("market", F.lit("MOON"))
    scored = risk.risk_segments(risk.predict_risk(unseen, trained))
    assert scored.count() == df.count()
    assert scored.where("risk_probability < 0 OR risk_probability > 1").isEmpty()
    assert risk.top_critical(scored).count() <= 5
    with pytest.raises(ValueError):
        risk.predict_risk(df, trained, "nobody")
    with pytest.raises(ValueError):
        risk.predict_risk(df, risk.RiskModels(trained.encoder))


def test_run_isolates_failures(spark, small):
    shared = run_all.prepare_shared(order_lines(spark, small, RUN_COLUMNS))

    def broken(df):
        raise RuntimeError("no luck")

    def silent(df):
        raise RuntimeError
    run = run_all.run_selected(shared, ["cost_optimization", "broken", "silent", "unknown"],
                               {"cost_optimization": run_all.cost_findings, "broken": broken, "silent": silent})
    status = {r["analysis"]: (r["status"], r["error"]) for r in run.status.collect()}
    assert status["cost_optimization"] == ("success", None) and status["broken"] == ("failed", "no luck")
    assert status["silent"] == ("failed", "RuntimeError()")
    assert status["unknown"][0] == "failed"
    assert run.findings.where("analysis = 'cost_optimization'").count() == 2


def test_scoring_takes_the_best_model_by_default(lines, trained):
    named = delivery.predict_days(lines, trained, trained.best).orderBy("line_key").collect()
    assert delivery.predict_days(lines, trained).orderBy("line_key").collect() == named
    assert trained.best == min(trained.metrics, key=lambda m: trained.metrics[m]["mae"])


def test_folds_share_one_table_and_no_model_is_fitted_twice(lines):
    """Three folds and the whole make four fits; a model that fails has no score and stops none."""
    fits = []

    class Counted(LinearRegression):
        def _fit(self, dataset):
            fits.append(dataset.count())
            return super()._fit(dataset)
    trained = delivery.train_delivery_models(lines, folds=3, estimators={
        "linear_regression": Counted(**SCALED), "broken": LinearRegression(featuresCol="no_such_column", labelCol="days_real")})
    assert len(fits) == 4 and sorted(fits)[3] * 2 == sum(sorted(fits)[:3])
    assert 0 < trained.cv_mae["linear_regression"] < 2 and trained.cv_mae["broken"] is None
    alone = delivery.cross_validate(lines, folds=3, estimators={"linear_regression": LinearRegression(**SCALED)}).first()
    assert alone["cv_mae"] == pytest.approx(trained.cv_mae["linear_regression"])


def test_classifiers_see_a_bounded_share_of_each_class(spark):
    df = spark.range(40_000).selectExpr("id AS line_key", "CAST(id % 4 = 0 AS INT) AS late_delivery_risk")
    some = risk.bounded_rows(df, 8_000)
    counts = {r[0]: r[1] for r in some.groupBy("late_delivery_risk").count().collect()}
    assert 7_600 < sum(counts.values()) < 8_400 and counts[1] / sum(counts.values()) == pytest.approx(0.25, abs=0.02)
    assert risk.bounded_rows(df, 40_000).count() == risk.bounded_rows(df, None).count() == 40_000
    assert some.exceptAll(risk.bounded_rows(df.repartition(7), 8_000)).isEmpty()


def test_classifiers_are_fitted_on_every_train_row(spark):
    """Each classifier sees all train rows of a table of more than 20,000, and the ridge term is the one for that many."""
    df = spark.range(30_000).selectExpr("id AS line_key", "CAST(id % 4 = 0 AS INT) AS late_delivery_risk", "CAST(id % 7 AS DOUBLE) AS days_scheduled",
                                        "CAST(id % 3 AS STRING) AS market")
    seen = []

    class Counted(LogisticRegression):
        def _fit(self, dataset):
            seen.append(dataset.count())
            return super()._fit(dataset)
    some = {n: Counted(featuresCol="scaled", labelCol=risk.LABEL, maxIter=2) for n in ("a", "b")}
    n_train = risk.stratified_split(df)[0].count()
    trained = risk.train_risk_models(df, estimators=some)
    assert n_train > 20_000 and seen == [n_train, n_train] and set(trained.models) == {"a", "b"}
    ridge = risk.train_risk_models(df, ["logistic"], score=False).models["logistic"].stages[-1].getRegParam()
    assert ridge == pytest.approx(1 / n_train)


def test_encoders_join_long_dictionaries(spark, small):
    df = risk_lines(spark, small)
    short, long = (risk.fit_encoder(df, literal_levels=n) for n in (64, 1))
    assert long.labels.tables and not short.labels.tables and set(short.features) == set(long.features)
    columns = ["line_key", *sorted(short.features)]
    assert short.apply(df, ["line_key"]).select(columns).exceptAll(long.apply(df, ["line_key"]).select(columns)).isEmpty()


def test_saved_pipelines_score_alike(spark, small, lines, trained, tmp_path):
    """Written, read again and applied to lines as they come."""
    stages.delivery_pipeline(trained, "random_forest").write().save(str(tmp_path / "delivery"))
    loaded = PipelineModel.load(str(tmp_path / "delivery"))
    old = delivery.predict_days(lines, trained, "random_forest").withColumnRenamed("predicted_days", "p")
    new = loaded.transform(lines).select("line_key", F.col("prediction").alias("p"))
    assert old.exceptAll(new).isEmpty() and new.count() == lines.count()
    df = risk_lines(spark, small)
    fitted = risk.train_risk_models(df, estimators={"logistic": LogisticRegression(featuresCol="scaled", labelCol=risk.LABEL, maxIter=5)})
    fitted.encoder = risk.fit_encoder(df, literal_levels=1)
    order = fitted.encoder.features
    fitted.models["logistic"] = PipelineModel([VectorAssembler(inputCols=order, outputCol="features"), *fitted.models["logistic"].stages[1:]])
    stages.risk_pipeline(fitted).write().save(str(tmp_path / "risk"))
    again = PipelineModel.load(str(tmp_path / "risk")).transform(df).select("line_key", F.col("prediction").cast("int").alias("predicted_late"))
    assert risk.predict_risk(df, fitted).select("line_key", "predicted_late").exceptAll(again).isEmpty()
    result = prep.preprocess(order_lines(spark, small))
    stages.preprocessing_stage(result).write().save(str(tmp_path / "prep"))
    same = stages.PreprocessingStage.load(str(tmp_path / "prep")).transform(order_lines(spark, small))
    assert same.columns == result.data.columns and same.exceptAll(result.data).isEmpty()
    with pytest.raises(ValueError):
        stages.delivery_pipeline(trained, "nobody")


def test_forecasts_per_key_equal_least_squares(spark):
    rng = np.random.default_rng(5)
    start = datetime.date(2021, 3, 1)
    rows = []
    for key, days in (("a", 500), ("b", 40), (None, 300)):
        for d in range(days):
            level = 4 + math.sin(2 * math.pi * d / 7) + 0.002 * d + rng.normal(0, 0.1)
            rows += [(key, datetime.datetime.combine(start + datetime.timedelta(d), datetime.time(9)), level)] * 5
    rows += [("short", datetime.datetime(2021, 3, 1), 4.0)] * 5
    df = spark.createDataFrame(rows, "region string, order_ts timestamp_ntz, days_real double")
    got = {}
    for r in delivery.forecast_by(df, ["region"], periods=14).collect():
        got.setdefault(r["region"], []).append(r)
    assert set(got) == {"a", "b", None} and all(len(v) == 14 for v in got.values())
    for key, days in (("a", 500), ("b", 40), (None, 300)):
        y = np.log1p(np.array([v for k, _, v in rows if k == key][::5]))
        day = (start - datetime.date(1970, 1, 1)).days + np.arange(days + 14)
        x = delivery.season_matrix(day.astype(float), day[0], days - 1)[:, 1:]
        scale = x[:days].std(axis=0)
        z = (x - x[:days].mean(axis=0)) / scale
        # The ridge as further rows of a plain least-squares problem.
        rows_of = np.vstack([z[:days], math.sqrt(delivery.RIDGE * days) * np.eye(z.shape[1])])
        weights = np.linalg.lstsq(rows_of, np.concatenate([y - y.mean(), np.zeros(z.shape[1])]), rcond=None)[0]
        mine = [r["yhat"] for r in sorted(got[key], key=lambda r: r["ds"])]
        assert mine == pytest.approx(np.expm1(y.mean() + z[days:] @ weights), rel=1e-4)
        assert all(r["yhat_lower"] < r["yhat"] < r["yhat_upper"] for r in got[key])
    assert min(r["ds"] for r in got["a"]) == start + datetime.timedelta(500)
    one = {r["ds"] for r in delivery.forecast(df.where("region = 'a'"), periods=14).collect()}
    assert one == {r["ds"] for r in got["a"]}


MODEL_QUERIES = ("d9_d10_delivery_models", "d11_cv_mae", "d12_feature_importance", "d13_score", "d14_model_comparison",
                 "r5_risk_models", "r9_risk_factors", "r10_predict", "o1_run_all", "d16_forecast_by_region")


@pytest.mark.parametrize("name", MODEL_QUERIES)
def test_model_queries_end_with_their_models(spark, name):
    """As registered, on the smallest tables; forests grow to full depth."""
    out = entry.queries()[name](spark, "/root/testdata/sf0.001").collect()
    if name in ("d9_d10_delivery_models", "d11_cv_mae", "d14_model_comparison", "r5_risk_models"):
        assert len(out) == 3
    if name in ("d13_score", "r10_predict"):
        assert len(out) == order_lines(spark, "/root/testdata/sf0.001", ["line_key"]).count()
    if name == "d9_d10_delivery_models":
        assert all(r["error"] is None for r in out)
    if name == "o1_run_all":
        assert {r["status"] for r in out} == {"success"}


@pytest.mark.parametrize("name, trainer, kind", [("d12_feature_importance", "train_delivery", delivery.DeliveryModels),
                                                 ("r9_risk_factors", "train_risk", risk.RiskModels)])
def test_importances_of_a_failed_fit_are_an_error(spark, small, monkeypatch, name, trainer, kind):
    """No empty table: that would look like a model without features."""
    model = {"d12_feature_importance": "random_forest", "r9_risk_factors": "rf"}[name]
    failed = kind(delivery.FeatureFill([], {}) if kind is delivery.DeliveryModels else risk.RiskEncoder([], None), errors={model: "out of luck"})
    monkeypatch.setattr(model_queries, trainer, lambda *args, **kwargs: failed)
    with pytest.raises(RuntimeError, match="out of luck"):
        entry.queries()[name](spark, small)


def test_forests_are_registered_at_full_depth():
    assert delivery.regressors()["random_forest"].getMaxDepth() == 30 and delivery.regressors()["random_forest"].getNumTrees() == 100
    assert risk.classifiers(10)["rf"].getMaxDepth() == 30 and risk.classifiers(10)["rf"].getNumTrees() == 100


def test_many_fits_do_not_put_a_large_table_into_one_task(spark, monkeypatch):
    monkeypatch.setattr(training, "MAX_ROWS_PER_PARTITION", 10_000)
    small, large = (training.training_rows(spark.range(n).toDF("a"), 15) for n in (4_000, 45_000))
    try:
        assert small.rdd.getNumPartitions() == 1 and large.rdd.getNumPartitions() == 5 and large.count() == 45_000
    finally:
        small.unpersist()
        large.unpersist()
