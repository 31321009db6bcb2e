"""Fitted steps as pipeline stages that can be saved and loaded.

``preprocessing_stage``, ``fill_stage`` and ``encoder_stage`` wrap what the operators learned,
``delivery_pipeline`` and ``risk_pipeline`` put them before a trained model: one
``PipelineModel`` that scores order lines as they come, in this session or another.
"""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from haulmetrics.functions.labels import LabelDictionary
from haulmetrics.operators import preprocess
from haulmetrics.operators.delivery import TARGET, DeliveryModels, FeatureFill, fill_features
from haulmetrics.operators.fitted import FittedStage
from haulmetrics.operators.risk import RiskEncoder, RiskModels


class PreprocessingStage(FittedStage):
    """The preprocessing steps with what they learned; a step that learned nothing is just applied."""

    def _transform(self, df: DataFrame) -> DataFrame:
        given = self.learned
        codes = given["profile"].pop("codes")
        profile = preprocess.Profile(**given["profile"])
        profile.codes = LabelDictionary(codes, self.tables) if codes is not None else None
        return preprocess.transform(df, profile, given["steps"])


class FillStage(FittedStage):
    """Delivery features as doubles with their medians in place of gaps, beside all other columns."""

    def _transform(self, df: DataFrame) -> DataFrame:
        fill = FeatureFill(**self.learned)
        others = [c for c in df.columns if c not in fill.medians]
        return fill_features(df.drop(TARGET), fill, keep=[c for c in others if c != TARGET])


class EncoderStage(FittedStage):
    """Risk features as doubles, categories by their codes, beside all other columns."""

    def _transform(self, df: DataFrame) -> DataFrame:
        given = self.learned
        encoder = RiskEncoder(given["numeric"], LabelDictionary(given["levels"], self.tables))
        return encoder.apply(df, keep=[c for c in df.columns if c not in encoder.numeric])


def preprocessing_stage(result: preprocess.Preprocessed) -> PreprocessingStage:
    profile = result.profile
    learned = {f: getattr(profile, f) for f in ("sparse", "medians", "modes", "high_value", "levels")}
    learned["codes"] = profile.codes.levels if profile.codes is not None else None
    stage = PreprocessingStage(state=json.dumps({"profile": learned, "steps": result.applied}))
    stage.tables = profile.codes.tables if profile.codes is not None else {}
    return stage


def fill_stage(fill: FeatureFill) -> FillStage:
    return FillStage(state=json.dumps(asdict(fill)))


def encoder_stage(encoder: RiskEncoder) -> EncoderStage:
    stage = EncoderStage(state=json.dumps({"numeric": encoder.numeric, "levels": encoder.labels.levels}))
    stage.tables = encoder.labels.tables
    return stage


def delivery_pipeline(trained: DeliveryModels, model: str | None = None) -> PipelineModel:
    """The named or the best delivery model with its filling: order lines with date parts in, ``prediction`` out."""
    name = model or trained.best
    if name not in trained.models:
        raise ValueError(f"model {name} is not trained")
    return PipelineModel([fill_stage(trained.fill), *trained.models[name].stages])


def risk_pipeline(trained: RiskModels, model: str | None = None) -> PipelineModel:
    """The named or the best risk model with its encoder: order lines with date parts in, ``prediction`` and ``probability`` out."""
    name = model or trained.best
    if name not in trained.models:
        raise ValueError(f"model {name} is not trained")
    return PipelineModel([encoder_stage(trained.encoder), *trained.models[name].stages])
