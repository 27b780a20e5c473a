"""Preprocessing, resampling and a model as one object.

``ModelPipeline.fit`` fits the scaler on the training rows as they are, then (with SMOTE) adds synthetic rows in the scaled
space, then fits the model: resampling belongs to fitting only. The fitted pipeline scales and scores any frame and is saved
and loaded as one artifact: the scaler's statistics and settings as JSON beside the model's own files.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from riskline.operators import models as MD
from riskline.operators.scaling import ScalerModel


def imbalance_method(use_smote: bool, class_weight: bool) -> str:
    return "+".join(n for n, on in (("smote", use_smote), ("class_weight", class_weight)) if on) or "none"


@dataclass
class FittedPipeline:
    """``predict`` gives ``id, label, prediction, score`` of each row of a frame with the raw features: no row is added."""

    scaler: ScalerModel | None
    model: object
    features: list[str]

    def transform(self, df: DataFrame) -> DataFrame:
        """The frame with its features as the model sees them."""
        return self.scaler.transform(df) if self.scaler else df

    def predict(self, df: DataFrame) -> DataFrame:
        return self.model.predict(self.transform(df))

    def save(self, spark: SparkSession, path: str) -> str:
        s = self.scaler
        meta = {"features": self.features, "scaler": None if s is None else {"kind": s.kind, "center": s.center, "scale": s.scale}}
        MD.save_model(self.model, f"{path}/model")
        spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").json(f"{path}/pipeline")
        return path


def load_pipeline(spark: SparkSession, path: str) -> FittedPipeline:
    meta = json.loads(spark.read.json(f"{path}/pipeline").first()["meta"])
    scaler = ScalerModel(**meta["scaler"]) if meta["scaler"] else None
    return FittedPipeline(scaler, MD.load_model(spark, f"{path}/model"), meta["features"])


@dataclass
class ModelPipeline:
    """An unfitted pipeline; ``fit`` may be called on many training frames and leaves the pipeline as it is."""

    preprocessor: MD.Preprocessor
    model_name: str
    params: Mapping
    label: str
    id_col: str
    use_smote: bool = False
    class_weight: bool = False
    seed: int = 42

    def __post_init__(self):
        if self.model_name not in MD.SEARCH_SPACES:
            raise ValueError(f"unknown model {self.model_name!r}")
        if self.class_weight and self.model_name in MD.NO_WEIGHTS:
            raise ValueError(f"{self.model_name} takes no class weights")

    def fit(self, train: DataFrame) -> FittedPipeline:
        features: Sequence[str] = self.preprocessor.features
        scaler = MD.make_preprocessor(features, self.preprocessor.scaler).fit(train).model
        scaled = scaler.transform(train) if scaler else train
        method = imbalance_method(self.use_smote, self.class_weight)
        model = MD.fit_model(self.model_name, self.params, scaled, features, self.label, self.id_col, method, self.seed)
        return FittedPipeline(scaler, model, list(features))


__all__ = ["FittedPipeline", "ModelPipeline", "imbalance_method", "load_pipeline"]
