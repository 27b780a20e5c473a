"""Train-fitted scaling (J1, J2) as SQL projections.

``fit`` runs one statistics job on the training frame; ``transform`` is a
projection applied to any frame (train, test, a stream batch). MLlib's
``StandardScaler`` uses the sample sigma and ``RobustScaler`` approximate
quantiles, so neither reproduces the population-sigma / exact-quartile
definitions here.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskline.operators.quantiles import column_quantiles


@dataclass
class ScalerModel:
    """``(x - center) / scale`` per column; a zero scale divides by 1."""

    kind: str
    center: dict[str, float]
    scale: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        cols = {}
        for c in self.center:
            s = self.scale[c]
            s = 1.0 if (s is None or s == 0) else s
            cols[c] = (F.col(c) - F.lit(self.center[c] or 0.0)) / F.lit(s)
        return df.withColumns(cols)

    def params(self, spark) -> DataFrame:
        rows = [(c, self.center[c], self.scale[c]) for c in self.center]
        return spark.createDataFrame(rows, "feature string, center double, scale double").withColumn(
            "kind", F.lit(self.kind)
        )


def fit_standard_scaler(df: DataFrame, columns: Sequence[str]) -> ScalerModel:
    """Mean and population sigma in one aggregate."""
    r = df.agg(*[x for c in columns for x in (F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))]).first()
    return ScalerModel("standard", {c: r[f"m_{c}"] for c in columns}, {c: r[f"s_{c}"] for c in columns})


def fit_robust_scaler(df: DataFrame, columns: Sequence[str]) -> ScalerModel:
    """Exact median and interquartile range (linear interpolation)."""
    q = column_quantiles(df, columns, [0.25, 0.5, 0.75])
    return ScalerModel(
        "robust",
        {c: q[c][0.5] for c in columns},
        {c: (None if q[c][0.25] is None else q[c][0.75] - q[c][0.25]) for c in columns},
    )


def standard_scale(train: DataFrame, test: DataFrame, columns: Sequence[str]):
    """``(train_scaled, test_scaled, model)`` with statistics from train only."""
    m = fit_standard_scaler(train, columns)
    return m.transform(train), m.transform(test), m


def robust_scale(train: DataFrame, test: DataFrame, columns: Sequence[str]):
    """``(train_scaled, test_scaled, model)`` with statistics from train only."""
    m = fit_robust_scaler(train, columns)
    return m.transform(train), m.transform(test), m
