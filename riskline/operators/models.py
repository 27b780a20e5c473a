"""Estimators, search spaces, cross-validated tuning and scoring.

Models are MLlib estimators (distributed fits) plus the exact k-NN join for
the neighbour classifier. Tuning is a fold loop on the driver that submits
Spark jobs: the fold column comes from ``stratified_folds``; resampling
(SMOTE) and class weights are applied to each training fold only, and every
fold is scored with the exact ROC AUC. Only fold metrics, coefficients and
parameters reach the driver.
"""

from __future__ import annotations

import itertools
import json
import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskline.operators import metrics as M
from riskline.operators import neighbors as N
from riskline.operators import sampling as SP
from riskline.operators.scaling import ScalerModel, fit_robust_scaler, fit_standard_scaler

UNLIMITED_DEPTH = 30  # deepest tree MLlib accepts; stands in for "no limit"
#: Rows from which on a forest's rows are dealt evenly to the cores, and most rows of a partition then.
DEAL_FROM, DEAL_ROWS = 100_000, 200_000
FEATURES = "features"

# ---------------------------------------------------------------------------
# The reference's search spaces (K7).
# ---------------------------------------------------------------------------
SEARCH_SPACES = {
    "logistic_regression": {"search_type": "grid", "params": {"C": [0.1, 1, 10], "penalty": ["l1", "l2"]}},
    "knn": {"search_type": "grid", "params": {"n_neighbors": [3, 5, 7], "weights": ["uniform", "distance"], "p": [2]}},
    "decision_tree": {
        "search_type": "grid",
        "params": {"max_depth": [None, 10], "min_samples_split": [2, 5], "min_samples_leaf": [1], "criterion": ["gini", "entropy"]},
    },
    "random_forest": {
        "search_type": "random",
        "n_iter": 4,
        "params": {
            "n_estimators": [200, 300],
            "max_depth": [None, 10],
            "min_samples_split": [2, 5],
            "min_samples_leaf": [1, 2],
            "max_features": ["sqrt"],
        },
    },
    "svm": {"search_type": "random", "n_iter": 4, "params": {"C": [0.5, 1, 5], "gamma": ["scale", "auto"], "kernel": ["rbf", "linear"]}},
}
# Estimators without sample weights (class_weight combinations are skipped, I5).
NO_WEIGHTS = {"knn"}


# ---------------------------------------------------------------------------
# preprocessing
# ---------------------------------------------------------------------------


@dataclass
class Preprocessor:
    """Optional train-fitted scaling followed by vector assembly."""

    features: list[str]
    scaler: str | None = None  # None | "standard" | "robust"
    model: ScalerModel | None = None

    def fit(self, train: DataFrame) -> "Preprocessor":
        if self.scaler == "standard":
            self.model = fit_standard_scaler(train, self.features)
        elif self.scaler == "robust":
            self.model = fit_robust_scaler(train, self.features)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.model.transform(df) if self.model else df
        return VectorAssembler(inputCols=self.features, outputCol=FEATURES).transform(out)


def make_preprocessor(features: Sequence[str], scaler: str | None = None) -> Preprocessor:
    return Preprocessor(list(features), scaler)


# ---------------------------------------------------------------------------
# Estimators from reference-style parameters
# ---------------------------------------------------------------------------


def expand_grid(params: Mapping[str, Sequence]) -> list[dict]:
    """All combinations in grid order (first key varies slowest)."""
    keys = sorted(params)
    return [dict(zip(keys, vals)) for vals in itertools.product(*[params[k] for k in keys])]


def sample_grid(params: Mapping[str, Sequence], n_iter: int, seed: int = 42) -> list[dict]:
    """K9: ``n_iter`` distinct combinations drawn without replacement (seeded)."""
    grid = expand_grid(params)
    if n_iter >= len(grid):
        return grid
    rng = random.Random(seed)
    return [grid[i] for i in sorted(rng.sample(range(len(grid)), n_iter))]


def candidates(model_name: str, spaces: Mapping = SEARCH_SPACES, seed: int = 42) -> list[dict]:
    space = spaces[model_name]
    if space.get("search_type") == "random":
        return sample_grid(space["params"], space.get("n_iter", 10), seed)
    return expand_grid(space["params"])


def build_estimator(model_name: str, params: Mapping, total_weight: float, weight_col: str | None, label: str, seed: int = 42):
    """MLlib estimator for reference-style parameters.

    ``C`` maps to ``regParam = 1 / (C * total_weight)`` (the penalised
    objectives agree up to a constant factor); depth None maps to the MLlib
    maximum. MLlib has no minimum split size: ``min_samples_split`` is honoured by ``tree_batch`` only, which all searches use."""
    common = {"featuresCol": FEATURES, "labelCol": label}
    if weight_col:
        common["weightCol"] = weight_col
    depth = lambda d: UNLIMITED_DEPTH if d is None else int(d)
    if model_name == "logistic_regression":
        return LogisticRegression(
            regParam=1.0 / (float(params.get("C", 1.0)) * total_weight),
            elasticNetParam=1.0 if params.get("penalty", "l2") == "l1" else 0.0,
            standardization=False,
            maxIter=int(params.get("max_iter", 1000)),
            tol=float(params.get("tol", 1e-4)),  # liblinear's default tolerance
            **common,
        )
    if model_name == "decision_tree":
        return DecisionTreeClassifier(
            maxDepth=depth(params.get("max_depth")),
            minInstancesPerNode=int(params.get("min_samples_leaf", 1)),
            impurity=params.get("criterion", "gini"),
            seed=seed,
            **common,
        )
    if model_name == "random_forest":
        return RandomForestClassifier(
            numTrees=int(params.get("n_estimators", 300)),
            maxDepth=depth(params.get("max_depth")),
            minInstancesPerNode=int(params.get("min_samples_leaf", 1)),
            featureSubsetStrategy=params.get("max_features", "sqrt"),
            seed=seed,
            cacheNodeIds=True,  # a level does not walk every tree from its root again
            **common,
        )
    if model_name == "svm":
        return LinearSVC(
            regParam=1.0 / (float(params.get("C", 1.0)) * total_weight),
            standardization=False,
            maxIter=int(params.get("max_iter", 100)),
            tol=float(params.get("tol", 1e-3)),  # SVC's default tolerance
            **common,
        )
    raise ValueError(f"no MLlib estimator for {model_name!r}")


def dealt(df: DataFrame, rows: int) -> DataFrame:
    """Many rows in equal partitions, one for each core at least: every level of a forest waits for its largest partition.
    No more than needed, as each partition sends the statistics of all open nodes."""
    if rows < DEAL_FROM:
        return df
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / DEAL_ROWS)))


# ---------------------------------------------------------------------------
# RBF kernel re-aimed as random Fourier features
# ---------------------------------------------------------------------------


def rbf_gamma(df: DataFrame, features: Sequence[str], gamma) -> float:
    """``scale`` -> 1 / (p var(X)) over all feature values; ``auto`` -> 1 / p."""
    p = len(features)
    if gamma == "auto":
        return 1.0 / p
    if gamma == "scale":
        long = df.select(F.explode(F.array(*[F.col(c).cast("double") for c in features])).alias("v"))
        var = long.agg(F.var_pop("v")).first()[0] or 0.0
        return 1.0 / (p * var) if var > 0 else 1.0
    return float(gamma)


def fourier_vectors(df: DataFrame, features: Sequence[str], gamma: float, n_components: int = 100, seed: int = 42, out: str = FEATURES) -> DataFrame:
    """``df`` with one vector column of ``sqrt(2/D) cos(w.x + b)`` with w ~ N(0, 2 gamma I), b ~ U[0, 2 pi)
    (Rahimi & Recht, 2007): a linear model on these approximates an RBF kernel. The D x p projection travels with the
    task, which projects a batch of rows at a time. Features that are null or not finite are an error."""
    p = len(features)
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, np.sqrt(2.0 * gamma), size=(n_components, p))
    b = rng.uniform(0.0, 2 * np.pi, size=n_components)
    scale = float(np.sqrt(2.0 / n_components))

    @F.arrow_udf("array<double>")
    def project(column: pa.Array) -> pa.Array:
        x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), p)
        if not np.isfinite(x).all():
            raise ValueError("Fourier features of a value that is not finite")
        dot = np.repeat(b[None, :], len(x), axis=0)
        for i in range(p):
            dot += x[:, i, None] * w[:, i]
        values = (scale * np.cos(dot)).ravel()
        return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * n_components), pa.array(values))

    raw = "_raw_features"
    df = VectorAssembler(inputCols=list(features), outputCol=raw).transform(df)
    return df.withColumn(out, array_to_vector(project(vector_to_array(raw)))).drop(raw)


def random_fourier_features(df: DataFrame, features: Sequence[str], gamma: float, n_components: int = 100, seed: int = 42, prefix: str = "rff_") -> tuple[DataFrame, list[str]]:
    """``fourier_vectors`` as one column per component, and the columns' names."""
    cols = [f"{prefix}{j}" for j in range(n_components)]
    out = fourier_vectors(df, features, gamma, n_components, seed, "_fourier").withColumn("_fourier", vector_to_array("_fourier"))
    return out.select(*df.columns, *[F.col("_fourier")[j].alias(c) for j, c in enumerate(cols)]), cols


# ---------------------------------------------------------------------------
# scoring
# ---------------------------------------------------------------------------


def positive_score(model, scored: DataFrame) -> DataFrame:
    """``score`` = P(y=1) when the model has probabilities, else the
    positive margin min-max rescaled to [0, 1] (one min/max aggregate)."""
    if "probability" in scored.columns:
        return scored.withColumn("score", vector_to_array("probability")[1])
    margin = vector_to_array("rawPrediction")[1]
    s = scored.withColumn("_m", margin)
    lo, hi = s.agg(F.min("_m"), F.max("_m")).first()
    return s.withColumn("score", (F.col("_m") - F.lit(lo)) / (F.lit(hi) - F.lit(lo) + 1e-9)).drop("_m")


# ---------------------------------------------------------------------------
# Fitting one configuration (with per-fold imbalance handling)
# ---------------------------------------------------------------------------


@dataclass
class FittedModel:
    model_name: str
    params: dict
    features: list[str]
    label: str
    id_col: str
    model: object = None  # MLlib model, or the training frame for k-NN
    extra: dict = field(default_factory=dict)

    def predict(self, df: DataFrame) -> DataFrame:
        """``id, label, prediction, score`` for every row of an assembled frame."""
        if self.model_name == "knn":
            p = N.knn_predict(
                self.model, df, self.id_col, self.features, self.label,
                k=int(self.params.get("n_neighbors", 5)), weights=self.params.get("weights", "uniform"),
            )
            return df.select(self.id_col, self.label).join(p, self.id_col).select(
                self.id_col, self.label, F.col("prediction").cast("double").alias("prediction"), F.col("probability").alias("score")
            )
        inp = df.drop(FEATURES) if FEATURES in df.columns else df
        if self.extra.get("rff"):
            from riskline.session import ensure_checkpoint_dir

            ensure_checkpoint_dir(df.sparkSession)
            out = self.model.transform(fourier_vectors(inp, self.features, **self.extra["rff"]))
            # rescaling and metrics read the margins several times: each row is projected once
            out = out.select(self.id_col, self.label, "prediction", "rawPrediction").checkpoint(eager=True)
        else:
            out = self.model.transform(VectorAssembler(inputCols=self.features, outputCol=FEATURES).transform(inp))
        out = positive_score(self.model, out)
        return out.select(self.id_col, self.label, "prediction", "score")


def prepare_training(train: DataFrame, label: str, id_col: str, features: Sequence[str], imbalance: str, seed: int = 42):
    """Apply the imbalance method to a training frame: returns (frame, weight column or None)."""
    df = train
    if imbalance in ("smote", "smote+class_weight"):
        df = N.smote(train.select(id_col, *features, label), id_col, features, label, k=5, seed=seed).drop("is_synthetic")
    weight_col = None
    if imbalance in ("class_weight", "smote+class_weight"):
        df = SP.with_class_weights(df, label, "weight")
        weight_col = "weight"
    return df, weight_col


def fit_model(
    model_name: str,
    params: Mapping,
    train: DataFrame,
    features: Sequence[str],
    label: str,
    id_col: str,
    imbalance: str = "none",
    seed: int = 42,
) -> FittedModel:
    """Fit one configuration on (raw, unassembled) training rows."""
    df, weight_col = prepare_training(train, label, id_col, features, imbalance, seed)
    if imbalance.startswith("smote"):
        # The synthetic rows come from a k-NN join: materialise them once
        # (reliable checkpoint) instead of recomputing per optimiser pass.
        from riskline.session import ensure_checkpoint_dir

        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    fm = FittedModel(model_name, dict(params), list(features), label, id_col)
    if model_name == "knn":
        fm.model = df.select(id_col, *features, label)
        return fm
    total = df.agg(F.sum(F.col(weight_col)) if weight_col else F.count(F.lit(1))).first()[0]
    inp = df
    if model_name == "svm" and params.get("kernel", "linear") == "rbf":
        gamma = rbf_gamma(df, features, params.get("gamma", "scale"))
        fm.extra["rff"] = {"gamma": gamma, "seed": seed}
        inp = fourier_vectors(df, features, gamma, seed=seed)
    else:
        inp = VectorAssembler(inputCols=list(features), outputCol=FEATURES).transform(inp)
    est = build_estimator(model_name, params, float(total), weight_col, label, seed)
    if model_name == "random_forest":
        inp = dealt(inp, df.count() if weight_col else total)
    fm.model = est.fit(inp)
    return fm


# ---------------------------------------------------------------------------
# K8/K9: tuning with stratified folds
# ---------------------------------------------------------------------------


@dataclass
class TuningResult:
    best_params: dict
    best_score: float
    scores: list[tuple[dict, float]]
    model: FittedModel


def tune_model(
    model_name: str,
    train: DataFrame,
    features: Sequence[str],
    label: str,
    id_col: str,
    imbalance: str = "none",
    grid: Sequence[Mapping] | None = None,
    n_splits: int = 5,
    seed: int = 42,
) -> TuningResult:
    """K8/K9: mean fold ROC AUC per combination; best (ties -> first in grid order), fitted on the whole training frame.

    All combinations and folds are fitted together from one prepared table (``model_batch``): at most a few dozen scans
    for a linear model, one neighbour join for k-NN, one growth per fold and tree setting, at every size."""
    from riskline.operators import model_batch as B

    grid = list(grid) if grid is not None else candidates(model_name, seed=seed)
    empty = train.limit(0)
    tables = B.prepare_tables({"train": (train, empty)}, features, label, id_col, imbalance.startswith("smote"), n_splits, seed)
    from riskline.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(train.sparkSession)
    p = B.prepared(*(t.checkpoint(eager=True) for t in tables), features, ["train"], n_splits)
    keys = {}
    for gi, params in enumerate(grid):
        for task in range(n_splits + 1):
            keys[(gi, task)] = B.unit_of(p, model_name, p.group("train", imbalance.startswith("smote"), task), imbalance, params, seed)
    numbers = {u: k for k, u in enumerate(dict.fromkeys(keys.values()))}
    scored, payloads = B.fit_and_score(p, model_name, {k: u for u, k in numbers.items()})
    aucs = {r["unit"]: r["roc_auc"] for r in M.roc_auc(scored, "y", "score", by=["unit"]).collect()}
    nan = float("nan")
    mean = lambda v: sum(nan if x is None else x for x in v) / len(v)
    scores = [(dict(params), mean([aucs.get(numbers[keys[(gi, f)]]) for f in range(n_splits)])) for gi, params in enumerate(grid)]
    # a candidate without a score (a fold of one class) is ranked last
    best_i = max(range(len(scores)), key=lambda i: (scores[i][1] == scores[i][1], scores[i][1], -i))
    unit = numbers[keys[(best_i, n_splits)]]
    parts = [bytes(r["payload"]) for r in payloads.where(F.col("unit") == unit).orderBy("part").collect()]
    donors = None
    if model_name == "knn":
        g = p.group("train", imbalance.startswith("smote"), n_splits)
        rows = p.train.where(F.col("g") == g)
        donors = rows.select(F.col("id").alias(id_col), *[F.col("x")[i].alias(c) for i, c in enumerate(features)], F.col("y").alias(label))
    model = B.BatchModel(model_name, dict(grid[best_i]), list(features), label, id_col, parts, donors)
    return TuningResult(scores[best_i][0], scores[best_i][1], scores, model)


def params_json(params: Mapping) -> str:
    return json.dumps({k: params[k] for k in sorted(params)}, sort_keys=True)


# ---------------------------------------------------------------------------
# Feature selection
# ---------------------------------------------------------------------------


def rfe(df: DataFrame, features: Sequence[str], label: str, n_select: int, C: float = 1.0) -> DataFrame:
    """Recursive feature elimination with L2 logistic regression: drop the
    smallest squared coefficient one at a time. ``feature, selected, ranking``
    (kept features rank 1, the last one dropped 2, ...)."""
    from riskline.operators import linear_batch as L

    remaining = list(features)
    dropped: list[str] = []
    base = df.dropna(subset=[*features, label]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        while len(remaining) > n_select:
            x = F.array(*[F.col(c).cast("double") for c in remaining]).alias("x")
            rows = base.select(F.lit(0).alias("g"), F.col(label).cast("double").alias("y"), x)
            coef = L.fit_linear(rows, [L.Fit(0, C=C)])[0][0]
            worst = min(range(len(remaining)), key=lambda i: (coef[i] ** 2, i))
            dropped.append(remaining.pop(worst))
    finally:
        base.unpersist()
    rank = {f: 1 for f in remaining}
    for i, f in enumerate(reversed(dropped)):
        rank[f] = i + 2
    rows = [(f, rank[f] == 1, rank[f]) for f in features]
    return df.sparkSession.createDataFrame(rows, "feature string, selected boolean, ranking int")


def tree_importance(df: DataFrame, features: Sequence[str], label: str, n_trees: int = 300, seed: int = 42, balanced: bool = True) -> DataFrame:
    """Normalised impurity importances of a (class-balanced) random forest."""
    base = df.dropna(subset=[*features, label])
    counts = SP.class_counts(base, label)
    weight_col = None
    if balanced:
        base = SP.with_class_weights(base, label, "weight", counts)
        weight_col = "weight"
    inp = dealt(VectorAssembler(inputCols=list(features), outputCol=FEATURES).transform(base), sum(counts.values()))
    rf = RandomForestClassifier(
        numTrees=n_trees, featureSubsetStrategy="sqrt", seed=seed, featuresCol=FEATURES, labelCol=label, cacheNodeIds=True,
        **({"weightCol": weight_col} if weight_col else {}),
    )
    imp = rf.fit(inp).featureImportances.toArray()
    rows = sorted(zip(features, [float(x) for x in imp]), key=lambda t: (-t[1], t[0]))
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def feature_selection(df: DataFrame, features: Sequence[str], label: str, n_select: int = 8, n_trees: int = 300):
    """(|r| with the target on complete cases, RFE table, importance table)."""
    from riskline.operators.stats import target_correlation

    corr = target_correlation(df, features, label, complete_cases=True, absolute=True)
    return corr, rfe(df, features, label, min(n_select, len(features))), tree_importance(df, features, label, n_trees)


# ---------------------------------------------------------------------------
# A4: persistence
# ---------------------------------------------------------------------------


def save_model(fm, path: str) -> str:
    """A4: MLlib models through their writer; a k-NN model is its training table; a batch model is its payload's table."""
    from pyspark.sql import SparkSession

    from riskline.operators import model_batch as B

    if isinstance(fm, B.BatchModel):
        return B.save_batch_model(SparkSession.getActiveSession(), fm, path)
    meta = {"model_name": fm.model_name, "params": fm.params, "features": fm.features, "label": fm.label, "id_col": fm.id_col, "extra": fm.extra}
    spark = None
    if fm.model_name == "knn":
        fm.model.write.mode("overwrite").parquet(f"{path}/train")
        spark = fm.model.sparkSession
    else:
        PipelineModel(stages=[fm.model]).write().overwrite().save(f"{path}/model")
        spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").json(f"{path}/meta")
    return path


def load_model(spark, path: str):
    meta = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
    if meta.get("kind") == "batch":
        from riskline.operators import model_batch as B

        return B.load_batch_model(spark, path, meta)
    fm = FittedModel(meta["model_name"], meta["params"], meta["features"], meta["label"], meta["id_col"], extra=meta.get("extra", {}))
    if fm.model_name == "knn":
        fm.model = spark.read.parquet(f"{path}/train")
    else:
        fm.model = PipelineModel.load(f"{path}/model").stages[0]
    return fm


__all__ = [
    "Preprocessor",
    "SEARCH_SPACES",
    "build_estimator",
    "candidates",
    "expand_grid",
    "feature_selection",
    "fit_model",
    "load_model",
    "make_preprocessor",
    "positive_score",
    "rfe",
    "sample_grid",
    "save_model",
    "tree_importance",
    "tune_model",
]
