"""The experiment matrix (K18, K19, A4, A6, F5, I5) and the model-input flow.

Dataset versions x models x imbalance strategies; each run tunes with
stratified 5-fold CV on the training split, refits, scores the test split
and emits one row of the result table:
``dataset_version, model_name, imbalance_method, best_params, cv_best_roc_auc,
test_accuracy, test_precision, test_recall, test_f1, test_roc_auc``.
All runs share one prepared table (``model_batch``), and each model's open runs are fitted together. A ledger in the
shared folder records what is finished: the prepared tables, each model's predictions, and one folder per run with its
result row. A plan that is started again over the same folder goes on where it stopped.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskline.operators import metrics as M
from riskline.operators import model_batch as B
from riskline.operators import models as MD
from riskline.operators import sampling as SP
from riskline.operators.missing import fit_simple_imputer
from riskline.operators.neighbors import knn_impute
from riskline.operators.scaling import fit_robust_scaler, fit_standard_scaler
from riskline.session import ensure_checkpoint_dir
from riskline.sources import fixtures as FX

# The reference's experiment dimensions.
DATASET_VERSIONS = ["unscaled", "standard_scaled", "robust_scaled"]
MODELS = ["logistic_regression", "knn", "decision_tree", "random_forest", "svm"]
IMBALANCE_METHODS = ["none", "class_weight", "smote", "smote+class_weight"]

COHORT_FEATURES = ["acctbal", "n_orders", "avg_total", "max_total"]

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("dataset_version", T.StringType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("imbalance_method", T.StringType()),
        T.StructField("best_params", T.StringType()),
        T.StructField("cv_best_roc_auc", T.DoubleType()),
        T.StructField("test_accuracy", T.DoubleType()),
        T.StructField("test_precision", T.DoubleType()),
        T.StructField("test_recall", T.DoubleType()),
        T.StructField("test_f1", T.DoubleType()),
        T.StructField("test_roc_auc", T.DoubleType()),
    ]
)


_RUN_SCHEMA = T.StructType([*RESULT_SCHEMA.fields, T.StructField("_name", T.StringType()), T.StructField("_unit", T.IntegerType())])


def cohort_model_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-COHORT cleaned for modelling: median fill of the <5%-null column,
    5-NN fill of the >5%-null one (the reference's cleaning order). The result is a reliable checkpoint: splits, scalers and
    fits read it many times, and none repeats the neighbour join. So is the raw cohort: each pass of the imputers reads one
    row per customer, and none repeats the aggregation of the orders."""
    ensure_checkpoint_dir(spark)
    df = FX.cohort(spark, sf_dir).checkpoint(eager=True)
    imp = fit_simple_imputer(df, ["acctbal", "n_orders", "avg_total", "max_total"], [], threshold=0.05)
    df = imp.transform(df)
    df = knn_impute(df, "id", "max_total", ["acctbal", "n_orders", "avg_total"], k=5)
    return df.select("id", *COHORT_FEATURES, "label").checkpoint(eager=True)


def split_versions(
    df: DataFrame, features: Sequence[str], label: str, id_col: str, versions: Sequence[str] = DATASET_VERSIONS, seed: int = 42,
    order_key: Column | None = None,
) -> dict[str, tuple[DataFrame, DataFrame]]:
    """One stratified split, then each version's scaler fitted on its train part."""
    # Reliable checkpoint in the shared folder: cuts the imputation / k-NN lineage
    # once, so the many fits and scores below never recompute it.
    ensure_checkpoint_dir(df.sparkSession)
    s = SP.stratified_split(df, label, [id_col], 0.2, seed, order_key).checkpoint(eager=True)
    train, test = s.where(F.col("split") == "train").drop("split"), s.where(F.col("split") == "test").drop("split")
    out = {}
    for v in versions:
        if v == "unscaled":
            out[v] = (train, test)
        else:
            m = fit_standard_scaler(train, features) if v == "standard_scaled" else fit_robust_scaler(train, features)
            out[v] = (m.transform(train), m.transform(test))
    return out


def dataset_shapes(frames: Mapping[str, tuple[DataFrame, DataFrame]], label: str, features: Sequence[str]) -> DataFrame:
    """``dataset_version, split, n_rows, n_features, positives, positive_rate`` in one union plan."""
    parts = []
    for v, (tr, te) in frames.items():
        for name, f in (("train", tr), ("test", te)):
            parts.append(
                f.agg(
                    F.count(F.lit(1)).cast("bigint").alias("n_rows"),
                    F.sum(label).cast("bigint").alias("positives"),
                    F.avg(F.col(label).cast("double")).alias("positive_rate"),
                ).select(F.lit(v).alias("dataset_version"), F.lit(name).alias("split"), "n_rows", F.lit(len([c for c in features if c in f.columns])).alias("n_features"), "positives", "positive_rate")
            )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_plan(versions=DATASET_VERSIONS, models=MODELS, methods=IMBALANCE_METHODS) -> list[tuple[str, str, str]]:
    """The cross product of the three dimensions, without combinations
    whose estimator takes no sample weights (k-NN x class weights)."""
    plan = []
    for v, m, i in itertools.product(versions, models, methods):
        if m in MD.NO_WEIGHTS and "class_weight" in i:
            continue
        plan.append((v, m, i))
    return plan


def run_one_experiment(
    version: str,
    model_name: str,
    imbalance: str,
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    label: str,
    id_col: str,
    grid: Sequence[Mapping] | None = None,
    n_splits: int = 5,
    seed: int = 42,
):
    """One row of the result table (and the fitted model)."""
    tr = MD.tune_model(model_name, train, features, label, id_col, imbalance, grid=grid, n_splits=n_splits, seed=seed)
    pred = tr.model.predict(test)
    m = M.evaluate_predictions(pred, label, "prediction", "score").first()
    row = (
        version,
        model_name,
        imbalance,
        MD.params_json(tr.best_params),
        float(tr.best_score),
        float(m["accuracy"]),
        float(m["precision"]),
        float(m["recall"]),
        float(m["f1"]),
        None if m["roc_auc"] is None else float(m["roc_auc"]),
    )
    return row, tr.model


class Ledger:
    """What a plan has finished, as folders of Parquet files under one shared path; a folder counts once its writer has
    committed it (``_SUCCESS``), so a job that died half-way leaves nothing that is taken for done. The settings are
    part of the path: another plan over the same folder starts its own ledger."""

    def __init__(self, spark: SparkSession, folder: str, settings: Mapping):
        text = json.dumps(settings, sort_keys=True, default=str)
        self.spark, self.path = spark, f"{folder.rstrip('/')}/{hashlib.sha256(text.encode()).hexdigest()[:16]}"
        self.made: list[str] = []

    def finished(self, name: str) -> bool:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}/_SUCCESS")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def table(self, name: str, make) -> DataFrame:
        """The table, read back; made (and written) only if it is not there yet."""
        if not self.finished(name):
            make().write.mode("overwrite").parquet(f"{self.path}/{name}")
            self.made.append(name)
        return self.spark.read.parquet(f"{self.path}/{name}")

    def put(self, key: str, row: tuple, name: str = "", unit: int = -1) -> None:
        """The run's result row, and where its model and predictions are."""
        self.table(f"runs/{key}", lambda: self.spark.createDataFrame([(*row, name, unit)], _RUN_SCHEMA).coalesce(1))

    def runs(self, keys: Sequence[str]) -> DataFrame:
        return self.spark.read.schema(_RUN_SCHEMA).parquet(*[f"{self.path}/runs/{k}" for k in keys])


def run_key(version: str, model_name: str, imbalance: str) -> str:
    return f"{version}__{model_name}__{imbalance}"


@dataclass
class Matrix:
    """A plan's results: ``matrix[run_key]`` is the run's model, fitted on the whole training split."""

    ledger: Ledger
    p: B.Prepared
    label: str
    id_col: str
    done: dict[str, tuple[str, str, int]]  # run key -> (ledger name, parameters, unit)

    def __getitem__(self, key: str):
        version, model_name, imbalance = key.split("__")
        name, params, unit = self.done[key]
        rows = self.ledger.spark.read.parquet(f"{self.ledger.path}/models/{name}").where(F.col("unit") == unit).orderBy("part")
        donors = None
        if model_name == "knn":
            rows_of = self.p.train.where(F.col("g") == self.p.group(version, imbalance.startswith("smote"), self.p.n_splits))
            donors = rows_of.select(F.col("id").alias(self.id_col), *[F.col("x")[i].alias(c) for i, c in enumerate(self.p.features)], F.col("y").alias(self.label))
        return B.BatchModel(model_name, json.loads(params), self.p.features, self.label, self.id_col, [bytes(r["payload"]) for r in rows.collect()], donors)

    def test_predictions(self, key: str) -> DataFrame:
        """``id, y, score, prediction`` of the run's test rows, as its metrics were computed from."""
        name = self.done[key][0]
        return self.ledger.spark.read.parquet(f"{self.ledger.path}/test/{name}").where(F.col("run_key") == key).drop("run_key")


def run_model(ledger: Ledger, p: B.Prepared, model_name: str, runs: Sequence[tuple[str, str, str]], grid: Sequence[Mapping], seed: int) -> None:
    """All open runs of one model: predictions of every candidate on validation and test rows, the best candidate of each
    run (mean fold AUC; ties: the first), its test metrics."""
    keys = [run_key(*r) for r in runs]
    name = f"{model_name}-{hashlib.sha256(json.dumps(sorted(keys)).encode()).hexdigest()[:12]}"
    units: dict[B.Unit, int] = {}
    of = {}
    for v, _, method in runs:
        for c, params in enumerate(grid):
            for task in range(p.n_splits + 1):
                u = B.unit_of(p, model_name, p.group(v, method.startswith("smote"), task), method, params, seed)
                of[(run_key(v, model_name, method), c, task)] = units.setdefault(u, len(units))
    if not (ledger.finished(f"predictions/{name}") and ledger.finished(f"models/{name}")):
        scored, payloads = B.fit_and_score(p, model_name, {k: u for u, k in units.items()})
        ledger.table(f"predictions/{name}", lambda: scored)
        ledger.table(f"models/{name}", lambda: payloads)
    scored = ledger.spark.read.parquet(f"{ledger.path}/predictions/{name}")
    aucs = {r["unit"]: r["roc_auc"] for r in M.roc_auc(scored, "y", "score", by=["unit"]).collect()}
    best = {}
    for key in keys:
        means = []
        for c in range(len(grid)):
            values = [aucs.get(of[(key, c, f)]) for f in range(p.n_splits)]
            means.append(None if None in values else sum(values) / len(values))
        c = max(range(len(grid)), key=lambda i: (means[i] is not None, means[i] or 0.0, -i))
        best[key] = (c, means[c], of[(key, c, p.n_splits)])
    named = ledger.spark.createDataFrame([(k, b[2]) for k, b in best.items()], "run_key string, unit int")
    test = scored.join(F.broadcast(named), "unit").drop("unit")
    test = ledger.table(f"test/{name}", lambda: B.rescaled(test, ["run_key"]) if model_name == "svm" else test)
    metrics = {r["run_key"]: r for r in M.evaluate_predictions(test, "y", "prediction", "score", by=["run_key"]).collect()}

    def put(run):
        key = run_key(*run)
        c, mean, unit = best[key]
        m = metrics.get(key)
        numbers = [None if m is None or m[x] is None else float(m[x]) for x in ("accuracy", "precision", "recall", "f1", "roc_auc")]
        ledger.put(key, (*run, MD.params_json(grid[c]), mean, *numbers), name, unit)

    with ThreadPoolExecutor(max_workers=8) as pool:
        list(pool.map(put, runs))


def run_experiments(
    spark: SparkSession,
    frames: Mapping[str, tuple[DataFrame, DataFrame]],
    features: Sequence[str],
    label: str,
    id_col: str,
    models: Sequence[str] = MODELS,
    methods: Sequence[str] = IMBALANCE_METHODS,
    grids: Mapping[str, Sequence[Mapping]] | None = None,
    n_splits: int = 5,
    parallelism: int = 3,
    seed: int = 42,
    folder: str | None = None,
):
    """The whole matrix; returns ``(results DataFrame, Matrix)``. ``folder``: a shared folder for the ledger; a plan
    that died goes on there. ``parallelism``: models that are fitted at a time. All models are fitted in one way at every size."""
    plan = run_plan(list(frames), models, methods)
    grids = {m: list((grids or {}).get(m) or MD.candidates(m, seed=seed)) for m in dict.fromkeys([*MODELS, *models])}
    folder = folder or f"{ensure_checkpoint_dir(spark).rstrip('/')}/experiments-{uuid.uuid4().hex}"
    settings = {"versions": list(frames), "features": list(features), "label": label, "id": id_col, "grids": grids, "n_splits": n_splits, "seed": seed}
    settings["smote"] = any(i.startswith("smote") for *_, i in plan)
    ledger = Ledger(spark, folder, settings)
    if not (ledger.finished("train") and ledger.finished("targets")):
        train, targets = B.prepare_tables(frames, features, label, id_col, settings["smote"], n_splits, seed)
        ledger.table("targets", lambda: targets)
        ledger.table("train", lambda: train)
    p = B.prepared(ledger.table("train", None), ledger.table("targets", None), features, list(frames), n_splits)
    matrix = Matrix(ledger, p, label, id_col, {})

    def one(model_name: str) -> None:
        open_runs = [r for r in plan if r[1] == model_name and not ledger.finished(f"runs/{run_key(*r)}")]
        if open_runs:
            run_model(ledger, p, model_name, open_runs, grids[model_name], seed)

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        list(pool.map(one, dict.fromkeys(m for _, m, _ in plan)))
    runs = ledger.runs([run_key(*r) for r in plan])
    matrix.done |= {run_key(*r[:3]): (r["_name"], r["best_params"], r["_unit"]) for r in runs.collect()}
    return runs.select(*RESULT_SCHEMA.names), matrix


def comparison_table(results: DataFrame) -> DataFrame:
    """Results with ``run_key`` and leaderboard ``rank``."""
    keyed = results.withColumn("run_key", F.concat_ws("__", "dataset_version", "model_name", "imbalance_method"))
    return M.leaderboard(keyed)


def best_model(results: DataFrame, fitted: Mapping, path: str | None = None):
    """The leaderboard's first run; its model is saved under ``path``."""
    best = M.best_run(results.withColumn("run_key", F.concat_ws("__", "dataset_version", "model_name", "imbalance_method")))
    row = best.first()
    if path and row is not None:
        MD.save_model(fitted[row["run_key"]], path)
    return best
