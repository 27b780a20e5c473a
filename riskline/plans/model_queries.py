"""Registered queries: preprocessing, models, tuning, selection, experiment matrix.

All run on F-COHORT (one row per customer, derived from customer + orders),
cleaned with the imputers and split 80/20 with exact stratified quotas.
Model fits are MLlib jobs; these queries have no SQL twin and are checked by
properties in the tests.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from riskline.operators import linear_batch as LB
from riskline.operators import metrics as M
from riskline.operators import missing as MS
from riskline.operators import models as MD
from riskline.operators import pipelines as PL
from riskline.operators import sampling as SP
from riskline.operators.quantiles import medians
from riskline.plans import experiment as X
from riskline.plans.describe_queries import _extra
from riskline.plans.registry import query
from riskline.plans.sampling_queries import split_cte
from riskline.session import ensure_checkpoint_dir
from riskline.sources import fixtures as FX
from riskline.sources.fixtures import with_fixtures

FEAT = X.COHORT_FEATURES


def _versions(spark, sf_dir, versions=("unscaled", "standard_scaled")):
    df = X.cohort_model_input(spark, sf_dir)
    return X.split_versions(df, FEAT, "label", "id", versions)


def _metrics_row(fm, test):
    pred = fm.predict(test)
    return M.evaluate_predictions(pred, "label", "prediction", "score")


@query("k1_logistic_regression")
def k1_logistic_regression(spark, sf_dir):
    """K1: L2 logistic regression (C=1) on standard-scaled features: test metrics."""
    tr, te = _versions(spark, sf_dir, ["standard_scaled"])["standard_scaled"]
    return _metrics_row(MD.fit_model("logistic_regression", {"C": 1.0, "penalty": "l2"}, tr, FEAT, "label", "id"), te)


@query("k1_logistic_regression_l1_weighted")
def k1_logistic_regression_l1_weighted(spark, sf_dir):
    """K1 + I3: L1 logistic regression with balanced class weights."""
    tr, te = _versions(spark, sf_dir, ["standard_scaled"])["standard_scaled"]
    fm = MD.fit_model("logistic_regression", {"C": 1.0, "penalty": "l1"}, tr, FEAT, "label", "id", "class_weight")
    return _metrics_row(fm, te)


@query("k3_decision_tree")
def k3_decision_tree(spark, sf_dir):
    """K3: entropy tree, depth 10."""
    tr, te = _versions(spark, sf_dir, ["unscaled"])["unscaled"]
    fm = MD.fit_model("decision_tree", {"max_depth": 10, "criterion": "entropy", "min_samples_leaf": 1}, tr, FEAT, "label", "id")
    return _metrics_row(fm, te)


@query("k4_random_forest")
def k4_random_forest(spark, sf_dir):
    """K4: 200-tree forest, sqrt features, leaf 2, with SMOTE on the train split."""
    tr, te = _versions(spark, sf_dir, ["unscaled"])["unscaled"]
    params = {"n_estimators": 200, "max_depth": 10, "min_samples_leaf": 2, "max_features": "sqrt"}
    return _metrics_row(MD.fit_model("random_forest", params, tr, FEAT, "label", "id", "smote"), te)


@query("k5_linear_svm")
def k5_linear_svm(spark, sf_dir):
    """K5: linear SVM (C=5) with class weights; score = rescaled margin."""
    tr, te = _versions(spark, sf_dir, ["standard_scaled"])["standard_scaled"]
    return _metrics_row(MD.fit_model("svm", {"C": 5, "kernel": "linear"}, tr, FEAT, "label", "id", "class_weight"), te)


@query("k5b_rbf_svm_fourier")
def k5b_rbf_svm_fourier(spark, sf_dir):
    """RBF kernel approximated with random Fourier features + linear SVM."""
    tr, te = _versions(spark, sf_dir, ["standard_scaled"])["standard_scaled"]
    return _metrics_row(MD.fit_model("svm", {"C": 1, "kernel": "rbf", "gamma": "scale"}, tr, FEAT, "label", "id"), te)


@query("k10_predict_proba")
def k10_predict_proba(spark, sf_dir):
    """Positive-class probability per test row (logistic regression)."""
    tr, te = _versions(spark, sf_dir, ["standard_scaled"])["standard_scaled"]
    fm = MD.fit_model("logistic_regression", {"C": 1.0, "penalty": "l2"}, tr, FEAT, "label", "id")
    return fm.predict(te)


@query("k8_tune_grid_search")
def k8_tune_grid_search(spark, sf_dir):
    """K8: exhaustive 5-fold CV over the logistic-regression grid (mean fold AUC)."""
    tr, _ = _versions(spark, sf_dir, ["standard_scaled"])["standard_scaled"]
    res = MD.tune_model("logistic_regression", tr, FEAT, "label", "id")
    rows = [(MD.params_json(p), float(s), MD.params_json(p) == MD.params_json(res.best_params)) for p, s in res.scores]
    return spark.createDataFrame(rows, "params string, cv_roc_auc double, best boolean")


_C_GRID = (0.1, 1.0, 10.0)
_BALANCED = {"none": ("1.0::DOUBLE", "1.0::DOUBLE"), "balanced": ("n / (2.0 * n0)", "n / (2.0 * n1)")}

# Newton's method on two coefficients, written out: 20 steps for each C and weighting
_NEWTON_SQL = with_fixtures(
    ", d AS (SELECT n_orders / 10.0 AS x, label::DOUBLE AS y FROM cohort WHERE n_orders IS NOT NULL), "
    "t AS (SELECT count(*)::DOUBLE AS n, count_if(y = 0)::DOUBLE AS n0, count_if(y = 1)::DOUBLE AS n1 FROM d), "
    "u AS (" + " UNION ALL ".join(f"SELECT '{k}' AS weighting, {a} AS w0, {b} AS w1 FROM t" for k, (a, b) in _BALANCED.items()) + "), "
    "it AS (SELECT weighting, w0, w1, c, 0 AS k, 0.0::DOUBLE AS a, 0.0::DOUBLE AS b FROM u, (VALUES "
    + ", ".join(f"({c}::DOUBLE)" for c in _C_GRID)
    + ") v(c) UNION ALL SELECT weighting, w0, w1, c, k + 1, a - (hbb * ga - hab * gb) / (haa * hbb - hab * hab), "
    "b - (haa * gb - hab * ga) / (haa * hbb - hab * hab) FROM (SELECT weighting, w0, w1, c, k, a, b, "
    "a + c * sum(w * x * (p - y)) AS ga, b + c * sum(w * (p - y)) AS gb, 1 + c * sum(w * p * (1 - p) * x * x) AS haa, "
    "c * sum(w * p * (1 - p) * x) AS hab, 1 + c * sum(w * p * (1 - p)) AS hbb FROM (SELECT it.*, x, y, 1 / (1 + exp(-(a * x + b))) AS p, "
    "CASE WHEN y = 1 THEN w1 ELSE w0 END AS w FROM it, d WHERE k < 20) GROUP BY weighting, w0, w1, c, k, a, b)) "
    "SELECT weighting, c, round(a, 6) AS slope, round(b, 6) AS intercept FROM it WHERE k = 20"
).replace("WITH bulk", "WITH RECURSIVE bulk", 1)


@query("k1_newton_logistic", _NEWTON_SQL)
def k1_newton_logistic(spark, sf_dir):
    """l2 logistic regression (the intercept is penalised too) of the label on the number of orders, for three C
    and both weightings, all fitted in shared scans."""
    df = FX.cohort(spark, sf_dir).where("n_orders is not null")
    rows = df.select(F.lit(0).alias("g"), F.col("label").cast("double").alias("y"), F.array(F.col("n_orders") / 10.0).alias("x"))
    n0, n1 = rows.agg(F.count_if(F.col("y") == 0), F.count_if(F.col("y") == 1)).first()
    weights = {"none": (1.0, 1.0), "balanced": ((n0 + n1) / (2.0 * n0), (n0 + n1) / (2.0 * n1))}
    plan = [(w, c) for w in weights for c in _C_GRID]
    found, _ = LB.fit_linear(rows, [LB.Fit(0, C=c, weights=weights[w]) for w, c in plan])
    return spark.createDataFrame([(w, c, float(b[0]), float(b[1])) for (w, c), b in zip(plan, found)], "weighting string, c double, slope double, intercept double")


_TERMS = [*FEAT, "intercept"]


@query(
    "k8_grid_optimality",
    "SELECT penalty, c::DOUBLE AS c, fold, term, 0.0::DOUBLE AS gradient, true AS few_scans FROM (VALUES ('l1'), ('l2')) p(penalty), (VALUES (0.1), (1), (10)) q(c), "
    f"range(5) r(fold), (VALUES {', '.join(f'({t!r})' for t in _TERMS)}) t(term)",
)
def k8_grid_optimality(spark, sf_dir):
    """K8/K1: the 6 x 5 grid of logistic regressions in at most 15 scans; at each returned optimum the gradient of the whole
    objective (l1: its distance from the subgradient), recomputed by a plain aggregate, is zero."""
    tr, _ = _versions(spark, sf_dir, ["standard_scaled"])["standard_scaled"]
    ensure_checkpoint_dir(spark)
    folded = SP.stratified_folds(tr, "label", ["id"], 5, 42).checkpoint(eager=True)
    each = F.explode(F.filter(F.sequence(F.lit(0), F.lit(4)), lambda t: t != F.col("fold"))).alias("g")
    rows = folded.select(each, F.col("label").cast("double").alias("y"), F.array(*[F.col(c).cast("double") for c in FEAT]).alias("x"))
    fits = [LB.Fit(f, penalty=p, C=c) for p in ("l1", "l2") for c in _C_GRID for f in range(5)]
    found, scans = LB.fit_linear(rows, fits)
    out = None
    for fit, b in zip(fits, found):
        one = LB.optimality(fit, FEAT, "label", None, [float(v) for v in b], folded.where(F.col("fold") != fit.group))
        one = one.select(F.lit(fit.penalty).alias("penalty"), F.lit(fit.C).alias("c"), F.lit(fit.group).cast("long").alias("fold"), "term", "gradient")
        out = one if out is None else out.unionByName(one)
    return out.withColumn("few_scans", F.lit(scans <= 15))


@query("k9_tune_random_search")
def k9_tune_random_search(spark, sf_dir):
    """K9: 4 combinations drawn from the decision-tree grid, 5-fold CV."""
    tr, _ = _versions(spark, sf_dir, ["unscaled"])["unscaled"]
    grid = MD.sample_grid(MD.SEARCH_SPACES["decision_tree"]["params"], 4, seed=42)
    res = MD.tune_model("decision_tree", tr, FEAT, "label", "id", grid=grid)
    rows = [(MD.params_json(p), float(s), MD.params_json(p) == MD.params_json(res.best_params)) for p, s in res.scores]
    return spark.createDataFrame(rows, "params string, cv_roc_auc double, best boolean")


@query("k15_rfe")
def k15_rfe(spark, sf_dir):
    """RFE down to 2 of the 4 cohort features."""
    df = X.cohort_model_input(spark, sf_dir)
    return MD.rfe(df, FEAT, "label", 2)


@query("k16_tree_importance")
def k16_tree_importance(spark, sf_dir):
    """Balanced 300-tree forest importances (sum to 1)."""
    df = X.cohort_model_input(spark, sf_dir)
    return MD.tree_importance(df, FEAT, "label", n_trees=300)


@query("k17_feature_selection")
def k17_feature_selection(spark, sf_dir):
    """|r| with the target, RFE rank and forest importance per feature, joined."""
    df = X.cohort_model_input(spark, sf_dir)
    corr, rf, imp = MD.feature_selection(df, FEAT, "label", n_select=2, n_trees=300)
    return rf.join(imp, "feature", "left").join(corr.withColumnRenamed("variable", "feature"), "feature", "left")


# the median of a robust-scaled column is 0
@query("j3_preprocessor", "SELECT " + ", ".join(f"0.0::DOUBLE AS {c}_median" for c in FEAT))
def j3_preprocessor(spark, sf_dir):
    """Robust scaler fitted on train, then vector assembly: per-feature train median ~0."""
    df = X.cohort_model_input(spark, sf_dir)
    s = SP.stratified_split(df, "label", ["id"])
    train = s.where(F.col("split") == "train")
    pp = MD.make_preprocessor(FEAT, "robust").fit(train)
    out = pp.transform(train)
    from pyspark.ml.functions import vector_to_array

    arr = out.select(vector_to_array("features").alias("v"))
    middle = medians(arr.select(*[F.col("v")[i].alias(c) for i, c in enumerate(FEAT)]), FEAT)
    return spark.createDataFrame([tuple(middle[c] for c in FEAT)], ", ".join(f"{c}_median double" for c in FEAT))


# --- experiment matrix -------------------------------------------------------------

def _matrix(spark, sf_dir):
    return X.run_experiments(spark, _versions(spark, sf_dir, X.DATASET_VERSIONS), FEAT, "label", "id")


@query("k18_experiment_matrix")
def k18_experiment_matrix(spark, sf_dir):
    """3 versions x 5 models x 4 imbalance methods minus k-NN x weights (54 runs), whole search spaces, 5 folds."""
    res, _ = _matrix(spark, sf_dir)
    return X.comparison_table(res)


@query("k19_best_model")
def k19_best_model(spark, sf_dir):
    """Best run of the whole matrix, its model saved to the shared checkpoint folder."""
    res, fitted = _matrix(spark, sf_dir)
    path = os.path.join(ensure_checkpoint_dir(spark), f"best-model-{uuid.uuid4().hex[:8]}")
    return X.best_model(res, fitted, path)


# as many test rows as the quota says, and no difference
@query("a4_model_roundtrip", with_fixtures("SELECT CAST(ceil(0.2 * count(*)) AS BIGINT) AS n, 0.0::DOUBLE AS max_abs_diff FROM cohort"))
def a4_model_roundtrip(spark, sf_dir):
    """A4: save + load a fitted model: identical test scores (max |diff| = 0)."""
    tr, te = _versions(spark, sf_dir, ["standard_scaled"])["standard_scaled"]
    fm = MD.fit_model("logistic_regression", {"C": 1.0, "penalty": "l2"}, tr, FEAT, "label", "id")
    path = os.path.join(ensure_checkpoint_dir(spark), f"model-{uuid.uuid4().hex[:8]}")
    MD.save_model(fm, path)
    back = MD.load_model(spark, path)
    a = fm.predict(te).select("id", F.col("score").alias("a"))
    b = back.predict(te).select("id", F.col("score").alias("b"))
    return a.join(b, "id").agg(F.count(F.lit(1)).cast("bigint").alias("n"), F.max(F.abs(F.col("a") - F.col("b"))).alias("max_abs_diff"))


@query("k6_pipeline_roundtrip", with_fixtures("SELECT CAST(ceil(0.2 * count(*)) AS BIGINT) AS n, 0.0::DOUBLE AS max_abs_diff, true AS same_predictions FROM cohort"))
def k6_pipeline_roundtrip(spark, sf_dir):
    """Robust scaler -> SMOTE -> logistic regression as one pipeline, saved and loaded: equal scores for the raw
    test rows, one for each (SMOTE adds rows in fitting only)."""
    tr, te = _versions(spark, sf_dir, ["unscaled"])["unscaled"]
    pipe = PL.ModelPipeline(MD.make_preprocessor(FEAT, "robust"), "logistic_regression", {"C": 1.0}, "label", "id", use_smote=True)
    fitted = pipe.fit(tr)
    path = fitted.save(spark, os.path.join(ensure_checkpoint_dir(spark), f"pipeline-{uuid.uuid4().hex[:8]}"))
    a = fitted.predict(te).select("id", F.col("score").alias("a"), F.col("prediction").alias("pa"))
    b = PL.load_pipeline(spark, path).predict(te).select("id", F.col("score").alias("b"), F.col("prediction").alias("pb"))
    return a.join(b, "id", "full").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.max(F.abs(F.col("a") - F.col("b"))).alias("max_abs_diff"),
        F.every(F.col("pa") == F.col("pb")).alias("same_predictions"),
    )


_RAW = ["acctbal", "n_orders", "avg_total", "max_total"]


def _raw_versions(spark, sf_dir):
    """The three dataset versions of the raw cohort, each scaler fitted on the train part."""
    return X.split_versions(FX.cohort(spark, sf_dir), _RAW, "label", "id", order_key=(F.col("id") * 7919) % 1000003)


_COHORT_SPLIT = split_cte("cohort", "(id * 7919) % 1000003", "id")


@query(
    "a6_dataset_shapes",
    _extra(
        _COHORT_SPLIT,
        "SELECT v.dataset_version, split, CAST(count(*) AS BIGINT) AS n_rows, 4 AS n_features, CAST(sum(label) AS BIGINT) AS positives, "
        "round(avg(label::DOUBLE), 6) AS positive_rate FROM s, (VALUES ('unscaled'), ('standard_scaled'), ('robust_scaled')) v(dataset_version) "
        "GROUP BY v.dataset_version, split",
    ),
)
def a6_dataset_shapes(spark, sf_dir):
    """Rows, features and label rate per dataset version and split."""
    return X.dataset_shapes(_raw_versions(spark, sf_dir), "label", _RAW)


@query(
    "c2_missing_by_version",
    _extra(
        _COHORT_SPLIT,
        " UNION ALL ".join(
            f"SELECT v.dataset_version || '_' || split AS dataset_version, '{c}' AS column, CAST(count_if({c} IS NULL) AS BIGINT) AS missing_values, "
            f"round(count_if({c} IS NULL) / count(*) * 100, 6) AS percentage FROM s, "
            "(VALUES ('unscaled'), ('standard_scaled'), ('robust_scaled')) v(dataset_version) GROUP BY v.dataset_version, split"
            for c in _RAW
        ),
    ),
)
def c2_missing_by_version(spark, sf_dir):
    """Missing summary per dataset version and split of the raw cohort (before imputation; scaling keeps the NULLs)."""
    frames = {f"{v}_{part}": df for v, pair in _raw_versions(spark, sf_dir).items() for part, df in zip(("train", "test"), pair)}
    return MS.missing_by_version(frames, _RAW)
