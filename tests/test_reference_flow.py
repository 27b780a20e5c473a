"""The reference-named flow end to end on a small raw table written by the test."""

from __future__ import annotations

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from riskline.plans import reference_flow as R


def _write_raw(path, n=300, seed=1):
    rng = random.Random(seed)
    header = "sex,age,education,currentSmoker,cigsPerDay,BPMeds,prevalentStroke,prevalentHyp,diabetes,totChol,sysBP,diaBP,BMI,heartRate,glucose,TenYearCHD"
    lines = [header]
    for i in range(n):
        sys_bp = rng.uniform(100, 180)
        row = [
            rng.choice(["M", "F"]), rng.randint(32, 70), rng.choice(["1", "2", "3", "4", "NA"] if i % 25 == 0 else ["1", "2", "3", "4"]),
            rng.choice(["Yes", "No"]), rng.choice([0, 0, 10, 20]), "NA" if i % 40 == 0 else rng.choice([0, 1]),
            int(rng.random() < 0.05), int(rng.random() < 0.3), int(rng.random() < 0.05), round(rng.uniform(150, 350)),
            round(sys_bp, 1), round(sys_bp - rng.uniform(30, 60), 1), round(rng.uniform(17, 40), 2), rng.randint(55, 110),
            "NA" if i % 11 == 0 else rng.randint(60, 140), int(rng.random() < 0.15),
        ]
        lines.append(",".join(str(x) for x in row))
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_reference_flow_end_to_end(spark):
    d = tempfile.mkdtemp(prefix="riskline-ref-")
    raw = os.path.join(d, "raw.csv")
    _write_raw(raw)
    cleaned, reports = R.run_cleaning(spark, raw, out_dir=d)
    miss = {r["column"]: r["missing_values"] for r in reports["missing"].collect()}
    assert miss["glucose"] == len(range(0, 300, 11)) and miss["bp_medication"] == len(range(0, 300, 40))
    assert cleaned.where(F.col("glucose").isNull()).count() == 0  # k-NN filled (> 5% missing)
    assert cleaned.where(F.col("bp_medication").isNull()).count() == 0  # mode filled (< 5% missing)
    assert cleaned.count() == 300
    final, vif = R.run_features(cleaned)
    v = {r["feature"]: r["vif"] for r in vif.collect()}
    assert v["pulse_pressure"] == pytest.approx(float("inf")) or v["pulse_pressure"] > 1e6  # sys - dia dependency
    assert set(final.columns) == {"row_id", *R.MODEL_FEATURES, R.TARGET}
    outs = R.run_split_and_scale(final, out_dir=d)
    n_test = outs["test_unscaled"].count()
    assert n_test == 60 and outs["train_unscaled"].count() == 240
    m = outs["train_standard_scaled"].agg(*[F.avg(c).alias(c) for c in R.MODEL_FEATURES]).first()
    assert all(abs(m[c]) < 1e-9 for c in R.MODEL_FEATURES)
    back = spark.read.option("header", True).csv(os.path.join(d, "test_unscaled.csv"))
    assert back.count() == 60


REFERENCE_FUNCTIONS = """load_data rename_columns convert_dtypes missing_value_summary get_column_types simple_imputation
knn_impute_glucose outliers_iqr iqr_outlier_summary zscore_outlier_summary split_data create_unscaled_sets standard_scale
robust_scale build_scaled_dataframe standardize_target derive_features compute_vif feature_selection build_final_dataset
save_final_dataset load_dataset prepare_features make_preprocessor get_estimators build_pipeline get_search_spaces get_cv
tune_model predict_proba_positive evaluate_predictions compute_roc_curve compute_pr_curve cramers_v cohens_d
calculate_importance_score classify_usefulness run_one_experiment""".split()


def test_api_names_cover_the_reference_functions():
    from riskline import api

    missing = [n for n in REFERENCE_FUNCTIONS if not callable(getattr(api, n, None))]
    assert not missing
    assert api.cramers_v(5.4, 60, 2, 2) == pytest.approx((5.4 / 60) ** 0.5)


def test_api_calls_run(spark):
    from riskline import api

    df = spark.createDataFrame(
        [(i, float(i % 7), None if i % 9 == 0 else float(i % 5), i % 2) for i in range(60)], "row_id long, a double, b double, y int"
    )
    miss = {r["column"]: r["missing_values"] for r in api.missing_value_summary(df, ["a", "b"]).collect()}
    assert miss == {"a": 0, "b": 7}
    filled = api.simple_imputation(df, ["a", "b"], [])  # b is 11.7% null: left as is
    assert filled.where("b IS NULL").count() == 7
    train, test = api.split_data(df, ["a"], "y", "row_id")
    assert train.count() == 48 and test.count() == 12
    assert api.compute_vif(df.fillna(0.0), ["a", "b"]).count() == 2
