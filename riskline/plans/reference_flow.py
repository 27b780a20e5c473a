"""The reference's own pipeline on its own column names, as Spark jobs.

``run_cleaning`` is the script flow (load -> rename / cast -> missing profile ->
median / mode / k-NN imputation -> outlier reports -> write);
``run_features`` derives the engineered columns, the VIF table and the final
projection; ``run_split_and_scale`` writes the unscaled / standard / robust
train and test sets. The input is the 16-column raw table (CSV with the
schema below). Every step is one of the library's distributed operators.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskline.operators import clean, missing, outliers, sampling, scaling, stats
from riskline.operators.neighbors import knn_impute
from riskline.sources.readers import read_csv
from riskline.sources.writers import write_table

# ---------------------------------------------------------------------------
# The reference's schema and column lists.
# ---------------------------------------------------------------------------
RAW_SCHEMA = (
    "sex string, age double, education double, currentSmoker string, cigsPerDay double, BPMeds double, "
    "prevalentStroke double, prevalentHyp double, diabetes double, totChol double, sysBP double, diaBP double, "
    "BMI double, heartRate double, glucose double, TenYearCHD int"
)
NUMERICAL = ["age", "cigarettes_per_day", "total_cholesterol", "systolic_bp", "diastolic_bp", "bmi", "heart_rate", "glucose"]
CATEGORICAL = ["sex", "education_level", "current_smoker", "bp_medication", "previous_stroke", "hypertension", "diabetes", "ten_year_chd"]
GLUCOSE_PREDICTORS = [
    "age", "bmi", "systolic_bp", "diastolic_bp", "total_cholesterol", "heart_rate", "cigarettes_per_day",
]
VIF_FEATURES = [
    "age", "systolic_bp", "diastolic_bp", "pulse_pressure", "bmi", "total_cholesterol", "heart_rate", "glucose", "risk_factor_count",
]
CANDIDATE_FEATURES = [
    "age", "sex", "pulse_pressure", "bmi", "total_cholesterol", "glucose", "heart_rate", "risk_factor_count",
    "previous_stroke", "age_group_code", "bmi_category_code",
]
MODEL_FEATURES = [
    "bmi", "hypertension", "pulse_pressure", "cigarettes_per_day", "total_cholesterol", "glucose", "heart_rate", "age_group_code",
]
TARGET = "TenYearCHD"


def get_column_types() -> tuple[list[str], list[str]]:
    """The fixed numerical / categorical lists."""
    return list(NUMERICAL), list(CATEGORICAL)


def load_raw(spark: SparkSession, path: str) -> DataFrame:
    """A1: raw CSV with the reference schema; ``NA`` and empty fields are NULL."""
    return read_csv(spark, path, schema=RAW_SCHEMA, null_value="NA")


def convert_reference_dtypes(df: DataFrame) -> DataFrame:
    """B5 with the reference's casts: M/F and Yes/No recodes, nullable ints, strict ints."""
    return clean.convert_dtypes(
        df,
        {"sex": {"M": 1, "F": 0}, "current_smoker": {"Yes": 1, "No": 0}},
        nullable_ints=["education_level", "bp_medication"],
        strict_ints=["previous_stroke", "hypertension", "diabetes"],
    )


def run_cleaning(spark: SparkSession, raw_path: str, out_dir: str | None = None, id_col: str = "row_id"):
    """Script flow up to the cleaned table. Returns ``(cleaned, reports)``.

    Rows get a stable ``row_id`` (needed for neighbour identity), from
    ``monotonically_increasing_id`` over the freshly read file, materialised
    with a reliable checkpoint so a recomputation cannot renumber them."""
    from riskline.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    raw = load_raw(spark, raw_path).withColumn(id_col, F.monotonically_increasing_id()).checkpoint(eager=True)
    df = convert_reference_dtypes(clean.rename_columns(raw))
    reports = {"missing": missing.missing_value_summary(df, [c for c in df.columns if c != id_col])}
    num, cat = get_column_types()
    df = missing.simple_imputation(df, num, cat, threshold=0.05)
    df = knn_impute(df, id_col, "glucose", GLUCOSE_PREDICTORS, k=5)
    df = df.checkpoint(eager=True)
    reports["iqr_outliers"] = outliers.iqr_outlier_summary(df, num)
    reports["zscore_outliers"] = outliers.zscore_outlier_summary(df, num)
    if out_dir:
        write_table(df.drop(id_col), os.path.join(out_dir, "cleaned.csv"), fmt="csv")
    return df, reports


def run_features(df: DataFrame, id_col: str = "row_id"):
    """Feature engineering: derived columns, VIF, final projection (returns ``(final, vif)``)."""
    d = clean.standardize_target(df, TARGET, aliases=["ten_year_chd"])
    d = clean.reference_derive_features(d)
    vif_table = stats.vif(d, VIF_FEATURES)
    final = clean.prepare_features(d, MODEL_FEATURES, TARGET, [id_col])
    return final, vif_table


def run_split_and_scale(final: DataFrame, out_dir: str | None = None, id_col: str = "row_id", seed: int = 42):
    """Stratified 80/20 split; standard and robust scalers fitted on train;
    returns ``{name: DataFrame}`` for the six output tables."""
    s = sampling.stratified_split(final, TARGET, [id_col], 0.2, seed)
    train, test = s.where(F.col("split") == "train").drop("split"), s.where(F.col("split") == "test").drop("split")
    std = scaling.fit_standard_scaler(train, MODEL_FEATURES)
    rob = scaling.fit_robust_scaler(train, MODEL_FEATURES)
    out = {
        "train_unscaled": train,
        "test_unscaled": test,
        "train_standard_scaled": std.transform(train),
        "test_standard_scaled": std.transform(test),
        "train_robust_scaled": rob.transform(train),
        "test_robust_scaled": rob.transform(test),
    }
    if out_dir:
        for name, frame in out.items():
            write_table(frame.drop(id_col), os.path.join(out_dir, f"{name}.csv"), fmt="csv")
    return out
