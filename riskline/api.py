"""The reference's function names, with Spark signatures.

A user of the reference finds each of its functions here under the same
name; each maps onto the distributed operator that does the work (section 2
of the survey gives the id in brackets). Frames are Spark DataFrames; where
the reference split X and y, the features and the target stay in one frame
and an id column carries row identity.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskline.functions import exprs as X
from riskline.operators import clean, metrics, missing, models, neighbors, outliers, pipelines, sampling, scaling, stats
from riskline.plans import experiment, reference_flow
from riskline.sources import readers, writers

# --- data cleaning -------------------------------------------------------------------


def load_data(spark: SparkSession, path: str, schema: str | None = reference_flow.RAW_SCHEMA) -> DataFrame:
    """[A1]"""
    return readers.read_csv(spark, path, schema=schema) if path.endswith(".csv") else readers.load_data(spark, path)


load_dataset = load_data
rename_columns = clean.rename_columns  # [B1]
convert_dtypes = reference_flow.convert_reference_dtypes  # [B5]
missing_value_summary = missing.missing_value_summary  # [C1]
get_column_types = reference_flow.get_column_types  # [B6]
simple_imputation = missing.simple_imputation  # [C6]
iqr_outlier_summary = outliers.iqr_outlier_summary  # [D2]
zscore_outlier_summary = outliers.zscore_outlier_summary  # [D3]


def outliers_iqr(df: DataFrame, column: str) -> DataFrame:
    """[D1] the outlying rows of ``column``."""
    return outliers.outliers_iqr(df, column)


def knn_impute_glucose(df: DataFrame, id_col: str = "row_id", k: int = 5) -> DataFrame:
    """[C7] 5-NN fill of ``glucose`` over the reference's eight columns."""
    return neighbors.knn_impute(df, id_col, "glucose", reference_flow.GLUCOSE_PREDICTORS, k=k)


# --- normalisation ------------------------------------------------------------------


def split_data(df: DataFrame, selected_features: Sequence[str], target: str, id_col: str, test_size: float = 0.2, random_state: int = 42):
    """[I1] ``(train, test)`` with the features, the target and the id in each frame."""
    proj = df.select(id_col, *selected_features, target)
    return sampling.split_data(proj, target, [id_col], test_size, random_state)


def create_unscaled_sets(x_train: DataFrame, x_test: DataFrame, y_train: DataFrame, y_test: DataFrame, id_col: str):
    """[B12] ``(train, test)``: the features with the target of the same id attached."""
    return x_train.join(y_train, id_col), x_test.join(y_test, id_col)


def standard_scale(train: DataFrame, test: DataFrame, features: Sequence[str]):
    """[J1] ``(train_scaled, test_scaled, fitted)``."""
    return scaling.standard_scale(train, test, features)


def robust_scale(train: DataFrame, test: DataFrame, features: Sequence[str]):
    """[J2] ``(train_scaled, test_scaled, fitted)``."""
    return scaling.robust_scale(train, test, features)


def build_scaled_dataframe(scaled: DataFrame, feature_names: Sequence[str], y: DataFrame, target: str, id_col: str) -> DataFrame:
    """[B13] ``id, features, target``: scaled features with the target of the same id attached."""
    return scaled.select(id_col, *feature_names).join(y.select(id_col, target), id_col)


# --- feature engineering -------------------------------------------------------------


def standardize_target(df: DataFrame) -> DataFrame:
    """[B8]"""
    return clean.standardize_target(df, reference_flow.TARGET, aliases=["ten_year_chd"])


derive_features = clean.reference_derive_features  # [B24]


def compute_vif(df: DataFrame, features: Sequence[str] = reference_flow.VIF_FEATURES) -> DataFrame:
    """[D23]"""
    return stats.vif(df, features)


def feature_selection(df: DataFrame, features: Sequence[str] = reference_flow.CANDIDATE_FEATURES, target: str = reference_flow.TARGET):
    """[K17] ``(|r| with target, RFE table, forest importances)``."""
    return models.feature_selection(df, features, target, n_select=8)


def build_final_dataset(df: DataFrame, features: Sequence[str] = reference_flow.CANDIDATE_FEATURES, target: str = reference_flow.TARGET, id_col: str | None = None) -> DataFrame:
    """[B11]"""
    return clean.prepare_features(df, features, target, [id_col] if id_col else [])


def save_final_dataset(df: DataFrame, output_dir: str) -> str:
    """[A3]"""
    return writers.save_final_dataset(df, output_dir)


# --- models ------------------------------------------------------------------------

prepare_features = clean.prepare_features  # [B10]
make_preprocessor = models.make_preprocessor  # [J3]
get_search_spaces = lambda random_state=42: models.SEARCH_SPACES  # noqa: E731  [K7]
tune_model = models.tune_model  # [K8/K9]
evaluate_predictions = metrics.evaluate_predictions  # [K11]
compute_roc_curve = metrics.roc_curve  # [K12]
compute_pr_curve = metrics.pr_curve  # [K13]
confusion_matrix = metrics.confusion_matrix  # [K14]
run_one_experiment = experiment.run_one_experiment  # [K18]


def get_cv(df: DataFrame, target: str, id_col: str, n_splits: int = 5, random_state: int = 42) -> DataFrame:
    """[I2] the fold column for stratified k-fold."""
    return sampling.stratified_folds(df, target, [id_col], n_splits, random_state)


def get_estimators(random_state: int = 42) -> dict:
    """[K7] ``{name: build}``: ``build(preprocessor, params, target, id_col, **options)`` is an unfitted pipeline of that model
    with the reference's defaults where ``params`` has none."""
    defaults = {"logistic_regression": {"max_iter": 1000}, "random_forest": {"n_estimators": 300}}

    def builder(name: str):
        def build(preprocessor, params=None, target=reference_flow.TARGET, id_col="row_id", **options):
            return pipelines.ModelPipeline(preprocessor, name, {**defaults.get(name, {}), **(params or {})}, target, id_col, seed=random_state, **options)

        return build

    return {name: builder(name) for name in experiment.MODELS}


def build_pipeline(preprocessor: models.Preprocessor, model_name: str, params: dict, target: str, id_col: str, use_smote: bool = False, class_weight: bool = False):
    """[K6] an unfitted preprocess -> (SMOTE on the training rows) -> model; ``fit``, ``predict``, ``save``."""
    return pipelines.ModelPipeline(preprocessor, model_name, params, target, id_col, use_smote, class_weight)


def predict_proba_positive(fitted, df: DataFrame, id_col: str = "row_id") -> DataFrame:
    """[K10] ``id, score`` (P(y=1), or the rescaled margin)."""
    return fitted.predict(df).select(getattr(fitted, "id_col", id_col), "score")


# --- statistics helpers of the notebooks -------------------------------------------


def cramers_v(chi2: float, n: int, k: int, r: int) -> float:
    """[D19] on given numbers (the Spark form is ``stats.chi_square_stats``)."""
    return (chi2 / (n * min(k - 1, r - 1))) ** 0.5


def cohens_d(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """[D19]"""
    return stats.cohens_d(df, columns, target)


def calculate_importance_score(p_value, effect_size):
    """[D20] column expression."""
    return X.importance_score(p_value, effect_size)


def classify_usefulness(p_value, effect_size):
    """[B28] column expression."""
    return X.usefulness_label(p_value, effect_size)


__all__ = [n for n in dir() if not n.startswith("_") and n not in {"annotations", "Sequence", "DataFrame", "SparkSession", "F"}]
