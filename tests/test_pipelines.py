"""Pipelines of a scaler, SMOTE and a model."""

import pytest

from riskline import api
from riskline.operators import models as MD
from riskline.operators import pipelines as PL

PARAMS = {
    "logistic_regression": {"C": 1.0, "max_iter": 50},
    "knn": {"n_neighbors": 3, "weights": "distance"},
    "decision_tree": {"max_depth": 4},
    "random_forest": {"n_estimators": 5, "max_depth": 4},
    "svm": {"C": 1.0, "kernel": "linear", "max_iter": 20},
}


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([(i, float(i % 7), float((i * 31) % 50), int((i * 7) % 10 > 7)) for i in range(120)], "row_id long, a double, b double, y int").checkpoint()


@pytest.mark.parametrize("model", list(PARAMS))
def test_saved_and_loaded_pipelines_score_alike(spark, df, model, tmp_path):
    scaler = {"knn": "standard", "svm": None}.get(model, "robust")
    pipe = api.build_pipeline(api.make_preprocessor(["a", "b"], scaler), model, PARAMS[model], "y", "row_id", use_smote=True)
    fitted = pipe.fit(df)
    fitted.save(spark, str(tmp_path / "p"))
    a = {r["row_id"]: (r["score"], r["prediction"]) for r in fitted.predict(df).collect()}
    b = {r["row_id"]: (r["score"], r["prediction"]) for r in PL.load_pipeline(spark, str(tmp_path / "p")).predict(df).collect()}
    assert a == b and set(a) == set(range(120))  # SMOTE adds no rows here


def test_builders_and_refusals(spark, df):
    builders = api.get_estimators(7)
    assert set(builders) == set(MD.SEARCH_SPACES)
    pipe = builders["random_forest"](api.make_preprocessor(["a"]), target="y", use_smote=True)
    assert pipe.params == {"n_estimators": 300} and pipe.seed == 7 and pipe.use_smote
    with pytest.raises(ValueError):
        api.build_pipeline(api.make_preprocessor(["a"]), "knn", {}, "y", "row_id", class_weight=True)
    with pytest.raises(ValueError):
        api.build_pipeline(api.make_preprocessor(["a"]), "boosting", {}, "y", "row_id")
    x, y = df.select("row_id", "a"), df.select("row_id", "y")
    train, test = api.create_unscaled_sets(x.where("a < 3"), x.where("a >= 3"), y, y, "row_id")
    assert train.columns == ["row_id", "a", "y"] and train.count() + test.count() == 120
    scaled, _, _ = api.standard_scale(x, x, ["a"])
    assert api.build_scaled_dataframe(scaled, ["a"], y, "y", "row_id").count() == 120
