"""The experiment matrix: the whole plan, its ledger, and results that follow from the emitted predictions."""

import uuid

import duckdb
import pytest
from pyspark.sql import functions as F

from riskline.operators import models as MD
from riskline.plans import experiment as X
from riskline.plans import model_queries
from tests.conftest import SF001

GRIDS = {
    "logistic_regression": [{"C": 1, "penalty": "l1"}, {"C": 1, "penalty": "l2"}],
    "knn": MD.expand_grid(MD.SEARCH_SPACES["knn"]["params"]),
    "decision_tree": MD.expand_grid(MD.SEARCH_SPACES["decision_tree"]["params"]),
    "random_forest": [{"n_estimators": n, "max_depth": d, "min_samples_leaf": 1, "min_samples_split": 2} for n in (10, 20) for d in (None, 3)],
    "svm": [{"C": 1, "gamma": "scale", "kernel": k} for k in ("linear", "rbf")],
}


def test_registered_matrix_is_the_whole_plan(spark, monkeypatch):
    asked = []

    def record(spark, frames, features, label, id_col, models=X.MODELS, methods=X.IMBALANCE_METHODS, grids=None, n_splits=5, **more):
        asked.append((X.run_plan(list(frames), models, methods), grids, n_splits))
        rows = [(v, m, i, "{}", 0.5, 0.5, 0.5, 0.5, 0.9 if m == "svm" else 0.5, 0.5) for v, m, i in asked[-1][0]]
        return spark.createDataFrame(rows, X.RESULT_SCHEMA), {X.run_key(*r[:3]): r[1] for r in rows}

    saved = []
    monkeypatch.setattr(model_queries, "_versions", lambda spark, sf_dir, versions: {v: (None, None) for v in versions})
    monkeypatch.setattr(X, "run_experiments", record)
    monkeypatch.setattr(X.MD, "save_model", lambda model, path: saved.append(model))
    assert model_queries.k18_experiment_matrix(spark, "").count() == 54
    assert model_queries.k19_best_model(spark, "").first()["model_name"] == "svm" and saved == ["svm"]
    assert asked == [(X.run_plan(), None, 5)] * 2 and len(X.run_plan()) == 54
    sizes = {m: len(MD.expand_grid(MD.SEARCH_SPACES[m]["params"])) for m in X.MODELS}
    assert sizes == {"logistic_regression": 6, "knn": 6, "decision_tree": 8, "random_forest": 16, "svm": 12}


@pytest.fixture(scope="module")
def frames(spark):
    df = X.cohort_model_input(spark, SF001).checkpoint()
    return X.split_versions(df, X.COHORT_FEATURES, "label", "id", ["unscaled", "standard_scaled"])


METHODS = ["class_weight", "smote"]


def test_matrix_resumes_and_follows_from_its_predictions(spark, frames, tmp_path, monkeypatch):
    def run(**more):
        return X.run_experiments(spark, frames, X.COHORT_FEATURES, "label", "id", methods=METHODS, grids=GRIDS, n_splits=3, folder=str(tmp_path), **more)

    # a plan that dies before the forests: what it finished is there, and is not made again
    made = X.run_model

    def dies(ledger, p, model_name, *rest):
        if model_name == "random_forest":
            raise RuntimeError("lost")
        return made(ledger, p, model_name, *rest)

    monkeypatch.setattr(X, "run_model", dies)
    with pytest.raises(RuntimeError, match="lost"):
        run(parallelism=1, models=["knn", "random_forest", "svm"])
    monkeypatch.setattr(X, "run_model", made)
    results, matrix = run()
    first = [n for n in matrix.ledger.made if not n.startswith("runs/")]
    assert not any("knn" in n or n in ("train", "targets") for n in first) and any("random_forest" in n for n in first)
    again, rerun = run()
    assert rerun.ledger.made == []
    rows = {X.run_key(*r[:3]): r for r in results.collect()}
    assert rows == {X.run_key(*r[:3]): r for r in again.collect()}
    assert sorted(rows) == sorted(X.run_key(*r) for r in X.run_plan(list(frames), methods=METHODS))

    # one prepared training set per version, resampling and fold (and the whole training split), shared by all models
    sets = matrix.p.train.select("v", "s", "task").distinct().count()
    assert sets == 2 * 2 * 4

    # the table follows from the predictions, by SQL
    con = duckdb.connect()
    folder = matrix.ledger.path
    test = con.execute(
        f"SELECT run_key, avg((prediction = y)::INT), coalesce(count_if(prediction = 1 AND y = 1) / nullif(count_if(prediction = 1), 0), 0), "
        f"coalesce(count_if(prediction = 1 AND y = 1) / nullif(count_if(y = 1), 0), 0) FROM read_parquet('{folder}/test/*/*.parquet') GROUP BY 1"
    ).fetchall()
    assert {t[0]: [round(x, 9) for x in t[1:]] for t in test} == {k: [round(r[c], 9) for c in ("test_accuracy", "test_precision", "test_recall")] for k, r in rows.items()}
    auc = "SELECT {by}, avg(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0 END) FROM {t} p JOIN {t} n USING ({by}) WHERE p.y = 1 AND n.y = 0 GROUP BY 1"
    got = dict(con.execute(auc.format(by="run_key", t=f"read_parquet('{folder}/test/*/*.parquet')")).fetchall())
    assert {k: round(v, 9) for k, v in got.items()} == {k: round(r["test_roc_auc"], 9) for k, r in rows.items()}

    # a saved model of every kind gives its run's scores again
    for model in ("knn", "random_forest", "svm"):
        key = X.run_key("standard_scaled", model, "smote")
        MD.save_model(matrix[key], f"{tmp_path}/saved-{model}")
        scores = MD.load_model(spark, f"{tmp_path}/saved-{model}").predict(frames["standard_scaled"][1])
        a = {r["id"]: (r["score"], r["prediction"]) for r in scores.collect()}
        b = {r["id"]: (r["score"], r["prediction"]) for r in matrix.test_predictions(key).collect()}
        assert a.keys() == b.keys() and all(abs(a[i][0] - b[i][0]) < 1e-9 and a[i][1] == b[i][1] for i in a)


def test_synthetic_rows_of_each_training_set(spark, frames):
    """SMOTE per fold: classes are level, and every point lies between two minority rows of its own training set."""
    from riskline.operators import model_batch as B

    train, _ = B.prepare_tables(frames, X.COHORT_FEATURES, "label", "id", True, 3)
    rows = train.collect()
    for g in {r["g"] for r in rows if r["s"] == 1}:
        own = [r for r in rows if r["g"] == g]
        assert sum(r["y"] == 1 for r in own) == sum(r["y"] == 0 for r in own)
        real = [r["x"] for r in own if r["id"] >= 0 and r["y"] == min((0, 1), key=lambda c: sum(q["y"] == c for q in own if q["id"] >= 0))]
        for r in [r for r in own if r["id"] < 0][:5]:
            assert any(_between(a, b, r["x"]) for a in real for b in real if a != b)


def _between(a, b, x):
    gap = [(v - p) / (q - p) for p, q, v in zip(a, b, x) if abs(q - p) > 1e-9 * max(abs(p), abs(q), 1)]
    return bool(gap) and max(gap) - min(gap) < 1e-6 and -1e-9 <= gap[0] <= 1 + 1e-9 and all(abs(v - p) < 1e-6 * max(abs(p), 1) for p, q, v in zip(a, b, x) if abs(q - p) <= 1e-9 * max(abs(p), abs(q), 1))


def test_orders_are_aggregated_once_for_the_model_input(spark, monkeypatch, tmp_path):
    real = X.FX.cohort

    def marked(spark, sf_dir):
        df = real(spark, sf_dir)

        def run(batches):
            (tmp_path / uuid.uuid4().hex).touch()
            yield from batches

        return df.coalesce(1).mapInArrow(run, df.schema)

    monkeypatch.setattr(X.FX, "cohort", marked)
    rows = X.cohort_model_input(spark, SF001)
    assert rows.count() == real(spark, SF001).count() and not rows.where("max_total is null").count()
    assert len(list(tmp_path.iterdir())) == 1
