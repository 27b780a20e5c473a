"""What keeps forests and wide neighbour joins in proportion: the same results by less work."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from riskline.operators import models as MD
from riskline.operators import neighbors as N


def _frame(spark, n):
    rows = spark.range(n, numPartitions=2).select("id", (F.col("id") * 37 % 101).cast("double").alias("a"), (F.col("id") * 11 % 13).cast("double").alias("b"))
    return rows.withColumn("label", ((F.col("a") + F.col("b") * 3) > 70).cast("int"))


def test_a_forest_keeps_node_ids_and_its_trees(spark):
    inp = VectorAssembler(inputCols=["a", "b"], outputCol=MD.FEATURES).transform(_frame(spark, 600))
    est = MD.build_estimator("random_forest", {"n_estimators": 5, "max_depth": 6}, 600.0, None, "label")
    assert est.getCacheNodeIds()
    walked = est.copy({est.cacheNodeIds: False}).fit(inp)
    assert est.fit(inp).toDebugString.split("\n")[1:] == walked.toDebugString.split("\n")[1:]


def test_many_rows_of_a_forest_are_dealt_evenly(spark, monkeypatch):
    df = _frame(spark, 1000).where("id < 600")  # partitions of 500 and 100 rows
    assert MD.dealt(df, 600) is df
    monkeypatch.setattr(MD, "DEAL_FROM", 500)
    monkeypatch.setattr(MD, "DEAL_ROWS", 50)
    out = MD.dealt(df, 600)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) >= max(12, spark.sparkContext.defaultParallelism) and max(sizes) <= 2 * min(sizes)
    assert sorted(r["id"] for r in out.collect()) == list(range(600))


def test_wide_rows_squared_distances_by_one_product():
    r = np.random.default_rng(3)
    q, d = r.normal(size=(40, 12)), r.normal(size=(70, 12))
    a, b = N._sides(q, d)
    assert np.allclose(a @ b.T, ((q[:, None] - d[None]) ** 2).sum(axis=2), atol=1e-4)


def test_own_pairs_with_repeated_and_missing_ids():
    qids, ids = np.array([5, 1, 5, 9, 2]), np.array([1, 1, 2, 5, 7])
    i, j = N._own(qids, ids)
    assert sorted(zip(i.tolist(), j.tolist())) == [(0, 3), (1, 0), (1, 1), (2, 3), (4, 2)]
    i, j = N._own(np.array([1.0, np.nan]), np.array([1.0, np.nan]))
    assert list(zip(i.tolist(), j.tolist())) == [(0, 0)]


def test_wide_neighbours_with_repeated_ids_equal_brute_force(monkeypatch):
    monkeypatch.setattr(N, "QUERY_CHUNK", 16)
    monkeypatch.setattr(N, "DONOR_CHUNK", 32)
    r = np.random.default_rng(4)
    x = np.round(r.normal(size=(150, 10)), 1)
    x[::9] = x[0]  # copies
    ids = np.arange(150) % 120  # repeated ids
    a, b, dist = N._local_topk(ids, x, ids, x, 4, True)
    found = pd.DataFrame({"q": a, "id": ids[b], "d": dist})
    for q in range(150):
        all_ = sorted((float(np.sqrt(sum((u - v) * (u - v) for u, v in zip(x[q], x[j])))), int(ids[j])) for j in range(150) if ids[j] != ids[q])[:4]
        mine = sorted(zip(found[found.q == q].d, found[found.q == q].id))
        assert [i for _, i in mine] == [i for _, i in all_] and np.allclose([v for v, _ in mine], [v for v, _ in all_])


def test_fourier_features_are_projected_by_batches(spark):
    df = _frame(spark, 50).select("id", (F.col("a") / 50).alias("a"), (F.col("b") / 7).alias("b"))
    wide, names = MD.random_fourier_features(df, ["a", "b"], 0.5, n_components=6, seed=4)
    assert wide.columns == [*df.columns, *names]
    rng = np.random.default_rng(4)
    w, shift = rng.normal(0.0, 1.0, size=(6, 2)), rng.uniform(0.0, 2 * np.pi, size=6)
    rows = wide.toPandas()
    assert np.allclose(rows[names], np.sqrt(2 / 6) * np.cos(rows[["a", "b"]].to_numpy() @ w.T + shift), atol=1e-12)
    vectors = MD.fourier_vectors(df, ["a", "b"], 0.5, n_components=6, seed=4)
    assert [list(r[MD.FEATURES]) for r in vectors.collect()] == rows[names].to_numpy().tolist()
    plan = vectors._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "cos(" not in plan.lower()  # no expression per component and row
    for bad in (None, float("nan"), float("inf")):
        odd = spark.createDataFrame([(1, bad, 1.0)], "id long, a double, b double")
        with pytest.raises(Exception):  # noqa: B017  (as null features are elsewhere)
            MD.fourier_vectors(odd, ["a", "b"], 0.5).collect()


def test_rows_of_a_fourier_svm_are_scored_once(spark):
    df = _frame(spark, 300).select("id", (F.col("a") / 50).alias("a"), (F.col("b") / 7).alias("b"), "label")
    scored = MD.fit_model("svm", {"C": 1, "kernel": "rbf", "gamma": "scale"}, df, ["a", "b"], "label", "id").predict(df)
    assert "EvalPython" not in scored._jdf.queryExecution().executedPlan().toString()
    assert scored.count() == 300 and scored.where(F.col("prediction") == F.col("label")).count() > 240
