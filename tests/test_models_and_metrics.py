"""Metrics known answers, split/fold/weight properties, neighbours vs brute force, models."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskline.operators import metrics as M
from riskline.operators import models as MD
from riskline.operators import neighbors as N
from riskline.operators import sampling as SP
from riskline.operators import scaling as SC
from riskline.operators.clean import recode, require_columns


def _scored(spark, tp, fp, fn, tn):
    rows = [(1, 1)] * tp + [(0, 1)] * fp + [(1, 0)] * fn + [(0, 0)] * tn
    return spark.createDataFrame(rows, "label int, prediction int")


def test_metrics_golden_run(spark):
    # 129 positives / 719 negatives, TP=77 FP=228 FN=52 TN=491
    r = M.evaluate_predictions(_scored(spark, 77, 228, 52, 491), "label", "prediction").first()
    assert round(r["accuracy"], 6) == 0.669811
    assert round(r["precision"], 6) == 0.252459
    assert round(r["recall"], 6) == 0.596899
    assert round(r["f1"], 6) == 0.354839
    assert r["roc_auc"] is None


def test_metrics_zero_division(spark):
    r = M.evaluate_predictions(_scored(spark, 0, 0, 129, 719), "label", "prediction").first()
    assert (r["precision"], r["recall"], r["f1"]) == (0.0, 0.0, 0.0)
    assert round(r["accuracy"], 6) == 0.847877


def test_auc_matches_pair_counting_and_is_rank_invariant(spark):
    rng = random.Random(1)
    rows = [(i, rng.randint(0, 1), float(rng.randint(0, 20))) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, label int, score double")
    auc = M.roc_auc(df, "label", "score").first()["roc_auc"]
    pos = [s for _, y, s in rows if y == 1]
    neg = [s for _, y, s in rows if y == 0]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert auc == pytest.approx(brute)
    auc2 = M.roc_auc(df.withColumn("score", F.exp(F.col("score") / 3)), "label", "score").first()["roc_auc"]
    assert auc2 == pytest.approx(auc)


def _roc_reference(y, s):
    order = sorted(set(s), reverse=True)
    tps, fps = [], []
    for t in order:
        tps.append(sum(1 for a, b in zip(y, s) if b >= t and a == 1))
        fps.append(sum(1 for a, b in zip(y, s) if b >= t and a == 0))
    keep = [0]
    for i in range(1, len(order) - 1):
        if (fps[i + 1] - 2 * fps[i] + fps[i - 1]) != 0 or (tps[i + 1] - 2 * tps[i] + tps[i - 1]) != 0:
            keep.append(i)
    keep.append(len(order) - 1)
    P, Nn = sum(y), len(y) - sum(y)
    return sorted({(order[i], fps[i] / Nn, tps[i] / P) for i in keep})


def test_roc_curve_corners(spark):
    rng = random.Random(2)
    y = [rng.randint(0, 1) for _ in range(200)]
    s = [float(rng.randint(0, 30)) for _ in range(200)]
    df = spark.createDataFrame(list(zip(y, s)), "label int, score double")
    got = sorted(
        (r["threshold"], r["fpr"], r["tpr"]) for r in M.roc_curve(df, "label", "score").collect() if not math.isinf(r["threshold"])
    )
    exp = _roc_reference(y, s)
    assert len(got) == len(exp)
    for a, b in zip(got, exp):
        assert a == pytest.approx(b)


def test_split_quotas_golden():
    # 4240 rows: 3595 negatives, 645 positives -> test 848 = 719 + 129
    q = SP.split_quotas({0: 3595, 1: 645}, 0.2)
    assert q == {0: 719, 1: 129}


def test_split_and_folds_properties(spark):
    rows = [(i, 1 if i % 7 == 0 else 0) for i in range(700)]
    df = spark.createDataFrame(rows, "id long, label int")
    s = SP.stratified_split(df, "label", ["id"], 0.2)
    counts = {(r["label"], r["split"]): r["count"] for r in s.groupBy("label", "split").count().collect()}
    quotas = SP.split_quotas({0: 600, 1: 100}, 0.2)
    assert counts[(0, "test")] == quotas[0] and counts[(1, "test")] == quotas[1]
    assert s.count() == 700 and s.select("id").distinct().count() == 700
    folds = SP.stratified_folds(df, "label", ["id"], 5)
    sizes = folds.groupBy("label", "fold").count().collect()
    for lab in (0, 1):
        v = [r["count"] for r in sizes if r["label"] == lab]
        assert len(v) == 5 and max(v) - min(v) <= 1


def test_rank_within_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(SP, "TARGET_RANGE_ROWS", 10)
    rows = [(i, i % 2) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, g int")
    out = SP.rank_within(df, ["g"], F.xxhash64("id"), ["id"]).select("id", "g", "_key", "_rank").collect()
    for g in (0, 1):
        sub = sorted((r["_key"], r["id"], r["_rank"]) for r in out if r["g"] == g)
        assert [x[2] for x in sub] == list(range(1, len(sub) + 1))


def test_class_weights_sum_to_n(spark):
    df = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(100)], "id int, label int")
    w = SP.with_class_weights(df, "label").agg(F.sum("weight")).first()[0]
    assert w == pytest.approx(100.0)


def test_standard_scaler_population_sigma(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "x double")
    m = SC.fit_standard_scaler(df, ["x"])
    assert m.scale["x"] == pytest.approx(np.std([1.0, 2.0, 4.0]))
    r = SC.fit_robust_scaler(df, ["x"])
    assert r.scale["x"] == pytest.approx(1.5) and r.center["x"] == 2.0
    const = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    out = SC.fit_standard_scaler(const, ["x"]).transform(const).collect()
    assert [x[0] for x in out] == [0.0, 0.0]


def _brute_knn(q, d, k, exclude_self=False):
    p = q.shape[1] - 1
    res = {}
    for row in q:
        cand = []
        for dr in d:
            if exclude_self and dr[0] == row[0]:
                continue
            both = ~np.isnan(row[1:]) & ~np.isnan(dr[1:])
            if both.sum() == 0:
                continue
            acc = 0.0
            for f in range(p):
                if both[f]:
                    acc += (row[1 + f] - dr[1 + f]) * (row[1 + f] - dr[1 + f])
            cand.append((math.sqrt(acc * p / both.sum()), int(dr[0])))
        res[int(row[0])] = sorted(cand)[:k]
    return res


def test_knn_join_matches_brute_force_across_blocks(spark):
    rng = np.random.default_rng(4)
    q = np.column_stack([np.arange(40), rng.normal(size=(40, 3))])
    d = np.column_stack([np.arange(100, 230), rng.integers(0, 4, size=(130, 3)).astype(float)])
    q[3, 2] = np.nan
    d[5, 1] = np.nan
    qdf = spark.createDataFrame([tuple(float(x) if i else int(x) for i, x in enumerate(r)) for r in q], "id long, a double, b double, c double")
    ddf = spark.createDataFrame([tuple(float(x) if i else int(x) for i, x in enumerate(r)) for r in d], "id long, a double, b double, c double")
    qdf = qdf.replace(float("nan"), None)
    ddf = ddf.replace(float("nan"), None)
    got = N.knn_join(qdf, ddf, "id", "id", ["a", "b", "c"], k=4, block_rows=17).collect()
    exp = _brute_knn(q, d, 4)
    by_q = {}
    for r in got:
        by_q.setdefault(r["qid"], []).append((r["rank"], r["dist"], r["did"]))
    for qid, lst in exp.items():
        mine = [(dist, did) for _, dist, did in sorted(by_q[qid])]
        assert [m[1] for m in mine] == [e[1] for e in lst]
        assert [m[0] for m in mine] == pytest.approx([e[0] for e in lst])


def test_smote_rows_lie_between_their_base_and_neighbour(spark):
    # integer features, string ids, one minority row without any value
    rows = [(f"r{i}", i % 7, (i * i) % 11, 1.5 * i, 1 if i % 5 == 0 else 0) for i in range(100)] + [("none", None, None, None, 1)]
    df = spark.createDataFrame(rows, "id string, a int, b int, c double, label int")
    out = N.smote(df, "id", ["a", "b", "c"], "label", k=3, seed=4, trace=True)
    counts = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    assert counts[0] == counts[1] == 80
    at = {r[0]: r[1:4] for r in rows}
    made = out.where("is_synthetic").collect()
    assert len(made) == 59
    for r in made:
        x, y = at[r.base_id], at[r.neighbour_id]
        assert r.base_id != r.neighbour_id and 0 <= r.gap < 1
        assert [r.a, r.b, r.c] == pytest.approx([p + r.gap * (q - p) for p, q in zip(x, y)])
        near = sorted((sum((p - q) ** 2 for p, q in zip(x, v)), i) for i, v in at.items() if i != r.base_id and i != "none" and dict((z[0], z[4]) for z in rows)[i] == 1)
        assert r.neighbour_id in [i for _, i in near[:3]]
    with pytest.raises(ValueError):
        N.smote(df.where("label = 0 or id = 'none'").unionByName(df.where("id = 'none'")), "id", ["a"], "label")


def test_neighbours_in_many_blocks_and_levels(spark, monkeypatch):
    import random

    monkeypatch.setattr(N, "MERGE_BLOCKS", 2)
    r = random.Random(1)
    pts = [(f"p{i:03d}", float(r.randint(0, 9)), float(r.randint(0, 9))) for i in range(90)]
    df = spark.createDataFrame(pts, "id string, x double, y double")
    got = N.knn_join(df, df, "id", "id", ["x", "y"], 4, exclude_self=True, block_rows=13, payload=["x"]).collect()
    want = {}
    for i, x, y in pts:
        near = sorted(((x - u) ** 2 + (y - v) ** 2, j) for j, u, v in pts if j != i)[:4]
        want.update({(i, n + 1): j for n, (_, j) in enumerate(near)})
    assert {(g.qid, g["rank"]): g.did for g in got} == want
    assert all(g.x == dict((i, x) for i, x, _ in pts)[g.did] for g in got)


def test_median_between_integers_widens_the_column(spark):
    from riskline.operators import missing

    df = spark.createDataFrame([(i, None if i == 24 else i + 1) for i in range(25)], "id int, a int")
    out = missing.simple_imputation(df, ["a"], [])
    assert dict(out.dtypes)["a"] == "double" and out.where("id = 24").first()["a"] == 12.5


def test_smote_parity_and_segments(spark):
    rng = random.Random(8)
    rows = [(i, rng.random(), rng.random(), 1 if i % 6 == 0 else 0) for i in range(240)]
    df = spark.createDataFrame(rows, "id long, a double, b double, label int")
    out = N.smote(df, "id", ["a", "b"], "label", k=5, seed=1)
    c = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    assert c[0] == c[1] == 200
    mins = [(a, b) for _, a, b, y in rows if y == 1]
    lo_a, hi_a = min(m[0] for m in mins), max(m[0] for m in mins)
    syn = out.where("is_synthetic").collect()
    assert len(syn) == 160
    assert all(lo_a - 1e-12 <= r["a"] <= hi_a + 1e-12 for r in syn)
    w = SP.with_class_weights(out.drop("is_synthetic"), "label")
    assert {r["weight"] for r in w.select("weight").distinct().collect()} == {1.0}


def test_knn_impute_fallback_mean(spark):
    rows = [(1, None, None), (2, 10.0, 1.0), (3, 20.0, 2.0), (4, None, 1.1)]
    df = spark.createDataFrame(rows, "id long, t double, x double")
    out = {r["id"]: r["t"] for r in N.knn_impute(df, "id", "t", ["x"], k=1).collect()}
    assert out[1] == 15.0  # no coordinate in common with any donor -> donor mean
    assert out[4] == 10.0


def test_rfe_and_importances(spark):
    rng = random.Random(9)
    rows = []
    for i in range(300):
        a, b, c = rng.random(), rng.random(), rng.random()
        rows.append((i, a, b, c, int(a + 0.2 * rng.random() > 0.6)))
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, label int")
    r = {x["feature"]: x["ranking"] for x in MD.rfe(df, ["a", "b", "c"], "label", 1).collect()}
    assert sorted(r.values()) == [1, 2, 3] and r["a"] == 1
    imp = MD.tree_importance(df, ["a", "b", "c"], "label", n_trees=20)
    assert sum(x["importance"] for x in imp.collect()) == pytest.approx(1.0)


def test_guards(spark):
    df = spark.createDataFrame([("M",), ("X",)], "sex string")
    with pytest.raises(ValueError):
        require_columns(df, ["sex", "age"])
    with pytest.raises(Exception):
        recode(df, {"sex": ({"M": 1, "F": 0}, None)}).collect()


def test_grid_helpers():
    g = MD.expand_grid(MD.SEARCH_SPACES["logistic_regression"]["params"])
    assert len(g) == 6
    s = MD.sample_grid(MD.SEARCH_SPACES["svm"]["params"], 4, seed=42)
    assert len(s) == 4 and len({MD.params_json(x) for x in s}) == 4
    from riskline.plans.experiment import run_plan

    assert len(run_plan()) == 54


def test_split_of_exact_copies_is_exact(spark):
    df = spark.range(100_000).selectExpr("7L as id", "1 as label", "'x' as s").repartition(4)
    df = df.unionByName(spark.range(50).selectExpr("id + 100 as id", "cast(id % 2 as int) as label", "'y' as s"))
    s = SP.stratified_split(df, "label", ["id"], 0.2, seed=3)
    counts = {(r["label"], r["split"]): r["count"] for r in s.groupBy("label", "split").count().collect()}
    assert counts[(1, "test")] + counts.get((0, "test"), 0) == 20_010 and sum(counts.values()) == 100_050
    folds = SP.stratified_folds(df, "label", ["id"], 5, seed=3)
    sizes = [r["count"] for r in folds.where("label = 1").groupBy("fold").count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    few = SP.stratified_folds(df.where("label = 0").limit(3), "label", ["id"], 5, seed=3)
    assert sorted(r["fold"] for r in few.collect()) == [0, 1, 3]


def test_split_with_hot_id_is_exact(spark):
    # 1/3 of the rows are copies of one id: the cut falls inside that group.
    rows = [(7, i, i % 2) for i in range(300)] + [(i, i, (i // 3) % 2) for i in range(1000, 1600)]
    df = spark.createDataFrame(rows, "id long, payload long, label int")
    s = SP.stratified_split(df, "label", ["id"], 0.5, seed=3)
    counts = {(r["label"], r["split"]): r["count"] for r in s.groupBy("label", "split").count().collect()}
    quotas = SP.split_quotas({0: 450, 1: 450}, 0.5)
    assert counts[(0, "test")] == quotas[0] and counts[(1, "test")] == quotas[1]
    folds = SP.stratified_folds(df, "label", ["id"], 4, seed=3)
    for lab in (0, 1):
        v = [r["count"] for r in folds.groupBy("label", "fold").count().collect() if r["label"] == lab]
        assert max(v) - min(v) <= 1
