"""Known answers and brute-force cross-checks on hand-made micro tables."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskline.functions import exprs as X
from riskline.functions.pvalues import chi2_sf, norm_sf
from riskline.operators import missing, outliers, stats
from riskline.operators.ordering import prefix_sums, rank_sums
from riskline.operators.quantiles import exact_quantiles


def test_cut_code_band_edges(spark):
    ages = [-1.0, 0.0, 44.9, 45.0, 54.9, 55.0, 65.0, 119.9, 120.0, None]
    df = spark.createDataFrame([(a,) for a in ages], "age double")
    got = [r[0] for r in df.select(X.cut_code("age", X.AGE_EDGES)).collect()]
    assert got == [-1, 0, 0, 1, 1, 2, 3, 3, -1, -1]
    bmis = [18.4, 18.5, 24.99, 25.0, 30.0, 1e9]
    df = spark.createDataFrame([(b,) for b in bmis], "bmi double")
    assert [r[0] for r in df.select(X.cut_code("bmi", X.BMI_EDGES)).collect()] == [0, 1, 1, 2, 3, 3]


def test_labels_and_stars(spark):
    df = spark.createDataFrame([(0.0005, 0.05), (0.005, 0.15), (0.03, 0.35), (0.2, 0.6)], "p double, v double")
    r = df.select(X.significance_stars("p"), X.cramer_effect("v"), X.usefulness_label("p", "v"), X.useful_flag("p", "v")).collect()
    assert [tuple(x) for x in r] == [
        ("***", "negligible", "Insignificant", "No"),
        ("**", "small", "Small Significance", "Yes"),
        ("*", "moderate", "Moderate Significance", "Yes"),
        ("ns", "large", "Non-Significant", "No"),
    ]


@pytest.mark.parametrize("buckets,limit", [(2048, 4096), (2048, 0), (4, 7)])
def test_exact_quantiles_match_numpy(spark, buckets, limit):
    rng = random.Random(7)
    rows = []
    for i in range(400):
        g = i % 3
        v = None if i % 17 == 0 else float(rng.choice([rng.gauss(0, 1), 1.5, 1.5, round(rng.random() * 10, 1)]))
        rows.append((g, v))
    df = spark.createDataFrame(rows, "g int, v double")
    probs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    q, counts = exact_quantiles(df, ["v"], probs, by=["g"], buckets=buckets, few_rows=limit)
    for g in range(3):
        vals = np.array([v for gg, v in rows if gg == g and v is not None])
        assert counts[((g,), "v")] == len(vals)
        for p in probs:
            assert q[((g,), "v", p)] == pytest.approx(float(np.percentile(vals, p * 100)), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("few", [0, 5, 4096])
def test_exact_quantiles_of_extreme_values(spark, few):
    inf = float("inf")
    values = [-inf, -1.7e308, -1e308, -3.5, -5e-324, 0.0, 5e-324, 1.5e-323, 2e-323, 1e-300, 1.0, 1.0, 1.0000000000000002, 7e5, 1e308, 1.7e308, inf, inf]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    n = len(values) - 1
    q, counts = exact_quantiles(df, ["v"], [i / n for i in range(n + 1)], buckets=4, few_rows=few)
    assert counts[((), "v")] == len(values)
    for i, v in enumerate(sorted(values)):
        got = q[((), "v", i / n)]
        lo, hi = sorted(values)[max(0, i - 1)], sorted(values)[min(n, i + 1)]
        assert got == v or lo <= got <= hi or got != got  # i / n * n may miss i by one step


def test_median_and_mode_imputation_gate(spark):
    # a: 1/25 null (4% < 5%) -> median; b: 2/25 null (8%) -> untouched; c mode with tie -> smallest
    rows = []
    for i in range(25):
        a = None if i == 0 else float(i)
        b = None if i < 2 else float(i)
        c = None if i == 3 else [2, 2, 1, 1, 3][i % 5]
        rows.append((i, a, b, c))
    df = spark.createDataFrame(rows, "id int, a double, b double, c int")
    out = {r["id"]: r for r in missing.simple_imputation(df, ["a", "b"], ["c"]).collect()}
    assert out[0]["a"] == 12.5  # median of 1..24
    assert out[0]["b"] is None and out[1]["b"] is None
    c_vals = [x[3] for x in rows if x[3] is not None]
    counts = {v: c_vals.count(v) for v in set(c_vals)}
    best = min(counts, key=lambda v: (-counts[v], v))
    assert out[3]["c"] == best


def test_missing_summary_percent_over_all_rows(spark):
    df = spark.createDataFrame([(None,), (1.0,), (None,), (2.0,)], "x double")
    r = missing.missing_value_summary(df).collect()[0]
    assert (r["column"], r["missing_values"], r["percentage"]) == ("x", 2, 50.0)


def test_zscore_policies(spark):
    vals = [0.0] * 30 + [100.0] + [None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    omit = outliers.zscore_outlier_summary(df, ["x"]).collect()[0]
    prop = outliers.zscore_outlier_summary(df, ["x"], nan_policy="propagate").collect()[0]
    assert omit["count"] == 1 and prop["count"] == 0
    assert omit["percentage"] == pytest.approx(100 / 32)


def test_chi_square_yates_known_answer(spark):
    rows = [("a", 1)] * 10 + [("a", 0)] * 20 + [("b", 1)] * 20 + [("b", 0)] * 10
    df = spark.createDataFrame(rows, "cat string, y int")
    r = stats.chi_square_report(df, ["cat"], "y").collect()[0]
    assert r["chi2"] == pytest.approx(5.4)
    assert r["dof"] == 1
    assert r["p_value"] == pytest.approx(math.erfc(math.sqrt(5.4 / 2)))
    assert r["significance"] == "*"
    assert r["min_expected"] == pytest.approx(15.0)
    assert r["cramers_v"] == pytest.approx(math.sqrt(5.4 / 60))


def test_chi2_and_normal_tails():
    assert chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, rel=1e-9)
    assert chi2_sf(5.991464547107979, 2) == pytest.approx(0.05, rel=1e-9)
    assert chi2_sf(7.814727903251178, 3) == pytest.approx(0.05, rel=1e-9)
    assert chi2_sf(9.487729036781154, 4) == pytest.approx(0.05, rel=1e-9)
    assert norm_sf(1.959963984540054) == pytest.approx(0.025, rel=1e-9)


def test_mann_whitney_matches_pair_counting(spark):
    rng = random.Random(3)
    rows = [(i, float(rng.randint(0, 12)), i % 3 == 0) for i in range(150)]
    rows = [(i, v, int(y)) for i, v, y in rows]
    df = spark.createDataFrame(rows, "id int, x double, y int")
    r = stats.mann_whitney(df, ["x"], "y").collect()[0]
    g0 = [v for _, v, y in rows if y == 0]
    g1 = [v for _, v, y in rows if y == 1]
    u0 = sum((a > b) + 0.5 * (a == b) for a in g0 for b in g1)
    assert r["u_statistic"] == pytest.approx(u0)
    n0, n1 = len(g0), len(g1)
    allv = g0 + g1
    ties = sum(allv.count(v) ** 3 - allv.count(v) for v in set(allv))
    n = n0 + n1
    sigma = math.sqrt(n0 * n1 / 12 * ((n + 1) - ties / (n * (n - 1))))
    z = (max(u0, n0 * n1 - u0) - n0 * n1 / 2 - 0.5) / sigma
    assert r["z"] == pytest.approx(z)
    assert r["p_value"] == pytest.approx(min(1.0, 2 * norm_sf(z)))


def test_prefix_sums_and_rank_sums_many_ranges(spark):
    rng = random.Random(11)
    rows = [(k, float(v), rng.randint(1, 5)) for k in range(2) for v in rng.sample(range(1000), 120)]
    df = spark.createDataFrame(rows, "k int, v double, w int")
    got = {(r["k"], r["v"]): r["w_before"] for r in prefix_sums(df, ["k"], "v", ["w"], buckets=7).collect()}
    for k in range(2):
        acc = 0
        for _, v, w in sorted((r for r in rows if r[0] == k), key=lambda r: r[1]):
            assert got[(k, v)] == acc
            acc += w
    desc = {(r["k"], r["v"]): r["w_before"] for r in prefix_sums(df, ["k"], "v", ["w"], buckets=5, descending=True).collect()}
    for k in range(2):
        acc = 0
        for _, v, w in sorted((r for r in rows if r[0] == k), key=lambda r: -r[1]):
            assert desc[(k, v)] == acc
            acc += w


def test_vif_closed_form_and_dependency(spark):
    rng = random.Random(5)
    rows = [(rng.random(), rng.random(), rng.random()) for _ in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, c double").withColumn("d", F.col("a") + F.col("b"))
    v2 = {r["feature"]: r["vif"] for r in stats.vif(df, ["a", "b"]).collect()}
    g = np.array([[sum(x[0] * x[0] for x in rows), sum(x[0] * x[1] for x in rows)], [0, sum(x[1] * x[1] for x in rows)]])
    g[1, 0] = g[0, 1]
    expect = g[0, 0] * g[1, 1] / (g[0, 0] * g[1, 1] - g[0, 1] ** 2)
    assert v2["a"] == pytest.approx(expect) and v2["b"] == pytest.approx(expect)
    v4 = {r["feature"]: r["vif"] for r in stats.vif(df, ["a", "b", "c", "d"]).collect()}
    assert math.isinf(v4["a"]) and math.isinf(v4["b"]) and math.isinf(v4["d"])
    assert not math.isinf(v4["c"])


def test_correlation_pairwise_complete(spark):
    rows = [(1.0, 2.0), (2.0, None), (3.0, 6.5), (4.0, 8.0), (None, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    r = stats.correlation_pairs(df, ["a", "b"]).collect()[0]
    x = np.array([1.0, 3.0, 4.0])
    y = np.array([2.0, 6.5, 8.0])
    assert r["correlation"] == pytest.approx(float(np.corrcoef(x, y)[0, 1]))


def test_ranges_follow_the_order_and_null_keys_stay(spark):
    from riskline.operators import ordering

    rows = [(float(v),) for v in random.Random(4).sample(range(5000), 900)]
    df = spark.createDataFrame(rows, "v double")
    out = ordering.prefix_sums(df.withColumn("w", F.lit(1)), [], "v", ["w"], buckets=70, keep_range=True).collect()
    ranks = sorted((r["v"], r["w_before"]) for r in out)
    assert [b for _, b in ranks] == list(range(len(rows)))
    rng = sorted((r["v"], r["_rng"]) for r in out)
    assert all(a[1] <= b[1] for a, b in zip(rng, rng[1:]))
    assert len({r for _, r in rng}) > 35
    keyed = spark.createDataFrame([(None, 1.0, 1), (None, 2.0, 0), ("a", 3.0, 1), ("a", 1.0, 0)], "g string, v double, y int")
    sums = {r["g"]: (r["n_neg"], r["n_pos"], r["rank_sum_pos"]) for r in rank_sums(keyed, "v", "y", ["g"]).collect()}
    assert sums == {None: (1, 1, 1.0), "a": (1, 1, 2.0)}


def test_approx_quantiles_on_request(spark):
    from riskline.operators.quantiles import column_quantiles

    rows = [(float(i),) for i in range(1001)]
    df = spark.createDataFrame(rows, "x double")
    exact = column_quantiles(df, ["x"], [0.5, 0.9])["x"]
    approx = column_quantiles(df, ["x"], [0.5, 0.9], method="approx")["x"]
    assert exact == {0.5: 500.0, 0.9: 900.0}
    assert abs(approx[0.5] - 500.0) <= 1 and abs(approx[0.9] - 900.0) <= 1


def test_mode_of_string_column(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), ("c",)], "s string")
    assert missing.column_modes(df, ["s"]) == {"s": "a"}
    out = missing.simple_imputation(df, [], ["s"], threshold=0.5).collect()
    assert sorted(r["s"] for r in out) == ["a", "a", "a", "b", "b", "c"]


@pytest.mark.parametrize(
    "x,dof,p", [(1600, 1000, 1.742039824e-30), (2000, 1002, 8.303834067e-69), (1500, 1001, 1.283254812e-22), (1600, 100, 1.145859577e-268), (7.0, 0, 1.0)]
)
def test_chi_square_tail_at_large_freedom(x, dof, p):
    from riskline.functions.pvalues import chi2_sf

    assert chi2_sf(x, dof) == pytest.approx(p, rel=1e-9)
    if dof:
        assert chi2_sf(1201.0, 1199) == pytest.approx(chi2_sf(1200.9999999, 1199), rel=1e-6)


def test_quantiles_of_many_shapes_are_exact(spark, monkeypatch):
    """Brackets from sketches, counted and read: exact for heavy ties, infinities, NULL and NaN, missed brackets and ranges that
    hold too many rows, with and without groups."""
    import numpy as np

    from riskline.operators import quantiles as Q

    r = np.random.default_rng(11)
    n = 6000
    cols = {
        "a": r.standard_normal(n), "b": r.integers(0, 7, n).astype(float), "c": np.exp(30 * r.standard_normal(n)),
        "d": np.where(r.random(n) < 0.999, 5.0, r.standard_normal(n)), "e": np.where(r.random(n) < 0.01, np.inf, np.where(r.random(n) < 0.01, -np.inf, r.random(n))),
    }
    group = [None if i % 3 == 0 else i % 3 for i in range(n)]
    rows = [(group[i], *(None if i % 17 == j else float("nan") if i % 19 == j else float(v[i]) for j, v in enumerate(cols.values()))) for i in range(n)]
    df = spark.createDataFrame(rows, "g int, " + ", ".join(f"{c} double" for c in cols)).repartition(4)
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]

    def want(by):
        out = {}
        for g in {r[0] for r in rows} if by else [()]:
            for j, c in enumerate(cols):
                v = np.sort([r[1 + j] for r in rows if (not by or r[0] == g) and r[1 + j] is not None and r[1 + j] == r[1 + j]])
                for p in probs:
                    h = (len(v) - 1) * p
                    lo = v[int(h)]
                    out[((g,) if by else (), c, p)] = lo if h == int(h) else lo + (v[int(h) + 1] - lo) * (h - int(h))
        return out

    def same(found, wanted):
        assert found.keys() == wanted.keys()
        for k, v in wanted.items():
            assert found[k] == v or abs(found[k] - v) <= 1e-12 * abs(v) or (v != v and found[k] != found[k]), k

    for by in ([], ["g"]):
        same(Q.exact_quantiles(df, list(cols), probs, by)[0], want(by))
        same(Q.exact_quantiles(df, list(cols), probs, by, few_rows=3)[0], want(by))
    monkeypatch.setattr(Q, "RANK_ERROR", 1e-3 / 2)  # brackets that often miss
    monkeypatch.setattr(Q, "SKETCH_K", 20)
    same(Q.exact_quantiles(df, list(cols), probs)[0], want([]))


def test_correlation_matrix_of_500_columns(spark):
    """Pairwise-complete, whatever is missing, and one plan for any number of columns."""
    import numpy as np
    import pandas as pd

    from riskline.operators import stats

    r = np.random.default_rng(5)
    x = r.standard_normal((60, 500)) * 10.0 ** r.integers(-3, 6, 500) + 10.0 ** r.integers(0, 7, 500)
    x[r.random(x.shape) < 0.1] = np.nan
    x[:, 7], x[1:, 8], x[:, 9] = 3.3, np.nan, np.nan
    cols = [f"c{i}" for i in range(500)]
    df = spark.createDataFrame([tuple(None if v != v else float(v) for v in row) for row in x], ", ".join(f"{c} double" for c in cols))
    got = {(a["variable_1"], a["variable_2"]): a["correlation"] for a in stats.correlation_pairs(df, cols, full=True).collect()}
    want = pd.DataFrame(x, columns=cols).corr()
    assert len(got) == 250_000
    for i in [*range(0, 500, 23), 7, 8, 9]:
        for j in [*range(0, 500, 17), 7, 8, 9, i]:
            a, b = got[(cols[i], cols[j])], want.iloc[i, j]
            constant = {7, 8, 9} & {i, j}
            assert a is None if constant else abs(a - b) < 1e-8, (i, j, a, b)


def test_exact_u_tail_equals_enumeration():
    from itertools import combinations
    from math import comb

    from riskline.functions.pvalues import exact_u_tail

    for m, n in ((1, 1), (1, 6), (3, 5), (4, 4), (5, 8)):
        us = [sum(c) - m * (m + 1) // 2 for c in combinations(range(1, m + n + 1), m)]
        for u in range(m * n + 1):
            assert abs(exact_u_tail(m, n, u) - sum(x <= u for x in us) / comb(m + n, m)) < 1e-12
    # far into the tail, and near the normal form for large classes
    assert abs(exact_u_tail(8, 1000, 0) * comb(1008, 8) - 1) < 1e-9
    from math import erfc, sqrt

    u, mu, sigma = 1500, 8 * 500 / 2, sqrt(8 * 500 * 509 / 12)
    assert abs(exact_u_tail(500, 8, u) - 0.5 * erfc((mu - u - 0.5) / sigma / sqrt(2))) < 5e-3
