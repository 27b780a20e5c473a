"""Mergeable profile states and binned densities against plain figures."""

import math

import pytest

from riskline.operators import describe, profile_state

COLUMNS = ["x", "k", "t", "none"]
SCHEMA = "part string, x double, k int, t string, none double"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(n, start=0):
    return [("abc"[i % 3], None if i % 7 == 0 else 1e9 + math.sin(i) * 10, i % 4, f"v{i % 500}", None) for i in range(start, start + n)]


def plain(rows, at):
    v = [r[at] for r in rows if r[at] is not None]
    mean = math.fsum(v) / len(v) if v else None
    std = math.sqrt(math.fsum((a - mean) ** 2 for a in v) / (len(v) - 1)) if len(v) > 1 else None
    return len(v), len(rows) - len(v), mean, std, min(v, default=None), max(v, default=None)


def test_parts_merge_into_the_whole(spark):
    rows = rows_of(4000)
    df = frame(spark, rows).repartition(5)
    merged = profile_state.merge_states(profile_state.profile_state(df, COLUMNS, by=["part"]))
    assert merged.columns == profile_state.profile_state(df, COLUMNS).columns
    got = {r.variable: r for r in profile_state.summary(merged).collect()}
    assert set(got) == set(COLUMNS)
    for at, c in ((1, "x"), (2, "k")):
        n, missing, mean, std, low, high = plain(rows, at)
        r = got[c]
        assert (r["count"], r.missing, r.min, r.max) == (n, missing, low, high)
        assert r.mean == pytest.approx(mean, rel=1e-14) and r.std == pytest.approx(std, rel=1e-9)
    ranked = sorted(r[1] for r in rows if r[1] is not None)
    for p, q in ((0.25, got["x"].approx_q25), (0.5, got["x"].approx_median), (0.75, got["x"].approx_q75)):
        assert abs(sum(v <= q for v in ranked) / len(ranked) - p) < 0.02
    assert got["k"].approx_distinct == 4
    assert abs(got["t"].approx_distinct - 500) <= 4 * 1.04 / 64 * 500 and got["t"].mean is None and got["t"].approx_median is None
    assert (got["none"]["count"], got["none"].mean, got["none"].std, got["none"].approx_distinct) == (0, None, None, 0)
    kinds = {r.variable: r.kind for r in profile_state.approximate_types(merged).collect()}
    assert kinds == {"x": "numerical", "k": "categorical", "none": "categorical"}


def test_sources_are_added_once(spark, tmp_path):
    path = str(tmp_path / "profile")
    a, b = rows_of(900), rows_of(700, 5000)
    profile_state.add_to_profile(frame(spark, a), COLUMNS, path, "a")
    profile_state.add_to_profile(frame(spark, b), COLUMNS, path, "b")
    profile_state.add_to_profile(frame(spark, a), COLUMNS, path, "a")
    profile_state.add_to_profile(frame(spark, a).limit(0), COLUMNS, path, "empty")
    got = {r.variable: r for r in profile_state.summary(profile_state.read_profile(spark, path)).collect()}
    n, missing, mean, std, low, high = plain(a + b, 1)
    assert (got["x"]["count"], got["x"].missing, got["x"].min, got["x"].max) == (n, missing, low, high)
    assert got["x"].mean == pytest.approx(mean, rel=1e-14) and got["x"].std == pytest.approx(std, rel=1e-9)


def test_binned_density_is_within_its_bound(spark):
    rows = [("g", math.sin(i) * 3 + i % 5, 0, "", None) for i in range(600)] + [("h", float(i * i), 0, "", None) for i in range(50)]
    df = frame(spark, [*rows, ("one", 4.0, 0, "", None), ("same", 2.0, 0, "", None), ("same", 2.0, 0, "", None), ("g", None, 0, "", None)])
    exact = {(r.part, r.point): r for r in describe.kde_density(df, "x", "part", 20).collect()}
    for tolerance in (1e-4, 1e-6):
        got = describe.kde_density_binned(df, "x", "part", 20, tolerance).collect()
        assert {(r.part, r.point) for r in got} == set(exact)
        for r in got:
            want = exact[r.part, r.point]
            assert r.x == want.x
            if want.density is None:
                assert r.density is None
            else:
                assert abs(r.density - want.density) <= r.error_bound + 1e-15
