import math
from fractions import Fraction

import numpy as np
import pytest

from riskline.llm import embedding_dedup as dedup
from riskline.llm import whitening
from tests.conftest import SF001

SCHEMA = "vec_id long, embedding array<float>, label int, cid long, a long, _id string, _vec string, n long, component int, copies int"


def frame(spark, rows):
    """Rows (id, vector) with extra columns whose names clash."""
    data = [(i, None if v is None else [None if x is None else float(x) for x in v], 0, 1, 2, "x", "y", 3, 4, 5) for i, v in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def unit(x):
    return x / np.linalg.norm(x, axis=-1, keepdims=True)


ODD = [(901, None), (902, []), (903, [0.0] * 16), (904, [math.nan] + [1.0] * 15), (905, [None] + [1.0] * 15), (906, [math.inf] + [1.0] * 15), (None, None)]


# near-duplicates


def brute_links(rows, least=0.9):
    """n_links and smallest id reachable of every row."""
    n = len(rows)
    sound = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    vectors = [np.asarray(v, np.float32).astype(float) if s else None for (_, v), s in zip(rows, sound, strict=True)]
    linked = np.zeros((n, n), bool)
    for size in {len(v) for v in vectors if v is not None}:
        at = [i for i in range(n) if sound[i] and len(vectors[i]) == size]
        x = unit(np.stack([vectors[i] for i in at]))
        linked[np.ix_(at, at)] = x @ x.T >= least
    np.fill_diagonal(linked, False)
    out, seen = [None] * n, set()
    for i in range(n):
        if i in seen:
            continue
        group, todo = {i}, [i]
        while todo:
            for j in np.flatnonzero(linked[todo.pop()]):
                if j not in group:
                    group.add(j)
                    todo.append(j)
        seen |= group
        low = min((rows[j][0] for j in group if rows[j][0] is not None), default=None)
        for j in group:
            out[j] = (rows[j][0], int(linked[j].sum()), low, rows[j][0] is not None and rows[j][0] == low)
    return out


def found(df):
    return [tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()]


ordered = lambda rows: sorted(rows, key=repr)


def pairs_at(rng, count, dim, low, high):
    """Vectors and a partner each at a cosine between low and high."""
    base = unit(rng.standard_normal((count, dim)))
    other = rng.standard_normal((count, dim))
    other = unit(other - (other * base).sum(axis=1, keepdims=True) * base)
    c = rng.uniform(low, high, (count, 1))
    return np.concatenate([base, c * base + np.sqrt(1 - c * c) * other])


def mixed(dim, seed):
    rng = np.random.default_rng(seed)
    dense = unit(rng.standard_normal(dim)) + rng.standard_normal((150, dim)) * 0.2 / math.sqrt(dim)
    x = np.concatenate([pairs_at(rng, 300, dim, 0.85, 0.96), dense, dense[:40], 7.5 * dense[40:60], rng.standard_normal((1, dim)).repeat(30, 0)])
    rows = [(int(i), v.tolist()) for i, v in enumerate(x.astype(np.float32))]
    return [*rows, (3, rows[3][1]), (3, rows[4][1]), (None, rows[5][1]), (None, (-x[7]).tolist()), (907, [1e-30] * dim), (908, [3e38] * dim), *ODD]


@pytest.mark.parametrize(("dim", "seed"), [(64, 1), (24, 2), (16, 5), (3, 3), (2, 4)])
def test_links_equal_brute_force(spark, dim, seed):
    rows = mixed(dim, seed)
    got = found(dedup.near_duplicates(frame(spark, rows), cell=16, cover=1 - 1e-9))
    assert ordered(got) == ordered(brute_links(rows))


def test_blocks_of_hot_cells(spark, monkeypatch):
    """A cell cut into many blocks gives the same rows."""
    monkeypatch.setattr(dedup, "QUERY_BLOCK", 20)
    monkeypatch.setattr(dedup, "CODE_BLOCK", 50)
    rows = mixed(24, 6)
    got = found(dedup.near_duplicates(frame(spark, rows), cell=64, cover=1 - 1e-9))
    assert ordered(got) == ordered(brute_links(rows))


def test_recall_at_the_threshold(spark):
    """With production's cover, links right at the threshold: measured recall, and none below it."""
    x = pairs_at(np.random.default_rng(8), 4000, 64, 0.9, 0.91).astype(np.float32)
    got = {r[0]: r[1] for r in found(dedup.near_duplicates(frame(spark, [(i, v.tolist()) for i, v in enumerate(x)]), cell=16))}
    u = unit(x.astype(float))
    want = (u @ u.T >= 0.9).sum(axis=1) - 1
    k = np.array([got[i] for i in range(len(x))])
    assert (k <= want).all() and k.sum() >= 0.99 * want.sum()


def test_estimates_are_unbiased_and_bounds_hold():
    rng = np.random.default_rng(9)
    x = pairs_at(rng, 3000, 64, 0.9, 0.9)
    q, d = x[:3000] @ dedup.rotation(64), x[3000:] @ dedup.rotation(64)
    factor = np.abs(d).sum(axis=1) / 8
    estimate = (q * np.sign(d)).sum(axis=1) / 8 / factor
    assert abs(estimate.mean() - 0.9) < 4 * estimate.std() / math.sqrt(3000)
    assert (estimate >= 0.9 - dedup.margin(factor, 64, 0.9)).all()


def test_no_vectors_no_rows(spark):
    assert found(dedup.near_duplicates(frame(spark, []))) == []
    assert ordered(found(dedup.near_duplicates(frame(spark, ODD)))) == ordered(brute_links(ODD))


# whitening


def check_whitening(out, rows, dim, most=32):
    """Against doubles, up to signs; exact columns against Python integers."""
    kept = [(i, v) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in kept]
    n = len(x)
    s = [sum(c) for c in zip(*x, strict=True)]
    deviation = [sum((n * c - t) ** 2 for c, t in zip(v, s, strict=True)) for v in x]
    y = np.array([[float(Fraction(n * c - t, n)) for c, t in zip(v, s, strict=True)] for v in x])
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1], u[:, ::-1]
    k = min(most, int((e > 1e-9 * e[0]).sum()))
    got = sorted(((r["vec_id"], r["deviation"], r["component"], r["whitened"]) for r in out), key=lambda r: (r[1], repr(r[0]), r[2]))
    assert len(got) == n * k and {r["n"] for r in out} == {n}
    assert sorted((r[0], r[1]) for r in got if r[2] == 1 and r[0] is not None) == sorted((i, d) for (i, _), d in zip(kept, deviation, strict=True) if i is not None)
    explained = dict((r["component"], r["explained"]) for r in out)
    assert np.allclose([explained[c + 1] for c in range(k)], e[:k] / e.sum(), rtol=1e-9)
    assert {r["identity_error"] for r in out} == {out[0]["identity_error"]} and out[0]["identity_error"] < 1e-9
    return kept, y, e, u, k


def test_whitened_rows_equal_doubles(spark):
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((200, 16)) * np.linspace(0.2, 1, 16))]
    rows += [(5, rows[5][1]), (None, rows[6][1]), (910, [1.0] * 3), (903, [0.0] * 16), *(r for r in ODD if r[0] != 903)]
    out = whitening.whiten(frame(spark, rows)).collect()
    kept, y, e, u, k = check_whitening(out, rows, 16)
    z = {}
    for r in out:
        z.setdefault(r["vec_id"], {}).setdefault(r["component"], set()).add(r["whitened"])
    want = y @ u[:, :k] / np.sqrt(e[:k])
    ids = [i for i, _ in kept]
    got = np.array([[min(z[i][c + 1]) for c in range(k)] for i in ids])
    once = [j for j, i in enumerate(ids) if ids.count(i) == 1]
    sign = np.sign((got * want)[once].sum(axis=0))
    assert np.abs(got * sign - want)[once].max() < 1e-9


def test_equal_eigenvalues_constants_and_large_entries(spark):
    """Repeated roots get an orthonormal basis; constant dimensions and rows fewer than dimensions leave components out."""
    cross = [(2 * i + s, [float((1 - 2 * s) * (j == i)) for j in range(6)] + [0.5]) for i in range(6) for s in (0, 1)]
    check_whitening(whitening.whiten(frame(spark, cross)).collect(), cross, 7)
    few = [(i, v.tolist()) for i, v in enumerate(np.random.default_rng(4).standard_normal((5, 12)))]
    check_whitening(whitening.whiten(frame(spark, few)).collect(), few, 12)
    big = [(i, [2.0**40 * (i + 1), -(2.0**41) * (i % 3), float(i)]) for i in range(9)]
    out = whitening.whiten(frame(spark, big)).collect()
    # the first and the last dimension depend on each other
    assert len(out) == 18 and out[0]["identity_error"] < 1e-4
    x = [[math.floor(64 * c) for c in v] for _, v in big]
    exact = [sum((9 * c - sum(col)) ** 2 for c, col in zip(v, zip(*x, strict=True), strict=True)) for v in x]
    got = {r["vec_id"]: r["deviation"] for r in out}
    assert got == {i: d if d < 1 << 63 else None for i, d in enumerate(exact)} and None in got.values() and got[4] is not None


def test_most_components_and_empty_tables(spark):
    df = spark.read.parquet(f"{SF001}/embeddings.parquet")
    out = whitening.whiten(df, most=3).collect()
    assert len(out) == 3 * df.count()
    for rows in ([], ODD[:2], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        out = whitening.whiten(frame(spark, rows))
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and out.collect() == []


def test_characteristic_polynomial_roots_and_null_space(spark):
    m = np.diag([9, 7, 7, 4, 0]).tolist()
    for a, b in ((0, 1), (2, 3)):  # a unimodular congruence would change roots; a permutation does not
        m[a], m[b] = m[b], m[a]
        for row in m:
            row[a], row[b] = row[b], row[a]
    poly = whitening.characteristic_polynomial(spark, m)
    want = np.poly([9, 7, 7, 4, 0])[::-1]
    assert poly == [round(x) for x in want]
    found = [whitening.kth_root(poly[1:], k) for k in range(1, 5)]
    value = [Fraction(2 * lo + 1, 2) / Fraction(2) ** bits for lo, bits, *_ in found]
    assert [round(float(v), 12) for v in value] == [9, 7, 7, 4] and all(abs(v - w) < Fraction(1, 10**50) for v, w in zip(value, (9, 7, 7, 4), strict=True))
    assert [above - past for *_, above, past in found] == [1, 2, 2, 1] and found[1][:2] == found[2][:2]
    basis = whitening.null_vectors(m, value[1], 2)
    assert np.abs(basis @ basis.T - np.eye(2)).max() < 1e-15 and np.abs(np.array(m) @ basis.T - 7 * basis.T).max() < 1e-14
