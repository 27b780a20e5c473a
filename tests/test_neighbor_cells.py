"""The k-NN join through cells against comparing all pairs."""

import math
import random

import numpy as np
import pytest

from riskline.operators import neighbors as N

KINDS = "w int, id long, a double, b double, c double"


def _all_pairs(queries, donors, k, exclude_self):
    out = {}
    for n, (w, i, *q) in enumerate(queries):
        found = []
        for dw, j, *d in donors:
            both = [f for f in range(3) if q[f] is not None and d[f] is not None]
            if w != dw or not both or (exclude_self and i == j):
                continue
            acc = 0.0
            for f in both:
                acc += (q[f] - d[f]) * (q[f] - d[f])
            found.append((math.sqrt(acc * 3 / len(both)), j))
        out.setdefault((w, i), []).extend(sorted(found)[:k])
    return {x: sorted(found)[:k] for x, found in out.items() if found}


def _rows(r, n, first):
    """Spread rows, many ties, copies, nulls and two groups."""
    rows = []
    for i in range(n):
        values = [r.gauss(0, 5) if i % 3 else float(r.randint(0, 3)), float(r.randint(0, 40)), r.expovariate(0.1)]
        if i % 7 == 0:
            values = [1.0, 2.0, 3.0]
        if i % 5 == 0:
            values[r.randint(0, 2)] = None
        if i % 41 == 0:
            values = [None, None, None]
        rows.append((i % 2 if i % 43 else None, first + i, *values))
    return rows


@pytest.mark.parametrize("exclude_self", [False, True])
def test_cells_find_what_all_pairs_find(spark, monkeypatch, exclude_self):
    monkeypatch.setattr(N, "CELLS_FROM", 0)
    monkeypatch.setattr(N.C, "LEAF", 8)
    monkeypatch.setattr(N.C, "STEP", 16)
    r = random.Random(5)
    donors = _rows(r, 500, 0)
    queries = donors + donors[:20] if exclude_self else _rows(r, 250, 9_007_199_254_740_993)
    donors = donors + donors[100:110]
    q, d = spark.createDataFrame(queries, KINDS), spark.createDataFrame(donors, KINDS)
    got = {}
    for x in N.knn_join(q, d, "id", "id", ["a", "b", "c"], 4, exclude_self, block_rows=40, payload=["c"], within=["w"]).collect():
        got.setdefault((x.w, x.qid), []).append((x["rank"], x.dist, x.did))
        assert x.c in {v for _, i, _, _, v in donors if i == x.did}
    got = {x: [v[1:] for v in sorted(found)] for x, found in got.items()}
    assert got == _all_pairs(queries, donors, 4, exclude_self)


def test_cells_are_met_only_where_a_bound_allows(spark, monkeypatch):
    monkeypatch.setattr(N, "CELLS_FROM", 0)
    seen = spark.sparkContext.accumulator(0)
    plain = N.C.topk

    def counted(qids, Q, *rest):
        seen.add(len(Q))
        return plain(qids, Q, *rest)

    monkeypatch.setattr(N.C, "topk", counted)
    r = random.Random(2)
    df = spark.createDataFrame([(i, r.random(), r.random()) for i in range(4000)], "id long, a double, b double")
    assert N.knn_join(df, df, "id", "id", ["a", "b"], 5, True, block_rows=100).where("dist > 0").count() == 20_000
    assert 4000 <= seen.value <= 3 * 4000  # of 40 cells


def test_matrix_products_leave_the_same_neighbours(spark, monkeypatch):
    monkeypatch.setattr(N, "DONOR_CHUNK", 64)
    r = np.random.default_rng(3)
    x = r.normal(size=(300, 12))
    x[50:90] = x[50]  # copies: ties by id
    x[90:95] = x[50] + 1e-9 * r.normal(size=(5, 12))  # nearer to each other than single precision tells
    ids = r.permutation(300)
    a, b, dist = N._local_topk(ids, x, ids, x, 5, True)
    got = {}
    for i, j, v in zip(a, b, dist):
        got.setdefault(i, []).append((v, ids[j]))
    for i in range(300):
        acc = np.zeros(300)
        for f in range(12):
            acc += (x[i, f] - x[:, f]) ** 2
        want = sorted((math.sqrt(v * 12 / 12), ids[j]) for j, v in enumerate(acc) if j != i)[:5]
        assert got[i] == want
