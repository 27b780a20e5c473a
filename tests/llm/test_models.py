"""LM scoring and the quality classifier against plain Python."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from riskline.llm import lm_scoring, quality_classifier
from tests.llm.samples import DOCS, empty, frame, prose, words


def tokens(text):
    return [*words(text), None]


def lm_rows():
    r = random.Random(11)
    vocabulary = prose(21, 60).split(" ")
    return DOCS + [(500 + i, " ".join(r.choices(vocabulary, k=r.randint(3, 120)))) for i in range(200)]


def brute_lm(rows, weights):
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in rows]
    one, two = Counter(), Counter()
    for (_, t), h in zip(rows, held, strict=True):
        if not h:
            w = tokens(t)
            one.update(w)
            two.update(zip(["<start>", *w], w))
    total, v, first = sum(one.values()), len(one), one[None]
    out = []
    for (d, t), h in zip(rows, held, strict=True):
        w = tokens(t)
        base = sum(math.log10((one[x] + 1) / (total + v + 1)) for x in w)
        score = 0.0
        for before, x in zip(["<start>", *w], w):
            c = first if before == "<start>" else one[before]
            a = weights[int(lm_scoring.frequency_bucket(np.array([c]))[0])]
            score += math.log10(a[0] / (v + 1) + a[1] * one[x] / total + (a[2] * two[before, x] / c if c else 0.0))
        out.append((d, h, len(w), sum(one[x] > 0 for x in w), total, base, score))
    return out


def test_scores_match_brute_force(spark, monkeypatch):
    rows, learned = lm_rows(), []
    original = lm_scoring.learn_weights
    monkeypatch.setattr(lm_scoring, "learn_weights", lambda cells, v: learned.append(original(cells, v)) or learned[-1])
    got = lm_scoring.score_documents(frame(spark, rows))
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    for g, w in zip(sorted(map(tuple, got.collect()), key=key), sorted(brute_lm(rows, learned[0]), key=key), strict=True):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9)
    assert lm_scoring.score_documents(empty(spark)).count() == 0
    held = [w for w in brute_lm(rows, learned[0]) if w[1]]
    assert sum(w[6] for w in held) > sum(w[5] for w in held)


def test_weights_are_learned_on_all_training_tokens(spark, monkeypatch):
    repeats = [(5000 + i, "x y z " * 40) for i in range(120)]  # another source at the end of the files
    rows, learned = lm_rows() + repeats, []
    original = lm_scoring.learn_weights
    monkeypatch.setattr(lm_scoring, "learn_weights", lambda cells, v: learned.append((cells, original(cells, v))) or learned[-1][1])
    monkeypatch.setattr(lm_scoring, "CHUNK_BYTES", 2000)
    for partitions in (1, 5):
        lm_scoring.score_documents(frame(spark, rows).coalesce(1).repartition(partitions) if partitions > 1 else frame(spark, rows).coalesce(1)).count()
    train = [tokens(t) for d, t in rows if zlib.crc32(("" if d is None else str(d)).encode()) % 7 != 2]
    one, two = Counter(x for w in train for x in w), Counter(p for w in train for p in zip(["<start>", *w], w))
    total, each = sum(one.values()), []
    for w in train:
        for before, x in zip(["<start>", *w], w):
            c = (one[None] if before == "<start>" else one[before]) - 1
            each.append((int(lm_scoring.frequency_bucket(np.array([c + 1]))[0]), 1, (one[x] - 1) / (total - 1), (two[before, x] - 1) / c if c > 0 else 0.0))
    want = original(pd.DataFrame(each, columns=["bucket", "n", "p1", "p2"]), len(one))
    for cells, weights in learned:
        assert cells.n.sum() == total
        assert np.abs(weights - want).max() < 0.01
    assert np.allclose(learned[0][1], learned[1][1], atol=1e-9)


def test_weights_maximise_the_deleted_likelihood():
    r = np.random.default_rng(5)
    n = 400
    cells = pd.DataFrame({"bucket": r.integers(1, 4, n), "x": 0, "y": 0, "n": r.integers(1, 50, n)})
    cells["p1"], cells["p2"] = cells["n"] * r.uniform(0, 0.01, n), cells["n"] * r.uniform(0, 0.3, n) * (r.random(n) < 0.5)
    weights = lm_scoring.learn_weights(cells, 1000, 400)
    assert np.allclose(weights.sum(axis=1), 1) and (weights >= 0).all() and weights[0, 2] == 0
    own = cells[cells.bucket == 2]
    p = np.stack([np.full(len(own), 1 / 1001), own.p1 / own.n, own.p2 / own.n], axis=1)
    value = lambda w: float((own.n * np.log(p @ w)).sum())
    best = value(weights[2])
    for _ in range(200):
        other = np.abs(weights[2] + r.normal(0, 0.05, 3)) + 1e-9
        assert value(other / other.sum()) < best + 0.02 * abs(best)


def test_a_changed_input_is_noticed(spark):
    docs = frame(spark).select("doc_id", "text")
    asked = lm_scoring.Asked(lm_scoring.Words(np.frombuffer(b"a b", np.uint8), np.array([0, 3])))
    assert len(asked.words) == 3 and docs.count()
    row = pd.Series({"data": b"a b", "offsets": np.array([0, 3]).tobytes(), "held": b"\x00"})
    with pytest.raises(RuntimeError):
        lm_scoring._counts(row, pd.DataFrame({"bucket": [0], "counts": [np.zeros(1, np.int64).tobytes()]}))


def quality_rows():
    rows, labels = [], []
    for i in range(600):
        good = i % 4 != 0
        text = prose(1000 + i, 40)
        if not good:
            text = [text.upper().replace(" ", "!! "), text.replace(" ", "### "), (text.split(" ")[0] + " ") * 40][i // 4 % 3]
        rows.append((i, text))
        labels.append((i, int(good), 0))
    return rows, labels


def test_classifier_held_out_accuracy(spark):
    rows, labels = quality_rows()
    table = spark.createDataFrame([*labels, (None, 1, 0), (3, None, 0), (9999, 1, 0)], "doc_id long, quality int, toxic int")
    docs = frame(spark, rows + DOCS[5:8])
    got = quality_classifier.score_quality(docs, table)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    out = got.toPandas()
    assert len(out) == len(rows) + 3 and out.score.between(0, 1).all()
    assert (out.held_out == [zlib.crc32(str(int(d)).encode() if d == d else b"") % 5 == 0 for d in out.doc_id]).all()
    assert ((out.score >= 0.3) == (out.predicted == 1)).all()
    truth = dict((d, q) for d, q, _ in labels)
    held = out[out.held_out & out.doc_id.isin(truth)]
    assert (held.predicted == held.doc_id.map(truth)).mean() > 0.97
    kept = quality_classifier.keep_good(docs, table)
    assert kept.columns == docs.columns and kept.count() == int((out.score >= 0.3).sum())


def test_classifier_without_two_classes(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    out = quality_classifier.score_quality(frame(spark), labels).toPandas()
    assert len(out) == len(DOCS) and (out.score > 0.99).all()
    none = quality_classifier.score_quality(frame(spark), labels.limit(0)).toPandas()
    assert (none.score == 0.5).all()
    assert quality_classifier.score_quality(empty(spark), labels).count() == 0


def test_dual_coordinate_descent_reaches_the_primal_optimum():
    r = np.random.default_rng(1)
    x = [np.unique(r.integers(0, 12, 5)).astype(np.int32) for _ in range(60)]
    y = np.array([int(f.min() % 2) for f in x])
    scale = np.ones(quality_classifier.DIMENSIONS)
    w, b = quality_classifier.dual_coordinate_descent(x, y, scale, passes=300, c=1.0)
    share = np.array([(y == 0).mean(), (y > 0).mean()])
    cost = np.where(y > 0, 0.5 / share[1], 0.5 / share[0])
    dense = np.zeros((60, 12))
    for i, f in enumerate(x):
        dense[i, f] = 1 / np.sqrt(len(f))
    sign = np.where(y > 0, 1.0, -1.0)
    value = lambda w, b: 0.5 * (w @ w + b * b) + (cost * np.maximum(0, 1 - sign * (dense @ w + b))).sum()
    best = value(w[:12], b)
    for _ in range(300):
        assert value(w[:12] + r.normal(0, 0.02, 12), b + r.normal(0, 0.02)) > best - 1e-3


def test_features_do_not_depend_on_the_chunk():
    texts = [t or "" for _, t in DOCS]
    alone = [quality_classifier.text_features(pa.array([t]))[0].tolist() for t in texts]
    assert [f.tolist() for f in quality_classifier.text_features(pa.array(texts))] == alone
