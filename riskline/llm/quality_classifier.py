"""Quality classifier: naive Bayes support vectors (operator 8).

A text's features are the indicators of its n-grams: byte trigrams, and one- to three-grams of word
shapes (letter case, digits and the other signs of a word, and whether it repeats the word before),
hashed into ``DIMENSIONS`` places. A feature's indicator is scaled by its class log-count ratio, and a
linear model with hinge loss is fitted by dual coordinate descent. Margins become probabilities by a
logistic curve, fitted on a fifth of the labelled sample that the weights have not seen.

The fit uses ``SAMPLE_ROWS`` labelled rows at most (those whose ids have the smallest hashes), in one task of bounded
size. Scoring reads every text whole, in its partition, with a weight vector of bounded size.

Null texts are empty; an empty text has no n-gram and gets the score of the bias. An id with
several labels counts as its largest; null labels are skipped. Without two classes among the
labels every score is the share of label 1 (0.5 without any). Repeated rows and ids give a row each.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskline.llm.textblocks import SPACE, Words, chunks, mix, text_buffers

BITS = 18
DIMENSIONS = 1 << BITS
SAMPLE_ROWS = 12_000
#: Dual coordinate descent: penalty of the loss, passes over the sample, smoothing of the counts.
C, PASSES, ALPHA = 0.1, 12, 1.0
THRESHOLD = 0.3

_U = np.uint64
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[65:91] = ord("A")
_SHAPE[97:123] = ord("a")
_SHAPE[48:58] = ord("0")
_SHAPE[128:] = ord("a")


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of a chunk: distinct, sorted by text."""
    n = len(offsets) - 1
    text = np.repeat(np.arange(n), np.diff(offsets))
    white = SPACE[data]
    byte = np.where(white, np.uint8(32), data).astype(np.uint64)
    found = []
    if len(data) > 2:
        same = text[2:] == text[:-2]
        h = mix(byte[:-2] << _U(16) | byte[1:-1] << _U(8) | byte[2:])[same]
        found.append((text[:-2][same], h))
    w = Words(data, offsets, lower=False)
    if len(w.hash):
        # a word's shape: its signs without repeats in a row
        sign = _SHAPE[data]
        keep = ~white
        keep[1:] &= (sign[1:] != sign[:-1]) | white[:-1]
        first = np.zeros(len(data), bool)
        first[w.start] = True
        keep |= first
        of_word = np.cumsum(first) - 1
        at = np.flatnonzero(keep)
        place = np.arange(len(at)) - np.searchsorted(at, w.start)[of_word[at]]
        part = mix(sign[at].astype(np.uint64) + (np.minimum(place, 12).astype(np.uint64) << _U(8)) + _U(1 << 40))
        total = np.append(_U(0), np.cumsum(part, dtype=np.uint64))
        bounds = np.append(np.searchsorted(at, w.start), len(at))
        shape = mix(total[bounds[1:]] - total[bounds[:-1]])
        again = np.zeros(len(shape), bool)
        again[1:] = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
        shape = np.where(again, mix(shape + _U(77)), shape)
        found.append((w.doc, shape))
        for k in (2, 3):
            if len(shape) >= k:
                inside = w.doc[: len(shape) - k + 1] == w.doc[k - 1 :]
                g = shape[: len(shape) - k + 1].copy()
                for j in range(1, k):
                    g = g * _U(0xD6E8FEB86659FD93) + shape[j : len(shape) - k + 1 + j]
                found.append((w.doc[: len(inside)][inside], mix(g)[inside]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = np.concatenate([(d << BITS) | (h >> _U(64 - BITS)).astype(np.int64) for d, h in found])
    # distinct codes: a flag per text and feature, as long as the grid is small, else by sorting
    code = np.unique(code)
    return code >> BITS, code & (DIMENSIONS - 1)


def text_features(column: pa.Array) -> list[np.ndarray]:
    out = []
    data, offsets = text_buffers(column)
    for a, b in chunks(offsets):
        d, f = features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        out += np.split(f.astype(np.int32), np.searchsorted(d, np.arange(1, b - a)))
    return out


def log_count_ratio(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """log of the smoothed, normalised feature counts of label 1 against label 0."""
    counts = [np.full(DIMENSIONS, ALPHA), np.full(DIMENSIONS, ALPHA)]
    for f, label in zip(rows, y, strict=True):
        counts[int(label)][f] += 1
    p, q = counts[1] / counts[1].sum(), counts[0] / counts[0].sum()
    return np.log(p / q)


def dual_coordinate_descent(rows: list[np.ndarray], y: np.ndarray, scale: np.ndarray, passes: int = PASSES, c: float = C) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear hinge-loss model on scaled, length-normalised indicators. The bias is a feature of value 1;
    the rarer class weighs as much as the other."""
    norm = [np.sqrt(max(1e-12, float(np.square(scale[f]).sum()))) if len(f) else 1.0 for f in rows]
    weight, bias = np.zeros(DIMENSIONS), 0.0
    sign = np.where(y > 0, 1.0, -1.0)
    share = np.array([(y == 0).mean(), (y > 0).mean()])
    upper = c * np.where(y > 0, 0.5 / share[1], 0.5 / share[0])
    alpha = np.zeros(len(rows))
    rng = np.random.default_rng(7)
    for _ in range(passes):
        for i in rng.permutation(len(rows)):
            f = rows[i]
            x = scale[f] / norm[i]
            gradient = sign[i] * (float(weight[f] @ x) + bias) - 1.0
            new = min(max(alpha[i] - gradient / 2.0, 0.0), upper[i])  # a row's squared length is 2 with the bias
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                weight[f] += step * x
                bias += step
                alpha[i] = new
    return weight, bias


def margins(rows: list[np.ndarray], scale: np.ndarray, weight: np.ndarray, bias: float) -> np.ndarray:
    out = np.full(len(rows), bias)
    for i, f in enumerate(rows):
        if len(f):
            out[i] += float(weight[f] @ scale[f]) / np.sqrt(max(1e-12, float(np.square(scale[f]).sum())))
    return out


def logistic_curve(m: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, offset) of the probability of label 1 by margin: Newton steps on the smoothed likelihood."""
    ones, zeros = float((y > 0).sum()), float((y == 0).sum())
    target = np.where(y > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * m + b, -35, 35)))
        g = np.array([((p - target) * m).sum() + 1e-3 * a, (p - target).sum()])
        s = p * (1 - p)
        h = np.array([[(s * m * m).sum() + 1e-3, (s * m).sum()], [(s * m).sum(), s.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 5.0 / max(1e-9, float(np.abs(step).max())))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(max(a, 0.0)), float(b)


def fit(texts: pa.Array, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """(scaled weights, squared scales, bias, slope and offset) from labelled texts in a fixed order."""
    ones = int((y > 0).sum())
    if not 0 < ones < len(y):
        share = 0.5 if not len(y) else min(max(ones / len(y), 1e-6), 1 - 1e-6)
        return np.zeros(DIMENSIONS), np.zeros(DIMENSIONS), 0.0, (0.0, float(np.log(share / (1 - share))))
    rows = text_features(texts)
    held = np.arange(len(y)) % 5 == 4
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held = np.zeros(len(y), bool)
    train = [r for r, h in zip(rows, held, strict=True) if not h]
    scale = log_count_ratio(train, y[~held])
    weight, bias = dual_coordinate_descent(train, y[~held], scale)
    rest = [r for r, h in zip(rows, held, strict=True) if h] or train
    slope, offset = logistic_curve(margins(rest, scale, weight, bias), y[held] if held.any() else y)
    return weight * scale, np.square(scale), bias, (slope, offset)


def labelled(docs: DataFrame, labels: DataFrame, fold: int, rows: int) -> DataFrame:
    """(order, text, label) of at most ``rows`` labelled ids outside the held-out fold."""
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("label"))
    known = known.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % fold != 0)
    chosen = known.withColumn("order", F.xxhash64(F.col("doc_id").cast("string"))).orderBy("order", "doc_id").limit(rows)
    chosen = F.broadcast(chosen.withColumnRenamed("doc_id", "_id"))  # at most ``rows`` rows
    one = docs.join(chosen, "_id").groupBy("_id", "order", "label").agg(F.min("_text").alias("_text"))
    return one.select("_id", "order", "label", "_text")


def train(sample: DataFrame):
    """Fits on the bounded sample in one task and returns (weights, squared scales, bias, slope, offset)."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["order", "_text"], kind="stable")
        text = pa.array(rows["_text"].fillna(""), pa.large_string())
        weight, squares, bias, (slope, offset) = fit(text, rows["label"].to_numpy())
        return pd.DataFrame({"weight": [weight.tobytes()], "squares": [squares.tobytes()], "bias": [bias], "slope": [slope], "offset": [offset]})

    schema = "weight binary, squares binary, bias double, slope double, offset double"
    got = sample.groupBy(F.lit(0).alias("all")).applyInPandas(run, schema).first()
    if got is None:
        return np.zeros(DIMENSIONS), np.zeros(DIMENSIONS), 0.0, 0.0, 0.0
    return np.frombuffer(got["weight"]), np.frombuffer(got["squares"]), got["bias"], got["slope"], got["offset"]


def probabilities(column: pa.Array, model) -> np.ndarray:
    weight, squares, bias, slope, offset = model
    data, offsets = text_buffers(column)
    out = np.zeros(len(offsets) - 1)
    for a, b in chunks(offsets):
        d, f = features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        dot = np.bincount(d, weights=weight[f], minlength=b - a)
        length = np.sqrt(np.maximum(1e-12, np.bincount(d, weights=squares[f], minlength=b - a)))
        out[a:b] = np.where(np.bincount(d, minlength=b - a) > 0, dot / length, 0.0) + bias
    return 1 / (1 + np.exp(-np.clip(slope * out + offset, -35, 35)))


def _model(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, fold: int, sample_rows: int):
    """The fitted model, broadcast (two vectors of ``DIMENSIONS``)."""
    docs = df.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    return docs, df.sparkSession.sparkContext.broadcast(train(labelled(docs, labels, fold, sample_rows)))


def score_quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", fold: int = 5, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per input row."""
    docs, model = _model(df, labels, id_col, text_col, fold, sample_rows)

    def run(batches):
        for batch in batches:
            score = probabilities(batch.column(1), model.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["doc_id", "score"])

    kind = docs.schema["_id"].dataType.simpleString()
    remainder = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % fold
    out = docs.mapInArrow(run, f"doc_id {kind}, score double")
    return out.select("doc_id", (remainder == 0).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def keep_good(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", fold: int = 5, sample_rows: int = SAMPLE_ROWS, least: float = THRESHOLD
) -> DataFrame:
    """The rows whose texts score ``least`` or more, with their own columns."""
    _, model = _model(df, labels, id_col, text_col, fold, sample_rows)
    place = df.columns.index(text_col)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(probabilities(batch.column(place), model.value) >= least))

    return df.mapInArrow(run, df.schema)
