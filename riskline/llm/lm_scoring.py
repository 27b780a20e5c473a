"""Language-model scores by deleted interpolation (operator 3).

A bigram model over words: p(w | v) = l2 c(v,w)/c(v) + l1 c(w)/N + l0 1/(V+1), where the three
weights depend on the bucket of the context's frequency, floor(log2 c(v)). They are learned by
expectation-maximisation on held-out counts: each training token in turn is deleted from the counts
that predict it (every count less 1), over all training tokens.

How it runs: a task cuts its texts into chunks of about ``CHUNK_BYTES``. A chunk asks for the
counts of its distinct words and pairs (64-bit hashes, 48 bits for pairs) and brings its own
training counts; the requests are shuffled by hash range, summed, and answered in the order asked.
Then a chunk's texts and answers meet by chunk number, and each text is scored. A frequent word is
one request per chunk, so no key is hot; nothing is collected but N, V and the cells of a
fixed grid for the weights (``GRID`` steps per power of two of both probabilities).

Requests and texts (once for the weights, once for the scores) are made by three reads of the input, which must give the same rows in the same
partitions, as files do; any other input is written to the shared checkpoint folder first
(``stable=False``). A chunk whose answers don't match its requests raises an error.

Null texts are empty: their only token is the end. Null ids count as the text '' for the training split.
Repeated rows and ids each give a row and count each time. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskline.llm.tables import cut, parts
from riskline.llm.textblocks import Words, chunks, mix, run_starts, text_buffers

CHUNK_BYTES = 4 << 20
#: Requests that one task sums up.
BUCKET_ENTRIES = 2_000_000
GRID = 4
STEPS = 60

_U = np.uint64
_END, _START = _U(0xE4D0000000000001), _U(0x57A4700000000003)
_PAIR = _U(0xD6E8FEB86659FD93)


def tokens_of(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, its context, its text) hashes of a chunk: the words of each text, then one end."""
    n = len(w.count)
    ends = w.first[1:] + np.arange(n)
    token = np.empty(len(w.hash) + n, np.uint64)
    is_end = np.zeros(len(token), bool)
    is_end[ends] = True
    token[ends], token[~is_end] = _END, w.hash
    context = np.empty_like(token)
    context[1:] = token[:-1]
    context[np.append(0, ends[:-1] + 1)[:n]] = _START
    return token, context, np.repeat(np.arange(n), w.count + 1)


class Asked:
    """The distinct words and pairs of a chunk in the order of their hashes, and each token's place among them."""

    def __init__(self, w: Words):
        self.token, self.context, self.doc = tokens_of(w)
        self.words, self.word = np.unique(self.token, return_inverse=True)
        pair = mix(self.context * _PAIR + self.token) >> _U(16)
        self.pairs, self.pair = np.unique(pair, return_inverse=True)


def _split(h: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """Range bucket of sorted hashes, and so in ascending order."""
    return ((h >> _U(bits - 32)) * _U(buckets) >> _U(32)).astype(np.int64)


def _chunked(batches, ordinal_base: int):
    """Chunks of a task's rows: (number, ids, held out, bytes, offsets)."""
    at = 0
    for batch in batches:
        data, offsets = text_buffers(batch.column(2))
        for a, b in chunks(offsets, CHUNK_BYTES):
            part, o = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            yield ordinal_base + at, batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), part, o
            at += 1


def _number() -> int:
    return TaskContext.get().partitionId() << 32


def requests(docs: DataFrame, buckets: tuple[int, int]) -> DataFrame:
    """(bucket, chunk, asked, own): hashes and their training counts, by hash range; pairs follow after the words' buckets."""

    def run(batches):
        for chunk, _, held, data, offsets in _chunked(batches, _number()):
            a = Asked(Words(data, offsets))
            train = ~held.to_numpy(zero_copy_only=False)[a.doc]
            out = {"bucket": [], "chunk": [], "asked": [], "own": []}
            for base, n, bits, distinct, which in ((0, buckets[0], 64, a.words, a.word), (buckets[0], buckets[1], 48, a.pairs, a.pair)):
                own = np.bincount(which[train], minlength=len(distinct)).astype(np.int32)
                raw = distinct.view(np.uint8).reshape(-1, 8)[:, : bits // 8]
                bucket = _split(distinct, bits, n)
                at = run_starts(bucket)
                for x, y in zip(at, np.append(at[1:], len(distinct)), strict=True):
                    out["bucket"].append(base + int(bucket[x]))
                    out["chunk"].append(chunk)
                    out["asked"].append(raw[x:y].tobytes())
                    out["own"].append(own[x:y].tobytes())
            yield pa.RecordBatch.from_pydict(
                {"bucket": pa.array(out["bucket"], pa.int32()), "chunk": pa.array(out["chunk"], pa.int64())}
                | {k: pa.array(out[k], pa.binary()) for k in ("asked", "own")}
            )

    return docs.mapInArrow(run, "bucket int, chunk long, asked binary, own binary")


def answers(asked: DataFrame, word_buckets: int) -> DataFrame:
    """(chunk, bucket, counts) for each request, and one row without chunk per bucket of words: its N and V."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        bucket = int(rows["bucket"].iloc[0])
        width = 8 if bucket < word_buckets else 6
        raw = np.frombuffer(b"".join(rows["asked"]), np.uint8).reshape(-1, width)
        h = np.zeros((len(raw), 8), np.uint8)
        h[:, :width] = raw
        own = np.frombuffer(b"".join(rows["own"]), np.int32)
        distinct, which = np.unique(h.view(np.uint64).ravel(), return_inverse=True)
        total = np.bincount(which, weights=own, minlength=len(distinct)).astype(np.int64)
        back = total[which]
        ends = np.cumsum([len(x) // 4 for x in rows["own"]])
        out = pd.DataFrame({"chunk": rows["chunk"], "bucket": bucket, "counts": [x.tobytes() for x in np.split(back, ends[:-1])], "n": 0, "v": 0})
        if bucket < word_buckets:
            out.loc[len(out)] = [-1, bucket, b"", int(total.sum()), int((total > 0).sum())]
        return out

    return asked.groupBy("bucket").applyInPandas(run, "chunk long, bucket int, counts binary, n long, v long")


def chunk_texts(docs: DataFrame) -> DataFrame:
    """One row per chunk: its texts end to end, their offsets, ids and split."""

    def run(batches):
        for chunk, ids, held, data, offsets in _chunked(batches, _number()):
            flags = held.to_numpy(zero_copy_only=False).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([chunk], pa.int64()),
                    pa.array([data.tobytes()], pa.binary()),
                    pa.array([offsets.tobytes()], pa.binary()),
                    pa.array([flags.tobytes()], pa.binary()),
                    pa.array([ids.to_pylist()], pa.list_(pa.string())),
                ],
                names=["chunk", "data", "offsets", "held", "ids"],
            )

    return docs.mapInArrow(run, "chunk long, data binary, offsets binary, held binary, ids array<string>")


def _counts(row: pd.Series, replies: pd.DataFrame) -> tuple[Asked, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each token of a chunk: c(w), c(v), c(v,w); and which tokens are held out."""
    offsets = np.frombuffer(row["offsets"], np.int64)
    a = Asked(Words(np.frombuffer(row["data"], np.uint8), offsets))
    reply = np.frombuffer(b"".join(replies.sort_values("bucket")["counts"]), np.int64)
    if len(reply) != len(a.words) + len(a.pairs):
        raise RuntimeError("the input gave other rows when it was read again; call with stable=False")
    word = reply[: len(a.words)][a.word]
    pair = reply[len(a.words) :][a.pair]
    context = np.empty_like(word)
    context[1:] = word[:-1]
    starts = a.context == _START
    at_end = np.searchsorted(a.words, _END)
    context[starts] = reply[at_end] if len(a.words) else 0
    return a, word, context, pair, np.frombuffer(row["held"], np.uint8).astype(bool)


def frequency_bucket(c: np.ndarray) -> np.ndarray:
    """0 for 0, else 1 + floor(log2 c), 40 at most."""
    return np.minimum(np.where(c > 0, np.log2(np.maximum(c, 1)).astype(np.int64) + 1, 0), 40)


def _cell(p: np.ndarray) -> np.ndarray:
    """Cell of a probability on the grid: 0 for 0, else by its logarithm."""
    with np.errstate(divide="ignore"):
        return np.where(p > 0, 1 + np.minimum(np.floor(-np.log2(p) * GRID), 250), 0).astype(np.int64)


def deleted_cells(texts: DataFrame, replies: DataFrame, total: int) -> pd.DataFrame:
    """Per context bucket and grid cell: how many deleted tokens, and the sums of their two probabilities."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        columns = {"bucket": "int64", "x": "int64", "y": "int64", "n": "int64", "p1": "float64", "p2": "float64"}
        if not len(left):
            return pd.DataFrame({k: pd.Series(dtype=t) for k, t in columns.items()})
        a, word, context, pair, held = _counts(left.iloc[0], right)
        use = ~held[a.doc]
        word, context, pair = word[use] - 1, context[use] - 1, pair[use] - 1
        p1 = word / max(1, total - 1)
        p2 = np.where(context > 0, pair / np.maximum(context, 1), 0.0)
        frame = pd.DataFrame({"bucket": frequency_bucket(context + 1), "x": _cell(p1), "y": _cell(p2), "p1": p1, "p2": p2})
        out = frame.groupby(["bucket", "x", "y"], as_index=False).agg(n=("p1", "size"), p1=("p1", "sum"), p2=("p2", "sum"))
        return out[list(columns)].astype(columns)

    cells = texts.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInPandas(run, "bucket long, x long, y long, n long, p1 double, p2 double")
    # at most 41 x 252 x 252 cells
    return cells.groupBy("bucket", "x", "y").agg(*(F.sum(c).alias(c) for c in ("n", "p1", "p2"))).toPandas()


def learn_weights(cells: pd.DataFrame, v: int, steps: int = STEPS) -> np.ndarray:
    """(41, 3) mixture weights of 1/(V+1), c(w)/N and c(v,w)/c(v), by EM; a bucket starts from and leans
    on (as much as 20 tokens count) the weights of all buckets together. An unseen context has no pair estimate."""
    weights = np.tile(np.array([0.5, 0.5, 0.0]), (41, 1))
    if not len(cells):
        weights[:] = [1.0, 0.0, 0.0]
        return weights
    n = cells["n"].to_numpy(float)
    p = np.stack([np.full(len(n), 1 / (v + 1)), cells["p1"] / n, cells["p2"] / n], axis=1)
    bucket = cells["bucket"].to_numpy()

    def em(which: np.ndarray, start: np.ndarray, prior: float) -> np.ndarray:
        w = start.copy()
        for _ in range(steps):
            share = p[which] * w
            share *= (n[which] / np.maximum(share.sum(axis=1), 1e-300))[:, None]
            got = share.sum(axis=0) + prior * start
            w = got / got.sum()
        return w

    every = em(np.arange(len(n)), np.array([0.2, 0.4, 0.4]), 0.0)
    for b in range(1, 41):
        own = np.flatnonzero(bucket == b)
        weights[b] = em(own, every, 20.0) if len(own) else every
    seen = every[:2].sum()
    weights[0] = [every[0] / seen, every[1] / seen, 0.0] if seen > 0 else [1.0, 0.0, 0.0]
    # every weight of the uniform part stays above 0, so that every text has a finite score
    weights[:, 0] = np.maximum(weights[:, 0], 1e-6)
    return weights / weights.sum(axis=1, keepdims=True)


def scores(texts: DataFrame, replies: DataFrame, total: int, v: int, weights: np.ndarray) -> DataFrame:
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        names = ["id", "held_out", "n_tokens", "n_known", "base_score", "score"]
        if not len(left):
            return pd.DataFrame({k: [] for k in names})
        row = left.iloc[0]
        a, word, context, pair, held = _counts(row, right)
        w = weights[frequency_bucket(context)]
        p = w[:, 0] / (v + 1) + w[:, 1] * word / max(1, total) + w[:, 2] * pair / np.maximum(context, 1)
        n = len(held)
        per = lambda x: np.bincount(a.doc, weights=x, minlength=n)
        base = np.log10((word + 1) / (total + v + 1))
        columns = [list(row["ids"]), held, per(None).astype(np.int64), per(word > 0).astype(np.int64), per(base), per(np.log10(p))]
        return pd.DataFrame(dict(zip(names, columns, strict=True)))

    schema = "id string, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    return texts.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInPandas(run, schema)


def score_documents(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    fold: tuple[int, int] = (7, 2),
    stable: bool = False,
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``, one row per input row.

    Rows whose crc32(id as text) modulo ``fold[0]`` is ``fold[1]`` are held out, all others are learned from.
    ``base_score`` uses add-one smoothed word frequencies, ``score`` the interpolated model (both log10).
    """
    key = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    docs = df.select(
        F.col(f"`{id_col}`").cast("string").alias("_id"),
        (F.crc32(key.cast("binary")) % fold[0] == fold[1]).alias("_held"),
        F.col(f"`{text_col}`").cast("string").alias("_text"),
    )
    if not stable:
        docs = cut(docs)
    spark = df.sparkSession
    size = docs.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()[0]
    buckets = (parts(spark, size / 16, BUCKET_ENTRIES), parts(spark, size / 7, BUCKET_ENTRIES))
    replies = cut(answers(requests(docs, buckets), buckets[0]))
    total, v = replies.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    replies = replies.filter("chunk >= 0").select("chunk", "bucket", "counts")
    weights = learn_weights(deleted_cells(chunk_texts(docs), replies, total), v)
    out = scores(chunk_texts(docs), replies, total, v, weights)
    kind = df.schema[id_col].dataType
    return out.select(
        F.col("id").cast(kind).alias("doc_id"),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def perplexity(score: float, n_tokens: int) -> float:
    """Per-token perplexity of a log10 score."""
    return math.pow(10.0, -score / n_tokens) if n_tokens else math.nan
