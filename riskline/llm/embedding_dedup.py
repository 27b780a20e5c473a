"""Near-duplicate embeddings by randomly rotated binary codes (operator 12).

Which vectors have a cosine of ``least`` or more? Equal vectors are one class; links are looked for between classes.

1. Codes. A vector is scaled to length 1 and turned by one random rotation (fixed seed). Its binary code x' holds the
   signs, each 1/sqrt(D) long. Stored with it: the correction factor f = <x', x>, and a code of one byte per entry with
   its exact error e.
2. Index. The first ``bits`` signs are a vector's home cell. Bit i of a vector at cosine ``least`` flips with a
   probability that follows from |x_i|, because the rotation is random. Each vector's codes are sent to its likeliest
   cells, in falling probability, until a partner at the threshold is there with ``cover``; the full rotated vectors
   stay at home, once each. A partner is missed only if neither vector's codes reach the other, so at the threshold more
   than ``cover`` of the links are found, and nearly all above it (measured in the tests and in the README).
3. Estimates. In a cell, <x', q> / f is an unbiased estimate of <x, q> for the full vector q; its error is
   sqrt(1 - f^2) / f * sqrt(1 - cos^2) * u, with u an entry of a random unit vector in D - 1 dimensions. A pair stays if
   the estimate is above the threshold less ``EPS`` standard deviations (for D up to ``EPS``^2 + 1, the largest possible
   error: then no link is lost here). For pairs that stay, the byte code gives <x, q> up to e: most are certain.
   Only pairs within e of the threshold are recomputed in double precision from the vectors themselves.
4. Links are counted where they are found: the home cell of q adds x to q; it also adds q to x if q's codes do not reach
   x's home, where the pair would be found again. Pairs leave a task as sums per vector and as a spanning forest.

A cell with many vectors (near copies share one) is cut into blocks, and a task compares one block of queries with one of
codes: no group is ever in one task, and no pair is an output row but the undecided ones. Counting all direct links of a
dense group compares all its pairs, block by block.

Vectors that are null, empty or zero, or hold null or non-finite entries, link with nothing; vectors of different
dimensions neither. Every row is a vector of its own: repeated rows and repeated ids link, null ids too (a null id has its
component's smallest id). An empty table gives no rows. Other columns, whatever their names, are not read. Vectors of any
dimension are used whole.
"""

from __future__ import annotations

import math
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskline.llm.jaccard_join import components
from riskline.llm.tables import cut, small

#: Vectors of a home cell, about; bits at most; flipped bits at most (beyond 10 bits).
CELL, MAX_BITS, FLIPS = 512, 16, 5
#: Queries and codes that one task compares, at most about.
QUERY_BLOCK, CODE_BLOCK = 4096, 32768
#: Standard deviations of the estimate's error that a pair is allowed.
EPS = 8.0
#: Below this many dimensions, every cell that a partner can be in gets the codes.
FEW_DIMS = 16
#: What float arithmetic may add to an estimate.
SLACK = 1e-5

_CODED = "cid long, copies long, dim int, cell int, signs binary, factor float, bytes binary, step float, error float, turned binary, probes binary"
_OUT = "a long, b long, links long, kind int"
#: Kinds of a task's output rows.
_COUNT, _EDGE, _OPEN, _OPEN_ONCE = 0, 1, 2, 3


@lru_cache(maxsize=4)
def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(12_000_000 + dim).standard_normal((dim, dim)))
    return q * np.where(np.diag(r) < 0, -1.0, 1.0)


@lru_cache(maxsize=4)
def flips(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sets of flipped bits: (sets, bits) of 0/1, and each set as a number."""
    most = bits if bits <= 10 else FLIPS
    sets = [c for k in range(most + 1) for c in combinations(range(bits), k)]
    table = np.zeros((len(sets), bits))
    for row, c in zip(table, sets, strict=True):
        row[list(c)] = 1
    return table, (table @ (1 << np.arange(bits))).astype(np.int64)


def _phi(x: np.ndarray) -> np.ndarray:
    """The normal distribution function."""
    return np.array([0.5 * math.erfc(v) for v in (x / -math.sqrt(2)).ravel()]).reshape(x.shape)


def probes(turned: np.ndarray, bits: int, least: float, cover: float) -> list[np.ndarray]:
    """For each turned unit vector, the cells that its partners are in, likeliest first."""
    n, dim = turned.shape
    table, value = flips(bits)
    x = np.abs(turned[:, :bits])
    home = cells(turned, bits)
    far = math.sqrt(max(0.0, 1 - least * least))  # |x_i| beyond this cannot change its sign
    if dim < FEW_DIMS:
        score = (x > far) @ table.T
        return [home[i] ^ value[score[i] == 0] for i in range(n)]
    sd = np.sqrt((1 - np.minimum(x, 1.0) ** 2) / (dim - 1)) * far
    p = np.where(x > far, 0.0, _phi(-least * x / np.maximum(sd, 1e-12))) if bits else np.zeros((n, 0))
    p = np.clip(p, 1e-15, 0.5)
    likely = np.exp(np.log(p / (1 - p)) @ table.T) * np.prod(1 - p, axis=1, keepdims=True)
    order = np.argsort(-likely, axis=1, kind="stable")
    mass = np.cumsum(np.take_along_axis(likely, order, 1), axis=1)
    count = (mass < cover).sum(axis=1) + 1
    return [home[i] ^ value[order[i, : count[i]]] for i in range(n)]


def cells(turned: np.ndarray, bits: int) -> np.ndarray:
    return ((turned[:, :bits] >= 0) @ (1 << np.arange(bits))).astype(np.int64)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1, in doubles, without overflow."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def matrices(column: pa.Array):
    """(row numbers, matrix) of the vectors of each length in a list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    at = np.asarray(column.offsets)
    values = column.values.to_numpy(zero_copy_only=False)
    size = np.diff(at)
    for dim in np.unique(size):
        rows = np.flatnonzero(size == dim)
        yield rows, values[at[rows][:, None] + np.arange(dim)]


def _blobs(rows) -> pa.Array:
    return pa.array([np.ascontiguousarray(r).tobytes() for r in rows], pa.binary())


def _encode(bits: int, least: float, cover: float):
    def run(batches):
        for batch in batches:
            cid, copies = (batch.column(k).to_numpy() for k in (0, 1))
            for rows, vectors in matrices(batch.column(2)):
                for lo in range(0, len(rows), 2048):
                    part = rows[lo : lo + 2048]
                    dim = vectors.shape[1]
                    own = min(bits, dim) if dim >= FEW_DIMS else min(bits, dim, 8)
                    turned = (unit(vectors[lo : lo + 2048]) @ rotation(dim)).astype(np.float32)
                    step = np.abs(turned).max(axis=1, keepdims=True) / 127
                    code = np.rint(turned / step).astype(np.int8)
                    error = np.sqrt(((turned - code * step) ** 2).sum(axis=1))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(cid[part]),
                            pa.array(copies[part]),
                            pa.array(np.full(len(part), dim), pa.int32()),
                            pa.array(cells(turned, own), pa.int32()),
                            _blobs(np.packbits(turned >= 0, axis=1)),
                            pa.array(np.abs(turned).sum(axis=1) / math.sqrt(dim), pa.float32()),
                            _blobs(code),
                            pa.array(step[:, 0], pa.float32()),
                            pa.array(error, pa.float32()),
                            _blobs(turned),
                            _blobs(x.astype(np.int32) for x in probes(turned, own, least, cover)),
                        ],
                        [c.split()[0] for c in _CODED.split(", ")],
                    )

    return run


def _spread(batches):
    """One row per code and probed cell."""
    for batch in batches:
        lists = [np.frombuffer(p, np.int32) for p in batch.column("probes").to_pylist()]
        size = np.array([len(x) for x in lists], np.int64)
        rows = pa.array(np.repeat(np.arange(len(lists)), size))
        out = [batch.column(c).take(rows) for c in ("cid", "copies", "dim", "cell", "signs", "factor", "bytes", "step", "error")]
        to = pa.array(np.concatenate(lists) if lists else np.zeros(0, np.int32))
        yield pa.RecordBatch.from_arrays([*out, to], ["cid", "copies", "dim", "home", "signs", "factor", "bytes", "step", "error", "cell"])


def _stack(blobs: pd.Series, kind, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), kind).reshape(len(blobs), dim)


def margin(factor: np.ndarray, dim: int, least: float) -> np.ndarray:
    """How far below the threshold the estimate of a linked pair can be."""
    deviations = min(EPS, math.sqrt(max(dim - 1, 1)))
    loss = np.sqrt(np.maximum(0.0, 1 - factor.astype(float) ** 2)) / factor
    return deviations * loss * math.sqrt(max(0.0, 1 - least * least)) / math.sqrt(max(dim - 1, 1)) + SLACK


def _forest(linked: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, name of its component in this matrix) of the rows (a) and columns (b) with a link."""
    r, c = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
    m, a, b = linked[np.ix_(r, c)], a[r], b[c]
    most = np.iinfo(np.int64).max
    left, right = a.copy(), b.copy()
    while True:
        near = np.minimum(left, np.where(m, right[None, :], most).min(axis=1))
        after = np.minimum(right, np.where(m, near[:, None], most).min(axis=0))
        if (near == left).all() and (after == right).all():
            break
        left, right = near, after
    node, root = np.concatenate([a, b]), np.concatenate([left, right])
    keep = node != root
    return node[keep], root[keep]


def _compare(least: float):
    def run(queries: pd.DataFrame, codes: pd.DataFrame) -> pd.DataFrame:
        names = ["a", "b", "links", "kind"]
        if not len(queries) or not len(codes):
            return pd.DataFrame({k: pd.Series([], dtype="int64") for k in names})
        dim = int(queries["dim"].iloc[0])
        q = _stack(queries["turned"], np.float32, dim)
        q_id, q_copies = queries["cid"].to_numpy(), queries["copies"].to_numpy()
        x_id, x_copies, home = (codes[c].to_numpy() for c in ("cid", "copies", "home"))
        signs = np.unpackbits(_stack(codes["signs"], np.uint8, (dim + 7) // 8), axis=1, count=dim).astype(np.float32) * 2 - 1
        fine = _stack(codes["bytes"], np.int8, dim).astype(np.float32) * codes["step"].to_numpy()[:, None]
        factor, error = codes["factor"].to_numpy(), codes["error"].to_numpy()
        floor = ((least - margin(factor, dim, least)) * factor * math.sqrt(dim)).astype(np.float32)
        q_links, x_links = np.zeros(len(q_id), np.int64), np.zeros(len(x_id), np.int64)
        out: list[tuple] = []

        def put(a, b, links, kind):
            out.append((a, b, links, np.full(len(a), kind)))

        for i in range(0, len(q), 512):
            reach = [np.frombuffer(p, np.int32) for p in queries["probes"].iloc[i : i + 512]]
            for j in range(0, len(x_id), 4096):
                rows, cols = slice(i, i + 512), slice(j, j + 4096)
                hopeful = (q[rows] @ signs[cols].T >= floor[None, cols]) & (q_id[rows, None] != x_id[None, cols])
                r = np.flatnonzero(hopeful.any(axis=1))
                c = np.flatnonzero(hopeful.any(axis=0))
                if not len(r):
                    continue
                near = q[rows][r] @ fine[cols][c].T
                hopeful = hopeful[np.ix_(r, c)]
                doubt = error[cols][c][None, :] + SLACK
                linked = hopeful & (near - doubt >= least)
                unsure = hopeful & ~linked & (near + doubt >= least)
                # is the pair also found at the home of x?
                cell, which = np.unique(home[cols][c], return_inverse=True)
                twice = np.stack([np.isin(cell, reach[k]) for k in r])[:, which]
                qi, xi = r + i, c + j
                q_links[qi] += linked @ x_copies[xi]
                x_links[xi] += (linked & ~twice).T @ q_copies[qi]
                if linked.any():
                    node, root = _forest(linked, q_id[qi], x_id[xi])
                    put(node, root, np.zeros(len(node), np.int64), _EDGE)
                for kind, some in ((_OPEN, unsure & twice), (_OPEN_ONCE, unsure & ~twice)):
                    s, t = np.nonzero(some)
                    put(q_id[qi[s]], x_id[xi[t]], np.zeros(len(s), np.int64), kind)
        for ids, links in ((q_id, q_links), (x_id, x_links)):
            at = np.flatnonzero(links)
            put(ids[at], ids[at], links[at], _COUNT)
        return pd.DataFrame({k: np.concatenate([o[n] for o in out]) for n, k in enumerate(names)})

    return run


def _cosines(batches):
    for batch in batches:
        keep = [batch.column(k) for k in range(3)]
        left, right = batch.column(3), batch.column(4)
        cos = np.zeros(len(left))
        for (rows, x), (_, y) in zip(matrices(left), matrices(right), strict=True):
            cos[rows] = (unit(x) * unit(y)).sum(axis=1)
        yield pa.RecordBatch.from_arrays([*keep, pa.array(cos)], ["a", "b", "kind", "cosine"])


def links_between(classes: DataFrame, least: float, cover: float, cell: int = CELL) -> tuple[DataFrame, DataFrame]:
    """(cid, links) and the edges (a, b) of a spanning graph, for classes (cid, copies, vec)."""
    n = classes.count()
    bits = min(MAX_BITS, max(0, math.ceil(math.log2(max(1, n) / cell))))
    coded = cut(classes.select("cid", "copies", "vec").mapInArrow(_encode(bits, least, cover), _CODED))
    spread = coded.mapInArrow(
        _spread, "cid long, copies long, dim int, home int, signs binary, factor float, bytes binary, step float, error float, cell int"
    )
    at = ["dim", "cell"]
    sizes = coded.groupBy(*at).agg(F.count("*").alias("q")).join(spread.select(*at).groupBy(*at).agg(F.count("*").alias("x")), at)
    sizes = sizes.select(*at, F.ceil(F.col("q") / QUERY_BLOCK).cast("int").alias("qs"), F.ceil(F.col("x") / CODE_BLOCK).cast("int").alias("xs"))
    split = small(cut(sizes.filter("qs > 1 or xs > 1")))

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        """Each row in one block of its own side, against every block of the other side."""
        rows = rows.join(split, at, "left")
        mine = F.expr(f"cast(pmod(xxhash64(cid), coalesce({own}, 1)) as int)").alias(own[0])
        return rows.withColumn(other[0], F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1))).select("*", mine).drop("qs", "xs")

    queries = dealt(coded.select("cid", "copies", *at, "turned", "probes"), "qs", "xs")
    codes = dealt(spread, "xs", "qs")
    keys = [*at, "q", "x"]
    found = cut(queries.groupBy(*keys).cogroup(codes.groupBy(*keys)).applyInPandas(_compare(least), _OUT))
    counted = found.filter(F.col("kind") == _COUNT).select(F.col("a").alias("cid"), "links")
    edges = found.filter(F.col("kind") == _EDGE).select("a", "b")
    undecided = found.filter(F.col("kind") >= _OPEN).select("a", "b", "kind")
    vec = lambda c: classes.select(F.col("cid").alias(c), F.col("vec").alias(f"vec_{c}"))
    exact = undecided.join(vec("a"), "a").join(vec("b"), "b").select("a", "b", "kind", "vec_a", "vec_b")
    exact = cut(exact.mapInArrow(_cosines, "a long, b long, kind int, cosine double").filter(F.col("cosine") >= least))
    copies = lambda c: classes.select(F.col("cid").alias(c), F.col("copies").alias("links"))
    more = exact.join(copies("b"), "b").select(F.col("a").alias("cid"), "links")
    back = exact.filter(F.col("kind") == _OPEN_ONCE).join(copies("a"), "a").select(F.col("b").alias("cid"), "links")
    links = counted.unionByName(more).unionByName(back).groupBy("cid").agg(F.sum("links").alias("links"))
    return links, edges.unionByName(exact.select("a", "b"))


def near_duplicates(
    df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", least: float = 0.9, cover: float = 0.99, cell: int = CELL
) -> DataFrame:
    """One row per input row: ``vec_id, n_links, component_id, kept`` (other rows linked directly; the smallest id reachable
    by links, its own included; whether that is its own). ``least`` is above 0 and below 1. See the module's text."""
    vec = F.transform(F.col(f"`{vec_col}`").cast("array<double>"), lambda x: x + F.lit(0.0))  # no -0.0
    rows = df.select(F.col(f"`{id_col}`").alias("_id"), vec.alias("_vec"))
    sound = F.forall("_vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("_vec", lambda x: x != 0)
    rows = rows.withColumn("_vec", F.when(F.coalesce(sound, F.lit(False)), F.col("_vec")))
    key = [F.when(F.col("_vec").isNotNull(), F.xxhash64(F.lit(k), "_vec")).alias(f"_h{k}") for k in (1, 2)]
    keyed = rows.select("_id", "_vec", *key)
    classes = keyed.filter("_vec is not null").groupBy("_h1", "_h2")
    classes = classes.agg(F.count("*").alias("copies"), F.min("_id").alias("low"), F.first("_vec").alias("vec"))
    classes = cut(classes.select(F.monotonically_increasing_id().alias("cid"), "_h1", "_h2", "copies", "low", "vec"))
    links, edges = links_between(classes, least, cover, cell)
    named = classes.drop("vec").join(components(edges).withColumnRenamed("node", "cid"), "cid", "left")
    named = named.join(links, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    named = cut(named.select("_h1", "_h2", "root", "low", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    named = named.join(lowest, "root").select("_h1", "_h2", "n_links", "component_id")
    whole = keyed.drop("_vec").join(named, ["_h1", "_h2"], "left")
    component = F.when(F.col("_h1").isNull(), F.col("_id")).otherwise(F.col("component_id"))
    out = whole.select(F.col("_id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


#: Every pair, in double precision.
ORACLE_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
u AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM v WHERE list_dot_product(e, e) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  AND list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.9),
r AS (SELECT a AS vec_id, a AS root FROM l UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.vec_id),
c AS (SELECT vec_id, min(root) AS c FROM r GROUP BY 1),
k AS (SELECT a AS vec_id, count(*) AS k FROM l GROUP BY 1)
SELECT x.vec_id, CAST(coalesce(k.k, 0) AS BIGINT) AS n_links, coalesce(c.c, x.vec_id) AS component_id, coalesce(c.c, x.vec_id) = x.vec_id AS kept
FROM embeddings x LEFT JOIN k USING (vec_id) LEFT JOIN c USING (vec_id)
"""
