"""Cells for the exact k-NN join (``neighbors.knn_join``): queries meet only the donors that a bound leaves.

Rows that have the same coordinates present form a space, in which distances are plain Euclidean ones times a constant. In
each space the donors (of exact copies the first by id, no others can be among the nearest) are cut into cells of a k-d
partition: planes come from a bounded sample of the donors, every donor goes to its cell. Two rounds follow:

1. a query meets its home cell. Its k-th distance there bounds the result; the bounding boxes of the other cells
   (a row per cell, on every executor) tell which of them can hold anything nearer, or as near.
2. it meets those cells, whatever their number.

Inside a task, cell and queries are cut in the same way into boxes of ``LEAF`` rows, and a group of queries visits
boxes in the order of their least distance, until none is left within its bound. A cell with many queries
meets them in chunks. Results are those of comparing all pairs, ties by donor id included.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from riskline.session import ensure_checkpoint_dir

#: Rows of a box inside a task, and rows that a group of queries meets at a time.
LEAF, STEP = 64, 512
#: Sample rows per cell that planes are learned from; cells of all spaces together.
SAMPLE, MOST_CELLS = 64, 16_384
#: Spaces per group up to which donors are put into each of theirs.
MOST_SPACES = 64
#: Entries of a (queries, cells) matrix of least distances.
ENTRIES = 4_000_000
#: Least distances are computed with rounding; a box this much beyond a bound is still visited.
SLACK = 1 + 1e-9


def nearest(dist: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k smallest distances per row, nearest first, equal distances in column order."""
    if k < dist.shape[1]:
        kth = np.partition(dist, k - 1, axis=1)[:, k - 1 : k]
        chosen = dist < kth
        tied = dist == kth
        chosen |= tied & (np.cumsum(tied, axis=1) <= k - chosen.sum(axis=1, keepdims=True))
        columns = np.nonzero(chosen)[1].reshape(dist.shape[0], k)
    else:
        columns = np.tile(np.arange(dist.shape[1]), (dist.shape[0], 1))
    order = np.argsort(np.take_along_axis(dist, columns, axis=1), axis=1, kind="stable")
    return np.take_along_axis(columns, order, axis=1)


def merged(best: tuple[np.ndarray, np.ndarray], more: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k first of two (distances, donors) lists per row."""
    dist, donor = np.hstack([best[0], more[0]]), np.hstack([best[1], more[1]])
    order = np.lexsort((donor, dist))[:, :k]
    return np.take_along_axis(dist, order, axis=1), np.take_along_axis(donor, order, axis=1)


def boxes(x: np.ndarray, most: int) -> list[np.ndarray]:
    """Row numbers in boxes of at most ``most`` rows: halves by the widest side."""
    todo, out = [np.arange(len(x))] if len(x) else [], []
    while todo:
        rows = todo.pop()
        if len(rows) <= most:
            out.append(rows)
            continue
        part = x[rows]
        side = part[:, int(np.argmax(part.max(axis=0) - part.min(axis=0)))]
        order = np.argpartition(side, len(rows) // 2)
        todo += [rows[order[len(rows) // 2 :]], rows[order[: len(rows) // 2]]]
    return out


def least(lo: np.ndarray, hi: np.ndarray, qlo: np.ndarray, qhi: np.ndarray, scale: float) -> np.ndarray:
    """Least distances between query boxes (rows) and donor boxes (columns)."""
    acc = np.zeros((len(qlo), len(lo)))
    for f in range(lo.shape[1]):
        gap = np.maximum(0.0, np.maximum(lo[None, :, f] - qhi[:, None, f], qlo[:, None, f] - hi[None, :, f]))
        acc += gap * gap
    return np.sqrt(acc * scale)


def topk(qids, Q: np.ndarray, bound: np.ndarray, dids, D: np.ndarray, k: int, exclude_self: bool, p: int):
    """Top-k donors within ``bound`` per query row: (query row, donor row, distance) arrays. Rows are finite; ``p`` is the
    number of coordinates of the whole join."""
    n = Q.shape[1]
    order = np.argsort(dids, kind="stable")  # donors by id, so that equal distances are taken in the order of ids
    ids, D = dids[order], D[order]
    leaf = boxes(D, LEAF)
    lo, hi = (np.stack([f(D[b], axis=0) for b in leaf]) for f in (np.min, np.max))
    size = np.array([len(b) for b in leaf])
    out_q, out_d, out_dist = [], [], []
    for rows in boxes(Q, LEAF):
        q, limit = Q[rows], bound[rows].copy()
        away = least(lo, hi, q.min(axis=0)[None], q.max(axis=0)[None], p / n)[0]
        near = np.argsort(away, kind="stable")
        ends = np.cumsum(size[near])
        best = np.empty((len(rows), 0)), np.empty((len(rows), 0), np.int64)
        at = 0
        while at < len(near):
            upto = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + (STEP if at else 2 * LEAF))) + 1
            take = near[at:upto]
            take = take[away[take] <= limit.max() * SLACK]
            if not len(take):
                break
            columns = np.sort(np.concatenate([leaf[b] for b in take]))
            acc = np.zeros((len(rows), len(columns)))
            with np.errstate(over="ignore"):
                for f in range(n):
                    diff = q[:, f, None] - D[columns, f][None, :]
                    acc += diff * diff
                dist = np.sqrt(acc * p / n)
            if exclude_self:
                dist[qids[rows][:, None] == ids[columns][None, :]] = np.inf
            idx = nearest(dist, min(k, len(columns)))
            best = merged(best, (np.take_along_axis(dist, idx, axis=1), columns[idx]), k)
            if best[0].shape[1] == k:
                limit = np.minimum(limit, best[0][:, -1])
            at = upto
        ok = np.isfinite(best[0]) & (best[0] <= bound[rows][:, None])
        out_q.append(np.broadcast_to(rows[:, None], ok.shape)[ok])
        out_d.append(order[best[1][ok]])
        out_dist.append(best[0][ok])
    return np.concatenate(out_q), np.concatenate(out_d), np.concatenate(out_dist)


class Planes:
    """A k-d partition of one space; ``first`` is the number of its first cell."""

    def __init__(self, sample: np.ndarray, active: Sequence[int], cells: int, first: int):
        self.feature, self.value, self.left, self.cell, self.first, self.cells = [-1], [0.0], [0], [first], first, 0
        todo = [(0, sample, cells)]
        while todo:
            node, x, wanted = todo.pop()
            spread = x[:, active].max(axis=0) - x[:, active].min(axis=0) if len(x) > 1 and wanted > 1 else np.zeros(1)
            if spread.max() <= 0:
                self.cell[node] = first + self.cells
                self.cells += 1
                continue
            f = active[int(np.argmax(spread))]
            side = np.sort(x[:, f])
            value = side[len(side) * (wanted // 2) // wanted]
            if value == side[0]:
                value = side[np.searchsorted(side, value, side="right")]
            self.feature[node], self.value[node], self.left[node] = f, float(value), len(self.left)
            for part, n in ((x[x[:, f] < value], wanted // 2), (x[x[:, f] >= value], wanted - wanted // 2)):
                todo.append((len(self.left), part, n))
                for values, empty in ((self.feature, -1), (self.value, 0.0), (self.left, 0), (self.cell, -1)):
                    values.append(empty)

    def of(self, x: np.ndarray) -> np.ndarray:
        feature, value, left, cell = (np.array(v) for v in (self.feature, self.value, self.left, self.cell))
        at, row = np.zeros(len(x), np.int64), np.arange(len(x))
        while (feature[at] >= 0).any():
            go = feature[at] >= 0
            at = np.where(go, left[at] + (x[row, np.maximum(feature[at], 0)] >= value[at]), at)
        return cell[at]


def _matching(df: DataFrame, small: DataFrame, on: Sequence[str]) -> DataFrame:
    """``df`` with the columns of a broadcast table, nulls equal."""
    small = small.select(*[F.col(c).alias(f"_{c}") for c in on], *[c for c in small.columns if c not in on])
    same = F.lit(True)
    for c in on:
        same = same & df[c].eqNullSafe(F.col(f"_{c}"))
    return df.join(F.broadcast(small), same).drop(*[f"_{c}" for c in on])


def _chunked(q: DataFrame, d: DataFrame, block_rows: int, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Queries dealt to chunks of their cell, and the cell's donors to all of them."""
    loads = q.groupBy("cell").count().collect()
    chunks = q.sparkSession.createDataFrame([(r["cell"], math.ceil(r["count"] / block_rows)) for r in loads], "cell int, _chunks int")
    q = _matching(q, chunks, ["cell"]).withColumn("chunk", F.pmod(F.xxhash64(*key), F.col("_chunks")).cast("int")).drop("_chunks")
    d = _matching(d, chunks, ["cell"]).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))).drop("_chunks")
    return q, d


def spaces_of(queries, donors) -> tuple[list[tuple], dict]:
    """Spaces (group, coordinates that a donor has, coordinates that count), and those of each kind of query; from the
    kinds (group, coordinates present) of both sides."""
    spaces: dict[tuple, int] = {}
    met: dict[tuple, list[int]] = {}
    for w, has in queries:
        for dw, dhas in donors:
            if w == dw and has & dhas:
                met.setdefault((w, has), []).append(spaces.setdefault((w, dhas, has & dhas), len(spaces)))
    return list(spaces), met


def candidates(
    q: DataFrame, d: DataFrame, within: Sequence[str], p: int, values: Sequence[str], k: int, exclude_self: bool, block_rows: int, cores: int
) -> DataFrame | None:
    """``w0.., qid, did, dist, *values``: donors of every query among which its k nearest are. ``q``: w0.., qid, q0..;
    ``d``: w0.., did, d0.., *values; both without NaN. None
    if there are more than ``MOST_SPACES`` spaces per group."""
    spark = q.sparkSession
    ensure_checkpoint_dir(spark)
    groups, qs, ds = [f"w{i}" for i in range(len(within))], [f"q{i}" for i in range(p)], [f"d{i}" for i in range(p)]

    def has(names: Sequence[str]) -> Column:
        return sum((F.when(F.col(c).isNotNull(), 1 << i).otherwise(0) for i, c in enumerate(names)), F.lit(0)).cast("int")

    q = q.withColumn("has", has(qs)).checkpoint(eager=True)
    d = d.withColumn("has", has(ds))
    kinds = [{(tuple(r[:-1]), r[-1]): None for r in x.select(*groups, "has").distinct().collect()} for x in (q, d)]
    spaces, met = spaces_of(*kinds)
    out = T.StructType([*[q.schema[w] for w in groups], q.schema["qid"], d.schema["did"], T.StructField("dist", T.DoubleType()), *[T.StructField(v, T.DoubleType()) for v in values]])
    if not spaces:
        return spark.createDataFrame([], out)
    if len(spaces) > MOST_SPACES * len({s[0] for s in spaces}):
        return None
    active = [[f for f in range(p) if s[2] >> f & 1] for s in spaces]
    kind = [d.schema[w] for w in groups] + [T.StructField("has", T.IntegerType())]
    table = spark.createDataFrame([(*s[0], s[1], s[2], i) for i, s in enumerate(spaces)], T.StructType([*kind, T.StructField("counts", T.IntegerType()), T.StructField("space", T.IntegerType())]))
    d = _matching(d, table, [*groups, "has"])
    d = d.select("space", "did", *[F.when(F.col("counts").bitwiseAND(1 << i) != 0, F.col(c)).alias(c) for i, c in enumerate(ds)], *values)
    for c in ds:
        d = d.where(F.col(c).isNull() | (F.abs(c) < float("inf")))  # at an infinite distance of all
    if exclude_self:  # one id may fall out of the copies, with all its rows
        d = d.withColumn("_n", F.dense_rank().over(Window.partitionBy("space", *ds).orderBy("did"))).where(F.col("_n") <= k + 1)
        d = d.withColumn("_n", F.row_number().over(Window.partitionBy("space", *ds, "did").orderBy(*(values or ["did"])))).where(F.col("_n") <= k)
    else:
        d = d.withColumn("_n", F.row_number().over(Window.partitionBy("space", *ds).orderBy("did", *values))).where(F.col("_n") <= k)
    d = d.drop("_n").checkpoint(eager=True)

    sizes = {r["space"]: r["count"] for r in d.groupBy("space").count().collect()}
    wanted = {s: max(math.ceil(n / block_rows), min(n // (2 * LEAF), math.ceil(cores / len(sizes))), 1) for s, n in sizes.items()}
    if sum(wanted.values()) > MOST_CELLS:
        wanted = {s: max(1, n * MOST_CELLS // sum(wanted.values())) for s, n in wanted.items()}
    share = {s: min(1.0, SAMPLE * wanted[s] / n) for s, n in sizes.items() if wanted[s] > 1}
    samples: dict[int, list] = {s: [] for s in sizes}
    if share:
        luck = F.create_map(*[F.lit(x) for s, f in share.items() for x in (s, int(f * (1 << 30)))])
        drawn = d.where(F.pmod(F.xxhash64("did", *ds), F.lit(1 << 30)) < F.coalesce(luck[F.col("space")], F.lit(0)))
        for r in drawn.select("space", F.array(*ds)).collect():
            samples[r[0]].append(r[1])
    planes, first = {}, 0
    for s in sizes:
        planes[s] = Planes(np.array(samples[s], dtype=float).reshape(-1, p), active[s], wanted[s], first)
        first += planes[s].cells

    @F.pandas_udf("int")
    def cell_of(space: pd.Series, x: pd.DataFrame) -> pd.Series:
        s, x = space.to_numpy(), x.to_numpy(dtype=np.float64, na_value=np.nan)
        cell = np.zeros(len(s), np.int32)
        for one in np.unique(s):
            cell[s == one] = planes[int(one)].of(x[s == one])
        return pd.Series(cell)

    d = d.withColumn("cell", cell_of("space", F.struct(*ds)))
    ends = d.groupBy("space", "cell").agg(*[f(c) for c in ds for f in (F.min, F.max)]).orderBy("cell").collect()
    space_of = {r["cell"]: r["space"] for r in ends}
    cells: dict[int, tuple] = {}
    for s in sizes:
        mine = [r for r in ends if r["space"] == s]
        box = np.array([r[2:] for r in mine], dtype=float).reshape(len(mine), p, 2)[:, active[s]]
        cells[s] = np.array([r["cell"] for r in mine]), box[:, :, 0], box[:, :, 1]
    homes = [(*w, h, max((s for s in found if s in sizes), key=lambda s: (sizes[s], -s))) for (w, h), found in met.items() if any(s in sizes for s in found)]
    if not homes:
        return spark.createDataFrame([], out)
    home = spark.createDataFrame(homes, T.StructType([*[T.StructField(w, q.schema[w].dataType) for w in groups], T.StructField("has", T.IntegerType()), T.StructField("space", T.IntegerType())]))
    q = _matching(q, home, [*groups, "has"]).withColumn("cell", cell_of("space", F.struct(*qs))).withColumn("r", F.lit(float("inf"))).drop("space")
    others = {(*w, h): [s for s in found if s in sizes] for (w, h), found in met.items()}

    def found(qpdf: pd.DataFrame, dpdf: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
        """Candidates, and per query its coordinates and the distance that bounds its k nearest."""
        Q, bound = qpdf[qs].to_numpy(dtype=np.float64, na_value=np.nan), qpdf["r"].to_numpy(dtype=float).copy()
        none = pd.DataFrame({f.name: [] for f in out.fields})
        if not len(qpdf) or not len(dpdf):
            return none, Q, bound
        use = active[space_of[int(dpdf["cell"].iloc[0])]]
        rows = np.flatnonzero(np.isfinite(Q[:, use]).all(axis=1))
        if not len(rows):
            return none, Q, bound
        D = dpdf[[ds[f] for f in use]].to_numpy(dtype=np.float64)
        a, b, dist = topk(qpdf["qid"].to_numpy()[rows], Q[rows][:, use], bound[rows], dpdf["did"].to_numpy(), D, k, exclude_self, p)
        a = rows[a]
        full = np.bincount(a, minlength=len(qpdf)) == k
        far = np.zeros(len(qpdf))
        np.maximum.at(far, a, dist)
        bound[full] = np.minimum(bound[full], far[full])
        one = {w: qpdf[w].to_numpy()[a] for w in groups} | {"qid": qpdf["qid"].to_numpy()[a], "did": dpdf["did"].to_numpy()[b], "dist": dist}
        return pd.DataFrame(one | {v: dpdf[v].to_numpy()[b] for v in values}), Q, bound

    def first_round(qpdf: pd.DataFrame, dpdf: pd.DataFrame) -> pd.DataFrame:
        got, Q, bound = found(qpdf, dpdf)
        got["cell"], got["r"] = -1, np.nan
        for c in qs:
            got[c] = np.nan
        if not len(qpdf):
            return got
        at, targets = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        here = int(qpdf["cell"].iloc[0])
        for key, rows in qpdf.groupby([*groups, "has"], dropna=False, sort=False).indices.items():
            key = tuple(None if x != x else x for x in (key if isinstance(key, tuple) else (key,)))
            for s in others[key]:
                number, lo, hi = cells[s]
                able = rows[np.isfinite(Q[rows][:, active[s]]).all(axis=1)]
                step = max(1, ENTRIES // len(number))
                for part in (able[i : i + step] for i in range(0, len(able), step)):
                    x = Q[part][:, active[s]]
                    i, j = np.nonzero((least(lo, hi, x, x, p / len(active[s])) <= bound[part][:, None] * SLACK) & (number != here)[None, :])
                    at.append(part[i])
                    targets.append(number[j])
        at, targets = np.concatenate(at), np.concatenate(targets)
        if not len(at):
            return got
        more = pd.DataFrame({w: qpdf[w].to_numpy()[at] for w in groups} | {"qid": qpdf["qid"].to_numpy()[at]})
        more["did"] = pd.Series([None] * len(at), dtype=object)
        more["dist"] = np.nan
        for v in values:
            more[v] = np.nan
        more["cell"], more["r"] = targets, bound[at]
        for f, c in enumerate(qs):
            more[c] = Q[at, f]
        if not len(got):
            return more
        got["did"] = got["did"].astype(object)  # whole numbers stay whole beside the open rows' nulls
        return pd.concat([got, more], ignore_index=True)

    def second_round(qpdf: pd.DataFrame, dpdf: pd.DataFrame) -> pd.DataFrame:
        return found(qpdf, dpdf)[0]

    wide = T.StructType([*out.fields, T.StructField("cell", T.IntegerType()), T.StructField("r", T.DoubleType()), *[T.StructField(c, T.DoubleType()) for c in qs]])
    sides = [x.groupBy("cell", "chunk") for x in _chunked(q, d, block_rows, ["qid", *qs])]
    met_home = sides[0].cogroup(sides[1]).applyInPandas(first_round, wide).checkpoint(eager=True)
    near = met_home.where("cell < 0").select(*out.names)
    rest = met_home.where("cell >= 0").select(*groups, "qid", "cell", "r", *qs)
    sides = [x.groupBy("cell", "chunk") for x in _chunked(rest, d, block_rows, ["qid", *qs])]
    return near.unionByName(sides[0].cogroup(sides[1]).applyInPandas(second_round, out))
