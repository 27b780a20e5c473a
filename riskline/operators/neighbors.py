"""Exact k-nearest-neighbour join (C7 imputer, K2 classifier, I4 SMOTE).

Two plans. Few coordinates and many pairs (``CELLS_FROM``): cells of a k-d partition of the donors, of which a query meets
those that a bound leaves (``neighbor_cells``). Else both sides are cut into hash blocks of bounded size; every query block
meets every donor block once through ``cogroup(...).applyInPandas``: the
query rows are exploded over the donor-block ids and the donor rows over the
query-block ids, so each (query block, donor block) pair is one task. The
vectorised kernel scores the pair chunk by chunk and emits only each
query's local top-k (never the pair list); a window over at most
``k x #donor blocks`` candidates per query then keeps the global top-k.

Distance: NaN-aware Euclidean over the coordinates present on both sides,
scaled by ``p / n_present`` (``p`` = all coordinates), the form a k-NN
imputer uses; with complete data it is the plain Euclidean distance.
Ties are broken by donor id, so the result is deterministic.

The blocks' work is O(#queries x #donors) distance evaluations (complete rows of many coordinates: matrix products in single
precision, which leave few pairs to evaluate), spread over
#query blocks x #donor blocks tasks with memory bounded by the block size;
no block holds more than ``block_rows`` rows of either side whatever the
key distribution (blocks come from a hash of the row id).
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

from riskline.operators import neighbor_cells as C
from riskline.operators.neighbor_cells import merged, nearest
from riskline.session import ensure_checkpoint_dir

BLOCK_ROWS = 20_000
#: Block rows where distances start as matrix products.
WIDE_BLOCK_ROWS = 50_000
QUERY_CHUNK, DONOR_CHUNK = 1024, 4096
#: Pairs that are compared exactly at a time.
PAIRS = 65_536
#: Coordinates up to which cells can leave out pairs, and pairs from which on they are worth their scans.
FEW_COORDS = 8
CELLS_FROM = 25_000_000
#: Rows below which a block is not cut further for the sake of parallelism.
SMALL_BLOCK = 512
#: Donor blocks whose candidates for one query are merged at a time.
MERGE_BLOCKS = 32


def block_counts(nq: int, nd: int, cores: int, block_rows: int) -> tuple[int, int]:
    """Query and donor blocks: no block over ``block_rows``, and a task for every core if there are rows enough."""
    qb, db = max(1, math.ceil(nq / block_rows)), max(1, math.ceil(nd / block_rows))
    most_q, most_d = max(1, nq // SMALL_BLOCK), max(1, nd // SMALL_BLOCK)
    qb = max(qb, min(most_q, math.ceil(cores / db)))
    return qb, max(db, min(most_d, math.ceil(cores / qb)))


def _exact(q: np.ndarray, d: np.ndarray, pairs: int) -> np.ndarray:
    """NaN-aware distances, row by row of two arrays that broadcast over all but their last axis; infinite without a
    coordinate in common. Sums run over the coordinates in their order."""
    acc, cnt = 0.0, 0
    for f in range(pairs):
        both = ~np.isnan(q[..., f]) & ~np.isnan(d[..., f])
        with np.errstate(invalid="ignore", over="ignore"):
            diff = q[..., f] - d[..., f]
            acc = acc + np.where(both, diff * diff, 0.0)
        cnt = cnt + both
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(cnt == 0, np.inf, np.sqrt(acc * pairs / cnt))


def _sides(Q: np.ndarray, D: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in single precision with two more coordinates each, so that one matrix product of them gives squared distances."""
    square = [(x * x).sum(axis=1, keepdims=True) for x in (Q, D)]
    one = [np.ones_like(x) for x in square]
    return np.hstack([Q, square[0], one[0]]).astype(np.float32), np.hstack([-2 * D, one[1], square[1]]).astype(np.float32)


def _own(qids: np.ndarray, sorted_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, donor) of equal ids; donors are sorted by id."""
    first, end = (np.searchsorted(sorted_ids, qids, side=side) for side in ("left", "right"))
    count = end - first
    i = np.repeat(np.arange(len(qids)), count)
    j = np.arange(len(i)) + np.repeat(first - (np.cumsum(count) - count), count)
    real = qids[i] == sorted_ids[j]  # a missing id equals none
    return i[real], j[real]


def _close_pairs(qn: np.ndarray, dn: np.ndarray, unit: float, limit: np.ndarray, k: int, own: tuple | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (query, donor) of which none of a query's k nearest are missing: squared distances of centred rows (``_sides``)
    by one matrix product in single precision, and its error's bound; and the squared distance that the k-th nearest does
    not exceed. ``own``: pairs that do not count."""
    square = qn @ dn.T
    if own is not None:
        square[own] = np.inf
    error = 8.0 * (qn.shape[1] + 8) * float(np.finfo(np.float32).eps) * unit
    if not np.isfinite(limit).all() and k <= square.shape[1]:
        limit = np.minimum(limit, np.partition(square, k - 1, axis=1)[:, k - 1].astype(float) + error)
    i, j = np.divmod(np.flatnonzero(square <= (limit + error).astype(np.float32)[:, None] * np.float32(1 + 1e-6)), square.shape[1])
    return i, j, limit


def _local_topk(qids, Q, dids, D, k, exclude_self):
    """Top-k donors per query row: (query row, donor row, distance) arrays. A chunk of queries meets a chunk of donors at a
    time. Complete rows of many coordinates are compared by matrix products first, and exactly only where those leave them."""
    p = Q.shape[1]
    out_q, out_d, out_dist = [], [], []
    # Donors sorted by id, so that equal distances are taken in the order of ids.
    order = np.argsort(dids, kind="stable")
    sorted_ids, D = dids[order], D[order]
    kk = min(k, len(dids))
    products = p > FEW_COORDS and np.isfinite(Q).all() and np.isfinite(D).all()
    if products:
        middle = D.mean(axis=0)
        largest = max(np.abs(Q - middle).max(), np.abs(D - middle).max())
        products = 0 < largest < 1e100
    if products:
        Qn, Dn = ((x - middle) / largest for x in (Q, D))
        unit = float((Qn * Qn).sum(axis=1).max() + (Dn * Dn).sum(axis=1).max())
        Qn, Dn = _sides(Qn, Dn)
    for s in range(0, len(qids), QUERY_CHUNK):
        q = Q[s : s + QUERY_CHUNK]
        best = np.full((len(q), 0), np.inf), np.zeros((len(q), 0), np.int64)
        limit = np.full(len(q), np.inf)
        for t in range(0, len(D), DONOR_CHUNK):
            d = D[t : t + DONOR_CHUNK]
            if products:
                own = _own(qids[s : s + QUERY_CHUNK], sorted_ids[t : t + DONOR_CHUNK]) if exclude_self else None
                i, j, limit = _close_pairs(Qn[s : s + QUERY_CHUNK], Dn[t : t + DONOR_CHUNK], unit, limit, kk, own)
                if not len(i):
                    continue
                dist = np.concatenate([_exact(q[i[c : c + PAIRS]], d[j[c : c + PAIRS]], p) for c in range(0, len(i), PAIRS)] or [np.empty(0)])
                by = np.lexsort((j, dist, i))
                i, j, dist = i[by], j[by], dist[by]
                place = np.arange(len(i)) - np.searchsorted(i, i)
                first = place < kk
                more = np.full((len(q), kk), np.inf), np.zeros((len(q), kk), np.int64)
                more[0][i[first], place[first]], more[1][i[first], place[first]] = dist[first], t + j[first]
            else:
                dist = _exact(q[:, None, :], d[None, :, :], p)
                if exclude_self:
                    dist[qids[s : s + QUERY_CHUNK, None] == sorted_ids[None, t : t + DONOR_CHUNK]] = np.inf
                idx = nearest(np.where(np.isnan(dist), np.inf, dist), min(kk, len(d)))
                more = np.take_along_axis(dist, idx, axis=1), t + idx
            best = merged(best, more, kk)
            if products and best[0].shape[1] == kk:
                limit = np.minimum(limit, (best[0][:, -1] / largest) ** 2 * (1 + 1e-9))
        ok = np.isfinite(best[0])
        out_q.append(np.broadcast_to(np.arange(s, s + len(q))[:, None], ok.shape)[ok])
        out_d.append(order[best[1][ok]])
        out_dist.append(best[0][ok])
    return np.concatenate(out_q), np.concatenate(out_d), np.concatenate(out_dist)


def knn_join(
    queries: DataFrame,
    donors: DataFrame,
    query_id: str,
    donor_id: str,
    coords: Sequence[str],
    k: int,
    exclude_self: bool = False,
    block_rows: int | None = None,
    counts: tuple[int, int] | None = None,
    payload: Sequence[str] = (),
    within: Sequence[str] = (),
) -> DataFrame:
    """``qid, did, dist, rank, *payload`` for the ``k`` nearest donors of every query
    (fewer when fewer donors have a defined distance). Ids may be of any type that has an order;
    ``payload`` columns of the donors (as doubles) travel through the kernel, so no join by donor follows.
    ``within``: integer columns of both sides (they come first in the result); only rows that agree in them meet."""
    coords, payload, within = list(coords), list(payload), list(within)
    if counts:
        nq, nd = counts
    else:  # rows of the largest group
        nq, nd = (x.groupBy(*within).agg(F.count("*").alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0] if within else x.count() for x in (queries, donors))
    cores = queries.sparkSession.sparkContext.defaultParallelism
    if len(coords) <= FEW_COORDS and nq * nd > CELLS_FROM:
        found = _by_cells(queries, donors, query_id, donor_id, coords, k, exclude_self, block_rows or BLOCK_ROWS, payload, within, cores)
        if found is not None:
            return found
    qb, db = block_counts(nq, nd, 1 if within else cores, block_rows or (WIDE_BLOCK_ROWS if len(coords) > FEW_COORDS else BLOCK_ROWS))
    q = queries.select(
        *[F.col(w).alias(f"qw{i}") for i, w in enumerate(within)],
        F.col(query_id).alias("qid"),
        *[F.col(c).cast("double").alias(f"q{i}") for i, c in enumerate(coords)],
    ).withColumn("qb", F.pmod(F.xxhash64("qid"), F.lit(qb)).cast("int"))
    d = donors.select(
        *[F.col(w).alias(f"dw{i}") for i, w in enumerate(within)],
        F.col(donor_id).alias("did"),
        *[F.col(c).cast("double").alias(f"d{i}") for i, c in enumerate(coords)],
        *[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(payload)],
    ).withColumn("db", F.pmod(F.xxhash64("did"), F.lit(db)).cast("int"))
    q = q.withColumn("db", F.explode(F.sequence(F.lit(0), F.lit(db - 1))))
    d = d.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(qb - 1))))
    p = len(coords)
    values = [f"v{i}" for i in range(len(payload))]
    schema = T.StructType(
        [
            *[T.StructField(w, queries.schema[w].dataType) for w in within],
            T.StructField("qid", q.schema["qid"].dataType),
            T.StructField("did", d.schema["did"].dataType),
            T.StructField("dist", T.DoubleType()),
            T.StructField("part", T.IntegerType()),
            *[T.StructField(v, T.DoubleType()) for v in values],
        ]
    )

    def kernel(qpdf: pd.DataFrame, dpdf: pd.DataFrame) -> pd.DataFrame:
        if len(qpdf) == 0 or len(dpdf) == 0:
            return pd.DataFrame({f.name: [] for f in schema.fields})
        Q = qpdf[[f"q{i}" for i in range(p)]].to_numpy(dtype=np.float64, na_value=np.nan)
        D = dpdf[[f"d{i}" for i in range(p)]].to_numpy(dtype=np.float64, na_value=np.nan)
        a, b, c = _local_topk(qpdf["qid"].to_numpy(), Q, dpdf["did"].to_numpy(), D, k, exclude_self)
        met = {w: qpdf[f"qw{i}"].iloc[0] for i, w in enumerate(within)} | {"qid": qpdf["qid"].to_numpy()[a], "did": dpdf["did"].to_numpy()[b], "dist": c, "part": int(dpdf["db"].iloc[0])}
        return pd.DataFrame(met | {v: dpdf[v].to_numpy()[b] for v in values})

    sides = [x.groupBy(*[f"{n}w{i}" for i in range(len(within))], "qb", "db") for n, x in (("q", q), ("d", d))]
    local = sides[0].cogroup(sides[1]).applyInPandas(kernel, schema)
    best = F.slice(F.sort_array(F.collect_list(F.struct("dist", "did", *values))), 1, k)
    # At most MERGE_BLOCKS * k candidates of a query meet at once, whatever the number of donor blocks.
    while db > MERGE_BLOCKS:
        db = math.ceil(db / MERGE_BLOCKS)
        local = local.withColumn("part", F.floor(F.col("part") / MERGE_BLOCKS).cast("int"))
        local = local.groupBy(*within, "qid", "part").agg(best.alias("x")).select(*within, "qid", "part", F.explode("x").alias("x")).select(*within, "qid", "part", "x.*")
    return _ranked(local, within, best, values, payload)


def _ranked(local: DataFrame, within: Sequence[str], best: Column, values: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """The nearest of every query's candidates, in order."""
    found = local.groupBy(*within, "qid").agg(best.alias("x")).select(*within, "qid", F.posexplode("x").alias("rank", "x"))
    named = [F.col(f"x.{v}").alias(c) for v, c in zip(values, payload)]
    return found.select(*within, "qid", "x.did", "x.dist", (F.col("rank") + 1).alias("rank"), *named)


def _by_cells(queries, donors, query_id, donor_id, coords, k, exclude_self, block_rows, payload, within, cores) -> DataFrame | None:
    """``knn_join`` through the cells of ``neighbor_cells``; None if nulls make too many spaces."""
    number = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    groups = [f"w{i}" for i in range(len(within))]
    q = queries.select(*[F.col(w).alias(g) for w, g in zip(within, groups)], F.col(query_id).alias("qid"), *[number(c).alias(f"q{i}") for i, c in enumerate(coords)])
    values = [f"v{i}" for i in range(len(payload))]
    d = donors.select(
        *[F.col(w).alias(g) for w, g in zip(within, groups)],
        F.col(donor_id).alias("did"),
        *[number(c).alias(f"d{i}") for i, c in enumerate(coords)],
        *[F.col(c).cast("double").alias(v) for c, v in zip(payload, values)],
    )
    local = C.candidates(q, d, within, len(coords), values, k, exclude_self, block_rows, cores)
    if local is None:
        return None
    local = local.select(*[F.col(g).alias(w) for w, g in zip(within, groups)], "qid", "did", "dist", *values)
    best = F.slice(F.sort_array(F.collect_list(F.struct("dist", "did", *values))), 1, k)
    return _ranked(local, within, best, values, payload)


# ---------------------------------------------------------------------------
# K-NN imputation
# ---------------------------------------------------------------------------


def knn_impute(
    df: DataFrame,
    id_col: str,
    target: str,
    predictors: Sequence[str],
    k: int = 5,
    donors: DataFrame | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """Fill NULL ``target`` with the mean target of the ``k`` nearest donors.

    Distances use ``[target, *predictors]`` (the target is NULL on receivers, so
    it counts in ``p`` but never in the sum); donors are the rows with a
    target (from ``donors`` when given, e.g. the training split). A receiver
    without any donor at a defined distance gets the donors' target mean.
    Only ``target`` is rewritten."""
    coords = [target, *[c for c in predictors if c != target]]
    pool = (donors if donors is not None else df).where(F.col(target).isNotNull())
    receivers = df.where(F.col(target).isNull())
    pool = pool.withColumn("_y", F.col(target))
    nn = knn_join(receivers, pool, id_col, id_col, coords, k, block_rows=block_rows, payload=["_y"])
    fill = nn.groupBy("qid").agg(F.avg("_y").alias("_fill"))
    mean = pool.agg(F.avg(target)).first()[0]
    # Only the receivers meet the fill table; rows that have the target pass
    # through without a shuffle.
    rec = receivers.join(fill, receivers[id_col] == fill["qid"], "left")
    # a mean is a double: an integer target is widened, not cut
    rec = rec.withColumn(target, F.coalesce(F.col("_fill"), F.lit(mean))).select(*df.columns)
    return df.where(F.col(target).isNotNull()).withColumn(target, F.col(target).cast("double")).unionByName(rec)


# ---------------------------------------------------------------------------
# K2: k-NN classifier
# ---------------------------------------------------------------------------


def knn_predict(
    train: DataFrame,
    test: DataFrame,
    id_col: str,
    features: Sequence[str],
    label: str,
    k: int = 5,
    weights: str = "uniform",
    block_rows: int | None = None,
) -> DataFrame:
    """K2: ``id, probability, prediction`` for every test row.

    ``probability`` = weighted share of positive neighbours (``distance``
    weights 1/d; neighbours at distance 0, when present, take all the weight);
    ``prediction`` = 1 when the probability exceeds 0.5 (a tie votes 0)."""
    donors = train.withColumn("_y", F.col(label).cast("double"))
    j = knn_join(test, donors, id_col, id_col, features, k, block_rows=block_rows, payload=["_y"])
    if weights == "distance":
        zero = F.max((F.col("dist") == 0).cast("int")).over(Window.partitionBy("qid"))
        w = F.when(zero == 1, (F.col("dist") == 0).cast("double")).otherwise(1.0 / F.col("dist"))
    else:
        w = F.lit(1.0)
    j = j.withColumn("_w", w)
    agg = j.groupBy("qid").agg((F.sum(F.col("_w") * F.col("_y")) / F.sum("_w")).alias("probability"))
    return agg.select(
        F.col("qid").alias(id_col), "probability", (F.col("probability") > 0.5).cast("int").alias("prediction")
    )


# ---------------------------------------------------------------------------
# I4: SMOTE
# ---------------------------------------------------------------------------


def smote(
    train: DataFrame,
    id_col: str,
    features: Sequence[str],
    label: str,
    k: int = 5,
    seed: int = 42,
    minority=None,
    block_rows: int | None = None,
    trace: bool = False,
) -> DataFrame:
    """I4: oversample the minority class to parity with synthetic rows
    ``x + u (nn - x)`` where ``nn`` is one of the ``k`` nearest minority
    neighbours of a minority row ``x`` and ``u`` in [0, 1) (Chawla et al.,
    2002). Base row, neighbour and gap come from hashes of the synthetic
    row number and the seed; bases are the minority rows that have a neighbour at a defined
    distance. Returns the training rows plus the synthetic
    ones (``is_synthetic``; synthetic ids are negative). Features come back as doubles, as the
    points between two rows of an integer feature are no integers. ``trace`` adds ``base_id``,
    ``neighbour_id`` and ``gap`` of the synthetic rows."""
    from riskline.operators.sampling import class_counts, rank_within

    counts = class_counts(train, label)
    if minority is None:
        minority = min(counts, key=lambda c: (counts[c], c))
    majority_n = max(v for c, v in counts.items() if c != minority)
    n_min = counts[minority]
    n_new = majority_n - n_min
    ids = train.schema[id_col].dataType
    wide = [F.col(c).cast("double").alias(c) for c in features]
    traced = {"base_id": F.lit(None).cast(ids), "neighbour_id": F.lit(None).cast(ids), "gap": F.lit(None).cast("double")} if trace else {}
    base = train.select(id_col, *wide, label, F.lit(False).alias("is_synthetic")).withColumns(traced)
    if n_new <= 0 or n_min < 2:
        return base
    mins = train.where(F.col(label) == minority)
    points = [f"_n_{c}" for c in features]
    donors = mins.withColumns({n: F.col(c).cast("double") for n, c in zip(points, features)})
    nn = knn_join(mins, donors, id_col, id_col, features, k, exclude_self=True, block_rows=block_rows, counts=(n_min, n_min), payload=points)
    near = nn.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("rank", "did", *points))).alias("_nn"))
    own = mins.select(F.col(id_col).alias("qid"), *[F.col(c).cast("double").alias(f"_b_{c}") for c in features])
    ensure_checkpoint_dir(train.sparkSession)  # the lineage is cut: counted, ranked and joined below
    with_nn = own.join(near, "qid").checkpoint(eager=True)
    n_base = with_nn.count()
    if n_base == 0:
        raise ValueError("no minority row has a neighbour at a defined distance")
    # Index the base rows 0..n_base-1 in hash order (distributed ranking).
    ranked = rank_within(with_nn.withColumn("_all", F.lit(1)), ["_all"], F.xxhash64("qid", F.lit(seed)), ["qid"], n_rows=n_base)
    ranked = ranked.withColumn("_idx", F.col("_rank") - 1)
    s = train.sparkSession.range(n_new).withColumnRenamed("id", "_s")
    h1, h2, h3 = (F.xxhash64(F.col("_s"), F.lit(seed), F.lit(i)) for i in (1, 2, 3))
    s = s.select("_s", F.pmod(h1, F.lit(n_base)).alias("_idx"), h2.alias("_h2"), (F.pmod(h3, F.lit(1 << 30)) / float(1 << 30)).alias("_u"))
    syn = s.join(ranked, "_idx").withColumn("_x", F.element_at("_nn", (F.pmod("_h2", F.size("_nn")) + 1).cast("int")))
    point = {c: F.col(f"_b_{c}") + F.col("_u") * (F.col(f"_x._n_{c}") - F.col(f"_b_{c}")) for c in features}
    # an id of the rows' own type: negative numbers, or text
    new_id = -(F.col("_s") + 1) if isinstance(ids, T.NumericType) else F.concat(F.lit("synthetic-"), F.col("_s").cast("string"))
    syn = syn.select(
        new_id.cast(ids).alias(id_col),
        *[point[c].alias(c) for c in features],
        F.lit(minority).cast(train.schema[label].dataType).alias(label),
        F.lit(True).alias("is_synthetic"),
        *([F.col("qid").alias("base_id"), F.col("_x.did").alias("neighbour_id"), F.col("_u").alias("gap")] if trace else []),
    )
    return base.unionByName(syn)


def smote_within(rows: DataFrame, within: Sequence[str], id_col: str, features: Sequence[str], label: str, k: int = 5, seed: int = 42) -> DataFrame:
    """I4 for many training sets at once: the synthetic rows (``within, id, features, label``) that bring the minority of
    every ``within`` group to parity, as ``smote`` makes them. Groups are training sets of one plan (their counts reach
    the driver); the neighbour join and the ranking run over the rows of all of them."""
    from riskline.operators.sampling import rank_within

    within, features = list(within), list(features)
    spark = rows.sparkSession
    counts: dict[tuple, dict] = {}
    for r in rows.groupBy(*within, label).count().collect():
        counts.setdefault(tuple(r[w] for w in within), {})[r[label]] = r["count"]
    wanted = []
    for g, c in counts.items():
        minority = min(c, key=lambda v: (c[v], v))
        new = max((n for v, n in c.items() if v != minority), default=0) - c[minority]
        if new > 0 and c[minority] > 1:
            wanted.append((*g, minority, new))
    kinds = [rows.schema[w] for w in within]
    schema = T.StructType([*kinds, T.StructField("_minority", rows.schema[label].dataType), T.StructField("_new", T.LongType())])
    plan = F.broadcast(spark.createDataFrame(wanted, schema))
    points = [f"_n_{c}" for c in features]
    mins = rows.join(plan, within).where(F.col(label) == F.col("_minority"))
    donors = mins.withColumns({n: F.col(c).cast("double") for n, c in zip(points, features)})
    nn = knn_join(mins, donors, id_col, id_col, features, k, exclude_self=True, payload=points, within=within)
    near = nn.groupBy(*within, "qid").agg(F.sort_array(F.collect_list(F.struct("rank", "did", *points))).alias("_nn"))
    own = mins.select(*within, F.col(id_col).alias("qid"), *[F.col(c).cast("double").alias(f"_b_{c}") for c in features])
    ensure_checkpoint_dir(spark)
    with_nn = own.join(near, [*within, "qid"]).checkpoint(eager=True)
    bases = {tuple(r[w] for w in within): r["count"] for r in with_nn.groupBy(*within).count().collect()}
    wanted = [w for w in wanted if bases.get(w[: len(within)])]
    first, made = 0, []
    for w in wanted:
        made.append((len(made), *w, first, bases[w[: len(within)]]))
        first += w[-1]
    whole = T.StructType([T.StructField("_g", T.IntegerType()), *schema.fields, T.StructField("_first", T.LongType()), T.StructField("_base", T.LongType())])
    plan = F.broadcast(spark.createDataFrame(made, whole))
    ranked = rank_within(with_nn, within, F.xxhash64("qid", F.lit(seed)), ["qid"]).withColumn("_idx", F.col("_rank") - 1)
    group = F.lit(-1)
    for m in made:
        group = F.when(F.col("id") >= m[-2], m[0]).otherwise(group)
    s = spark.range(first).withColumn("_g", group).join(plan, "_g").withColumn("_s", F.col("id") - F.col("_first")).drop("id")
    h1, h2, h3 = (F.xxhash64(F.col("_s"), F.lit(seed), F.lit(i)) for i in (1, 2, 3))
    s = s.select(*within, "_minority", "_s", F.pmod(h1, "_base").alias("_idx"), h2.alias("_h2"), (F.pmod(h3, F.lit(1 << 30)) / float(1 << 30)).alias("_u"))
    syn = s.join(ranked, [*within, "_idx"]).withColumn("_x", F.element_at("_nn", (F.pmod("_h2", F.size("_nn")) + 1).cast("int")))
    point = [(F.col(f"_b_{c}") + F.col("_u") * (F.col(f"_x._n_{c}") - F.col(f"_b_{c}"))).alias(c) for c in features]
    ids = rows.schema[id_col].dataType
    new_id = -(F.col("_s") + 1) if isinstance(ids, T.NumericType) else F.concat(F.lit("synthetic-"), F.col("_s").cast("string"))
    return syn.select(*within, new_id.cast(ids).alias(id_col), *point, F.col("_minority").alias(label))
