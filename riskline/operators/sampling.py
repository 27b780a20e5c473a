"""Stratified splitting, folds and class weights.

Every random choice derives from a hash of the row id and a seed, so a rerun
(or a recomputed partition after an executor loss) makes the same choice.
Class quotas are exact (largest remainder, as a stratified shuffle split
allocates them); the rows inside a class are the ones with the smallest
``(hash, id)``.

Split and folds never shuffle the rows: for each class the row at
the quota rank (the "cut") is found with the range-narrowing selection of
``quantiles.select_ranks`` (a few aggregation passes over (class, key) whose
shuffles carry only histograms), level by level of one total order
``(key, ids, row hash)`` at every size, then rows are assigned by comparing with the
cut. ``rank_within`` (explicit ranks via range-bounded
windows) remains for callers that need the rank itself.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

TARGET_RANGE_ROWS = 1_000_000


def hash_key(id_cols: Sequence[str], seed: int = 42) -> Column:
    """Deterministic pseudo-random order key of a row."""
    return F.xxhash64(*[F.col(c) for c in id_cols], F.lit(seed))


def class_counts(df: DataFrame, target: str) -> dict:
    return {r[0]: r[1] for r in df.groupBy(target).count().collect()}


def largest_remainder(counts: Mapping, n_draws: int) -> dict:
    """Split ``n_draws`` over classes proportionally; leftover units go to
    the largest remainders (ties -> smaller class value)."""
    total = sum(counts.values())
    keys = sorted(counts)
    cont = {k: counts[k] / total * n_draws for k in keys}
    out = {k: int(math.floor(cont[k])) for k in keys}
    need = n_draws - sum(out.values())
    for k in sorted(keys, key=lambda k: (-(cont[k] - math.floor(cont[k])), k))[:need]:
        out[k] += 1
    return out


def split_quotas(counts: Mapping, test_size: float = 0.2) -> dict:
    """Test rows per class: n_test = ceil(test_size * n); the train quotas
    are allocated first by largest remainder and the test gets the rest."""
    n = sum(counts.values())
    n_test = int(math.ceil(test_size * n))
    train = largest_remainder(counts, n - n_test)
    return {k: counts[k] - train[k] for k in counts}


def rank_within(
    df: DataFrame,
    by: Sequence[str],
    order_key: Column,
    tie_cols: Sequence[str],
    n_rows: int | None = None,
) -> DataFrame:
    """Add ``_key`` and ``_rank`` (1-based) inside each ``by`` group in
    ``(order_key, tie_cols)`` order, without a single-task window.

    ``order_key`` must be a uniformly spread 64-bit value (a hash); its top
    bits give the ranges."""
    by = list(by)
    n_rows = n_rows if n_rows is not None else df.count()
    bits = max(0, min(24, math.ceil(math.log2(max(1, n_rows / TARGET_RANGE_ROWS)))))
    keyed = df.withColumn("_key", order_key.cast("long"))
    rng = F.shiftright(F.col("_key"), 64 - bits) if bits > 0 else F.lit(0).cast("long")
    keyed = keyed.withColumn("_rng", rng)
    sizes = keyed.groupBy(*by, "_rng").agg(F.count(F.lit(1)).alias("_c"))
    w_off = Window.partitionBy(*by).orderBy("_rng").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*by, "_rng", F.coalesce(F.sum("_c").over(w_off), F.lit(0)).alias("_off"))
    j = keyed.join(offsets, [*by, "_rng"])
    w = Window.partitionBy(*by, "_rng").orderBy("_key", *tie_cols)
    return j.withColumn("_rank", F.col("_off") + F.row_number().over(w)).drop("_rng", "_off")


def _order_cols(df: DataFrame, id_cols: Sequence[str], seed: int, order_key: Column | None) -> tuple[DataFrame, list[str]]:
    """The rows with the levels of their total order: the key (a hash of the ids by default), the ids, and a
    hash of the whole row. A 64-bit value makes two levels (its upper and lower 32 bits), each exact as a double."""
    key = order_key if order_key is not None else hash_key(id_cols, seed)
    exact = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)
    ids = [F.col(f"`{c}`") if isinstance(df.schema[c].dataType, exact) else F.xxhash64(F.col(f"`{c}`")) for c in id_cols]
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], F.lit(seed + 1))
    levels = {}
    for i, x in enumerate([key, *ids, row_hash]):
        x = F.coalesce(x.cast("long"), F.lit(-(1 << 63)))
        levels[f"_o{i}h"] = F.shiftright(x, 32).cast("double")
        levels[f"_o{i}l"] = x.bitwiseAND(F.lit(0xFFFFFFFF)).cast("double")
    return df.withColumns(levels), list(levels)


def _is_class(target: str, c) -> Column:
    return F.col(f"`{target}`").eqNullSafe(F.lit(c))


def _tied(target: str, c, levels: Sequence[str], values: Sequence[float]) -> Column:
    """The rows of a class that have these values on the first levels."""
    cond = _is_class(target, c)
    for name, v in zip(levels, values):
        cond = cond & (F.col(name) == F.lit(v))
    return cond


def _cuts(keyed: DataFrame, levels: list[str], target: str, ranks: Mapping, stats) -> dict:
    """``{(class, rank): (values, left, equal)}``: the row at a 0-based rank has ``values`` on the first levels of the
    order; ``left`` of the ``equal`` rows with the same values come before the cut. ``left`` is 0 unless all levels
    are used up, which is so for exact copies only.

    Each level narrows all open ranks together (``select_ranks``); rows are never collected."""
    from riskline.operators.quantiles import _stats, select_ranks

    found, open_ranks = {}, {(c, ()): [(r, r) for r in rs] for c, rs in ranks.items() if rs}
    for depth, name in enumerate(levels):
        if not open_ranks:
            break
        groups = list(open_ranks)
        number = F.lit(None).cast("int")
        for g, (c, values) in enumerate(groups):
            number = F.when(_tied(target, c, levels, values), F.lit(g)).otherwise(number)
        long = keyed.select(number.alias("_g"), F.lit("key").alias("variable"), F.col(name).alias("value")).where("_g is not null")
        if depth == 0:
            first = [(groups.index((row[target], ())), row) for row in stats if (row[target], ()) in open_ranks]
        else:
            first = [(row["_g"], row) for row in _stats(long, ["_g"])]
        state = {(((g,), "key"), r): [row["lo"], row["hi"], 0, row["n"]] for g, row in first for _, r in open_ranks[groups[g]]}
        met = select_ranks(long, ["_g"], [T.StructField("_g", T.IntegerType())], state)
        after = defaultdict(list)
        for g, key in enumerate(groups):
            c, values = key
            for rank, r in open_ranks[key]:
                v, below, equal = met[(((g,), "key"), r)]
                here = (*values, v)
                if r == below or depth == len(levels) - 1:
                    found[(c, rank)] = (here, r - below, equal)
                else:
                    after[(c, here)].append((rank, r - below))
        open_ranks = after
    return found


def _key_stats(keyed: DataFrame, levels: list[str], target: str):
    """One pass: per class ``n, min, max`` of the first level (the class sizes
    and the selection's starting ranges)."""
    from riskline.operators.quantiles import _stats

    long = keyed.select(F.col(target), F.lit("key").alias("variable"), F.col(levels[0]).alias("value"))
    stats = _stats(long, [target])
    return stats, {r[target]: r["n"] for r in stats}


def _before(levels: list[str], values: Sequence[float]) -> Column:
    """Whether a row comes before the rows with these values on the first levels."""
    used = levels[: len(values)]
    return F.struct(*[F.col(x) for x in used]) < F.struct(*[F.lit(float(v)).alias(x) for x, v in zip(used, values)])


def _assign(keyed: DataFrame, levels: list[str], target: str, name: str, cuts: dict, steps: Mapping) -> DataFrame:
    """Add ``name``: how many cuts of its class a row is not before. ``steps[c]`` are the class's ranks in ascending order.

    Rows are compared with the cuts in a projection. Where a cut falls among exact copies, the copies are equal in every
    column: their one row is repeated as often as it occurs and the copies are numbered, so the quota is exact."""
    value, copies = F.lit(0), []
    for c, ranks in steps.items():
        count = F.lit(0)
        for r in ranks:
            values, left, equal = cuts[(c, r)]
            count = count + F.when(_before(levels, values), 0).otherwise(1)
            if left:
                copies.append((c, values, equal))
        value = F.when(_is_class(target, c), count).otherwise(value)
    out = keyed.withColumn(name, value.cast("int"))
    for c, values, equal in dict.fromkeys(copies):
        same = _tied(target, c, levels, values)
        passed = F.lit(0)
        for r in steps[c]:
            at, left, _ = cuts[(c, r)]
            here = (F.col("_copy") >= F.lit(left)) if at == values else ~_before(levels, at)
            passed = passed + F.when(here, 1).otherwise(0)
        one = keyed.where(same).limit(1).withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(equal - 1))))
        numbered = one.withColumn(name, passed.cast("int")).drop("_copy")
        out = out.where(~same).unionByName(numbered)
    return out.drop(*levels)


def stratified_split(
    df: DataFrame,
    target: str,
    id_cols: Sequence[str],
    test_size: float = 0.2,
    seed: int = 42,
    order_key: Column | None = None,
) -> DataFrame:
    """Add ``split`` ('train' / 'test') with exact stratified quotas: the
    first ``quota_c`` rows of class ``c`` in ``(key, ids, row hash)`` order are the test
    rows, whatever the number of ties. No shuffle of the rows: class counts and the cut come from
    aggregation passes, the assignment is a projection."""
    keyed, levels = _order_cols(df, id_cols, seed, order_key)
    stats, counts = _key_stats(keyed, levels, target)
    quotas = split_quotas(counts, test_size)
    steps = {c: [q] for c, q in quotas.items() if 0 < q < counts[c]}
    out = _assign(keyed, levels, target, "_passed", _cuts(keyed, levels, target, steps, stats), steps)
    whole = [c for c, q in quotas.items() if q >= counts[c]]
    none = [c for c, q in quotas.items() if q <= 0]
    test = F.col("_passed") == 0
    for c in whole:
        test = test | _is_class(target, c)
    for c in none:
        test = test & ~_is_class(target, c)
    return out.withColumn("split", F.when(test, "test").otherwise("train")).drop("_passed")


def split_data(df: DataFrame, target: str, id_cols: Sequence[str], test_size: float = 0.2, seed: int = 42):
    """``(train, test)`` frames."""
    s = stratified_split(df, target, id_cols, test_size, seed)
    return s.where(F.col("split") == "train").drop("split"), s.where(F.col("split") == "test").drop("split")


def stratified_folds(
    df: DataFrame,
    target: str,
    id_cols: Sequence[str],
    n_splits: int = 5,
    seed: int = 42,
    order_key: Column | None = None,
) -> DataFrame:
    """Add ``fold`` in ``0..n_splits-1``: the row of rank ``r`` (0-based,
    ``(key, ids, row hash)`` order) in a class of ``n`` rows goes to fold
    ``floor(r * k / n)``, so per-class fold sizes differ by at most one.
    The k-1 cuts per class come from the same selection passes as the split."""
    keyed, levels = _order_cols(df, id_cols, seed, order_key)
    stats, counts = _key_stats(keyed, levels, target)
    # a class of fewer rows than folds passes several cuts at one rank
    starts = {c: [-(-f * n // n_splits) for f in range(1, n_splits)] for c, n in counts.items()}
    steps = {c: [r for r in rs if 0 < r < counts[c]] for c, rs in starts.items()}
    zero = {c: sum(r <= 0 for r in rs) for c, rs in starts.items()}
    cuts = _cuts(keyed, levels, target, {c: sorted(set(rs)) for c, rs in steps.items()}, stats)
    out = _assign(keyed, levels, target, "fold", cuts, steps)
    for c, n in zero.items():
        if n:
            out = out.withColumn("fold", F.when(_is_class(target, c), F.col("fold") + n).otherwise(F.col("fold")))
    return out.withColumn("fold", F.col("fold").cast("int"))


def balanced_weights(counts: Mapping) -> dict:
    """w_c = n / (#classes * n_c)."""
    n = sum(counts.values())
    return {k: n / (len(counts) * c) for k, c in counts.items()}


def with_class_weights(df: DataFrame, target: str, weight_col: str = "weight", counts: Mapping | None = None) -> DataFrame:
    """``class_weight='balanced'`` as a weight column (counts fitted on ``df``
    unless given, e.g. from the training fold)."""
    counts = counts or class_counts(df, target)
    w = balanced_weights(counts)
    expr = F.lit(None).cast("double")
    for k, v in w.items():
        expr = F.when(F.col(target) == F.lit(k), F.lit(float(v))).otherwise(expr)
    return df.withColumn(weight_col, expr)
