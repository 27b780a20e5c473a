"""Exact, distributed quantiles by rank selection.

Spark's exact ``percentile`` aggregate keeps a map of every distinct value of
a group and merges it in one task, which does not survive a high-cardinality
column at scale. Here three passes over the columns as they are (no unpivot) usually do:

1. brackets: per group and column ``count, min, max`` and a KLL sketch (mergeable, some KB), which names for each
   probability two values around it, ``RANK_ERROR`` of all ranks to either side;
2. counts: how many values are below each bracket, and how many inside. This makes the result exact: it proves that
   the rank is inside (a bracket that misses its rank, once in hundreds, is replaced by the whole range);
3. the inside: once the brackets together hold ``FEW_ROWS`` rows at most, their distinct values are counted.

Brackets that hold more are narrowed first (``select_ranks``): passes in which rows inside the current range are counted
per bucket (``groupBy(probe, bucket)`` with map-side partial aggregation, so the shuffle carries at most
#probes x #buckets rows); the bucket that holds the target rank becomes the new range.

Buckets are equal in width if the range's ends are of one sign and magnitude,
else by sign and exponent. The ends of a range always fall into different
buckets, so each pass narrows it; a double has 2^11 exponents and 2^52 steps
in each, so six passes of 2,048 buckets reach one value. Infinities have
buckets of their own.

All columns, groups and probabilities are searched together. Linear interpolation
between the two neighbouring ranks, as ``quantile_cont`` / numpy ``linear``; NULLs are skipped.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskline.operators.long import to_long

#: Rows, over all open ranges together, whose distinct values may be counted one by one.
FEW_ROWS = 65_536
#: Items per level of a sketch, and how far to either side of a rank its bracket reaches (twice the sketch's error at 99 %).
SKETCH_K, RANK_ERROR = 4_000, 0.002
#: Columns of one pass.
CHUNK = 32


def _key_of(row, by):
    return tuple(row[b] for b in by), row["variable"]


def _stats(long: DataFrame, by: Sequence[str]):
    """Pass 0: ``count, min, max`` per (group, variable)."""
    return long.groupBy(*by, "variable").agg(
        F.count("value").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")
    ).collect()


def _bucket(x: Column, lo: Column, hi: Column, buckets: int) -> Column:
    """Bucket of a value in ``lo..hi`` (``lo < hi``): monotone, and different for the two ends."""
    infinite = float("inf")

    def magnitude(v: Column) -> Column:
        # sign and exponent: monotone over all finite doubles
        size = F.floor(F.log2(F.greatest(F.abs(v), F.lit(5e-324)))) + 1076
        return F.when(v > 0, size).when(v < 0, -size).otherwise(F.lit(0))

    near = ((lo > 0) & (hi / 4 <= lo)) | ((hi < 0) & (lo / 4 >= hi))
    linear = F.least(F.floor((x - lo) / (hi - lo) * buckets), F.lit(buckets - 1))
    span = magnitude(hi) - magnitude(lo)
    coarse = F.when(span > 0, F.floor((magnitude(x) - magnitude(lo)) * (buckets - 1) / span)).otherwise(linear)
    inner = F.when(near | (magnitude(lo) == magnitude(hi)), linear).otherwise(coarse)
    ends = F.when(x == -infinite, F.lit(-(1 << 20))).when(x == infinite, F.lit(1 << 20))
    return ends.when((lo == -infinite) | (hi == infinite), magnitude(x)).otherwise(inner).cast("int")


def select_ranks(
    long: DataFrame,
    by: Sequence[str],
    by_fields: Sequence[T.StructField],
    state: dict,
    buckets: int = 2048,
    few_rows: int = FEW_ROWS,
) -> dict:
    """Resolve ``state[(key, rank)] = [lo, hi, below, inside]`` (``key`` =
    (group tuple, variable); ranks 0-based over non-NULL values) to
    ``{(key, rank): (value, n_below, n_equal)}`` where ``n_below`` counts the
    values strictly smaller than ``value`` and ``n_equal`` those equal to it."""
    spark = long.sparkSession
    by = list(by)
    state = {k: list(v) for k, v in state.items()}
    values: dict = {}
    while True:
        for k, (lo, hi, below, inside) in list(state.items()):
            if lo == hi:
                values[k] = (lo, below, inside)
                del state[k]
        if not state:
            break
        ranges = {(k[0], lo, hi): inside for k, (lo, hi, _below, inside) in state.items()}
        final = sum(ranges.values()) <= few_rows
        # One probe per distinct (key, lo, hi): two ranks in the same range share it.
        probe_ids: dict = {}
        members = defaultdict(list)
        for k, (lo, hi, below, inside) in state.items():
            pk = (k[0], lo, hi)
            pid = probe_ids.setdefault(pk, len(probe_ids))
            members[pid].append(k)
        probe_rows = [(pid, *key[0], key[1], lo, hi) for (key, lo, hi), pid in probe_ids.items()]
        probe_schema = T.StructType(
            [T.StructField("_pid", T.LongType())]
            + [T.StructField(f.name, f.dataType) for f in by_fields]
            + [T.StructField("variable", T.StringType()), T.StructField("_lo", T.DoubleType()), T.StructField("_hi", T.DoubleType())]
        )
        probes = spark.createDataFrame(probe_rows, probe_schema)
        cond = [long["variable"] == probes["variable"]] + [long[b].eqNullSafe(probes[b]) for b in by]
        # The probe table is bounded by (#groups x #columns x #ranks): safe to broadcast.
        joined = long.join(F.broadcast(probes), cond).where(
            (F.col("value") >= F.col("_lo")) & (F.col("value") <= F.col("_hi"))
        )
        if final:
            dist = joined.groupBy("_pid", "value").agg(F.count(F.lit(1)).alias("c")).collect()
            per = defaultdict(list)
            for r in dist:
                per[r["_pid"]].append((r["value"], r["c"]))
            for pid, ks in members.items():
                vals = sorted(per[pid])
                for k in ks:
                    lo, hi, below, inside = state.pop(k)
                    target = k[1] - below
                    acc = 0
                    for v, c in vals:
                        if acc + c > target:
                            values[k] = (v, below + acc, c)
                            break
                        acc += c
            break
        b = _bucket(F.col("value"), F.col("_lo"), F.col("_hi"), buckets)
        hist = (
            joined.groupBy("_pid", b.alias("_b"))
            .agg(F.count(F.lit(1)).alias("c"), F.min("value").alias("mn"), F.max("value").alias("mx"))
            .collect()
        )
        per = defaultdict(list)
        for r in hist:
            per[r["_pid"]].append((r["_b"], r["c"], r["mn"], r["mx"]))
        for pid, ks in members.items():
            bins = sorted(per[pid])
            for k in ks:
                lo, hi, below, inside = state[k]
                acc = below
                for _, c, mn, mx in bins:
                    if acc + c > k[1]:
                        state[k] = [mn, mx, acc, c]
                        break
                    acc += c
    return values


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    buckets: int = 2048,
    few_rows: int = FEW_ROWS,
) -> tuple[dict, dict]:
    """Return ``(quantiles, counts)``.

    ``quantiles[(group, variable, p)]`` is the exact linear-interpolated
    quantile (None when the group has no value); ``counts[(group, variable)]``
    is the non-null count. ``group`` is a tuple of the ``by`` values; ``by``
    must be low-cardinality (classes, segments).
    """
    by, columns = list(by), list(columns)
    groups = [f"_g{i}" for i in range(len(by))]
    out: dict = {}
    counts: dict = {}
    for lo in range(0, len(columns), CHUNK):
        some = columns[lo : lo + CHUNK]
        named = [F.col(f"`{b}`").alias(g) for b, g in zip(by, groups)]
        wide = df.select(*named, *[_sound(c).alias(f"_v{i}") for i, c in enumerate(some)])
        found, n = _chunk_quantiles(wide, some, [float(p) for p in probs], groups, buckets, few_rows)
        out |= {(g, c, p): found[(g, c, float(p))] for (g, c) in n for p in probs}
        counts |= n
    return out, counts


def _sound(c: str) -> Column:
    """The column as doubles, NaN as NULL."""
    x = F.col(f"`{c}`").cast("double")
    return F.when(~F.isnan(x), x)


def _chunk_quantiles(wide: DataFrame, columns: Sequence[str], probs: Sequence[float], groups: Sequence[str], buckets: int, few_rows: int) -> tuple[dict, dict]:
    """``exact_quantiles`` of the columns ``_v0, _v1, ...`` by the columns ``groups``."""
    ends = sorted({min(1.0, max(0.0, p + e)) for p in probs for e in (-RANK_ERROR, RANK_ERROR)})
    aggs, picks = [], []
    for i in range(len(columns)):
        v = F.col(f"_v{i}")
        aggs += [F.count(v).alias(f"n{i}"), F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"), F.kll_sketch_agg_double(v, F.lit(SKETCH_K)).alias(f"k{i}")]
        named = F.kll_sketch_get_quantile_double(F.col(f"k{i}"), F.array(*[F.lit(e) for e in ends]))
        picks += [f"n{i}", f"lo{i}", f"hi{i}", F.when(F.col(f"n{i}") > 0, named).alias(f"q{i}")]
    counts, state, wanted, first = {}, {}, {}, {}
    for row in wide.groupBy(*groups).agg(*aggs).select(*groups, *picks).collect():
        g = tuple(row[x] for x in groups)
        for i, c in enumerate(columns):
            n, low, high = row[f"n{i}"], row[f"lo{i}"], row[f"hi{i}"]
            counts[(g, c)] = n
            if not n:
                continue
            at = dict(zip(ends, row[f"q{i}"]))
            for p in probs:
                h = (n - 1) * p
                r0 = int(math.floor(h))
                wanted[(g, c, p)] = (r0, min(r0 + 1, n - 1), h - r0)
                # a rank may lie a place beyond the probability's own: few values are searched as a whole
                a = low if p - RANK_ERROR <= 0 or n * RANK_ERROR < 2 else at[max(0.0, p - RANK_ERROR)]
                b = high if p + RANK_ERROR >= 1 or n * RANK_ERROR < 2 else at[min(1.0, p + RANK_ERROR)]
                for r in wanted[(g, c, p)][:2]:
                    if low == high:
                        state[((g, c), r)] = [low, high, 0, n]
                    else:
                        first.setdefault((g, i, a, b), set()).add(r)
            first_whole = (g, i, low, high)
            if first_whole in first:  # its counts are known
                for r in first.pop(first_whole):
                    state[((g, c), r)] = [low, high, 0, n]
    brackets = sorted(first, key=repr)
    if brackets:
        met = _count_brackets(wide, brackets, groups)
        for k, (g, i, a, b) in enumerate(brackets):
            below, low, middle, high = met[k]
            for r in first[(g, i, a, b)]:
                key, after = ((g, columns[i]), r), r - below
                if after < 0 or after >= low + middle + high:  # missed: the whole range
                    state[key] = [None, None, 0, counts[key[0]]]
                elif after < low:
                    state[key] = [a, a, below, low]
                elif after >= low + middle:
                    state[key] = [b, b, below + low + middle, high]
                else:
                    state[key] = [a, b, below, low + middle + high, low, middle]
        missed = [k for k, s in state.items() if s[0] is None]
        if missed:
            ranges = _ranges(wide, groups, len(columns))
            for (g, c), r in missed:
                state[((g, c), r)][:2] = ranges[(g, columns.index(c))]
    values = _resolve(wide, columns, groups, state, buckets, few_rows)
    out = {}
    for (g, c), n in counts.items():
        for p in probs:
            if not n:
                out[(g, c, p)] = None
                continue
            r0, r1, frac = wanted[(g, c, p)]
            v0, v1 = values[((g, c), r0)], values[((g, c), r1)]
            out[(g, c, p)] = v0 if r1 == r0 or frac == 0 else v0 + (v1 - v0) * frac
    return out, counts


def _ranges(wide: DataFrame, groups: Sequence[str], size: int) -> dict:
    rows = wide.groupBy(*groups).agg(*[f(f"_v{i}").alias(f"{n}{i}") for i in range(size) for n, f in (("lo", F.min), ("hi", F.max))]).collect()
    return {(tuple(r[x] for x in groups), i): [r[f"lo{i}"], r[f"hi{i}"]] for r in rows for i in range(size)}


def _with_ends(wide: DataFrame, brackets: Sequence[tuple], groups: Sequence[str]) -> tuple[DataFrame, list[tuple]]:
    """The rows, and for each slot its column and its two ends: literals without groups, else columns that a row per
    group brings along (a small table: #groups x #columns x #probabilities)."""
    if not groups:
        return wide, [(i, F.lit(float(a)), F.lit(float(b)), {(): k}) for k, (_, i, a, b) in enumerate(brackets)]
    per: dict = {}
    for k, (g, i, a, b) in enumerate(brackets):
        per.setdefault(g, {}).setdefault(i, []).append((k, a, b))
    slots: list = []  # (column, number within the column)
    for i in sorted({b[1] for b in brackets}):
        slots += [(i, j) for j in range(max(len(x.get(i, [])) for x in per.values()))]
    rows, of = [], [{} for _ in slots]
    for g, cols in per.items():
        row = list(g)
        for s, (i, j) in enumerate(slots):
            here = cols.get(i, [])
            row += here[j][1:] if j < len(here) else (None, None)
            if j < len(here):
                of[s][g] = here[j][0]
        rows.append(row)
    fields = [T.StructField(f"_k{x}", wide.schema[x].dataType) for x in groups]
    fields += [T.StructField(f"_{e}{s}", T.DoubleType()) for s in range(len(slots)) for e in "ab"]
    small = wide.sparkSession.createDataFrame(rows, T.StructType(fields))
    on = [wide[x].eqNullSafe(small[f"_k{x}"]) for x in groups]
    return wide.join(F.broadcast(small), on), [(i, F.col(f"_a{s}"), F.col(f"_b{s}"), of[s]) for s, (i, _) in enumerate(slots)]


def _count_brackets(wide: DataFrame, brackets: Sequence[tuple], groups: Sequence[str]) -> dict[int, tuple[int, int, int, int]]:
    """How many values are below, equal to the low end, between the ends and equal to the high end (0 if that is the low
    end) of each bracket (group, column number, low, high): one pass."""
    rows, slots = _with_ends(wide, brackets, groups)
    if groups:
        # a row per value and bracket that it is not above: many conditional counts by key leave compiled code
        places = []
        for s, (i, a, b, _) in enumerate(slots):
            v = F.col(f"_v{i}")
            places.append(F.when(v < a, s * 4).when(v == a, s * 4 + 1).when(v < b, s * 4 + 2).when(v == b, s * 4 + 3))
        rows = rows.select(*groups, F.explode(F.array(*places)).alias("c")).where("c is not null")
        counted: dict[int, list[int]] = {k: [0] * 4 for k in range(len(brackets))}
        for row in rows.groupBy(*groups, "c").count().collect():
            of = slots[row["c"] // 4][3]
            g = tuple(row[x] for x in groups)
            if g in of:
                counted[of[g]][row["c"] % 4] = row["count"]
        return {k: tuple(v) for k, v in counted.items()}
    aggs = []
    for s, (i, a, b, _) in enumerate(slots):
        v = F.col(f"_v{i}")
        tests = (v < a, v == a, (v > a) & (v < b), (v == b) & (a < b))
        aggs += [F.count_if(x).alias(f"c{s}_{j}") for j, x in enumerate(tests)]
    met = {}
    for row in rows.groupBy(*groups).agg(*aggs).collect():
        g = tuple(row[x] for x in groups)
        for s, (*_, of) in enumerate(slots):
            if g in of:
                met[of[g]] = tuple(row[f"c{s}_{j}"] for j in range(4))
    return met


def _resolve(wide: DataFrame, columns: Sequence[str], groups: Sequence[str], state: dict, buckets: int, few_rows: int) -> dict:
    """{((group, column), rank): value}: ranges that are few rows together are read in one pass, others narrowed first."""
    values = {k: s[0] for k, s in state.items() if s[0] == s[1]}
    ranges: dict = {}
    for (key, r), (a, b, below, inside, *ends) in state.items():
        if a != b:  # with its ends counted, only what is between them is read
            low, middle = ends or (0, inside)
            ranges.setdefault((key[0], columns.index(key[1]), a, b), [below + low, middle, bool(ends), []])[3].append(r)
    if not ranges:
        return values
    if sum(x[1] for x in ranges.values()) > few_rows:
        long = to_long(wide.withColumnsRenamed({f"_v{i}": c for i, c in enumerate(columns)}), columns, groups)
        left = {k: s[:4] for k, s in state.items() if s[0] != s[1]}
        found = select_ranks(long, groups, [wide.schema[x] for x in groups], left, buckets, few_rows)
        return values | {k: v[0] for k, v in found.items()}
    brackets = sorted(ranges, key=repr)
    rows, slots = _with_ends(wide, brackets, groups)
    inside = []
    for s, (i, a, b, _) in enumerate(slots):
        v = F.col(f"_v{i}")
        inside.append(F.when((v >= a) & (v <= b), F.struct(F.lit(s).alias("s"), v.alias("v"))))
    met = rows.select(*groups, F.explode(F.filter(F.array(*inside), lambda x: x.isNotNull())).alias("x"))
    per = defaultdict(list)
    for row in met.groupBy(*groups, F.col("x.s").alias("s"), F.col("x.v").alias("v")).agg(F.count("*").alias("c")).collect():
        of = slots[row["s"]][3]
        g = tuple(row[x] for x in groups)
        if g in of:
            per[of[g]].append((row["v"], row["c"]))
    for k, bracket in enumerate(brackets):
        below, _, open_, wanted = ranges[bracket]
        g, i = bracket[:2]
        found = sorted(x for x in per[k] if not open_ or bracket[2] < x[0] < bracket[3])
        for r in wanted:
            before = below
            for v, c in found:
                if before + c > r:
                    values[((g, columns[i]), r)] = v
                    break
                before += c
    return values


def approx_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], accuracy: int = 10_000) -> dict[str, dict[float, float | None]]:
    """One-pass ``percentile_approx`` (rank error <= n / accuracy): only on
    request, e.g. for a first look at a very large table."""
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), list(probs), accuracy).alias(c) for c in columns]).first()
    return {c: ({p: None for p in probs} if row[c] is None else dict(zip(probs, row[c]))) for c in columns}


def column_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], method: str = "exact", **kw
) -> dict[str, dict[float, float | None]]:
    """Ungrouped form: ``{column: {p: value}}`` (None for an all-NULL column).

    ``method="exact"`` (default) selects ranks and interpolates linearly;
    ``method="approx"`` runs one ``percentile_approx`` pass instead."""
    if method == "approx":
        return approx_quantiles(df, columns, probs, kw.get("accuracy", 10_000))
    q, _ = exact_quantiles(df, columns, probs, **kw)
    res: dict[str, dict[float, float | None]] = {c: {p: None for p in probs} for c in columns}
    for ((), var, p), v in q.items():
        res[var][p] = v
    return res


def medians(df: DataFrame, columns: Sequence[str], **kw) -> dict[str, float | None]:
    return {c: d[0.5] for c, d in column_quantiles(df, columns, [0.5], **kw).items()}
