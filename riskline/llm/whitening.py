"""Embedding whitening through the exact characteristic polynomial (operator 11).

The components of integer vectors' covariance, from exact integers all the way to the last rounding:

1. Integers. Each entry c becomes x = floor(64 c) + 1,000,000; a shift leaves covariances as they are, so tasks work on
   y = floor(64 c). Every partition adds up y and y y' exactly (float products only where they stay below 2^53, Python
   integers else) and sends them as limbs of 32 bits; Spark sums the limbs. The scatter M = n sum(y y') - S S' is an
   integer matrix, V = M / n^2.
2. Characteristic polynomial of M. Modulo primes below 2^31 a task brings M to Hessenberg form and reads off the
   polynomial; there are as many primes as the bound of the coefficients needs, dealt over the tasks. The residues of a
   coefficient meet in one group, which rebuilds it by Chinese remaindering.
3. Roots. All roots are real, so Descartes' count of sign changes after a shift by t is the exact number of roots above
   t. Bisection by that count isolates the k-th largest root, bisection and Newton steps on the integers refine it to
   ``DIGITS`` digits. Each component is a task's row of its own.
4. Null space. M - e I is factorised with ``DIGITS`` + 30 digits and full pivoting, and inverse iteration in its null
   space gives the component, correct to double precision also between close eigenvalues. Equal roots share a group and
   get an orthonormal basis.
5. Whitening. One pass over the rows projects them; a pass before it gives the covariance of just these projections.

Nothing here grows with the rows but the passes themselves: the driver holds numbers by dimension only.

Rows whose vector is null, or holds null or non-finite entries, are dropped; so are empty vectors, and vectors of another
length than most of the remaining ones have (ties: the longer). Entries beyond +-2^61 count as that. Components without
variance (exact zeros) cannot be whitened and are left out: n rows give n - 1 components at most, one row or equal rows
none. ``deviation`` is null where it exceeds a long. Repeated rows count each time, null ids are kept. An empty table gives
no rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
from decimal import Decimal, localcontext
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskline.llm.embedding_dedup import matrices

SCALE, SHIFT, BOUND = 64, 1_000_000, 2.0**61
#: Significant digits of the eigenvalues.
DIGITS = 60
#: Limbs of a sum: 32 bits each, in signed longs.
LIMBS = 8
#: Primes that a task takes at a time.
PRIMES = 8


def integers(vectors: np.ndarray) -> np.ndarray:
    """floor(64 c) of doubles as longs."""
    return np.floor(np.clip(vectors * float(SCALE), -BOUND, BOUND)).astype(np.int64)


def exact_products(y: np.ndarray) -> list[list[int]] | np.ndarray:
    """Integer y' y."""
    most = int(np.abs(y).max(initial=0))
    if most * most * max(1, len(y)) < 1 << 53:
        f = y.astype(float)
        return (f.T @ f).astype(np.int64)
    big = y.astype(object)
    return big.T @ big


def _limbs(value: int) -> list[int]:
    sign, value = (-1, -value) if value < 0 else (1, value)
    return [sign * ((value >> (32 * k)) & 0xFFFFFFFF) for k in range(LIMBS)]


def _sums(dim: int):
    """Per partition: the sums of y (row -1) and of y y' (upper half), in limbs."""

    def run(batches):
        total, square, n = [0] * dim, None, 0
        low = np.zeros((dim, dim), np.int64)
        for batch in batches:
            for _, vectors in matrices(batch.column(0)):
                y = integers(vectors)
                n += len(y)
                total = [a + b for a, b in zip(total, y.astype(object).sum(axis=0), strict=True)] if len(y) else total
                part = exact_products(y)
                if part.dtype == np.int64:
                    low += part
                    if np.abs(low).max(initial=0) > 1 << 61:
                        square = low.astype(object) + (0 if square is None else square)
                        low = np.zeros((dim, dim), np.int64)
                else:
                    square = part + (0 if square is None else square)
        if not n:
            return
        square = low.astype(object) + (0 if square is None else square)
        rows = [(-1, j, _limbs(int(total[j]))) for j in range(dim)]
        rows += [(i, j, _limbs(int(square[i][j]))) for i in range(dim) for j in range(i, dim)]
        rows.append((-2, 0, _limbs(n)))
        columns = {"i": [r[0] for r in rows], "j": [r[1] for r in rows]}
        columns |= {f"l{k}": [r[2][k] for r in rows] for k in range(LIMBS)}
        yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int32() if k in "ij" else pa.int64()) for k, v in columns.items()})

    return run


def scatter(vectors: DataFrame, dim: int) -> tuple[int, list[int], list[list[int]]]:
    """(n, S, M) of the vectors, exact: dim + dim^2 / 2 numbers reach the driver."""
    schema = "i int, j int, " + ", ".join(f"l{k} long" for k in range(LIMBS))
    sums = vectors.mapInArrow(_sums(dim), schema).groupBy("i", "j").agg(*(F.sum(f"l{k}").alias(f"l{k}") for k in range(LIMBS)))
    n, s, q = 0, [0] * dim, [[0] * dim for _ in range(dim)]
    for row in sums.collect():
        value = sum(int(row[k + 2]) << (32 * k) for k in range(LIMBS))
        if row[0] == -2:
            n = value
        elif row[0] == -1:
            s[row[1]] = value
        else:
            q[row[0]][row[1]] = q[row[1]][row[0]] = value
    return n, s, [[n * q[i][j] - s[i] * s[j] for j in range(dim)] for i in range(dim)]


def primes_below(top: int, count: int) -> list[int]:
    """The largest primes below ``top`` (Miller-Rabin, exact below 3 * 10^9 with these bases)."""

    def prime(p: int) -> bool:
        odd, twos = p - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        for a in (2, 3, 5, 7):
            x = pow(a, odd, p)
            if x not in (1, p - 1) and all((x := x * x % p) != p - 1 for _ in range(twos - 1)):
                return False
        return True

    out, p = [], top - 1 if top % 2 == 0 else top - 2
    while len(out) < count:
        if prime(p):
            out.append(p)
        p -= 2
    return out


def characteristic_mod(m: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Coefficients (constant first) of det(xI - m[k]) modulo p[k], for matrices m (primes, dim, dim) of longs."""
    h = m.copy()
    count, dim, _ = h.shape
    every = np.arange(count)
    mod = p[:, None]
    for k in range(1, dim - 1):
        pivot = k + np.argmax(h[:, k:, k - 1] != 0, axis=1)
        for axis in (1, 2):  # a similarity: rows, then columns
            a = h[every, pivot].copy() if axis == 1 else h[every, :, pivot].copy()
            if axis == 1:
                h[every, pivot] = h[:, k]
                h[:, k] = a
            else:
                h[every, :, pivot] = h[:, :, k]
                h[:, :, k] = a
        inverse = np.array([pow(int(x), -1, int(q)) if x else 0 for x, q in zip(h[:, k, k - 1], p, strict=True)], np.int64)
        u = h[:, k + 1 :, k - 1] * inverse[:, None] % mod
        h[:, k + 1 :] = (h[:, k + 1 :] - u[:, :, None] * h[:, k, None] % mod[:, :, None]) % mod[:, :, None]
        # column k gains the sum of u times the columns below; products are cut to p before they are added
        gain = (h[:, :, k + 1 :] * u[:, None] % mod[:, :, None]).sum(axis=2)
        h[:, :, k] = (h[:, :, k] + gain) % mod
    c = np.zeros((dim + 1, count, dim + 1), np.int64)
    c[0, :, 0] = 1
    for k in range(1, dim + 1):
        c[k, :, 1:] = c[k - 1, :, :-1]
        c[k] = (c[k] - h[:, k - 1, k - 1][:, None] * c[k - 1]) % mod
        t = np.ones(count, np.int64)
        for i in range(1, k):
            t = t * h[:, k - i, k - i - 1] % p
            c[k] = (c[k] - (t * h[:, k - i - 1, k - 1] % p)[:, None] * c[k - i - 1]) % mod
    return c[dim]


def characteristic_polynomial(spark: SparkSession, m: list[list[int]]) -> list[int]:
    """Integer coefficients (constant first) of det(xI - m) for a symmetric m without negative eigenvalues."""
    dim = len(m)
    trace = max(1, sum(m[i][i] for i in range(dim)))
    # the k-th symmetric function of the eigenvalues is comb(dim, k) (trace / dim)^k at most (Maclaurin)
    bits = max(math.log2(math.comb(dim, k)) + k * math.log2(Fraction(trace, dim)) for k in range(dim + 1))
    primes = primes_below(1 << 31, math.ceil((bits + 8) / 30.99) + 1)

    def residues(batches):
        for batch in batches:
            every = batch["p"].to_numpy()
            for lo in range(0, len(every), PRIMES):
                p = every[lo : lo + PRIMES]
                cut = np.array([[[x % int(q) for x in row] for row in m] for q in p], np.int64)
                c = characteristic_mod(cut, p)
                yield pd.DataFrame({"k": np.tile(np.arange(dim + 1), len(p)), "p": np.repeat(p, dim + 1), "r": c.ravel()})

    def rebuilt(rows: pd.DataFrame) -> pd.DataFrame:
        value, product = 0, 1
        for p, r in zip(rows["p"].tolist(), rows["r"].tolist(), strict=True):
            value += product * ((r - value) * pow(product, -1, p) % p)
            product *= p
        value -= product if 2 * value > product else 0
        return pd.DataFrame({"k": [int(rows["k"].iloc[0])], "c": [str(value)]})

    tasks = max(1, min(len(primes) // PRIMES, 4 * spark.sparkContext.defaultParallelism))
    dealt = spark.createDataFrame(pd.DataFrame({"p": primes})).repartition(tasks)
    got = dealt.mapInPandas(residues, "k int, p long, r long").groupBy("k").applyInPandas(rebuilt, "k int, c string").collect()
    return [int(c) for _, c in sorted((r["k"], r["c"]) for r in got)]


def roots_above(poly: list[int], t: int, bits: int) -> int:
    """How many roots of a real-rooted polynomial exceed t / 2^bits: the sign changes after a shift, on integers."""
    degree = len(poly) - 1
    c = [x << (bits * (degree - k)) for k, x in enumerate(poly)]
    for i in range(degree):
        for k in range(degree - 1, i - 1, -1):
            c[k] += t * c[k + 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def _value(poly: list[int], t: int, bits: int) -> int:
    """poly(t / 2^bits) * 2^(bits * degree)."""
    v, shift = 0, 0
    for x in reversed(poly):
        v = v * t + (x << shift)
        shift += bits
    return v


def kth_root(poly: list[int], k: int, digits: int = DIGITS) -> tuple[int, int, int, int]:
    """(lo, bits, above, past): the k-th largest root (from 1) of a real-rooted polynomial is in (lo, lo + 1] / 2^bits, known to
    ``digits`` digits. ``above - past`` roots are not told from it. k is at most the number of positive roots."""
    bits, lo, hi = 0, 0, 1
    while roots_above(poly, hi, 0) >= k:
        lo, hi = hi, hi * 2
    need = math.ceil(digits * math.log2(10)) + 1
    above_lo, above_hi = (roots_above(poly, x, bits) for x in (lo, hi))
    # bisect by the count until the root is alone and known to some bits, or is known to all of them
    while (above_lo - above_hi > 1 or lo.bit_length() < 12) and (lo.bit_length() < need or hi - lo > 1):
        if hi - lo == 1:
            bits, lo, hi = bits + 1, 2 * lo, 2 * hi
        mid = (lo + hi) // 2
        above = roots_above(poly, mid, bits)
        if above >= k:
            lo, above_lo = mid, above
        else:
            hi, above_hi = mid, above
    if above_lo - above_hi == 1:
        # a simple root: signs decide; Newton steps on the integers, each kept only inside its bracket
        derivative = [i * x for i, x in enumerate(poly)][1:]
        at_hi = _value(poly, hi, bits)
        exact = at_hi == 0
        while not exact and (lo.bit_length() < need or hi - lo > 1):
            grow = min(lo.bit_length(), 64) if hi - lo < 4 else 0
            bits, lo, hi = bits + grow, lo << grow, hi << grow
            mid = (lo + hi) // 2
            slope = _value(derivative, mid, bits)
            guess = mid - _value(poly, mid, bits) // slope if slope else mid
            width = max(1, (hi - lo) >> 8)
            for t in (guess - width, guess + width, mid):
                if lo < t < hi:
                    v = _value(poly, t, bits)
                    if v == 0:
                        exact, hi = True, t
                        break
                    if (v > 0) == (at_hi > 0):
                        hi = t
                    else:
                        lo = t
        if exact:
            grow = max(0, need + 1 - hi.bit_length())
            bits, lo = bits + grow, (hi << grow) - 1
    # equal grids for equal roots
    extra = lo.bit_length() - need
    if extra > 0:
        bits, lo = bits - extra, lo >> extra
    return lo, bits, above_lo, above_hi


def null_vectors(m: list[list[int]], root: Fraction, count: int, digits: int = DIGITS) -> np.ndarray:
    """``count`` orthonormal vectors (rows) of the null space of m - root I, by inverse iteration, as doubles.
    The largest entry of each is positive."""
    dim = len(m)
    with localcontext() as context:
        context.prec = digits + 30
        e = Decimal(root.numerator) / Decimal(root.denominator)
        a = np.array([[Decimal(x) for x in row] for row in m], dtype=object)
        a[np.arange(dim), np.arange(dim)] -= e
        tiny = max(map(abs, a.ravel())) * Decimal(10) ** -(digits + 20) or Decimal(10) ** -digits
        rows, columns = list(range(dim)), list(range(dim))
        for k in range(dim):  # factorised with full pivoting: the null space ends in the last pivots
            i, j = divmod(int(np.argmax(np.abs(a[k:, k:]))), dim - k)
            for axis, other, order in ((0, k + i, rows), (1, k + j, columns)):
                if other != k:
                    order[k], order[other] = order[other], order[k]
                    if axis == 0:
                        a[[k, other]] = a[[other, k]]
                    else:
                        a[:, [k, other]] = a[:, [other, k]]
            if abs(a[k, k]) < tiny:
                a[k, k] = tiny
            if k + 1 < dim:
                a[k + 1 :, k] /= a[k, k]
                a[k + 1 :, k + 1 :] -= np.multiply.outer(a[k + 1 :, k], a[k, k + 1 :])
        x = [[Decimal(int(v)) for v in np.random.default_rng(11 + g).integers(1, 1000, dim)] for g in range(count)]
        for _ in range(3):
            found: list[np.ndarray] = []
            for start in x:
                b = np.array(start, dtype=object)[rows]
                for k in range(1, dim):
                    b[k] -= (a[k, :k] * b[:k]).sum()
                for k in range(dim - 1, -1, -1):
                    b[k] = (b[k] - ((a[k, k + 1 :] * b[k + 1 :]).sum() if k + 1 < dim else 0)) / a[k, k]
                back = np.empty(dim, dtype=object)
                back[columns] = b
                back /= max(map(abs, back))
                for _ in range(2):
                    for f in found:
                        back = back - f * (f * back).sum()
                found.append(back / (back * back).sum().sqrt())
            x = found
        out = np.array([[float(v) for v in f] for f in x])
    largest = np.argmax(np.abs(out), axis=1)
    return out * np.sign(out[np.arange(count), largest])[:, None]


def components(spark: SparkSession, m: list[list[int]], poly: list[int], most: int) -> tuple[np.ndarray, list[Fraction]]:
    """(components as rows, eigenvalues of m), by falling eigenvalue; eigenvalues of zero are left out."""
    dim = len(m)
    zeros = next(k for k, x in enumerate(poly) if x)
    count = min(most, dim - zeros)
    if not count:
        return np.zeros((0, dim)), []
    reduced = poly[zeros:]

    def isolate(batches):
        for batch in batches:
            rows = [(k, *kth_root(reduced, k)) for k in batch["k"].tolist()]
            yield pd.DataFrame(
                {"k": [r[0] for r in rows], "lo": [str(r[1]) for r in rows], "bits": [r[2] for r in rows], "above": [r[3] for r in rows], "past": [r[4] for r in rows]}
            )

    def vectors(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("k")
        root = Fraction(2 * int(rows["lo"].iloc[0]) + 1, 2) / Fraction(2) ** int(rows["bits"].iloc[0])
        multiple = int(rows["above"].iloc[0] - rows["past"].iloc[0])
        found = null_vectors(m, root, max(multiple, len(rows)))[: len(rows)]
        return pd.DataFrame({"k": rows["k"], "e": f"{root.numerator}/{root.denominator}", "vector": [list(f) for f in found]})

    numbers = spark.createDataFrame(pd.DataFrame({"k": range(1, count + 1)})).repartition(min(count, 4 * spark.sparkContext.defaultParallelism), "k")
    isolated = numbers.mapInPandas(isolate, "k long, lo string, bits long, above long, past long")
    got = isolated.groupBy("lo", "bits").applyInPandas(vectors, "k long, e string, vector array<double>").collect()
    got.sort(key=lambda r: r["k"])
    return np.array([r["vector"] for r in got]), [Fraction(r["e"]) for r in got]


def _projected(vectors: np.ndarray, n: int, s: list[int], w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The integers y, and the whitened rows: w has the components over the root of their variance."""
    y = integers(vectors)
    whole = np.array([x // n for x in s], dtype=np.int64)
    part = np.array([float(Fraction(x % n, n)) for x in s])
    return y, ((y - whole).astype(float) - part) @ w.T


def _moments(n: int, s: list[int], w: np.ndarray):
    def run(batches):
        k = len(w)
        total, square = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for _, vectors in matrices(batch.column(0)):
                z = _projected(vectors, n, s, w)[1]
                total += z.sum(axis=0)
                square += z.T @ z
        i, j = np.triu_indices(k)
        i, j, v = np.append(i, np.full(k, -1)), np.append(j, np.arange(k)), np.append(square[np.triu_indices(k)], total)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(v)], ["i", "j", "v"])

    return run


def _deviation(y: np.ndarray, n: int, s: list[int]) -> list[int | None]:
    """Sum of (n y - S)^2 of each row, exact."""
    most = max(int(np.abs(y).max(initial=0)) * n, max(map(abs, s)))
    if (2 * most) ** 2 * len(s) < 1 << 62:
        d = y * n - np.array(s, np.int64)
        return (d * d).sum(axis=1).tolist()
    d = y.astype(object) * n - np.array(s, dtype=object)
    return [x if x < 1 << 63 else None for x in (d * d).sum(axis=1)]


def _rows(n: int, s: list[int], w: np.ndarray, explained: list[float], error: float):
    k = len(w)

    def run(batches):
        for batch in batches:
            for rows, vectors in matrices(batch.column(1)):
                for lo in range(0, len(rows), 4096):
                    y, z = _projected(vectors[lo : lo + 4096], n, s, w)
                    at = np.repeat(rows[lo : lo + 4096], k)
                    size = len(z)
                    deviation = pa.array(_deviation(y, n, s), pa.int64()).take(pa.array(np.repeat(np.arange(size), k)))
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(at)),
                            pa.array(np.tile(np.arange(1, k + 1), size), pa.int32()),
                            pa.array(np.full(size * k, n), pa.int64()),
                            deviation,
                            pa.array(z.ravel()),
                            pa.array(np.tile(explained, size)),
                            pa.array(np.full(size * k, error)),
                        ],
                        ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                    )

    return run


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", most: int = 32) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: one row per remaining row and component
    up to ``most``. See the module's text for the method and for odd input."""
    spark = df.sparkSession
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rename = lambda out: out.withColumnRenamed("id", "vec_id")
    rows = df.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{vec_col}`").cast("array<double>").alias("_vec"))
    sound = F.forall("_vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & (F.size("_vec") > 0)
    rows = rows.filter(F.col("_vec").isNotNull() & sound)
    length = rows.groupBy(F.size("_vec").alias("d")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), F.desc("d")).first()
    if length is None:
        return rename(spark.createDataFrame([], schema))
    rows = rows.filter(F.size("_vec") == length["d"])
    n, s, m = scatter(rows.select("_vec"), length["d"])
    vectors, roots = components(spark, m, characteristic_polynomial(spark, m), most)
    if not roots:
        return rename(spark.createDataFrame([], schema))
    trace = sum(m[i][i] for i in range(len(m)))
    explained = [float(e / trace) for e in roots]
    w = vectors / np.array([math.sqrt(e / (n * n)) for e in roots])[:, None]
    moments = rows.select("_vec").mapInArrow(_moments(n, s, w), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    total, square = np.zeros(len(w)), np.zeros((len(w), len(w)))
    for i, j, v in moments:
        if i < 0:
            total[j] = v / n
        else:
            square[i, j] = square[j, i] = v / n
    error = float(np.abs(square - np.outer(total, total) - np.eye(len(w))).max())
    return rename(rows.mapInArrow(_rows(n, s, w, explained, error), schema))
