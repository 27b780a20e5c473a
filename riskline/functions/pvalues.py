"""Distribution tails for test p-values.

Spark SQL has no ``erfc`` or incomplete gamma, so tails are computed by a
vectorised pandas UDF over the (tiny) per-variable statistics table: one row
per tested variable, never per data row. Closed forms for integer degrees
of freedom keep them exact to double precision.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType


#: Half the statistic up to which the closed form neither overflows nor underflows.
_PLAIN_LIMIT = 600.0


def chi2_sf(x: float, dof: int) -> float:
    """Upper tail of the chi-square distribution, integer ``dof`` >= 0 (no freedom: 1, as the statistic is 0)."""
    if x is None or dof is None or (isinstance(x, float) and math.isnan(x)) or dof < 0:
        return float("nan")
    if dof == 0 or x <= 0:
        return 1.0
    if math.isinf(x):
        return 0.0
    h = x / 2.0
    if h > _PLAIN_LIMIT or dof > 2 * _PLAIN_LIMIT:
        return _chi2_sf_by_logs(h, dof)
    if dof % 2 == 0:
        # Q(m, h) = exp(-h) * sum_{i<m} h^i / i!
        term, total = 1.0, 1.0
        for i in range(1, dof // 2):
            term *= h / i
            total += term
        return min(1.0, math.exp(-h) * total)
    # odd: erfc(sqrt(h)) + exp(-h) * sum_{i=0}^{(dof-3)/2} h^(i+1/2) / Gamma(i+3/2)
    total = math.erfc(math.sqrt(h))
    if dof > 1:
        term = math.sqrt(h) / math.gamma(1.5)
        acc = term
        for i in range(1, (dof - 1) // 2):
            term *= h / (i + 0.5)
            acc += term
        total += math.exp(-h) * acc
    return min(1.0, total)


def _chi2_sf_by_logs(h: float, dof: int) -> float:
    """The same sums by logarithms of their terms, for statistics or degrees of freedom that leave the range of a double."""
    half = 0.5 if dof % 2 else 0.0
    i = np.arange((dof - 1) // 2 if dof % 2 else dof // 2)
    steps = np.log(np.maximum(i, 1) + half)
    steps[:1] = 0.0
    logs = (i + half) * math.log(h) - np.cumsum(steps) - math.lgamma(1.0 + half) - h
    first = math.erfc(math.sqrt(h)) if dof % 2 else 0.0
    if not len(logs):
        return first
    top = float(logs.max())
    return min(1.0, first + math.exp(top) * math.fsum(np.exp(logs - top))) if top > -745 else first


def norm_sf(z: float) -> float:
    """Upper tail of the standard normal."""
    return 0.5 * math.erfc(z / math.sqrt(2.0))


SMALLEST_NORMAL = 2.2250738585072014e-308


def flush(p: float) -> float:
    """Tails below the smallest normal double are reported as 0 (their
    logarithm would depend on subnormal rounding); the importance score then
    applies its 1e-300 floor."""
    return 0.0 if p < SMALLEST_NORMAL else p


@pandas_udf(DoubleType())
def _chi2_sf_udf(x: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([flush(chi2_sf(float(a), int(b))) if pd.notna(a) and pd.notna(b) else None for a, b in zip(x, dof)])


@pandas_udf(DoubleType())
def _two_sided_normal_udf(z: pd.Series) -> pd.Series:
    return pd.Series([flush(min(1.0, 2.0 * norm_sf(abs(float(a))))) if pd.notna(a) else None for a in z])


def chi2_pvalue(x: Column | str, dof: Column | str) -> Column:
    """p-value column of a chi-square statistic (apply to per-variable tables only)."""
    return _chi2_sf_udf(F.col(x) if isinstance(x, str) else x, F.col(dof) if isinstance(dof, str) else dof)


def exact_u_tail(m: int, n: int, u: int) -> float:
    """P(U <= u) of the Mann-Whitney U of two samples of m and n values without ties under the null hypothesis.

    The counts of rank arrangements with U = 0, 1, ..., u: the product of (1 - q^(n+i)) / (1 - q^i) for i = 1..m, of which
    only the powers up to u are kept; each factor is one running sum and one shifted difference."""
    m, n = min(m, n), max(m, n)
    counts = np.zeros(u + 1)
    counts[0] = 1.0
    for i in range(1, m + 1):
        if n + i <= u:
            counts[n + i :] -= counts[: u + 1 - n - i].copy()
        for first in range(min(i, u + 1)):
            counts[first::i] = np.cumsum(counts[first::i])
    return float(min(1.0, counts.sum() / math.comb(m + n, m)))


@pandas_udf(DoubleType())
def _exact_u_udf(n_0: pd.Series, n_1: pd.Series, u: pd.Series) -> pd.Series:
    return pd.Series([min(1.0, 2.0 * exact_u_tail(int(a), int(b), int(min(x, a * b - x)))) for a, b, x in zip(n_0, n_1, u)], dtype=float)


def exact_u_pvalue(n_0: Column, n_1: Column, u: Column) -> Column:
    """Two-sided p of U (of either sample) by the exact null distribution (apply to per-variable tables only)."""
    return _exact_u_udf(n_0, n_1, u)


def two_sided_normal_pvalue(z: Column | str) -> Column:
    """``2 * P(Z > |z|)`` capped at 1 (apply to per-variable tables only)."""
    return _two_sided_normal_udf(F.col(z) if isinstance(z, str) else z)
