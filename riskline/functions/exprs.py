"""Scalar column expressions (all JVM-side, codegen-friendly; no UDFs).

Banding, codes, labels and keys used across the operators. Every function
returns a ``Column`` so callers compose them inside one projection.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# ---------------------------------------------------------------------------
# Significance stars: p < 0.001 "***", p < 0.01 "**", p < 0.05 "*", else "ns".
STAR_CUTS = [(0.001, "***"), (0.01, "**"), (0.05, "*")]
STAR_ELSE = "ns"
# Cramer's V effect category: < 0.1 negligible, < 0.3 small, < 0.5 moderate, else large.
CRAMER_CUTS = [(0.1, "negligible"), (0.3, "small"), (0.5, "moderate")]
CRAMER_ELSE = "large"
# Importance label: p >= .05 Non-Significant; else by effect: < .1 Insignificant, < .2 Small, < .5 Moderate, else Strong Significance.
NOT_SIGNIFICANT = "Non-Significant"
IMPORTANCE_CUTS = [(0.1, "Insignificant"), (0.2, "Small Significance"), (0.5, "Moderate Significance")]
IMPORTANCE_ELSE = "Strong Significance"
# Correlation strength bands on |r|: < .2 Very Weak, < .4 Weak, < .6 Moderate, < .8 Strong, else Very Strong.
CORR_STRENGTH_CUTS = [(0.2, "Very Weak"), (0.4, "Weak"), (0.6, "Moderate"), (0.8, "Strong")]
CORR_STRENGTH_ELSE = "Very Strong"
# Age bands [0,45,55,65,120) and BMI bands [0,18.5,25,30,inf), both left-closed.
AGE_EDGES = [0, 45, 55, 65, 120]
BMI_EDGES = [0, 18.5, 25, 30, math.inf]
# Smallest p-value used before a logarithm.
P_FLOOR = 1e-300


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def threshold_label(x: str | Column, cuts: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """``CASE WHEN x < t1 THEN l1 WHEN x < t2 THEN l2 ... ELSE otherwise END`` (NULL stays NULL)."""
    x = _col(x)
    expr = None
    for t, label in cuts:
        expr = F.when(x < t, label) if expr is None else expr.when(x < t, label)
    return F.when(x.isNull(), F.lit(None)).otherwise(expr.otherwise(otherwise))


def significance_stars(p: str | Column) -> Column:
    """B25."""
    return threshold_label(p, STAR_CUTS, STAR_ELSE)


def cramer_effect(v: str | Column) -> Column:
    """B26."""
    return threshold_label(v, CRAMER_CUTS, CRAMER_ELSE)


def corr_strength(r: str | Column) -> Column:
    """Band of |r|."""
    return threshold_label(F.abs(_col(r)), CORR_STRENGTH_CUTS, CORR_STRENGTH_ELSE)


def usefulness_label(p: str | Column, effect: str | Column) -> Column:
    """P >= .05 Non-Significant; else effect < .1 / .2 / .5 bands."""
    p, e = _col(p), _col(effect)
    return F.when(p >= 0.05, NOT_SIGNIFICANT).otherwise(threshold_label(e, IMPORTANCE_CUTS, IMPORTANCE_ELSE))


def useful_flag(p: str | Column, v: str | Column) -> Column:
    """Significant (p < .05) and non-negligible (V >= .1)."""
    return F.when((_col(p) < 0.05) & (_col(v) >= 0.1), "Yes").otherwise("No")


def valid_test_flag(min_expected: str | Column) -> Column:
    """Chi-square approximation valid when every expected count >= 5."""
    return F.when(_col(min_expected) >= 5, "Yes").otherwise("No")


def rate_gap_label(gap_points: str | Column) -> Column:
    """Category-rate spread above 10 percentage points."""
    return F.when(_col(gap_points) > 10, "useful").otherwise("limited")


def neg_log10(p: str | Column) -> Column:
    """-log10(p) with p <= 0 clamped to 1e-300."""
    p = _col(p)
    return -F.log10(F.when(p <= 0, F.lit(P_FLOOR)).otherwise(p))


def importance_score(p: str | Column, effect: str | Column) -> Column:
    """Effect x -log10(p) when p < .05, else 0."""
    p = _col(p)
    return F.when(p < 0.05, _col(effect) * neg_log10(p)).otherwise(F.lit(0.0))


def cut_code(x: str | Column, edges: Sequence[float], missing_code: int | None = -1) -> Column:
    """Left-closed bands ``[e0,e1), [e1,e2), ...`` as an int code.

    Values outside ``[e0, e_last)`` and NULL get ``missing_code`` (-1 by
    default, as ordinal codes of a categorical do; ``None`` keeps NULL).
    The last upper edge is excluded, unlike ``Bucketizer``.
    """
    x = _col(x)
    expr = None
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        cond = x >= lo
        if not math.isinf(hi):
            cond = cond & (x < hi)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    fallback = F.lit(None).cast("int") if missing_code is None else F.lit(missing_code)
    return expr.otherwise(fallback).cast("int")


def row_sum_skip_null(cols: Sequence[str | Column]) -> Column:
    """Row-wise sum that treats NULL as 0 (pandas ``sum(axis=1)``)."""
    total = None
    for c in cols:
        t = F.coalesce(_col(c), F.lit(0))
        total = t if total is None else total + t
    return total


def recode_map(x: str | Column, mapping: Mapping[object, int], strict: bool = True, name: str = "value") -> Column:
    """B2: dictionary recode; strict mode fails the job on an unmapped/NULL value."""
    x = _col(x)
    expr = None
    for k, v in mapping.items():
        expr = F.when(x == F.lit(k), F.lit(v)) if expr is None else expr.when(x == F.lit(k), F.lit(v))
    if strict:
        expr = expr.otherwise(F.raise_error(F.concat(F.lit(f"unmapped {name}: "), F.coalesce(x.cast("string"), F.lit("NULL")))))
    return expr.cast("int")


def strict_int(x: str | Column, name: str = "value") -> Column:
    """Integer cast that fails on NULL; fractions truncate as ``astype(int)`` does."""
    x = _col(x)
    return F.when(x.isNull(), F.raise_error(F.lit(f"NULL in strict integer column {name}"))).otherwise(x.cast("int"))


def nullable_int(x: str | Column, name: str = "value") -> Column:
    """Nullable bigint that keeps NULL and refuses fractional values."""
    x = _col(x)
    return (
        F.when(x.isNull(), F.lit(None).cast("bigint"))
        .when(x.cast("double") != F.floor(x.cast("double")), F.raise_error(F.lit(f"fractional value in integer column {name}")))
        .otherwise(x.cast("bigint"))
    )


def round_report(x: str | Column, digits: int = 2) -> Column:
    """Half-to-even rounding of report values (``.round(2)`` of a table)."""
    return F.bround(_col(x), digits)


def run_key(*parts: str | Column) -> Column:
    """``a__b__c`` run identifier (strings are literals; pass ``F.col(..)`` for column parts)."""
    return F.concat_ws("__", *[p if isinstance(p, Column) else F.lit(p) for p in parts])


def params_json_column(*cols: str) -> Column:
    """B32/H: sorted-key JSON of the named columns of a row (NULL values are left out)."""
    return F.to_json(F.struct(*[F.col(c) for c in sorted(cols)]))


def params_json(params: Mapping[str, object]) -> str:
    """Sorted-key JSON of a parameter combination."""
    return json.dumps(dict(params), sort_keys=True)
