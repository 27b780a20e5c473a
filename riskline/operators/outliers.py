"""Outlier profiling.

Bounds are fitted in one statistics pass (exact quartiles by rank selection,
or mean / population sigma) and applied as literals in a second pass that
computes every column's outlier count with conditional aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskline.operators.long import wide_agg_to_long
from riskline.operators.quantiles import column_quantiles

IQR_FACTOR = 1.5
Z_LIMIT = 3.0


@dataclass
class IqrBounds:
    q1: float | None
    q3: float | None

    @property
    def iqr(self):
        return None if self.q1 is None else self.q3 - self.q1

    @property
    def lower(self):
        return None if self.q1 is None else self.q1 - IQR_FACTOR * self.iqr

    @property
    def upper(self):
        return None if self.q1 is None else self.q3 + IQR_FACTOR * self.iqr

    def is_outlier(self, c: str | Column) -> Column:
        c = F.col(c) if isinstance(c, str) else c
        if self.q1 is None:
            return F.lit(False)
        return (c < F.lit(self.lower)) | (c > F.lit(self.upper))


def fit_iqr_bounds(df: DataFrame, columns: Sequence[str]) -> dict[str, IqrBounds]:
    q = column_quantiles(df, columns, [0.25, 0.75])
    return {c: IqrBounds(q[c][0.25], q[c][0.75]) for c in columns}


def outliers_iqr(df: DataFrame, column: str, bounds: IqrBounds | None = None) -> DataFrame:
    """The rows whose ``column`` lies outside [Q1 - 1.5 IQR, Q3 + 1.5 IQR]."""
    b = bounds or fit_iqr_bounds(df, [column])[column]
    return df.where(b.is_outlier(column))


def _count_summary(df: DataFrame, conds: dict[str, Column]) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("__n")] + [F.count_if(cond).alias(f"{c}__count") for c, cond in conds.items()]
    row = df.agg(*aggs)
    cols = list(conds)
    long = wide_agg_to_long(row.select("*", *[F.col("__n").alias(f"{c}__n") for c in cols]), cols, ["count", "n"])
    return long.select(
        F.col("variable").alias("column"),
        F.col("count").cast("bigint").alias("count"),
        F.when(F.col("n") > 0, F.col("count") / F.col("n") * 100).otherwise(F.lit(0.0)).alias("percentage"),
    ).orderBy(F.desc("count"), "column")  # a report of one row per column


def iqr_outlier_summary(df: DataFrame, columns: Sequence[str], bounds: dict[str, IqrBounds] | None = None) -> DataFrame:
    """``column, count, percentage`` where the denominator is all rows (nulls included)."""
    bounds = bounds or fit_iqr_bounds(df, columns)
    return _count_summary(df, {c: bounds[c].is_outlier(c) for c in columns})


def fit_moments(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float | None, float | None, int, int]]:
    """Per column ``(mean, population sigma, non-null count, row count)`` in one pass."""
    aggs = [F.count(F.lit(1)).alias("__n")]
    for c in columns:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__sd"), F.count(c).alias(f"{c}__cnt")]
    r = df.agg(*aggs).first()
    return {c: (r[f"{c}__mean"], r[f"{c}__sd"], r[f"{c}__cnt"], r["__n"]) for c in columns}


def zscore_outlier_summary(df: DataFrame, columns: Sequence[str], nan_policy: str = "omit") -> DataFrame:
    """D3: ``|z| > 3`` with population sigma.

    ``nan_policy="omit"`` scores the present values; ``"propagate"`` gives a
    count of 0 for any column holding a NULL (what a NaN-propagating z-score
    does). A zero sigma gives 0.
    """
    m = fit_moments(df, columns)
    conds = {}
    for c in columns:
        mean, sd, cnt, n = m[c]
        if sd is None or sd == 0 or (nan_policy == "propagate" and cnt < n):
            conds[c] = F.lit(False)
        else:
            conds[c] = F.abs(F.col(c) - F.lit(mean)) / F.lit(sd) > Z_LIMIT
    return _count_summary(df, conds)
