"""Registry of named queries (one per operator of the survey) and their
DuckDB oracle SQL. ``__spark_entry__`` exposes it to the driver."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

DIGITS = 6


def round_half_away(c, digits: int = DIGITS):
    """``round(x, digits)`` computed as ``sign(x) * floor(|x| * 10^d + 0.5) / 10^d``
    on the binary value (SQL engines differ on half-way cases when rounding
    through a decimal string; this form gives the same double as DuckDB's
    ``round`` on a DOUBLE). Infinities and NULL pass through.

    A value that is half-way but for the last bits of a sum (0.0499185 as a mean of 60,000 numbers) would be
    rounded by the order of summation. So both engines first add 1e-12 of the value (1e-9 at most, a
    thousandth of the last digit): half-way values then always go away from zero (see ``steady_rounds``)."""
    m = float(10**digits)
    x = F.col(c) if isinstance(c, str) else c
    r = F.signum(x) * F.floor((F.abs(x) + F.least(F.abs(x) * 1e-12, F.lit(1e-9))) * m + 0.5) / m + 0.0  # no negative zero
    return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), x).otherwise(r)


def steady_rounds(sql: str, digits: int = DIGITS) -> str:
    """The SQL with the same step before each ``round(x, digits)``."""
    out, at, tail = [], 0, f", {digits}"
    for m in re.finditer(r"\bround\(", sql):
        if m.start() < at:
            continue
        depth, end = 1, m.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        inner = sql[m.end() : end - 1]
        if not inner.endswith(tail):
            continue
        x = steady_rounds(inner[: -len(tail)], digits)
        out += [sql[at : m.start()], f"round(({x}) + sign({x}) * least(abs({x}) * 1e-12, 1e-9), {digits})"]
        at = end
    return "".join(out) + sql[at:]


def present(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column to ``digits`` decimals (reports carry 6)."""
    cols = {
        f.name: round_half_away(F.col(f"`{f.name}`").cast("double"), digits)
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(cols) if cols else df


def query(name: str, sql: str | None = None, round_doubles: bool = True):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` (with its oracle SQL)."""

    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            return present(df) if round_doubles else df

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = steady_rounds(sql)
        return fn

    return deco
