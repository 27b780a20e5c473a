"""Long-format helper: many per-column statistics become one grouped job.

Instead of one scan per column (what a per-column loop does), columns are
unpivoted into ``(by..., variable, value)`` inside the scan stage and every
statistic is a ``groupBy(variable, ...)`` with map-side partial aggregation,
so the shuffle carries at most (#variables x #groups) rows per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_long(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (),
    value_type: str = "double",
    drop_nulls: bool = True,
) -> DataFrame:
    """``(by..., variable, value)`` with every listed column cast to ``value_type``."""
    if not columns:
        raise ValueError("no columns to unpivot")
    casted = df.select(*by, *[F.col(c).cast(value_type).alias(c) for c in columns])
    long = casted.unpivot(list(by), list(columns), "variable", "value")
    return long.where(F.col("value").isNotNull()) if drop_nulls else long


def wide_agg_to_long(row_df: DataFrame, columns: Sequence[str], stats: Sequence[str], sep: str = "__") -> DataFrame:
    """Turn a one-row frame with ``{col}{sep}{stat}`` fields into one row per column.

    Used after a single wide ``agg`` (one pass over the data computing every
    statistic of every column): the transposition runs on the one-row result.
    """
    structs = [
        F.struct(F.lit(c).alias("variable"), *[F.col(f"`{c}{sep}{s}`").alias(s) for s in stats]) for c in columns
    ]
    return row_df.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def join_small(left: DataFrame, small: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Join a table of one row per key (broadcast) on keys that may be NULL; the keys stay the left side's."""
    keys = list(keys)
    named = small.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)], *[c for c in small.columns if c not in keys])
    cond = [F.col(f"`{k}`").eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return left.join(F.broadcast(named), cond, how).drop(*[f"_k{i}" for i in range(len(keys))])
