"""Missing-value profiling and simple imputation.

Imputation is split into ``fit`` (one statistics job, returns a few numbers
on the driver) and ``transform`` (one projection, no job), so the statistics
can come from the training split only; ``simple_imputation`` is both on the
same frame, as the reference does.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskline.operators.long import to_long, wide_agg_to_long
from riskline.operators.quantiles import medians


def missing_value_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: ``column, missing_values, percentage`` (of all rows), the most missing first, ties by name.

    One scan: ``count(*)`` and a null count per column in a single ``agg``;
    the transposition runs on the one-row result.
    """
    columns = list(columns or df.columns)
    aggs = [F.count(F.lit(1)).alias("__n")] + [
        F.count_if(F.col(c).isNull()).alias(f"{c}__missing") for c in columns
    ]
    row = df.agg(*aggs)
    long = wide_agg_to_long(
        row.select("*", *[F.col("__n").alias(f"{c}__n") for c in columns]), columns, ["missing", "n"]
    )
    return long.select(
        F.col("variable").alias("column"),
        F.col("missing").cast("bigint").alias("missing_values"),
        F.when(F.col("n") > 0, F.col("missing") / F.col("n") * 100).otherwise(F.lit(0.0)).alias("percentage"),
    ).orderBy(F.desc("missing_values"), "column")


def missing_by_version(frames: Mapping[str, DataFrame], columns: Sequence[str]) -> DataFrame:
    """The C1 summary per named dataset version, in one union plan."""
    parts = [missing_value_summary(df, columns).withColumn("dataset_version", F.lit(name)) for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def missing_rates(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Null fraction per column (one job)."""
    row = df.agg(
        F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    ).first()
    n = row["__n"]
    return {c: (row[c] / n if n else 0.0) for c in columns}


def imputable(rates: Mapping[str, float], threshold: float = 0.05) -> list[str]:
    """A column is filled only when its null rate is strictly below ``threshold``."""
    return [c for c, r in rates.items() if r < threshold]


def column_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """Most frequent value per column, ties -> smallest value.

    ``groupBy(variable, value).count()`` (partial aggregation map-side), then a
    ``min_by`` over (-count, value) per variable: no per-column scan, and no
    per-group buffer of distinct values in one task. Numeric and string
    columns are handled in their own type."""
    numeric = [c for c in columns if isinstance(df.schema[c].dataType, T.NumericType)]
    other = [c for c in columns if c not in numeric]
    out: dict[str, object] = {c: None for c in columns}
    for cols, vtype in ((numeric, "double"), (other, "string")):
        if not cols:
            continue
        long = to_long(df, cols, value_type=vtype)
        counts = long.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("c"))
        best = counts.groupBy("variable").agg(F.min_by("value", F.struct(-F.col("c"), F.col("value"))).alias("mode")).collect()
        out.update({r["variable"]: r["mode"] for r in best})
    return out


@dataclass
class SimpleImputerModel:
    """Fill values per column (fitted on one frame, applied to any)."""

    fills: dict[str, object] = field(default_factory=dict)
    rates: dict[str, float] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        cols = {}
        for c, v in self.fills.items():
            if v is None:
                continue
            dt = df.schema[c].dataType
            if isinstance(dt, T.IntegralType) and float(v) != int(v):
                dt = T.DoubleType()  # a median between two integers widens the column
            cols[c] = F.coalesce(F.col(c).cast(dt), F.lit(v).cast(dt))
        return df.withColumns(cols) if cols else df

    def as_frame(self, spark):
        rows = [(c, None if v is None else str(v), float(self.rates.get(c, 0.0))) for c, v in self.fills.items()]
        return spark.createDataFrame(rows, "column string, fill_value string, missing_rate double")


def fit_simple_imputer(
    df: DataFrame,
    numerical_cols: Sequence[str],
    categorical_cols: Sequence[str],
    threshold: float = 0.05,
) -> SimpleImputerModel:
    """C6 fit: numerical -> exact median, categorical -> mode, for columns
    whose null rate is strictly below ``threshold``."""
    rates = missing_rates(df, [*numerical_cols, *categorical_cols])
    num = [c for c in numerical_cols if rates[c] < threshold]
    cat = [c for c in categorical_cols if rates[c] < threshold]
    fills: dict[str, object] = {}
    if num:
        fills.update(medians(df, num))
    if cat:
        fills.update(column_modes(df, cat))
    return SimpleImputerModel(fills=fills, rates=rates)


def simple_imputation(
    df: DataFrame,
    numerical_cols: Sequence[str],
    categorical_cols: Sequence[str],
    threshold: float = 0.05,
) -> DataFrame:
    """C6 whole-table form (fit and transform on the same frame)."""
    return fit_simple_imputer(df, numerical_cols, categorical_cols, threshold).transform(df)
