"""Projection, cast and guard operators.

All of them are narrow transformations: they add expressions to one
projection and never trigger a job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskline.functions import exprs as X

# The reference's raw-name -> clean-name map (12 renames).
REFERENCE_RENAMES = {
    "education": "education_level",
    "currentSmoker": "current_smoker",
    "cigsPerDay": "cigarettes_per_day",
    "BPMeds": "bp_medication",
    "prevalentStroke": "previous_stroke",
    "prevalentHyp": "hypertension",
    "totChol": "total_cholesterol",
    "sysBP": "systolic_bp",
    "diaBP": "diastolic_bp",
    "BMI": "bmi",
    "heartRate": "heart_rate",
    "TenYearCHD": "ten_year_chd",
}


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    """Fail fast listing every missing column."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"the table lacks {missing}")


def rename_columns(df: DataFrame, mapping: Mapping[str, str] = REFERENCE_RENAMES) -> DataFrame:
    """B1: absent source names are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def recode(df: DataFrame, spec: Mapping[str, tuple[Mapping[object, int], str | None]], strict: bool = True) -> DataFrame:
    """B2: ``{column: (mapping, output name or None for in place)}``."""
    return df.withColumns(
        {out or c: X.recode_map(c, m, strict=strict, name=c) for c, (m, out) in spec.items()}
    )


def cast_nullable_int(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """B3."""
    return df.withColumns({c: X.nullable_int(c, c) for c in columns})


def cast_strict_int(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """B4."""
    return df.withColumns({c: X.strict_int(c, c) for c in columns})


def convert_dtypes(
    df: DataFrame,
    recodes: Mapping[str, Mapping[object, int]],
    nullable_ints: Sequence[str] = (),
    strict_ints: Sequence[str] = (),
) -> DataFrame:
    """Recodes, nullable and strict integer casts in one projection."""
    cols = {c: X.recode_map(c, m, strict=True, name=c) for c, m in recodes.items()}
    cols.update({c: X.nullable_int(c, c) for c in nullable_ints})
    cols.update({c: X.strict_int(c, c) for c in strict_ints})
    return df.withColumns(cols)


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of numeric columns, from the schema only."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def standardize_target(df: DataFrame, canonical: str = "label", aliases: Sequence[str] = ()) -> DataFrame:
    """Rename the first alias found to ``canonical``; fail when none exists."""
    for a in aliases:
        if a in df.columns and canonical not in df.columns:
            df = df.withColumnRenamed(a, canonical)
    if canonical not in df.columns:
        raise ValueError(f"no column is named {canonical!r} or one of {list(aliases)}")
    return df


def prepare_features(df: DataFrame, feature_cols: Sequence[str], target_col: str, id_cols: Sequence[str] = ()) -> DataFrame:
    """X and y stay in the same row; only the projection is kept."""
    require_columns(df, [*id_cols, *feature_cols, target_col])
    return df.select(*id_cols, *feature_cols, target_col)


def complete_cases(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with every listed column present."""
    return df.dropna(subset=list(columns))


def derive_features(
    df: DataFrame,
    difference: tuple[str, str, str] | None = None,
    bands: Mapping[str, tuple[str, Sequence[float]]] | None = None,
    flag_count: tuple[str, Sequence[str]] | None = None,
    strict_flags: bool = True,
) -> DataFrame:
    """B19-B24 in one projection.

    ``difference=(out, a, b)`` -> ``out = a - b`` (NULL-propagating);
    ``bands={out: (col, edges)}`` -> left-closed band code, -1 when missing;
    ``flag_count=(out, flags)`` -> strict-int flags and their NULL-skipping sum.
    """
    cols = {}
    if difference:
        out, a, b = difference
        cols[out] = F.col(a) - F.col(b)
    if flag_count:
        out, flags = flag_count
        if strict_flags:
            df = cast_strict_int(df, flags)
        cols[out] = X.row_sum_skip_null(flags).cast("int")
    for out, (c, edges) in (bands or {}).items():
        cols[out] = X.cut_code(c, edges)
    return df.withColumns(cols)


def reference_derive_features(df: DataFrame) -> DataFrame:
    """B24 with the reference's own columns (pulse pressure, age/BMI bands, risk count)."""
    return derive_features(
        df,
        difference=("pulse_pressure", "systolic_bp", "diastolic_bp"),
        bands={"age_group_code": ("age", X.AGE_EDGES), "bmi_category_code": ("bmi", X.BMI_EDGES)},
        flag_count=("risk_factor_count", ["current_smoker", "hypertension", "diabetes", "previous_stroke"]),
    )
