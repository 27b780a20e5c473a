"""Descriptive profiles.

Every profile is a fixed number of jobs regardless of the column count:
wide single-pass aggregates for moments and counts, exact quartiles by rank
selection (``quantiles.exact_quantiles``) for all columns at once, and
grouped long-format aggregates for categories. Results are small
(one row per column or per category) and carry a deterministic order key.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from riskline.functions import exprs as X
from riskline.operators.long import join_small, to_long, wide_agg_to_long
from riskline.operators.quantiles import exact_quantiles


def _spark(df):
    return df.sparkSession


# ---------------------------------------------------------------------------
# Schema-level profiles
# ---------------------------------------------------------------------------


def schema_profile(df: DataFrame) -> DataFrame:
    """A5: one row per column: ``column, position, dtype, non_null, n_rows`` (one scan)."""
    cols = df.columns
    row = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count(F.col(f"`{c}`")).alias(f"{c}__nn") for c in cols])
    dtypes = dict(df.dtypes)
    structs = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(i).alias("position"),
            F.lit(dtypes[c]).alias("dtype"),
            F.col(f"`{c}__nn`").cast("bigint").alias("non_null"),
            F.col("__n").cast("bigint").alias("n_rows"),
        )
        for i, c in enumerate(cols)
    ]
    return row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``variable, n_distinct`` (NULL not counted).

    Long format + two-level grouping instead of k ``count(DISTINCT)`` in one
    aggregate (which expands every row k times before the shuffle).
    """
    long = to_long(df, columns, value_type="string")
    per_value = long.groupBy("variable", "value").agg(F.lit(1).alias("_one"))
    return per_value.groupBy("variable").agg(F.count(F.lit(1)).cast("bigint").alias("n_distinct"))


def cardinality_types(df: DataFrame, columns: Sequence[str] | None = None, max_categories: int = 4) -> DataFrame:
    """Numeric columns with more than ``max_categories`` distinct values are
    numerical, the rest categorical: ``variable, n_distinct, kind``."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    columns = [c for c in (columns or numeric) if c in numeric]
    dc = distinct_counts(df, columns)
    return dc.withColumn(
        "kind", F.when(F.col("n_distinct") > max_categories, "numerical").otherwise("categorical")
    )


# ---------------------------------------------------------------------------
# Numeric and categorical summaries
# ---------------------------------------------------------------------------

_QPROBS = (0.25, 0.5, 0.75)


def _moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("__n")]
    for c in columns:
        aggs += [
            F.count(c).alias(f"{c}__count"),
            F.avg(c).alias(f"{c}__mean"),
            F.stddev_samp(c).alias(f"{c}__std"),
            F.min(F.col(c).cast("double")).alias(f"{c}__min"),
            F.max(F.col(c).cast("double")).alias(f"{c}__max"),
        ]
    row = df.agg(*aggs)
    row = row.select("*", *[F.col("__n").alias(f"{c}__n") for c in columns])
    return wide_agg_to_long(row, columns, ["n", "count", "mean", "std", "min", "max"])


def _quartile_frame(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    q, _ = exact_quantiles(df, columns, _QPROBS)
    rows = [(c, q.get(((), c, 0.25)), q.get(((), c, 0.5)), q.get(((), c, 0.75))) for c in columns]
    return _spark(df).createDataFrame(rows, "variable string, q25 double, median double, q75 double")


def continuous_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``variable, count, missing, missing_pct, mean, std, min, q25, median, q75, max``.

    ``std`` is the sample standard deviation; ``missing_pct`` is over all rows.
    Two jobs for the moments and about three for the exact quartiles,
    whatever the number of columns.
    """
    m = _moments(df, columns)
    q = _quartile_frame(df, columns)
    return m.join(F.broadcast(q), "variable").select(
        "variable",
        F.col("count").cast("bigint").alias("count"),
        (F.col("n") - F.col("count")).cast("bigint").alias("missing"),
        F.when(F.col("n") > 0, (F.col("n") - F.col("count")) / F.col("n") * 100).otherwise(0.0).alias("missing_pct"),
        "mean",
        "std",
        "min",
        "q25",
        "median",
        "q75",
        "max",
    )


def top_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``variable, n_unique, top, freq`` per column (top: most frequent, ties -> smallest)."""
    long = to_long(df, columns, value_type="string")
    counts = long.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("c"))
    return counts.groupBy("variable").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_unique"),
        F.min_by("value", F.struct(-F.col("c"), F.col("value"))).alias("top"),
        F.max("c").cast("bigint").alias("freq"),
    )


def describe(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """D4 (``include="all"``): one row per column with
    ``count, n_unique, top, freq, mean, std, min, q25, median, q75, max``;
    numeric columns leave n_unique/top/freq NULL, categorical ones the moments."""
    parts = []
    if numeric:
        s = continuous_summary(df, numeric)
        parts.append(
            s.select(
                "variable",
                "count",
                F.lit(None).cast("bigint").alias("n_unique"),
                F.lit(None).cast("string").alias("top"),
                F.lit(None).cast("bigint").alias("freq"),
                "mean",
                "std",
                "min",
                "q25",
                "median",
                "q75",
                "max",
            )
        )
    if categorical:
        cnt = df.agg(*[F.count(c).alias(c) for c in categorical])
        cnt_long = cnt.unpivot([], list(categorical), "variable", "count")
        tv = top_values(df, categorical)
        parts.append(
            tv.join(F.broadcast(cnt_long), "variable").select(
                "variable",
                F.col("count").cast("bigint").alias("count"),
                "n_unique",
                "top",
                "freq",
                *[F.lit(None).cast("double").alias(k) for k in ("mean", "std", "min", "q25", "median", "q75", "max")],
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------------------
# Value counts and class balance
# ---------------------------------------------------------------------------


def value_counts(df: DataFrame, columns: Sequence[str], by_value: bool = False) -> DataFrame:
    """``variable, value, count, percentage`` (percentage of all rows), NULL excluded, the most frequent first;
    with ``by_value`` in the order of the values, numbers by size."""
    long = to_long(df, columns, value_type="string")
    counts = long.groupBy("variable", "value").agg(F.count(F.lit(1)).cast("bigint").alias("count"))
    # Percent of all rows (NULLs included): one row count, applied as a literal.
    n = df.count()
    out = counts.select("variable", "value", "count", (F.col("count") / F.lit(float(n)) * 100).alias("percentage"))
    if by_value:
        return out.orderBy("variable", F.expr("try_cast(value AS double)").asc_nulls_last(), "value")
    return out.orderBy("variable", F.desc("count"), "value")


def class_balance(df: DataFrame, target: str, by: Sequence[str] = ()) -> DataFrame:
    """``by..., n, positives, positive_rate`` (mean of a 0/1 target)."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.sum(F.col(target)).cast("bigint").alias("positives"),
        F.avg(F.col(target).cast("double")).alias("positive_rate"),
    )


# ---------------------------------------------------------------------------
# Two-group comparison
# ---------------------------------------------------------------------------


def group_comparison(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Per column, median / mean / sample std of class 0 and class 1 and
    their differences; ``pct_diff_median`` is 0 when the class-0 median is 0;
    ``cv_k = std_k / mean_k`` (0 when the mean is 0)."""
    spark = _spark(df)
    aggs = []
    for c in columns:
        for k in (0, 1):
            v = F.when(F.col(target) == k, F.col(c))
            aggs += [F.avg(v).alias(f"{c}__mean_{k}"), F.stddev_samp(v).alias(f"{c}__std_{k}")]
    mom = wide_agg_to_long(df.agg(*aggs), columns, ["mean_0", "std_0", "mean_1", "std_1"])
    q, _ = exact_quantiles(df.where(F.col(target).isin(0, 1)), columns, [0.5], by=[target])
    med_rows = [(c, q.get(((0,), c, 0.5)), q.get(((1,), c, 0.5))) for c in columns]
    med = spark.createDataFrame(med_rows, "variable string, median_0 double, median_1 double")
    j = mom.join(F.broadcast(med), "variable")
    return j.select(
        "variable",
        "median_0",
        "median_1",
        "mean_0",
        "mean_1",
        "std_0",
        "std_1",
        (F.col("median_1") - F.col("median_0")).alias("diff_median"),
        (F.col("mean_1") - F.col("mean_0")).alias("diff_mean"),
        (F.col("std_1") - F.col("std_0")).alias("diff_std"),
        F.when(F.col("median_0") != 0, (F.col("median_1") - F.col("median_0")) / F.col("median_0") * 100)
        .otherwise(F.lit(0.0))
        .alias("pct_diff_median"),
        F.when(F.col("mean_0") != 0, F.col("std_0") / F.col("mean_0")).otherwise(F.lit(0.0)).alias("cv_0"),
        F.when(F.col("mean_1") != 0, F.col("std_1") / F.col("mean_1")).otherwise(F.lit(0.0)).alias("cv_1"),
    )


# ---------------------------------------------------------------------------
# Crosstabs against a binary target
# ---------------------------------------------------------------------------


def _cat_counts(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    long = to_long(df, columns, by=[target], value_type="string")
    return long.groupBy("variable", F.col("value").alias("category")).agg(
        F.count_if(F.col(target) == 0).cast("bigint").alias("n_0"),
        F.count_if(F.col(target) == 1).cast("bigint").alias("n_1"),
    )


def crosstab(df: DataFrame, columns: Sequence[str], target: str, margins: bool = False) -> DataFrame:
    """``variable, category, n_0, n_1, total`` (0-filled). With
    ``margins`` an ``All`` row per variable holds the column totals."""
    long = to_long(df, columns, by=[target], value_type="string").withColumnRenamed("value", "category")
    cells = long.groupBy("variable", "category").agg(
        F.count_if(F.col(target) == 0).cast("bigint").alias("n_0"),
        F.count_if(F.col(target) == 1).cast("bigint").alias("n_1"),
        F.count(F.lit(1)).cast("bigint").alias("total"),
    )
    if not margins:
        return cells
    # Margins from the aggregated cells (#variables x #categories rows), not a
    # rollup over the raw rows (which would expand every row before aggregating).
    totals = cells.groupBy("variable").agg(
        F.lit("All").alias("category"),
        F.sum("n_0").cast("bigint").alias("n_0"),
        F.sum("n_1").cast("bigint").alias("n_1"),
        F.sum("total").cast("bigint").alias("total"),
    )
    return cells.unionByName(totals)


def crosstab_row_pct(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Row percentages ``pct_0, pct_1`` per category."""
    c = _cat_counts(df, columns, target)
    tot = F.col("n_0") + F.col("n_1")
    return c.select("variable", "category", (F.col("n_0") / tot * 100).alias("pct_0"), (F.col("n_1") / tot * 100).alias("pct_1"))


def prevalence(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """``variable, category, n, positives, rate`` (rate in %)."""
    long = to_long(df, columns, by=[target], value_type="string")
    return long.groupBy("variable", F.col("value").alias("category")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.count_if(F.col(target) == 1).cast("bigint").alias("positives"),
        (F.count_if(F.col(target) == 1) / F.count(F.lit(1)) * 100).alias("rate"),
    )


def prevalence_gap(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """``variable, min_rate, max_rate, rate_gap, interpretation`` across categories."""
    p = prevalence(df, columns, target)
    g = p.groupBy("variable").agg(F.min("rate").alias("min_rate"), F.max("rate").alias("max_rate"))
    gap = F.col("max_rate") - F.col("min_rate")
    return g.select("variable", "min_rate", "max_rate", gap.alias("rate_gap"), X.rate_gap_label(gap).alias("interpretation"))


# ---------------------------------------------------------------------------
# Histogram, box-plot and density data
# ---------------------------------------------------------------------------


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 30) -> DataFrame:
    """Equal-width bins over [min, max] (last bin closed), empty bins included:
    ``variable, bin, lower, upper, count``."""
    long = to_long(df, columns)
    rng = long.groupBy("variable").agg(F.min("value").alias("mn"), F.max("value").alias("mx"))
    # #columns rows: bounded, broadcast.
    b = F.least(
        F.floor((F.col("value") - F.col("mn")) / (F.col("mx") - F.col("mn")) * bins) + 1, F.lit(bins)
    )
    b = F.when(F.col("mx") == F.col("mn"), F.lit(1)).otherwise(b).cast("int")
    counts = long.join(F.broadcast(rng), "variable").groupBy("variable", b.alias("bin")).agg(
        F.count(F.lit(1)).cast("bigint").alias("count")
    )
    frame = rng.select("variable", "mn", "mx", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    w = (F.col("mx") - F.col("mn")) / bins
    return frame.join(counts, ["variable", "bin"], "left").select(
        "variable",
        "bin",
        (F.col("mn") + w * (F.col("bin") - 1)).alias("lower"),
        (F.col("mn") + w * F.col("bin")).alias("upper"),
        F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
    )


def box_stats(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``by..., variable, q1, median, q3, iqr, whisker_low, whisker_high, n_outliers``.

    Whiskers are the most extreme values inside the 1.5 IQR fences."""
    spark = _spark(df)
    by = list(by)
    q, _ = exact_quantiles(df, columns, _QPROBS, by=by)
    keys = sorted({(g, v) for (g, v, _p) in q}, key=repr)
    schema = T.StructType(
        [T.StructField(b, df.schema[b].dataType) for b in by]
        + [T.StructField(n, T.StringType() if n == "variable" else T.DoubleType()) for n in ("variable", "q1", "median", "q3")]
    )
    rows = [(*g, v, q[(g, v, 0.25)], q[(g, v, 0.5)], q[(g, v, 0.75)]) for g, v in keys if q[(g, v, 0.25)] is not None]
    qs = spark.createDataFrame(rows, schema)
    iqr = F.col("q3") - F.col("q1")
    lo, hi = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    long = to_long(df, columns, by)
    j = join_small(long, qs, [*by, "variable"])
    inside = (F.col("value") >= lo) & (F.col("value") <= hi)
    return j.groupBy(*by, "variable", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.count_if(~inside).cast("bigint").alias("n_outliers"),
    ).withColumn("iqr", iqr)


def kde_density(df: DataFrame, column: str, by: str, grid_points: int = 100) -> DataFrame:
    """Gaussian KDE per group on ``grid_points`` equally spaced points over
    the group's [min, max]; Scott bandwidth ``sigma * n^(-1/5)`` (sample sigma).

    Exact: every row adds its kernel to each grid point; the per-row grid is
    an ``explode`` of a fixed-size sequence and the sum is a partial-aggregated
    ``groupBy(group, point)``, so the shuffle is #groups x grid_points rows."""
    st = df.where(F.col(column).isNotNull()).groupBy(by).agg(
        F.count(column).alias("_n"), F.stddev_samp(column).alias("_sd"), F.min(column).alias("_mn"), F.max(column).alias("_mx")
    )
    bw = F.col("_sd") * F.pow(F.col("_n"), F.lit(-0.2))
    st = st.withColumn("_h", bw)
    j = join_small(df.where(F.col(column).isNotNull()), st, [by])
    step = (F.col("_mx") - F.col("_mn")) / F.lit(grid_points - 1)
    ex = j.select(by, F.col(column).alias("_v"), "_n", "_h", "_mn", step.alias("_step"), F.explode(F.sequence(F.lit(0), F.lit(grid_points - 1))).alias("point"))
    x = F.col("_mn") + F.col("_step") * F.col("point")
    # a group of one value has no bandwidth: its density is NULL
    z = F.try_divide(x - F.col("_v"), F.col("_h"))
    k = F.try_divide(F.exp(-0.5 * z * z), F.col("_n") * F.col("_h") * F.lit(math.sqrt(2 * math.pi)))
    return ex.groupBy(by, "point").agg(F.first(x).alias("x"), F.sum(k).alias("density"))


def kde_density_binned(df: DataFrame, column: str, by: str, grid_points: int = 100, tolerance: float = 1e-6) -> DataFrame:
    """D28 by linear binning: ``by, point, x, density, error_bound`` on the grid of ``kde_density``.

    Each row gives its weight to the two ends of its bin, of width ``d``; kernels are then evaluated at bin ends alone. Linear
    interpolation of a Gaussian kernel of bandwidth ``h`` errs by at most ``d^2 / (8 h^3 sqrt(2 pi))``, and so does the mean of the
    rows (``error_bound``). ``d`` is chosen so that this is ``tolerance / h``. The shuffle has one row per group and bin that
    holds a value: no row is copied per grid point. A group of one value has no bandwidth: its density is NULL."""
    rows = df.where(F.col(column).isNotNull()).select(F.col(by), F.col(column).cast("double").alias("_v"))
    stats = rows.groupBy(by).agg(F.count("_v").alias("_n"), F.stddev_samp("_v").alias("_sd"), F.min("_v").alias("_mn"), F.max("_v").alias("_mx"))
    root = math.sqrt(2 * math.pi)
    stats = stats.withColumn("_h", F.nullif(F.col("_sd") * F.pow(F.col("_n"), F.lit(-0.2)), F.lit(0.0)))
    stats = stats.withColumn("_d", F.coalesce(F.col("_h") * math.sqrt(8 * tolerance * root), F.lit(1.0)))
    place = (F.col("_v") - F.col("_mn")) / F.col("_d")
    placed = join_small(rows, stats.select(by, "_mn", "_d"), [by]).select(by, F.floor(place).alias("_bin"), (place - F.floor(place)).alias("_share"))
    bins = placed.groupBy(by, "_bin").agg(F.sum(1 - F.col("_share")).alias("_w0"), F.sum("_share").alias("_w1"))
    step = (F.col("_mx") - F.col("_mn")) / F.lit(grid_points - 1)
    ex = join_small(bins, stats, [by]).select("*", F.explode(F.sequence(F.lit(0), F.lit(grid_points - 1))).alias("point"))
    x = F.col("_mn") + step * F.col("point")
    kernel = lambda end: F.exp(-0.5 * F.pow((step * F.col("point") - F.col("_d") * end) / F.col("_h"), F.lit(2.0)))
    met = F.col("_w0") * kernel(F.col("_bin")) + F.col("_w1") * kernel(F.col("_bin") + 1)
    density = F.sum(met / (F.col("_n") * F.col("_h") * F.lit(root)))
    return ex.groupBy(by, "point").agg(F.first(x).alias("x"), density.alias("density"), F.first(F.lit(tolerance) / F.col("_h")).alias("error_bound"))
