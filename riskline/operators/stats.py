"""Inferential statistics against a binary target.

All tests run on per-variable aggregates computed in one grouped job over the
long format: the data never leaves the executors; the driver (or a pandas
UDF over the per-variable table) only turns a handful of sums into
statistics and p-values.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskline.functions import exprs as X
from riskline.functions.pvalues import chi2_pvalue, exact_u_pvalue, two_sided_normal_pvalue
from riskline.operators.long import to_long
from riskline.operators.ordering import rank_sums

# ---------------------------------------------------------------------------
# Pearson correlation
# ---------------------------------------------------------------------------


def pearson(x: Column, y: Column) -> Column:
    """Pearson r over the rows that have both values; NULL if one of them is constant (no error in ANSI mode)."""
    x = F.when(y.isNotNull(), x.cast("double"))
    y = F.when(x.isNotNull(), y.cast("double"))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


#: Pairs, and numbers of each (n, sum x, sum y, sum x^2, sum y^2, sum xy), in one row of a partial sum.
_PAIRS, _MOMENTS = 10, 6
#: Rows whose median is taken as a column's origin, so that sums of squares lose no digits.
_ORIGIN_ROWS = 101
#: Share of the sum of squares below which a variance is rounding only: the column is constant.
_CONSTANT = 1e-13


def _pair_moments(origin: np.ndarray):
    """Per task: pairwise-complete moments of all column pairs (i <= j), by matrix products of values and masks."""
    k = len(origin)
    i, j = np.triu_indices(k)

    def run(batches):
        total = None
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, k) - origin
            for lo in range(0, len(x), 8192):
                part = x[lo : lo + 8192]
                there = ~np.isnan(part)
                v, m = np.where(there, part, 0.0), there.astype(float)
                n, s, q = m.T @ m, v.T @ m, (v * v).T @ m
                new = np.stack([n[i, j], s[i, j], s[j, i], q[i, j], q[j, i], (v.T @ v)[i, j]], axis=1)
                total = new if total is None else total + new
        if total is not None:
            total = np.pad(total, ((0, -len(total) % _PAIRS), (0, 0))).reshape(-1, _PAIRS * _MOMENTS)
            columns = [pa.array(np.arange(len(total)), pa.int32()), *(pa.array(c) for c in total.T)]
            yield pa.RecordBatch.from_arrays(columns, ["at", *(f"v{c}" for c in range(_PAIRS * _MOMENTS))])

    return run


def correlation_pairs(df: DataFrame, columns: Sequence[str], full: bool = False) -> DataFrame:
    """Pairwise-complete Pearson r of every column pair in ONE pass (NaN counts as NULL).

    ``variable_1, variable_2, correlation, abs_correlation, strength``; the
    upper triangle (i < j) by default, the full symmetric matrix with its diagonal with ``full``. A constant column has
    NULL throughout. Each task multiplies blocks of values and of masks, and what it sends are sums per pair: rows are not
    exploded, and the plan has one size for any number of columns."""
    cols = list(columns)
    k, spark = len(cols), df.sparkSession
    rows = df.select(F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in cols]).alias("x"))
    origin = np.zeros(k)
    few = rows.limit(_ORIGIN_ROWS).collect()
    for c in range(k):
        v = sorted(r["x"][c] for r in few if np.isfinite(r["x"][c]))
        origin[c] = v[len(v) // 2] if v else 0.0
    width = _PAIRS * _MOMENTS
    sums = rows.mapInArrow(_pair_moments(origin), "at int, " + ", ".join(f"v{c} double" for c in range(width)))
    sums = sums.groupBy("at").agg(*(F.sum(f"v{c}").alias(f"v{c}") for c in range(width)))
    names = ["n", "sx", "sy", "qx", "qy", "p"]
    one = [F.struct((F.col("at") * _PAIRS + s).alias("pair"), *[F.col(f"v{s * _MOMENTS + m}").alias(names[m]) for m in range(_MOMENTS)]) for s in range(_PAIRS)]
    r = sums.select(F.explode(F.array(*one)).alias("m")).select("m.*")
    n, sx, sy, qx, qy, p = (F.col(c) for c in names)
    var = [F.when(n * q - s * s > _CONSTANT * n * q, n * q - s * s) for s, q in ((sx, qx), (sy, qy))]
    value = F.least(F.lit(1.0), F.greatest(F.lit(-1.0), (n * p - sx * sy) / (F.sqrt(var[0]) * F.sqrt(var[1]))))
    value = F.when(var[0].isNotNull() & var[1].isNotNull(), value)
    i, j = np.triu_indices(k)
    pairs = [(int(x), cols[a], cols[b]) for x, (a, b) in enumerate(zip(i, j)) if full or a != b]
    named = spark.createDataFrame(pairs, "pair int, variable_1 string, variable_2 string")
    out = named.join(r.select("pair", value.alias("correlation")), "pair", "left").drop("pair")
    if full:
        mirrored = out.where("variable_1 != variable_2")
        out = out.unionByName(mirrored.select(F.col("variable_2").alias("variable_1"), F.col("variable_1").alias("variable_2"), "correlation"))
    return out.withColumns(
        {"abs_correlation": F.abs("correlation"), "strength": X.corr_strength(F.col("correlation"))}
    )


def top_correlation_pairs(df: DataFrame, columns: Sequence[str], n: int = 20) -> DataFrame:
    """The ``n`` strongest pairs by |r| (ties broken by names): a top-k report."""
    pairs = correlation_pairs(df, columns)
    return pairs.orderBy(F.desc("abs_correlation"), "variable_1", "variable_2").limit(n)


def target_correlation(df: DataFrame, columns: Sequence[str], target: str, complete_cases: bool = False, absolute: bool = False) -> DataFrame:
    """R of every column with the target.

    Signed form drops the target itself; ``absolute`` keeps it (r = 1), as the
    selection report does. ``complete_cases`` first drops rows with any NULL
    in the listed columns (otherwise pairwise-complete)."""
    cols = list(columns)
    base = df.dropna(subset=[*cols, target]) if complete_cases else df
    row = base.agg(*[pearson(F.col(c), F.col(target)).alias(c) for c in cols])
    out = row.unpivot([], cols, "variable", "correlation")
    if absolute:
        self_row = base.agg(F.lit(target).alias("variable"), pearson(F.col(target), F.col(target)).alias("correlation"))
        out = out.unionByName(self_row).withColumn("correlation", F.abs("correlation"))
    return out.orderBy(F.desc_nulls_last("correlation"), "variable")


# ---------------------------------------------------------------------------
# Chi-square independence tests
# ---------------------------------------------------------------------------


def contingency(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Observed counts ``variable, category, cls, observed`` (NULLs skipped)."""
    long = to_long(df, columns, by=[target], value_type="string").where(F.col(target).isNotNull())
    return long.groupBy("variable", F.col("value").alias("category"), F.col(target).alias("cls")).agg(
        F.count(F.lit(1)).cast("bigint").alias("observed")
    )


def expected_frequencies(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """``variable, category, cls, observed, expected, residual`` with
    expected = row total x column total / n. Zero cells are filled so every
    (category, class) pair of a variable appears."""
    return _cells(df, columns, target).drop("_r", "_k", "_n")


def _cells(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    obs = contingency(df, columns, target)
    # Per-variable and per-class totals are small (#variables x #classes): broadcast.
    col_t = obs.groupBy("variable", "cls").agg(F.sum("observed").alias("_col"))
    per_var = obs.groupBy("variable").agg(
        F.sum("observed").alias("_n"),
        F.count_distinct("category").alias("_r"),
        F.count_distinct("cls").alias("_k"),
    )
    # Row totals: one row per (variable, category), joined back distributed
    # (a high-cardinality category column never lands in one task).
    row_t = obs.groupBy("variable", "category").agg(F.sum("observed").alias("_row"))
    grid = row_t.join(F.broadcast(col_t), "variable")
    cells = grid.join(obs, ["variable", "category", "cls"], "left").fillna(0, subset=["observed"])
    cells = cells.join(F.broadcast(per_var), "variable")
    e = F.col("_row") * F.col("_col") / F.col("_n")
    return cells.select(
        "variable",
        "category",
        "cls",
        "observed",
        e.alias("expected"),
        (F.col("observed") - e).alias("residual"),
        F.col("_r").cast("int").alias("_r"),
        F.col("_k").cast("int").alias("_k"),
        "_n",
    )


def chi_square_stats(df: DataFrame, columns: Sequence[str], target: str, correction: bool = True) -> DataFrame:
    """D17/D19 statistics: ``variable, chi2, dof, n, n_categories, min_expected, cramers_v``.

    Yates' continuity correction (each |O - E| reduced by min(0.5, |O - E|))
    applies when dof = 1, as ``chi2_contingency`` does by default."""
    cells = _cells(df, columns, target)
    dof = (F.col("_r") - 1) * (F.col("_k") - 1)
    diff = F.abs(F.col("residual"))
    adj = F.when((dof == 1) & F.lit(correction), diff - F.least(F.lit(0.5), diff)).otherwise(diff)
    g = cells.groupBy("variable").agg(
        F.sum(adj * adj / F.col("expected")).alias("chi2"),
        F.first(dof).cast("int").alias("dof"),
        F.first("_n").cast("bigint").alias("n"),
        F.first("_r").cast("int").alias("n_categories"),
        F.first("_k").cast("int").alias("n_classes"),
        F.min("expected").alias("min_expected"),
    )
    # a variable or target of one value has no freedom: NULL, and the other variables keep theirs
    v = F.sqrt(F.try_divide(F.col("chi2"), F.col("n") * F.least(F.col("n_classes") - 1, F.col("n_categories") - 1)))
    return g.withColumn("cramers_v", v)


def chi_square_report(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """One row per categorical variable:
    ``variable, chi2, p_value, significance, cramers_v, effect_size, dof,
    min_expected, valid_test, useful``."""
    s = chi_square_stats(df, columns, target)
    s = s.withColumn("p_value", chi2_pvalue("chi2", "dof"))
    return s.select(
        "variable",
        "chi2",
        "p_value",
        X.significance_stars("p_value").alias("significance"),
        "cramers_v",
        X.cramer_effect("cramers_v").alias("effect_size"),
        "dof",
        "min_expected",
        X.valid_test_flag("min_expected").alias("valid_test"),
        X.useful_flag("p_value", "cramers_v").alias("useful"),
    )


# ---------------------------------------------------------------------------
# Cohen's d and the Mann-Whitney U test
# ---------------------------------------------------------------------------


def cohens_d(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """``variable, cohens_d`` = (mean_0 - mean_1) / pooled sample sigma, one aggregate."""
    aggs = []
    for c in columns:
        for k in (0, 1):
            v = F.when(F.col(target) == k, F.col(c))
            aggs += [F.count(v).alias(f"{c}__n{k}"), F.avg(v).alias(f"{c}__m{k}"), F.var_samp(v).alias(f"{c}__v{k}")]
    row = df.agg(*aggs)
    structs = []
    for c in columns:
        n0, n1 = F.col(f"{c}__n0"), F.col(f"{c}__n1")
        pooled = F.sqrt(F.try_divide((n0 - 1) * F.col(f"{c}__v0") + (n1 - 1) * F.col(f"{c}__v1"), n0 + n1 - 2))
        d = F.try_divide(F.col(f"{c}__m0") - F.col(f"{c}__m1"), pooled)
        structs.append(F.struct(F.lit(c).alias("variable"), d.alias("cohens_d")))
    return row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


#: Rows of the smaller class, and product of the class sizes, up to which the U test is exact.
EXACT_ROWS, EXACT_STEPS = 8, 4_000_000


def mann_whitney(df: DataFrame, columns: Sequence[str], target: str, continuity: bool = True) -> DataFrame:
    """Two-sided Mann-Whitney U of class 0 vs class 1 per column.

    ``variable, n_0, n_1, u_statistic, z, p_value``; ``u_statistic`` is U of
    the class-0 sample. Without ties and with ``EXACT_ROWS`` rows at most in a class the p-value is exact (the usual
    automatic choice); else it is the normal approximation with tie correction and continuity correction. A product of the class
    sizes beyond ``EXACT_STEPS`` takes the approximation too, which then agrees to many digits."""
    long = to_long(df, columns, by=[target]).where(F.col(target).isin(0, 1))
    rs = rank_sums(long, "value", target, by=["variable"], positive=1)
    n0, n1 = F.col("n_neg"), F.col("n_pos")
    n = n0 + n1
    u0 = F.col("rank_sum_neg") - n0 * (n0 + 1) / 2.0
    mu = n0 * n1 / 2.0
    big_u = F.greatest(u0, n0 * n1 - u0)
    sigma = F.sqrt(n0 * n1 / 12.0 * ((n + 1) - F.try_divide(F.col("tie_term"), n * (n - 1))))
    z = (big_u - mu - (0.5 if continuity else 0.0)) / sigma
    out = rs.select(
        "variable", n0.alias("n_0"), n1.alias("n_1"), u0.alias("u_statistic"), F.when(sigma > 0, z).alias("z"), (F.col("tie_term") == 0).alias("_untied")
    )
    small = (F.least("n_0", "n_1") >= 1) & (F.least("n_0", "n_1") <= EXACT_ROWS) & (F.col("n_0") * F.col("n_1") <= EXACT_STEPS)
    exact = small & F.col("_untied")
    sizes = [F.when(exact, F.col(c)).otherwise(F.lit(0)) for c in ("n_0", "n_1", "u_statistic")]
    normal = F.when(F.col("z").isNull(), F.lit(1.0)).otherwise(two_sided_normal_pvalue("z"))
    return out.withColumns({"_p": normal, "_q": exact_u_pvalue(*sizes)}).select("variable", "n_0", "n_1", "u_statistic", "z", F.when(exact, F.col("_q")).otherwise(F.col("_p")).alias("p_value"))


# ---------------------------------------------------------------------------
# Importance ranking and segmentation
# ---------------------------------------------------------------------------


def importance_ranking(df: DataFrame, continuous: Sequence[str], categorical: Sequence[str], target: str) -> DataFrame:
    """``rank, variable, type, effect_size, effect_metric, p_value,
    importance_score, usefulness`` over continuous (MWU p, |d|) and
    categorical (chi-square p, Cramer's V) variables, best first."""
    parts = []
    if continuous:
        mw = mann_whitney(df, continuous, target)
        d = cohens_d(df, continuous, target)
        parts.append(
            mw.join(d, "variable").select(
                "variable",
                F.lit("Continuous").alias("type"),
                F.abs("cohens_d").alias("effect_size"),
                F.lit("Cohen's d").alias("effect_metric"),
                "p_value",
            )
        )
    if categorical:
        cs = chi_square_stats(df, categorical, target).withColumn("p_value", chi2_pvalue("chi2", "dof"))
        parts.append(
            cs.select(
                "variable",
                F.lit("Categorical").alias("type"),
                F.col("cramers_v").alias("effect_size"),
                F.lit("Cramér's V").alias("effect_metric"),
                "p_value",
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.withColumn("importance_score", X.importance_score("p_value", "effect_size"))
    # One row per tested variable: a tiny table, so a global window is fine here.
    w = Window.orderBy(F.desc("importance_score"), "variable")
    return out.select(
        F.row_number().over(w).alias("rank"),
        "variable",
        "type",
        "effect_size",
        "effect_metric",
        "p_value",
        "importance_score",
        X.usefulness_label("p_value", "effect_size").alias("usefulness"),
    )


SEGMENT_ORDER = ["high", "moderate", "low", "not_significant"]
SEGMENT_ACTION = {"high": "include", "moderate": "consider", "low": "exclude", "not_significant": "exclude"}


def segment_of(p, e):
    """D21 segment: high (p<.05, e>=.2), moderate (.1<=e<.2), low (e<.1), not significant."""
    p, e = F.col(p), F.col(e)
    return (
        F.when(p >= 0.05, "not_significant")
        .when(e >= 0.2, "high")
        .when(e >= 0.1, "moderate")
        .otherwise("low")
    )


def segments(ranking: DataFrame) -> DataFrame:
    """``segment, action, n_variables, variables`` (sorted member list)."""
    seg = ranking.withColumn("segment", segment_of("p_value", "effect_size"))
    action = F.create_map(*[x for k, v in SEGMENT_ACTION.items() for x in (F.lit(k), F.lit(v))])
    return seg.groupBy("segment").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_variables"),
        F.array_join(F.sort_array(F.collect_list("variable")), ",").alias("variables"),
    ).withColumn("action", action[F.col("segment")])


# ---------------------------------------------------------------------------
# Variance inflation factors
# ---------------------------------------------------------------------------


def gram_matrix(df: DataFrame, columns: Sequence[str]) -> tuple[np.ndarray, int]:
    """Uncentred X'X over complete cases in ONE aggregate (k(k+1)/2 sums)."""
    cols = list(columns)
    k = len(cols)
    base = df.dropna(subset=cols)
    aggs = [F.count(F.lit(1)).alias("n")]
    for i in range(k):
        for j in range(i, k):
            aggs.append(F.sum(F.col(cols[i]).cast("double") * F.col(cols[j]).cast("double")).alias(f"g_{i}_{j}"))
    r = base.agg(*aggs).first()
    g = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            g[i, j] = g[j, i] = r[f"g_{i}_{j}"] or 0.0
    return g, r["n"]


def vif_values(g: np.ndarray, rtol: float = 1e-10) -> list[float]:
    """VIF_i = G_ii (G^-1)_ii (uncentred R^2, no intercept); +inf for a column
    that is an exact linear combination of the others."""
    k = g.shape[0]
    d = np.sqrt(np.clip(np.diag(g), 1e-300, None))
    c = g / np.outer(d, d)  # unit-diagonal scaling: VIF is invariant to it
    out = []
    for i in range(k):
        others = [j for j in range(k) if j != i]
        if not others:
            out.append(1.0)
            continue
        a = c[np.ix_(others, others)]
        b = c[others, i]
        sol, *_ = np.linalg.lstsq(a, b, rcond=None)
        ssr = 1.0 - float(b @ sol)
        out.append(float("inf") if ssr <= rtol else 1.0 / ssr)
    return out


def vif(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``feature, vif`` (descending) from one Gram-matrix aggregate."""
    g, _n = gram_matrix(df, columns)
    vals = vif_values(g)
    rows = sorted(zip(columns, vals), key=lambda t: (-t[1], t[0]))
    return df.sparkSession.createDataFrame(rows, "feature string, vif double")
