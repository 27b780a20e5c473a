"""Registered queries: correlation, chi-square, rank tests, importance, VIF."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskline.operators import stats as S
from riskline.plans.describe_queries import _extra, long_sql
from riskline.plans.pvalue_sql import chi2_sf_sql, two_sided_normal_sql
from riskline.plans.registry import query
from riskline.sources import fixtures as FX
from riskline.sources.fixtures import with_fixtures

NUM = FX.BULK_NUMERIC
CORR7 = [*NUM, "grade", "label"]
CAT = ["grade", "flag", "status"]

_STRENGTH = (
    "CASE WHEN abs({r}) < 0.2 THEN 'Very Weak' WHEN abs({r}) < 0.4 THEN 'Weak' WHEN abs({r}) < 0.6 THEN 'Moderate' "
    "WHEN abs({r}) < 0.8 THEN 'Strong' ELSE 'Very Strong' END"
)


def _pairs_sql(cols):
    parts = []
    for i in range(len(cols)):
        for j in range(i + 1, len(cols)):
            a, b = cols[i], cols[j]
            parts.append(f"SELECT '{a}' AS variable_1, '{b}' AS variable_2, corr({a}, {b}) AS r FROM bulk")
    return " UNION ALL ".join(parts)


@query(
    "d9_correlation_pairs",
    with_fixtures(
        "SELECT variable_1, variable_2, round(r, 6) AS correlation, round(abs(r), 6) AS abs_correlation, "
        + _STRENGTH.format(r="r")
        + " AS strength FROM ("
        + _pairs_sql(CORR7)
        + ")"
    ),
)
def d9_correlation_pairs(spark, sf_dir):
    """Upper-triangle Pearson pairs of seven F-BULK columns, one aggregate."""
    return S.correlation_pairs(FX.bulk(spark, sf_dir), CORR7)


def _matrix_sql(cols):
    rows = [f"SELECT '{a}' AS variable_1, '{b}' AS variable_2, {'1.0::DOUBLE' if a == b else f'corr({a}, {b})'} AS r FROM bulk" for a in cols for b in cols]
    return " UNION ALL ".join(f"({x} LIMIT 1)" if "corr" not in x else x for x in rows)


@query(
    "d9_correlation_matrix",
    with_fixtures(
        "SELECT variable_1, variable_2, round(r, 6) AS correlation, round(abs(r), 6) AS abs_correlation, "
        + _STRENGTH.format(r="r")
        + " AS strength FROM ("
        + _matrix_sql(CORR7)
        + ")"
    ),
)
def d9_correlation_matrix(spark, sf_dir):
    """The whole symmetric matrix of seven F-BULK columns, diagonal included."""
    return S.correlation_pairs(FX.bulk(spark, sf_dir), CORR7, full=True)


@query(
    "d10_top_correlation_pairs",
    with_fixtures(
        "SELECT variable_1, variable_2, round(r, 6) AS correlation, round(abs(r), 6) AS abs_correlation, "
        + _STRENGTH.format(r="r")
        + " AS strength FROM ("
        + _pairs_sql(CORR7)
        + ") ORDER BY abs(r) DESC, variable_1, variable_2 LIMIT 20"
    ),
)
def d10_top_correlation_pairs(spark, sf_dir):
    """The 20 strongest pairs (a top-k report)."""
    return S.top_correlation_pairs(FX.bulk(spark, sf_dir), CORR7, n=20)


@query(
    "d11_target_correlation",
    with_fixtures(
        " UNION ALL ".join(f"SELECT '{c}' AS variable, round(corr({c}, label), 6) AS correlation FROM bulk" for c in [*NUM, "grade"])
    ),
)
def d11_target_correlation(spark, sf_dir):
    """Signed r with the label, pairwise-complete, label itself dropped."""
    return S.target_correlation(FX.bulk(spark, sf_dir), [*NUM, "grade"], "label")


_CC = "bulk WHERE price IS NOT NULL AND unit_net IS NOT NULL AND grade IS NOT NULL"


@query(
    "d11_target_correlation_abs",
    with_fixtures(
        " UNION ALL ".join(
            f"SELECT '{c}' AS variable, round(abs(corr({c}, label)), 6) AS correlation FROM {_CC}" for c in [*NUM, "grade", "label"]
        )
    ),
)
def d11_target_correlation_abs(spark, sf_dir):
    """|r| with the label on complete cases, label kept (r = 1)."""
    return S.target_correlation(FX.bulk(spark, sf_dir), [*NUM, "grade"], "label", complete_cases=True, absolute=True)


# --- chi-square -------------------------------------------------------------------

_CELLS = (
    f"l AS ({long_sql(CAT, cast='VARCHAR', by=['label'])}), "
    "o AS (SELECT variable, value AS category, label AS cls, count(*) AS observed FROM l WHERE value IS NOT NULL GROUP BY ALL), "
    "g AS (SELECT DISTINCT a.variable, a.category, b.cls FROM o a JOIN o b ON a.variable = b.variable), "
    "c AS (SELECT g.variable, g.category, g.cls, coalesce(o.observed, 0) AS observed FROM g LEFT JOIN o "
    "ON g.variable = o.variable AND g.category = o.category AND g.cls = o.cls), "
    "e AS (SELECT *, sum(observed) OVER (PARTITION BY variable, category) * sum(observed) OVER (PARTITION BY variable, cls) "
    "/ sum(observed) OVER (PARTITION BY variable) AS expected, sum(observed) OVER (PARTITION BY variable) AS n, "
    "count(DISTINCT category) OVER (PARTITION BY variable) AS r, count(DISTINCT cls) OVER (PARTITION BY variable) AS k FROM c)"
)


@query(
    "d18_expected_frequencies",
    _extra(
        _CELLS,
        "SELECT variable, category, cls, CAST(observed AS BIGINT) AS observed, round(expected, 6) AS expected, "
        "round(observed - expected, 6) AS residual FROM e",
    ),
)
def d18_expected_frequencies(spark, sf_dir):
    """Observed, expected and residual cells of the three F-BULK categoricals."""
    return S.expected_frequencies(FX.bulk(spark, sf_dir), CAT, "label")


_CHI_STATS = (
    "cs AS (SELECT variable, chi2, dof, n, n_categories, n_classes, min_expected, "
    "sqrt(chi2 / (n * least(n_classes - 1, n_categories - 1))) AS cramers_v, sqrt(chi2 / 2.0) AS x1 FROM ("
    "SELECT variable, sum(CASE WHEN (r-1)*(k-1) = 1 THEN (abs(observed-expected) - least(0.5, abs(observed-expected)))^2 "
    "ELSE (observed-expected)^2 END / expected) AS chi2, CAST(any_value((r-1)*(k-1)) AS INTEGER) AS dof, "
    "CAST(any_value(n) AS BIGINT) AS n, CAST(any_value(r) AS INTEGER) AS n_categories, CAST(any_value(k) AS INTEGER) AS n_classes, "
    "min(expected) AS min_expected FROM e GROUP BY variable)), "
    f"cp AS (SELECT *, {chi2_sf_sql('chi2', 'dof', 'x1')} AS p_value FROM cs)"
)
_STARS = "CASE WHEN p_value < 0.001 THEN '***' WHEN p_value < 0.01 THEN '**' WHEN p_value < 0.05 THEN '*' ELSE 'ns' END"
_EFFECT = "CASE WHEN cramers_v < 0.1 THEN 'negligible' WHEN cramers_v < 0.3 THEN 'small' WHEN cramers_v < 0.5 THEN 'moderate' ELSE 'large' END"


@query(
    "d17_chi_square_stats",
    _extra(
        _CELLS,
        "SELECT variable, round(chi2, 6) AS chi2, dof, n, n_categories, n_classes, round(min_expected, 6) AS min_expected, "
        "round(sqrt(chi2 / (n * least(n_classes - 1, n_categories - 1))), 6) AS cramers_v FROM ("
        "SELECT variable, sum(CASE WHEN (r-1)*(k-1) = 1 THEN (abs(observed-expected) - least(0.5, abs(observed-expected)))^2 "
        "ELSE (observed-expected)^2 END / expected) AS chi2, CAST(any_value((r-1)*(k-1)) AS INTEGER) AS dof, "
        "CAST(any_value(n) AS BIGINT) AS n, CAST(any_value(r) AS INTEGER) AS n_categories, CAST(any_value(k) AS INTEGER) AS n_classes, "
        "min(expected) AS min_expected FROM e GROUP BY variable)",
    ),
)
def d17_chi_square_stats(spark, sf_dir):
    """Chi-square statistic (Yates at dof = 1), dof, min expected, Cramer's V."""
    return S.chi_square_stats(FX.bulk(spark, sf_dir), CAT, "label")


@query(
    "d22_chi_square_report",
    _extra(
        _CELLS + ", " + _CHI_STATS,
        f"SELECT variable, round(chi2, 6) AS chi2, round(p_value, 6) AS p_value, {_STARS} AS significance, "
        f"round(cramers_v, 6) AS cramers_v, {_EFFECT} AS effect_size, dof, round(min_expected, 6) AS min_expected, "
        "CASE WHEN min_expected >= 5 THEN 'Yes' ELSE 'No' END AS valid_test, "
        "CASE WHEN p_value < 0.05 AND cramers_v >= 0.1 THEN 'Yes' ELSE 'No' END AS useful FROM cp",
    ),
)
def d22_chi_square_report(spark, sf_dir):
    """The full chi-square report with p-values, stars and flags."""
    return S.chi_square_report(FX.bulk(spark, sf_dir), CAT, "label")


# --- rank tests, effect sizes --------------------------------------------------------


@query(
    "d19_cohens_d",
    with_fixtures(
        " UNION ALL ".join(
            f"SELECT '{c}' AS variable, round((avg({c}) FILTER (WHERE label = 0) - avg({c}) FILTER (WHERE label = 1)) / "
            f"sqrt(((count({c}) FILTER (WHERE label = 0) - 1) * var_samp({c}) FILTER (WHERE label = 0) + "
            f"(count({c}) FILTER (WHERE label = 1) - 1) * var_samp({c}) FILTER (WHERE label = 1)) / "
            f"(count({c}) FILTER (WHERE label = 0) + count({c}) FILTER (WHERE label = 1) - 2)), 6) AS cohens_d FROM bulk"
            for c in NUM
        )
    ),
)
def d19_cohens_d(spark, sf_dir):
    return S.cohens_d(FX.bulk(spark, sf_dir), NUM, "label")


_MWU = (
    f"lm AS ({long_sql(NUM, by=['label'])}), "
    "v AS (SELECT variable, value, count_if(label = 0) AS c0, count(*) AS t FROM lm WHERE value IS NOT NULL GROUP BY ALL), "
    "rkm AS (SELECT *, coalesce(sum(t) OVER (PARTITION BY variable ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) "
    "+ (t + 1) / 2.0 AS avg_rank FROM v), "
    "s AS (SELECT variable, sum(c0) AS n0, sum(t) - sum(c0) AS n1, sum(c0 * avg_rank) AS r0, sum(t*t*t - t) AS tie FROM rkm GROUP BY variable)"
)


@query(
    "d20_mann_whitney_u",
    _extra(
        _MWU,
        "SELECT variable, CAST(n0 AS BIGINT) AS n_0, CAST(n1 AS BIGINT) AS n_1, round(r0 - n0 * (n0 + 1) / 2.0, 6) AS u_statistic, "
        "round((greatest(r0 - n0 * (n0 + 1) / 2.0, n0 * n1 - (r0 - n0 * (n0 + 1) / 2.0)) - n0 * n1 / 2.0 - 0.5) / "
        "sqrt(n0 * n1 / 12.0 * ((n0 + n1 + 1) - tie / ((n0 + n1) * (n0 + n1 - 1)))), 6) AS z FROM s",
    ),
)
def d20_mann_whitney_u(spark, sf_dir):
    """U of class 0 and its tie- and continuity-corrected z, per column."""
    return S.mann_whitney(FX.bulk(spark, sf_dir), NUM, "label").drop("p_value")


_MWU_Z = (
    "mz AS (SELECT variable, n0, n1, r0 - n0 * (n0 + 1) / 2.0 AS u0, "
    "CASE WHEN n0 * n1 / 12.0 * ((n0 + n1 + 1) - tie / ((n0 + n1) * (n0 + n1 - 1))) > 0 THEN "
    "(greatest(r0 - n0 * (n0 + 1) / 2.0, n0 * n1 - (r0 - n0 * (n0 + 1) / 2.0)) - n0 * n1 / 2.0 - 0.5) / "
    "sqrt(n0 * n1 / 12.0 * ((n0 + n1 + 1) - tie / ((n0 + n1) * (n0 + n1 - 1)))) END AS z FROM s), "
    "mx AS (SELECT *, abs(z) / sqrt(2.0) AS x2 FROM mz), "
    f"mp AS (SELECT *, CASE WHEN z IS NULL THEN 1.0 ELSE {two_sided_normal_sql('x2')} END AS p_value FROM mx)"
)


@query(
    "d20_mann_whitney_test",
    _extra(
        _MWU + ", " + _MWU_Z,
        "SELECT variable, CAST(n0 AS BIGINT) AS n_0, CAST(n1 AS BIGINT) AS n_1, round(u0, 6) AS u_statistic, round(z, 6) AS z, "
        "round(p_value, 6) AS p_value FROM mp",
    ),
)
def d20_mann_whitney_test(spark, sf_dir):
    """U, z and the two-sided p-value."""
    return S.mann_whitney(FX.bulk(spark, sf_dir), NUM, "label")


_NATIONS_SQL = (
    "WITH v AS (SELECT n_nationkey AS k, CASE WHEN n_regionkey = 0 THEN 1 ELSE 0 END AS label, coalesce(avg(c_acctbal), 0) + n_nationkey / 1000.0 AS balance, "
    "coalesce(max(c_acctbal), 0) - n_nationkey / 7.0 AS largest FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey, n_regionkey), "
    "l AS (SELECT label, 'balance' AS variable, balance AS x FROM v UNION ALL SELECT label, 'largest', largest FROM v), "
    "r AS (SELECT variable, label, row_number() OVER (PARTITION BY variable ORDER BY x) AS r FROM l), "
    "u AS (SELECT variable, count_if(label = 0) AS n_0, count_if(label = 1) AS n_1, sum(r) FILTER (WHERE label = 0) - count_if(label = 0) * (count_if(label = 0) + 1) / 2.0 AS u "
    "FROM r GROUP BY variable), n AS (SELECT unnest(range(1, 26)) AS i), "
    # every choice of five ranks out of 25
    "s AS (SELECT a.i + b.i + c.i + d.i + e.i - 15 AS u FROM n a JOIN n b ON b.i > a.i JOIN n c ON c.i > b.i JOIN n d ON d.i > c.i JOIN n e ON e.i > d.i) "
    "SELECT variable, CAST(n_0 AS BIGINT) AS n_0, CAST(n_1 AS BIGINT) AS n_1, round(u::DOUBLE, 6) AS u_statistic, "
    "round(least(1.0, 2.0 * (SELECT count_if(s.u <= least(x.u, 100 - x.u)) FROM s) / 53130.0), 6) AS p_value FROM u x"
)


@query("d20_mann_whitney_exact", _NATIONS_SQL)
def d20_mann_whitney_exact(spark, sf_dir):
    """D20 on small classes without ties: the exact U test of the nations' customer balances, one region against the others."""
    c, n = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("customer", "nation"))
    per = c.groupBy("c_nationkey").agg(F.avg("c_acctbal").alias("mean"), F.max("c_acctbal").alias("top"))
    df = n.join(per, n["n_nationkey"] == per["c_nationkey"], "left").select(
        F.when(F.col("n_regionkey") == 0, 1).otherwise(0).alias("label"),
        (F.coalesce("mean", F.lit(0.0)) + F.col("n_nationkey") / 1000.0).alias("balance"),
        (F.coalesce("top", F.lit(0.0)) - F.col("n_nationkey") / 7.0).alias("largest"),
    )
    return S.mann_whitney(df, ["balance", "largest"], "label").drop("z")


_COHEN_ABS = " UNION ALL ".join(f"SELECT '{c}' AS variable, abs((avg({c}) FILTER (WHERE label = 0) - avg({c}) FILTER (WHERE label = 1)) / " f"sqrt(((count({c}) FILTER (WHERE label = 0) - 1) * var_samp({c}) FILTER (WHERE label = 0) + " f"(count({c}) FILTER (WHERE label = 1) - 1) * var_samp({c}) FILTER (WHERE label = 1)) / " f"(count({c}) FILTER (WHERE label = 0) + count({c}) FILTER (WHERE label = 1) - 2))) AS effect FROM bulk" for c in NUM)
_RANKING = (
    _CELLS + ", " + _CHI_STATS + ", " + _MWU + ", " + _MWU_Z + f", cd AS ({_COHEN_ABS}), "
    "u AS (SELECT mp.variable, 'Continuous' AS type, cd.effect AS effect_size, 'Cohen''s d' AS effect_metric, p_value "
    "FROM mp JOIN cd ON mp.variable = cd.variable UNION ALL "
    "SELECT variable, 'Categorical', cramers_v, 'Cramér''s V', p_value FROM cp), "
    "sc AS (SELECT *, CASE WHEN p_value < 0.05 THEN effect_size * -log10(CASE WHEN p_value <= 0 THEN 1e-300 ELSE p_value END) "
    "ELSE 0.0 END AS importance_score FROM u), "
    "rk AS (SELECT CAST(row_number() OVER (ORDER BY importance_score DESC, variable) AS INTEGER) AS rank, *, "
    "CASE WHEN p_value >= 0.05 THEN 'Non-Significant' WHEN effect_size < 0.1 THEN 'Insignificant' WHEN effect_size < 0.2 "
    "THEN 'Small Significance' WHEN effect_size < 0.5 THEN 'Moderate Significance' ELSE 'Strong Significance' END AS usefulness FROM sc)"
)


@query(
    "d20_importance_ranking",
    _extra(
        _RANKING,
        "SELECT rank, variable, type, round(effect_size, 6) AS effect_size, effect_metric, round(p_value, 6) AS p_value, "
        "round(importance_score, 6) AS importance_score, usefulness FROM rk",
    ),
)
def d20_importance_ranking(spark, sf_dir):
    """Combined continuous + categorical importance ranking."""
    return S.importance_ranking(FX.bulk(spark, sf_dir), NUM, CAT, "label")


@query(
    "d21_segments",
    _extra(
        _RANKING + ", sg AS (SELECT *, CASE WHEN p_value >= 0.05 THEN 'not_significant' WHEN effect_size >= 0.2 THEN 'high' "
        "WHEN effect_size >= 0.1 THEN 'moderate' ELSE 'low' END AS segment FROM rk)",
        "SELECT segment, CAST(count(*) AS BIGINT) AS n_variables, string_agg(variable, ',' ORDER BY variable) AS variables, "
        "CASE segment WHEN 'high' THEN 'include' WHEN 'moderate' THEN 'consider' ELSE 'exclude' END AS action FROM sg GROUP BY segment",
    ),
)
def d21_segments(spark, sf_dir):
    """Variables per usefulness segment with the recommended action."""
    return S.segments(S.importance_ranking(FX.bulk(spark, sf_dir), NUM, CAT, "label"))


# --- VIF --------------------------------------------------------------------------

_VIF3 = ["quantity", "discount", "tax"]


def _vif_sql():
    a, b, c = _VIF3
    g = (
        f"SELECT sum({a}*{a}) AS g00, sum({a}*{b}) AS g01, sum({a}*{c}) AS g02, sum({b}*{b}) AS g11, "
        f"sum({b}*{c}) AS g12, sum({c}*{c}) AS g22 FROM bulk WHERE {a} IS NOT NULL AND {b} IS NOT NULL AND {c} IS NOT NULL"
    )
    det = "(g00*(g11*g22 - g12*g12) - g01*(g01*g22 - g12*g02) + g02*(g01*g12 - g11*g02))"
    return _extra(
        f"gm AS ({g})",
        f"SELECT '{a}' AS feature, round(g00*(g11*g22 - g12*g12)/{det}, 6) AS vif FROM gm UNION ALL "
        f"SELECT '{b}', round(g11*(g00*g22 - g02*g02)/{det}, 6) FROM gm UNION ALL "
        f"SELECT '{c}', round(g22*(g00*g11 - g01*g01)/{det}, 6) FROM gm",
    )


@query("d23_vif", _vif_sql())
def d23_vif(spark, sf_dir):
    """Uncentred VIF of three F-BULK columns (one Gram aggregate)."""
    return S.vif(FX.bulk(spark, sf_dir), _VIF3)


def _det(g: list[list[str]]) -> str:
    """Determinant of a small matrix of SQL terms, by the first row."""
    if len(g) == 1:
        return g[0][0]
    terms = [f"{'+-'[j % 2]} {g[0][j]} * ({_det([row[:j] + row[j + 1 :] for row in g[1:]])})" for j in range(len(g))]
    return " ".join(terms)


def _vif_dependent_sql():
    # price, gross_discount and net span two dimensions: their own VIF is infinite, and the others' follows from any two of them
    cols = ["price", "price * discount", "quantity", "tax"]
    n = range(len(cols))
    sums = ", ".join(f"sum(({cols[i]}) * ({cols[j]})) AS g{i}{j}" for i in n for j in n if i <= j)
    g = [[f"g{min(i, j)}{max(i, j)}" for j in n] for i in n]

    def vif(i):
        minor = [[g[a][b] for b in n if b != i] for a in n if a != i]
        return f"g{i}{i} * ({_det(minor)}) / ({_det(g)})"

    endless = " UNION ALL ".join(f"SELECT '{c}' AS feature, 'inf'::DOUBLE AS vif" for c in ("price", "gross_discount", "net"))
    return _extra(f"gm AS (SELECT {sums} FROM bulk WHERE price IS NOT NULL AND discount IS NOT NULL AND quantity IS NOT NULL AND tax IS NOT NULL)", f"{endless} UNION ALL SELECT 'quantity', round({vif(2)}, 6) FROM gm UNION ALL SELECT 'tax', round({vif(3)}, 6) FROM gm")


@query("d23_vif_dependent", _vif_dependent_sql())
def d23_vif_dependent(spark, sf_dir):
    """D23 with an exact linear dependency (net = price - price*discount): +inf rows."""
    from pyspark.sql import functions as F

    df = FX.bulk(spark, sf_dir).withColumn("gross_discount", F.col("price") * F.col("discount"))
    df = df.withColumn("net", F.col("price") - F.col("gross_discount"))
    return S.vif(df, ["price", "gross_discount", "net", "quantity", "tax"])
