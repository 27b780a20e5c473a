"""Registered queries on degenerate columns: one value only, and a category of several hundred values."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskline.operators import stats as S
from riskline.plans.describe_queries import _extra
from riskline.plans.registry import query
from riskline.plans.stats_queries import _EFFECT, _STARS, _STRENGTH
from riskline.sources import fixtures as FX

PAIRED = ["quantity", "same", "tax", "label"]
CATEGORIES = ["grade", "same", "many"]


def _bulk(spark, sf_dir):
    return FX.bulk(spark, sf_dir).withColumns({"same": F.lit(7.0), "many": F.col("l_partkey") % 301})


_PLUS = "bx AS (SELECT *, 7.0::DOUBLE AS same, l_partkey % 301 AS many FROM bulk)"


def _pairs() -> str:
    out = []
    for i, a in enumerate(PAIRED):
        for b in PAIRED[i + 1 :]:
            varied = f"count(DISTINCT {a}) FILTER ({b} IS NOT NULL) > 1 AND count(DISTINCT {b}) FILTER ({a} IS NOT NULL) > 1"
            out.append(f"SELECT '{a}' AS variable_1, '{b}' AS variable_2, CASE WHEN {varied} THEN corr({a}, {b}) END AS r FROM bx")
    return " UNION ALL ".join(out)


@query(
    "d9_correlation_constant_column",
    _extra(
        _PLUS,
        "SELECT variable_1, variable_2, round(r, 6) AS correlation, round(abs(r), 6) AS abs_correlation, CASE WHEN r IS NOT NULL THEN "
        + _STRENGTH.format(r="r")
        + f" END AS strength FROM ({_pairs()})",
    ),
)
def d9_correlation_constant_column(spark, sf_dir):
    """D9 with a column of one value: NULL for its pairs, the others as ever."""
    return S.correlation_pairs(_bulk(spark, sf_dir), PAIRED)


_LONG = " UNION ALL ".join(f"SELECT '{c}' AS variable, {c}::VARCHAR AS category, label AS cls FROM bx WHERE {c} IS NOT NULL" for c in CATEGORIES)
_TESTED = (
    f"{_PLUS}, l AS ({_LONG}), o AS (SELECT variable, category, cls, count(*) AS c FROM l GROUP BY ALL), "
    "rt AS (SELECT variable, category, sum(c) AS rc FROM o GROUP BY ALL), ct AS (SELECT variable, cls, sum(c) AS cc FROM o GROUP BY ALL), "
    "nt AS (SELECT variable, sum(c) AS n, count(DISTINCT category) AS r, count(DISTINCT cls) AS k FROM o GROUP BY ALL), "
    "e AS (SELECT rt.variable, coalesce(o.c, 0)::DOUBLE AS observed, (rc::DOUBLE * cc / n) AS expected, n, r, k FROM rt JOIN ct USING (variable) "
    "JOIN nt USING (variable) LEFT JOIN o ON o.variable = rt.variable AND o.category = rt.category AND o.cls = ct.cls), "
    "s AS (SELECT variable, sum((observed - expected)^2 / expected) AS chi2, any_value((r - 1) * (k - 1))::INTEGER AS dof, any_value(n) AS n, "
    "any_value(least(r - 1, k - 1)) AS m, min(expected) AS min_expected FROM e GROUP BY variable), "
    # an even number of degrees of freedom: exp(-h) * sum of h^i / i!, by logarithms
    "cp AS (SELECT *, CASE WHEN m > 0 THEN sqrt(chi2 / (n * m)) END AS cramers_v, CASE WHEN dof = 0 THEN 1.0 ELSE "
    "least(1.0, list_sum(list_transform(range(0, dof // 2), lambda i: exp(i * ln(chi2 / 2) - lgamma(i + 1) - chi2 / 2)))) END AS p_value FROM s)"
)


@query(
    "d22_chi_square_degenerate",
    _extra(
        _TESTED,
        f"SELECT variable, round(chi2, 6) AS chi2, round(p_value, 6) AS p_value, {_STARS} AS significance, round(cramers_v, 6) AS cramers_v, "
        f"CASE WHEN cramers_v IS NOT NULL THEN {_EFFECT} END AS effect_size, dof, round(min_expected, 6) AS min_expected, "
        "CASE WHEN min_expected >= 5 THEN 'Yes' ELSE 'No' END AS valid_test, "
        "CASE WHEN p_value < 0.05 AND cramers_v >= 0.1 THEN 'Yes' ELSE 'No' END AS useful FROM cp WHERE variable <> 'grade'",
    ),
)
def d22_chi_square_degenerate(spark, sf_dir):
    """D22 with a variable of one value (no freedom: p = 1, V undefined) and one of 301 values (300 degrees of freedom)."""
    return S.chi_square_report(_bulk(spark, sf_dir), CATEGORIES, "label").where("variable <> 'grade'")
