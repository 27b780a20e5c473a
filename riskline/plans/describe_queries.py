"""Registered queries: schema, descriptive statistics, crosstabs, plot data."""

from __future__ import annotations

import math

from riskline.operators import describe as D
from riskline.plans.registry import query
from riskline.sources import fixtures as FX
from riskline.sources.fixtures import with_fixtures
from riskline.sources.readers import table

NUM = FX.BULK_NUMERIC
CAT = ["grade", "flag", "status"]


def _extra(extra_cte: str, body: str) -> str:
    return with_fixtures("").rstrip() + f", {extra_cte}\n{body}"


def long_sql(cols, source="bulk", cast="DOUBLE", by=()):
    byc = "".join(f"{b}, " for b in by)
    return " UNION ALL ".join(
        f"SELECT {byc}'{c}' AS variable, CAST({c} AS {cast}) AS value FROM {source}" for c in cols
    )


# --- A5 ---------------------------------------------------------------------------

_BULK_TYPES = [
    ("l_orderkey", "bigint"), ("l_linenumber", "int"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
    ("quantity", "double"), ("price", "double"), ("unit_net", "double"), ("discount", "double"), ("tax", "double"),
    ("grade", "int"), ("flag", "string"), ("status", "string"), ("label", "int"),
]


@query(
    "a5_schema_profile",
    with_fixtures(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column, {i} AS position, '{t}' AS dtype, CAST(count({c}) AS BIGINT) AS non_null, "
            f"CAST(count(*) AS BIGINT) AS n_rows FROM bulk"
            for i, (c, t) in enumerate(_BULK_TYPES)
        )
    ),
)
def a5_schema_profile(spark, sf_dir):
    """A5: name, position, type and non-null count of every F-BULK column (one scan)."""
    return D.schema_profile(FX.bulk(spark, sf_dir))


# --- B7 / D7 ----------------------------------------------------------------------

_CARD = [*NUM, "grade", "label"]


@query(
    "b7_cardinality_types",
    _extra(
        f"l AS ({long_sql(_CARD, cast='VARCHAR')})",
        "SELECT variable, CAST(count(DISTINCT value) AS BIGINT) AS n_distinct, "
        "CASE WHEN count(DISTINCT value) > 4 THEN 'numerical' ELSE 'categorical' END AS kind FROM l GROUP BY variable",
    ),
)
def b7_cardinality_types(spark, sf_dir):
    """Numeric columns with more than 4 distinct values are numerical."""
    return D.cardinality_types(FX.bulk(spark, sf_dir), _CARD)


@query(
    "d7_distinct_counts",
    _extra(
        f"l AS ({long_sql(CAT, cast='VARCHAR')})",
        "SELECT variable, CAST(count(DISTINCT value) AS BIGINT) AS n_distinct FROM l GROUP BY variable",
    ),
)
def d7_distinct_counts(spark, sf_dir):
    return D.distinct_counts(FX.bulk(spark, sf_dir), CAT)


# --- D4 / D5 ----------------------------------------------------------------------


def _cont_sql(cols):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS variable, CAST(count({c}) AS BIGINT) AS count, CAST(count(*) - count({c}) AS BIGINT) AS missing, "
        f"round((count(*) - count({c})) / count(*) * 100, 6) AS missing_pct, round(avg({c}), 6) AS mean, "
        f"round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS q25, "
        f"round(quantile_cont({c}, 0.5), 6) AS median, round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max FROM bulk"
        for c in cols
    )


@query("d5_continuous_summary", with_fixtures(_cont_sql(NUM)))
def d5_continuous_summary(spark, sf_dir):
    """D5 on the numerical F-BULK columns."""
    return D.continuous_summary(FX.bulk(spark, sf_dir), NUM)


def _describe_sql():
    num = (
        "SELECT variable, count, CAST(NULL AS BIGINT) AS n_unique, CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq, "
        "mean, std, min, q25, median, q75, max FROM (" + _cont_sql(NUM) + ")"
    )
    cat = (
        "SELECT variable, count, n_unique, top, freq, NULL::DOUBLE AS mean, NULL::DOUBLE AS std, NULL::DOUBLE AS min, "
        "NULL::DOUBLE AS q25, NULL::DOUBLE AS median, NULL::DOUBLE AS q75, NULL::DOUBLE AS max FROM ("
        "SELECT variable, CAST(sum(c) AS BIGINT) AS count, CAST(count(*) AS BIGINT) AS n_unique, "
        "arg_min(value, (-c, value)) AS top, CAST(max(c) AS BIGINT) AS freq FROM ("
        f"SELECT variable, value, count(*) AS c FROM ({long_sql(['flag', 'status'], cast='VARCHAR')}) WHERE value IS NOT NULL GROUP BY ALL"
        ") GROUP BY variable)"
    )
    return with_fixtures(num + " UNION ALL " + cat)


@query("d4_describe", _describe_sql())
def d4_describe(spark, sf_dir):
    """D4 (include="all") on numerical + string columns of F-BULK."""
    return D.describe(FX.bulk(spark, sf_dir), NUM, ["flag", "status"])


# --- D6 / D8 ----------------------------------------------------------------------


@query(
    "d6_value_counts",
    _extra(
        f"l AS ({long_sql(CAT, cast='VARCHAR')})",
        "SELECT variable, value, CAST(count(*) AS BIGINT) AS count, round(count(*) / (SELECT count(*) FROM bulk) * 100, 6) AS percentage "
        "FROM l WHERE value IS NOT NULL GROUP BY variable, value",
    ),
)
def d6_value_counts(spark, sf_dir):
    return D.value_counts(FX.bulk(spark, sf_dir), CAT)


@query(
    "e7_value_counts_by_value",
    _extra(
        f"l AS ({long_sql(CAT, cast='VARCHAR')})",
        "SELECT variable, value, CAST(count(*) AS BIGINT) AS count, round(count(*) / (SELECT count(*) FROM bulk) * 100, 6) AS percentage, "
        "row_number() OVER (ORDER BY variable, try_cast(value AS DOUBLE) NULLS LAST, value) AS place FROM l WHERE value IS NOT NULL GROUP BY variable, value",
    ),
)
def e7_value_counts_by_value(spark, sf_dir):
    """Value counts in the order of the values; ``place`` states the row's place in the report."""
    report = D.value_counts(FX.bulk(spark, sf_dir), CAT, by_value=True).collect()  # a row per category
    rows = [(*r, k + 1) for k, r in enumerate(report)]
    return spark.createDataFrame(rows, "variable string, value string, count bigint, percentage double, place bigint")


@query(
    "d8_class_balance",
    with_fixtures(
        "SELECT status, CAST(count(*) AS BIGINT) AS n, CAST(sum(label) AS BIGINT) AS positives, "
        "round(avg(label::DOUBLE), 6) AS positive_rate FROM bulk GROUP BY status"
    ),
)
def d8_class_balance(spark, sf_dir):
    """Label rate per group (here per line status)."""
    return D.class_balance(FX.bulk(spark, sf_dir), "label", ["status"])


# --- D12 --------------------------------------------------------------------------


def _cmp_sql(cols):
    parts = []
    for c in cols:
        parts.append(
            f"SELECT '{c}' AS variable, quantile_cont({c}, 0.5) FILTER (WHERE label = 0) AS median_0, "
            f"quantile_cont({c}, 0.5) FILTER (WHERE label = 1) AS median_1, avg({c}) FILTER (WHERE label = 0) AS mean_0, "
            f"avg({c}) FILTER (WHERE label = 1) AS mean_1, stddev_samp({c}) FILTER (WHERE label = 0) AS std_0, "
            f"stddev_samp({c}) FILTER (WHERE label = 1) AS std_1 FROM bulk"
        )
    inner = " UNION ALL ".join(parts)
    return with_fixtures(
        "SELECT variable, round(median_0, 6) AS median_0, round(median_1, 6) AS median_1, round(mean_0, 6) AS mean_0, "
        "round(mean_1, 6) AS mean_1, round(std_0, 6) AS std_0, round(std_1, 6) AS std_1, "
        "round(median_1 - median_0, 6) AS diff_median, round(mean_1 - mean_0, 6) AS diff_mean, round(std_1 - std_0, 6) AS diff_std, "
        "round(CASE WHEN median_0 <> 0 THEN (median_1 - median_0) / median_0 * 100 ELSE 0.0 END, 6) AS pct_diff_median, "
        "round(CASE WHEN mean_0 <> 0 THEN std_0 / mean_0 ELSE 0.0 END, 6) AS cv_0, "
        "round(CASE WHEN mean_1 <> 0 THEN std_1 / mean_1 ELSE 0.0 END, 6) AS cv_1 FROM (" + inner + ")"
    )


@query("d12_group_comparison", _cmp_sql(NUM))
def d12_group_comparison(spark, sf_dir):
    """Class-0 vs class-1 medians, means and sample std per numerical column."""
    return D.group_comparison(FX.bulk(spark, sf_dir), NUM, "label")


# --- D13-D16 ----------------------------------------------------------------------

_LT = f"l AS ({long_sql(CAT, cast='VARCHAR', by=['label'])})"


@query(
    "d13_crosstab",
    _extra(
        _LT,
        "SELECT variable, value AS category, CAST(count_if(label = 0) AS BIGINT) AS n_0, CAST(count_if(label = 1) AS BIGINT) AS n_1, "
        "CAST(count(*) AS BIGINT) AS total FROM l WHERE value IS NOT NULL GROUP BY variable, value",
    ),
)
def d13_crosstab(spark, sf_dir):
    return D.crosstab(FX.bulk(spark, sf_dir), CAT, "label")


@query(
    "d15_crosstab_margins",
    _extra(
        _LT,
        "SELECT variable, value AS category, CAST(count_if(label = 0) AS BIGINT) AS n_0, CAST(count_if(label = 1) AS BIGINT) AS n_1, "
        "CAST(count(*) AS BIGINT) AS total FROM l WHERE value IS NOT NULL GROUP BY variable, value UNION ALL "
        "SELECT variable, 'All', CAST(count_if(label = 0) AS BIGINT), CAST(count_if(label = 1) AS BIGINT), CAST(count(*) AS BIGINT) "
        "FROM l WHERE value IS NOT NULL GROUP BY variable",
    ),
)
def d15_crosstab_margins(spark, sf_dir):
    return D.crosstab(FX.bulk(spark, sf_dir), CAT, "label", margins=True)


@query(
    "d14_crosstab_row_pct",
    _extra(
        _LT,
        "SELECT variable, value AS category, round(count_if(label = 0) / count(*) * 100, 6) AS pct_0, "
        "round(count_if(label = 1) / count(*) * 100, 6) AS pct_1 FROM l WHERE value IS NOT NULL GROUP BY variable, value",
    ),
)
def d14_crosstab_row_pct(spark, sf_dir):
    return D.crosstab_row_pct(FX.bulk(spark, sf_dir), CAT, "label")


@query(
    "d16_prevalence",
    _extra(
        _LT,
        "SELECT variable, value AS category, CAST(count(*) AS BIGINT) AS n, CAST(count_if(label = 1) AS BIGINT) AS positives, "
        "round(count_if(label = 1) / count(*) * 100, 6) AS rate FROM l WHERE value IS NOT NULL GROUP BY variable, value",
    ),
)
def d16_prevalence(spark, sf_dir):
    return D.prevalence(FX.bulk(spark, sf_dir), CAT, "label")


@query(
    "d16_prevalence_gap",
    _extra(
        _LT + ", p AS (SELECT variable, value, count_if(label = 1) / count(*) * 100 AS rate FROM l WHERE value IS NOT NULL GROUP BY ALL)",
        "SELECT variable, round(min(rate), 6) AS min_rate, round(max(rate), 6) AS max_rate, round(max(rate) - min(rate), 6) AS rate_gap, "
        "CASE WHEN max(rate) - min(rate) > 10 THEN 'useful' ELSE 'limited' END AS interpretation FROM p GROUP BY variable",
    ),
)
def d16_prevalence_gap(spark, sf_dir):
    return D.prevalence_gap(FX.bulk(spark, sf_dir), CAT, "label")


# --- D26-D28 ----------------------------------------------------------------------


@query(
    "d26_histogram",
    _extra(
        f"l AS ({long_sql(NUM)}), r AS (SELECT variable, min(value) AS mn, max(value) AS mx FROM l GROUP BY variable), "
        "b AS (SELECT l.variable, CASE WHEN mx = mn THEN 1 ELSE CAST(least(floor((value - mn) / (mx - mn) * 30) + 1, 30) AS INTEGER) END AS bin "
        "FROM l JOIN r USING (variable) WHERE value IS NOT NULL), c AS (SELECT variable, bin, count(*) AS n FROM b GROUP BY ALL), "
        "g AS (SELECT variable, mn, mx, CAST(s.generate_series AS INTEGER) AS bin FROM r, generate_series(1, 30) s)",
        "SELECT g.variable, g.bin, round(mn + (mx - mn) / 30 * (g.bin - 1), 6) AS lower, round(mn + (mx - mn) / 30 * g.bin, 6) AS upper, "
        "CAST(coalesce(c.n, 0) AS BIGINT) AS count FROM g LEFT JOIN c ON g.variable = c.variable AND g.bin = c.bin",
    ),
)
def d26_histogram(spark, sf_dir):
    """30 equal-width bins per numerical column."""
    return D.histogram(FX.bulk(spark, sf_dir), NUM, bins=30)


@query(
    "d27_box_stats",
    _extra(
        f"l AS ({long_sql(NUM, by=['label'])}), q AS (SELECT label, variable, quantile_cont(value, 0.25) AS q1, "
        "quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 FROM l WHERE value IS NOT NULL GROUP BY ALL)",
        "SELECT q.label, q.variable, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, "
        "round(min(value) FILTER (WHERE value >= q1 - 1.5*(q3-q1) AND value <= q3 + 1.5*(q3-q1)), 6) AS whisker_low, "
        "round(max(value) FILTER (WHERE value >= q1 - 1.5*(q3-q1) AND value <= q3 + 1.5*(q3-q1)), 6) AS whisker_high, "
        "CAST(count_if(NOT (value >= q1 - 1.5*(q3-q1) AND value <= q3 + 1.5*(q3-q1))) AS BIGINT) AS n_outliers, "
        "round(q3 - q1, 6) AS iqr FROM l JOIN q ON l.label = q.label AND l.variable = q.variable "
        "WHERE value IS NOT NULL GROUP BY q.label, q.variable, q1, median, q3",
    ),
)
def d27_box_stats(spark, sf_dir):
    """Box-plot statistics per numerical column and class."""
    return D.box_stats(FX.bulk(spark, sf_dir), NUM, by=["label"])


@query(
    "d28_kde_density",
    _extra(
        "s AS (SELECT label, count(unit_net) AS n, stddev_samp(unit_net) * pow(count(unit_net), -0.2) AS h, "
        "min(unit_net) AS mn, (max(unit_net) - min(unit_net)) / 99 AS step FROM bulk WHERE unit_net IS NOT NULL GROUP BY label)",
        "SELECT s.label, CAST(g.generate_series AS INTEGER) AS point, round(mn + step * g.generate_series, 6) AS x, "
        f"round(sum(exp(-0.5 * ((mn + step * g.generate_series - unit_net) / h) * ((mn + step * g.generate_series - unit_net) / h)) "
        f"/ (n * h * {math.sqrt(2 * math.pi)!r})), 6) AS density "
        "FROM bulk b JOIN s ON b.label = s.label, generate_series(0, 99) g WHERE unit_net IS NOT NULL GROUP BY s.label, g.generate_series, mn, step",
    ),
)
def d28_kde_density(spark, sf_dir):
    """Gaussian KDE of ``unit_net`` per class on 100 grid points."""
    return D.kde_density(FX.bulk(spark, sf_dir), "unit_net", "label", grid_points=100)


@query(
    "d27_box_stats_skewed",
    _extra(
        "q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 FROM events)",
        "SELECT 'value' AS variable, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, "
        "round(min(value) FILTER (WHERE value >= q1 - 1.5*(q3-q1) AND value <= q3 + 1.5*(q3-q1)), 6) AS whisker_low, "
        "round(max(value) FILTER (WHERE value >= q1 - 1.5*(q3-q1) AND value <= q3 + 1.5*(q3-q1)), 6) AS whisker_high, "
        "CAST(count_if(NOT (value >= q1 - 1.5*(q3-q1) AND value <= q3 + 1.5*(q3-q1))) AS BIGINT) AS n_outliers, "
        "round(q3 - q1, 6) AS iqr FROM events CROSS JOIN q GROUP BY q1, median, q3",
    ),
)
def d27_box_stats_skewed(spark, sf_dir):
    """D27 on the skewed ``events.value`` fixture."""
    return D.box_stats(table(spark, sf_dir, "events"), ["value"])
