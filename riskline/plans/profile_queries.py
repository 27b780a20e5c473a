"""Registered queries: loading, cleaning, missing data and outliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskline.operators import missing, outliers
from riskline.plans.registry import query
from riskline.sources import fixtures as FX
from riskline.sources.fixtures import with_fixtures

NUM = FX.BULK_NUMERIC
ALL_BULK = [*NUM, *FX.BULK_CATEGORICAL, FX.BULK_TARGET]


def _sql_missing(cols, source="bulk"):
    parts = [
        f"SELECT '{c}' AS column, CAST(count_if({c} IS NULL) AS BIGINT) AS missing_values, "
        f"round(count_if({c} IS NULL) / count(*) * 100, 6) AS percentage FROM {source}"
        for c in cols
    ]
    return with_fixtures(" UNION ALL ".join(parts))


@query("c1_missing_summary", _sql_missing(ALL_BULK))
def c1_missing_summary(spark, sf_dir):
    """C1 on F-BULK."""
    return missing.missing_value_summary(FX.bulk(spark, sf_dir), ALL_BULK)


def _sql_imputation():
    gate = lambda c: f"(SELECT count_if({c} IS NULL) / count(*) FROM bulk) < 0.05"
    med = lambda c: f"(SELECT quantile_cont({c}, 0.5) FROM bulk)"
    mode = lambda c: f"(SELECT {c} FROM bulk WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
    sel = ", ".join(
        [f"CASE WHEN {gate(c)} THEN coalesce({c}, {med(c)}) ELSE {c} END AS {c}" for c in NUM]
        + [f"CASE WHEN {gate('grade')} THEN coalesce(grade, {mode('grade')}) ELSE grade END AS grade"]
    )
    return with_fixtures(
        "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
        + ", ".join(f"round({c}, 6) AS {c}" for c in NUM)
        + ", grade FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, " + sel + " FROM bulk) t"
    )


@query("c6_simple_imputation", _sql_imputation())
def c6_simple_imputation(spark, sf_dir):
    """Median for numerical, mode for categorical, only below a 5% null rate."""
    df = FX.bulk(spark, sf_dir)
    out = missing.simple_imputation(df, NUM, ["grade"], threshold=0.05)
    return out.select(*FX.BULK_ID, *NUM, "grade")


def _with_extra(extra_cte: str, body: str) -> str:
    return with_fixtures("").rstrip() + f", {extra_cte}\n{body}"


def _sql_iqr(cols):
    q = ", ".join(f"quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.75) AS {c}_q3" for c in cols)
    cond = lambda c: f"{c} < {c}_q1 - 1.5*({c}_q3-{c}_q1) OR {c} > {c}_q3 + 1.5*({c}_q3-{c}_q1)"
    parts = [
        f"SELECT '{c}' AS column, CAST(count_if({cond(c)}) AS BIGINT) AS count, "
        f"round(count_if({cond(c)}) / count(*) * 100, 6) AS percentage FROM bulk CROSS JOIN q"
        for c in cols
    ]
    return _with_extra(f"q AS (SELECT {q} FROM bulk)", " UNION ALL ".join(parts))


@query("d2_iqr_outlier_summary", _sql_iqr(NUM))
def d2_iqr_outlier_summary(spark, sf_dir):
    """D2 on the numerical F-BULK columns."""
    return outliers.iqr_outlier_summary(FX.bulk(spark, sf_dir), NUM)


def _sql_z(cols):
    m = ", ".join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in cols)
    cond = lambda c: f"{c}_s > 0 AND abs({c} - {c}_m) / {c}_s > 3"
    parts = [
        f"SELECT '{c}' AS column, CAST(count_if({cond(c)}) AS BIGINT) AS count, "
        f"round(count_if({cond(c)}) / count(*) * 100, 6) AS percentage FROM bulk CROSS JOIN m"
        for c in cols
    ]
    return _with_extra(f"m AS (SELECT {m} FROM bulk)", " UNION ALL ".join(parts))


@query("d3_zscore_outlier_summary", _sql_z(NUM))
def d3_zscore_outlier_summary(spark, sf_dir):
    """D3 (omit policy) on the numerical F-BULK columns."""
    return outliers.zscore_outlier_summary(FX.bulk(spark, sf_dir), NUM)


@query(
    "d1_outliers_iqr",
    _with_extra(
        "q AS (SELECT quantile_cont(unit_net, 0.25) AS q1, quantile_cont(unit_net, 0.75) AS q3 FROM bulk)",
        "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(unit_net, 6) AS unit_net FROM bulk CROSS JOIN q "
        "WHERE unit_net < q1 - 1.5*(q3-q1) OR unit_net > q3 + 1.5*(q3-q1)",
    ),
)
def d1_outliers_iqr(spark, sf_dir):
    """The outlying rows of one column."""
    df = FX.bulk(spark, sf_dir)
    return outliers.outliers_iqr(df, "unit_net").select(*FX.BULK_ID, "unit_net")


@query(
    "d1_outliers_iqr_skewed",
    _with_extra(
        "q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)",
        "SELECT event_id, round(value, 6) AS value FROM events CROSS JOIN q WHERE value < q1 - 1.5*(q3-q1) OR value > q3 + 1.5*(q3-q1)",
    ),
)
def d1_outliers_iqr_skewed(spark, sf_dir):
    """D1 on the skewed ``events.value`` fixture."""
    from riskline.sources.readers import table

    ev = table(spark, sf_dir, "events").select("event_id", "value")
    return outliers.outliers_iqr(ev, "value")


@query(
    "d2_iqr_outlier_summary_skewed",
    _with_extra(
        "q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)",
        "SELECT 'value' AS column, CAST(count_if(value < q1 - 1.5*(q3-q1) OR value > q3 + 1.5*(q3-q1)) AS BIGINT) AS count, "
        "round(count_if(value < q1 - 1.5*(q3-q1) OR value > q3 + 1.5*(q3-q1)) / count(*) * 100, 6) AS percentage FROM events CROSS JOIN q",
    ),
)
def d2_iqr_outlier_summary_skewed(spark, sf_dir):
    from riskline.sources.readers import table

    return outliers.iqr_outlier_summary(table(spark, sf_dir, "events"), ["value"])


@query("a1_fixture_bulk", with_fixtures(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, quantity, round(price, 6) AS price, "
    "round(unit_net, 6) AS unit_net, discount, tax, grade, flag, status, label FROM bulk"))
def a1_fixture_bulk(spark, sf_dir):
    """A1: parquet scan + the F-BULK projection (whole table)."""
    return FX.bulk(spark, sf_dir)


@query("a1_fixture_cohort", with_fixtures(
    "SELECT id, acctbal, segment, n_orders, round(avg_total, 6) AS avg_total, round(max_total, 6) AS max_total, label FROM cohort"))
def a1_fixture_cohort(spark, sf_dir):
    """A1: scan + pre-aggregated left join -> F-COHORT."""
    return FX.cohort(spark, sf_dir)


@query(
    "d3_zscore_outlier_summary_skewed",
    _with_extra(
        "m AS (SELECT avg(value) AS mu, stddev_pop(value) AS sd FROM events)",
        "SELECT 'value' AS column, CAST(count_if(sd > 0 AND abs(value - mu) / sd > 3) AS BIGINT) AS count, "
        "round(count_if(sd > 0 AND abs(value - mu) / sd > 3) / count(*) * 100, 6) AS percentage FROM events CROSS JOIN m",
    ),
)
def d3_zscore_outlier_summary_skewed(spark, sf_dir):
    """D3 on the skewed ``events.value`` fixture."""
    from riskline.sources.readers import table

    return outliers.zscore_outlier_summary(table(spark, sf_dir, "events"), ["value"])


@query(
    "d5_continuous_summary_skewed",
    _with_extra(
        "x AS (SELECT 1)",
        "SELECT event_type AS variable, CAST(count(value) AS BIGINT) AS n, round(avg(value), 6) AS mean, "
        "round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.99), 6) AS p99, round(max(value), 6) AS max "
        "FROM events GROUP BY event_type",
    ),
)
def d5_continuous_summary_skewed(spark, sf_dir):
    """D5 per event type on the skewed fixture: exact median and 99th percentile
    per group from one set of selection passes (all groups together)."""
    from riskline.operators.quantiles import exact_quantiles
    from riskline.sources.readers import table

    ev = table(spark, sf_dir, "events")
    q, _ = exact_quantiles(ev, ["value"], [0.5, 0.99], by=["event_type"])
    qs = spark.createDataFrame(
        [(g[0], q[(g, "value", 0.5)], q[(g, "value", 0.99)]) for (g, v, p) in q if p == 0.5],
        "variable string, median double, p99 double",
    )
    mom = ev.groupBy(F.col("event_type").alias("variable")).agg(
        F.count("value").cast("bigint").alias("n"), F.avg("value").alias("mean"), F.max("value").alias("max")
    )
    return mom.join(qs, "variable").select("variable", "n", "mean", "median", "p99", "max")
