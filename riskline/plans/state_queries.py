"""Registered queries: mergeable profile states, and densities by linear binning."""

from __future__ import annotations

from riskline.operators import describe as D
from riskline.operators import profile_state as P
from riskline.plans.describe_queries import _CARD, NUM, _extra, long_sql
from riskline.plans.registry import ORACLE, query
from riskline.sources import fixtures as FX
from riskline.sources.fixtures import with_fixtures


@query(
    "d5_merged_profile",
    with_fixtures(
        " UNION ALL ".join(
            f"SELECT '{c}' AS variable, CAST(count({c}) AS BIGINT) AS count, CAST(count(*) - count({c}) AS BIGINT) AS missing, "
            f"round((count(*) - count({c})) / count(*) * 100, 6) AS missing_pct, round(avg({c}), 6) AS mean, "
            f"round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, round(max({c}), 6) AS max FROM bulk"
            for c in NUM
        )
    ),
)
def d5_merged_profile(spark, sf_dir):
    """D5's exact figures from states: one per status and column, merged into those of the whole table."""
    states = P.profile_state(FX.bulk(spark, sf_dir), NUM, by=["status"])
    return P.summary(P.merge_states(states)).drop("approx_q25", "approx_median", "approx_q75", "approx_distinct")


@query(
    "b7_approximate_types",
    _extra(
        f"l AS ({long_sql(_CARD, cast='VARCHAR')})",
        "SELECT variable, CASE WHEN count(DISTINCT value) > 4 THEN 'numerical' ELSE 'categorical' END AS kind, true AS near FROM l GROUP BY variable",
    ),
)
def b7_approximate_types(spark, sf_dir):
    """B7 by merged sketches, and whether each distinct count is within four standard errors of the exact one."""
    bulk = FX.bulk(spark, sf_dir)
    types = P.approximate_types(P.merge_states(P.profile_state(bulk, _CARD, by=["status"])))
    exact = D.distinct_counts(bulk, _CARD)
    off = "abs(approx_distinct - n_distinct) <= 4 * 1.04 / sqrt(4096) * n_distinct"
    return types.join(exact, "variable").selectExpr("variable", "kind", f"{off} AS near")


@query("d28_kde_binned")
def d28_kde_binned(spark, sf_dir):
    """D28 by linear binning at a tolerance of 1e-8: the rows of the exact density, rounded."""
    return D.kde_density_binned(FX.bulk(spark, sf_dir), "unit_net", "label", tolerance=1e-8).drop("error_bound")


ORACLE["d28_kde_binned"] = ORACLE["d28_kde_density"]
