"""Registered queries: renames, recodes, casts, guards, predicates, derived features, sinks."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from riskline.functions import exprs as X
from riskline.operators import clean as C
from riskline.operators.model_batch import rescaled
from riskline.plans.registry import query
from riskline.session import ensure_checkpoint_dir
from riskline.sources import fixtures as FX
from riskline.sources.fixtures import with_fixtures
from riskline.sources.readers import read_csv
from riskline.sources.writers import save_final_dataset

IDS = ", ".join(FX.BULK_ID)
RENAMES = {"quantity": "qty", "price": "gross_price", "no_such_column": "ignored"}
STATUS_MAP = {"F": 1, "O": 0}
FLAG_MAP = {"A": 0, "N": 1, "R": 2}
RETURNED_MAP = {"A": 0, "N": 0, "R": 1}
QTY_EDGES = [1, 11, 21, 31, 51]
ACCTBAL_EDGES = [-1000, 0, 2500, 5000, 10001]


def _band_sql(col, edges):
    parts = " ".join(f"WHEN {col} >= {edges[i]} AND {col} < {edges[i + 1]} THEN {i}" for i in range(len(edges) - 1))
    return f"CAST(CASE {parts} ELSE -1 END AS INTEGER)"


@query(
    "b1_rename_columns",
    with_fixtures(f"SELECT {IDS}, quantity AS qty, round(price, 6) AS gross_price, flag FROM bulk"),
)
def b1_rename_columns(spark, sf_dir):
    """B1: rename map (absent source names ignored)."""
    return C.rename_columns(FX.bulk(spark, sf_dir), RENAMES).select(*FX.BULK_ID, "qty", "gross_price", "flag")


@query(
    "b2_recode_values",
    with_fixtures(
        f"SELECT {IDS}, CAST(CASE status WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS INTEGER) AS status_code, "
        "CAST(CASE flag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END AS INTEGER) AS flag_code FROM bulk"
    ),
)
def b2_recode_values(spark, sf_dir):
    """B2: strict dictionary recode of two string columns (an unmapped value fails the job)."""
    df = C.recode(FX.bulk(spark, sf_dir), {"status": (STATUS_MAP, "status_code"), "flag": (FLAG_MAP, "flag_code")})
    return df.select(*FX.BULK_ID, "status_code", "flag_code")


@query(
    "b5_convert_dtypes",
    with_fixtures(
        f"SELECT {IDS}, CAST(grade AS BIGINT) AS grade, CAST(quantity AS INTEGER) AS quantity, CAST(label AS INTEGER) AS label, "
        "CAST(CASE status WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS INTEGER) AS status FROM bulk"
    ),
)
def b5_convert_dtypes(spark, sf_dir):
    """Nullable bigint (grade), strict ints (quantity, label), recode (status)."""
    df = C.convert_dtypes(FX.bulk(spark, sf_dir), {"status": STATUS_MAP}, nullable_ints=["grade"], strict_ints=["quantity", "label"])
    return df.select(*FX.BULK_ID, "grade", "quantity", "label", "status")


@query(
    "b8_standardize_target",
    with_fixtures(f"SELECT {IDS}, quantity, label AS target FROM bulk"),
)
def b8_standardize_target(spark, sf_dir):
    """Canonical target name, then the (id, features, target) projection."""
    df = C.standardize_target(FX.bulk(spark, sf_dir), "target", aliases=["label"])
    return C.prepare_features(df, ["quantity"], "target", FX.BULK_ID)


@query(
    "b14_drop_columns",
    with_fixtures(f"SELECT {IDS}, quantity, discount, tax, flag, status, label FROM bulk"),
)
def b14_drop_columns(spark, sf_dir):
    """Drop the temporary / unused columns."""
    return FX.bulk(spark, sf_dir).drop("price", "unit_net", "grade")


@query(
    "b15_complete_cases",
    with_fixtures(
        f"SELECT {IDS}, round(price, 6) AS price, round(unit_net, 6) AS unit_net, grade, label FROM bulk "
        "WHERE price IS NOT NULL AND unit_net IS NOT NULL AND grade IS NOT NULL"
    ),
)
def b15_complete_cases(spark, sf_dir):
    """Rows with every listed column present."""
    df = C.complete_cases(FX.bulk(spark, sf_dir), ["price", "unit_net", "grade"])
    return df.select(*FX.BULK_ID, "price", "unit_net", "grade", "label")


@query(
    "b17_predicate_filter",
    with_fixtures(
        f"SELECT {IDS}, quantity, flag, label FROM bulk WHERE (label = 1 AND quantity BETWEEN 10 AND 30) OR flag = 'R'"
    ),
)
def b17_predicate_filter(spark, sf_dir):
    """Conjunction / disjunction / range predicates (pushed to the scan where possible)."""
    df = FX.bulk(spark, sf_dir)
    cond = ((F.col("label") == 1) & F.col("quantity").between(10, 30)) | (F.col("flag") == "R")
    return df.where(cond).select(*FX.BULK_ID, "quantity", "flag", "label")


@query(
    "b17_conditional_counts",
    with_fixtures(
        "SELECT CAST(count_if(label = 1) AS BIGINT) AS positives, CAST(count_if(flag = 'R' AND quantity > 25) AS BIGINT) AS returned_large, "
        "CAST(count_if(price IS NULL OR unit_net IS NULL) AS BIGINT) AS incomplete FROM bulk"
    ),
)
def b17_conditional_counts(spark, sf_dir):
    """Several filtered counts as conditional aggregates of ONE scan."""
    return FX.bulk(spark, sf_dir).agg(
        F.count_if(F.col("label") == 1).cast("bigint").alias("positives"),
        F.count_if((F.col("flag") == "R") & (F.col("quantity") > 25)).cast("bigint").alias("returned_large"),
        F.count_if(F.col("price").isNull() | F.col("unit_net").isNull()).cast("bigint").alias("incomplete"),
    )


@query(
    "b24_derive_features",
    with_fixtures(
        f"SELECT {IDS}, round(price - unit_net, 6) AS price_gap, {_band_sql('quantity', QTY_EDGES)} AS quantity_band, "
        "CAST(label + CASE status WHEN 'F' THEN 1 ELSE 0 END + CASE flag WHEN 'R' THEN 1 ELSE 0 END AS INTEGER) AS flag_count FROM bulk"
    ),
)
def b24_derive_features(spark, sf_dir):
    """Difference (NULL-propagating), left-closed band code (-1 outside), flag count."""
    df = C.recode(FX.bulk(spark, sf_dir), {"status": (STATUS_MAP, "status_code"), "flag": (RETURNED_MAP, "is_returned")})
    out = C.derive_features(
        df,
        difference=("price_gap", "price", "unit_net"),
        bands={"quantity_band": ("quantity", QTY_EDGES)},
        flag_count=("flag_count", ["label", "status_code", "is_returned"]),
    )
    return out.select(*FX.BULK_ID, "price_gap", "quantity_band", "flag_count")


@query(
    "b20_acctbal_bands",
    with_fixtures(
        f"SELECT {_band_sql('acctbal', ACCTBAL_EDGES)} AS acctbal_band, CAST(count(*) AS BIGINT) AS n, "
        "CAST(sum(label) AS BIGINT) AS positives FROM cohort GROUP BY ALL"
    ),
)
def b20_acctbal_bands(spark, sf_dir):
    """Account-balance bands of F-COHORT and their label counts."""
    df = C.derive_features(FX.cohort(spark, sf_dir), bands={"acctbal_band": ("acctbal", ACCTBAL_EDGES)})
    return df.groupBy("acctbal_band").agg(F.count(F.lit(1)).cast("bigint").alias("n"), F.sum("label").cast("bigint").alias("positives"))


_BULK_DDL = (
    "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, quantity double, price double, "
    "unit_net double, discount double, tax double, grade int, flag string, status string, label int"
)


@query(
    "a2_csv_roundtrip",
    with_fixtures(
        f"SELECT {IDS}, quantity, round(price, 6) AS price, round(unit_net, 6) AS unit_net, discount, tax, grade, flag, status, label FROM bulk"
    ),
)
def a2_csv_roundtrip(spark, sf_dir):
    """A2/A3/A1: write F-BULK as a CSV directory (header, no index) in the shared
    folder, read it back with an explicit schema: the same table."""
    path = os.path.join(ensure_checkpoint_dir(spark), f"csv-{uuid.uuid4().hex[:8]}")
    out = save_final_dataset(FX.bulk(spark, sf_dir), path, name="processed_features", fmt="csv")
    return read_csv(spark, out, schema=_BULK_DDL, null_value="")


OPEN_EDGES = [0, 18.5, 25, 30, float("inf")]


@query(
    "b21_open_bands",
    with_fixtures(
        f"SELECT {IDS}, CAST(CASE WHEN quantity >= 0 AND quantity < 18.5 THEN 0 WHEN quantity >= 18.5 AND quantity < 25 THEN 1 "
        "WHEN quantity >= 25 AND quantity < 30 THEN 2 WHEN quantity >= 30 THEN 3 ELSE -1 END AS INTEGER) AS band FROM bulk"
    ),
)
def b21_open_bands(spark, sf_dir):
    """Bands whose last one has no upper edge."""
    return FX.bulk(spark, sf_dir).select(*FX.BULK_ID, X.cut_code("quantity", OPEN_EDGES).alias("band"))


@query(
    "b31_score_rescale",
    with_fixtures(
        f"SELECT {IDS}, flag, round((unit_net - min(unit_net) OVER (PARTITION BY flag)) / (max(unit_net) OVER (PARTITION BY flag) - "
        "min(unit_net) OVER (PARTITION BY flag) + 1e-9), 6) AS score FROM bulk"
    ),
)
def b31_score_rescale(spark, sf_dir):
    """Margins moved to [0, 1] by the least and largest of each run (here: flag)."""
    df = FX.bulk(spark, sf_dir).select(*FX.BULK_ID, "flag", F.col("unit_net").cast("double").alias("score"))
    return rescaled(df, ["flag"])


@query(
    "b33_round_report",
    with_fixtures("SELECT flag, round_even(avg(price), 2) AS price, round_even(avg(unit_net), 2) AS unit_net, CAST(count(*) AS BIGINT) AS n FROM bulk GROUP BY flag"),
)
def b33_round_report(spark, sf_dir):
    """Report values rounded half to even."""
    means = FX.bulk(spark, sf_dir).groupBy("flag").agg(F.avg("price").alias("price"), F.avg("unit_net").alias("unit_net"), F.count("*").cast("bigint").alias("n"))
    return means.select("flag", X.round_report("price").alias("price"), X.round_report("unit_net").alias("unit_net"), "n")


@query(
    "b32_params_json",
    with_fixtures("SELECT CAST(to_json({'flag': flag, 'label': label, 'status': status}) AS VARCHAR) AS params, CAST(count(*) AS BIGINT) AS n FROM bulk GROUP BY flag, label, status"),
)
def b32_params_json(spark, sf_dir):
    """B32/H: parameters of a row as JSON text with sorted keys."""
    return FX.bulk(spark, sf_dir).groupBy(X.params_json_column("status", "flag", "label").alias("params")).agg(F.count("*").cast("bigint").alias("n"))
