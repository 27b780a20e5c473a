"""Projections of the test tables that stand in for the reference's data.

Two fixtures (see FIXTURES.md): F-BULK, one row per line item (scan-heavy
operators), and F-COHORT, one row per customer (neighbour and model
operators). Each is given twice: as a DataFrame plan and as SQL text that
DuckDB runs for the oracle. Nulls and the binary label are planted by integer
arithmetic so both engines agree exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskline.sources.readers import table

# Column roles of the fixtures (fixed values, mirrored in FIXTURES.md).
BULK_ID = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
BULK_NUMERIC = ["quantity", "price", "unit_net", "discount", "tax"]
BULK_CATEGORICAL = ["grade", "flag", "status"]
BULK_CODED_CATEGORICAL = ["grade", "status_code", "flag_code"]
BULK_TARGET = "label"

COHORT_ID = ["id"]
COHORT_NUMERIC = ["acctbal", "n_orders", "avg_total", "max_total"]
COHORT_TARGET = "label"


def bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-BULK: lineitem with planted nulls and a label (one narrow projection)."""
    li = table(spark, sf_dir, "lineitem")
    ok, pk, ln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    price = F.col("l_extendedprice")
    noise = ((ok * 7919 + pk * 104729 + ln * 31) % 1000) / F.lit(10.0)
    return li.select(
        *BULK_ID,
        F.col("l_quantity").alias("quantity"),
        F.when((ok * 7 + pk * 13 + ln) % 41 == 0, F.lit(None)).otherwise(price).alias("price"),
        F.when((ok * 11 + pk * 3 + ln) % 11 == 0, F.lit(None))
        .otherwise(price * (1 - F.col("l_discount")) / F.col("l_quantity"))
        .alias("unit_net"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        F.when((ok * 5 + pk * 17 + ln) % 37 == 0, F.lit(None)).otherwise(ln % 4 + 1).alias("grade"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"),
        F.when(F.col("l_quantity") * 2 + price / 2000 + noise > 174, 1).otherwise(0).alias("label"),
    )


def cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-COHORT: customers left-joined to their orders, aggregated per customer.

    The orders side is pre-aggregated per customer before the join, so the
    join is customer x (one row per customer) instead of customer x orders.
    """
    c = table(spark, sf_dir, "customer")
    o = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(
            F.count("o_orderkey").alias("_n"),
            F.avg("o_totalprice").alias("_avg"),
            F.max("o_totalprice").alias("_max"),
        )
    )
    j = c.join(o, c.c_custkey == o.o_custkey, "left")
    n = F.coalesce(F.col("_n"), F.lit(0)).cast("bigint")
    key = F.col("c_custkey")
    return j.select(
        key.alias("id"),
        F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"),
        n.alias("n_orders"),
        F.when(key % 41 == 0, F.lit(None)).otherwise(F.coalesce(F.col("_avg"), F.lit(0.0))).alias("avg_total"),
        F.when(key % 11 == 3, F.lit(None)).otherwise(F.coalesce(F.col("_max"), F.lit(0.0))).alias("max_total"),
        F.when(F.col("c_acctbal") / 100 + 3 * n + ((key * 7919) % 1000) / F.lit(20.0) > 140, 1)
        .otherwise(0)
        .alias("label"),
    )


def bulk_coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-BULK with its string categories recoded to integer codes (B2)."""
    from riskline.operators.clean import recode

    df = bulk(spark, sf_dir)
    return recode(df, {"status": ({"F": 1, "O": 0}, "status_code"), "flag": ({"A": 0, "N": 1, "R": 2}, "flag_code")})


# ---------------------------------------------------------------------------
# The same fixtures as DuckDB SQL (used by the oracle only).
# ---------------------------------------------------------------------------

BULK_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
 l_quantity AS quantity,
 CASE WHEN (l_orderkey*7 + l_partkey*13 + l_linenumber) % 41 = 0 THEN NULL ELSE l_extendedprice END AS price,
 CASE WHEN (l_orderkey*11 + l_partkey*3 + l_linenumber) % 11 = 0 THEN NULL
      ELSE l_extendedprice*(1-l_discount)/l_quantity END AS unit_net,
 l_discount AS discount, l_tax AS tax,
 CASE WHEN (l_orderkey*5 + l_partkey*17 + l_linenumber) % 37 = 0 THEN NULL ELSE l_linenumber % 4 + 1 END AS grade,
 l_returnflag AS flag, l_linestatus AS status,
 CASE WHEN l_quantity*2 + l_extendedprice/2000
         + ((l_orderkey*7919 + l_partkey*104729 + l_linenumber*31) % 1000)/10.0 > 174 THEN 1 ELSE 0 END AS label
FROM lineitem
"""

BULK_CODED_SQL = f"""
SELECT *, CASE status WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS status_code,
 CASE flag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END AS flag_code
FROM ({BULK_SQL}) b
"""

COHORT_SQL = """
SELECT c.c_custkey AS id, c.c_acctbal AS acctbal, c.c_mktsegment AS segment,
 CAST(count(o.o_orderkey) AS BIGINT) AS n_orders,
 CASE WHEN c.c_custkey % 41 = 0 THEN NULL ELSE coalesce(avg(o.o_totalprice),0.0) END AS avg_total,
 CASE WHEN c.c_custkey % 11 = 3 THEN NULL ELSE coalesce(max(o.o_totalprice),0.0) END AS max_total,
 CASE WHEN c.c_acctbal/100 + 3*count(o.o_orderkey) + ((c.c_custkey*7919) % 1000)/20.0 > 140 THEN 1 ELSE 0 END AS label
FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey
GROUP BY c.c_custkey, c.c_acctbal, c.c_mktsegment
"""


def with_fixtures(sql: str) -> str:
    """Prefix an oracle query with the fixture CTEs ``bulk``, ``bulk_coded``, ``cohort``."""
    return f"WITH bulk AS ({BULK_SQL}), bulk_coded AS ({BULK_CODED_SQL}), cohort AS ({COHORT_SQL})\n{sql}"
