"""Print the physical plans of a few headline operators (for PLANS.md).

usage: python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from riskline.operators import describe, missing, neighbors, sampling, stats  # noqa: E402
from riskline.session import local_session  # noqa: E402
from riskline.sources import fixtures as FX  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    bulk = FX.bulk(spark, sf)
    plans = {
        "C1 missing summary (one scan, partial aggregate, one exchange)": missing.missing_value_summary(bulk, ["price", "unit_net", "grade"]),
        "D9 correlation pairs (in-stage explode + one grouped corr)": stats.correlation_pairs(bulk, ["quantity", "price", "discount"]),
        "D13 crosstab (long format, partial aggregation)": describe.crosstab(bulk, ["grade", "flag"], "label"),
        "I1 stratified split (no exchange: a projection after the cut is selected)": sampling.stratified_split(bulk, "label", FX.BULK_ID),
        "B17 predicate (pushed to the parquet scan)": bulk.where((F.col("flag") == "R") & (F.col("quantity") > 25)).select("l_orderkey", "quantity"),
        "C7 k-NN imputation (blocked cogroup, partial top-k before the exchange)": neighbors.knn_impute(
            FX.cohort(spark, sf), "id", "max_total", ["acctbal", "n_orders", "avg_total"], k=5
        ),
    }
    for title, df in plans.items():
        print(f"## {title}\n\n```")
        df.explain("simple")
        print("```\n")


if __name__ == "__main__":
    main()
