"""The cleaning flow: load -> profile missing -> impute -> outlier profile.

What the reference's script does in its first half, as one chain of Spark
jobs: a null-rate job, a statistics job (medians by rank selection, modes by
grouped counts), then one bounds job and one counting job per outlier rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskline.operators import missing, outliers
from riskline.sources import fixtures as FX


def cleaned(spark: SparkSession, sf_dir: str, threshold: float = 0.05) -> DataFrame:
    df = FX.bulk(spark, sf_dir)
    return missing.simple_imputation(df, FX.BULK_NUMERIC, ["grade"], threshold=threshold)


def cleaned_outlier_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IQR and z-score outlier counts per numerical column after imputation."""
    df = cleaned(spark, sf_dir)
    iqr = outliers.iqr_outlier_summary(df, FX.BULK_NUMERIC).withColumn("method", F.lit("iqr"))
    z = outliers.zscore_outlier_summary(df, FX.BULK_NUMERIC).withColumn("method", F.lit("zscore"))
    return iqr.unionByName(z).select("method", "column", "count", F.round("percentage", 6).alias("percentage"))
