"""Helpers around Spark that several operators share: lineage cuts, size-checked broadcasts, bucket counts."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskline.session import ensure_checkpoint_dir

#: Most keys that a size-checked broadcast may hold (8 to 16 MB of 64-bit keys).
BROADCAST_KEYS = 1_000_000


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back: later steps start
    from files that every executor sees, so a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def step(df: DataFrame, *done: DataFrame) -> DataFrame:
    """``cut`` that leaves no more on disk than later steps read: the cuts ``done``, which nothing reads any more, are
    deleted, and so are the shuffle files of finished jobs. Spark removes those once the driver's JVM has collected the
    plans that they belong to; a driver whose heap is not full would keep them until the end of the run."""
    out = cut(df)
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    for old in done:
        path = jvm.org.apache.hadoop.fs.Path(old._cut_path)
        path.getFileSystem(conf).delete(path, True)
    jvm.System.gc()
    return out


def small(df: DataFrame, rows: int | None = None, bound: int = BROADCAST_KEYS) -> DataFrame:
    """``df`` with a broadcast hint if it has ``bound`` rows at most, else as it is (a shuffled join)."""
    rows = df.count() if rows is None else rows
    return F.broadcast(df) if rows <= bound else df


def as_docs(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns that an operator reads, under names that clash with no other."""
    return df.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))


def parts(spark: SparkSession, amount: float, each: float) -> int:
    """How many parts of about ``each`` hold ``amount``, and no fewer than the session's cores."""
    return max(int(spark.sparkContext.defaultParallelism), math.ceil(amount / each))
