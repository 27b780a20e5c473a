"""Global order without a single partition.

Running totals in value order (ranks, ROC points, rank sums) normally call
for ``Window.orderBy`` over the whole frame, which moves every row into one
task. Here the rows are first dealt out in value order:

1. ``repartitionByRange`` on (key, value) gives balanced ranges, one per
   partition, and the partition number is kept as the range (the result is
   checkpointed, as the cut points are drawn from a sample);
2. the range totals (at most #keys + #ranges rows) get their exclusive
   prefix sums with a small window;
3. the range offsets are joined back (broadcast) and a window per (key, range)
   finishes the running totals.

Only the rows of one range share a task. There are as many ranges as shuffle
partitions, so they grow with the session that is sized for the data. Callers
collapse equal values first (one row per distinct value with its counts), so a
hot value is a single row. Keys may be NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskline.operators.long import join_small


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the session's shared folder."""
    from riskline.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def with_ranges(
    df: DataFrame,
    partition_cols: Sequence[str],
    order_col: str,
    buckets: int | None = None,
    descending: bool = False,
) -> DataFrame:
    """The rows, checkpointed, with ``_rng``: the number of the value range that holds ``order_col``
    (ranges follow the requested order; ``buckets`` of them, by default one per shuffle partition)."""
    n = buckets or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    key = F.col(order_col).desc() if descending else F.col(order_col).asc()
    return materialize(df.repartitionByRange(n, *[F.col(c) for c in partition_cols], key).withColumn("_rng", F.spark_partition_id()))


def prefix_sums(
    df: DataFrame,
    partition_cols: Sequence[str],
    order_col: str,
    sum_cols: Sequence[str],
    buckets: int | None = None,
    descending: bool = False,
    keep_range: bool = False,
) -> DataFrame:
    """Add ``{c}_before`` = sum of ``c`` over rows that come strictly earlier
    (ascending or ``descending`` ``order_col``) within each partition key.

    ``order_col`` must be unique within a partition key (collapse ties first). Rows that
    carry ``_rng`` already (from ``with_ranges``, in the same order) are taken as they are.
    """
    parts = list(partition_cols)
    j = df if "_rng" in df.columns else with_ranges(df, parts, order_col, buckets, descending)
    totals = j.groupBy(*parts, "_rng").agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols])
    w_rng = Window.partitionBy(*parts).orderBy("_rng").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *parts, "_rng", *[F.coalesce(F.sum(f"_t_{c}").over(w_rng), F.lit(0)).alias(f"_o_{c}") for c in sum_cols]
    )
    # at most #keys + #ranges rows
    j = join_small(j, offsets, [*parts, "_rng"])
    key = F.col(order_col)
    order = key.desc() if descending else key.asc()
    w = Window.partitionBy(*parts, "_rng").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return j.select(
        *[c for c in df.columns if c != "_rng"],
        *(["_rng"] if keep_range else []),
        *[(F.col(f"_o_{c}") + F.coalesce(F.sum(c).over(w), F.lit(0))).alias(f"{c}_before") for c in sum_cols],
    )


def next_values(
    ranged: DataFrame,
    partition_cols: Sequence[str],
    order_col: str,
    cols: Sequence[str],
    descending: bool = False,
) -> DataFrame:
    """Add ``{c}_next``: the value of ``c`` on the following row in order
    (NULL on the last row). ``ranged`` must carry ``_rng`` (``keep_range``):
    a window per range gives the lead, and the first row of the next
    non-empty range (at most #keys + #ranges rows) patches each range's last row."""
    parts = list(partition_cols)
    key = F.col(order_col)
    first_of = F.max_by if descending else F.min_by
    firsts = ranged.groupBy(*parts, "_rng").agg(
        *[first_of(F.col(c), key).alias(f"_f_{c}") for c in cols]
    )
    w_r = Window.partitionBy(*parts).orderBy("_rng")
    patch = firsts.select(*parts, "_rng", *[F.lead(f"_f_{c}").over(w_r).alias(f"_p_{c}") for c in cols])
    j = join_small(ranged, patch, [*parts, "_rng"])
    order = key.desc() if descending else key.asc()
    w = Window.partitionBy(*parts, "_rng").orderBy(order)
    is_last = F.lead(F.lit(1)).over(w).isNull()
    return j.select(
        *[c for c in ranged.columns],
        *[F.when(is_last, F.col(f"_p_{c}")).otherwise(F.lead(c).over(w)).alias(f"{c}_next") for c in cols],
    )


def rank_sums(
    df: DataFrame,
    value: str,
    label: str,
    by: Sequence[str] = (),
    positive=1,
    buckets: int | None = None,
) -> DataFrame:
    """Tie-averaged rank statistics of a binary split, per ``by`` key.

    Returns ``by..., n_neg, n_pos, rank_sum_neg, rank_sum_pos, tie_term``
    where ranks are 1-based over both classes together (NULL values skipped),
    ties get the average rank, and ``tie_term = sum(t^3 - t)`` over tie blocks.
    This is the core of the Mann-Whitney U test and of the exact ROC AUC.
    """
    by = list(by)
    base = df.where(F.col(value).isNotNull() & F.col(label).isNotNull())
    per_value = base.groupBy(*by, F.col(value).alias("_v")).agg(
        F.count_if(F.col(label) == positive).cast("bigint").alias("_pos"),
        F.count_if(F.col(label) != positive).cast("bigint").alias("_neg"),
    ).withColumn("_t", F.col("_pos") + F.col("_neg"))
    ranked = prefix_sums(per_value, by, "_v", ["_t"], buckets=buckets)
    avg_rank = F.col("_t_before") + (F.col("_t") + 1) / 2.0
    return ranked.groupBy(*by).agg(
        F.sum("_neg").cast("bigint").alias("n_neg"),
        F.sum("_pos").cast("bigint").alias("n_pos"),
        F.sum(F.col("_neg") * avg_rank).alias("rank_sum_neg"),
        F.sum(F.col("_pos") * avg_rank).alias("rank_sum_pos"),
        F.sum(F.col("_t").cast("double") ** 3 - F.col("_t")).alias("tie_term"),
    )
