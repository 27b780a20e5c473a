"""Mergeable column profiles (D4, D5, B7 in its approximate form) kept as a table.

A state is one row per column: rows, non-null values, mean, sum of squared deviations, extremes, a HyperLogLog sketch of the
distinct values and a KLL sketch of the ranks (numeric columns). The state of A and the state of B merge into that of
A and B together, so the profile of a growing table reads only what is new: each source (a day, a file) adds its rows to the table
once, and adding it again replaces them.

Counts and extremes of a merged state are exact, mean and deviation up to the order of summation (merged around the common mean,
without cancellation). Distinct counts have a relative standard error of 1.04 / sqrt(2^lg_k), and are exact while a sketch still lists
its values (the few categories that decide a column's type). Ranks have the normalized error of a KLL sketch of 200 (1.65 %).

Nulls count as missing. A column without values has null moments and zero distinct values. An empty table gives states without rows
that merge like others (without ``by``), or no state at all (with ``by``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskline.operators.long import join_small

LG_K = 12
RANK_K = 200


def profile_state(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), lg_k: int = LG_K) -> DataFrame:
    """``by..., variable, numeric, rows, present, mean, m2, lowest, highest, distinct, ranks``: one scan with partial
    aggregation, whose shuffle is one row of sketches per task and group. Text columns have no moments and ranks."""
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    aggs, structs = [F.count(F.lit(1)).alias("_rows")], []
    for i, c in enumerate(columns):
        value, number = F.col(f"`{c}`"), F.col(f"`{c}`").cast("double")
        aggs += [F.count(value).alias(f"_n{i}"), F.hll_sketch_agg(value.cast("string"), F.lit(lg_k)).alias(f"_d{i}")]
        moments = {"mean": F.avg(number), "m2": F.var_pop(number) * F.count(number), "lowest": F.min(number), "highest": F.max(number)}
        if c in numeric:
            aggs += [m.alias(f"_{k}{i}") for k, m in moments.items()] + [F.kll_sketch_agg_double(number, F.lit(RANK_K)).alias(f"_r{i}")]
        got = [(F.col(f"_{k}{i}") if c in numeric else F.lit(None).cast("double")).alias(k) for k in moments]
        ranks = F.col(f"_r{i}") if c in numeric else F.lit(None).cast("binary")
        structs.append(
            F.struct(
                F.lit(c).alias("variable"), F.lit(c in numeric).alias("numeric"), F.col("_rows").alias("rows"), F.col(f"_n{i}").alias("present"),
                *got, F.col(f"_d{i}").alias("distinct"), F.when(F.col(f"_n{i}") > 0, ranks).alias("ranks"),
            )
        )
    wide = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    return wide.select(*by, F.explode(F.array(*structs)).alias("_s")).select(*by, "_s.*")


def merge_states(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One state per ``by`` and variable, in the same columns (those in ``by`` kept, others that are not a state's dropped)."""
    keys = [*by, "variable"]
    total = states.groupBy(*keys).agg(
        F.any_value("numeric").alias("numeric"),
        F.sum("rows").alias("rows"),
        F.sum("present").alias("present"),
        F.try_divide(F.sum(F.col("mean") * F.col("present")), F.sum(F.when(F.col("mean").isNotNull(), F.col("present")))).alias("mean"),
        F.min("lowest").alias("lowest"),
        F.max("highest").alias("highest"),
        F.hll_union_agg("distinct", F.lit(True)).alias("distinct"),
        F.when(F.count("ranks") > 0, F.kll_merge_agg_double("ranks")).alias("ranks"),
    )
    around = join_small(states.select(*keys, "present", "mean", "m2"), total.select(*keys, F.col("mean").alias("_mean")), keys)
    apart = F.col("mean") - F.col("_mean")
    m2 = around.groupBy(*keys).agg(F.sum(F.col("m2") + F.col("present") * apart * apart).alias("m2"))
    return join_small(total, m2, keys).select(*keys, "numeric", "rows", "present", "mean", "m2", "lowest", "highest", "distinct", "ranks")


def add_to_profile(df: DataFrame, columns: Sequence[str], path: str, source: str) -> None:
    """Writes the state of one source into the profile table at ``path``; a source that is there already is replaced."""
    profile_state(df, columns).write.mode("overwrite").parquet(f"{path.rstrip('/')}/source={source}")


def read_profile(spark: SparkSession, path: str) -> DataFrame:
    """The merged state of all sources of a profile table. Reads no data, only states."""
    return merge_states(spark.read.parquet(path))


def summary(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The survey's summary of merged states: counts, moments and extremes, and estimated quartiles and distinct counts."""
    quartile = lambda p: F.when(F.col("ranks").isNotNull(), F.kll_sketch_get_quantile_double("ranks", F.lit(p)))
    return states.select(
        *by,
        "variable",
        F.col("present").alias("count"),
        (F.col("rows") - F.col("present")).alias("missing"),
        F.coalesce(F.try_divide(F.col("rows") - F.col("present"), F.col("rows")) * 100, F.lit(0.0)).alias("missing_pct"),
        "mean",
        F.when(F.col("present") > 1, F.sqrt(F.col("m2") / (F.col("present") - 1))).alias("std"),
        F.col("lowest").alias("min"),
        F.col("highest").alias("max"),
        *(quartile(p).alias(f"approx_{n}") for n, p in (("q25", 0.25), ("median", 0.5), ("q75", 0.75))),
        F.hll_sketch_estimate("distinct").alias("approx_distinct"),
    )


def approximate_types(states: DataFrame, max_categories: int = 4) -> DataFrame:
    """B7 from states: ``variable, approx_distinct, kind`` of the numeric columns."""
    found = F.hll_sketch_estimate("distinct")
    kind = F.when(found > max_categories, "numerical").otherwise("categorical")
    return states.where("numeric").select("variable", found.alias("approx_distinct"), kind.alias("kind"))
