"""Registered queries: stratified split, folds, class weights, scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskline.operators import sampling as SP
from riskline.operators import scaling as SC
from riskline.plans.describe_queries import _extra
from riskline.plans.registry import query
from riskline.sources import fixtures as FX

IDS = FX.BULK_ID
IDS_SQL = ", ".join(IDS)
# An integer-arithmetic order key both engines compute identically (the
# library default is xxhash64(id, seed), which DuckDB has no twin for).
KEY_SQL = "(l_orderkey * 7919 + l_partkey * 104729 + l_linenumber * 31 + l_suppkey * 17) % 1000003"
SCALE_COLS = ["quantity", "discount", "tax", "price"]


def _key():
    ok, pk, ln, sk = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey"))
    return (ok * 7919 + pk * 104729 + ln * 31 + sk * 17) % 1000003


def split_cte(source: str = "bulk", key: str = KEY_SQL, ids: str = IDS_SQL, test_size: float = 0.2) -> str:
    """SQL CTEs ``c, t, f, nd, q, s`` where ``s`` is ``source`` plus ``split``."""
    return (
        f"c AS (SELECT label, count(*) AS n FROM {source} GROUP BY label), "
        f"t AS (SELECT sum(n) AS total, ceil({test_size!r}::DOUBLE * sum(n)) AS n_test FROM c), "
        "f AS (SELECT label, n, n / total * (total - n_test) AS cont, floor(n / total * (total - n_test)) AS fl FROM c, t), "
        "nd AS (SELECT (SELECT total - n_test FROM t) - sum(fl) AS need FROM f), "
        "q AS (SELECT label, n - (fl + CASE WHEN row_number() OVER (ORDER BY cont - fl DESC, label) <= (SELECT need FROM nd) "
        "THEN 1 ELSE 0 END) AS quota FROM f), "
        f"s AS (SELECT b.*, CASE WHEN row_number() OVER (PARTITION BY b.label ORDER BY {key}, {ids}) <= quota "
        f"THEN 'test' ELSE 'train' END AS split FROM {source} b JOIN q ON b.label = q.label)"
    )


_SPLIT_CTE = split_cte()


@query("i1_stratified_split", _extra(_SPLIT_CTE, f"SELECT {IDS_SQL}, label, split FROM s"))
def i1_stratified_split(spark, sf_dir):
    """Exact stratified 80/20 quotas (arithmetic order key for the oracle)."""
    df = FX.bulk(spark, sf_dir)
    return SP.stratified_split(df, "label", IDS, 0.2, order_key=_key()).select(*IDS, "label", "split")


@query(
    "i1_split_quotas",
    _extra(_SPLIT_CTE, "SELECT label, split, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY label, split"),
)
def i1_split_quotas(spark, sf_dir):
    """I1 with the default xxhash64 order: the quotas do not depend on the key."""
    df = FX.bulk(spark, sf_dir)
    return SP.stratified_split(df, "label", IDS, 0.2, seed=42).groupBy("label", "split").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@query(
    "i2_stratified_folds",
    _extra(
        "x AS (SELECT 1)",
        f"SELECT {IDS_SQL}, label, CAST(((row_number() OVER (PARTITION BY label ORDER BY {KEY_SQL}, {IDS_SQL}) - 1) * 5) "
        "// count(*) OVER (PARTITION BY label) AS INTEGER) AS fold FROM bulk",
    ),
)
def i2_stratified_folds(spark, sf_dir):
    """Five stratified folds (fold = floor(rank x 5 / class size))."""
    df = FX.bulk(spark, sf_dir)
    return SP.stratified_folds(df, "label", IDS, 5, order_key=_key()).select(*IDS, "label", "fold")


@query(
    "i2_fold_sizes",
    _extra(
        f"fo AS (SELECT label, ((row_number() OVER (PARTITION BY label ORDER BY {KEY_SQL}, {IDS_SQL}) - 1) * 5) "
        "// count(*) OVER (PARTITION BY label) AS fold FROM bulk)",
        "SELECT label, CAST(fold AS INTEGER) AS fold, CAST(count(*) AS BIGINT) AS n FROM fo GROUP BY ALL",
    ),
)
def i2_fold_sizes(spark, sf_dir):
    """I2 with the default hash order: per-class fold sizes differ by at most one."""
    df = FX.bulk(spark, sf_dir)
    return SP.stratified_folds(df, "label", IDS, 5, seed=42).groupBy("label", "fold").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@query(
    "i3_class_weights",
    _extra(
        "c AS (SELECT label, count(*) AS n FROM bulk GROUP BY label)",
        "SELECT label, CAST(n AS BIGINT) AS n, round((SELECT sum(n) FROM c) / (2 * n), 6) AS weight FROM c",
    ),
)
def i3_class_weights(spark, sf_dir):
    """Balanced weights n / (2 n_c), as the weight column sees them."""
    df = SP.with_class_weights(FX.bulk(spark, sf_dir), "label")
    return df.groupBy("label").agg(F.count(F.lit(1)).cast("bigint").alias("n"), F.first("weight").alias("weight"))


def _scaled_sql(kind):
    if kind == "standard":
        stats = ", ".join(f"avg({c}) AS c_{c}, stddev_pop({c}) AS s_{c}" for c in SCALE_COLS)
    else:
        stats = ", ".join(
            f"quantile_cont({c}, 0.5) AS c_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS s_{c}" for c in SCALE_COLS
        )
    sel = ", ".join(
        f"round(({c} - c_{c}) / CASE WHEN s_{c} = 0 OR s_{c} IS NULL THEN 1 ELSE s_{c} END, 6) AS {c}" for c in SCALE_COLS
    )
    return _extra(
        _SPLIT_CTE + f", st AS (SELECT {stats} FROM s WHERE split = 'train')",
        f"SELECT {IDS_SQL}, split, {sel} FROM s CROSS JOIN st",
    )


def _scaled(spark, sf_dir, fit):
    df = SP.stratified_split(FX.bulk(spark, sf_dir), "label", IDS, 0.2, order_key=_key())
    model = fit(df.where(F.col("split") == "train"), SCALE_COLS)
    return model.transform(df).select(*IDS, "split", *SCALE_COLS)


@query("j1_standard_scale", _scaled_sql("standard"))
def j1_standard_scale(spark, sf_dir):
    """Population-sigma standardisation fitted on the train split, applied to both."""
    return _scaled(spark, sf_dir, SC.fit_standard_scaler)


@query("j2_robust_scale", _scaled_sql("robust"))
def j2_robust_scale(spark, sf_dir):
    """(x - median) / IQR fitted on the train split (exact quartiles)."""
    return _scaled(spark, sf_dir, SC.fit_robust_scaler)


@query("b12_unscaled_sets", _extra(_SPLIT_CTE, f"SELECT split, {IDS_SQL}, {', '.join(f'round({c}::DOUBLE, 6) AS {c}' for c in SCALE_COLS)}, label FROM s"))
def b12_unscaled_sets(spark, sf_dir):
    """Features and target split apart, then attached again by id, for train and test."""
    return _sets(spark, sf_dir, lambda train, test: (train, test))


@query("b13_scaled_frame", _scaled_sql("standard").replace("SELECT " + IDS_SQL + ", split, ", "SELECT " + IDS_SQL + ", label, split, "))
def b13_scaled_frame(spark, sf_dir):
    """The scaled features (J1) with the target attached by id, for train and test."""

    def scaled(train, test):
        model = SC.fit_standard_scaler(train, SCALE_COLS)
        return model.transform(train), model.transform(test)

    return _sets(spark, sf_dir, scaled)


def _sets(spark, sf_dir, change):
    df = SP.stratified_split(FX.bulk(spark, sf_dir), "label", IDS, 0.2, order_key=_key())
    x = [df.where(F.col("split") == part).select(*IDS, *SCALE_COLS) for part in ("train", "test")]
    y = [df.where(F.col("split") == part).select(*IDS, "label") for part in ("train", "test")]
    out = [a.join(b, IDS).withColumn("split", F.lit(part)) for a, b, part in zip(change(*x), y, ("train", "test"))]
    return out[0].unionByName(out[1]).select("split", *IDS, *[F.col(c).cast("double").alias(c) for c in SCALE_COLS], "label")
