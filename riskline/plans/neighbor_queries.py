"""Registered queries: k-NN imputation, k-NN classification, SMOTE (F-COHORT)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskline.operators import neighbors as N
from riskline.operators import sampling as SP
from riskline.plans.describe_queries import _extra
from riskline.plans.registry import query
from riskline.plans.sampling_queries import split_cte
from riskline.sources import fixtures as FX

PRED = ["acctbal", "n_orders", "avg_total"]
KNN_FEATURES = ["acctbal", "n_orders"]
COHORT_KEY_SQL = "(id * 7919) % 1000003"


def _cohort_key():
    return (F.col("id") * 7919) % 1000003


def _dist_sql(cols, qa="q", da="d"):
    acc = " + ".join(
        f"CASE WHEN {qa}.{c} IS NOT NULL AND {da}.{c} IS NOT NULL THEN ({qa}.{c} - {da}.{c}) * ({qa}.{c} - {da}.{c}) ELSE 0 END" for c in cols
    )
    cnt = " + ".join(f"CASE WHEN {qa}.{c} IS NOT NULL AND {da}.{c} IS NOT NULL THEN 1 ELSE 0 END" for c in cols)
    return acc, cnt


def _impute_sql():
    cols = ["max_total", *PRED]
    acc, cnt = _dist_sql(cols)
    return _extra(
        "q AS (SELECT * FROM cohort WHERE max_total IS NULL), d AS (SELECT * FROM cohort WHERE max_total IS NOT NULL), "
        f"pr AS (SELECT q.id AS qid, d.id AS did, d.max_total AS y, {acc} AS acc, {cnt} AS cnt FROM q, d), "
        f"ds AS (SELECT qid, did, y, sqrt(acc * {len(cols)} / cnt) AS dist FROM pr WHERE cnt > 0), "
        "rk AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, did) AS r FROM ds), "
        "fl AS (SELECT qid, avg(y) AS fill FROM rk WHERE r <= 5 GROUP BY qid)",
        "SELECT c.id, round(coalesce(c.max_total, fl.fill, (SELECT avg(max_total) FROM cohort)), 6) AS max_total "
        "FROM cohort c LEFT JOIN fl ON c.id = fl.qid",
    )


@query("c7_knn_impute", _impute_sql())
def c7_knn_impute(spark, sf_dir):
    """5-NN mean imputation of ``max_total`` (NaN-aware distance over 4 columns)."""
    df = FX.cohort(spark, sf_dir)
    return N.knn_impute(df, "id", "max_total", PRED, k=5).select("id", "max_total")


def _knn_clf_sql(weights):
    acc, cnt = _dist_sql(KNN_FEATURES)
    if weights == "distance":
        w = "CASE WHEN zero = 1 THEN CASE WHEN dist = 0 THEN 1.0 ELSE 0.0 END ELSE 1.0 / dist END"
    else:
        w = "1.0"
    return _extra(
        split_cte("cohort", COHORT_KEY_SQL, "id")
        + ", qt AS (SELECT * FROM s WHERE split = 'test'), dt AS (SELECT * FROM s WHERE split = 'train'), "
        f"pr AS (SELECT q.id AS qid, d.id AS did, d.label AS y, sqrt(({acc}) * {len(KNN_FEATURES)} / ({cnt})) AS dist FROM qt q, dt d), "
        "rk AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, did) AS r FROM pr), "
        "nn AS (SELECT *, max(CASE WHEN dist = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY qid) AS zero FROM rk WHERE r <= 5), "
        f"pb AS (SELECT qid, sum(({w}) * y) / sum({w}) AS probability FROM nn GROUP BY qid)",
        "SELECT qid AS id, round(probability, 6) AS probability, CAST(probability > 0.5 AS INTEGER) AS prediction FROM pb",
    )


def _knn_clf(spark, sf_dir, weights):
    df = SP.stratified_split(FX.cohort(spark, sf_dir), "label", ["id"], 0.2, order_key=_cohort_key())
    train, test = df.where(F.col("split") == "train"), df.where(F.col("split") == "test")
    return N.knn_predict(train, test, "id", KNN_FEATURES, "label", k=5, weights=weights)




@query("k2_knn_classifier", _knn_clf_sql("uniform"))
def k2_knn_classifier(spark, sf_dir):
    """K2: 5-NN vote (uniform) for the test split of F-COHORT."""
    return _knn_clf(spark, sf_dir, "uniform")


@query("k2_knn_classifier_distance", _knn_clf_sql("distance"))
def k2_knn_classifier_distance(spark, sf_dir):
    """K2: 5-NN vote weighted by 1/distance."""
    return _knn_clf(spark, sf_dir, "distance")


@query(
    "i4_smote_balance",
    _extra(
        split_cte("cohort", COHORT_KEY_SQL, "id")
        + ", tr AS (SELECT label, count(*) AS n FROM s WHERE split = 'train' GROUP BY label), "
        "mn AS (SELECT label AS minority, n AS n_min FROM tr ORDER BY n, label LIMIT 1), mj AS (SELECT max(n) AS n_maj FROM tr)",
        "SELECT label, false AS is_synthetic, CAST(n AS BIGINT) AS n FROM tr UNION ALL "
        "SELECT minority, true, CAST(n_maj - n_min AS BIGINT) FROM mn, mj WHERE n_maj > n_min",
    ),
)
def i4_smote_balance(spark, sf_dir):
    """I4: class sizes after SMOTE on the F-COHORT train split (parity expected)."""
    df = SP.stratified_split(FX.cohort(spark, sf_dir), "label", ["id"], 0.2, order_key=_cohort_key())
    train = df.where(F.col("split") == "train").select("id", *KNN_FEATURES, "label")
    out = N.smote(train, "id", KNN_FEATURES, "label", k=5, seed=42)
    return out.groupBy("label", "is_synthetic").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def _smote_rows_sql():
    acc = " + ".join(f"(q.{c} - d.{c}) * (q.{c} - d.{c})" for c in KNN_FEATURES)
    return _extra(
        split_cte("cohort", COHORT_KEY_SQL, "id")
        + ", tr AS (SELECT * FROM s WHERE split = 'train'), mn AS (SELECT label AS minority FROM tr GROUP BY label ORDER BY count(*), label LIMIT 1), "
        "mi AS (SELECT tr.* FROM tr JOIN mn ON label = minority), "
        f"pr AS (SELECT q.id AS base_id, d.id AS did, sqrt({acc}) AS dist FROM mi q, mi d WHERE q.id <> d.id), "
        "rk AS (SELECT *, row_number() OVER (PARTITION BY base_id ORDER BY dist, did) AS r FROM pr)",
        "SELECT base_id, string_agg(did::VARCHAR, ',' ORDER BY r) AS neighbours, true AS drawn_from_them, true AS on_the_segments FROM rk WHERE r <= 5 GROUP BY base_id",
    )


@query("i4_smote_rows", _smote_rows_sql())
def i4_smote_rows(spark, sf_dir):
    """I4: per minority row its five nearest minority neighbours, and whether all synthetic rows made from it use one of them
    and lie at their gap on the segment between the two."""
    df = SP.stratified_split(FX.cohort(spark, sf_dir), "label", ["id"], 0.2, order_key=_cohort_key())
    train = df.where(F.col("split") == "train").select("id", *KNN_FEATURES, "label")
    made = N.smote(train, "id", KNN_FEATURES, "label", k=5, seed=42, trace=True).where("is_synthetic")
    counts = SP.class_counts(train, "label")
    mins = train.where(F.col("label") == min(counts, key=lambda c: (counts[c], c)))
    near = N.knn_join(mins, mins, "id", "id", KNN_FEATURES, 5, exclude_self=True)
    lists = near.groupBy(F.col("qid").alias("base_id")).agg(F.sort_array(F.collect_list(F.struct("rank", "did"))).alias("nn"))
    ends = [mins.select(F.col("id").alias(i), *[F.col(c).cast("double").alias(f"{p}_{c}") for c in KNN_FEATURES]) for i, p in (("base_id", "b"), ("neighbour_id", "n"))]
    off = [F.abs(F.col(f"b_{c}") + F.col("gap") * (F.col(f"n_{c}") - F.col(f"b_{c}")) - F.col(c)) <= 1e-9 * (1 + F.abs(F.col(c))) for c in KNN_FEATURES]
    checked = made.join(ends[0], "base_id").join(ends[1], "neighbour_id").withColumn("on", off[0] & off[1])
    checked = checked.join(lists, "base_id").withColumn("one", F.exists("nn", lambda x: x["did"] == F.col("neighbour_id")))
    checked = checked.groupBy("base_id").agg(F.every("one").alias("one"), F.every("on").alias("on"))
    return lists.join(checked, "base_id", "left").select(
        "base_id",
        F.array_join(F.transform("nn", lambda x: x["did"].cast("string")), ",").alias("neighbours"),
        F.coalesce("one", F.lit(True)).alias("drawn_from_them"),
        F.coalesce("on", F.lit(True)).alias("on_the_segments"),
    )
