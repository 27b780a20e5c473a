"""Registered queries on the second fixtures: ``labels.toxic`` (imbalance) and
``embeddings`` (64-dimensional nearest neighbours)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskline.operators import describe as D
from riskline.operators import neighbors as N
from riskline.operators import sampling as SP
from riskline.plans.describe_queries import _extra
from riskline.plans.registry import query
from riskline.sources.readers import table

EMB_DIM = 64


@query(
    "i3_class_weights_toxic",
    _extra(
        "c AS (SELECT toxic, count(*) AS n FROM labels GROUP BY toxic)",
        "SELECT toxic, CAST(n AS BIGINT) AS n, round((SELECT sum(n) FROM c) / (2 * n), 6) AS weight FROM c",
    ),
)
def i3_class_weights_toxic(spark, sf_dir):
    """I3 on the second imbalance fixture (labels.toxic)."""
    df = SP.with_class_weights(table(spark, sf_dir, "labels"), "toxic")
    return df.groupBy("toxic").agg(F.count(F.lit(1)).cast("bigint").alias("n"), F.first("weight").alias("weight"))


@query(
    "d16_prevalence_toxic_by_quality",
    _extra(
        "x AS (SELECT 1)",
        "SELECT 'quality' AS variable, CAST(quality AS VARCHAR) AS category, CAST(count(*) AS BIGINT) AS n, "
        "CAST(count_if(toxic = 1) AS BIGINT) AS positives, round(count_if(toxic = 1) / count(*) * 100, 6) AS rate "
        "FROM labels WHERE quality IS NOT NULL GROUP BY quality",
    ),
)
def d16_prevalence_toxic_by_quality(spark, sf_dir):
    """Toxic rate per quality class."""
    return D.prevalence(table(spark, sf_dir, "labels"), ["quality"], "toxic")


def _emb_cols(df):
    return df.select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(EMB_DIM)])


def _emb_ctes():
    dist = (
        "list_reduce(list_transform(list_zip(q.embedding::DOUBLE[], d.embedding::DOUBLE[]), lambda x: (x[1] - x[2]) * (x[1] - x[2])), "
        "lambda a, b: a + b)"
    )
    return (
        f"pr AS (SELECT q.vec_id AS qid, d.vec_id AS did, sqrt({dist} * {EMB_DIM} / {EMB_DIM}) AS dist "
        "FROM embeddings q, embeddings d WHERE q.vec_id <> d.vec_id), "
        "rk AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, did) AS r FROM pr)"
    )


def _emb_sql():
    return _extra(_emb_ctes(), "SELECT qid, did, round(dist, 6) AS dist, CAST(r AS INTEGER) AS rank FROM rk WHERE r <= 5")


@query("g2_knn_embeddings", _emb_sql())
def g2_knn_embeddings(spark, sf_dir):
    """G2-G4 on the 64-d embeddings: the 5 nearest other vectors of every vector
    (exact blocked self-join, self excluded)."""
    e = _emb_cols(table(spark, sf_dir, "embeddings"))
    cols = [f"e{i}" for i in range(EMB_DIM)]
    nn = N.knn_join(e, e, "vec_id", "vec_id", cols, k=5, exclude_self=True)
    return nn.select("qid", "did", "dist", F.col("rank").cast("int").alias("rank"))


@query(
    "k2_knn_embeddings_label_agreement",
    _extra(
        _emb_ctes() + ", nn AS (SELECT qid, did FROM rk WHERE r <= 5)",
        "SELECT q.label, CAST(count(*) AS BIGINT) AS pairs, CAST(count_if(q.label = d.label) AS BIGINT) AS same_label "
        "FROM nn JOIN embeddings q ON nn.qid = q.vec_id JOIN embeddings d ON nn.did = d.vec_id GROUP BY q.label",
    ),
)
def k2_knn_embeddings_label_agreement(spark, sf_dir):
    """K2 support: per label, how many of the 5 nearest neighbours share it."""
    emb = table(spark, sf_dir, "embeddings")
    e = _emb_cols(emb)
    cols = [f"e{i}" for i in range(EMB_DIM)]
    nn = N.knn_join(e, e, "vec_id", "vec_id", cols, k=5, exclude_self=True)
    lab = emb.select("vec_id", "label")
    j = nn.join(lab.withColumnRenamed("vec_id", "qid"), "qid").join(
        lab.select(F.col("vec_id").alias("did"), F.col("label").alias("d_label")), "did"
    )
    return j.groupBy("label").agg(
        F.count(F.lit(1)).cast("bigint").alias("pairs"),
        F.count_if(F.col("label") == F.col("d_label")).cast("bigint").alias("same_label"),
    )
