"""Registered queries: metrics, curves, confusion matrix, leaderboards.

The scored frame comes from three arithmetic scorers over F-BULK (so DuckDB
can reproduce every score exactly) at three decision thresholds: nine
"runs" evaluated in one pass each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskline.functions.exprs import run_key
from riskline.operators import metrics as M
from riskline.plans.describe_queries import _extra
from riskline.plans.registry import query
from riskline.sources import fixtures as FX

# Fixed scorer definitions (both engines).
SCORERS = {
    "qty": "quantity / 50.0",
    "qty_price": "(quantity * 2 + coalesce(price, 0.0) / 2000.0) / 200.0",
    "disc": "discount * 10.0",
}
THRESHOLDS = {"t40": 0.4, "t50": 0.5, "t60": 0.6}


def scored(spark, sf_dir) -> DataFrame:
    """``model_name, label, score`` (one row per F-BULK row and scorer)."""
    b = FX.bulk(spark, sf_dir)
    wide = b.select("label", *[F.expr(e).alias(k) for k, e in SCORERS.items()])
    return wide.unpivot(["label"], list(SCORERS), "model_name", "score")


def scored_runs(spark, sf_dir) -> DataFrame:
    """``model_name, threshold, label, score, prediction`` (nine runs)."""
    s = scored(spark, sf_dir)
    t = F.explode(F.array(*[F.struct(F.lit(k).alias("threshold"), F.lit(v).alias("cut")) for k, v in THRESHOLDS.items()]))
    r = s.select("*", t.alias("t")).select("model_name", "t.threshold", "label", "score", "t.cut")
    return r.withColumn("prediction", (F.col("score") >= F.col("cut")).cast("int")).drop("cut")


def results(spark, sf_dir) -> DataFrame:
    """The run result table (one row per run), as the experiment matrix emits."""
    # Confusion counts per run; the AUC does not depend on the threshold, so it
    # is ranked once per scorer and joined to its runs.
    ev = M.evaluate_predictions(scored_runs(spark, sf_dir), "label", "prediction", None, by=["model_name", "threshold"]).drop("roc_auc")
    auc = M.roc_auc(scored(spark, sf_dir), "label", "score", by=["model_name"])
    ev = ev.join(auc, "model_name")
    return ev.select(
        run_key(F.col("model_name"), F.col("threshold")).alias("run_key"),
        "model_name",
        "threshold",
        F.col("accuracy").alias("test_accuracy"),
        F.col("precision").alias("test_precision"),
        F.col("recall").alias("test_recall"),
        F.col("f1").alias("test_f1"),
        F.col("roc_auc").alias("test_roc_auc"),
    )


# ---------------------------------------------------------------------------
# SQL twins
# ---------------------------------------------------------------------------

_SCORED_SQL = " UNION ALL ".join(f"SELECT '{k}' AS model_name, label, {e} AS score FROM bulk" for k, e in SCORERS.items())
_RUNS_SQL = " UNION ALL ".join(
    f"SELECT model_name, '{k}' AS threshold, label, score, CAST(score >= {v} AS INTEGER) AS prediction FROM sc"
    for k, v in THRESHOLDS.items()
)
_AUC_SQL = (
    "v AS (SELECT model_name, score, count_if(label = 1) AS p, count(*) AS t FROM sc GROUP BY ALL), "
    "rk AS (SELECT *, coalesce(sum(t) OVER (PARTITION BY model_name ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) "
    "+ (t + 1) / 2.0 AS avg_rank FROM v), "
    "auc AS (SELECT model_name, (sum(p * avg_rank) - sum(p) * (sum(p) + 1) / 2.0) / (sum(p) * (sum(t) - sum(p))) AS roc_auc FROM rk GROUP BY model_name)"
)
_RESULTS_SQL = (
    "cm AS (SELECT model_name, threshold, count_if(label = 1 AND prediction = 1) AS tp, count_if(label <> 1 AND prediction = 1) AS fp, "
    "count_if(label = 1 AND prediction <> 1) AS fn, count_if(label <> 1 AND prediction <> 1) AS tn, count(*) AS n FROM runs GROUP BY ALL), "
    "res AS (SELECT cm.model_name || '__' || threshold AS run_key, cm.model_name, threshold, (tp + tn) / n AS test_accuracy, "
    "CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS test_precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS test_recall, "
    "CASE WHEN 2*tp + fp + fn > 0 THEN 2*tp / (2*tp + fp + fn) ELSE 0.0 END AS test_f1, roc_auc AS test_roc_auc "
    "FROM cm JOIN auc ON cm.model_name = auc.model_name)"
)
_BASE = f"sc AS ({_SCORED_SQL}), runs AS ({_RUNS_SQL}), {_AUC_SQL}, {_RESULTS_SQL}"
_R6 = lambda cols: ", ".join(f"round({c}, 6) AS {c}" for c in cols)
_METRICS = ["test_accuracy", "test_precision", "test_recall", "test_f1", "test_roc_auc"]


@query(
    "k11_evaluate_predictions",
    _extra(_BASE, f"SELECT run_key, model_name, threshold, {_R6(_METRICS)} FROM res"),
)
def k11_evaluate_predictions(spark, sf_dir):
    """Accuracy, precision, recall, F1 and exact ROC AUC for nine runs in one pass."""
    return results(spark, sf_dir)


@query("k11_roc_auc", _extra(_BASE, "SELECT model_name, round(roc_auc, 6) AS roc_auc FROM auc"))
def k11_roc_auc(spark, sf_dir):
    """Exact (tie-averaged rank) ROC AUC per scorer."""
    return M.roc_auc(scored(spark, sf_dir), "label", "score", by=["model_name"])


_PTS = (
    "pt AS (SELECT model_name, score AS threshold, count_if(label = 1) AS tp, count_if(label <> 1) AS fp FROM sc GROUP BY ALL), "
    "cu AS (SELECT *, sum(tp) OVER w AS tps, sum(fp) OVER w AS fps, lead(tp) OVER w2 AS tp_next, lead(fp) OVER w2 AS fp_next, "
    "row_number() OVER w2 AS pos, sum(tp) OVER (PARTITION BY model_name) AS P, sum(fp) OVER (PARTITION BY model_name) AS N FROM pt "
    "WINDOW w AS (PARTITION BY model_name ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
    "w2 AS (PARTITION BY model_name ORDER BY threshold DESC))"
)


@query(
    "k12_roc_curve",
    _extra(
        f"sc AS ({_SCORED_SQL}), {_PTS}",
        "SELECT model_name, round(threshold, 6) AS threshold, round(fps / N, 6) AS fpr, round(tps / P, 6) AS tpr FROM cu "
        "WHERE pos = 1 OR tp_next IS NULL OR tp_next <> tp OR fp_next <> fp "
        "UNION ALL SELECT DISTINCT model_name, 'Infinity'::DOUBLE, 0.0, 0.0 FROM sc",
    ),
)
def k12_roc_curve(spark, sf_dir):
    """ROC corners per scorer (collinear points dropped), starting at (0, 0)."""
    return M.roc_curve(scored(spark, sf_dir), "label", "score", by=["model_name"])


@query(
    "k12_roc_curve_all_points",
    _extra(
        f"sc AS ({_SCORED_SQL}), {_PTS}",
        "SELECT model_name, round(threshold, 6) AS threshold, round(fps / N, 6) AS fpr, round(tps / P, 6) AS tpr FROM cu "
        "UNION ALL SELECT DISTINCT model_name, 'Infinity'::DOUBLE, 0.0, 0.0 FROM sc",
    ),
)
def k12_roc_curve_all_points(spark, sf_dir):
    """K12 with every distinct threshold kept."""
    return M.roc_curve(scored(spark, sf_dir), "label", "score", by=["model_name"], drop_intermediate=False)


@query(
    "k13_pr_curve",
    _extra(
        f"sc AS ({_SCORED_SQL}), {_PTS}",
        "SELECT model_name, round(threshold, 6) AS threshold, round(tps / (tps + fps), 6) AS precision, round(tps / P, 6) AS recall FROM cu WHERE tps - tp < P "
        "UNION ALL SELECT DISTINCT model_name, NULL::DOUBLE, 1.0, 0.0 FROM sc",
    ),
)
def k13_pr_curve(spark, sf_dir):
    """Precision-recall points per scorer down to full recall, plus (1, 0)."""
    return M.pr_curve(scored(spark, sf_dir), "label", "score", by=["model_name"])


@query(
    "k14_confusion_matrix",
    _extra(
        _BASE,
        "SELECT model_name, threshold, actual, predicted, CAST(c AS BIGINT) AS count FROM cm, "
        "LATERAL (VALUES (1, 1, tp), (0, 1, fp), (1, 0, fn), (0, 0, tn)) v(actual, predicted, c)",
    ),
)
def k14_confusion_matrix(spark, sf_dir):
    """Full 2 x 2 confusion grid per run."""
    return M.confusion_matrix(scored_runs(spark, sf_dir), "label", "prediction", by=["model_name", "threshold"])


@query(
    "k20_score_density",
    _extra(
        "s AS (SELECT label, (quantity * 2 + coalesce(price, 0.0) / 2000.0) / 200.0 AS score FROM bulk), "
        "r AS (SELECT label, min(score) AS mn, max(score) AS mx, count(*) AS n FROM s GROUP BY label), "
        "b AS (SELECT s.label, CASE WHEN mx = mn THEN 1 ELSE CAST(least(floor((score - mn) / (mx - mn) * 20) + 1, 20) AS INTEGER) END AS bin "
        "FROM s JOIN r ON s.label = r.label), c AS (SELECT label, bin, count(*) AS k FROM b GROUP BY ALL), "
        "g AS (SELECT label, mn, mx, n, CAST(x.generate_series AS INTEGER) AS bin FROM r, generate_series(1, 20) x)",
        "SELECT g.label, g.bin, round(mn + (mx - mn) / 20 * (g.bin - 1), 6) AS lower, round(mn + (mx - mn) / 20 * g.bin, 6) AS upper, "
        "CAST(coalesce(k, 0) AS BIGINT) AS count, round(CASE WHEN mx > mn THEN coalesce(k, 0) / (n * (mx - mn) / 20) END, 6) AS density "
        "FROM g LEFT JOIN c ON g.label = c.label AND g.bin = c.bin",
    ),
)
def k20_score_density(spark, sf_dir):
    """20-bin score density per class for the best scorer."""
    s = scored(spark, sf_dir).where(F.col("model_name") == "qty_price")
    return M.score_density(s, "label", "score", bins=20)


# --- result-table operators ----------------------------------------------------


@query(
    "e2_leaderboard",
    _extra(
        _BASE,
        f"SELECT run_key, model_name, threshold, {_R6(_METRICS)}, CAST(row_number() OVER (ORDER BY test_f1 DESC, test_precision DESC, "
        "test_recall DESC, test_accuracy DESC, run_key) AS INTEGER) AS rank FROM res",
    ),
)
def e2_leaderboard(spark, sf_dir):
    """Runs sorted by F1, precision, recall, accuracy (then run key) with a rank."""
    return M.leaderboard(results(spark, sf_dir))


@query(
    "e3_top_runs_by_auc",
    _extra(_BASE, f"SELECT run_key, model_name, threshold, {_R6(_METRICS)} FROM res ORDER BY test_roc_auc DESC, run_key LIMIT 5"),
)
def e3_top_runs_by_auc(spark, sf_dir):
    """The five best runs by ROC AUC (a top-k report)."""
    return M.top_runs(results(spark, sf_dir), "test_roc_auc", n=5)


@query(
    "e5_best_run",
    _extra(
        _BASE,
        f"SELECT run_key, model_name, threshold, {_R6(_METRICS)} FROM res ORDER BY test_f1 DESC, test_precision DESC, "
        "test_recall DESC, test_accuracy DESC, run_key LIMIT 1",
    ),
)
def e5_best_run(spark, sf_dir):
    """E5: the leaderboard's first run."""
    return M.best_run(results(spark, sf_dir))


@query(
    "d24_metric_summary",
    _extra(
        _BASE,
        "SELECT model_name, "
        + ", ".join(f"round(avg({m}), 6) AS {m}_mean, round(stddev_samp({m}), 6) AS {m}_std" for m in _METRICS)
        + " FROM res GROUP BY model_name",
    ),
)
def d24_metric_summary(spark, sf_dir):
    """Mean and std of the five metrics per model."""
    return M.metric_summary(results(spark, sf_dir), "model_name", _METRICS)


@query(
    "d25_best_f1_pivot",
    _extra(
        _BASE,
        "SELECT model_name, "
        + ", ".join(f"round(max(test_f1) FILTER (WHERE threshold = '{t}'), 6) AS {t}" for t in THRESHOLDS)
        + " FROM res GROUP BY model_name",
    ),
)
def d25_best_f1_pivot(spark, sf_dir):
    """Max F1 per model x threshold (pivot)."""
    return M.best_pivot(results(spark, sf_dir), "model_name", "threshold", "test_f1", list(THRESHOLDS))
