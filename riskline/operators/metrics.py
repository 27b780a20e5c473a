"""Classification metrics, curves and leaderboards.

Everything is computed from a scored frame ``(label, prediction, score)``
without collecting it: confusion counts are one conditional aggregate; the
exact ROC AUC is the tie-averaged rank form (one row per distinct score,
ranked with range-partitioned prefix sums); curve points come from the same
cumulative counts. ``by`` computes many runs (models, folds) in one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskline.operators.long import join_small
from riskline.operators.ordering import next_values, prefix_sums, rank_sums, with_ranges


def _safe_div(a, b):
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def _keyed(df: DataFrame, by: Sequence[str]):
    """Ungrouped calls group by a constant key, so every step stays an equi-join."""
    if by:
        return df, list(by), []
    return df.withColumn("_all", F.lit(0)), ["_all"], ["_all"]


def confusion_counts(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """``by..., tp, fp, fn, tn, n`` in one aggregate."""
    y, p = F.col(label), F.col(prediction)
    return df.groupBy(*by).agg(
        F.count_if((y == 1) & (p == 1)).cast("bigint").alias("tp"),
        F.count_if((y != 1) & (p == 1)).cast("bigint").alias("fp"),
        F.count_if((y == 1) & (p != 1)).cast("bigint").alias("fn"),
        F.count_if((y != 1) & (p != 1)).cast("bigint").alias("tn"),
        F.count(F.lit(1)).cast("bigint").alias("n"),
    )


def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact ROC AUC per ``by`` key: (R_pos - n_pos(n_pos+1)/2) / (n_pos n_neg)
    with tie-averaged ranks; NULL when a class is absent."""
    rs = rank_sums(df, score, label, by=by, positive=1)
    npos, nneg = F.col("n_pos"), F.col("n_neg")
    auc = (F.col("rank_sum_pos") - npos * (npos + 1) / 2.0) / (npos * nneg)
    return rs.select(*by, F.when((npos > 0) & (nneg > 0), auc).alias("roc_auc"))


def evaluate_predictions(
    df: DataFrame, label: str, prediction: str, score: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """``by..., accuracy, precision, recall, f1, roc_auc`` (zero division -> 0;
    roc_auc NULL without a score)."""
    df, by, extra = _keyed(df, by)
    c = confusion_counts(df, label, prediction, by)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    prec = _safe_div(tp, tp + fp)
    rec = _safe_div(tp, tp + fn)
    m = c.select(
        *by,
        ((tp + tn) / F.col("n")).alias("accuracy"),
        prec.alias("precision"),
        rec.alias("recall"),
        _safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )
    if score is None:
        return m.withColumn("roc_auc", F.lit(None).cast("double")).drop(*extra)
    a = roc_auc(df, label, score, by)
    return join_small(m, a, by, "left").drop(*extra)


def _score_points(df: DataFrame, label: str, score: str, by: Sequence[str]) -> DataFrame:
    """One row per distinct score: own ``tp``/``fp`` and cumulative ``tps``/``fps``
    over scores >= it (descending threshold order), plus class totals."""
    by = list(by)
    base = df.where(F.col(score).isNotNull())
    pts = base.groupBy(*by, F.col(score).alias("threshold")).agg(
        F.count_if(F.col(label) == 1).cast("bigint").alias("tp"),
        F.count_if(F.col(label) != 1).cast("bigint").alias("fp"),
    )
    pts = with_ranges(pts, by, "threshold", descending=True)  # one row per distinct score, reused by every step below
    tot = pts.groupBy(*by).agg(F.sum("tp").cast("bigint").alias("P"), F.sum("fp").cast("bigint").alias("N"))
    cum = prefix_sums(pts, by, "threshold", ["tp", "fp"], descending=True, keep_range=True)
    cum = cum.withColumns({"tps": F.col("tp_before") + F.col("tp"), "fps": F.col("fp_before") + F.col("fp")})
    return join_small(cum, tot, by)  # #keys rows


def roc_curve(df: DataFrame, label: str, score: str, by: Sequence[str] = (), drop_intermediate: bool = True) -> DataFrame:
    """``by..., threshold, fpr, tpr`` with a first point (0, 0) at
    threshold +inf; ``drop_intermediate`` keeps only corners (a point is dropped
    when its successor adds exactly the same tp and fp)."""
    df, by, extra = _keyed(df, by)
    pts = _score_points(df, label, score, by)
    if drop_intermediate:
        nx = next_values(pts, by, "threshold", ["tp", "fp"], descending=True)
        first = (F.col("tp_before") + F.col("fp_before")) == 0
        last = F.col("tp_next").isNull()
        keep = first | last | (F.col("tp_next") != F.col("tp")) | (F.col("fp_next") != F.col("fp"))
        pts = nx.where(keep)
    curve = pts.select(
        *by,
        F.col("threshold").cast("double").alias("threshold"),
        _safe_div(F.col("fps"), F.col("N")).alias("fpr"),
        _safe_div(F.col("tps"), F.col("P")).alias("tpr"),
    )
    start = df.select(*by).distinct()
    start = start.select(*by, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return curve.unionByName(start).drop(*extra)


def pr_curve(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """``by..., threshold, precision, recall`` for thresholds from the
    highest score down to the first one reaching full recall, plus the final
    point (precision 1, recall 0, threshold NULL)."""
    df, by, extra = _keyed(df, by)
    pts = _score_points(df, label, score, by).where(F.col("tp_before") < F.col("P"))
    curve = pts.select(
        *by,
        F.col("threshold").cast("double").alias("threshold"),
        _safe_div(F.col("tps"), F.col("tps") + F.col("fps")).alias("precision"),
        _safe_div(F.col("tps"), F.col("P")).alias("recall"),
    )
    end = df.select(*by).distinct()
    end = end.select(*by, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return curve.unionByName(end).drop(*extra)


def confusion_matrix(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """``by..., actual, predicted, count`` on the full 2 x 2 grid (0-filled)."""
    c = confusion_counts(df, label, prediction, by)
    cells = F.array(
        *[
            F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(n).alias("count"))
            for a, p, n in ((1, 1, "tp"), (0, 1, "fp"), (1, 0, "fn"), (0, 0, "tn"))
        ]
    )
    return c.select(*by, F.explode(cells).alias("c")).select(*by, "c.*")


def score_density(df: DataFrame, label: str, score: str, bins: int = 20) -> DataFrame:
    """Per class, ``bins`` equal-width bins over the class's score range with
    ``count`` and ``density = count / (n * width)`` (empty bins included)."""
    base = df.where(F.col(score).isNotNull())
    rng = base.groupBy(label).agg(F.min(score).alias("mn"), F.max(score).alias("mx"), F.count(F.lit(1)).alias("n"))
    # #classes rows: bounded, broadcast.
    j = base.join(F.broadcast(rng), label)
    b = F.least(F.floor((F.col(score) - F.col("mn")) / (F.col("mx") - F.col("mn")) * bins) + 1, F.lit(bins))
    b = F.when(F.col("mx") == F.col("mn"), F.lit(1)).otherwise(b).cast("int")
    counts = j.groupBy(label, b.alias("bin")).agg(F.count(F.lit(1)).cast("bigint").alias("count"))
    frame = rng.select(label, "mn", "mx", "n", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    width = (F.col("mx") - F.col("mn")) / bins
    out = frame.join(counts, [label, "bin"], "left").select(
        label,
        "bin",
        (F.col("mn") + width * (F.col("bin") - 1)).alias("lower"),
        (F.col("mn") + width * F.col("bin")).alias("upper"),
        F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
        "n",
        "mn",
        "mx",
    )
    dens = F.when(F.col("mx") > F.col("mn"), F.col("count") / (F.col("n") * (F.col("mx") - F.col("mn")) / bins))
    return out.withColumn("density", dens).drop("n", "mn", "mx")


# ---------------------------------------------------------------------------
# Result-table operators (small frames: one row per run)
# ---------------------------------------------------------------------------

LEADERBOARD_ORDER = ["test_f1", "test_precision", "test_recall", "test_accuracy"]


def leaderboard(results: DataFrame, order: Sequence[str] = LEADERBOARD_ORDER, tie: Sequence[str] = ("run_key",)) -> DataFrame:
    """Sort by the metrics (desc) then the run key, with a ``rank`` column."""
    w = Window.orderBy(*[F.desc(c) for c in order], *tie)  # one row per run: small
    return results.withColumn("rank", F.row_number().over(w))


def top_runs(results: DataFrame, metric: str = "test_roc_auc", n: int = 10, tie: Sequence[str] = ("run_key",)) -> DataFrame:
    """The ``n`` best runs by one metric (a top-k report)."""
    return results.orderBy(F.desc(metric), *tie).limit(n)


def best_run(results: DataFrame, order: Sequence[str] = LEADERBOARD_ORDER, tie: Sequence[str] = ("run_key",)) -> DataFrame:
    """E5: the first row of the leaderboard."""
    return results.orderBy(*[F.desc(c) for c in order], *tie).limit(1)


def metric_summary(results: DataFrame, by: str, metrics: Sequence[str]) -> DataFrame:
    """Mean and sample std of each metric per ``by`` value."""
    aggs = []
    for m in metrics:
        aggs += [F.avg(m).alias(f"{m}_mean"), F.stddev_samp(m).alias(f"{m}_std")]
    return results.groupBy(by).agg(*aggs)


def best_pivot(results: DataFrame, index: str, columns: str, values: str, column_values: Sequence[str]) -> DataFrame:
    """``max(values)`` for ``index`` x ``columns`` (pivot values given, so
    no extra job to discover them)."""
    return results.groupBy(index).pivot(columns, list(column_values)).agg(F.max(values))
