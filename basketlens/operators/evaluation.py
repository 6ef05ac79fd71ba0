"""Classifier evaluation as DataFrame aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import prefix_sums


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row (tn, fp, fn, tp) from one aggregation; safe with a single class."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    return df.agg(F.count_if((y == 0) & (p == 0)).cast("bigint").alias("tn"),
                  F.count_if((y == 0) & (p == 1)).cast("bigint").alias("fp"),
                  F.count_if((y == 1) & (p == 0)).cast("bigint").alias("fn"),
                  F.count_if((y == 1) & (p == 1)).cast("bigint").alias("tp"))


def _threshold_counts(df: DataFrame, label: str, score: str, prediction: str | None = None,
                      keys: Sequence[str] = ()) -> DataFrame:
    """Positives/negatives per key and distinct score (ties collapse here), optionally with confusion counts."""
    y = F.col(label).cast("double")
    aggs = [F.count_if(y == 1).cast("bigint").alias("pos"), F.count_if(y != 1).cast("bigint").alias("neg")]
    if prediction:
        p = F.col(prediction).cast("double")
        aggs += [F.count_if((y == 0) & (p == 0)).alias("c_tn"), F.count_if((y == 0) & (p == 1)).alias("c_fp"),
                 F.count_if((y == 1) & (p == 0)).alias("c_fn"), F.count_if((y == 1) & (p == 1)).alias("c_tp")]
    return df.groupBy(*keys, F.col(score).cast("double").alias("threshold")).agg(*aggs)


def _with_rates(d: DataFrame, num_partitions, keys: Sequence[str] = ()) -> DataFrame:
    c = prefix_sums(d, keys, [F.desc("threshold")], ["pos", "neg"], num_partitions, few_keys=True)
    if keys:
        c = c.join(d.groupBy(*keys).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")), list(keys))
    else:
        c = c.withColumns({"P": d.agg(F.sum("pos")).scalar(), "N": d.agg(F.sum("neg")).scalar()})  # no join
    return c.withColumns({
        "tp": F.col("cum_pos"), "fp": F.col("cum_neg"),
        "tpr": F.try_divide(F.col("cum_pos").cast("double"), F.col("P").cast("double")),
        "fpr": F.try_divide(F.col("cum_neg").cast("double"), F.col("N").cast("double"))})


def roc_points(df: DataFrame, label: str = "label", score: str = "score",
               num_partitions: int | None = None) -> DataFrame:
    """(threshold, pos, neg, tp, fp, tpr, fpr, P, N) per distinct score, thresholds descending.

    Ties collapse first; running sums come from ``ordering.prefix_sums``. A point means
    "predict 1 when score >= threshold"; the curve starts at (0, 0) with threshold infinity.
    An empty table has no points.
    """
    counts = _threshold_counts(df, label, score)
    pts = _with_rates(counts, num_partitions).select("threshold", "pos", "neg", "tp", "fp", "tpr", "fpr", "P", "N")
    none = F.lit(0).cast("bigint")
    origin = counts.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).filter("P IS NOT NULL").select(
        F.lit(float("inf")).alias("threshold"), none.alias("pos"), none.alias("neg"), none.alias("tp"), none.alias("fp"),
        F.try_divide(F.lit(0.0), F.col("P").cast("double")).alias("tpr"),
        F.try_divide(F.lit(0.0), F.col("N").cast("double")).alias("fpr"), "P", "N")
    return pts.unionByName(origin)


def _summary_aggs():
    auc_term = F.col("neg").cast("double") * (F.col("tp").cast("double") - F.col("pos") / 2.0)
    youden = F.col("tpr") - F.col("fpr")
    return [F.try_divide(F.sum(auc_term), (F.first("P") * F.first("N")).cast("double")).alias("auc"),
            # the curve starts at "predict nothing" (threshold inf, Youden 0), which wins ties
            F.when(F.max(youden) > 0, F.max_by("threshold", F.struct(youden, F.col("threshold"))))
            .when(F.max(youden).isNotNull(), F.lit(float("inf"))).alias("best_threshold"),
            F.greatest(F.max(youden), F.when(F.max(youden).isNotNull(), F.lit(0.0))).alias("youden")]


def roc_summary(points: DataFrame) -> DataFrame:
    """AUC (trapezoid = Mann-Whitney with half ties) and Youden-optimal threshold."""
    return points.agg(*_summary_aggs())


def evaluate_by(df: DataFrame, keys: Sequence[str], label: str = "label", prediction: str = "prediction",
                score: str = "score", num_partitions: int | None = None) -> DataFrame:
    """One row of metrics per key (J14, J15): confusion counts, accuracy, sensitivity, specificity,
    balanced accuracy, precision, recall, F1, AUC and the Youden threshold.

    Any number of scored tables is evaluated together: scores collapse to counts per (key, score),
    one keyed prefix sum orders them all, one aggregation ends it. A key's scores are spread over
    range partitions, so a key that holds most rows is not one task's work. The confusion counts
    ride along. Keys (configurations, models, splits) are taken to be few; rows with a NULL key take
    no part.
    """
    keys = list(keys)
    pts = _with_rates(_threshold_counts(df, label, score, prediction, keys), num_partitions, keys)
    counts = [F.sum(f"c_{k}").cast("bigint").alias(k) for k in ("tn", "fp", "fn", "tp")]
    rows = pts.groupBy(*keys).agg(*_summary_aggs(), *counts) if keys else pts.agg(*_summary_aggs(), *counts)
    tp, tn, fp, fn = (F.coalesce(F.col(c), F.lit(0)).cast("double") for c in ("tp", "tn", "fp", "fn"))
    sens = F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))
    spec = F.coalesce(F.try_divide(tn, tn + fp), F.lit(0.0))
    prec = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))
    return rows.select(
        *keys, *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("tn", "fp", "fn", "tp")],
        F.try_divide(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        sens.alias("sensitivity"), spec.alias("specificity"), ((sens + spec) / 2).alias("balanced_accuracy"),
        prec.alias("precision"), sens.alias("recall"),
        F.coalesce(F.try_divide(2 * prec * sens, prec + sens), F.lit(0.0)).alias("f1"),
        "auc", "best_threshold")


def evaluate(df: DataFrame, label: str = "label", prediction: str = "prediction", score: str = "score",
             num_partitions: int | None = None) -> DataFrame:
    """One row of metrics of the whole table (``evaluate_by`` without keys)."""
    return evaluate_by(df, [], label, prediction, score, num_partitions)
