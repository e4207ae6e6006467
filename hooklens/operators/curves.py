"""Precision-recall and ROC points, areas and threshold choice.

Scores are first reduced to one row per distinct score, so equal scores cost one row, and
the running counts use written score ranges. Each point carries the counts of the
point before it, so areas and the choice of thresholds are plain aggregates.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from hooklens.session import shuffle_partitions, written

RECALL_FLOOR = 0.90
#: Distinct scores summed in one piece, about.
RANGE_ROWS = 500_000


def _share(part: Column, whole: Column, default: float) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(default))


def _f1(precision: Column, recall: Column) -> Column:
    both = precision + recall
    return F.coalesce(F.try_divide(2.0 * precision * recall, both), F.lit(0.0))


def cumulative_counts(
    predictions: DataFrame, by: Sequence[str] = (), buckets: int | None = None
) -> DataFrame:
    """Per distinct score: rows of each class at it, and at or above it.

    Columns: the group, `threshold, pos, neg, tp, fp, n_pos, n_neg`. Runs jobs when called: the distinct scores are
    cut into ranges by one range shuffle, as many as there are rows for, and written with their range. So any number
    of distinct scores is summed in bounded pieces, and nothing of the ranges is in the plan.
    """
    by = list(by)
    if buckets is None:
        rows = predictions.count()
        buckets = max(shuffle_partitions(predictions.sparkSession), math.ceil(rows / RANGE_ROWS))
    points = (
        predictions.groupBy(*by, F.col("score").alias("threshold"))
        .agg(F.sum("y_true").cast("bigint").alias("pos"), F.count("*").alias("_all"))
        .withColumn("neg", F.col("_all") - F.col("pos"))
        .repartitionByRange(buckets, *by, F.desc("threshold"))
        .withColumn("_bucket", -F.spark_partition_id())
    )
    points = written(points, "points")
    # one row per bucket: what lies above it, and the class totals
    whole = W.partitionBy(*by)
    above = whole.orderBy(F.desc("_bucket")).rowsBetween(W.unboundedPreceding, -1)
    sums = points.groupBy(*by, "_bucket").agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    offsets = sums.select(
        *by,
        "_bucket",
        F.coalesce(F.sum("_p").over(above), F.lit(0)).alias("_tp_above"),
        F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_fp_above"),
        F.sum("_p").over(whole).alias("n_pos"),
        F.sum("_n").over(whole).alias("n_neg"),
    )
    inside = (
        W.partitionBy(*by, "_bucket")
        .orderBy(F.desc("threshold"))
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    return points.join(offsets, [*by, "_bucket"]).select(
        *by,
        "threshold",
        "pos",
        "neg",
        (F.sum("pos").over(inside) + F.col("_tp_above")).alias("tp"),
        (F.sum("neg").over(inside) + F.col("_fp_above")).alias("fp"),
        "n_pos",
        "n_neg",
    )


def with_rates(counts: DataFrame) -> DataFrame:
    """Add precision, recall, F1 and the ROC rates, of each point and of the one above it."""
    tp, fp, n_pos, n_neg = (F.col(c) for c in ("tp", "fp", "n_pos", "n_neg"))
    tp_up, fp_up = tp - F.col("pos"), fp - F.col("neg")
    rates = counts.withColumns(
        {
            "precision": _share(tp, tp + fp, 1.0),
            "recall": _share(tp, n_pos, 1.0),
            "fpr": _share(fp, n_neg, 0.0),
            "tpr": _share(tp, n_pos, 0.0),
            "precision_up": _share(tp_up, tp_up + fp_up, 1.0),
            "recall_up": F.when(tp_up + fp_up == 0, 0.0).otherwise(_share(tp_up, n_pos, 1.0)),
            "fpr_up": _share(fp_up, n_neg, 0.0),
            "tpr_up": _share(tp_up, n_pos, 0.0),
        }
    )
    return rates.withColumns(
        {
            "f1": _f1(F.col("precision"), F.col("recall")),
            "f1_up": _f1(F.col("precision_up"), F.col("recall_up")),
        }
    )


def pr_curve(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    points = with_rates(cumulative_counts(predictions, by))
    return points.select(*by, "threshold", "tp", "fp", "precision", "recall")


def roc_curve(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    points = with_rates(cumulative_counts(predictions, by))
    return points.select(*by, "threshold", "fpr", "tpr")


def area_columns() -> list[Column]:
    """Aggregates over rated points: average precision, AUROC, trapezoid area under PR.

    AUROC is null when one class is absent.
    """
    rise = F.col("recall") - F.col("recall_up")
    ap = F.sum(F.col("pos") * F.col("precision")) / F.first("n_pos")
    both = (F.first("n_pos") > 0) & (F.first("n_neg") > 0)
    trapezoid = (F.col("fpr") - F.col("fpr_up")) * (F.col("tpr") + F.col("tpr_up")) / 2
    pr_trapezoid = rise * (F.col("precision") + F.col("precision_up")) / 2
    return [
        F.when(F.first("n_pos") > 0, ap).otherwise(0.0).alias("pr_auc"),
        F.when(both, F.sum(trapezoid)).alias("roc_auc"),
        F.sum(pr_trapezoid).alias("pr_trapezoid"),
    ]


def curve_areas(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return _grouped(with_rates(cumulative_counts(predictions, by)), by).agg(*area_columns())


def _grouped(df: DataFrame, by: Sequence[str]):
    return df.groupBy(*by) if by else df.groupBy()


def choice_column(recall_floor: float | None, alignment: str = "same") -> Column:
    """Aggregate that picks the best point, as a struct.

    With a recall floor: highest precision, then highest F1, then lowest threshold among
    the points that reach the floor; if none does, or without a floor, highest F1, then
    lowest threshold. `alignment="next"` rates each threshold by the point above it.
    """
    suffix = {"same": "", "next": "_up"}[alignment]
    precision, recall, f1 = (F.col(f"{c}{suffix}") for c in ("precision", "recall", "f1"))
    reaches = F.lit(False) if recall_floor is None else recall >= recall_floor
    best = F.max(
        F.struct(
            reaches.alias("reaches"),
            F.when(reaches, precision).otherwise(0.0).alias("rank"),
            f1.alias("f1"),
            (-F.col("threshold")).alias("low"),
            F.col("threshold"),
            precision.alias("precision"),
            recall.alias("recall"),
            "tp", "fp", "n_pos", "n_neg",
        )
    )
    return best.alias("best")


def select_threshold(
    predictions: DataFrame,
    recall_floor: float | None = RECALL_FLOOR,
    alignment: str = "same",
    by: Sequence[str] = (),
) -> DataFrame:
    """Per group the chosen threshold with its rates and whether the floor was reached."""
    points = with_rates(cumulative_counts(predictions, by))
    chosen = _grouped(points, by).agg(choice_column(recall_floor, alignment))
    mode = F.when(F.col("best.reaches"), "recall_floor").otherwise("maxF1_fallback")
    return chosen.select(
        *by, "best.threshold", "best.precision", "best.recall", "best.f1",
        mode.alias("mode"),
    )


def quantile_columns(share: float, name: str) -> Column:
    """Aggregate over counted points: exact quantile with linear interpolation."""
    total = F.first("n_pos") + F.first("n_neg")
    below = (F.col("n_pos") + F.col("n_neg")) - F.col("tp") - F.col("fp")
    position = F.lit(share) * (F.col("n_pos") + F.col("n_neg") - 1)
    low = F.max(F.when(below <= F.floor(position), F.col("threshold")))
    high = F.max(F.when(below <= F.ceil(position), F.col("threshold")))
    place = F.lit(share) * (total - 1)
    return (low + (high - low) * (place - F.floor(place))).alias(name)


def threshold_max_f1(
    predictions: DataFrame, alignment: str = "next", by: Sequence[str] = ()
) -> DataFrame:
    """Threshold of the highest F1; the median score if no F1 exists. Also gives the two
    fallback quantiles (0.5 and 0.8) of the scores."""
    points = with_rates(cumulative_counts(predictions, by))
    found = _grouped(points, by).agg(
        choice_column(None, alignment), quantile_columns(0.5, "q50"), quantile_columns(0.8, "q80")
    )
    return found.select(
        *by, F.coalesce("best.threshold", "q50").alias("threshold"), "best.f1", "q50", "q80"
    )
