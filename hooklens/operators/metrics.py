"""Class counts, confusion counts, reports, robustness scenarios and ablation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from hooklens import lists
from hooklens.operators.curves import (
    RECALL_FLOOR, area_columns, choice_column, cumulative_counts, with_rates,
)
from hooklens.operators.split import TEST_SIZE
from hooklens.schema import LABELS


def ratio(part: Column, whole: Column) -> Column:
    """Quotient as double, 0 on division by zero."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def class_distribution(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weight n / (classes * n_class) per class."""
    counts = class_distribution(df, label)
    totals = counts.agg(F.sum("n").alias("total"), F.count("*").alias("classes"))
    weight = totals.select(F.col("total") / F.col("classes")).scalar() / F.col("n")
    return counts.withColumn("weight", weight)


def confusion_columns(y: Column, predicted: Column) -> list[Column]:
    return [
        F.count_if((y == 1) & predicted).alias("tp"),
        F.count_if((y == 0) & predicted).alias("fp"),
        F.count_if((y == 0) & ~predicted).alias("tn"),
        F.count_if((y == 1) & ~predicted).alias("fn"),
    ]


def rates_of_counts(counts: DataFrame) -> DataFrame:
    """Add precision, recall and F1 of the positive class to confusion counts."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns(
        {
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
            "f1": ratio(2 * tp, 2 * tp + fp + fn),
        }
    )


def confusion(predictions: DataFrame, threshold: float, by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts and rates at a fixed threshold, one pass."""
    grouped = predictions.groupBy(*by) if by else predictions.groupBy()
    return rates_of_counts(
        grouped.agg(*confusion_columns(F.col("y_true"), F.col("score") >= threshold))
    )


def class_report(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per-class, macro, weighted and accuracy rows from confusion counts."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))

    def row(name: str, hit: Column, wrong: Column, missed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            ratio(hit, hit + wrong).alias("precision"),
            ratio(hit, hit + missed).alias("recall"),
            ratio(2 * hit, 2 * hit + wrong + missed).alias("f1"),
            (hit + missed).cast("bigint").alias("support"),
        )

    staged = counts.select(
        *by, row("ham", tn, fn, fp).alias("_h"), row("phishing", tp, fp, fn).alias("_p"),
        ratio(tp + tn, tp + fp + tn + fn).alias("_accuracy"), (tp + fp + tn + fn).alias("_n"),
    )
    fields = ("precision", "recall", "f1")
    h, p = F.col("_h"), F.col("_p")

    def average(name: str, combine) -> Column:
        return F.struct(
            F.lit(name).alias("class"), *[combine(f).alias(f) for f in fields],
            F.col("_n").cast("bigint").alias("support"),
        )

    rows = F.array(
        h,
        p,
        average("accuracy", lambda _f: F.col("_accuracy")),
        average("macro avg", lambda f: (h[f] + p[f]) / 2),
        average(
            "weighted avg",
            lambda f: ratio(h[f] * h["support"] + p[f] * p["support"], F.col("_n")),
        ),
    )
    return staged.select(*by, F.inline(rows))


def metrics_summary(
    predictions: DataFrame,
    by: Sequence[str] = ("experiment",),
    recall_floor: float = RECALL_FLOOR,
    alignment: str = "same",
) -> DataFrame:
    """One flat row per experiment: chosen threshold, rates, areas and counts.

    Everything comes from one reduction of the scores to their distinct values.
    """
    points = with_rates(cumulative_counts(predictions, by))
    found = points.groupBy(*by).agg(choice_column(recall_floor, alignment), *area_columns())
    best = F.col("best")
    return found.select(
        *by,
        best["threshold"].alias("threshold"),
        best["precision"].alias("precision_plus"),
        best["recall"].alias("recall_plus"),
        best["f1"].alias("f1_plus"),
        "pr_auc",
        "roc_auc",
        best["tp"].alias("tp"),
        best["fp"].alias("fp"),
        (best["n_neg"] - best["fp"]).alias("tn"),
        (best["n_pos"] - best["tp"]).alias("fn"),
        (best["n_pos"] + best["n_neg"]).alias("n_test"),
        F.when(best["reaches"], "recall_floor").otherwise("maxF1_fallback").alias("mode"),
    )


def with_training_counts(
    summary: DataFrame, split: DataFrame, recall_floor: float = RECALL_FLOOR, test_size: float = TEST_SIZE,
    by: Sequence[str] = (),
) -> DataFrame:
    """Summary rows with `n_train, test_size, recall_floor` and the class counts of both parts.

    `split` is the split table (`label, split`) all experiments share: four counts, one row. With `by` it has
    those columns, too, and each experiment gets the counts of its own rows.
    """
    counts = split.groupBy(*by).agg(*[
        F.count_if((F.col("split") == part) & (F.col("label") == label)).alias(f"{part}_{label}")
        for part in ("train", "test") for label in LABELS
    ])
    n_train = sum(F.col(f"train_{label}") for label in LABELS)
    if by:
        own = counts.withColumns({"n_train": n_train, "test_size": F.lit(test_size), "recall_floor": F.lit(recall_floor)})
        return summary.join(own, list(by))
    record = counts.select(F.struct(n_train.alias("n_train"), *counts.columns)).scalar()
    settings = {"test_size": F.lit(test_size), "recall_floor": F.lit(recall_floor), "_counts": record}
    return summary.withColumns(settings).select("*", "_counts.*").drop("_counts")


def ablation(summary: DataFrame, base: str = "E0") -> DataFrame:
    """Differences of every experiment to the base one, rounded to four digits.

    The base is one row; it reaches the others as scalar values, not as a join.
    """
    names = ("precision_plus", "recall_plus", "f1_plus", "pr_auc")
    reference = summary.filter(F.col("experiment") == base)

    def of_base(name: str) -> Column:
        return reference.select(name).scalar()

    others = summary.filter(F.col("experiment") != base)
    note = F.format_string(
        f"Limiar %s=%.4f; {base}=%.4f", "experiment", "threshold", of_base("threshold")
    )
    return others.select(
        F.concat("experiment", F.lit(f" − {base}")).alias("comparison"),
        *[F.round(F.col(n) - of_base(n), 4).alias(f"delta_{n}") for n in names],
        note.alias("notes"),
    )


def robustness(predictions: DataFrame, flags: DataFrame, threshold: float) -> DataFrame:
    """F1, precision, recall and size for each of the six flag scenarios.

    One join and one pass: every scenario is a set of conditional counts, and the single
    result row is then turned into one row per scenario. An empty scenario gives "NA".
    """
    names = [flag for _, flag in lists.SCENARIOS]
    joined = predictions.join(flags.select("id", *names), "id")
    y, predicted = F.col("y_true"), F.col("score") >= threshold
    counts = joined.agg(
        *[
            F.struct(
                F.count_if(F.col(f)).alias("n"),
                F.count_if(F.col(f) & (y == 1) & predicted).alias("tp"),
                F.count_if(F.col(f) & (y == 0) & predicted).alias("fp"),
                F.count_if(F.col(f) & (y == 1) & ~predicted).alias("fn"),
            ).alias(f)
            for f in names
        ]
    )
    rows = F.array(
        *[
            F.struct(F.lit(title).alias("scenario"), F.lit(f).alias("flag"), F.col(f).alias("c"))
            for title, f in lists.SCENARIOS
        ]
    )
    listed = counts.select(F.inline(rows)).select("scenario", "flag", "c.*")
    rated = rates_of_counts(listed)
    empty = F.col("n") == 0
    number = F.format_string("N=%d; Recall+=%.4f; Precision+=%.4f; t=%.4f", "n", "recall",
                             "precision", F.lit(float(threshold)))
    return rated.select(
        "scenario",
        F.concat("flag", F.lit(" == True")).alias("description"),
        F.lit("F1+").alias("metric"),
        F.when(empty, "NA").otherwise(F.round("f1", 4).cast("string")).alias("value"),
        F.when(empty, "N=0").otherwise(number).alias("notes"),
    )
