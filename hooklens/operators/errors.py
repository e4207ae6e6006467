"""Error typology of predictions and anonymised examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from hooklens import lists
from hooklens.functions.headers import json_auth_ok
from hooklens.functions.urls import short_text

EXAMPLES_PER_TYPE = 3
NEAR_MISSES = 6
NEAR_MARGIN = 0.05


def error_type() -> Column:
    """Error class of a row; the first fitting explanation wins."""
    false_positive = (F.col("y_true") == 0) & (F.col("y_pred") == 1)
    false_negative = (F.col("y_true") == 1) & (F.col("y_pred") == 0)
    header_ok = ~F.col("headers_missing") & F.col("hdr_auth_ok")
    redirected = F.col("redirector_url") | F.col("shortened_url")
    return (
        F.when(false_positive & F.col("ptbr_likely"), "FP_ptbr")
        .when(false_positive & header_ok, "FP_header_ok")
        .when(false_positive, "FP_newsletter")
        .when(false_negative & F.col("no_url"), "FN_sem_url")
        .when(false_negative & redirected, "FN_redirect_chain")
        .when(false_negative, "FN_compromised_domain")
        .otherwise("OK")
    )


def error_typology(
    predictions: DataFrame, flags: DataFrame, messages: DataFrame, threshold: float
) -> DataFrame:
    """Predictions with flags and error type. Only the header flag of a message takes part
    in the joins, its text does not."""
    if "headers_json" in messages.columns:
        auth = json_auth_ok(F.col("headers_json"))
    else:
        auth = F.lit(False)
    headers = messages.select("id", auth.alias("hdr_auth_ok"))
    joined = predictions.join(flags.drop("label"), "id").join(headers, "id")
    judged = joined.withColumn("y_pred", (F.col("score") >= threshold).cast("int"))
    return judged.withColumn("tipo", error_type())


def error_counts(typed: DataFrame) -> DataFrame:
    return typed.groupBy("tipo").agg(F.count("id").alias("n"))


def near_misses(typed: DataFrame, threshold: float, margin: float = NEAR_MARGIN) -> DataFrame:
    """Rows whose score lies close to the threshold."""
    close = F.abs(F.col("score") - threshold) <= margin
    kind = F.when(F.col("y_true") == 1, "FN_quase").otherwise("FP_quase")
    return typed.filter(close).withColumn("tipo", kind)


def error_examples(typed: DataFrame, messages: DataFrame, threshold: float) -> DataFrame:
    """First three examples per error type; without any error, the first six near misses.

    The few chosen ids are known before the text is touched, so the wide message table is
    read once, filtered by a broadcast of at most 18 rows.
    """
    errors = typed.filter(F.col("tipo") != "OK")
    place = F.row_number().over(W.partitionBy("tipo").orderBy("id"))
    real = errors.withColumn("_place", place).filter(F.col("_place") <= EXAMPLES_PER_TYPE)
    notes = typed.sparkSession.createDataFrame(
        list(lists.ERROR_NOTES), "tipo string, missing_signal string, mitigation string"
    )
    shown = real.join(F.broadcast(notes), "tipo").select(
        "id", "tipo", "missing_signal", "mitigation"
    )
    any_error = errors.select(F.lit(1)).limit(1).agg(F.count("*")).scalar()
    near = (
        near_misses(typed, threshold)
        .filter(any_error == 0)
        .orderBy("id")
        .limit(NEAR_MISSES)
    )
    url_signal = F.col("redirector_url") | F.col("shortened_url") | F.col("no_url")
    header_signal = ~F.col("headers_missing") & F.col("hdr_auth_ok")
    almost = near.select(
        "id",
        "tipo",
        F.when(url_signal, lists.NEAR_MISS_URL_SIGNAL)
        .when(header_signal, lists.NEAR_MISS_HEADER_SIGNAL)
        .otherwise(lists.NEAR_MISS_OTHER_SIGNAL)
        .alias("missing_signal"),
        F.when(F.col("tipo").startswith("FN_"), lists.NEAR_MISS_FN_MITIGATION)
        .otherwise(lists.NEAR_MISS_FP_MITIGATION)
        .alias("mitigation"),
    )
    chosen = shown.unionByName(almost)
    texts = messages.select("id", "subject", "body").join(F.broadcast(chosen), "id")
    return texts.select("id", "tipo", short_text().alias("example"), "missing_signal", "mitigation")
