"""Robustness variants of labelled messages for stress-testing a classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hooklens import lists
from hooklens.functions.hashing import fraction, pick
from hooklens.functions.text import blank, label_number, strip
from hooklens.functions.urls import PATTERNS, first_url
from hooklens.operators.ranking import with_row_number


def redirect_body(body: Column) -> Column:
    """Every occurrence of the first URL behind a redirector; unchanged without a URL."""
    url = first_url(body, "strict")
    wrapped = F.replace(body, url, F.concat(F.lit(lists.REDIRECT_PREFIX), url))
    return F.coalesce(wrapped, body)


def strip_urls_body(body: Column) -> Column:
    return F.concat(F.regexp_replace(body, PATTERNS["strict"], ""), F.lit(lists.REPLY_REQUEST))


def newsletter_subject(key: Column, subject: Column) -> Column:
    headline = pick(lists.NEWSLETTER_HEADLINES, key, "news")
    return strip(F.concat(F.lit("["), headline, F.lit("] "), subject))


def newsletter_body(body: Column) -> Column:
    return F.concat(body, F.lit(lists.NEWSLETTER_FOOTER))


def marker_body(key: Column, body: Column) -> Column:
    return F.concat(body, F.lit(" "), pick(lists.MARKER_PHRASES, key, "ptbr"))


def variant_columns(key: Column, mode: Column) -> dict[str, Column]:
    """Subject, body and header JSON of one variant; a mode that does not fit the label
    only appends a neutral closing."""
    subject, body, y = blank("subject"), blank("body"), F.col("y")
    headers = F.col("headers_json")

    def fits(name: str, label: int) -> Column:
        return (mode == name) & (y == label)

    header_ok = fits("FP_headerok", 0)
    return {
        "subject": F.when(fits("FP_news", 0), newsletter_subject(key, subject))
        .when(header_ok, F.concat(F.lit(lists.URGENT_SUBJECT), subject))
        .otherwise(subject),
        "body": F.when(fits("FN_redirect", 1), redirect_body(body))
        .when(fits("FN_semurl", 1), strip_urls_body(body))
        .when(fits("FP_news", 0), newsletter_body(body))
        .when(fits("FP_ptbr", 0), marker_body(key, body))
        .when(header_ok, F.concat(body, F.lit(lists.URGENT_FOOTER)))
        .otherwise(F.concat(body, F.lit(lists.NEUTRAL_FOOTER))),
        "headers_json": F.when(header_ok, F.lit(lists.AUTHENTICATED_HEADERS)).otherwise(
            F.coalesce(headers, F.lit(lists.UNAUTHENTICATED_HEADERS))
        ),
    }


def with_variant_mode(messages: DataFrame, mode: str) -> DataFrame:
    """One mode applied to every message of a table with subject, body and headers_json."""
    staged = messages.withColumn("y", label_number(F.col("label")))
    return staged.withColumns(variant_columns(F.col("id"), F.lit(mode))).drop("y")


def expanded_with_variants(base: DataFrame, target_n: int) -> DataFrame:
    """Base rows plus variants of rows drawn with replacement, up to `target_n` rows.

    Base rows are numbered once; each draw picks a number, so the draw is an equi-join on
    a near-uniform key. New ids run from 0, base rows first.
    """
    columns = ["id", "label", "y", "subject", "body", "headers_json", "mode"]
    staged = base.withColumn("y", label_number(F.col("label")))
    if "headers_json" not in base.columns:
        staged = staged.withColumn("headers_json", F.lit(None).cast("string"))
    ranked = with_row_number(staged.withColumnRenamed("id", "_source"), [F.col("_source")], "id", 0)
    rows = ranked.agg(F.count("*").alias("n")).first()["n"]
    kept = ranked.withColumn("mode", F.lit(None).cast("string")).select(*columns)
    missing = max(target_n - rows, 0)
    if not rows or not missing:
        return kept
    number = F.col("number")
    draws = base.sparkSession.range(missing).select(
        F.col("id").alias("number"),
        F.floor(fraction(F.col("id"), "row") * F.lit(rows)).alias("drawn"),
    )
    drawn = ranked.join(draws, ranked["id"] == draws["drawn"]).withColumn(
        "mode", pick(lists.VARIANT_MODES, number, "mode")
    )
    variants = drawn.withColumns(variant_columns(number, F.col("mode"))).withColumn(
        "id", number + F.lit(rows)
    )
    return kept.unionByName(variants.select(*columns))
