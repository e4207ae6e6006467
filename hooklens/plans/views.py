"""Message, score and raw-mail views derived from the given tables.

Only the tables a query needs are joined: labels for `label`, `headers_raw` and `html`,
pages for `body` and what derives from it.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hooklens.functions.hashing import permille
from hooklens.functions.text import blank
from hooklens.functions.urls import first_url
from hooklens.lists import AUTHENTICATED_HEADERS, UNAUTHENTICATED_HEADERS
from hooklens.operators.synth import synthetic_headers, synthetic_html

# the same objects without blanks
AUTH_JSON, NONE_JSON = (
    json.dumps(json.loads(t), separators=(",", ":")) for t in (AUTHENTICATED_HEADERS, UNAUTHENTICATED_HEADERS)
)
BAD_JSON = "{bad"
ALL = ("id", "label", "subject", "body", "date", "source", "headers_raw", "html", "headers_json")
EXPERIMENT_NAMES = ("E0", "E1", "E2", "E3", "E4", "E5")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _url_part(key: Column, source: Column, page_url: Column) -> Column:
    draw, text = permille(key, "url"), key.cast("string")

    def below(limit: int, *parts) -> tuple[int, Column]:
        return limit, F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    steps = [
        below(200, ""),
        below(300, " https://bit.ly/", text),
        below(400, " https://l.facebook.com/l.php?u=http://x", text, ".com"),
        below(500, " http://login.", source, ".tk/verify//x"),
        below(600, " http://user@pay", text, ".com:8080/a"),
        below(700, " http://exämple", text, ".com/"),
        below(800, " http://a.", source, ".zip/1 http://a.", source, ".zip/2)"),
        below(900, " HTTP://Shop.Example.com/q?a=1 HTTP://Shop.Example.com/q?a=1"),
    ]
    part = F.when(draw < steps[0][0], steps[0][1])
    for limit, value in steps[1:]:
        part = part.when(draw < limit, value)
    return part.otherwise(F.concat(F.lit(" "), page_url))


def messages(
    spark: SparkSession, sf_dir: str, *columns: str, documents: DataFrame | None = None
) -> DataFrame:
    """The message view with the asked columns (all of them by default).

    `documents` may be a stream over the documents table instead of the table itself.
    """
    wanted = columns or ALL
    with_body = {"body", "headers_raw", "html"} & set(wanted)
    with_label = {"label", "headers_raw", "html"} & set(wanted)
    if documents is None:
        documents = table(spark, sf_dir, "documents")
    rows = documents.withColumn("id", F.col("doc_id"))
    key = F.col("id")
    if with_label:
        labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
        rows = rows.join(labels, "doc_id", "left").withColumn(
            "label", F.when(F.col("toxic") == 1, "phishing").when(F.col("toxic") == 0, "ham")
        )
    if with_body:
        pages = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("page_url"))
        n_pages = table(spark, sf_dir, "pages").select(F.count("*")).scalar()
        # every row gets a key, so no null key gathers the rows without a page URL
        rows = rows.withColumn("page_id", F.col("doc_id") % n_pages).join(pages, "page_id", "left")
        body = F.concat("text", _url_part(key, F.col("source"), F.col("page_url")))
        rows = rows.withColumn("body", body)
    if {"headers_raw", "html"} & set(wanted):
        rows = rows.withColumn("_url", first_url(blank("body")))
    day, minute = F.floor(F.col("id") / 1440), F.col("id") % 1440
    made = {
        "subject": lambda: F.split_part("text", F.lit("\n"), F.lit(1)),
        "date": lambda: F.concat(
            F.date_add(F.lit("2024-01-01").cast("date"), day.cast("int")).cast("string"),
            F.lit(" "), F.lpad(F.floor(minute / 60).cast("string"), 2, "0"),
            F.lit(":"), F.lpad((minute % 60).cast("string"), 2, "0"), F.lit(":00"),
        ),
        "headers_raw": lambda: F.when(
            permille(key, "nohdr") >= 100, synthetic_headers(key, F.col("label"), F.col("_url"))
        ),
        "html": lambda: synthetic_html(key, F.col("label"), F.col("_url")),
        "headers_json": lambda: F.when(permille(key, "json") < 400, AUTH_JSON)
        .when(permille(key, "json") < 600, NONE_JSON)
        .when(permille(key, "json") < 700, BAD_JSON),
    }
    return rows.select(*[made[c]().alias(c) if c in made else F.col(c) for c in wanted])


def labelled(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Messages that have a label."""
    return messages(spark, sf_dir, *columns).filter(F.col("label").isNotNull())


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction table of the labelled messages without a model: `id, y_true, score`."""
    rows = table(spark, sf_dir, "labels").join(
        table(spark, sf_dir, "documents").select("doc_id"), "doc_id", "left_semi"
    )
    labels = rows.filter(F.col("toxic").isNotNull())
    y = (F.col("toxic") == 1).cast("int")
    return labels.select(F.col("doc_id").alias("id"), y.alias("y_true")).withColumn(
        "score", _score("score", 0.35)
    )


def _score(salt: str, gain: float) -> Column:
    draw = permille(F.col("id"), salt) / F.lit(1000.0)
    return F.round(F.lit(0.6) * draw + F.lit(gain) * F.col("y_true"), 3)


def experiment_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score tables of six pretended experiments that separate the classes ever better."""
    base = scores(spark, sf_dir).select("id", "y_true")
    variants = F.array(
        *[
            F.struct(F.lit(e).alias("experiment"), _score(f"score{e}", gain).alias("score"))
            for e, gain in zip(EXPERIMENT_NAMES, GAINS)
        ]
    )
    return base.select("id", "y_true", F.inline(variants))


GAINS = (0.20, 0.25, 0.40, 0.30, 0.35, 0.10)


def raw_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw ham/spam mail table with its usual column names."""
    rows = labelled(spark, sf_dir, "id", "label", "subject", "body", "date")
    return rows.select(
        F.col("id").alias("Message ID"),
        F.when(F.col("id") % 7 != 0, F.col("subject")).alias("Subject"),
        F.col("body").alias("Message"),
        F.when(F.col("label") == "ham", "ham").otherwise("spam").alias("Spam/Ham"),
        # some dates are missing, and many messages share a day
        F.when(F.col("id") % 11 != 0, F.substring("date", 1, 10)).alias("Date"),
    )


def raw_phishing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw phishing table with other column names and no label."""
    rows = messages(spark, sf_dir, "id", "label", "subject", "body", "date")
    return rows.filter("label = 'phishing'").select(
        "id", F.col("subject").alias("Subject"), F.col("body").alias("Body"), F.col("date").alias("Date")
    )
