"""Synthetic headers and HTML whose signals follow the label at set rates.

Every draw depends on the message id and a salt. Rates are in thousandths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hooklens import lists
from hooklens.functions.hashing import permille, pick
from hooklens.functions.text import blank
from hooklens.functions.urls import first_url


def _url_host(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:https?://)?([^/]*)", 1)


def synthetic_headers(key: Column, label: Column, url: Column) -> Column:
    """Raw headers; a label other than `phishing` counts as ham."""
    phishing = F.coalesce(label == "phishing", F.lit(False))

    def by_label(salt: str, ham_rate: int, phishing_rate: int) -> Column:
        return permille(key, salt) < F.when(phishing, phishing_rate).otherwise(ham_rate)

    spf = (
        F.when(phishing & (permille(key, "spf") < 600), "fail")
        .when(phishing & (permille(key, "spf_none") < 300), "none")
        .when(~phishing & (permille(key, "spf") < 100), "none")
        .otherwise("pass")
    )
    dkim = F.when(by_label("dkim", 50, 500), "fail").otherwise("pass")
    dmarc = (
        F.when(by_label("dmarc", 50, 500), "fail")
        .when(phishing & (permille(key, "dmarc_none") < 300), "none")
        .otherwise("pass")
    )
    sender = pick(lists.LEGIT_DOMAINS, key, "from")
    # a phishing message with a URL answers to the last two labels of the URL's host
    url_domain = F.regexp_extract(_url_host(url), r"([^.]*\.[^.]*)$", 1)
    aligned = phishing & (F.coalesce(url_domain, F.lit("")) != "")

    def reply(salt: str, phishing_rate: int) -> Column:
        attacker = pick(lists.ATTACKER_DOMAINS, key, f"{salt}_domain")
        swapped = F.when(by_label(salt, 50, phishing_rate), attacker).otherwise(sender)
        return F.when(aligned, url_domain).otherwise(swapped)

    return F.concat(
        F.lit("From: alerts@"), sender,
        F.lit("\nReply-To: support@"), reply("reply", 600),
        F.lit("\nReturn-Path: bounce@"), reply("return", 500),
        F.lit("\nAuthentication-Results: spf="), spf, F.lit(" dkim="), dkim,
        F.lit(" dmarc="), dmarc, F.lit("\n"),
    )


def synthetic_html(key: Column, label: Column, url: Column) -> Column:
    """One-anchor HTML; empty without a URL."""
    rate = F.when(label == "phishing", 700).otherwise(100)
    text = F.when(
        permille(key, "mis") < rate, pick(lists.GENERIC_LINK_TEXTS, key, "opt")
    ).otherwise(F.concat(F.lit("Click here to visit "), _url_host(url)))
    page = F.concat(
        F.lit('<html><body><p>Notification:</p><a href="'), url, F.lit('">'), text,
        F.lit("</a></body></html>"),
    )
    return F.coalesce(page, F.lit(""))


def with_synthetic_modalities(messages: DataFrame) -> DataFrame:
    """Set `headers_raw` and `html` from id, label and the first URL of the body."""
    staged = messages.withColumn("_url", first_url(blank("body")))
    key, label, url = F.col("id"), F.col("label"), F.col("_url")
    return staged.withColumns(
        {
            "headers_raw": synthetic_headers(key, label, url),
            "html": synthetic_html(key, label, url),
        }
    ).drop("_url")
