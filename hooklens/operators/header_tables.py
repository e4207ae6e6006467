"""Header and link tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from hooklens.functions import headers as H, links as L
from hooklens.functions.text import unnest

DOMAIN_FIELDS = {"from_domains": "from", "reply_domains": "reply-to", "return_domains": "return-path"}
AUTH_FLAGS = ("auth_spf_fail", "auth_dkim_fail", "auth_dmarc_fail", "auth_any_none")


def with_header_signals(messages: DataFrame) -> DataFrame:
    """Add address domains, authentication flags and the two mismatch flags."""
    block = messages.withColumn("_block", H.unfolded(F.col("headers_raw")))
    domains = {n: H.address_domains(F.col("_block"), f) for n, f in DOMAIN_FIELDS.items()}
    staged = block.withColumns({**domains, "_auth": H.auth_results(F.col("_block"))})
    return staged.withColumns(
        {
            **H.auth_flags(F.col("_auth")),
            "from_reply_mismatch": H.domains_differ(F.col("from_domains"), F.col("reply_domains")),
            "from_return_mismatch": H.domains_differ(F.col("from_domains"), F.col("return_domains")),
        }
    ).drop("_block", "_auth")


def header_features(messages: DataFrame, keep: Sequence[str] = ("id",)) -> DataFrame:
    """Header signals as numbers: three domain counts, two mismatches, four flags."""
    signals = with_header_signals(messages)
    return signals.select(
        *keep,
        *[F.size(n).cast("double").alias(f"n_{n}") for n in DOMAIN_FIELDS],
        *[
            F.col(n).cast("int").cast("double").alias(n)
            for n in ("from_reply_mismatch", "from_return_mismatch", *AUTH_FLAGS)
        ],
    )


def link_table(pages: DataFrame) -> DataFrame:
    """One row per anchor of a table `id, html`: position, text, target, host, mismatch."""
    exploded = unnest(pages, ["id"], L.anchors(F.col("html")), "_a", "pos")
    parts = exploded.select(
        "id", "pos", L.anchor_text(F.col("_a")).alias("text"), L.anchor_href(F.col("_a")).alias("href")
    )
    hosts = parts.withColumn("host", L.link_host(F.col("href")))
    return hosts.withColumn("mismatch", L.link_mismatch(F.col("text"), F.col("host")))


def anchor_mismatches(messages: DataFrame) -> DataFrame:
    """Per message: does some link show a text that hides its host."""
    return messages.select("id", L.anchor_mismatch(F.col("html")).alias("anchor_mismatch"))
