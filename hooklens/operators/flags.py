"""Robustness flags of messages, in two profiles that differ in lists and match kinds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hooklens import lists
from hooklens.functions import headers as H, urls as U
from hooklens.functions.text import contains_any, has_non_ascii, message_text

FLAGS = (
    "unicode_homoglyph", "shortened_url", "redirector_url", "ptbr_likely", "no_url",
    "headers_missing",
)


def robustness_flags(messages: DataFrame, profile: str = "prefix") -> DataFrame:
    """`id` and the flags (`has_url` too in the suffix profile, `label` in the prefix one).

    `suffix` matches network locations by ending or equality and reads header JSON;
    `prefix` matches raw hosts by beginning or part and reads raw headers. All flags are
    computed inside the row.
    """
    if profile == "suffix":
        pattern, host = "strict", U.netloc
        short = lambda h: U.host_ends_with(h, lists.SUFFIX_SHORTENERS)
        redirect = lambda h: h.isin(*lists.SUFFIX_REDIRECTORS)
        markers, header, test = lists.SUFFIX_MARKERS, "headers_json", H.json_headers_missing
    elif profile == "prefix":
        pattern, host = "loose", U.raw_host
        short = lambda h: U.host_starts_with(h, lists.PREFIX_SHORTENERS)
        redirect = lambda h: U.host_contains(h, lists.PREFIX_REDIRECTORS)
        markers, header, test = lists.PREFIX_MARKERS, "headers_raw", H.raw_headers_missing
    else:
        raise ValueError(f"unknown profile {profile!r}")
    missing = test(F.col(header)) if header in messages.columns else F.lit(True)
    text = messages.withColumn("_text", message_text())
    staged = text.withColumns(
        {
            "_hosts": F.transform(U.extract_urls(F.col("_text"), pattern), host),
            "_lower": F.lower("_text"),
            "headers_missing": missing,
        }
    )
    flagged = staged.withColumns(
        {
            "has_url": F.size("_hosts") > 0,
            "unicode_homoglyph": has_non_ascii(F.col("_text")),
            "shortened_url": F.exists("_hosts", short),
            "redirector_url": F.exists("_hosts", redirect),
            "ptbr_likely": contains_any(F.col("_lower"), markers),
            "no_url": F.size("_hosts") == 0,
        }
    )
    if profile == "suffix":
        return flagged.select("id", "has_url", *FLAGS)
    return flagged.select("id", *(["label"] if "label" in messages.columns else []), *FLAGS)


def flag_totals(flags: DataFrame) -> DataFrame:
    """Number of messages per flag, from one pass."""
    counted = flags.agg(*[F.count_if(f).alias(f) for f in FLAGS])
    return counted.unpivot([], list(FLAGS), "flag", "n")
