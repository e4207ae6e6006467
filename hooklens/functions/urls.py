"""URL extraction, host forms and per-URL signals."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from hooklens import lists
from hooklens.functions.text import WHITE, bind, blank, has_non_ascii, message_text, strip

# Three URL patterns that end a URL at different characters.
PATTERNS = {
    "loose": rf"(?i)https?://[^{WHITE}]+",
    "rule": rf"(?i)https?://[^{WHITE}'\"<>]+",
    "strict": rf"(?i)https?://[^{WHITE})>\]}}\"']+",
}
SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*://"

NUMERIC_SIGNALS = ("len_url", "len_host", "len_path", "num_dots", "num_digits", "num_subdomains")
BOOLEAN_SIGNALS = ("has_at", "has_double_slash", "tld_suspect", "confusable")


def extract_urls(text: Column, pattern: str = "rule") -> Column:
    """Array of all URLs of a text in order, duplicates kept."""
    return F.regexp_extract_all(text, F.lit(PATTERNS[pattern]), F.lit(0))


def first_url(text: Column, pattern: str = "loose") -> Column:
    """First URL of a text, null when there is none."""
    return F.nullif(F.regexp_extract(text, PATTERNS[pattern], 0), F.lit(""))


def message_urls(given: Column | None = None) -> Column:
    """URLs of subject and body (or the given array), followed by those of the HTML part."""
    from_text = extract_urls(message_text())
    listed = from_text if given is None else F.coalesce(given, from_text)
    return F.concat(listed, extract_urls(blank("html")))


# --- host forms -----------------------------------------------------------------------


def raw_host(url: Column) -> Column:
    """Everything up to the first slash after a lower-case scheme; keeps user-info and port."""
    return F.lower(F.regexp_extract(url, r"^(?:https?://)?([^/]*)", 1))


def netloc(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, SCHEME + r"([^/?#]*)", 1))


def hostname(url: Column) -> Column:
    """Host without user-info, port and brackets."""
    host = F.regexp_extract(url, SCHEME + r"(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^:/?#@]*)", 1)
    return F.lower(F.translate(host, "[]", ""))


def with_scheme(url: Column) -> Column:
    return F.when(F.contains(url, F.lit("://")), url).otherwise(F.concat(F.lit("http://"), url))


def url_path(url: Column) -> Column:
    """Path without the parameters of its last segment."""
    path = F.regexp_extract(url, SCHEME + r"[^/?#]*([^?#]*)", 1)
    return F.regexp_replace(path, r";[^/]*$", "")


def last_label(host: Column) -> Column:
    """Last dot-separated label, empty for a host without a dot."""
    return F.regexp_extract(host, r"\.([^.]*)$", 1)


def host_starts_with(host: Column, names: Sequence[str]) -> Column:
    return _any(host.startswith(n) for n in names)


def host_ends_with(host: Column, names: Sequence[str]) -> Column:
    return _any(host.endswith(n) for n in names)


def host_contains(host: Column, names: Sequence[str]) -> Column:
    return _any(F.contains(host, F.lit(n)) for n in names)


def _any(tests) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


# --- signals ----------------------------------------------------------------------------


def mixed_script(host: Column) -> Column:
    """More than one writing system among the letters; all-ASCII hosts skip the test.

    A host of one system matches one alternative; a letter of no named system fits none.
    """
    single = "|".join(rf"[\P{{L}}\p{{Is{s}}}]*" for s in lists.SCRIPTS)
    return F.when(has_non_ascii(host), ~host.rlike(rf"\A(?:{single})\z")).otherwise(F.lit(False))


def url_signals(url: Column, suspect_tlds: Sequence[str] = lists.SUSPECT_TLDS) -> dict[str, Column]:
    """Ten lexical signals of one normalised URL."""
    full = with_scheme(url)
    host = hostname(full)
    path = url_path(full)
    dots = F.length(host) - F.length(F.translate(host, ".", ""))
    return {
        "len_url": F.length(url),
        "len_host": F.length(host),
        "len_path": F.length(path),
        "num_dots": F.length(url) - F.length(F.translate(url, ".", "")),
        "num_digits": F.length(url) - F.length(F.regexp_replace(url, r"\p{Nd}", "")),
        "num_subdomains": F.greatest(dots - 1, F.lit(0)),
        "has_at": F.contains(url, F.lit("@")),
        "has_double_slash": F.contains(path, F.lit("//")),
        "tld_suspect": last_label(host).isin(*suspect_tlds) if suspect_tlds else F.lit(False),
        "confusable": mixed_script(host),
    }


@F.pandas_udf(T.StringType())
def _nfkc(values: pd.Series) -> pd.Series:
    return values.map(lambda v: unicodedata.normalize("NFKC", v), na_action="ignore")


@F.pandas_udf(T.ArrayType(T.StringType()))
def _nfkc_all(values: pd.Series) -> pd.Series:
    return values.map(lambda vs: [unicodedata.normalize("NFKC", v) for v in vs], na_action="ignore")


def normalise_url(url: Column) -> Column:
    """Compatibility form of a URL. Spark has no built-in for it: only URLs with non-ASCII
    characters carry a value to the Arrow function, all others travel as nulls."""
    return F.coalesce(_nfkc(F.when(has_non_ascii(url), url)), url)


def normalise_urls(urls: Column) -> Column:
    """`normalise_url` over the URL array of a message."""
    foreign = F.when(has_non_ascii(F.array_join(urls, " ")), urls)
    return F.coalesce(_nfkc_all(foreign), urls)


# --- masking ------------------------------------------------------------------------------


def mask_domains(text: Column) -> Column:
    """In every URL, replace its network location, wherever it stands in that URL, by `***.` and its
    last two labels. Addresses inside a URL's path or query are not URLs of their own.

    A URL with an opening bracket in its location is not a valid one and stays, as does an empty location.
    """

    def hidden(url: Column, location: Column) -> Column:
        masked = F.concat(F.lit("***."), F.substring_index(location, ".", -2))
        usable = (location != "") & ~F.contains(location, F.lit("["))
        return F.when(usable, F.replace(url, location, masked)).otherwise(url)

    def one(url: Column) -> Column:
        return bind(F.regexp_extract(url, r"\A[^/]*//([^/?#]*)", 1), lambda location: hidden(url, location))

    found = F.transform(F.regexp_extract_all(text, F.lit(MASKED_URL), F.lit(0)), one)
    between = F.split(text, MASKED_URL, -1)
    parts = F.zip_with(between, found, lambda b, u: F.concat(b, F.coalesce(u, F.lit(""))))
    return F.when(F.contains(text, F.lit("://")), F.array_join(parts, "")).otherwise(text)


#: Fixed pattern of the URLs to mask.
MASKED_URL = rf"(?i)https?://[^{WHITE})>\]}}\"']+"


def short_text(limit: int = 220) -> Column:
    """One-line, domain-masked excerpt of a message."""
    text = strip(F.concat(strip(blank("subject")), F.lit(" "), strip(blank("body"))))
    masked = bind(F.regexp_replace(text, rf"[{WHITE}]+", " "), mask_domains)
    return bind(masked, lambda m: F.when(
        F.length(m) > limit, F.concat(F.substring(m, 1, limit), F.lit("…"))
    ).otherwise(m))
