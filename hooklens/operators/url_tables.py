"""URL-grain and message-grain URL tables. None of them shuffles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from hooklens import lists
from hooklens.functions import urls as U
from hooklens.functions.text import message_text, strip, unnest


def url_table(
    messages: DataFrame, pattern: str = "rule", with_html: bool = True, given: str | None = None
) -> DataFrame:
    """One row per message and URL (`id, pos, url`), duplicates kept.

    A JSON array column `given` replaces the extraction from subject and body where set.
    """
    if with_html:
        listed = F.from_json(given, "array<string>") if given else None
        urls = U.message_urls(listed) if pattern == "rule" else _all_urls(pattern, listed)
    else:
        urls = U.extract_urls(message_text(), pattern)
    return unnest(messages, ["id"], urls, "url", "pos")


def _all_urls(pattern: str, given: Column | None) -> Column:
    text = U.extract_urls(message_text(), pattern)
    listed = text if given is None else F.coalesce(given, text)
    return F.concat(listed, U.extract_urls(F.coalesce("html", F.lit("")), pattern))


def distinct_urls(messages: DataFrame) -> DataFrame:
    """One row per message and different URL, made inside the row (no shuffle)."""
    return unnest(messages, ["id"], F.array_distinct(U.message_urls()), "url")


def url_hosts(urls: DataFrame) -> DataFrame:
    """Add the three host forms, path and last label to a URL table."""
    full = U.with_scheme(F.col("url"))
    return urls.withColumns(
        {
            "raw_host": U.raw_host(F.col("url")),
            "hostname": U.hostname(full),
            "netloc": U.netloc(F.col("url")),
            "path": U.url_path(full),
        }
    ).withColumns(
        {"tld": U.last_label(F.col("raw_host")), "host_non_ascii": U.has_non_ascii(F.col("raw_host"))}
    )


def normalised_urls(urls: DataFrame) -> DataFrame:
    """Add the compatibility-normalised form of each URL."""
    return urls.withColumn("url_nfkc", U.normalise_url(strip(F.col("url"))))


def url_signals(
    urls: DataFrame, suspect_tlds: Sequence[str] = lists.SUSPECT_TLDS
) -> DataFrame:
    """URL table with the ten lexical signals of every normalised URL."""
    staged = normalised_urls(urls)
    signals = U.url_signals(F.col("url_nfkc"), suspect_tlds)
    return staged.select(*urls.columns, *[c.alias(n) for n, c in signals.items()])


def _mean(records: Column, field: str) -> Column:
    total = F.aggregate(records, F.lit(0.0), lambda acc, r: acc + r[field])
    return F.coalesce(F.try_divide(total, F.size(records)), F.lit(0.0))


def any_record(records: Column, field: str) -> Column:
    """Does a boolean field hold in some record."""
    return F.exists(records, lambda r: r[field])


def message_url_features(
    messages: DataFrame, suspect_tlds: Sequence[str] = lists.SUSPECT_TLDS, keep: Sequence[str] | None = None
) -> DataFrame:
    """Per message: mean of the numeric and any of the boolean URL signals; zeros without URL.

    The URLs of a message sit in its own row, so they are folded there instead of being
    exploded and grouped again, which would shuffle every message. With `keep` only those columns
    stay: the texts then end with the extraction and do not go on to the normalisation.
    """
    kept = messages.withColumn("_urls", U.extract_urls(message_text(), "loose"))
    if keep is not None:
        kept = kept.select(*keep, "_urls")
    normal = kept.withColumn("_urls", U.normalise_urls(F.col("_urls")))
    records = normal.withColumn(
        "_records",
        F.transform(
            "_urls",
            lambda u: F.struct(*[c.alias(n) for n, c in U.url_signals(u, suspect_tlds).items()]),
        ),
    )
    features = {n: _mean(F.col("_records"), n) for n in U.NUMERIC_SIGNALS}
    features |= {n: any_record(F.col("_records"), n) for n in U.BOOLEAN_SIGNALS}
    return records.withColumns(features).drop("_urls", "_records")


def match_hosts(hosts: DataFrame, entries: DataFrame, kind: str) -> DataFrame:
    """Match a table `host` against a table `entry` by prefix, suffix, part or equality.

    Every host yields its substrings of the lengths that occur among the entries, which
    turns the comparison into an equi-join: lists of any size work, hash-partitioned or
    broadcast as Spark finds fit. Give distinct hosts, so that a frequent host counts once.
    The result has one row per matching host and entry.
    """
    host = F.col("host")
    if kind == "equal":
        return hosts.join(entries.select(F.col("entry")).distinct(), host == F.col("entry"))
    if kind == "contains":
        return _containing(hosts, entries.select("entry").distinct())
    # one row of distinct lengths, which stays in the plan; an entry may be as long as it likes
    lengths = entries.select(F.sort_array(F.collect_set(F.length("entry")))).scalar()
    columns = hosts.columns
    hosts = hosts.withColumn("_lengths", lengths)
    usable = F.filter("_lengths", lambda n: n <= F.length(host))
    if kind == "prefix":
        parts = F.transform(usable, lambda n: F.substring(host, F.lit(1), n))
    elif kind == "suffix":
        parts = F.transform(usable, lambda n: F.substring(host, F.length(host) - n + 1, n))
    else:
        raise ValueError(f"unknown match kind {kind!r}")
    candidates = unnest(hosts, columns, parts, "entry")
    return candidates.join(entries.select("entry").distinct(), "entry")


#: Length of the pieces that hosts and entries are compared by.
GRAM = 4


def _windows(text: Column, size: Column | int) -> Column:
    """All pieces of a length, each once; none of a shorter text."""
    size = F.lit(size) if isinstance(size, int) else size
    places = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1))
    return F.array_distinct(F.transform(F.coalesce(places, F.array().cast("array<int>")), lambda i: F.substring(text, i, size)))


def _containing(hosts: DataFrame, entries: DataFrame) -> DataFrame:
    """Hosts with the entries they contain.

    Every entry is filed under one of its pieces of GRAM characters, the one that the fewest entries have. A host
    looks up its own pieces, of which it has no more than characters, and checks the entries it finds. Entries
    shorter than a piece are looked up as they are.
    """
    size = F.length("entry")
    pieces = unnest(entries.filter(size >= GRAM), ["entry"], _windows(F.col("entry"), GRAM), "_g")
    shared = pieces.groupBy("_g").agg(F.count("*").alias("_n"))
    filed = pieces.join(shared, "_g").groupBy("entry").agg(F.min(F.struct("_n", "_g"))["_g"].alias("_g"))
    columns = hosts.columns
    asked = unnest(hosts, columns, _windows(F.col("host"), GRAM), "_g")
    found = asked.join(filed, "_g").filter(F.contains("host", "entry")).select(*columns, "entry")
    short = F.concat(*[_windows(F.col("host"), n) for n in range(1, GRAM)])
    by_itself = unnest(hosts, columns, short, "entry").join(entries.filter(size < GRAM), "entry")
    return found.unionByName(by_itself.select(*columns, "entry"))
