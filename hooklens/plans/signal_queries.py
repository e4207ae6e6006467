"""URL, header, link and flag tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from hooklens import lists
from hooklens.functions.urls import BOOLEAN_SIGNALS, NUMERIC_SIGNALS, mask_domains, short_text
from hooklens.operators import flags as FL, header_tables as HT, url_tables as UT
from hooklens.plans import sql, views


def _messages(spark: SparkSession, sf: str) -> DataFrame:
    return views.messages(spark, sf, "id", "subject", "body", "html")


def _urls(spark: SparkSession, sf: str) -> DataFrame:
    return UT.url_table(_messages(spark, sf))


def _wide_ints(df: DataFrame) -> DataFrame:
    return df.select(
        *[F.col(n).cast("bigint").alias(n) if t == "int" else F.col(n) for n, t in df.dtypes]
    )


def url_table(spark: SparkSession, sf: str) -> DataFrame:
    return _wide_ints(_urls(spark, sf))


def url_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return UT.distinct_urls(_messages(spark, sf))


def url_hosts(spark: SparkSession, sf: str) -> DataFrame:
    return _wide_ints(UT.url_hosts(_urls(spark, sf)))


def url_signals(spark: SparkSession, sf: str) -> DataFrame:
    return _wide_ints(UT.url_signals(_urls(spark, sf)))


#: A URL that normalisation changes, and what it becomes: full-width letters, a ligature, a circled digit, combining
#: pairs in either order, a Hangul syllable of three letters, a unit, a compatibility ideograph, a no-break space.
HARD_URLS = (
    ("http://\uff42\uff41\uff4e\uff4b{id}.com/\uff01", "http://bank{id}.com/!"),
    ("http://\ufb01n{id}.com/\u2460", "http://fin{id}.com/1"),
    ("http://cafe\u0301{id}.com/e\u0323\u0302\u0065\u0302\u0323", "http://caf\u00e9{id}.com/\u1ec7\u1ec7"),
    ("http://\u1112\u1161\u11ab{id}.kr/\u3392", "http://\ud55c{id}.kr/MHz"),
    ("http://\uf900{id}.com/\u00a0\u2126", "http://\u8c48{id}.com/ \u03a9"),
    ("http://ex\u00e4mple{id}.com/", "http://ex\u00e4mple{id}.com/"),
    ("http://\ufdfa{id}.com", "http://\u0635\u0644\u0649 \u0627\u0644\u0644\u0647 \u0639\u0644\u064a\u0647 \u0648\u0633\u0644\u0645{id}.com"),
)


def url_nfkc(spark: SparkSession, sf: str) -> DataFrame:
    """URLs of the messages, and one of each message that normalisation changes, as a message without position."""
    hard = F.get(F.array(*[F.lit(u) for u, _ in HARD_URLS]), (F.col("id") % len(HARD_URLS)).cast("int"))
    made = views.messages(spark, sf, "id").select(
        "id", F.lit(-1).alias("pos"), F.replace(hard, F.lit("{id}"), F.col("id").cast("string")).alias("url")
    )
    found = UT.normalised_urls(_urls(spark, sf).unionByName(made))
    return _wide_ints(found).withColumn("changed", F.col("url") != F.col("url_nfkc"))


def url_features(spark: SparkSession, sf: str) -> DataFrame:
    made = UT.message_url_features(views.messages(spark, sf, "id", "subject", "body"))
    return made.select(
        "id", *[F.round(n, 6).alias(n) for n in NUMERIC_SIGNALS], *BOOLEAN_SIGNALS
    )


def list_join(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct URL hosts against list tables in all four match kinds."""
    hosted = UT.url_hosts(_urls(spark, sf))
    hosts = hosted.groupBy(F.col("raw_host").alias("host")).agg(F.count("*").alias("n_urls"))
    pages = views.table(spark, sf, "pages").select(F.regexp_extract("url", r"^[a-z]+://([^/]*)", 1).alias("h"))
    endings = pages.select(F.regexp_extract("h", r"([^.]*\.[^.]*)$", 1).alias("entry"))

    def fixed(values: tuple[str, ...]) -> DataFrame:
        return spark.createDataFrame([(v,) for v in values], "entry string")

    kinds = {
        "prefix": fixed(lists.PREFIX_SHORTENERS),
        "contains": fixed(lists.PREFIX_REDIRECTORS),
        "suffix": endings,
        "equal": fixed(lists.SUFFIX_REDIRECTORS),
    }
    parts = [
        UT.match_hosts(hosts, entries, kind).select(F.lit(kind).alias("kind"), "host", "entry", "n_urls")
        for kind, entries in kinds.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _headers(spark: SparkSession, sf: str) -> DataFrame:
    return HT.with_header_signals(views.messages(spark, sf, "id", "headers_raw"))


def header_domains(spark: SparkSession, sf: str) -> DataFrame:
    return _headers(spark, sf).select(
        "id", *[F.array_join(n, ",").alias(n) for n in HT.DOMAIN_FIELDS]
    )


def auth_flags(spark: SparkSession, sf: str) -> DataFrame:
    return _headers(spark, sf).select("id", *HT.AUTH_FLAGS)


def header_mismatch(spark: SparkSession, sf: str) -> DataFrame:
    return _headers(spark, sf).select("id", "from_reply_mismatch", "from_return_mismatch")


def header_features(spark: SparkSession, sf: str) -> DataFrame:
    return HT.header_features(views.messages(spark, sf, "id", "headers_raw"))


#: HTML with one anchor, and its text and target as a parser sees them; `{id}` is the message's id.
HARD_LINKS = (
    ('<a title="a>b" href="http://evil{id}.com/x">evil.com</a>', "evil.com", "http://evil{id}.com/x"),
    ("<a href='http://b{id}.com' title='x href=y>'>b{id}&#00000046;com</a>", "b{id}.com", "http://b{id}.com"),
    ("<A HREF=http://c{id}.com/&#x0000002e;>C</A>", "c", "http://c{id}.com/."),
    ('<a href="http://d.com/?a={id}&copy=2&lt;&copy">&copy2020 d</a>', "©2020 d", "http://d.com/?a={id}&copy=2<©"),
    ('<a href="http://e{id}.com">e&#150;f &#x80;&#0000000000000065;</a>', "e–f €a", "http://e{id}.com"),
    ('<a title="href=http://no.com" data-href="http://no.com" href="http://f{id}.com">1 < 2 &lt;b&gt;</a>',
     "1 < 2 <b>", "http://f{id}.com"),
    ('<a href="http://g{id}.com"><img alt="x > y">&notit; &amp;amp;</a>', "¬it; &amp;", "http://g{id}.com"),
    ('<a href="http://h{id}.com" href="http://i.com">&#xD800;&#1114112;&#0;&#99999999999999999999;</a>',
     "\ufffd\ufffd\ufffd\ufffd", "http://h{id}.com"),
    ('<a href = "mailto:{id}@y.z" >&nbsp;mail&NonExisting; & &; &#; &#x;</a>', "mail&nonexisting; & &; &#; &#x;", "mailto:{id}@y.z"),
    ("<a title=it's href=http://j{id}.com>j&AMP &NotEqualTilde;</a>", "j& \u2242\u0338", "http://j{id}.com"),
)


def link_table(spark: SparkSession, sf: str) -> DataFrame:
    """Anchors of the message HTML and of the web pages, and of HTML that only a parser reads right."""
    mail = views.messages(spark, sf, "id", "html").withColumn("origin", F.lit("message"))
    pages = views.table(spark, sf, "pages").select(F.col("page_id").alias("id"), "html")
    both = mail.unionByName(pages.withColumn("origin", F.lit("page")))
    kinds = F.array(*[F.lit(html) for html, _, _ in HARD_LINKS])
    hard = F.replace(F.get(kinds, (F.col("id") % len(HARD_LINKS)).cast("int")), F.lit("{id}"), F.col("id").cast("string"))
    both = both.unionByName(views.messages(spark, sf, "id").select("id", hard.alias("html"), F.lit("hard").alias("origin")))
    both = both.withColumn("id", F.concat("origin", F.lit(":"), "id"))
    # HTML is dealt out before it is parsed: a file of one row group is read by one task, however large it is
    links = HT.link_table(both.select("id", "html").repartition("id", "html"))
    return _wide_ints(links)


def anchor_mismatch(spark: SparkSession, sf: str) -> DataFrame:
    return HT.anchor_mismatches(views.messages(spark, sf, "id", "html"))


def flags_suffix(spark: SparkSession, sf: str) -> DataFrame:
    return FL.robustness_flags(views.messages(spark, sf, "id", "subject", "body", "headers_json"), "suffix")


def _prefix_flags(spark: SparkSession, sf: str) -> DataFrame:
    return FL.robustness_flags(
        views.messages(spark, sf, "id", "label", "subject", "body", "headers_raw"), "prefix"
    )


def flag_totals(spark: SparkSession, sf: str) -> DataFrame:
    return FL.flag_totals(_prefix_flags(spark, sf))


def mask(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.messages(spark, sf, "id", "subject", "body")
    return rows.select(
        "id", short_text().alias("excerpt"), F.md5(mask_domains(F.col("body"))).alias("masked_md5")
    )


QUERIES = {
    "q_url_table": url_table,
    "q_url_distinct": url_distinct,
    "q_url_hosts": url_hosts,
    "q_url_signals": url_signals,
    "q_url_nfkc": url_nfkc,
    "q_url_features": url_features,
    "q_list_join": list_join,
    "q_header_domains": header_domains,
    "q_auth_flags": auth_flags,
    "q_header_mismatch": header_mismatch,
    "q_header_features": header_features,
    "q_link_table": link_table,
    "q_anchor_mismatch": anchor_mismatch,
    "q_flags_suffix": flags_suffix,
    "q_flags_prefix": _prefix_flags,
    "q_flag_totals": flag_totals,
    "q_mask_domains": mask,
}

# --- oracle views, shared with the rule and evaluation queries ------------------------------

URLS = f"""
url_lists AS (SELECT id, {sql.find_all(sql.TEXT, sql.RULE)} || {sql.find_all('html', sql.RULE)} AS urls
  FROM messages),
urls AS (SELECT id, unnest(range(len(urls))) AS pos, unnest(urls) AS url FROM url_lists)"""


def _signals(url: str) -> dict[str, str]:
    full = sql.with_scheme(url)
    host, path = sql.hostname(full), sql.path(full)
    dots = f"(length({host}) - length(replace({host}, '.', '')))"
    mixed = " + ".join(
        f"regexp_matches({host}, {sql.q('[' + chr(92) + 'p{' + s + '}]')})::INT" for s in lists.SCRIPTS if s != "Signwriting"  # unknown to this engine
    )
    digits = sql.swap(url, r"\p{Nd}", "")
    return {
        "len_url": f"length({url})",
        "len_host": f"length({host})",
        "len_path": f"length({path})",
        "num_dots": f"(length({url}) - length(replace({url}, '.', '')))",
        "num_digits": f"(length({url}) - length({digits}))",
        "num_subdomains": f"greatest({dots} - 1, 0)",
        "has_at": f"contains({url}, '@')",
        "has_double_slash": f"contains({path}, '//')",
        "tld_suspect": f"list_contains({sql.listing(lists.SUSPECT_TLDS)}, {sql.last_label(host)})",
        "confusable": f"(({mixed}) > 1)",
    }


SIGNALS = _signals("url")
_SIGNAL_LIST = ", ".join(f"{e} AS {n}" for n, e in SIGNALS.items())

# Continuation lines are joined to their field. The headers of the view hold no other lines,
# so the whole text is one header block.
_BLOCK = sql.swap("coalesce(headers_raw, '')", r"\r?\n([ \t])", r"\1")


def _domains(field: str) -> str:
    values = sql.find_all("block", rf"(?im)^{field}:[ \t]*([^\r\n]*)", 1)
    bare = sql.swap(f"lower(array_to_string({values}, ','))", r'"[^"]*"|\([^()]*\)', "")
    addresses = sql.swap(bare, r"[^,<]*<([^<>]*)>[^,]*", r"\1")
    return sql.find_all(addresses, r"@([^@,;<>\s]*)[;\s]*(?:,|$)", 1)


def _differ(a: str, b: str) -> str:
    return (
        f"(len({a}) > 0 AND len({b}) > 0 AND "
        f"list_sort(list_distinct({a})) <> list_sort(list_distinct({b})))"
    )


_AUTH = f"lower({sql.find('block', '(?im)^authentication-results:[ ' + chr(92) + 't]*([^' + chr(92) + 'r' + chr(92) + 'n]*)', 1)})"
HEADERS = f"""
hb AS (SELECT id, {_BLOCK} AS block FROM messages),
hd AS (SELECT id, {_domains('from')} AS f, {_domains('reply-to')} AS r, {_domains('return-path')} AS p,
         {_AUTH} AS auth FROM hb),
headers AS (SELECT id, f, r, p,
  {_differ('f', 'r')} AS from_reply_mismatch, {_differ('f', 'p')} AS from_return_mismatch,
  contains(auth, 'spf=fail') AS auth_spf_fail, contains(auth, 'dkim=fail') AS auth_dkim_fail,
  contains(auth, 'dmarc=fail') AS auth_dmarc_fail,
  contains(auth, 'spf=none') OR contains(auth, 'dkim=none') OR contains(auth, 'dmarc=none') AS auth_any_none
  FROM hd)"""

_DROP = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
_HREF = r"""(?is)[\s"'/]href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def _decode(expr: str) -> str:
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'),
                         ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&")):
        expr = f"replace({expr}, {sql.q(entity)}, {sql.q(char)})"
    return expr


def links(source: str) -> str:
    """Anchors of a view `id, html`. All anchors of the given tables are closed."""
    found = sql.find_all(sql.swap("coalesce(html, '')", _DROP, ""), r"(?is)<a[\s>/][^>]*>.*?</a\s*>")
    href = f"lower({sql.strip(_decode('trim(' + sql.find(chr(97) + '.tag', _HREF, 1) + ', ' + sql.q(chr(34) + chr(39)) + ')'))})"
    inner = sql.swap("a.inner_html", "(?s)<[^>]*>", "")
    return f"""
la AS (SELECT id, {found} AS anchors FROM {source}),
lb AS (SELECT id, unnest(range(len(anchors))) AS pos, unnest(anchors) AS anchor FROM la),
lc AS (SELECT id, pos, split_part(anchor, '>', 1) AS tag,
         regexp_replace(regexp_replace(anchor, '^[^>]*>', ''), '(?i)</a\\s*>$', '') AS inner_html FROM lb),
ld AS (SELECT id, pos, lower({sql.strip(_decode(inner))}) AS text, {href} AS href FROM lc a),
le AS (SELECT *, CASE WHEN href = '' OR starts_with(href, 'mailto:') THEN ''
         ELSE {sql.hostname(sql.with_scheme('href'))} END AS host FROM ld),
links AS (SELECT *, host <> '' AND text <> '' AND NOT contains(text, host) AS mismatch FROM le)"""


MISMATCH = (
    links("messages")
    + """,
mismatches AS (SELECT id, coalesce(bool_or(mismatch), false) AS anchor_mismatch
  FROM messages LEFT JOIN links USING (id) GROUP BY id)"""
)


def _keys_missing() -> str:
    keys = "list_transform(json_keys(headers_json), lambda k: lower(k))"
    return (
        f"NOT coalesce(CASE WHEN json_valid(headers_json) AND starts_with(trim(headers_json), '{{') "
        f"THEN list_has_any({keys}, {sql.listing(lists.AUTH_KEYS)}) END, false)"
    )


def _markers(words) -> str:
    return sql.any_of(words, "contains(lower(text), v)")


def _flags(name: str, pattern: str, host, short: str, redirect: str, markers, missing: str) -> str:
    hosts = f"list_transform({sql.find_all('text', pattern)}, lambda u: {host('u')})"
    return f"""
{name}_t AS (SELECT *, {sql.TEXT} AS text FROM messages),
{name}_h AS (SELECT *, {hosts} AS hosts FROM {name}_t),
{name}_f AS (SELECT id, label, len(hosts) > 0 AS has_url, {sql.non_ascii('text')} AS unicode_homoglyph,
    {sql.some('hosts', short)} AS shortened_url, {sql.some('hosts', redirect)} AS redirector_url,
    {_markers(markers)} AS ptbr_likely, len(hosts) = 0 AS no_url, {missing} AS headers_missing
  FROM {name}_h)"""


_FLAG_COLUMNS = ", ".join(FL.FLAGS)
SUFFIX_FLAGS = (
    _flags(
        "sfx", sql.STRICT, sql.netloc, sql.any_of(lists.SUFFIX_SHORTENERS, "ends_with(x, v)"),
        f"list_contains({sql.listing(lists.SUFFIX_REDIRECTORS)}, x)", lists.SUFFIX_MARKERS, _keys_missing(),
    )
    + f",\nsuffix_flags AS (SELECT id, has_url, {_FLAG_COLUMNS} FROM sfx_f)"
)
_RAW_MISSING = (
    "NOT (contains(lower(coalesce(headers_raw, '')), 'spf=') OR contains(lower(coalesce(headers_raw, '')), "
    "'dkim=') OR contains(lower(coalesce(headers_raw, '')), 'dmarc='))"
)
PREFIX_FLAGS = (
    _flags(
        "pfx", sql.LOOSE, sql.raw_host, sql.any_of(lists.PREFIX_SHORTENERS, "starts_with(x, v)"),
        sql.any_of(lists.PREFIX_REDIRECTORS, "contains(x, v)"), lists.PREFIX_MARKERS, _RAW_MISSING,
    )
    + f",\nprefix_flags AS (SELECT id, label, {_FLAG_COLUMNS} FROM pfx_f)"
)

_MASKED_URL = rf"(?i)https?://[^{sql.WHITE})>\]}}\"']+"


def masked(expr: str) -> str:
    """Each URL found on its own, its location cut out by position, and the pieces put together again."""
    rest = "substr(u, strpos(u, '//') + 2)"
    location = f"split_part(split_part(split_part({rest}, '/', 1), '?', 1), '#', 1)"
    labels = f"string_split({location}, '.')"
    last = f"CASE WHEN len({labels}) >= 2 THEN {labels}[-2] || '.' || {labels}[-1] ELSE {location} END"
    one = (
        f"CASE WHEN {location} = '' OR contains({location}, '[') THEN u "
        f"ELSE replace(u, {location}, '***.' || {last}) END"
    )
    urls = f"list_transform({sql.find_all(expr, _MASKED_URL)}, lambda u: {one})"
    gaps = f"string_split_regex({expr}, {sql.q(_MASKED_URL)})"
    return (
        f"array_to_string(list_transform(list_zip({gaps}, {urls}), lambda z: z[1] || coalesce(z[2], '')), '')"
    )


def excerpt() -> str:
    both = sql.strip(
        f"{sql.strip('coalesce(subject, ' + sql.q('') + ')')} || ' ' || {sql.strip('coalesce(body, ' + sql.q('') + ')')}"
    )
    return masked(sql.swap(both, f"[{sql.WHITE}]+", " "))


def oracle() -> dict[str, str]:
    m = sql.MESSAGES
    hosts = (
        f"hosts AS (SELECT {sql.raw_host('url')} AS host, count(*) AS n_urls FROM urls GROUP BY 1)"
    )

    def match(kind: str, entries: str, test: str) -> str:
        return f"SELECT '{kind}' AS kind, host, entry, n_urls FROM hosts JOIN {entries} ON {test}"

    def fixed(values) -> str:
        return f"(SELECT unnest({sql.listing(values)}) AS entry)"

    page_endings = (
        "(SELECT DISTINCT regexp_extract(regexp_extract(url, '^[a-z]+://([^/]*)', 1), "
        "'([^.]*[.][^.]*)$', 1) AS entry FROM pages)"
    )
    full = sql.with_scheme("url")
    text_urls = f"(SELECT id, unnest({sql.find_all(sql.TEXT, sql.LOOSE)}) AS url FROM messages)"
    means = ", ".join(
        f"round(coalesce(avg({n}), 0.0), 6)::DOUBLE AS {n}" for n in NUMERIC_SIGNALS
    )
    anys = ", ".join(f"coalesce(bool_or({n}), false) AS {n}" for n in BOOLEAN_SIGNALS)
    flags = "from_reply_mismatch, from_return_mismatch, auth_spf_fail, auth_dkim_fail, auth_dmarc_fail, auth_any_none"
    return {
        "q_url_table": sql.select("SELECT * FROM urls", m, URLS),
        "q_url_distinct": sql.select("SELECT DISTINCT id, url FROM urls", m, URLS),
        "q_url_hosts": sql.select(
            f"""SELECT id, pos, url, {sql.raw_host('url')} AS raw_host, {sql.hostname(full)} AS hostname,
            {sql.netloc('url')} AS netloc, {sql.path(full)} AS path,
            {sql.last_label(sql.raw_host('url'))} AS tld, {sql.non_ascii(sql.raw_host('url'))} AS host_non_ascii
            FROM urls""", m, URLS),
        "q_url_signals": sql.select(f"SELECT id, pos, url, {_SIGNAL_LIST} FROM urls", m, URLS),
        "q_url_features": sql.select(
            f"SELECT messages.id AS id, {means}, {anys} FROM messages LEFT JOIN feats ON feats.id = messages.id "
            "GROUP BY messages.id",
            m, f"feats AS (SELECT id, {_SIGNAL_LIST} FROM {text_urls})"),
        "q_list_join": sql.select(
            " UNION ALL ".join((
                match("prefix", fixed(lists.PREFIX_SHORTENERS), "starts_with(host, entry)"),
                match("contains", fixed(lists.PREFIX_REDIRECTORS), "contains(host, entry)"),
                match("suffix", page_endings, "ends_with(host, entry)"),
                match("equal", fixed(lists.SUFFIX_REDIRECTORS), "host = entry"),
            )), m, URLS, hosts),
        "q_header_domains": sql.select(
            "SELECT id, array_to_string(f, ',') AS from_domains, array_to_string(r, ',') AS reply_domains, "
            "array_to_string(p, ',') AS return_domains FROM headers", m, HEADERS),
        "q_auth_flags": sql.select(
            "SELECT id, auth_spf_fail, auth_dkim_fail, auth_dmarc_fail, auth_any_none FROM headers", m, HEADERS),
        "q_header_mismatch": sql.select(
            "SELECT id, from_reply_mismatch, from_return_mismatch FROM headers", m, HEADERS),
        "q_header_features": sql.select(
            "SELECT id, len(f)::DOUBLE AS n_from_domains, len(r)::DOUBLE AS n_reply_domains, "
            "len(p)::DOUBLE AS n_return_domains, "
            + ", ".join(f"{x.strip()}::INT::DOUBLE AS {x.strip()}" for x in flags.split(","))
            + " FROM headers", m, HEADERS),
        "q_url_nfkc": sql.select(
            f"""SELECT id, pos, url, trim(url) AS url_nfkc, false AS changed FROM urls
            UNION ALL SELECT id, -1, replace(u.url, '{{id}}', id::VARCHAR), replace(u.want, '{{id}}', id::VARCHAR), u.url <> u.want
            FROM (SELECT id, kinds[id % len(kinds) + 1] AS u FROM messages, (SELECT [{", ".join(
                "{'url': " + sql.q(u) + ", 'want': " + sql.q(w) + "}" for u, w in HARD_URLS)}] AS kinds))""", m, URLS),
        "q_link_table": sql.select(
            f"""SELECT id, pos, text, href, host, mismatch FROM links
            UNION ALL SELECT *, host <> '' AND NOT contains(text, host) FROM (
              SELECT 'hard:' || id, 0, replace(kinds[id % len(kinds) + 1].text, '{{id}}', id::VARCHAR) AS text,
                replace(kinds[id % len(kinds) + 1].href, '{{id}}', id::VARCHAR) AS href,
                coalesce(regexp_extract(href, '^https?://([^/?]*)', 1), '') AS host
              FROM messages, (SELECT [{", ".join("{'text': " + sql.q(t) + ", 'href': " + sql.q(h) + "}" for _, t, h in HARD_LINKS)}] AS kinds))""", m,
            """htmls AS (SELECT 'message:' || id AS id, html FROM messages
               UNION ALL SELECT 'page:' || page_id, html FROM pages)""", links("htmls")),
        "q_anchor_mismatch": sql.select("SELECT * FROM mismatches", m, MISMATCH),
        "q_flags_suffix": sql.select("SELECT * FROM suffix_flags", m, SUFFIX_FLAGS),
        "q_flags_prefix": sql.select("SELECT * FROM prefix_flags", m, PREFIX_FLAGS),
        "q_flag_totals": sql.select(
            " UNION ALL ".join(
                f"SELECT '{f}' AS flag, count(*) FILTER ({f}) AS n FROM prefix_flags" for f in FL.FLAGS
            ), m, PREFIX_FLAGS),
        "q_mask_domains": sql.select(
            f"""SELECT id, CASE WHEN length(t) > 220 THEN substr(t, 1, 220) || '…' ELSE t END AS excerpt,
            masked_md5 FROM (SELECT id, {excerpt()} AS t, md5({masked('body')}) AS masked_md5 FROM messages)""", m),
    }
