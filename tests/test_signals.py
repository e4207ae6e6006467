"""URL, header, link and flag signals on hand-made rows."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from hooklens import lists
from hooklens.functions import headers as H, links as L, urls as U
from hooklens.functions.text import label_name, label_number, message_text, strip, text_projection
from hooklens.operators import flags as FL, header_tables as HT, url_tables as UT


def one(spark, value, expression):
    """Value of a column expression over a single text column `x`."""
    return spark.createDataFrame([(value,)], "x string").select(expression(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "pattern, text, found",
    [
        ("loose", "see http://a.b/1) end", ["http://a.b/1)"]),
        ("strict", "see http://a.b/1) end", ["http://a.b/1"]),
        ("rule", "see http://a.b/1) end", ["http://a.b/1)"]),
        ("rule", "<a href='http://a.b/x'>", ["http://a.b/x"]),
        ("rule", "HTTPS://A.b and http://c.d", ["HTTPS://A.b", "http://c.d"]),
        ("loose", "http://a.b http://c.d", ["http://a.b", "http://c.d"]),
        ("loose", "ftp://a.b", []),
        ("loose", "", []),
        ("loose", None, None),
    ],
)
def test_extract_urls(spark, pattern, text, found):
    assert one(spark, text, lambda x: U.extract_urls(x, pattern)) == found


@pytest.mark.parametrize(
    "url, raw, name, location, tld",
    [
        ("http://user@Pay.com:8080/a", "user@pay.com:8080", "pay.com", "user@pay.com:8080", "com:8080"),
        ("HTTP://Shop.Example.com/q", "http:", "shop.example.com", "shop.example.com", ""),
        ("https://1.2.3.4/x?y#z", "1.2.3.4", "1.2.3.4", "1.2.3.4", "4"),
        ("http://localhost", "localhost", "localhost", "localhost", ""),
        ("http://[::1]:80/p", "[::1]:80", "::1", "[::1]:80", ""),
        ("http://a.b?q=/x", "a.b?q=", "a.b", "a.b", "b?q="),
    ],
)
def test_host_forms(spark, url, raw, name, location, tld):
    assert one(spark, url, U.raw_host) == raw
    assert one(spark, url, U.hostname) == name
    assert one(spark, url, U.netloc) == location
    assert one(spark, url, lambda x: U.last_label(U.raw_host(x))) == tld


def test_path_without_parameters(spark):
    assert one(spark, "http://a.b/c;x/d;y=1?q#f", U.url_path) == "/c;x/d"
    assert one(spark, "http://a.b", U.url_path) == ""


def signals(spark, *urls):
    df = spark.createDataFrame([(i, 0, u) for i, u in enumerate(urls)], "id long, pos int, url string")
    return [r.asDict() for r in UT.url_signals(df).orderBy("id").collect()]


def test_url_signals(spark):
    plain, foreign, full_width, mixed = signals(
        spark,
        "http://a.b.c.evil.tk/x//y1",
        "http://exämple.com/",
        "http://ｅｖｉｌ.com/１",
        "http://pаypal.com/",
    )
    assert plain["len_url"] == 26 and plain["len_host"] == 13 and plain["len_path"] == 6
    assert plain["num_dots"] == 4 and plain["num_digits"] == 1 and plain["num_subdomains"] == 3
    assert plain["has_double_slash"] and plain["tld_suspect"] and not plain["has_at"]
    assert not foreign["confusable"]  # one writing system, though not ASCII
    assert full_width["len_host"] == 8 and full_width["num_digits"] == 1
    assert not full_width["confusable"] and mixed["confusable"]


def test_url_normalisation(spark):
    df = spark.createDataFrame([(1, 0, "http://ｅ.com/①"), (2, 0, "http://a.b")], "id long, pos int, url string")
    found = {r["id"]: r["url_nfkc"] for r in UT.normalised_urls(df).collect()}
    assert found == {1: "http://e.com/1", 2: "http://a.b"}


MESSAGE = "id long, label string, subject string, body string, headers_raw string, html string, headers_json string"


def messages(spark, *rows):
    names = ("label", "subject", "body", "headers_raw", "html", "headers_json")
    return spark.createDataFrame([(i, *(r.get(n) for n in names)) for i, r in enumerate(rows)], MESSAGE)


def test_url_table_order_and_given_urls(spark):
    df = messages(spark, {"subject": "http://s.t", "body": "http://b.c http://b.c", "html": "<a href='http://h.i'>x</a>"}, {})
    rows = [(r["id"], r["pos"], r["url"]) for r in UT.url_table(df).orderBy("id", "pos").collect()]
    assert rows == [(0, 0, "http://s.t"), (0, 1, "http://b.c"), (0, 2, "http://b.c"), (0, 3, "http://h.i")]
    given = df.withColumn("urls", F.lit(json.dumps(["http://g.h"])))
    rows = {(r["id"], r["url"]) for r in UT.url_table(given, given="urls").collect()}
    assert rows == {(0, "http://g.h"), (0, "http://h.i"), (1, "http://g.h")}
    assert UT.distinct_urls(df).count() == 3


def test_message_url_features(spark):
    df = messages(spark, {"body": "http://a.tk/1 http://bb.com/"}, {"body": "none"}, {})
    rows = UT.message_url_features(df).orderBy("id").collect()
    assert rows[0]["len_url"] == 13.5 and rows[0]["tld_suspect"] and not rows[0]["has_at"]
    assert rows[1]["len_url"] == 0.0 and not rows[1]["tld_suspect"] and rows[2]["num_dots"] == 0.0


@pytest.mark.parametrize("kind", ["prefix", "suffix", "contains", "equal"])
def test_list_match_equals_brute_force(spark, kind):
    hosts = ["bit.ly", "xbit.ly", "bit.ly.evil.com", "t.co", "at.com", "", "example.com", "b"]
    entries = ["bit.ly", "t.co", "example.com", "com", "b"]
    test = {
        "prefix": str.startswith, "suffix": str.endswith, "contains": str.__contains__, "equal": str.__eq__,
    }[kind]
    found = UT.match_hosts(
        spark.createDataFrame([(h,) for h in hosts], "host string"),
        spark.createDataFrame([(e,) for e in entries], "entry string"), kind,
    )
    assert {(r["host"], r["entry"]) for r in found.collect()} == {
        (h, e) for h in hosts for e in entries if test(h, e)
    }


def test_header_domains(spark):
    raw = (
        'From: "Doe, J. (x@no.com)" <A@One.com>, b@two.ORG (comment @ here)\r\n'
        "Reply-To:\r\n <c@three.net>\n"
        "return-path: <>\n"
        "Authentication-Results: mx; spf=FAIL\n\tdkim=none\n"
        "Authentication-Results: dmarc=fail\n"
        "\nFrom: body@not.header\n"
    )
    row = HT.with_header_signals(messages(spark, {"headers_raw": raw}, {})).orderBy("id").collect()
    first, empty = row
    assert first["from_domains"] == ["one.com", "two.org"]
    assert first["reply_domains"] == ["three.net"] and first["return_domains"] == []
    assert first["auth_spf_fail"] and first["auth_any_none"] and not first["auth_dmarc_fail"]
    assert first["from_reply_mismatch"] and not first["from_return_mismatch"]
    assert empty["from_domains"] == [] and not empty["auth_any_none"]


def test_header_block_ends_at_other_lines(spark):
    raw = "Subject: x\nno field here\nFrom: a@late.com\n"
    assert one(spark, raw, lambda x: H.address_domains(H.unfolded(x), "from")) == []
    long = "X-Line: y\n" * 20000 + "From: a@far.com\n"
    assert one(spark, long, lambda x: H.address_domains(H.unfolded(x), "from")) == ["far.com"]


@pytest.mark.parametrize(
    "json_text, missing, ok",
    [
        ('{"spf": "pass", "dkim": "pass", "dmarc": "pass"}', False, True),
        ('{"Authentication-Results": "none"}', False, False),
        ('{"other": "spf dkim dmarc pass"}', True, True),
        ("{bad", True, False),
        ("[1]", True, False),
        ("", True, False),
        (None, True, False),
    ],
)
def test_header_json(spark, json_text, missing, ok):
    assert one(spark, json_text, H.json_headers_missing) is missing
    assert one(spark, json_text, H.json_auth_ok) is ok


@pytest.mark.parametrize(
    "html, mismatch",
    [
        ('<a href="http://evil.com/x">bank.com</a>', True),
        ('<a href="http://evil.com/x">go to <b>EVIL</b>.com</a>', False),
        ("<A class=x HREF=evil.com>bank</A>", True),
        ('<a href="mailto:a@b.c">write</a>', False),
        ('<a href="/local">here</a>', False),
        ('<a href="http://evil.com"></a>', False),
        ('<a href="http://evil.com">one<a href="http://two.com">two.com</a>', True),
        ('<!-- <a href="http://evil.com">bank</a> -->', False),
        ("<script>'<a href=\"http://evil.com\">bank</a>'</script>", False),
        ('<a href="http://a.com/?x=1&amp;y=2">a.com &amp; more</a>', False),
        ('<a data-href="http://evil.com">bank</a>', False),
        ('<a href="http://evil.com">open end', True),
        ("", False),
        (None, False),
    ],
)
def test_anchor_mismatch(spark, html, mismatch):
    assert one(spark, html, L.anchor_mismatch) is mismatch


def test_link_table(spark):
    df = spark.createDataFrame([(1, '<a href="http://U@H.com:1/"> A <i>b</i></a><a>x</a>'), (2, None)], "id long, html string")
    rows = [(r["pos"], r["text"], r["href"], r["host"]) for r in HT.link_table(df).orderBy("pos").collect()]
    assert rows == [(0, "a b", "http://u@h.com:1/", "h.com"), (1, "x", "", "")]


def test_flag_profiles_differ(spark):
    df = messages(
        spark,
        {"body": "https://t.com/x", "headers_raw": "spf=pass", "headers_json": '{"spf": 1}'},
        {"body": "https://xbit.ly/1 você"},
        {"body": "https://click.mail.net/"},
        {"subject": None, "body": None},
    )
    prefix = FL.robustness_flags(df, "prefix").orderBy("id").collect()
    suffix = FL.robustness_flags(df, "suffix").orderBy("id").collect()
    # a prefix test takes t.com for t.co, an ending test takes xbit.ly for bit.ly
    assert [r["shortened_url"] for r in prefix] == [True, False, False, False]
    assert [r["shortened_url"] for r in suffix] == [False, True, False, False]
    assert [r["redirector_url"] for r in prefix] == [False, False, True, False]
    assert [r["redirector_url"] for r in suffix] == [False, False, False, False]
    assert [r["headers_missing"] for r in prefix] == [False, True, True, True]
    assert prefix[1]["unicode_homoglyph"] and prefix[1]["ptbr_likely"] and prefix[3]["no_url"]
    totals = {r["flag"]: r["n"] for r in FL.flag_totals(FL.robustness_flags(df, "prefix")).collect()}
    assert totals["headers_missing"] == 3 and totals["no_url"] == 1


def test_masking(spark):
    text = "go http://login.a.evil.com/x and https://host:80 (http://u@a.b.c:8/p) end"
    assert one(spark, text, U.mask_domains) == (
        "go http://***.evil.com/x and https://***.host:80 (http://***.b.c:8/p) end"
    )
    df = messages(spark, {"subject": " a ", "body": "b \n c" + "d" * 300}, {})
    rows = [r[0] for r in df.orderBy("id").select(U.short_text()).collect()]
    assert rows[0].startswith("a b cdd") and len(rows[0]) == 221 and rows[0].endswith("…")
    assert rows[1] == ""


def test_text_projection_and_labels(spark):
    df = messages(spark, {"subject": "  a", "body": "b\t"}, {})
    assert [r[0] for r in df.orderBy("id").select(message_text()).collect()] == ["a b", ""]
    sms = spark.createDataFrame([(" x ",), (None,)], "text string")
    assert [r[0] for r in sms.select(text_projection("sms")).collect()] == ["x", ""]
    assert one(spark, " Spam ", label_name) == "phishing" and one(spark, "LEGIT", label_number) == 0
    assert one(spark, "other", label_name) is None
    assert one(spark, " x　", strip) == "x"


def test_lists_from_configuration():
    rules = lists.RuleLists.from_mapping({"suspect_tlds": [".tk"], "ptbr_markers": ["pix"]})
    assert rules.suspect_tlds == ("tk",) and rules.shorteners == () and rules.markers == ("pix",)


@pytest.mark.parametrize(
    "fragment, text, href",
    [
        ("<a" + " x='>'" * 20000 + " href=http://far.com>t</a>", "t", "http://far.com"),
        ('<a href="http://a.com/' + "&#x" + "0" * 5000 + '41;">&' + "a" * 5000 + ";</a>", "&" + "a" * 5000 + ";", "http://a.com/a"),
        ('<a href="unclosed>t</a>', "t", "unclosed"),
        ("<a href>t&#13;&#x9F;</a>", "t\rŸ".lower(), ""),
        ("<a href=x>&ampamp;&am;&lt</a>", "&amp;&am;<", "x"),
        ("<a href='?a&lt=1&ltx&lt;'>&lt=</a>", "<=", "?a&lt=1&ltx<"),
    ],
)
def test_anchor_parts(spark, fragment, text, href):
    """Tags of any length and quoting, references of any length; as the HTML standard reads them."""
    df = spark.createDataFrame([(1, fragment)], "id long, html string")
    row = HT.link_table(df).first()
    assert (row["text"], row["href"]) == (text, href)


def test_named_references_against_the_standard_library(spark):
    import html as standard

    names = sorted(L.html5)
    texts = ["&" + n for n in names] + ["&" + n + "xyz;" for n in names if not n.endswith(";")]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, html string")
    got = {r["id"]: r["t"] for r in df.select("id", L._decode(F.col("html"), F.lit(L._NAMES)).alias("t")).collect()}
    wrong = [t for i, t in enumerate(texts) if got[i] != standard.unescape(t).replace(" ", " ")]
    assert not wrong


def test_hosts_containing_entries_of_any_length(spark):
    import random

    from hooklens.operators.url_tables import match_hosts

    rng = random.Random(4)
    word = lambda n: "".join(rng.choices("ab.c", k=n))
    hosts = sorted({word(rng.randint(0, 30)) for _ in range(150)} | {"", "a", "www.www.www.com", "x" * 500 + "www."})
    entries = sorted({word(rng.randint(1, 9)) for _ in range(60)} | {"www.", "w.co", "x" * 400, "é"})
    tables = [spark.createDataFrame([(v,) for v in values], f"{name} string") for values, name in ((hosts, "host"), (entries * 2, "entry"))]
    found = sorted((r["host"], r["entry"]) for r in match_hosts(*tables, "contains").collect())
    assert found == sorted((h, e) for h in hosts for e in entries if e in h)
