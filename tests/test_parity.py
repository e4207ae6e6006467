"""Cases the generated data does not hold: whole references, masking, scripts, long list entries, missing labels."""

import html

import pytest
from pyspark.sql import functions as F

from hooklens.functions.links import _decode
from hooklens.functions.urls import mask_domains, mixed_script
from hooklens.operators import corpus, url_tables
from hooklens.plans import catalog


def one(spark, values, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.r for r in rows.select("i", expression(F.col("v")).alias("r")).orderBy("i").collect()]


def test_character_references(spark):
    texts = [
        "evil&#46;com", "b&auml;nk", "http:&#47;&#x2F;x", "a & b &", "&amp;lt;", "&lt;b&gt;", "&notaname; &copy &copyright;", "&#0;",
        "&#x1F600;", "&#xD800;", "&nbsp;x", "plain", "", "&&amp;&", "&NotEqualTilde;", "&eacute;t&eacute;",
    ]
    want = [html.unescape(t).replace(" ", " ") for t in texts]
    want[6] = "&notaname; © &copyright;"  # only whole names count
    assert one(spark, texts, _decode) == want


def test_masking_takes_each_url_as_a_whole(spark):
    texts = [
        "see https://l.facebook.com/l.php?u=http://a.x1.com now", "https://a.b.com/?u=a.b.com", "http://localhost/x", "http:///x",
        "no url", "HTTP://WWW.Example.co.UK:80/a) http://x.y.z", None,
    ]
    assert one(spark, texts, mask_domains) == [
        "see https://***.facebook.com/l.php?u=http://a.x1.com now", "https://***.b.com/?u=***.b.com", "http://***.localhost/x",
        "http:///x", "no url", "HTTP://***.co.UK:80/a) http://***.y.z", None,
    ]


def test_mixed_scripts(spark):
    hosts = ["example.com", "exämple.com", "раypal.com", "ⲁbc.com", "ꓮpple.com", "ελλ.gr", "日本.jp", "例え.jp", "аррӏе"]
    assert one(spark, hosts, mixed_script) == [False, False, True, True, True, True, True, True, False]


@pytest.mark.parametrize("kind", ["equal", "prefix", "suffix", "contains"])
def test_long_entries_match(spark, kind):
    host = "x" * 310
    entry = host if kind == "equal" else host[:305]
    hosts = spark.createDataFrame([(host,), ("short",)], "host string")
    entries = spark.createDataFrame([(entry,)], "entry string")
    assert [r.host for r in url_tables.match_hosts(hosts, entries, kind).collect()] == [host]
    assert url_tables.match_hosts(hosts, entries.limit(0), kind).count() == 0


def test_missing_label_is_refused(spark):
    rows = spark.createDataFrame([(1, "ham"), (2, None)], "id long, label string")
    with pytest.raises(ValueError, match="None"):
        corpus.require_labels(rows)


def test_no_query_deals_rows_round_robin(spark):
    for name in ("q_term_df", "q_message_scan", "q_error_examples", "q_robustness"):
        frame = catalog.queries()[name](spark, "/root/testdata/sf0.001")
        assert "RoundRobin" not in frame._jdf.queryExecution().executedPlan().toString()
