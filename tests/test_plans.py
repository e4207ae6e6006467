"""Physical plans: no needless shuffle, no one-task window over data, no Python but NFKC."""

from __future__ import annotations

import re

import pytest

from hooklens.operators import curves, ranking, rules as R, url_tables as UT
from hooklens.operators.flags import robustness_flags
from hooklens.operators.header_tables import link_table
from hooklens.operators.split import stratified_split
from hooklens.plans import catalog
from pyspark.sql import functions as F

DOCS = "/root/testdata/sf0.001/documents.parquet"
SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def mail(spark):
    docs = spark.read.parquet(DOCS)
    empty = F.lit(None).cast("string")
    return docs.select(
        F.col("doc_id").alias("id"), F.lit("ham").alias("label"), F.col("source").alias("subject"),
        F.col("text").alias("body"), empty.alias("headers_raw"), empty.alias("html"), empty.alias("headers_json"),
    )


@pytest.mark.parametrize(
    "make",
    [
        lambda m: R.evaluate_rules(m),
        lambda m: R.rule_details(m),
        lambda m: UT.url_table(m),
        lambda m: UT.distinct_urls(m),
        lambda m: UT.message_url_features(m),
        lambda m: robustness_flags(m, "prefix"),
        lambda m: robustness_flags(m, "suffix"),
        lambda m: link_table(m.select("id", "html")),
    ],
)
def test_message_signals_do_not_shuffle(mail, make):
    assert "Exchange" not in plan(make(mail))


def test_urls_are_extracted_once_per_row(mail):
    assert plan(UT.url_table(mail)).count("regexp_extract_all(trim") == 1
    assert plan(R.evaluate_rules(mail)).count("regexp_extract_all(trim") == 1


def test_only_needed_columns_are_read(mail):
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan(UT.url_table(mail))).group(1)
    assert schema == "doc_id:bigint,text:string,source:string"


def test_split_shuffles_keys_only(mail):
    text = plan(stratified_split(mail))
    for line in text.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "body" not in line
    assert "SortMergeJoin" not in text


def test_windows_over_data_are_partitioned(spark, mail):
    numbered = ranking.with_row_number(mail, [F.col("id")], "n", buckets=8)
    scored = mail.select("id", (F.col("id") % 2).cast("int").alias("y_true"), (F.col("id") / 1000).alias("score"))
    for df in (numbered, curves.pr_curve(scored)):
        for spec in re.findall(r"Window \[.*", plan(df)):
            # sums over bucket totals (_p) see one row per bucket; all others are bucketed
            assert "_bucket" in spec or "sum(_p#" in spec


PYTHON_ALLOWED = {"q_url_nfkc", "q_url_signals", "q_url_features", "q_signal_reasons"}


@pytest.mark.parametrize("name", sorted(set(catalog.oracle_sql()) - PYTHON_ALLOWED - {"q_stream_decisions", "q_sink_roundtrip", "q_metrics_json", "q_saved_pipeline", "q_experiment_summary"}))
def test_no_python_in_plans(spark, name):
    text = plan(catalog.queries()[name](spark, SF_DIR))
    assert "EvalPython" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_link_html_is_dealt_out_before_it_is_parsed(spark, tmp_path):
    from hooklens.plans.signal_queries import link_table as query

    html = '<a href="http://x.com">x</a>'
    tables = {
        "documents": ([(1, "see http://a.com/", "en", "s")], "doc_id long, text string, lang string, source string"),
        "labels": ([(1, 1)], "doc_id long, toxic int"),
        "pages": ([(0, "http://p.com", html), (None, None, html), (0, "http://p.com", html)], "page_id long, url string, html string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    links = query(spark, str(tmp_path))
    assert "RepartitionByExpression" in links._jdf.queryExecution().optimizedPlan().toString().split("Generate")[1]
    assert links.filter("host = 'x.com'").count() == 3
