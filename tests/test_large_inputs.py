"""Queries whose steps must not stay in one task or read the texts again, on rows of their own."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from hooklens.plans import corpus_queries, rule_queries


@pytest.fixture
def tables(spark, tmp_path):
    docs = spark.range(60).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("subject\nword http://a.b.tk/x w"), F.col("id")).alias("text"),
        F.lit("web").alias("source"),
    )
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(0, 60, 2).select(F.col("id").alias("doc_id"), (F.col("id") % 4 == 0).cast("int").alias("toxic")).write.parquet(
        f"{tmp_path}/labels.parquet")
    spark.range(10).select(F.col("id").alias("page_id"), F.concat(F.lit("http://site.org/"), "id").alias("url")).write.parquet(
        f"{tmp_path}/pages.parquet")
    return str(tmp_path)


def test_csv_files_grow_in_number(spark, tables, monkeypatch):
    parts = []
    write = corpus_queries.write_table
    monkeypatch.setattr(corpus_queries, "CSV_ROWS", 20, raising=False)
    monkeypatch.setattr(corpus_queries, "write_table", lambda df, *a: (parts.append(df.rdd.getNumPartitions()), write(df, *a)))
    found = corpus_queries.csv_split(spark, tables)
    assert parts == [3] and found.select("id").distinct().count() == found.count() == 60


def test_list_rules_do_not_read_the_texts_again(spark, tables, monkeypatch):
    read = []
    hits = rule_queries.list_rule_hits
    monkeypatch.setattr(rule_queries, "list_rule_hits", lambda rows, *a, **k: (read.extend(rows.inputFiles()), hits(rows, *a, **k))[1])
    assert rule_queries.rules_from_lists(spark, tables).count() == 120
    assert read and not [f for f in read if "documents.parquet" in f]


def test_list_versions_hold_no_broadcast_of_hosts_together(spark, tables):
    """A broadcast by text takes 64 MB of the driver: the plan that joins the versions has none, and each list is matched by itself."""
    from hooklens.operators import list_rules

    found = rule_queries.rules_from_lists(spark, tables)
    assert " host#" not in found._jdf.queryExecution().optimizedPlan().toString()
    hosts = spark.createDataFrame([("a.b.tk",), ("site.org",), ("x.y",)], "host string")
    entries = spark.createDataFrame([("suspect_tlds", "tk"), ("shorteners", "site"), ("redirectors", "site.org")], "list string, entry string")
    rules = list_rules.host_rules(hosts, entries)
    assert "Join" not in rules._jdf.queryExecution().optimizedPlan().toString()
    assert {r["host"]: sorted(r["rules"]) for r in rules.collect()} == {
        "a.b.tk": ["tld_suspect"], "site.org": ["redirector_url", "shortened_url"]}


def test_stream_batches_hold_many_files(spark, tables, monkeypatch):
    asked = []
    stream = rule_queries.message_stream
    monkeypatch.setattr(rule_queries, "FILE_ROWS", 4, raising=False)
    monkeypatch.setattr(
        rule_queries, "message_stream", lambda *a, **k: (asked.append(k["files_per_trigger"]), stream(*a, **k))[1])
    rows = rule_queries.stream_recovery(spark, tables).collect()
    assert asked == [3, 3]
    assert len(rows) == 60 and all(r["times"] == 1 and r["same_label"] and r["same_score"] for r in rows)
