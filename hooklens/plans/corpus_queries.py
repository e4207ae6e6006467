"""Sources, corpora, synthetic modalities and variants."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F

from hooklens import lists
from hooklens.functions.text import message_text
from hooklens.operators import corpus as C, metrics as M, split as SP, synth, variants as V
from hooklens.operators.flags import robustness_flags
from hooklens.plans import sql, views
from hooklens.schema import EXPERIMENT_COLUMNS, PREDICTION, require_columns
from hooklens.session import fresh_dir, written
from hooklens.sources.csv_split import read_csv_split
from hooklens.sources.readers import read_csv, read_messages
from hooklens.sources.writers import append_feedback, read_feedback, write_table
from hooklens.streaming.jobs import feedback_stream, start_append


def _digested(df: DataFrame, *texts: str) -> DataFrame:
    """Replace long texts by their length and hash, so whole texts are compared."""
    columns = []
    for name in df.columns:
        if name in texts:
            columns += [F.length(name).cast("bigint").alias(f"{name}_chars"), F.md5(name).alias(f"{name}_md5")]
        else:
            columns.append(F.col(name))
    return df.select(*columns)


def _digest(*texts: str) -> str:
    return ", ".join(f"length({t}) AS {t}_chars, md5({t}) AS {t}_md5" for t in texts)


def message_scan(spark: SparkSession, sf: str) -> DataFrame:
    rows = require_columns(views.messages(spark, sf), EXPERIMENT_COLUMNS)
    kept = rows.select("id", "label", "subject", "body", "date", "source", "headers_raw", "html")
    return _digested(kept, "subject", "body", "headers_raw", "html")


def bad_labels(spark: SparkSession, sf: str) -> DataFrame:
    raw = views.raw_mail(spark, sf).select(F.col("`Spam/Ham`").alias("label"))
    return C.unexpected_labels(raw)


def text_projection(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.messages(spark, sf, "id", "subject", "body")
    return _digested(rows.select("id", message_text().alias("text")), "text")


def label_normalise(spark: SparkSession, sf: str) -> DataFrame:
    third = F.col("doc_id") % 3
    spelled = (
        F.when(F.col("doc_id") % 17 == 0, "unknown")
        .when(F.col("toxic") == 1, F.when(third == 0, "1").when(third == 1, "Spam").otherwise(" phishing "))
        .otherwise(F.when(third == 0, "0").when(third == 1, "LEGIT").otherwise("ham"))
    )
    rows = views.table(spark, sf, "labels").select(F.col("doc_id").alias("id"), spelled.alias("label"))
    return C.normalised_labels(rows)


def corpus_ham(spark: SparkSession, sf: str) -> DataFrame:
    return C.ordered_corpus(_digested(C.ham_corpus(views.raw_mail(spark, sf)), "subject", "body"))


def corpus_relabel(spark: SparkSession, sf: str) -> DataFrame:
    made = C.relabelled_corpus(views.raw_mail(spark, sf))
    return C.ordered_corpus(_digested(made, "subject", "body"))


def _phishing(spark: SparkSession, sf: str) -> DataFrame:
    return C.phishing_corpus(views.raw_phishing(spark, sf), [F.col("id")])


def corpus_phishing(spark: SparkSession, sf: str) -> DataFrame:
    return _digested(_phishing(spark, sf), "subject", "body")


def corpus_merge(spark: SparkSession, sf: str) -> DataFrame:
    merged = C.merged_corpus(C.ham_corpus(views.raw_mail(spark, sf)), _phishing(spark, sf))
    return _digested(merged, "subject", "body")


def class_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return M.class_distribution(views.labelled(spark, sf, "label", "source"), "label", "source")


def test_size(spark: SparkSession, sf: str) -> DataFrame:
    return SP.choose_test_size(views.labelled(spark, sf, "id", "label"))


def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    return SP.stratified_split(views.labelled(spark, sf, "id", "label"))


def test_subset(spark: SparkSession, sf: str) -> DataFrame:
    chosen = SP.stratified_split(views.labelled(spark, sf, "id", "label")).filter("split = 'test'")
    rows = views.messages(spark, sf, "id", "subject", "body")
    return _digested(C.in_test_set(rows, chosen), "subject", "body")


def sink_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions through CSV and flags through parquet, read back and joined."""
    predictions, flags = fresh_dir(spark, "predictions"), fresh_dir(spark, "flags")
    write_table(views.scores(spark, sf), predictions, "csv")
    write_table(robustness_flags(views.messages(spark, sf, "id", "subject", "body", "headers_json"), "suffix"), flags)
    return read_csv(spark, predictions, PREDICTION).join(spark.read.parquet(flags), "id")


def read_messages_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled messages written as CSV and read by the message reader."""
    path = fresh_dir(spark, "messages")
    columns = ("id", "label", "subject", "body", "date", "source", "headers_raw", "html")
    write_table(views.labelled(spark, sf, *columns), path, "csv")
    return _digested(read_messages(spark, path, "csv").select(*columns), "subject", "body", "headers_raw", "html")


#: Messages of a CSV file, about.
CSV_ROWS = 20_000


def csv_split(spark: SparkSession, sf: str) -> DataFrame:
    """All messages through large CSV files, each read by many tasks; missing and empty texts stay apart.

    A file holds up to CSV_ROWS messages or so, so that no task writes more. There is one of them at test scale, cut into
    byte ranges of 64 KB; the ranges of more files are longer, up to 128 MB.
    """
    files = max(1, math.ceil(views.table(spark, sf, "documents").count() / CSV_ROWS))
    size = min(files << 16, 1 << 27)
    path = fresh_dir(spark, "messages")
    rows = views.messages(spark, sf, "id", "label", "subject", "body", "html", "headers_raw")
    subject = F.when(F.col("id") % 5 != 0, F.when(F.col("id") % 5 != 1, F.col("subject")).otherwise(""))
    quoted = F.concat(F.lit('"x,"\n"'), F.col("body"), F.lit('"\r\n'))
    write_table(rows.withColumns({"subject": subject, "body": quoted}).repartition(files, "id"), path, "csv")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in before:
            spark.conf.set(k, size)
        # the ranges are dealt out here
        read = read_csv_split(spark, path)
        parts = written(read.withColumn("_part", F.spark_partition_id()), "read")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    texts = ("subject", "body", "html", "headers_raw")
    return parts.select(
        F.col("id").cast("bigint").alias("id"), "label", *[F.md5(c).alias(f"{c}_md5") for c in texts],
        (F.col("subject") == "").alias("empty_subject"),
    )


def _feedback_folder(spark: SparkSession, sf: str) -> str:
    """Labels as feedback records, appended in two batches."""
    path, key = fresh_dir(spark, "feedback"), F.col("doc_id")
    name = F.when(F.col("toxic") == 1, "phishing").when(F.col("toxic") == 0, "ham")
    records = views.table(spark, sf, "labels").select(
        key.alias("id"), F.when(key % 13 != 0, name).alias("label_true"),
        F.when(key % 3 == 0, F.concat(F.lit('case "'), key.cast("string"), F.lit('"'))).alias("context"),
    )
    append_feedback(spark, records.filter("id % 2 = 0").drop("context"), path)
    append_feedback(spark, records.filter("id % 2 = 1"), path)
    return path


def feedback(spark: SparkSession, sf: str) -> DataFrame:
    return read_feedback(spark, _feedback_folder(spark, sf))


def feedback_kept(spark: SparkSession, sf: str) -> DataFrame:
    """The feedback folder as a stream that keeps valid records, read back."""
    out = fresh_dir(spark, "feedback-kept")
    records = feedback_stream(spark, _feedback_folder(spark, sf))
    start_append(records, f"{out}/rows", f"{out}/progress", "json").awaitTermination()
    return read_feedback(spark, f"{out}/rows")


def synth_headers(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.messages(spark, sf, "id", "label", "subject", "body")
    return synth.with_synthetic_modalities(rows).select("id", "headers_raw")


def synth_html(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.messages(spark, sf, "id", "label", "subject", "body")
    return synth.with_synthetic_modalities(rows).select("id", "html")


def adversarial_expand(spark: SparkSession, sf: str) -> DataFrame:
    base = views.labelled(spark, sf, "id", "label", "subject", "body", "headers_json")
    rows = base.select("id").count()
    made = V.expanded_with_variants(base, rows + rows // 2)
    return _digested(made.select("id", "label", "mode", "subject", "body", "headers_json"), "subject", "body")


def _variant(mode: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        base = views.labelled(spark, sf, "id", "label", "subject", "body", "headers_json")
        return _digested(V.with_variant_mode(base, mode), "subject", "body")

    return run


QUERIES = {
    "q_message_scan": message_scan,
    "q_bad_labels": bad_labels,
    "q_text_projection": text_projection,
    "q_label_normalise": label_normalise,
    "q_corpus_ham": corpus_ham,
    "q_corpus_relabel": corpus_relabel,
    "q_corpus_phishing": corpus_phishing,
    "q_corpus_merge": corpus_merge,
    "q_class_distribution": class_distribution,
    "q_test_size": test_size,
    "q_stratified_split": stratified_split,
    "q_test_subset": test_subset,
    "q_sink_roundtrip": sink_roundtrip,
    "q_read_messages": read_messages_csv,
    "q_csv_split": csv_split,
    "q_feedback": feedback,
    "q_feedback_stream": feedback_kept,
    "q_synth_headers": synth_headers,
    "q_synth_html": synth_html,
    "q_adversarial_expand": adversarial_expand,
    "q_adv_redirect": _variant("FN_redirect"),
    "q_adv_strip_urls": _variant("FN_semurl"),
    "q_adv_newsletter": _variant("FP_news"),
    "q_adv_ptbr": _variant("FP_ptbr"),
    "q_adv_headers": _variant("FP_headerok"),
}

_CORPUS = """
SELECT "Message ID" AS id, {label} AS label, {digest}, "Date" AS date FROM (
  SELECT "Message ID", "Spam/Ham", "Date", coalesce("Subject", '') AS subject,
    coalesce("Message", '') AS body FROM raw_mail
) {where} ORDER BY date IS NULL, date, id"""

_PHISHING = """
phish AS (
  SELECT row_number() OVER (ORDER BY id) - 1 AS id, 'phishing' AS label, subject, body, date
  FROM messages WHERE label = 'phishing'
)"""


def _variant_case(key: str, mode: str) -> dict[str, str]:
    url = f"nullif({sql.find('body', sql.STRICT)}, '')"
    news = sql.pick(lists.NEWSLETTER_HEADLINES, key, "news")
    headline = sql.strip(f"'[' || {news} || '] ' || subject")
    stripped = sql.swap("body", sql.STRICT, "")
    ok = f"{mode} = 'FP_headerok' AND y = 0"
    return {
        "subject": f"""CASE WHEN {mode} = 'FP_news' AND y = 0 THEN {headline}
            WHEN {ok} THEN {sql.q(lists.URGENT_SUBJECT)} || subject ELSE subject END""",
        "body": f"""CASE
            WHEN {mode} = 'FN_redirect' AND y = 1
              THEN coalesce(replace(body, {url}, {sql.q(lists.REDIRECT_PREFIX)} || {url}), body)
            WHEN {mode} = 'FN_semurl' AND y = 1 THEN {stripped} || {sql.q(lists.REPLY_REQUEST)}
            WHEN {mode} = 'FP_news' AND y = 0 THEN body || {sql.q(lists.NEWSLETTER_FOOTER)}
            WHEN {mode} = 'FP_ptbr' AND y = 0
              THEN body || ' ' || {sql.pick(lists.MARKER_PHRASES, key, 'ptbr')}
            WHEN {ok} THEN body || {sql.q(lists.URGENT_FOOTER)}
            ELSE body || {sql.q(lists.NEUTRAL_FOOTER)} END""",
        "headers_json": f"""CASE WHEN {ok} THEN {sql.q(lists.AUTHENTICATED_HEADERS)}
            ELSE coalesce(headers_json, {sql.q(lists.UNAUTHENTICATED_HEADERS)}) END""",
    }


_BASE = """
base AS (SELECT id, label, (label = 'phishing')::INT AS y, subject, body, headers_json
         FROM messages WHERE label IS NOT NULL)"""


def _variant_sql(mode: str) -> str:
    made = ", ".join(f"{e} AS {n}" for n, e in _variant_case("id", sql.q(mode)).items())
    return sql.select(
        f"SELECT id, label, {_digest('subject', 'body')}, headers_json FROM v",
        sql.MESSAGES, _BASE, f"v AS (SELECT id, label, {made} FROM base)",
    )


def _expand_sql() -> str:
    made = ", ".join(f"{e} AS {n}" for n, e in _variant_case("number", "mode").items())
    return sql.select(
        f"SELECT id, label, mode, {_digest('subject', 'body')}, headers_json FROM everything",
        sql.MESSAGES,
        _BASE,
        "numbered AS (SELECT row_number() OVER (ORDER BY id) - 1 AS rank, * FROM base)",
        f"""draws AS (SELECT range AS number, {sql.pick(lists.VARIANT_MODES, 'range', 'mode')} AS mode,
              floor({sql.draw('range', 'row', 13)} / 4503599627370496.0::DOUBLE
                    * (SELECT count(*) FROM base))::BIGINT AS drawn
            FROM range((SELECT count(*) // 2 FROM base)))""",
        f"""everything AS (
            SELECT rank AS id, label, NULL AS mode, subject, body, headers_json FROM numbered
            UNION ALL
            SELECT number + (SELECT count(*) FROM base) AS id, label, mode, subject, body, headers_json
            FROM (SELECT number, label, mode, {made} FROM draws JOIN numbered ON rank = drawn))""",
    )


def _suffix_flags() -> str:
    from hooklens.plans.signal_queries import SUFFIX_FLAGS  # the SQL lives with the flag queries

    return SUFFIX_FLAGS


_FEEDBACK = """
feedback AS (SELECT doc_id::VARCHAR AS id,
  CASE WHEN doc_id % 13 <> 0 THEN CASE toxic WHEN 1 THEN 'phishing' WHEN 0 THEN 'ham' END END AS label_true,
  CASE WHEN doc_id % 3 = 0 AND doc_id % 2 = 1 THEN 'case "' || doc_id || '"' END AS context
  FROM labels WHERE doc_id IS NOT NULL)"""


def oracle() -> dict[str, str]:
    m, raw = sql.MESSAGES, sql.RAW_MAIL
    found = {
        "q_message_scan": sql.select(
            f"SELECT id, label, {_digest('subject', 'body')}, date, source, "
            f"{_digest('headers_raw', 'html')} FROM messages", m),
        "q_bad_labels": sql.select(
            "SELECT \"Spam/Ham\" AS label, count(*) AS n FROM raw_mail "
            "WHERE \"Spam/Ham\" NOT IN ('ham', 'phishing') GROUP BY 1", raw),
        "q_text_projection": sql.select(
            f"SELECT id, {_digest('text')} FROM (SELECT id, {sql.TEXT} AS text FROM messages)", m),
        "q_label_normalise": """
            WITH spelled AS (
              SELECT doc_id AS id, CASE WHEN doc_id % 17 = 0 THEN 'unknown'
                WHEN toxic = 1 THEN list_extract(['1', 'Spam', ' phishing '], (doc_id % 3 + 1)::INT)
                ELSE list_extract(['0', 'LEGIT', 'ham'], (doc_id % 3 + 1)::INT) END AS label FROM labels),
            named AS (SELECT *, CASE WHEN lower(trim(label)) IN ('phishing', 'spam', '1') THEN 'phishing'
                WHEN lower(trim(label)) IN ('ham', 'legit', '0') THEN 'ham' END AS label_name FROM spelled)
            SELECT id, label, label_name, (label_name = 'phishing')::INT AS y_true FROM named""",
        "q_corpus_ham": sql.select(
            _CORPUS.format(label="'ham'", digest=_digest("subject", "body"),
                           where="WHERE \"Spam/Ham\" = 'ham'"), raw),
        "q_corpus_relabel": sql.select(
            _CORPUS.format(label="CASE \"Spam/Ham\" WHEN 'ham' THEN 'ham' ELSE 'phishing' END",
                           digest=_digest("subject", "body"), where=""), raw),
        "q_corpus_phishing": sql.select(
            f"SELECT id, label, {_digest('subject', 'body')}, date FROM phish", m, _PHISHING),
        "q_corpus_merge": sql.select(
            f"SELECT id, label, {_digest('subject', 'body')}, date, source FROM merged",
            raw, _PHISHING,
            """ham AS (SELECT "Message ID" AS id, 'ham' AS label, coalesce("Subject", '') AS subject,
                 coalesce("Message", '') AS body, "Date" AS date FROM raw_mail WHERE "Spam/Ham" = 'ham'),
            placed AS (SELECT 0 AS part, row_number() OVER (ORDER BY date IS NULL, date, id) AS place,
                 label, subject, body, date, 'enron_ham' AS source FROM ham
               UNION ALL SELECT 1, id, label, subject, body, date, 'nazario_phish' FROM phish),
            merged AS (SELECT row_number() OVER (ORDER BY part, place) AS id, * EXCLUDE (part, place)
               FROM placed)"""),
        "q_class_distribution": sql.select(
            "SELECT label, source, count(*) AS n FROM messages WHERE label IS NOT NULL GROUP BY 1, 2", m),
        "q_test_size": sql.select(
            "SELECT min(n) AS smallest_class, CASE WHEN min(n) < 2 THEN 0.5::DOUBLE ELSE 0.2::DOUBLE END "
            "AS test_size FROM (SELECT count(*) AS n FROM messages WHERE label IS NOT NULL GROUP BY label)", m),
        "q_stratified_split": sql.select("SELECT id, label, split FROM split", m, sql.SPLIT),
        "q_test_subset": sql.select(
            f"SELECT id, {_digest('subject', 'body')} FROM messages "
            "WHERE id IN (SELECT id FROM split WHERE split = 'test')", m, sql.SPLIT),
        "q_sink_roundtrip": sql.select(
            "SELECT * FROM scores JOIN suffix_flags USING (id)", m, sql.SCORES, _suffix_flags()),
        "q_read_messages": sql.select(
            f"SELECT id, label, {_digest('subject', 'body')}, date, source, "
            f"{_digest('headers_raw', 'html')} FROM (SELECT * REPLACE (nullif(subject, '') AS subject, "
            "nullif(body, '') AS body, nullif(html, '') AS html) FROM messages WHERE label IS NOT NULL)", m),
        "q_csv_split": sql.select(
            """SELECT id, label, md5(s) AS subject_md5, md5('"x,"' || chr(10) || '"' || body || '"' || chr(13) || chr(10)) AS body_md5,
            md5(html) AS html_md5, md5(headers_raw) AS headers_raw_md5, s = '' AS empty_subject
            FROM (SELECT *, CASE id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE subject END AS s FROM messages)""", m),
        "q_feedback": sql.select("SELECT * FROM feedback", _FEEDBACK),
        "q_feedback_stream": sql.select(
            "SELECT * FROM feedback WHERE id IS NOT NULL AND label_true IS NOT NULL", _FEEDBACK),
        "q_synth_headers": sql.select(f"SELECT id, {sql.HEADERS_SQL} AS headers_raw FROM m1", m),
        "q_synth_html": sql.select(f"SELECT id, {sql.HTML_SQL} AS html FROM m1", m),
        "q_adversarial_expand": _expand_sql(),
    }
    for name, mode in (
        ("q_adv_redirect", "FN_redirect"), ("q_adv_strip_urls", "FN_semurl"),
        ("q_adv_newsletter", "FP_news"), ("q_adv_ptbr", "FP_ptbr"), ("q_adv_headers", "FP_headerok"),
    ):
        found[name] = _variant_sql(mode)
    return found
