"""Thresholds, curves, confusion, reports, robustness, error analysis, ablation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hooklens import lists
from hooklens.models.linear import sigmoid
from hooklens.operators import curves as C, errors as E, metrics as M
from hooklens.operators.corpus import in_test_set
from hooklens.operators.flags import robustness_flags
from hooklens.operators.split import stratified_split
from hooklens.plans import sql, views
from hooklens.plans.signal_queries import PREFIX_FLAGS, excerpt
from hooklens.session import fresh_dir, written
from hooklens.sources.readers import read_metrics
from hooklens.sources.writers import flat_metrics_documents, metrics_documents, write_metrics_json

THRESHOLD = 0.5
BY = ("experiment",)
METRIC_COLUMNS = (
    "threshold", "precision_plus", "recall_plus", "f1_plus", "pr_auc", "roc_auc", "tp", "fp", "tn", "fn",
)


def _rounded(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(
        *[F.round(n, places).alias(n) if t == "double" else F.col(n) for n, t in df.dtypes]
    )


def confusion(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(M.confusion(views.experiment_predictions(spark, sf), THRESHOLD, BY))


def class_report(spark: SparkSession, sf: str) -> DataFrame:
    counts = M.confusion(views.experiment_predictions(spark, sf), THRESHOLD, BY)
    return _rounded(M.class_report(counts, BY))


def pr_curve(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(C.pr_curve(views.experiment_predictions(spark, sf), BY))


def roc_curve(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(C.roc_curve(views.experiment_predictions(spark, sf), BY))


def auc(spark: SparkSession, sf: str) -> DataFrame:
    areas = C.curve_areas(views.scores(spark, sf))
    return _rounded(areas.select("pr_auc", "roc_auc"))


def curve_area(spark: SparkSession, sf: str) -> DataFrame:
    areas = C.curve_areas(views.experiment_predictions(spark, sf), BY)
    return _rounded(areas.select("experiment", "pr_trapezoid", F.col("roc_auc").alias("roc_trapezoid")))


def threshold(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(C.select_threshold(views.experiment_predictions(spark, sf), by=BY))


def threshold_next(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(
        C.select_threshold(views.experiment_predictions(spark, sf), alignment="next", by=BY)
    )


def threshold_maxf1(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(C.threshold_max_f1(views.experiment_predictions(spark, sf), by=BY))


def _summary(spark: SparkSession, sf: str) -> DataFrame:
    return M.metrics_summary(views.experiment_predictions(spark, sf), BY)


def metrics_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_summary(spark, sf))


def ablation(spark: SparkSession, sf: str) -> DataFrame:
    return M.ablation(_summary(spark, sf))


def metrics_json(spark: SparkSession, sf: str) -> DataFrame:
    """Summary and report rows written as one JSON record per experiment and read back."""
    path = fresh_dir(spark, "metrics")
    split = written(stratified_split(views.labelled(spark, sf, "id", "label")), "split")
    summary = M.with_training_counts(_summary(spark, sf), split)
    write_metrics_json(metrics_documents(summary, M.class_report(summary, BY)), path)
    back = read_metrics(spark, path, name_from="folder")
    return _rounded(back.drop("notes"))


def metrics_flat(spark: SparkSession, sf: str) -> DataFrame:
    """Summary rows written as flat records and read back; the note names the choice."""
    path = fresh_dir(spark, "metrics")
    write_metrics_json(flat_metrics_documents(_summary(spark, sf)), path)
    back = read_metrics(spark, path, name_from="folder")
    kept = ("experiment", *METRIC_COLUMNS, "support_plus", "support_minus")
    return _rounded(back.select(*kept, F.get_json_object("notes", "$.mode").alias("mode")))


def _flags(spark: SparkSession, sf: str) -> DataFrame:
    """Flags of the messages that have a prediction; the others' text is not looked at."""
    columns = ("id", "subject", "body", "headers_raw")
    tested = in_test_set(views.messages(spark, sf, *columns), views.scores(spark, sf))
    return robustness_flags(tested, "prefix")


def robustness(spark: SparkSession, sf: str) -> DataFrame:
    return M.robustness(views.scores(spark, sf), _flags(spark, sf), THRESHOLD)


def _typed(spark: SparkSession, sf: str) -> DataFrame:
    headers = views.messages(spark, sf, "id", "headers_json")
    return E.error_typology(views.scores(spark, sf), _flags(spark, sf), headers, THRESHOLD)


def error_typology(spark: SparkSession, sf: str) -> DataFrame:
    return _typed(spark, sf).select("id", "y_true", "score", "y_pred", "hdr_auth_ok", "tipo")


def error_counts(spark: SparkSession, sf: str) -> DataFrame:
    return E.error_counts(_typed(spark, sf))


def error_examples(spark: SparkSession, sf: str) -> DataFrame:
    # typed rows are narrow and read three times: written once, the texts behind them are read once
    path = fresh_dir(spark, "typed")
    _typed(spark, sf).write.parquet(path)
    texts = views.messages(spark, sf, "id", "subject", "body")
    return E.error_examples(spark.read.parquet(path), texts, THRESHOLD)


def near_miss(spark: SparkSession, sf: str) -> DataFrame:
    return E.near_misses(_typed(spark, sf), THRESHOLD).select("id", "y_true", "score", "tipo")


def class_weights(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(M.class_weights(views.labelled(spark, sf, "id", "label")))


def sigmoid_scores(spark: SparkSession, sf: str) -> DataFrame:
    margin = F.col("score") * 4.0 - 2.0
    return _rounded(views.scores(spark, sf).withColumn("score", sigmoid(margin)))


QUERIES = {
    "q_confusion": confusion,
    "q_class_report": class_report,
    "q_pr_curve": pr_curve,
    "q_roc_curve": roc_curve,
    "q_auc": auc,
    "q_curve_area": curve_area,
    "q_threshold": threshold,
    "q_threshold_next": threshold_next,
    "q_threshold_maxf1": threshold_maxf1,
    "q_metrics_summary": metrics_summary,
    "q_metrics_json": metrics_json,
    "q_metrics_flat": metrics_flat,
    "q_ablation": ablation,
    "q_robustness": robustness,
    "q_error_typology": error_typology,
    "q_error_counts": error_counts,
    "q_error_examples": error_examples,
    "q_near_miss": near_miss,
    "q_class_weights": class_weights,
    "q_sigmoid_scores": sigmoid_scores,
}

_POINTS = (sql.EXPERIMENTS, sql.points("experiments", "experiment"))
_COUNTS = f"""
counts AS (SELECT experiment,
  count(*) FILTER (y_true = 1 AND score >= {THRESHOLD}) AS tp, count(*) FILTER (y_true = 0 AND score >= {THRESHOLD}) AS fp,
  count(*) FILTER (y_true = 0 AND score < {THRESHOLD}) AS tn, count(*) FILTER (y_true = 1 AND score < {THRESHOLD}) AS fn
  FROM experiments GROUP BY 1)"""


def _report(counts: str) -> str:
    per = (
        f"SELECT experiment, 'ham' AS class, {sql.ratio('tn', 'tn + fn')} AS precision, {sql.ratio('tn', 'tn + fp')} AS recall, "
        f"{sql.ratio('2 * tn', '2 * tn + fn + fp')} AS f1, tn + fp AS support FROM {counts} UNION ALL "
        f"SELECT experiment, 'phishing', {sql.ratio('tp', 'tp + fp')}, {sql.ratio('tp', 'tp + fn')}, "
        f"{sql.ratio('2 * tp', '2 * tp + fp + fn')}, tp + fn FROM {counts}"
    )
    return f"""
per AS ({per}),
report AS (SELECT * FROM per
  UNION ALL SELECT experiment, 'accuracy', {sql.ratio('tp + tn', 'tp + fp + tn + fn')}, {sql.ratio('tp + tn', 'tp + fp + tn + fn')},
    {sql.ratio('tp + tn', 'tp + fp + tn + fn')}, tp + fp + tn + fn FROM {counts}
  UNION ALL SELECT experiment, 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::BIGINT FROM per GROUP BY 1
  UNION ALL SELECT experiment, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1 * support) / sum(support), sum(support)::BIGINT FROM per GROUP BY 1)"""


def _chosen(floor: float | None, suffix: str = "") -> str:
    """Best point per experiment by the documented order."""
    reaches = "false" if floor is None else f"recall{suffix} >= {floor}::DOUBLE"
    return f"""
best AS (SELECT * FROM (
  SELECT *, {reaches} AS reaches, row_number() OVER (PARTITION BY experiment ORDER BY ({reaches}) DESC,
    CASE WHEN {reaches} THEN precision{suffix} ELSE 0.0 END DESC, f1{suffix} DESC, threshold) AS place FROM pts)
  WHERE place = 1)"""


_MODE = "CASE WHEN reaches THEN 'recall_floor' ELSE 'maxF1_fallback' END AS mode"
_AREAS = """
areas AS (SELECT experiment, sum(pos * precision) / any_value(n_pos) AS pr_auc,
  sum((fpr - fpr_up) * (tpr + tpr_up) / 2) AS roc_auc,
  sum((recall - recall_up) * (precision + precision_up) / 2) AS pr_trapezoid FROM pts GROUP BY 1)"""
_SUMMARY = """
summary AS (SELECT experiment, threshold, precision AS precision_plus, recall AS recall_plus, f1 AS f1_plus,
  pr_auc, roc_auc, tp, fp, n_neg - fp AS tn, n_pos - tp AS fn, n_pos + n_neg AS n_test,
  CASE WHEN reaches THEN 'recall_floor' ELSE 'maxF1_fallback' END AS mode FROM best JOIN areas USING (experiment))"""
_SUMMARY_VIEWS = (*_POINTS, _chosen(0.9), _AREAS, _SUMMARY)
_ROUNDED = "threshold, precision_plus, recall_plus, f1_plus, pr_auc, roc_auc".split(", ")
_SIX = ", ".join(f"round({n}, 6) AS {n}" for n in _ROUNDED)

_TYPED = f"""
typed AS (SELECT s.id AS id, y_true, score, (score >= {THRESHOLD})::INT AS y_pred, f.* EXCLUDE (id, label),
    coalesce(json_valid(headers_json) AND starts_with(trim(headers_json), '{{') AND contains(lower(headers_json), 'spf')
      AND contains(lower(headers_json), 'dkim') AND contains(lower(headers_json), 'dmarc')
      AND contains(lower(headers_json), 'pass'), false) AS hdr_auth_ok
  FROM scores s JOIN prefix_flags f ON f.id = s.id JOIN messages m ON m.id = s.id),
judged AS (SELECT *, CASE
    WHEN y_true = 0 AND y_pred = 1 AND ptbr_likely THEN 'FP_ptbr'
    WHEN y_true = 0 AND y_pred = 1 AND NOT headers_missing AND hdr_auth_ok THEN 'FP_header_ok'
    WHEN y_true = 0 AND y_pred = 1 THEN 'FP_newsletter'
    WHEN y_true = 1 AND y_pred = 0 AND no_url THEN 'FN_sem_url'
    WHEN y_true = 1 AND y_pred = 0 AND (redirector_url OR shortened_url) THEN 'FN_redirect_chain'
    WHEN y_true = 1 AND y_pred = 0 THEN 'FN_compromised_domain' ELSE 'OK' END AS tipo FROM typed)"""
_ERRORS = (sql.MESSAGES, sql.SCORES, PREFIX_FLAGS, _TYPED)


def oracle() -> dict[str, str]:
    near = f"""near AS (SELECT * REPLACE (CASE WHEN y_true = 1 THEN 'FN_quase' ELSE 'FP_quase' END AS tipo)
        FROM judged WHERE abs(score - {THRESHOLD}::DOUBLE) <= 0.05::DOUBLE)"""
    notes = ", ".join(f"({', '.join(sql.q(v) for v in row)})" for row in lists.ERROR_NOTES)
    scenarios = " UNION ALL ".join(
        f"""SELECT {i} AS i, {sql.q(title)} AS scenario, '{flag}' AS flag, count(*) AS n,
        count(*) FILTER (y_true = 1 AND y_pred = 1) AS tp, count(*) FILTER (y_true = 0 AND y_pred = 1) AS fp,
        count(*) FILTER (y_true = 1 AND y_pred = 0) AS fn FROM judged WHERE {flag}"""
        for i, (title, flag) in enumerate(lists.SCENARIOS)
    )
    t = excerpt()
    deltas = ", ".join(
        f"round(a.{n} - b.{n}, 4) AS delta_{n}" for n in ("precision_plus", "recall_plus", "f1_plus", "pr_auc")
    )
    return {
        "q_confusion": sql.select(
            f"""SELECT *, round({sql.ratio('tp', 'tp + fp')}, 6) AS precision, round({sql.ratio('tp', 'tp + fn')}, 6) AS recall,
            round({sql.ratio('2 * tp', '2 * tp + fp + fn')}, 6) AS f1 FROM counts""", sql.EXPERIMENTS, _COUNTS),
        "q_class_report": sql.select(
            "SELECT experiment, class, round(precision, 6) AS precision, round(recall, 6) AS recall, "
            "round(f1, 6) AS f1, support FROM report", sql.EXPERIMENTS, _COUNTS, _report("counts")),
        "q_pr_curve": sql.select(
            "SELECT experiment, round(threshold, 6) AS threshold, tp, fp, round(precision, 6) AS precision, "
            "round(recall, 6) AS recall FROM pts", *_POINTS),
        "q_roc_curve": sql.select(
            "SELECT experiment, round(threshold, 6) AS threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr "
            "FROM pts", *_POINTS),
        "q_auc": sql.select(
            """SELECT round(sum(pos * precision) / any_value(n_pos), 6) AS pr_auc,
            round(sum((fpr - fpr_up) * (tpr + tpr_up) / 2), 6) AS roc_auc FROM pts""",
            sql.SCORES, sql.points("scores")),
        "q_curve_area": sql.select(
            "SELECT experiment, round(pr_trapezoid, 6) AS pr_trapezoid, round(roc_auc, 6) AS roc_trapezoid "
            "FROM areas", *_POINTS, _AREAS),
        "q_threshold": sql.select(
            f"""SELECT experiment, round(threshold, 6) AS threshold, round(precision, 6) AS precision,
            round(recall, 6) AS recall, round(f1, 6) AS f1, {_MODE} FROM best""", *_POINTS, _chosen(0.9)),
        "q_threshold_next": sql.select(
            f"""SELECT experiment, round(threshold, 6) AS threshold, round(precision_up, 6) AS precision,
            round(recall_up, 6) AS recall, round(f1_up, 6) AS f1, {_MODE} FROM best""",
            *_POINTS, _chosen(0.9, "_up")),
        "q_threshold_maxf1": sql.select(
            "SELECT experiment, round(threshold, 6) AS threshold, round(f1_up, 6) AS f1, q50, q80 "
            "FROM best JOIN quant USING (experiment)", *_POINTS, _chosen(None, "_up"),
            """quant AS (SELECT experiment, round(quantile_cont(score, 0.5), 6) AS q50,
            round(quantile_cont(score, 0.8), 6) AS q80 FROM experiments GROUP BY 1)"""),
        "q_metrics_summary": sql.select(
            f"SELECT experiment, {_SIX}, tp, fp, tn, fn, n_test, mode FROM summary", *_SUMMARY_VIEWS),
        "q_metrics_json": sql.select(
            f"""SELECT experiment, {_SIX}, tp, fp, tn, fn, n_test, 0.2::DOUBLE AS test_size,
            0.9::DOUBLE AS recall_floor, ham - test_ham + phishing - test_phishing AS n_train, ham - test_ham AS train_ham,
            phishing - test_phishing AS train_phishing, test_ham, test_phishing, test_phishing AS support_plus,
            test_ham AS support_minus FROM summary, sizes""", *_SUMMARY_VIEWS,
            sql.SPLIT_SIZES),
        "q_metrics_flat": sql.select(
            f"""SELECT experiment, {_SIX}, tp, fp, tn, fn, tp + fn AS support_plus, tn + fp AS support_minus, mode
            FROM summary""", *_SUMMARY_VIEWS),
        "q_ablation": sql.select(
            f"""SELECT a.experiment || ' − E0' AS comparison, {deltas},
            printf('Limiar %s=%.4f; E0=%.4f', a.experiment, a.threshold, b.threshold) AS notes
            FROM summary a, summary b WHERE b.experiment = 'E0' AND a.experiment <> 'E0'""", *_SUMMARY_VIEWS),
        "q_robustness": sql.select(
            f"""SELECT scenario, flag || ' == True' AS description, 'F1+' AS metric,
            CASE WHEN n = 0 THEN 'NA' ELSE round({sql.ratio('2 * tp', '2 * tp + fp + fn')}, 4)::VARCHAR END AS value,
            CASE WHEN n = 0 THEN 'N=0' ELSE printf('N=%d; Recall+=%.4f; Precision+=%.4f; t=%.4f', n,
              {sql.ratio('tp', 'tp + fn')}, {sql.ratio('tp', 'tp + fp')}, {THRESHOLD}::DOUBLE) END AS notes FROM sc""",
            *_ERRORS, f"sc AS ({scenarios})"),
        "q_error_typology": sql.select(
            "SELECT id, y_true, score, y_pred, hdr_auth_ok, tipo FROM judged", *_ERRORS),
        "q_error_counts": sql.select("SELECT tipo, count(id) AS n FROM judged GROUP BY 1", *_ERRORS),
        "q_error_examples": sql.select(
            """SELECT id, tipo, CASE WHEN length(t) > 220 THEN substr(t, 1, 220) || '…' ELSE t END AS example,
            missing_signal, mitigation FROM shown""",
            *_ERRORS, near,
            f"notes(tipo, missing_signal, mitigation) AS (VALUES {notes})",
            """firsts AS (SELECT id, tipo FROM (SELECT id, tipo, row_number() OVER (PARTITION BY tipo ORDER BY id) AS place
                 FROM judged WHERE tipo <> 'OK') WHERE place <= 3)""",
            f"""chosen AS (SELECT id, tipo, missing_signal, mitigation FROM firsts JOIN notes USING (tipo)
              UNION ALL SELECT id, tipo,
                CASE WHEN redirector_url OR shortened_url OR no_url THEN {sql.q(lists.NEAR_MISS_URL_SIGNAL)}
                  WHEN NOT headers_missing AND hdr_auth_ok THEN {sql.q(lists.NEAR_MISS_HEADER_SIGNAL)}
                  ELSE {sql.q(lists.NEAR_MISS_OTHER_SIGNAL)} END,
                CASE WHEN starts_with(tipo, 'FN_') THEN {sql.q(lists.NEAR_MISS_FN_MITIGATION)}
                  ELSE {sql.q(lists.NEAR_MISS_FP_MITIGATION)} END
              FROM (SELECT * FROM near WHERE (SELECT count(*) FROM firsts) = 0 ORDER BY id LIMIT 6)),
            shown AS (SELECT chosen.*, {t} AS t FROM chosen JOIN messages ON messages.id = chosen.id)"""),
        "q_near_miss": sql.select("SELECT id, y_true, score, tipo FROM near", *_ERRORS, near),
        "q_class_weights": sql.select(
            """SELECT label, count(*) AS n, round((SELECT count(*) FROM messages WHERE label IS NOT NULL)
            / (2.0::DOUBLE * count(*)), 6) AS weight FROM messages WHERE label IS NOT NULL GROUP BY 1""", sql.MESSAGES),
        "q_sigmoid_scores": sql.select(
            "SELECT id, y_true, round(1.0::DOUBLE / (1.0::DOUBLE + exp(-(score * 4.0::DOUBLE - 2.0::DOUBLE))), 6) "
            "AS score FROM scores", sql.SCORES),
    }
