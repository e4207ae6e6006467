"""Readers with explicit schemas; nothing is inferred from the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from hooklens import schema as S
from hooklens.functions.text import label_name, text_projection
from hooklens.operators.corpus import require_labels
from hooklens.operators.rules import FALLBACK_THRESHOLD
from hooklens.sources.csv_split import read_csv_split


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header by Spark's own reader, one task a file; quoted fields may span lines and double their
    quotes. An empty field, quoted or not, is null. `read_csv_split` reads a large file by many tasks."""
    reader = spark.read.options(header=True, multiLine=True, escape='"')
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def read_messages(
    spark: SparkSession, path: str, format: str = "parquet", check_labels: bool = True
) -> DataFrame:
    """Labelled message table with the columns the experiments need."""
    if format == "csv":
        # names come from the file; a quoted empty field is null, as an empty one is
        raw = read_csv_split(spark, path, empty_as_null=True)
    else:
        raw = spark.read.format(format).load(path)
    S.require_columns(raw, S.EXPERIMENT_COLUMNS)
    kinds = {f.name: f.dataType for f in S.MESSAGE.fields}
    typed = raw.select(*[F.col(c).cast(kinds[c]).alias(c) if c in kinds else c for c in raw.columns])
    return require_labels(typed) if check_labels else typed


def labelled_texts(df: DataFrame) -> DataFrame:
    """`text, label` from a table with a text column or with subject and body."""
    mode = "sms" if "text" in df.columns else "email"
    known = label_name(F.col("label"))
    label = F.coalesce(known, F.lower(F.col("label").cast("string")))
    return df.select(text_projection(mode).alias("text"), label.alias("label"))


def read_metrics(spark: SparkSession, path: str, name_from: str = "file") -> DataFrame:
    """Flat metrics table from JSON files in either of the two layouts.

    The experiment is named by the file (the part before the first underscore), or by the
    folder as `write_metrics_json` lays them out.
    """
    # every field of both layouts is named, so absent ones read as null
    flat = "Limiar DOUBLE, `Precision+` DOUBLE, `Recall+` DOUBLE, `F1+` DOUBLE, `PR-AUC` DOUBLE, " \
        "AUROC DOUBLE, TP BIGINT, FP BIGINT, TN BIGINT, FN BIGINT, `Suporte+` BIGINT, `Suporte-` BIGINT, Notas STRING"
    nested = (
        "best STRUCT<threshold: DOUBLE, precision_at_thr: DOUBLE, recall_at_thr: DOUBLE, "
        "f1_plus_at_thr: DOUBLE, average_precision: DOUBLE, roc_auc: DOUBLE, tp: BIGINT, "
        "fp: BIGINT, tn: BIGINT, fn: BIGINT, n_train: BIGINT, n_test: BIGINT, test_size: DOUBLE, "
        "recall_floor: DOUBLE, class_distribution_test: STRUCT<ham: BIGINT, phishing: BIGINT>, "
        "class_distribution_train: STRUCT<ham: BIGINT, phishing: BIGINT>>"
    )
    # a row whose JSON names differ only by case (TP and tp) sits at different levels
    raw = spark.read.schema(f"{flat}, {nested}").option("multiLine", True).json(path)
    if name_from == "folder":
        stem = F.regexp_extract(F.col("_metadata.file_path"), r"/name=([^/]+)/", 1)
    else:
        stem = F.regexp_extract(F.col("_metadata.file_name"), r"^([^_.]+)", 1)
    pairs = {
        "threshold": ("Limiar", "threshold"),
        "precision_plus": ("Precision+", "precision_at_thr"),
        "recall_plus": ("Recall+", "recall_at_thr"),
        "f1_plus": ("F1+", "f1_plus_at_thr"),
        "pr_auc": ("PR-AUC", "average_precision"),
        "roc_auc": ("AUROC", "roc_auc"),
        "tp": ("TP", "tp"),
        "fp": ("FP", "fp"),
        "tn": ("TN", "tn"),
        "fn": ("FN", "fn"),
    }
    return raw.select(
        F.upper(stem).alias("experiment"),
        *[F.coalesce(F.col(f"`{a}`"), F.col(f"best.{b}")).alias(n) for n, (a, b) in pairs.items()],
        *[F.col(f"best.{n}").alias(n) for n in ("n_train", "n_test", "test_size", "recall_floor")],
        *[
            F.col(f"best.class_distribution_{part}.{label}").alias(f"{part}_{label}")
            for part in ("train", "test") for label in S.LABELS
        ],
        F.coalesce(F.col("`Suporte+`"), F.col("best.class_distribution_test.phishing")).alias("support_plus"),
        F.coalesce(F.col("`Suporte-`"), F.col("best.class_distribution_test.ham")).alias("support_minus"),
        F.col("Notas").alias("notes"),
    )


def stored_threshold(metrics: DataFrame, experiment: str, default: float = FALLBACK_THRESHOLD) -> float:
    """Decision threshold of an experiment in a metrics table; the default where it has none."""
    found = metrics.filter(F.col("experiment") == experiment).agg(F.max("threshold")).first()[0]
    return default if found is None else found
