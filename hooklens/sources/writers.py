"""Writers. Tables are written as many part files, never squeezed into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hooklens.schema import FEEDBACK, LABELS, PREDICTION, require_columns


def write_table(df: DataFrame, path: str, format: str = "parquet", mode: str = "overwrite") -> None:
    """Write as parquet, CSV with a header, or JSON lines. CSV cannot hold arrays and maps:
    those columns are written as JSON text."""
    if format == "csv":
        nested = [f.name for f in df.schema.fields if f.dataType.typeName() in ("array", "map", "struct")]
        flat = df.withColumns({c: F.to_json(c) for c in nested}) if nested else df
        # white space at the ends of a value belongs to it
        flat.write.mode(mode).options(
            header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        ).csv(path)
    else:
        df.write.mode(mode).format(format).save(path)


def write_predictions(df: DataFrame, path: str, format: str = "parquet") -> None:
    require_columns(df, PREDICTION.fieldNames())
    write_table(df.select(*PREDICTION.fieldNames()), path, format)


def metrics_documents(summary: DataFrame, report: DataFrame | None = None) -> DataFrame:
    """Nested metrics records (`experiment`, `best`, `report`) from flat summary rows.

    Training counts are in the record where the summary has them (`with_training_counts`).
    """
    fields = [
        F.col("threshold"),
        F.col("precision_plus").alias("precision_at_thr"),
        F.col("recall_plus").alias("recall_at_thr"),
        F.col("f1_plus").alias("f1_plus_at_thr"),
        F.col("pr_auc").alias("average_precision"),
        *map(F.col, ("roc_auc", "n_test", "tp", "fp", "tn", "fn")),
    ]
    if "n_train" in summary.columns:
        fields += [F.col(c) for c in ("n_train", "test_size", "recall_floor")]
        fields += [
            F.struct(*[F.col(f"{part}_{label}").alias(label) for label in LABELS]).alias(f"class_distribution_{part}")
            for part in ("test", "train")
        ]
    nested = summary.select("experiment", F.struct(*fields).alias("best"))
    if report is None:
        return nested
    # five rows per experiment
    row = F.struct("class", "precision", "recall", "f1", "support")
    listed = report.groupBy("experiment").agg(F.sort_array(F.collect_list(row)).alias("report"))
    return nested.join(listed, "experiment")


def flat_metrics_documents(summary: DataFrame) -> DataFrame:
    """Flat metrics records, supports and the note on the threshold choice included."""
    names = {
        "Limiar": "threshold", "Precision+": "precision_plus", "Recall+": "recall_plus",
        "F1+": "f1_plus", "PR-AUC": "pr_auc", "AUROC": "roc_auc",
        "TP": "tp", "FP": "fp", "TN": "tn", "FN": "fn",
    }
    note = F.to_json(F.struct("mode", F.col("precision_plus").alias("precision"), F.col("recall_plus").alias("recall")))
    return summary.select(
        "experiment",
        *[F.col(c).alias(n) for n, c in names.items()],
        (F.col("tp") + F.col("fn")).alias("Suporte+"),
        (F.col("tn") + F.col("fp")).alias("Suporte-"),
        note.alias("Notas"),
    )


def write_metrics_json(documents: DataFrame, path: str) -> None:
    """One JSON record per experiment, in a folder named after it."""
    named = documents.withColumn("name", F.col("experiment"))
    named.write.mode("overwrite").partitionBy("name").json(path)


def append_feedback(spark: SparkSession, records: DataFrame, path: str) -> None:
    """Append feedback records as JSON lines."""
    require_columns(records, ("id", "label_true"))
    context = F.col("context") if "context" in records.columns else F.lit(None).cast("string")
    rows = records.select(F.col("id").cast("string"), "label_true", context.alias("context"))
    rows.write.mode("append").option("ignoreNullFields", False).json(path)


def read_feedback(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FEEDBACK).json(path)
