"""From raw documents to token ids, in five stages.

Each stage works on all that the stage before kept, is written as Parquet and read again for the next.
All stages but the last return the columns of `documents`.

1. quality: documents that a quality rule rejects go.
2. near_duplicates: of each component of near copies the document with the smallest id stays. Rows that
   share an id stay or go together; rows without an id stay.
3. secrets: every secret found becomes `[SECRET]`; `n_chars` follows. No document goes.
4. mixture: documents are sampled by their calibrated probabilities. A cell wanted more than whole is kept whole;
   lowering the rate until none is would leave a third of the documents.
5. tokens: byte-level BPE ids, and whether decoding them gives the text back.

Null text counts as empty (and is rejected in the first stage, having no words). Columns other than those of
`documents` are left behind by the first stage; a stage's own columns never clash with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from hooklens.llm import bytebpe, jaccard, mixing, quality, secrets
from hooklens.llm.common import table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Share of all tokens to keep, and how far each dimension is moved to equal shares (1: not at all, 0: fully).
RATE = 0.85
POWERS = {"source": 0.8, "lang": 0.8, "topic": 0.9}

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.passing(docs.select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    grouped = jaccard.near_duplicates(docs.select("doc_id", "text"))
    first = grouped.filter("component_id = doc_id").select("doc_id").distinct()
    later = grouped.filter("component_id < doc_id").select("doc_id").join(first, "doc_id", "left_anti").distinct()
    return docs.join(written(later, "later-copies"), "doc_id", "left_anti").select(*COLUMNS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = secrets.scan_documents(docs.select(*COLUMNS))
    clean = found.withColumn("text", secrets.masked(F.col("text"), F.col("spans")))
    n_chars = F.when(F.size("spans") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", n_chars).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs.select(*COLUMNS), targets=POWERS, rate=RATE).filter("sampled").select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # written, so that no executor holds workers of both steps at once; zstd, as the table holds texts and ids
    encoded = bytebpe.encode(docs.select("doc_id", "source", "lang", "text"), offsets=False).drop("n_split")
    encoded = written(encoded, "encoded", compression="zstd")
    decoded = bytebpe.decode(encoded)
    text = F.coalesce("text", F.lit("")).cast("binary")
    return decoded.select(
        "doc_id", "source", "lang", "n_tokens", F.col("ids_packed").alias("ids"),
        (F.col("decoded") == text).alias("exact"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secrets", secret_scan),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: SQL has neither the components of the second stage nor the merges of the last; tests use plain Python instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for all of `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
