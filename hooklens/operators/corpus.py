"""Corpus builders: labelled message tables from raw mail tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from hooklens.functions.text import label_name
from hooklens.lists import BODY_NAMES, DATE_NAMES, SUBJECT_NAMES
from hooklens.operators.ranking import with_row_number
from hooklens.schema import LABELS, MAIL_CSV_COLUMNS, column_or, first_column, require_columns

CORPUS_COLUMNS = ("id", "label", "subject", "body", "date")
MERGED_COLUMNS = (*CORPUS_COLUMNS, "source")


def date_order(date: str = "date", unique: str = "id") -> list[Column]:
    """Order by date text with missing dates last, then by a unique column."""
    return [F.col(date).isNull(), F.col(date), F.col(unique)]


def _mail_columns(df: DataFrame, label: Column) -> DataFrame:
    return df.select(
        F.col("`Message ID`").alias("id"),
        label.alias("label"),
        column_or(df, "Subject").alias("subject"),
        column_or(df, "Message").alias("body"),
        F.col("Date").alias("date"),
    )


def ham_corpus(raw: DataFrame) -> DataFrame:
    """Legitimate messages of a raw ham/spam table. Order is left to the writer."""
    require_columns(raw, MAIL_CSV_COLUMNS)
    return _mail_columns(raw.filter(F.col("`Spam/Ham`") == "ham"), F.lit("ham"))


def relabelled_corpus(raw: DataFrame, check: bool = True) -> DataFrame:
    """All messages of a raw ham/spam table with `spam` renamed to `phishing`."""
    require_columns(raw, MAIL_CSV_COLUMNS)
    label = F.when(F.col("`Spam/Ham`") == "ham", "ham").when(
        F.col("`Spam/Ham`") == "spam", "phishing"
    )
    if check:
        bad = raw.filter(label.isNull()).select("`Spam/Ham`").limit(1).collect()
        if bad:
            raise ValueError(f"unexpected value in Spam/Ham: {bad[0][0]!r}")
    return _mail_columns(raw, label)


def ordered_corpus(corpus: DataFrame) -> DataFrame:
    """Corpus in its published order: date text, then id (a range shuffle, no single task)."""
    return corpus.orderBy(*date_order())


def phishing_corpus(raw: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Phishing messages from a table whose column names are found by candidates.

    Ids are positions from 0 in the given order; it must end in a unique column.
    """
    subject = first_column(raw, SUBJECT_NAMES, required=False)
    body = first_column(raw, BODY_NAMES)
    date = first_column(raw, DATE_NAMES, required=False)
    ordered = raw.select(
        F.lit("phishing").alias("label"),
        column_or(raw, subject).alias("subject"),
        column_or(raw, body).alias("body"),
        column_or(raw, date, None).alias("date"),
        *[c.alias(f"_o{i}") for i, c in enumerate(order)],
    )
    keys = [F.col(f"_o{i}") for i in range(len(order))]
    return with_row_number(ordered, keys, "id", start=0).select(*CORPUS_COLUMNS)


def merged_corpus(
    ham: DataFrame,
    phishing: DataFrame,
    ham_source: str = "enron_ham",
    phishing_source: str = "nazario_phish",
) -> DataFrame:
    """Both corpora with a source tag and new ids from 1, ham first."""
    for part in (ham, phishing):
        require_columns(part, ("label", "subject", "body", "date"))
    both = ham.select(*CORPUS_COLUMNS, F.lit(ham_source).alias("source"), F.lit(0).alias("_part"))
    both = both.unionByName(
        phishing.select(*CORPUS_COLUMNS, F.lit(phishing_source).alias("source"), F.lit(1).alias("_part"))
    )
    # ham keeps its date order, phishing its position; both parts are unique by id
    position = [
        F.col("_part"),
        F.when(F.col("_part") == 0, F.col("date").isNull()),
        F.when(F.col("_part") == 0, F.col("date")),
        F.col("id"),
    ]
    keyed = both.withColumns({f"_k{i}": c for i, c in enumerate(position)}).drop("id")
    keys = [F.col(f"_k{i}") for i in range(len(position))]
    return with_row_number(keyed, keys, "id").select(*MERGED_COLUMNS)


def normalised_labels(df: DataFrame, column: str = "label") -> DataFrame:
    """Add `label_name` (ham, phishing) and `y_true` (0, 1) for any accepted spelling."""
    name = label_name(F.col(column))
    return df.withColumns({"label_name": name, "y_true": (name == "phishing").cast("int")})


def unexpected_labels(df: DataFrame, allowed: Sequence[str] = LABELS) -> DataFrame:
    """Distinct labels outside the allowed set, a missing one included, with their counts."""
    return (
        df.filter(F.col("label").isNull() | ~F.col("label").isin(*allowed))
        .groupBy("label")
        .agg(F.count("*").alias("n"))
    )


def require_labels(df: DataFrame, allowed: Sequence[str] = LABELS) -> DataFrame:
    """Return `df` unchanged, or fail when it has a label outside the allowed set."""
    bad = unexpected_labels(df, allowed).limit(5).collect()
    if bad:
        raise ValueError(f"unexpected labels: {sorted(str(r['label']) for r in bad)}")
    return df


def in_test_set(messages: DataFrame, predictions: DataFrame) -> DataFrame:
    """Messages that a prediction table covers."""
    return messages.join(predictions.select("id"), "id", "left_semi")
