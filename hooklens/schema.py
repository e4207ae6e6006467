"""Table schemas and the plan-time checks on them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


_KINDS = {"BIGINT": T.LongType(), "INT": T.IntegerType(), "STRING": T.StringType(), "DOUBLE": T.DoubleType()}


def _struct(spec: str) -> T.StructType:
    """Schema from `name KIND, ...`; unlike the DDL parser it needs no running session."""
    pairs = (field.split() for field in spec.split(","))
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in pairs])


# `date` stays text: mail dates come in any format and are only ever ordered as text.
MESSAGE = _struct(
    "id BIGINT, label STRING, subject STRING, body STRING, date STRING, source STRING, "
    "headers_raw STRING, html STRING"
)
SCORING_REQUEST = _struct("id STRING, subject STRING, body STRING, headers_raw STRING, html STRING")
PREDICTION = _struct("id BIGINT, y_true INT, score DOUBLE")
FEEDBACK = _struct("id STRING, label_true STRING, context STRING")

MAIL_CSV_COLUMNS = ("Message ID", "Subject", "Message", "Spam/Ham", "Date")
EXPERIMENT_COLUMNS = ("id", "label", "subject", "body", "date", "headers_raw", "html")
LABELS = ("ham", "phishing")


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Return `df` unchanged, or fail before any job runs when a column is missing."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}; present: {df.columns}")
    return df


def first_column(df: DataFrame, candidates: Sequence[str], required: bool = True) -> str | None:
    """First of the candidate names that the table has."""
    found = next((c for c in candidates if c in df.columns), None)
    if found is None and required:
        raise ValueError(f"none of the columns {list(candidates)} in {df.columns}")
    return found


def column_or(df: DataFrame, name: str | None, default: str | None = "") -> Column:
    """The named column as text with nulls replaced, or the default when it is absent."""
    if name is None or name not in df.columns:
        return F.lit(default).cast("string")
    column = F.col(f"`{name}`").cast("string")
    return column if default is None else F.coalesce(column, F.lit(default))
