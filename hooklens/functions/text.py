"""Text projection, normalisation and marker expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Unicode white space, as a pattern class body and as trim characters.
WHITE = (
    r"\s\x0B\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WHITE_CHARS = "".join(
    chr(c)
    for c in (
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
        0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
)
NON_ASCII = r"[^\x00-\x7F]"
TOKEN = r"[\p{L}\p{N}_]{2,}"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value computed once per row, however often the body uses it.

    Lambda bodies are evaluated per element, and a column used inside one is evaluated with it; bound to a
    lambda variable it is a plain look-up.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def unnest(df: DataFrame, kept: Sequence[str], array: Column, value: str, pos: str | None = None) -> DataFrame:
    """One row per array element; rows with an empty or null array vanish.

    The outer form is used because for the inner one the optimizer infers a filter on the
    array, pushes it below the columns the array is made of, and evaluates them twice.
    Arrays must not hold nulls.
    """
    made = F.posexplode_outer(array).alias(pos, value) if pos else F.explode_outer(array).alias(value)
    return df.select(*kept, made).filter(F.col(value).isNotNull())


def blank(column: Column | str) -> Column:
    """Null as the empty string."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def strip(column: Column) -> Column:
    """Trim every kind of white space, not only the blank."""
    return F.trim(column, F.lit(WHITE_CHARS))


def message_text(subject: Column | str = "subject", body: Column | str = "body") -> Column:
    """Subject and body as one trimmed text."""
    return strip(F.concat(blank(subject), F.lit(" "), blank(body)))


def text_projection(mode: str = "email") -> Column:
    """Text of a mail (`email`: subject and body) or of a short message (`sms`: text)."""
    if mode == "email":
        return message_text()
    if mode == "sms":
        return strip(blank("text"))
    raise ValueError(f"unknown mode {mode!r}")


def has_non_ascii(column: Column) -> Column:
    return column.rlike(NON_ASCII)


def contains_any(column: Column, tokens: Sequence[str]) -> Column:
    """True when at least one token occurs; a chain of JVM substring tests, no regex."""
    return reduce(lambda a, b: a | b, (F.contains(column, F.lit(t)) for t in tokens), F.lit(False))


def label_name(column: Column) -> Column:
    """Any accepted spelling of a label as `ham` or `phishing`; others become null."""
    text = F.lower(F.trim(column.cast("string")))
    return F.when(text.isin("phishing", "spam", "1"), F.lit("phishing")).when(
        text.isin("ham", "legit", "0"), F.lit("ham")
    )


def label_number(column: Column) -> Column:
    """Any accepted spelling of a label as 1 (phishing) or 0."""
    return (label_name(column) == "phishing").cast("int")


def tokens(text: Column) -> Column:
    """Lower-case word tokens of two or more characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))
