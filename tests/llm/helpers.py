"""Small tables and plain Python versions of the contracts."""

from __future__ import annotations

import hashlib
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def lower(text: str | None) -> str:
    """A-Z only."""
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def documents(spark, rows):
    """Rows of (doc_id, text, lang, source)."""
    full = [(i, t, l, s, None if t is None else len(t)) for i, t, l, s in rows]
    return spark.createDataFrame(full, DOC_SCHEMA)


#: Nulls in every column, empty, blank, long, tied and repeated rows.
HARD = [
    (0, "one two three four five six seven", "en", "a"),
    (1, None, "en", "a"),
    (2, "", None, None),
    (3, " \t\n ", "fr", "b"),
    (4, "İstanbul ÉTÉ naïve 日本 🙂🙂 é́ <|endoftext|>", None, "b"),
    (5, "same same same\nsame same same\n\nsame", "en", None),
    (5, "same same same\nsame same same\n\nsame", "en", None),
    (6, "word " * 9000 + "end", "de", "a"),
    (None, "a row without an id but with ten words in it now", "en", "a"),
    (7, "x" * 70000, "en", "a"),
    (8, "one two three four five six seven", "en", "a"),
]
