"""Quality rules: a threshold table compiled into one projection.

Every metric and every rule is a column expression over the text of the row; there is no
shuffle, no function of ours runs in a task, and a hot source or repeated text changes
nothing. A null text counts as an empty one. A rule whose metric is null (a ratio over no
words) does not fail. Rows that repeat are judged each on their own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from hooklens.llm.common import WORD, bind, drop_columns

WINDOW = 5

#: Frequent function words of the languages in use; fixed values.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "it", "for", "with", "was", "on", "are", "by", "this", "be", "or",
    "de", "la", "le", "et", "les", "des", "en", "un", "une", "du", "que", "est", "pour", "qui", "dans", "sur", "par",
    "el", "los", "las", "y", "del", "se", "con", "una", "su", "para", "al", "lo",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "nicht",
)


@dataclass(frozen=True)
class Rule:
    """Reject a document when `metric` is below `low` or above `high`, if it has `min_words` words."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None
    min_words: int = 0


BASE_RULES = (
    Rule("few_words", "n_words", low=10),
    Rule("repeated_windows", "repeat_percent", high=20),
)

METHOD_RULES = (
    Rule("short_words", "mean_word_chars", low=2.0),
    Rule("long_words", "mean_word_chars", high=25.0),
    Rule("symbols", "symbols_per_word", high=0.25),
    Rule("duplicate_lines", "dup_line_ratio", high=0.6, min_words=20),
    Rule("stop_words", "stop_word_ratio", low=0.01, min_words=80),
    Rule("bullets", "bullet_line_ratio", high=0.9, min_words=20),
    Rule("ellipses", "ellipsis_line_ratio", high=0.5, min_words=20),
    Rule("shouting", "exclaimed_ratio", high=0.5),
)


def repeated_window_words(words: Column, size: int = WINDOW) -> Column:
    """How many words lie in a window of `size` words that occurs at least twice in the array.

    Windows are compared by 64-bit hashes of their words. Only a text with a repeated window pays
    for sorting them: equal neighbours give the positions, whose gaps give the covered words.
    """

    def windows(hashes: Column) -> Column:
        at = lambda i, k: F.get(hashes, i + k)
        return F.transform(
            F.sequence(F.lit(0), F.size(hashes) - size),
            lambda i: F.xxhash64(*[at(i, k) for k in range(size)]),
        )

    def covered(found: Column) -> Column:
        pairs = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        repeated = bind(
            pairs,
            lambda s: F.filter(
                s,
                lambda x, k: ((k > 0) & F.get(s, k - 1)["h"].eqNullSafe(x["h"]))
                | F.get(s, k + 1)["h"].eqNullSafe(x["h"]),
            ),
        )
        places = F.sort_array(F.transform(repeated, lambda x: x["i"]))
        start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("words"))
        step = lambda a, p: F.struct(
            (p + size).alias("end"), (a["words"] + p + size - F.greatest(a["end"], p)).alias("words")
        )
        return F.aggregate(places, start, step, lambda a: a["words"])

    counted = lambda found: F.when(
        F.size(F.array_distinct(found)) < F.size(found), covered(found)
    ).otherwise(0)
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(
        F.size(words) > size, bind(hashed, lambda hashes: bind(windows(hashes), counted))
    ).otherwise(0)


def metrics(text: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """A struct of all metrics of a text."""
    text = F.coalesce(text, F.lit(""))
    stops = [v for w in dict.fromkeys(stop_words) for v in (w, w.capitalize())]
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("bigint")

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
            F.size(F.filter(words, lambda w: w.isin(stops))).cast("bigint").alias("n_stop_words"),
            repeated_window_words(words).cast("bigint").alias("n_repeat_words"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("bigint").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
            F.size(F.filter(lines, lambda x: x.rlike(r"^\s*(?:[-*•]|\d+[.)])\s"))).cast("bigint").alias("n_bullet_lines"),
            F.size(F.filter(lines, lambda x: x.rlike(r"(?:\.\.\.|…)\s*$"))).cast("bigint").alias("n_ellipsis_lines"),
        )

    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    return F.struct(
        bind(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), of_words).alias("words"),
        bind(lines, of_lines).alias("lines"),
        count(r"[#*$%&|<>]").alias("n_symbols"),
        count(r"!!").alias("n_exclaimed"),
    )


def with_metrics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the metric columns. Columns of these names, in any case, are replaced."""
    names = (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "repeat_percent",
        "mean_word_chars", "symbols_per_word", "dup_line_ratio", "stop_word_ratio", "bullet_line_ratio",
        "ellipsis_line_ratio", "exclaimed_ratio",
    )
    rows = drop_columns(docs, *names, "_metrics").withColumn("_metrics", metrics(F.col(text)))
    made = named_metrics(F.col("_metrics"))
    return rows.select(*[c for c in rows.columns if c != "_metrics"], *[v.alias(k) for k, v in made.items()])


def named_metrics(m: Column) -> dict[str, Column]:
    """The metric columns of a struct of metrics."""
    words, lines = m["words"], m["lines"]
    over = lambda a, b: F.when(b > 0, a.cast("double") / b)
    n, n_lines = words["n_words"], lines["n_lines"]
    return {
        "n_words": n,
        "word_chars": words["word_chars"],
        "n_symbols": m["n_symbols"],
        "n_dup_lines": lines["n_dup_lines"],
        "n_repeat_words": words["n_repeat_words"],
        # whole percents never round across a limit: 100 * repeated > limit * words is exact in integers
        "repeat_percent": over(words["n_repeat_words"] * 100, n),
        "mean_word_chars": over(words["word_chars"], n),
        "symbols_per_word": over(m["n_symbols"], n),
        "dup_line_ratio": over(lines["n_dup_lines"], n_lines),
        "stop_word_ratio": over(words["n_stop_words"], n),
        "bullet_line_ratio": over(lines["n_bullet_lines"], n_lines),
        "ellipsis_line_ratio": over(lines["n_ellipsis_lines"], n_lines),
        "exclaimed_ratio": over(m["n_exclaimed"], n),
    }


def failed(rule: Rule, values: Mapping[str, Column] | None = None) -> Column:
    of = F.col if values is None else values.__getitem__
    metric = of(rule.metric)
    bad = F.lit(False)
    if rule.low is not None:
        bad = bad | (metric < rule.low)
    if rule.high is not None:
        bad = bad | (metric > rule.high)
    if rule.min_words:
        bad = bad & (of("n_words") >= rule.min_words)
    return F.coalesce(bad, F.lit(False))


def passing(docs: DataFrame, text: str = "text", rules: Sequence[Rule] | None = None) -> DataFrame:
    """The documents that no rule rejects, as they are.

    A filter on a computed column moves below the projection and takes the computation along for every use. The
    verdict is therefore one value of a generator, which no filter passes: the metrics are made once a text.
    """
    rules = (*BASE_RULES, *METHOD_RULES) if rules is None else rules

    def verdict(m: Column) -> Column:
        values = named_metrics(m)
        return ~F.array_contains(F.array(F.lit(False), *[failed(r, values) for r in rules]), True)

    rows = docs.select("*", F.explode_outer(F.array(bind(metrics(F.col(text)), verdict))).alias("_passes"))
    return rows.filter("_passes").drop("_passes")


def judge(
    docs: DataFrame,
    text: str = "text",
    base_rules: Sequence[Rule] = BASE_RULES,
    method_rules: Sequence[Rule] = METHOD_RULES,
) -> DataFrame:
    """Add the metrics, `base_failed`, `failed_rules` (names, in table order) and `kept`."""
    rows = drop_columns(with_metrics(docs, text), "base_failed", "failed_rules", "kept")
    any_of = lambda rules: F.array_contains(F.array(F.lit(False), *[failed(r) for r in rules]), True)
    every = [*base_rules, *method_rules]
    names = F.filter(
        F.array(*[F.when(failed(r), F.lit(r.name)) for r in every]), lambda x: x.isNotNull()
    )
    return rows.withColumns({
        "base_failed": any_of(base_rules), "failed_rules": names, "kept": ~any_of(every),
    })
