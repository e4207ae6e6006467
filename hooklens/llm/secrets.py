"""Secret scans over an incremental ledger of blobs.

A text version is addressed by its content (SHA-256). The ledger says which pairs of blob and
rule version have been scanned and what was found; a scan reads only pairs it does not hold,
each once, however many paths share the blob, and findings are then joined back to every path.
A third of all rows may be one text: repeated blobs fold into one row per task before the
shuffle, and only blobs with findings take part in the join back to the paths.

Null text counts as empty; repeated rows each get their findings. Nothing runs outside column
expressions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from hooklens.llm.common import bind, drop_columns, written
from hooklens.llm.components import HOT

#: In this order spans sort by start, then kind.
SPAN = "struct<start:int,kind:int,end:int>"


@dataclass(frozen=True)
class SecretRule:
    """A kind of secret. A match counts when capture `group` has `least` characters or more.

    A failing match still uses up its characters, as matches are leftmost and do not overlap.
    `hint` is a cheap pattern that every text with a match contains.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    hint: str | None = None


@dataclass(frozen=True)
class RuleSet:
    version: str
    rules: tuple[SecretRule, ...]


#: Fixed patterns of the base kinds. A run of the required length is looked for at once where this
#: cannot move a match: the run is greedy, and nothing else of the pattern may fail after it.
BASE = RuleSet("base-1", (
    SecretRule(
        "assign",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=1, least=6, hint=r"(?i:password|passwd|secret|token|api_?key)",
    ),
    SecretRule("access", r"AKIA[A-Z0-9]{16,}", hint="AKIA"),
    SecretRule("hex", r"[0-9a-f]{24,}"),
))

#: A key ends at its END line or, without one, with its last line of key characters. Line breaks may be written as \\n.
PEM = (
    r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----(?:[A-Za-z0-9+/=\\ \t\r\n:,-]*?-----END [A-Z ]{0,40}PRIVATE KEY-----"
    r"|(?:(?:\\[nr]|[ \t\r\n])++[A-Za-z0-9+/]{16,}+=*+)*+(?:(?:\\[nr]|[ \t\r\n])++[A-Za-z0-9+/]++=++)?+)"
)

EXTRA = RuleSet("extra-2", (
    SecretRule("pem", PEM, hint="PRIVATE KEY-----"),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", hint="eyJ"),
    SecretRule("hub", r"gh[pousr]_[A-Za-z0-9]{36,}", hint="gh[pousr]_"),
    SecretRule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", hint="xox"),
    SecretRule("basic", r"[a-z][a-z0-9+.-]{1,20}://[^\s/:@]+:[^\s/:@]+@", hint="://"),
))

RULE_SETS = (BASE, EXTRA)


def kinds(rule_sets: Sequence[RuleSet] = RULE_SETS) -> list[str]:
    return [r.kind for rules in rule_sets for r in rules.rules]


def rule_spans(text: Column, rule: SecretRule, number: int) -> Column:
    """Spans of a rule as structs (start, kind number, end), in code points, end exclusive.

    The pieces between the matches and the matches themselves alternate, so running sums of
    their lengths are the positions.
    """
    pattern = F.lit(rule.pattern)

    def place(found: Column) -> Column:
        gaps = F.split(text, rule.pattern, -1)
        inner = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
        parts = F.arrays_zip(
            F.transform(found, lambda x: F.length(x)).alias("m"),
            F.transform(gaps, lambda x: F.length(x)).alias("g"),
            F.transform(inner, lambda x: F.length(x)).alias("c"),
        )
        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))

        def step(acc: Column, x: Column) -> Column:
            begin = acc["at"] + x["g"]
            end = begin + x["m"]
            span = F.struct(begin.alias("start"), F.lit(number).alias("kind"), end.alias("end"))
            kept = F.when(x["c"] >= rule.least, F.array_append(acc["spans"], span)).otherwise(acc["spans"])
            # the last piece has no match after it
            return F.struct(
                F.coalesce(end, acc["at"]).alias("at"),
                F.coalesce(kept, acc["spans"]).alias("spans"),
            )

        return F.aggregate(parts, start, step, lambda acc: acc["spans"])

    empty = F.array().cast(f"array<{SPAN}>")
    there = text.rlike(rule.hint or rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    return F.when(there, bind(found, lambda m: place(m))).otherwise(empty)


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def update_ledger(
    paths: DataFrame, rule_sets: Sequence[RuleSet] = RULE_SETS, ledger: DataFrame | None = None,
    text: str = "text",
) -> DataFrame:
    """New ledger rows `blob, rule_version, spans` for the pairs that `ledger` does not hold.

    `paths` is any table of text versions, current and historical. Rows of blobs without findings
    are kept, with no spans: they say that the pair need not be scanned again. The result is lazy;
    append it to the ledger table.
    """
    blobs = paths.select(blob_id(F.col(text)).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # a blob folds into one row before anything is joined to it; the join reuses that shuffle
    blobs = blobs.dropDuplicates(["blob"])
    none = F.array().cast("array<string>")
    if ledger is None:
        blobs = blobs.withColumn("_known", none)
    else:
        versions = [r.version for r in rule_sets]
        known = ledger.filter(F.col("rule_version").isin(versions)).groupBy("blob").agg(
            F.collect_set("rule_version").alias("_known")
        )
        blobs = blobs.join(known, "blob", "left").withColumn("_known", F.coalesce("_known", none))
        blobs = blobs.filter(F.size("_known") < len(versions))
    found, first = [], 0
    for rules in rule_sets:
        spans = F.sort_array(F.concat(*[
            rule_spans(F.col("text"), r, first + i) for i, r in enumerate(rules.rules)
        ]))
        entry = F.struct(F.lit(rules.version).alias("rule_version"), spans.alias("spans"))
        found.append(F.when(~F.array_contains("_known", rules.version), entry))
        first += len(rules.rules)
    rows = blobs.select("blob", F.explode_outer(F.array(*found)).alias("_e"))
    return rows.filter(F.col("_e").isNotNull()).select("blob", "_e.*")


def findings(
    paths: DataFrame, ledger: DataFrame, rule_sets: Sequence[RuleSet] = RULE_SETS, text: str = "text"
) -> DataFrame:
    """Add `spans` of all given rule sets to every path, by blob. Runs jobs when called."""
    versions = [r.version for r in rule_sets]
    hits = ledger.filter(F.col("rule_version").isin(versions) & (F.size("spans") > 0))
    # one row per blob and version, a bounded few for each blob
    by_blob = hits.groupBy("blob").agg(F.sort_array(F.flatten(F.collect_set("spans"))).alias("spans"))
    rows = drop_columns(paths, "spans", "_blob").withColumn("_blob", blob_id(F.col(text)))
    hits_of = written(by_blob.withColumnRenamed("blob", "_blob"), "hits")
    # a text of more than 1/HOT of all rows: fewer than HOT such texts, whose rows stay where they are
    copies = rows.groupBy("_blob").agg(F.count("*").alias("_c"))
    often = written(copies.filter(F.col("_c") * HOT > rows.count()).select("_blob"), "often")
    if often.isEmpty():
        joined = rows.join(hits_of, "_blob", "left")
    else:
        there = F.broadcast(often)
        hot = rows.join(there, "_blob", "left_semi").join(F.broadcast(hits_of.join(there, "_blob", "left_semi")), "_blob", "left")
        joined = hot.unionByName(rows.join(there, "_blob", "left_anti").join(hits_of, "_blob", "left"))
    return joined.withColumn(
        "spans", F.coalesce("spans", F.array().cast(f"array<{SPAN}>"))
    ).drop("_blob")


def scan_documents(
    paths: DataFrame, rule_sets: Sequence[RuleSet] = RULE_SETS, ledger: DataFrame | None = None,
    text: str = "text",
) -> DataFrame:
    """Scan what is new, write it as ledger rows and add `spans` to every path.

    Runs its jobs when called: the new ledger rows and the blobs with findings are written to the shared folder.
    """
    new = written(update_ledger(paths, rule_sets, ledger, text), "secret-ledger")
    whole = new if ledger is None else ledger.select("blob", "rule_version", "spans").unionByName(new)
    return findings(paths, whole, rule_sets, text)


def span_list(spans: Column, names: Sequence[str]) -> Column:
    """`kind:start:end` of all spans, comma-joined."""
    named = F.array(*[F.lit(n) for n in names])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(named, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def masked(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with every span, and overlapping ones together, replaced by the mask."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, s: Column) -> Column:
        before = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        grown = F.when(
            (s["start"] >= acc["at"]) & ((acc["at"] == 0) | (s["start"] > acc["at"])),
            F.concat(acc["parts"], F.array(before, F.lit(mask))),
        ).otherwise(acc["parts"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), grown.alias("parts"))

    rest = lambda acc: F.concat(
        F.array_join(acc["parts"], ""), F.substring(text, acc["at"] + 1, F.length(text))
    )
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, rest)).otherwise(text)
