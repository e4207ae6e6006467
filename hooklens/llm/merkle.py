"""Merkle manifest of a table of documents, its leaves placed by bitmap ranks.

Every row is a leaf, SHA-256 over its columns. The leaves of a source ascend by id; while several nodes remain,
each run of `FAN` = 16 consecutive ones becomes its hash. What remains is the source's subroot; the subroots, by
source, give the root in the same way.

Leaves are never sorted. The ids of a source are a bitmap, merged from partial ones into words of 64 bits (words
without a bit are not stored). A word knows its rows (its popcount, plus the extra rows of repeated ids), and so do
three directories above it, of 2^25, 2^44 and all ids: the running counts inside a directory, at most 2^20 narrow
entries, add up to the rank of a word's first id. A leaf's slot is that offset and the popcount below its own bit.
Slots are the keys from then on: a level is reduced by grouping slots 16 by 16.

Rows with one id (and all rows without an id, which come first) are placed among themselves by the leading 60 bits
of their digest, and equal ones by their row's number, each by the same ranks; so no id is too frequent. A null
source comes first and is a source of its own. An empty table gives no rows. Extra columns are not read; `doc_id`,
`source`, `lang`, `n_chars` and `text` must be there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from hooklens.llm.common import written
from hooklens.llm.components import HOT, lookup
from hooklens.operators.ranking import with_row_number

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Bits below each directory level; the lowest is a word of 64 ids.
SHIFTS = (6, 25, 44)

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def digest(parts: Column) -> Column:
    return F.unhex(F.sha2(parts.cast("binary"), 256))


def _hex(value: Column) -> Column:
    return F.lower(F.hex(value))


def leaf(fields: Sequence[Column]) -> Column:
    """Digest of fields, each `-` if null, else its UTF-8 length, a colon and its value."""
    texts = [c.cast("string") for c in fields]
    return digest(F.concat(*[F.coalesce(F.concat(F.octet_length(t), F.lit(":"), t), F.lit("-")) for t in texts]))


# --- places by rank ------------------------------------------------------------------------------------


def _word(value: Column) -> Column:
    return F.shiftright(value, SHIFTS[0])


def _bit(value: Column) -> Column:
    return value.bitwiseAND(F.lit(63)).cast("int")


def _running(rows: DataFrame, within: list[str], digit: str) -> DataFrame:
    """`_before`: rows of the earlier entries of the same directory."""
    earlier = W.partitionBy(*within).orderBy(digit).rowsBetween(W.unboundedPreceding, -1)
    return rows.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))


def bitmap(rows: DataFrame, group: list[str], value: str) -> DataFrame:
    """`group, _h, _w, _bits, _more, _n, _offset, _total`: the words of each group's bitmap with their offsets.

    `_h` tells nulls (false, first) from values, `_w` is the word's number, `_more` the extra rows of repeated
    values, `_n` the word's rows, `_total` the group's.
    """
    v = F.coalesce(value, F.lit(0)).cast("bigint")
    has = F.col(value).isNotNull()
    counts = rows.groupBy(*group, has.alias("_h"), v.alias("_v")).agg(F.count("*").alias("_c"))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), _bit(F.col("_v")))
    extra = F.when(F.col("_c") > 1, F.struct(_bit(F.col("_v")).alias("bit"), (F.col("_c") - 1).alias("more")))
    words = written(
        counts.groupBy(*group, "_h", _word(F.col("_v")).alias("_w")).agg(
            F.bit_or(one).alias("_bits"), F.collect_list(extra).alias("_more"), F.sum("_c").alias("_n")
        ), "words",
    )
    # counts upwards, a directory entry for each prefix
    levels = [words.select(*group, "_h", "_w", "_n")]
    for low, high in zip(SHIFTS, SHIFTS[1:]):
        prefix = F.shiftright("_w", high - low).alias("_w")
        levels.append(levels[-1].groupBy(*group, "_h", prefix).agg(F.sum("_n").alias("_n")))
    sides = levels[-1].groupBy(*group, "_h").agg(F.sum("_n").alias("_n"))
    # offsets downwards
    whole = F.sum("_n").over(W.partitionBy(*group)).alias("_total")
    above = _running(sides, group, "_h").select(*group, "_h", F.col("_before").alias("_offset"), whole)
    above = above.withColumn("_u", F.lit(0).cast("bigint"))
    steps = [high - low for low, high in zip(SHIFTS, SHIFTS[1:])]
    for level, step in zip(reversed(levels), [None, *reversed(steps)]):
        up = F.lit(0).cast("bigint") if step is None else F.shiftright("_w", step)
        inner = _running(level.withColumn("_u", up), [*group, "_h", "_u"], "_w")
        offset = (F.col("_offset") + F.col("_before")).alias("_offset")
        above = inner.join(above, [*group, "_h", "_u"]).select(*group, "_h", "_w", offset, "_total")
        above = above.withColumnRenamed("_w", "_u")
    return words.join(above.withColumnRenamed("_u", "_w"), [*group, "_h", "_w"])


def ranked(rows: DataFrame, group: list[str], value: str) -> DataFrame:
    """Rows with `_rank` (rows of their group with a smaller value), `_same` (with an equal one) and `_total`."""
    total = rows.count()
    words = written(bitmap(rows, group, value), "bitmap")
    v = F.coalesce(value, F.lit(0)).cast("bigint")
    keyed = rows.withColumns({"_h": F.col(value).isNotNull(), "_w": _word(v), "_bit": _bit(v)})
    placed = lookup(keyed, words, [*group, "_h", "_w"], F.col("_n") * HOT > total)
    below = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("bigint"), F.col("_bit")))
    count = F.bit_count(F.col("_bits").bitwiseAND(below)).cast("bigint")
    more = lambda keep: F.aggregate(
        F.filter("_more", keep), F.lit(0).cast("bigint"), lambda a, x: a + x["more"]
    )
    return placed.withColumns({
        "_rank": F.col("_offset") + count + more(lambda x: x["bit"] < F.col("_bit")),
        "_same": more(lambda x: x["bit"] == F.col("_bit")) + 1,
    }).drop("_h", "_w", "_bit", "_bits", "_more", "_n", "_offset")


def slots(leaves: DataFrame) -> DataFrame:
    """Leaves with `slot` (from 0 inside their source) and `n`, the leaves of the source.

    `leaves` has `key` (the source), `doc_id`, `digest` and `row`, a number of its own.
    """
    sixty = F.conv(F.substring(F.hex("digest"), 1, 15), 16, 10).cast("bigint")
    todo = leaves.withColumns({"_base": F.lit(0).cast("bigint"), "_lead": sixty})
    group, done = ["key"], None
    for value in ("doc_id", "_lead", "row"):
        found = ranked(todo, group, value)
        if value != "doc_id":
            found = found.drop("_total")
        found = written(
            found.withColumn("_base", F.col("_base") + F.col("_rank")).drop("_rank").withColumnRenamed(
                "_total", "n"), "ranked",
        )
        settled = found.filter("_same = 1").drop("_same", "_lead", "_has", "_id").withColumnRenamed("_base", "slot")
        done = settled if done is None else done.unionByName(settled)
        todo = found.filter("_same > 1").drop("_same")
        if todo.isEmpty():
            return done
        if value == "doc_id":
            # null ids are a value here
            todo = todo.withColumns({"_has": F.col("doc_id").isNotNull(), "_id": F.coalesce("doc_id", F.lit(0))})
            group = [*group, "_has", "_id"]
        else:
            group = [*group, value]
    return done


# --- levels --------------------------------------------------------------------------------------------


def _levels(nodes: DataFrame, most: int, kept: Sequence[str] = ()) -> tuple[list[DataFrame], list[DataFrame]]:
    """Runs and lone nodes of each level of the trees of `key, slot, n, digest`.

    A run is `key, up, n, run`: up to FAN nodes by slot, the ones of the lowest level with the columns `kept`.
    A lone node is its tree's root. `most` is the largest n.
    """
    runs, lone = [], []
    while True:
        lone.append(nodes.filter("n = 1"))
        if most <= 1:
            return runs, lone
        node = F.struct("slot", "digest", *kept)
        found = nodes.filter("n > 1").groupBy("key", F.expr(f"slot div {FAN}").alias("up")).agg(
            F.first("n").alias("n"), F.sort_array(F.collect_list(node)).alias("run")
        )
        runs.append(written(found, "runs"))
        joined = F.array_join(F.transform("run", lambda x: _hex(x["digest"])), "")
        # not written: sixteen digests make one
        nodes = runs[-1].select(
            "key", F.col("up").alias("slot"), F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"), digest(joined).alias("digest")
        )
        most, kept = -(-most // FAN), ()


_TAIL = "array<struct<l: binary, r: binary>>"


def _siblings(run: Column, place: Column) -> Column:
    """The digests of a run left and right of a place, each as one binary."""
    of = lambda part: F.unhex(F.array_join(F.transform(part, lambda x: F.hex(x["digest"])), ""))
    return F.struct(of(F.slice(run, F.lit(1), place)).alias("l"), of(F.slice(run, place + 2, F.lit(FAN))).alias("r"))


def _descend(runs: list[DataFrame], lone: list[DataFrame], crown: DataFrame) -> DataFrame:
    """`key, slot, tail, crown columns` of the second-lowest level's nodes: their siblings on the way up.

    `crown` has `key, tail` and more for each tree, for its root.
    """
    more = [c for c in crown.columns if c not in ("key", "tail")]
    tails = None
    for level in range(len(lone) - 1, 0, -1):
        top = lone[level].select("key", "slot").join(crown, "key")
        if tails is None:
            tails = top
            continue
        each = runs[level].join(tails.withColumnRenamed("slot", "up"), ["key", "up"]).select(
            "key", "run", "tail", *more, F.posexplode("run").alias("_at", "_node")
        )
        tail = F.concat(F.array(_siblings(F.col("run"), F.col("_at"))), "tail").cast(_TAIL)
        tails = each.select("key", F.col("_node.slot").alias("slot"), tail.alias("tail"), *more).unionByName(
            top.select("key", "slot", "tail", *more)
        )
    return tails


def _trees(nodes: DataFrame, most: int, crown_of, kept: Sequence[str]) -> DataFrame:
    """Every lowest node with its own siblings and its parent's tail: `l, r` (hex text), `tail`, crown columns, `kept`.

    `crown_of` makes the crown from all roots `key, digest`. A lone lowest node has null `l` and `r`.
    """
    runs, lone = _levels(nodes, most, kept)
    roots = lone[0].select("key", "digest")
    for level in lone[1:]:
        roots = roots.unionAll(level.select("key", "digest"))
    crown = crown_of(written(roots, "roots"))
    more = [c for c in crown.columns if c not in ("key", "tail")]
    single = lone[0].join(crown, "key").select(
        "key", "slot", "digest", *kept, "tail", *more, F.lit(None).cast("string").alias("l"), F.lit(None).cast("string").alias("r")
    )
    if not runs:
        return single
    above = _descend(runs, lone, crown).withColumnRenamed("slot", "up")
    # what a run's nodes share is made before they are taken apart
    run = runs[0].join(above, ["key", "up"]).withColumn("_hexes", F.transform("run", lambda x: _hex(x["digest"])))
    each = run.select("key", "tail", *more, "_hexes", F.posexplode("run").alias("_at", "_node"))
    before = F.array_join(F.slice("_hexes", F.lit(1), F.col("_at")), "")
    after = F.array_join(F.slice("_hexes", F.col("_at") + 2, F.lit(FAN)), "")
    return each.select(
        "key", F.col("_node.slot").alias("slot"), F.col("_node.digest").alias("digest"),
        *[F.col(f"_node.{c}").alias(c) for c in kept], "tail", *more, before.alias("l"), after.alias("r"),
    ).unionByName(single)


def source_crown(roots: DataFrame) -> DataFrame:
    """`key, tail, subroot, root` of every source from the sources' subroots `key, digest`."""
    count = roots.count()
    numbered = with_row_number(roots, [F.col("key")], "slot", start=0)
    nodes = numbered.select(
        F.lit("").alias("key"), "slot", F.lit(count).cast("bigint").alias("n"), "digest", F.col("key").alias("source_key")
    )

    def top(root: DataFrame) -> DataFrame:
        return root.select("key", F.array().cast(_TAIL).alias("tail"), F.col("digest").alias("root"))

    found = _trees(nodes, count, top, ["source_key"])
    own = F.struct(F.unhex("l").alias("l"), F.unhex("r").alias("r"))
    tail = F.when(F.col("l").isNull(), F.col("tail")).otherwise(F.concat(F.array(own), "tail"))
    return found.select(F.col("source_key").alias("key"), tail.cast(_TAIL).alias("tail"), F.col("digest").alias("subroot"), "root")


def manifest(leaves: DataFrame) -> DataFrame:
    """Leaves `key, doc_id, digest, changed, row` with their tree, proof and check.

    Returns `doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`. `folded_root` is made from
    `changed`, or the leaf's own digest where that is null, and the original siblings. Runs jobs when called.
    """
    placed = slots(leaves)
    most = placed.agg(F.max("n")).first()[0] or 0
    crowned = lambda roots: written(source_crown(roots), "crown")
    found = _trees(placed.select("key", "slot", "n", "digest", "doc_id", "changed"), most, crowned, ["doc_id", "changed"])
    sides = F.transform("tail", lambda t: F.struct(_hex(t["l"]).alias("l"), _hex(t["r"]).alias("r")))
    each = found.withColumn("tail", sides)
    shared = F.array_join(F.transform("tail", lambda t: F.concat(t["l"], t["r"])), "")
    start = _hex(F.coalesce("changed", "digest"))
    sha = lambda *parts: F.sha2(F.concat(*parts).cast("binary"), 256)
    first = F.when(F.col("l").isNull(), start).otherwise(sha("l", start, "r"))
    return each.select(
        "doc_id", _hex(F.col("digest")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"),
        _hex(F.col("root")).alias("root"),
        sha(F.coalesce("l", F.lit("")), F.coalesce("r", F.lit("")), shared).alias("proof_sha256"),
        F.aggregate("tail", first, lambda a, t: sha(t["l"], a, t["r"])).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def document_leaves(docs: DataFrame, changed: Column | None = None, touched: Column | None = None) -> DataFrame:
    """`key, doc_id, digest, changed, row` of documents, written once.

    `changed` is the text of a tampered copy for the rows that `touched` tells; their digest is in `changed`.
    """
    fields = [F.col(c) for c in FIELDS]
    other = F.lit(None).cast("binary") if changed is None else F.when(touched, leaf([*fields[:-1], changed]))
    key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit(""))
    return written(
        docs.select(
            key.alias("key"), F.col("doc_id").cast("bigint").alias("doc_id"), leaf(fields).alias("digest"),
            other.alias("changed"), F.monotonically_increasing_id().alias("row"),
        ), "leaves",
    )


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def build(docs: DataFrame, changed: Column | None = None, touched: Column | None = None) -> DataFrame:
    """`manifest` of a table of documents."""
    return manifest(document_leaves(docs, changed, touched))
