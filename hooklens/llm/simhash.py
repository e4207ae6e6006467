"""SimHash near-duplicates by deletion-variant signatures.

A text's fingerprint has a bit set where more than half of its shingle hashes have it. Two fingerprints of at
most `BITS` = 3 differing bits link. Cut into two halves, one half of such a pair differs by at most one bit
(3 < 2 + 2), so both fingerprints have the same half once that bit is a wildcard. Every half is therefore
indexed under its 32 one-wildcard variants, and fingerprints meet by equality of (half, wildcard, other bits).

Equal fingerprints are one node beforehand, however many documents share them. A bucket of more than `CROWD`
nodes is not compared as it is: its members are indexed again by the quarter variants of their other half, and
if need be by the eighth variants of what is left. Members of a bucket of the third level agree in all but 11
bits, so none has more than 2,048. Each level is exact, so nothing is capped. A pair is looked at once: under a
wildcard that it needs, or, where the segments are equal, under the first wildcard alone.

Inside a bucket the members that reach one another are told as a tree of few edges a node, not as all pairs.

Null or empty text has the fingerprint zero, which links like any other. Rows that repeat are documents of their
own. A row without an id links like any other, but its id is never the smallest; a component of such rows alone
has a null id. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hooklens.llm.common import written
from hooklens.llm.components import HOT, components, lookup

SHINGLE = 3
SEED = 42
BITS = 3
CROWD = 2048
_HASHES = 1 << 16  # hashes whose bits are counted at a time
_SLICE_BYTES = 4_000_000

_WORDS = re.compile(rb"[^\x20\x09-\x0d]+")


def fingerprint(text: bytes) -> int:
    """SimHash of a UTF-8 text, A-Z lower-cased: shingles of three words, repeats included."""
    import xxhash

    words = _WORDS.findall(text.lower())
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(SHINGLE, len(words))
    firsts, lasts = starts[: len(words) - width + 1], ends[width - 1 :]
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(firsts), _HASHES):
        pairs = zip(firsts[at : at + _HASHES].tolist(), lasts[at : at + _HASHES].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in pairs], dtype="<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(firsts), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`doc_id, fp` of batches of `doc_id, text` (binary), a text at a time."""
    for batch in batches:
        texts = batch.column(1)
        found = np.fromiter((fingerprint(t.as_py() or b"") for t in texts), dtype=np.uint64, count=len(texts))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """`doc_id, fp`: one 64-bit fingerprint for each document, as a signed integer."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(_fingerprints, "doc_id long, fp long")


# --- one-wildcard variants ----------------------------------------------------------------------------


def _variants(rows: DataFrame, value: Column, width: int) -> DataFrame:
    """Rows once for each wildcard bit of a value of 2 * width bits: the bit's number from the upper piece's
    first on (`_v`), and its piece with that bit 0 (`_piece`)."""
    each = rows.withColumn("_v", F.explode(F.sequence(F.lit(0), F.lit(2 * width - 1))))
    piece = F.when(F.col("_v") < width, F.shiftrightunsigned(value, width)).otherwise(value)
    wild = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_v") % width)
    kept = F.bitwise_not(wild).bitwiseAND(F.lit((1 << width) - 1))
    return each.withColumn("_piece", piece.bitwiseAND(kept))


def _rest(value: Column, width: int, variant: Column) -> Column:
    """The piece that a variant does not index."""
    mask = F.lit((1 << width) - 1)
    return F.when(variant < width, value).otherwise(F.shiftrightunsigned(value, width)).bitwiseAND(mask)


def _half_keys(nodes: DataFrame) -> DataFrame:
    """`key, sub, fp`: 64 keys of 6 + 32 bits for each fingerprint."""
    rows = _variants(nodes.select("fp"), F.col("fp"), 32)
    key = F.shiftleft(F.col("_v").cast("bigint"), 32).bitwiseOR(F.col("_piece"))
    return rows.select(key.alias("key"), F.lit(0).cast("bigint").alias("sub"), "fp")


def _quarter_keys(crowded: DataFrame) -> DataFrame:
    """Members of crowded buckets under 32 sub-keys of 5 + 16 bits of their other half."""
    other = _rest(F.col("fp"), 32, F.shiftright("key", 32))
    rows = _variants(crowded.withColumn("_o", other), F.col("_o"), 16)
    sub = F.shiftleft(F.col("_v").cast("bigint"), 16).bitwiseOR(F.col("_piece"))
    return rows.select("key", sub.alias("sub"), "fp")


def _eighth_keys(crowded: DataFrame) -> DataFrame:
    """Members of crowded sub-buckets under 16 sub-keys of 4 + 8 more bits."""
    other = _rest(F.col("fp"), 32, F.shiftright("key", 32))
    left = _rest(other, 16, F.shiftright("sub", 16))
    rows = _variants(crowded.withColumn("_o", left), F.col("_o"), 8)
    more = F.shiftleft(F.col("_v").cast("bigint"), 8).bitwiseOR(F.col("_piece"))
    return rows.select("key", F.shiftleft("sub", 12).bitwiseOR(more).alias("sub"), "fp")


def _wildcards(key: np.ndarray, sub: np.ndarray, level: int) -> np.ndarray:
    """The bits in which a pair of each bucket must differ: its wildcards other than the first of a segment."""
    need = np.zeros(len(key), dtype=np.uint64)
    one = np.uint64(1)

    def ask(variant: np.ndarray, width: int, base: np.ndarray) -> np.ndarray:
        """Add the wildcard of a segment that starts at bit `base`; the start of the segment's other half."""
        upper, bit = variant < width, variant % width
        place = base + np.where(upper, width, 0) + bit
        need[bit > 0] |= one << place[bit > 0].astype(np.uint64)
        return base + np.where(upper, 0, width)

    other = ask((key >> 32).astype(np.int64), 32, np.zeros(len(key), dtype=np.int64))
    if level == 2:
        ask(sub >> 16, 16, other)
    elif level == 3:
        ask((sub & 0xFFF) >> 8, 8, ask(sub >> 28, 16, other))
    return need


def _tree(fp: np.ndarray, need: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join the members which reach one another inside a bucket, at most three a member."""
    left, xs, ys = np.arange(len(fp)), [], []
    while len(left) > 1:
        group, todo, left = [int(left[0])], [int(left[0])], left[1:]
        while todo and len(left):
            apart = fp[left] ^ fp[todo.pop()]
            near = (np.bitwise_count(apart) <= BITS) & ((apart & need) == need)
            found = left[near].tolist()
            left = left[~near]
            group += found
            todo += found
        xs += [group[(i - 1) // 2] for i in range(1, len(group))]
        ys += group[1:]
    return fp[np.array(xs, dtype=np.int64)], fp[np.array(ys, dtype=np.int64)]


def _compare(key: np.ndarray, sub: np.ndarray, fp: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges of whole buckets (rows sorted by key), and a mask of the rows whose bucket is crowded."""
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (sub[1:] != sub[:-1])
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(key)))
    crowded = np.repeat((size > CROWD) & (level < 3), size)
    need = _wildcards(key[start], sub[start], level)
    varied = np.bitwise_or.reduceat(fp ^ np.repeat(fp[start], size), start) if len(start) else need
    open_ = (size > 1) & ((size <= CROWD) | (level == 3)) & (varied != 0) & ((varied & need) == need)
    pair = start[open_ & (size == 2)]
    apart = fp[pair] ^ fp[pair + 1]
    pair = pair[np.bitwise_count(apart) <= BITS]
    xs, ys = [fp[pair]], [fp[pair + 1]]
    for i in np.flatnonzero(open_ & (size > 2)):
        x, y = _tree(np.unique(fp[start[i] : start[i] + size[i]]), need[i])
        xs.append(x)
        ys.append(y)
    return np.concatenate(xs), np.concatenate(ys), crowded


def _linker(level: int):
    """Over rows `key, sub, fp` sorted by key: the edges (x, y) of each bucket, or its members (x, null) if crowded.

    At most one bucket of CROWD members is held between batches; a larger one passes through.
    """
    names = ["key", "sub", "x", "y"]

    def told(key, sub, fp, whole: int, passing) -> list[pa.RecordBatch]:
        k, s, f = key[:whole], sub[:whole], fp[:whole]
        goes_on = (k == passing[0]) & (s == passing[1]) if passing else np.zeros(whole, dtype=bool)
        x, y, crowded = _compare(k[~goes_on], s[~goes_on], f[~goes_on], level)
        out = []
        if len(x):
            none = pa.nulls(len(x), pa.int64())
            out.append(pa.RecordBatch.from_arrays([none, none, pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], names))
        member = goes_on.copy()
        member[~goes_on] = crowded
        if member.any():
            out.append(pa.RecordBatch.from_arrays([
                pa.array(k[member]), pa.array(s[member]), pa.array(f[member].view(np.int64)),
                pa.nulls(int(member.sum()), pa.int64()),
            ], names))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = sub = np.array([], dtype=np.int64)
        fp = np.array([], dtype=np.uint64)
        passing = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            key, sub = np.concatenate((key, columns[0])), np.concatenate((sub, columns[1]))
            fp = np.concatenate((fp, columns[2].view(np.uint64)))
            last = int(np.argmax((key == key[-1]) & (sub == sub[-1])))  # sorted: where the last bucket begins
            yield from told(key, sub, fp, last, passing)
            if passing != (key[-1], sub[-1]):
                passing = None
            key, sub, fp = key[last:], sub[last:], fp[last:]
            if level < 3 and (passing or len(key) > CROWD):
                passing = (key[-1], sub[-1])
                yield from told(key, sub, fp, len(key), passing)
                key, sub, fp = key[:0], sub[:0], fp[:0]
        yield from told(key, sub, fp, len(key), passing)

    return run


def _bucketed(keys: DataFrame, level: int) -> DataFrame:
    sorted_ = keys.repartition("key", "sub").sortWithinPartitions("key", "sub")
    return sorted_.mapInArrow(_linker(level), "key long, sub long, x long, y long")


def join_edges(nodes: DataFrame) -> DataFrame:
    """`x, y`: edges whose components are those of all links among the distinct fingerprints `fp`."""
    keys, edges = _half_keys(nodes), None
    for level, finer in ((1, _quarter_keys), (2, _eighth_keys), (3, None)):
        found = written(_bucketed(keys, level), f"simhash-{level}")
        here = found.filter("y is not null").select("x", "y")
        edges = here if edges is None else edges.unionAll(here)
        crowded = found.filter("y is null").select("key", "sub", F.col("x").alias("fp"))
        if finer is None or crowded.isEmpty():
            return edges
        keys = finer(crowded)
    return edges


def near_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """`doc_id, fingerprint, component_id`, one row per document. Runs its jobs when called."""
    marked = written(fingerprints(docs, text), "fingerprints")
    total = marked.count()
    nodes = written(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("rows")), "nodes")
    labels = components(join_edges(nodes))
    rooted = written(
        nodes.join(labels, F.col("fp") == F.col("node"), "left").select(
            "fp", "first_id", "rows", F.coalesce("label", "fp").alias("label")
        ), "rooted",
    )
    count = nodes.count()
    roots = rooted.groupBy("label").agg(F.min("first_id").alias("component_id"), F.count("*").alias("_nodes"))
    named = lookup(rooted, roots, ["label"], F.col("_nodes") * HOT > count).select("fp", "component_id", "rows")
    joined = lookup(marked, written(named, "named"), ["fp"], F.col("rows") * HOT > total)
    return joined.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
