"""N-gram Jaccard join with prefix filters under several global token orders.

A document is the set of its distinct word shingles, as 64-bit hashes. Two sets of Jaccard similarity
`t` or more share a token among the first `n - ceil(t n) + 1` tokens of each, under any order of all
tokens that both follow; so candidates must do so under every order tried:

- A: rare tokens first (by the number of sets that hold them, then by hash);
- B: ascending hash;
- C: descending hash, so that B and C look at different ends of a set.

Steps, each exact (no link is lost, nothing is capped):

1. Under order B with longer prefixes: `n - ceil(t n) + l` tokens must share `l` with one partner, so
   at least as many must occur elsewhere at all. This leaves documents that may have a partner.
2. Their equal sets fold into one node each, told by a signature of 128 bits; nodes are numbered.
3. Order A needs token counts, which are taken over the nodes; tokens of one node cannot join.
4. Nodes that share a token of their A prefixes are candidates, if it may be the first one they share: what
   follows in either must be enough for a link. So a passage of many texts makes no candidates of those whose
   own tokens, which come first, are too many. To find the components without all
   pairs of a group, each bucket first compares its members with one leader, twice with different
   leaders; while many pairs are left across components, it does so with more leaders (`LEADERS`), which joins
   a node to its group once one of them links. Nodes still in different components are then compared with one
   another.
5. Candidates under A are intersected with those under B and C by the prefixes alone, of which 32 bits a
   token are kept; a chance meeting of those bits drops nothing that links. Sets are fetched for the nodes
   of the candidates left, and only these are verified.

Tokens travel packed and pre-counted: a block of documents names a token once, so a token of a third of
all documents is one entry per block. Buckets of tokens hold a fixed share of the input, so there are as
many as it asks for. Prefixes and sets are met in chunks of about `CHUNK_TOKENS`, to which a node with many
partners is sent once each.

Null or empty text has the empty set and no links. Rows that repeat, also of one id with other texts,
are documents of their own; rows without an id are not linked and have no component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hooklens.llm.common import forget, written
from hooklens.llm.components import HOT, components, lookup
from hooklens.llm.packing import mix64, pack, spans_of, unpack

SHINGLE = 5
THRESHOLD = 75  # percent
#: Share of a set by which prefixes are longer in step 1.
EXTRA = 0.15
#: Leaders of a bucket in further rounds, while the pairs across components are more than CROWDED times all members.
LEADERS = (64,)
CROWDED = 2
SLICE_BYTES = 4_000_000
CHUNK_TOKENS = 250_000
BITMAP_BITS = 1 << 26
#: Bytes of text whose tokens a bucket holds on average, and those that a task reads.
BUCKET_BYTES = 16_000_000
TASK_BYTES = 64_000_000

_MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63],
    dtype=np.uint64,
)


def least_shared(n: np.ndarray | int, percent: int = THRESHOLD):
    """ceil(t n) in integers."""
    return -(-percent * n // 100)


def prefix_size(n, percent: int = THRESHOLD):
    return n - least_shared(n, percent) + 1


def token_sets(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each UTF-8 text, A-Z lower-cased."""
    import re

    import xxhash

    words_of = re.compile(rb"[^\x20\x09-\x0d]+").findall
    digest = xxhash.xxh3_64_intdigest
    known: dict[bytes, int] = {}
    found = []
    for text in texts:
        words = words_of(text.lower())
        for w in words:
            if w not in known:
                known[w] = digest(w)
        hashes = np.array([known[w] for w in words], dtype=np.uint64)
        if len(hashes) >= size:
            count = len(hashes) - size + 1
            total = np.zeros(count, dtype=np.uint64)
            for i in range(size):
                total = mix_step(total, hashes[i : i + count], i)
        elif len(hashes):
            total = np.array([len(hashes)], dtype=np.uint64)
            for i in range(len(hashes)):
                total = mix_step(total, hashes[i : i + 1], i)
        else:
            total = hashes
        found.append(np.unique(mix64(total)))
    return found


def mix_step(total: np.ndarray, words: np.ndarray, place: int) -> np.ndarray:
    """Take one more word into running shingle hashes."""
    total = (total ^ words) * _MULTIPLIERS[place % len(_MULTIPLIERS)]
    return total ^ (total >> np.uint64(29))


def signature(tokens: np.ndarray) -> bytes:
    import hashlib

    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[list[int], list[bytes]]]:
    """Ids and UTF-8 texts of a batch of (id, binary text), a few MB at a time."""
    ids, texts = batch.column(0).to_pylist(), batch.column(1)
    start = size = 0
    for i in range(len(ids)):
        size += len(texts[i].as_buffer()) if texts[i].is_valid else 0
        if size >= SLICE_BYTES or i + 1 == len(ids):
            yield ids[start : i + 1], texts.slice(start, i + 1 - start).to_pylist()
            start, size = i + 1, 0


def _shares(spark: SparkSession, size: int) -> tuple[int, int]:
    """Buckets and tasks for so many bytes: never fewer than the session's shuffle partitions."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, math.ceil(size / BUCKET_BYTES)), max(least, math.ceil(size / TASK_BYTES))


def _dealt(rows: DataFrame, tasks: int, key: str) -> DataFrame:
    """Rows with a key together, in so many tasks where the session's own number is too low."""
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, key) if tasks > least else rows


# --- step 1: documents that may have a partner ------------------------------------------------------

_ASK = "key long, ids binary, base long, tokens binary, needs binary, sizes binary, signatures binary"
_TALLY = "key long, ids binary, counts binary, needs binary, sizes binary, signatures binary"


def _long_prefix(n: int, percent: int) -> tuple[int, int]:
    """Tokens of the longer prefix of a set of n, and how many of them a partner must share.

    The partner's own prefix follows its own size, which is at least t n.
    """
    more = max(1, int(EXTRA * n))
    return n - least_shared(n, percent) + more, max(1, int(EXTRA * least_shared(n, percent)) - 1)


def _asker(buckets: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in _slices(batch):
                yield _questions(ids, token_sets(texts), buckets, percent)

    return run


def _questions(ids: list[int], sets: list[np.ndarray], buckets: int, percent: int) -> pa.RecordBatch:
    n = np.array([len(s) for s in sets], dtype=np.int64)
    wanted = [_long_prefix(int(k), percent) if k else (0, 1) for k in n]
    doc = np.array(ids, dtype=np.int64)
    tokens = np.concatenate([s[:q] for s, (q, _) in zip(sets, wanted)] or [np.array([], dtype=np.uint64)])
    owner = np.repeat(np.arange(len(sets)), [min(len(s), q) for s, (q, _) in zip(sets, wanted)])
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    # a token of several documents of the slice is shared: they are credited here, and the others asked once
    first = np.concatenate(([True], tokens[1:] != tokens[:-1])) if len(tokens) else np.array([], dtype=bool)
    group = np.cumsum(first) - 1
    many = np.bincount(group, minlength=0)[group] > 1 if len(tokens) else first
    credit = np.bincount(owner[many], minlength=len(sets))
    lone = ~many
    asked, asker = tokens[first], np.where(lone[first], owner[first], -1)
    rows: list[tuple] = []
    base = int(doc.min()) if len(doc) else 0
    # distances from the least id, of 64 bits where ids lie far apart (modulo 2**64, so any two ids will do)
    wide = len(doc) and int(doc.max()) - base >= 1 << 32
    bucket = (asked >> np.uint64(33)).astype(np.int64) * buckets >> 31  # ranges of the hash, so sorted
    for key, start, end in spans_of(bucket):
        who, part = asker[start:end], asked[start:end]
        alone = who >= 0
        delta = (doc[who[alone]] - np.int64(base)).view(np.uint64)
        rows.append((key, pack(delta if wide else delta.astype(np.uint32)), base, pack(part[alone]), None, None, None))
        if not alone.all():
            # tokens of several documents of the slice: they are counted, nobody is told
            rows.append((key, b"", base, pack(part[~alone]), None, None, None))
    place = (mix64(doc.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    by = np.argsort(place, kind="stable")
    needs = np.array([w for _, w in wanted], dtype=np.int64) - credit
    marks = [signature(s) for s in sets]
    for key, start, end in spans_of(place[by]):
        which = by[start:end]
        rows.append((
            buckets + key, pack(doc[which]), 0, None, pack(needs[which]), pack(n[which]),
            b"".join(marks[i] for i in which),
        ))
    names = ["key", "ids", "base", "tokens", "needs", "sizes", "signatures"]
    kinds = [pa.int64(), pa.binary(), pa.int64(), *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 7, kinds)], names)


def _tallier(buckets: int):
    names = ["key", "ids", "counts", "needs", "sizes", "signatures"]
    kinds = [pa.int64(), *[pa.binary()] * 5]

    def run(table: pa.Table) -> pa.Table:
        rows = []
        columns = {c: table.column(c).to_pylist() for c in table.column_names}
        del table
        tokens, ids, told = [], [], []
        for i in range(len(columns["key"])):
            if columns["tokens"][i] is None:
                rows.append((columns["key"][i] - buckets, columns["ids"][i], None, columns["needs"][i],
                             columns["sizes"][i], columns["signatures"][i]))
                continue
            part = unpack(columns["tokens"][i], "u8")
            width = len(columns["ids"][i]) // max(1, len(part))
            delta = unpack(columns["ids"][i], f"u{width}") if width else np.zeros(len(part))
            tokens.append(part)
            ids.append(delta.astype(np.uint64).view(np.int64) + np.int64(columns["base"][i]))
            told.append(np.full(len(part), width > 0))
        if tokens:
            token = np.concatenate(tokens)
            order = np.argsort(token, kind="stable")
            token = token[order]
            same = token[1:] == token[:-1]
            # documents are looked up for the shared tokens alone
            shared = order[np.concatenate((same, [False])) | np.concatenate(([False], same))]
            del tokens, token, order, same
            doc, known = np.concatenate(ids)[shared], np.concatenate(told)[shared]
            doc = doc[known]
            found, counts = np.unique(doc, return_counts=True)
            place = (mix64(found.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(place, kind="stable")
            for key, start, end in spans_of(place[by]):
                which = by[start:end]
                rows.append((key, pack(found[which]), pack(counts[which].astype(np.uint32)), None, None, None))
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 6, kinds)], names)

    return run


def _survey(table: pa.Table) -> pa.Table:
    """Every document with size and signature, and whether enough of its tokens occur elsewhere."""
    c = {name: table.column(name).to_pylist() for name in table.column_names}
    mine = [i for i in range(table.num_rows) if c["needs"][i] is not None]
    others = [i for i in range(table.num_rows) if c["needs"][i] is None]
    join = lambda name, kind, rows: np.concatenate(
        [unpack(c[name][i], kind) for i in rows] or [np.array([], dtype=kind)]
    )
    ids, needs, sizes = join("ids", "i8", mine), join("needs", "i8", mine), join("sizes", "i8", mine)
    marks = b"".join(c["signatures"][i] for i in mine)
    hit_ids, hits = join("ids", "i8", others), join("counts", "u4", others)
    found, index = np.unique(hit_ids, return_inverse=True)
    total = np.bincount(index, weights=hits, minlength=len(found)).astype(np.int64)
    at = np.searchsorted(found, ids)
    at[at == len(found)] = 0
    got = np.where(found[at] == ids, total[at], 0) if len(found) else np.zeros(len(ids), dtype=np.int64)
    return pa.table({
        "doc_id": pa.array(ids, pa.int64()), "n_shingles": pa.array(sizes, pa.int64()),
        "signature": pa.array([marks[i : i + 16] for i in range(0, len(marks), 16)], pa.binary()),
        "candidate": pa.array((got >= needs) & (sizes > 0)),
    })


def survey(docs: DataFrame, text: str = "text", percent: int = THRESHOLD) -> DataFrame:
    """`doc_id, n_shingles, signature, candidate` of the documents that have an id."""
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    buckets, tasks = _shares(docs.sparkSession, size)
    rows = docs.filter(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("bigint"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text")
    )
    asked = _dealt(rows.mapInArrow(_asker(buckets, percent), _ASK), tasks, "key")
    tallied = asked.groupBy("key").applyInArrow(_tallier(buckets), _TALLY)
    return _dealt(tallied, tasks, "key").groupBy("key").applyInArrow(
        _survey, "doc_id long, n_shingles long, signature binary, candidate boolean"
    )


# --- step 2: one node for each set -------------------------------------------------------------------


def _only(rows: DataFrame, ids: DataFrame, name: str, own: str | None = None) -> DataFrame:
    """A filter that lets pass every row whose id, `own` or of the same name, is in `ids`, and few others.

    The ids are marked in a bitmap of fixed size (at most 8 MB), which is what is broadcast.
    """
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(BITMAP_BITS))
    marks = ids.select(slot(F.col(name)).alias("s")).groupBy(
        F.bitmap_bucket_number("s").alias("_b")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("_bits"))
    placed = rows.withColumn("_s", slot(F.col(own or name))).withColumn("_b", F.bitmap_bucket_number("_s"))
    bit = F.bitmap_bit_position("_s")
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(bitmap_bit_position(_s) div 8 as int) + 1, 1)")), 16, 10)
    there = F.getbit(byte.cast("int"), (bit % 8).cast("int")) == 1
    return placed.join(F.broadcast(marks), "_b").filter(there).drop("_s", "_b", "_bits")


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sizes of the sets of rows (id, text)."""
    for batch in batches:
        for ids, texts in _slices(batch):
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(s) for s in token_sets(texts)], pa.int64())],
                ["doc_id", "n_shingles"],
            )


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets of rows (node, text, signature) where the signature is the text's own."""
    last = None
    for batch in batches:
        marks, at = batch.column(2).to_pylist(), 0
        for nodes, texts in _slices(batch):
            chosen = []
            for node, tokens in zip(nodes, token_sets(texts)):
                if signature(tokens) == marks[at] and node != last:
                    chosen.append((node, tokens.view(np.int64)))
                    last = node
                at += 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([c[0] for c in chosen], pa.int64()), pa.array([len(c[1]) for c in chosen], pa.int64()),
                    pa.array([c[1] for c in chosen], pa.list_(pa.int64())),
                ],
                ["node", "n", "tokens"],
            )


def node_sets(docs: DataFrame, classes: DataFrame, text: str = "text") -> DataFrame:
    """`node, n, tokens` (ascending as unsigned) for each class `node, signature, first_id`.

    A node whose text repeats under one id may come twice, which changes no result.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    firsts = classes.select(F.col("first_id").alias("doc_id"), "signature", "node")
    # an id that repeats may have several sets: the one of the signature is taken
    few = _only(rows, firsts, "doc_id").join(firsts, "doc_id")
    return few.select("node", "text", "signature").mapInArrow(_set_rows, "node long, n long, tokens array<long>")


# --- step 3: prefixes, rare tokens first --------------------------------------------------------------


def _block_tokens(table: pa.Table) -> np.ndarray:
    return table.column("tokens").combine_chunks().flatten().to_numpy(zero_copy_only=False).view(np.uint64)


def _counter(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        tokens, counts = np.unique(_block_tokens(table), return_counts=True)
        bucket = (tokens >> np.uint64(33)).astype(np.int64) * buckets >> 31
        block = table.column("block")[0].as_py() if table.num_rows else 0
        rows = [
            (k, block, pack(tokens[a:b]), pack(counts[a:b].astype(np.uint32))) for k, a, b in spans_of(bucket)
        ]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 4, kinds)],
                        ["bucket", "block", "tokens", "counts"])

    return run


def _adder(table: pa.Table) -> pa.Table:
    """Counts of all blocks, told to each block for those of its tokens that several nodes hold."""
    parts = [unpack(x, "u8") for x in table.column("tokens").to_pylist()]
    counts = [unpack(x, "u4") for x in table.column("counts").to_pylist()]
    tokens, index = np.unique(np.concatenate(parts), return_inverse=True)
    total = np.bincount(index, weights=np.concatenate(counts)).astype(np.int64)
    rows = []
    for block, part in zip(table.column("block").to_pylist(), parts):
        of = total[np.searchsorted(tokens, part)]
        shared = of > 1
        rows.append((block, pack(part[shared]), pack(np.minimum(of[shared], 0xFFFFFFFF).astype(np.uint32))))
    kinds = [pa.int64(), pa.binary(), pa.binary()]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["block", "tokens", "counts"])


def _prefixer(percent: int):
    def run(sets: pa.Table, replies: pa.Table) -> pa.Table:
        known = np.concatenate([unpack(x, "u8") for x in replies.column("tokens").to_pylist()] or [np.array([], "u8")])
        count = np.concatenate([unpack(x, "u4") for x in replies.column("counts").to_pylist()] or [np.array([], "u4")])
        order = np.argsort(known)
        known, count = known[order], count[order]
        out: list[list] = [[], [], [], []]
        lists = sets.column("tokens").combine_chunks()
        ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
        for i, node in enumerate(sets.column("node").to_pylist()):
            tokens = flat[ends[i] : ends[i + 1]]
            n = len(tokens)
            at = np.minimum(np.searchsorted(known, tokens), max(0, len(known) - 1))
            shared = known[at] == tokens if len(known) else np.zeros(n, dtype=bool)
            m = int(shared.sum())
            left = prefix_size(n, percent) - (n - m)  # the tokens of this node alone come first
            if left > 0 and m:
                mine = tokens[shared]
                first = mine[np.lexsort((mine, count[at[shared]]))[:left]]
                out[0].append(first.view(np.int64))
                out[1].append(np.full(len(first), node, dtype=np.int64))
                out[2].append(np.full(len(first), n, dtype=np.int64))
                out[3].append(m - np.arange(len(first), dtype=np.int64))
        columns = [pa.array(np.concatenate(c) if c else np.array([], dtype=np.int64), pa.int64()) for c in out]
        return pa.table(columns, ["token", "node", "n", "m"])

    return run


def prefixes(sets: DataFrame, total: int, percent: int = THRESHOLD) -> DataFrame:
    """`token, node, n, m`: the tokens of each node's A prefix that other nodes hold, too.

    `m` is how many of the node's n tokens other nodes hold, from this one on in the order; `total` is the number
    of tokens of all nodes.
    """
    buckets, tasks = _shares(sets.sparkSession, 8 * total)
    blocked = sets.withColumn("block", F.pmod(F.xxhash64("node"), F.lit(buckets)))
    blocked = _dealt(blocked, tasks, "block")
    asked = blocked.groupBy("block").applyInArrow(
        _counter(buckets), "bucket long, block long, tokens binary, counts binary"
    )
    told = _dealt(asked, tasks, "bucket").groupBy("bucket").applyInArrow(_adder, "block long, tokens binary, counts binary")
    return blocked.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        _prefixer(percent), "token long, node long, n long, m long"
    )


# --- steps 4 and 5: candidates and verification ------------------------------------------------------


def fits(x: str, y: str, percent: int = THRESHOLD) -> Column:
    """Whether sizes and places allow a link whose first shared token is the bucket's.

    Nothing before that token is shared then, so the overlap is at most the tokens from there on that either shares
    with anyone. A pair that links meets in the bucket of its first shared token, where it passes.
    """
    c = lambda side, name: F.col(f"{side}.{name}")
    overlap = F.least(c(x, "m"), c(y, "m"), c(x, "n"), c(y, "n"))
    return overlap * (100 + percent) >= (c(x, "n") + c(y, "n")) * percent


def leader_pairs(buckets: DataFrame, seed: int, percent: int = THRESHOLD, leaders: int = 1) -> DataFrame:
    """`x, y`: every member y of a bucket with its leaders x, at most as many as asked for, chosen by a hash.

    `buckets` has `token, node, n, m, label`. With seed 0 leaders are the same in all buckets where they
    stand, so that groups meet in few of them; with others each bucket has its own. Members of one label
    need no comparison.
    """
    draw = F.xxhash64("node") if seed == 0 else F.xxhash64(F.lit(seed), "node", "token")
    drawn = buckets.withColumn("d", draw).withColumn("slot", F.pmod("d", F.lit(leaders)))
    leaders = drawn.groupBy("token", "slot").agg(F.min(F.struct("d", "node", "n", "m", "label")).alias("l")).select("token", "l.*")
    paired = buckets.alias("y").join(leaders.alias("x"), "token").filter(
        (F.col("x.node") != F.col("y.node")) & (F.col("x.label") != F.col("y.label")) & fits("x", "y", percent)
    )
    return paired.select(F.col("x.node").alias("x"), F.col("y.node").alias("y")).distinct()


def mixed(buckets: DataFrame) -> tuple[DataFrame, int]:
    """The buckets with several labels, and how many pairs across labels they have, up to twice."""
    by_label = buckets.groupBy("token", "label").agg(F.count("*").alias("rows"))
    sizes = by_label.groupBy("token").agg(F.sum("rows").alias("rows"), F.max("rows").alias("most")).filter("most < rows")
    pairs = sizes.agg(F.sum(F.col("rows").cast("double") * (F.col("rows") - F.col("most")))).first()[0] or 0
    return buckets.join(sizes.select("token"), "token", "left_semi"), pairs


_MEMBERS = 1024


def _crossing(percent: int):
    """Candidates across labels in one bucket, as one list for each node and the members it may link to."""

    def run(table: pa.Table) -> pa.Table:
        node, label, size, n, m, part = (table.column(c).to_numpy() for c in ("node", "label", "size", "n", "m", "part"))
        out_x, out_y = [], []
        probes = np.flatnonzero(part == 0) if "part" in table.column_names else np.arange(len(node))
        base = np.flatnonzero(part == 1)
        cap = np.minimum(n, m)
        for i in probes:
            fit = np.minimum(cap[i], cap[base]) * (100 + percent) >= (n[i] + n[base]) * percent
            up = (size[base] > size[i]) | ((size[base] == size[i]) & (label[base] > label[i]))
            found = node[base[fit & up]]
            if len(found):
                out_x.append(int(node[i]))
                out_y.append(found)
        return pa.table([pa.array(out_x, pa.int64()), pa.array(out_y, pa.list_(pa.int64()))], ["x", "ys"])

    return run


def cross_lists(buckets: DataFrame, percent: int = THRESHOLD) -> DataFrame:
    """`x, ys`: for each node x of a bucket, the members with another label that it may link to.

    Of two labels the smaller one asks, so a large component is looked at, not enumerated. A bucket is
    dealt out in parts of about `_MEMBERS` members, each of which meets all that ask.
    """
    sized = buckets.groupBy("token").agg(
        F.min("label").alias("_low"), F.max("label").alias("_high"), F.count("*").alias("_rows"),
        F.max(F.struct("size", "label")).alias("_top"),
    ).filter("_low <> _high").drop("_low", "_high")
    mixed = buckets.join(sized, "token").withColumn("_parts", F.ceil(F.col("_rows") / _MEMBERS).cast("int"))
    base = mixed.withColumn("cell", F.pmod(F.xxhash64("node"), F.col("_parts")).cast("int")).withColumn("part", F.lit(1))
    asks = F.struct("size", "label") < F.col("_top")
    probes = mixed.filter(asks).withColumn(
        "cell", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
    ).withColumn("part", F.lit(0))
    columns = ["token", "cell", "node", "label", "size", "n", "m", "part"]
    both = base.select(columns).unionByName(probes.select(columns))
    return both.groupBy("token", "cell").applyInArrow(_crossing(percent), "x long, ys array<long>")


def chunk_of(nodes: np.ndarray, chunks: int) -> np.ndarray:
    return (mix64(nodes.view(np.uint64)) % np.uint64(chunks)).astype(np.int64)


def _dealer(chunks: int):
    """Lists `x, ys` cut into one list for each chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for x, ys in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                y = np.unique(np.array(ys, dtype=np.int64))
                place = chunk_of(y, chunks)
                by = np.argsort(place, kind="stable")
                rows += [(x, k, y[by[a:b]]) for k, a, b in spans_of(place[by])]
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64())]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 3, kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["x", "chunk", "ys"])

    return run


def _with_chunk(chunks: int):
    """Add the chunk of the first column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = chunk_of(batch.column(0).to_numpy(zero_copy_only=False), chunks)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], [*batch.schema.names, "chunk"])

    return run


def _orders(percent: int):
    """Prefixes under the orders B and C, the upper 32 bits of each token, ascending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, flat = _ragged(batch.column("tokens"))
            least, greatest = [], []
            for start, end in zip(ends[:-1], ends[1:]):
                tokens = (flat[start:end] >> np.uint64(32)).astype(np.uint32)
                width = prefix_size(len(tokens), percent)
                least.append(tokens[:width].tobytes())
                greatest.append(tokens[len(tokens) - width :].tobytes())
            columns = [batch.column("node"), batch.column("n"), pa.array(least, pa.binary()), pa.array(greatest, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["node", "n", "least", "greatest"])

    return run


def _ragged(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets into the tokens of a column of sets, and the tokens."""
    ends = lists.offsets.to_numpy().astype(np.int64)
    return ends, lists.values.to_numpy(zero_copy_only=False).view(np.uint64)


def _meet(mine: np.ndarray, flat: np.ndarray, starts: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """How many tokens of mine, ascending, each of the stretches of `flat` holds."""
    first = np.cumsum(widths) - widths
    index = np.repeat(starts - first, widths) + np.arange(int(widths.sum()))
    tokens = flat[index]
    place = np.minimum(np.searchsorted(mine, tokens), len(mine) - 1)
    return np.add.reduceat((mine[place] == tokens).astype(np.int64), first)


def _intersecter(percent: int):
    """Of the members that a node asks about under A, those that it meets under B and C, too."""

    def run(questions: pa.Table, orders: pa.Table) -> pa.Table:
        out: list[tuple] = []
        nodes = orders.column("node").to_numpy()
        order = np.argsort(nodes)
        sizes = orders.column("n").to_numpy().astype(np.int64)
        width = prefix_size(sizes, percent)
        starts = np.cumsum(width) - width
        flats = {c: np.frombuffer(b"".join(orders.column(c).to_pylist()), dtype=np.uint32) for c in ("least", "greatest")}
        asked = [questions.column(c) for c in ("x", "n", "least", "greatest", "ys")]
        for x, n, least, greatest, ys in zip(*asked):
            n, ys = n.as_py(), ys.values.to_numpy(zero_copy_only=False)
            at = order[np.searchsorted(nodes, ys, sorter=order)]
            fit = np.minimum(sizes[at], n) * (100 + percent) >= (sizes[at] + n) * percent
            for side, prefix in (("least", least), ("greatest", greatest)):
                at, ys = at[fit], ys[fit]
                if not len(at):
                    break
                fit = _meet(np.frombuffer(prefix.as_py(), dtype=np.uint32), flats[side], starts[at], width[at]) > 0
            if len(at) and fit.any():
                out.append((x.as_py(), ys[fit]))
        if out:
            out.append((None, np.unique(np.concatenate([y for _, y in out]))))
        return pa.table(
            [pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.list_(pa.int64()))], ["x", "ys"]
        )

    return run


def intersected(lists: DataFrame, orders: DataFrame, chunks: int, percent: int = THRESHOLD) -> DataFrame:
    """Candidates `x, chunk, ys` that share prefix tokens under all orders: `x, ys`, a row for each x and chunk.

    A row of each chunk without x has all its members that some list names, each once.
    """
    asked = lists.join(orders.withColumnRenamed("node", "x"), "x")
    placed = orders.mapInArrow(_with_chunk(chunks), "node long, n long, least binary, greatest binary, chunk long")
    return asked.groupBy("chunk").cogroup(placed.groupBy("chunk")).applyInArrow(
        _intersecter(percent), "x long, ys array<long>"
    )


def _verifier(percent: int):
    def run(questions: pa.Table, sets: pa.Table) -> pa.Table:
        out_x: list[int] = []
        out_y: list[int] = []
        nodes = sets.column("node").to_numpy()
        order = np.argsort(nodes)
        lists = sets.column("tokens").combine_chunks()
        if not isinstance(lists, pa.ListArray) or not len(lists):
            return pa.table([pa.array([], pa.int64())] * 2, ["x", "y"])
        ends, flat = _ragged(lists)
        for row in range(questions.num_rows):
            mine = questions.column("tokens")[row].values.to_numpy(zero_copy_only=False).view(np.uint64)
            ys = questions.column("ys")[row].values.to_numpy(zero_copy_only=False)
            at = order[np.searchsorted(nodes, ys, sorter=order)]
            sizes = ends[at + 1] - ends[at]
            shared = _meet(mine, flat, ends[at], sizes)
            links = shared * (100 + percent) >= (len(mine) + sizes) * percent
            out_x += [questions.column("x")[row].as_py()] * int(links.sum())
            out_y += ys[links].tolist()
        return pa.table([pa.array(out_x, pa.int64()), pa.array(out_y, pa.int64())], ["x", "y"])

    return run


def named(left: DataFrame) -> DataFrame:
    """The nodes `x` of what `intersected` returns: however many candidates a node has, its chunk names it once."""
    ys = left.filter("x IS NULL").select(F.explode("ys").alias("x"))
    return left.filter("x IS NOT NULL").select("x").distinct().unionAll(ys).distinct()


def verify(lists: DataFrame, sets: DataFrame, orders: DataFrame, chunks: int, percent: int = THRESHOLD) -> DataFrame:
    """The links `x, y`, written, among candidates `x, chunk, ys` under A.

    They are intersected with the other orders first; sets of nodes that are in no candidate then stay where
    they are. What is left is checked chunk by chunk of the sets.
    """
    left = written(intersected(lists, orders, chunks, percent), "intersected")
    needed = _only(sets.select("node", "tokens"), named(left), "x", "node")
    dealt = left.filter("x IS NOT NULL").mapInArrow(_dealer(chunks), "x long, chunk long, ys array<long>")
    asked = dealt.join(needed.select(F.col("node").alias("x"), "tokens"), "x")
    placed = needed.mapInArrow(_with_chunk(chunks), "node long, tokens array<long>, chunk long")
    links = asked.groupBy("chunk").cogroup(placed.groupBy("chunk")).applyInArrow(_verifier(percent), "x long, y long")
    return written(links, "found")


def link_nodes(sets: DataFrame, percent: int = THRESHOLD) -> DataFrame:
    """`node, label` of the nodes that have links."""
    total = sets.agg(F.sum("n")).first()[0] or 0
    chunks = max(1, math.ceil(total / CHUNK_TOKENS))
    orders = written(
        sets.mapInArrow(_orders(percent), "node long, n long, least binary, greatest binary"), "orders"
    )
    every = written(prefixes(sets, total, percent), "prefixes")
    # a bucket of one node has no pair
    crowded = every.groupBy("token").agg(F.count("*").alias("c")).filter("c > 1").drop("c")
    rows = written(every.join(crowded, "token", "left_semi"), "buckets")
    forget(every)
    labelled = rows.withColumn("label", F.col("node"))
    links = None
    labels = None
    members = rows.count()
    for seed, leaders in enumerate((1, 1, *LEADERS)):
        asking = labelled
        if seed > 1:
            asking, pairs = mixed(labelled)
            if pairs <= CROWDED * members:
                break
        # a node with many partners asks about them chunk by chunk
        pairs = leader_pairs(asking, seed, percent, leaders).select("y", "x")
        pairs = pairs.mapInArrow(_with_chunk(chunks), "y long, x long, chunk long")
        lists = pairs.groupBy("x", "chunk").agg(F.collect_list("y").alias("ys"))
        found = verify(lists, sets, orders, chunks, percent)
        if seed > 1 and found.isEmpty():
            break
        links = found if links is None else links.unionAll(found)
        labels = components(links)
        labelled = rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    size = labels.groupBy("label").agg(F.count("*").alias("size"))
    sized = labelled.join(size, "label", "left").withColumn("size", F.coalesce("size", F.lit(1)).cast("bigint"))
    lists = cross_lists(sized, percent).groupBy("x").agg(F.array_distinct(F.flatten(F.collect_list("ys"))).alias("ys"))
    dealt = lists.mapInArrow(_dealer(chunks), "x long, chunk long, ys array<long>")
    labels = components(links.unionAll(verify(dealt, sets, orders, chunks, percent)))
    forget(orders)
    forget(rows)
    return labels


def near_duplicates(docs: DataFrame, text: str = "text", percent: int = THRESHOLD) -> DataFrame:
    """`doc_id, n_shingles, class_id, component_id`, one row per document.

    `class_id` is the smallest id with an equal set, `component_id` the smallest id reachable over links.
    Runs its jobs when called. The large intermediate tables are deleted once read; the others stay in the shared folder.
    """
    seen = written(survey(docs, text, percent), "survey")
    # numbers are given once, as the table is written
    classes = written(
        seen.filter("candidate").groupBy("signature").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("rows"))
        .withColumn("node", F.monotonically_increasing_id()), "classes"
    )
    sets = written(node_sets(docs, classes, text), "sets")
    labels = link_nodes(sets, percent)
    rooted = classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    roots = rooted.groupBy("label").agg(F.min("first_id").alias("root"))
    named = written(rooted.join(roots, "label").select(
        "signature", "rows", F.col("first_id").alias("class_id"), F.col("root").alias("component_id")
    ), "named")
    forget(sets)
    forget(classes)
    asking = seen.filter("candidate").select("doc_id", "n_shingles", "signature")
    # a set of very many equal texts is looked up by broadcast
    often = F.col("rows") * HOT > asking.count()
    with_partner = lookup(asking, named, ["signature"], often).select("doc_id", "n_shingles", "class_id", "component_id")
    alone = seen.filter("not candidate").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("component_id")
    )
    nameless = docs.filter(F.col("doc_id").isNull()).select(
        F.col("doc_id").cast("bigint"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text")
    ).mapInArrow(_shingle_rows, "doc_id long, n_shingles long").select(
        "doc_id", "n_shingles",
        F.lit(None).cast("bigint").alias("class_id"), F.lit(None).cast("bigint").alias("component_id"),
    )
    return with_partner.unionByName(alone).unionByName(nameless)
