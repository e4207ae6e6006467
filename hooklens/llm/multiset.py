"""Document fingerprints by a homomorphic multiset hash.

A text is the multiset of its paragraphs (lines with a word). Each paragraph is hashed to a wide
vector of two lanes, and the fingerprint is the sum of the vectors, each lane modulo a power of two:

- identity: `IDENTITY` words of 64 bits from a hash of the paragraph's bytes, summed modulo 2**64;
- likeness: for every run of `RUN` words inside the paragraph (a shorter paragraph is one run), plus
  or minus one in one of `BINS` counters, summed modulo 2**32.

Sums do not know an order, so equal multisets of paragraphs have equal fingerprints, and a paragraph is
put in or taken out by adding or subtracting its vector, without the rest of the text. The distance of
the likeness lanes of two texts estimates how many runs they do not share, so likeness is
`1 - |a - b|^2 / (|a|^2 + |b|^2)`, cut to [0, 1]; two texts without words are alike.

Null text is empty. Fingerprints are little-endian bytes. A worker holds one slice of an Arrow
batch at a time; the vector of a long text takes no more room than that of a short one.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

IDENTITY = 8
BINS = 256
RUN = 3
#: A text column holds fewer than 2**31 bytes, so fewer than 2**30 runs of words: a counter of 32 bits never wraps.
WIDTH = IDENTITY * 8 + BINS * 4
_SPACE = b" \t\n\x0b\x0c\r"
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
_powers: list[np.ndarray] = [np.array([], dtype=np.uint64)] * 2


def _powers_of(n: int) -> list[np.ndarray]:
    """The first n powers of the odd factor and of its inverse, kept for the next slice."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_ODD, _INVERSE)):
            factors = np.full(n, base, dtype=np.uint64)
            factors[0] = 1
            _powers[k] = np.cumprod(factors)
    return _powers


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word (run of bytes that are no ASCII white space)."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edges = np.flatnonzero(np.diff(np.concatenate(([True], space, [True]))))
    starts, ends = edges[0::2], edges[1::2]
    # the sum of byte * odd**position over a word, divided by odd**start, does not know where the word stands
    powers, inverses = _powers_of(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    return _mixed((sums[ends] - sums[starts]) * inverses[starts]), starts


def vectors(texts: list[bytes]) -> np.ndarray:
    """Fingerprints, one row of WIDTH bytes for each UTF-8 text."""
    out = np.zeros((len(texts), WIDTH), dtype=np.uint8)
    counters = np.zeros((len(texts), BINS), dtype=np.int64)
    for i, text in enumerate(texts):
        digests = [
            hashlib.blake2b(p, digest_size=8 * IDENTITY).digest() for p in text.split(b"\n") if p.strip(_SPACE)
        ]
        identity = np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, IDENTITY).sum(axis=0, dtype=np.uint64)
        out[i, : 8 * IDENTITY] = identity.astype("<u8").view(np.uint8)
    # likeness of all texts of the slice at once
    joined = b"\n".join(texts)
    if joined:
        data = np.frombuffer(joined, dtype=np.uint8)
        hashes, starts = _word_hashes(data)
        if len(hashes):
            newlines = np.flatnonzero(data == 10)
            line = np.searchsorted(newlines, starts)
            text_ends = np.cumsum([len(t) + 1 for t in texts])
            owner = np.searchsorted(text_ends, starts, side="right")
            run_hash, run_owner = _runs(hashes, line, owner)
            sign = ((run_hash >> np.uint64(63)).astype(np.int64) << 1) - 1
            slot = run_owner * BINS + (run_hash & np.uint64(BINS - 1)).astype(np.int64)
            counted = np.bincount(slot, weights=sign, minlength=len(texts) * BINS)
            counters = counted.reshape(len(texts), BINS).astype(np.int64)
    out[:, 8 * IDENTITY :] = counters.astype("<u4").view(np.uint8).reshape(len(texts), 4 * BINS)
    return out


def _runs(hashes: np.ndarray, line: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of words inside one line, and their texts."""
    n = len(hashes)
    first = np.flatnonzero(np.concatenate(([True], line[1:] != line[:-1])))
    sizes = np.diff(np.append(first, n))
    left = np.repeat(first + sizes, sizes) - np.arange(n)  # words from here to the end of the line
    total = hashes.copy()
    for k in range(1, RUN):
        there = left > k
        index = np.flatnonzero(there)
        total[index] = total[index] * _ODD + hashes[index + k]
    # full runs, and the start of each line that is too short for one
    starts = np.zeros(n, dtype=bool)
    starts[left >= RUN] = True
    starts[first[sizes < RUN]] = True
    chosen = np.flatnonzero(starts)
    return _mixed(total[chosen] + np.uint64(1)), owner[chosen]


def add(a: np.ndarray, b: np.ndarray, sign: int = 1) -> np.ndarray:
    """Sum (or difference, sign -1) of fingerprints, row by row."""
    out = np.empty_like(a)
    for part, kind in ((slice(0, 8 * IDENTITY), "<u8"), (slice(8 * IDENTITY, WIDTH), "<u4")):
        x = np.ascontiguousarray(a[:, part]).view(kind)
        y = np.ascontiguousarray(b[:, part]).view(kind)
        out[:, part] = (x + y if sign > 0 else x - y).view(np.uint8).reshape(len(a), -1)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    lane = lambda v: np.ascontiguousarray(v[:, 8 * IDENTITY :]).view("<i4").astype(np.float64)
    x, y = lane(a), lane(b)
    whole = (x * x).sum(axis=1) + (y * y).sum(axis=1)
    apart = ((x - y) ** 2).sum(axis=1)
    alike = 1.0 - apart / np.where(whole > 0, whole, 1.0)
    same = (a == b).all(axis=1)
    return np.where(same, 1.0, np.clip(np.where(whole > 0, alike, 0.0), 0.0, 1.0))


def _edited(text: str, following: str) -> tuple[str, str, str]:
    """The edited text, what the edit takes away and what it puts in, both in whole paragraphs.

    The last quarter of the text gives way to the first characters of the following one. Only the
    paragraph in which the edit begins and those behind it change.
    """
    quarter = len(text) // 4
    cut = len(text) - quarter
    head, new = text[:cut], following[:quarter]
    begin = head.rfind("\n") + 1
    return head + new, text[begin:], head[begin:] + new


def fingerprint(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add `fingerprint`, the WIDTH bytes of the text's multiset hash."""
    rows = docs.withColumn("_text", F.coalesce(F.col(text), F.lit("")).cast("binary"))
    schema = T.StructType([*docs.schema.fields, T.StructField("fingerprint", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                found = vectors(part.column(part.num_columns - 1).to_pylist())
                columns = [*part.columns[:-1], pa.array([v.tobytes() for v in found], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


def _ranges(docs: DataFrame, parts: int) -> list[int]:
    """Ids that cut the documents into about equal runs; at most `parts` numbers reach the driver."""
    shares = [i / parts for i in range(1, parts)]
    ids = docs.select("doc_id").filter("doc_id is not null")
    if not shares:
        return []
    found = ids.agg(F.percentile_approx("doc_id", shares, 10 * parts)).first()[0]
    return sorted(set(found or []))


_EDIT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()),
    T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.BinaryType()),
    T.StructField("edited_fingerprint", T.BinaryType()), T.StructField("near_edited", T.DoubleType()),
    T.StructField("near_next", T.DoubleType()),
])


def edit_study(spark: SparkSession, docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprints of each text, of its edited form and of the next document, by id.

    Documents are dealt out in ranges of their id and sorted there, so nearly every document has the
    next one behind it in its own task. The first document of each range goes to the task before as well,
    the first of all to the last. Rows with one id are in the order of their texts; null ids come first.
    A short job over the ids alone runs when this is called; its result, like the table of first ids that
    is broadcast, has one row per range. The edited text is never hashed as a whole:
    its fingerprint is that of the text, less the paragraphs the edit takes away, plus those it puts in.
    """
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    lowest = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63)))
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    cuts = sorted({float(c) for c in _ranges(rows, parts)})
    ranged = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="_key", outputCol="_part") if cuts else None
    placed = rows.withColumns({"_id": lowest, "_key": lowest.cast("double")})
    placed = ranged.transform(placed) if ranged else placed.withColumn("_part", F.lit(0.0))
    placed = placed.withColumn("part", F.col("_part").cast("int")).drop("_key", "_part")
    # one row per range: its first id, and the range before it (for the first of all: the last)
    firsts = placed.groupBy("part").agg(F.min("_id").alias("_id"))
    whole = W.orderBy("part").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    before = F.coalesce(F.lag("part").over(W.orderBy("part")), F.max("part").over(whole))
    heads = firsts.select("_id", before.alias("also"))
    copies = F.array(F.struct(F.col("part"), F.lit(0).alias("tail")))
    tail = F.array(F.struct(F.col("also").alias("part"), F.lit(1).alias("tail")))
    copies = F.when(F.col("also").isNotNull(), F.concat(copies, tail)).otherwise(copies)
    dealt = placed.join(F.broadcast(heads), "_id", "left").withColumn("at", F.explode(copies))
    runs = dealt.select("at.part", "at.tail", "doc_id", "text").repartition(parts, "part")
    runs = runs.sortWithinPartitions("part", "tail", F.col("doc_id").asc_nulls_first(), "text")
    return runs.mapInArrow(_study, _EDIT)


def _study(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting: tuple | None = None  # the last document seen: part, id, text
    for batch in batches:
        rows = list(zip(*[batch.column(i).to_pylist() for i in range(4)]))
        start = 0
        while start < len(rows):
            size, end = 0, start
            while end < len(rows) and size < 1_000_000:
                size += len(rows[end][3])
                end += 1
            pairs, waiting = _pairs(rows[start:end], waiting)
            if pairs:
                yield _studied(pairs)
            start = end


def _pairs(rows: list[tuple], waiting: tuple | None) -> tuple[list[tuple], tuple | None]:
    """Each document with the text of the next one in its part."""
    found = []
    for part, tail, doc_id, text in rows:
        if waiting is not None and waiting[0] == part:
            found.append((waiting[1], waiting[2], text))
        waiting = None if tail else (part, doc_id, text)
    return found, waiting


def _studied(pairs: list[tuple]) -> pa.RecordBatch:
    edits = [_edited(text, following) for _, text, following in pairs]
    # a text is mostly the next one of the row before: hash each run of texts once
    texts = [pairs[0][1]]
    place, after = [], []
    for _, text, following in pairs:
        if texts[-1] is not text and texts[-1] != text:
            texts.append(text)
        place.append(len(texts) - 1)
        texts.append(following)
        after.append(len(texts) - 1)
    whole = vectors([t.encode() for t in texts])
    own, following = whole[place], whole[after]
    gone = vectors([e[1].encode() for e in edits])
    new = vectors([e[2].encode() for e in edits])
    edited = add(add(own, gone, -1), new)
    columns = [
        pa.array([p[0] for p in pairs], pa.int64()), pa.array([len(p[1]) for p in pairs], pa.int64()),
        pa.array([hashlib.sha256(e[0].encode()).hexdigest() for e in edits]),
        pa.array([v.tobytes() for v in own], pa.binary()), pa.array([v.tobytes() for v in edited], pa.binary()),
        pa.array(likeness(own, edited)), pa.array(likeness(own, following)),
    ]
    return pa.RecordBatch.from_arrays(columns, names=_EDIT.names)
