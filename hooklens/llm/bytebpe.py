"""Byte-level BPE encoding and decoding with the tokenizers library, over Arrow batches.

The vocabulary is a rank file: a line per token, its bytes in base64 and its rank. Each text is
split by a pattern; each piece is written in the byte alphabet (every byte stands for one
printable character) and merged by rank. All splits of a token into two tokens are merges of its
rank, in rank order, so the library merges exactly as a rank table does.

Pieces repeat, so a worker merges a piece once and remembers its ids, in a table that is emptied
when it holds `REMEMBERED` pieces. Text is worked on in slices of an Arrow batch, which hold the text
once; only a slice's texts become Python strings. Nothing is shuffled.

A null text encodes as an empty one. Decoding gives the bytes back; a token may begin or end
inside a character, so bytes are joined before they are read as UTF-8.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from hooklens.llm.common import drop_columns

VOCABULARY = "byte_bpe_50k.tiktoken"
REMEMBERED = 100_000
SLICE_BYTES = 1_000_000


@cache
def byte_alphabet() -> tuple[str, ...]:
    """The character that stands for each byte: printable bytes for themselves, the others, in
    order, for the characters from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return tuple(chr(b) if b in printable else chr(256 + others.index(b)) for b in range(256))


class Codec:
    """Encoder and decoder of one vocabulary, made once per worker.

    A worker that only decodes reads the vocabulary and makes no merges.
    """

    def __init__(self, path: str, pattern: str) -> None:
        import base64

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        letters = byte_alphabet()
        self.spelled = {"".join(letters[b] for b in token): rank for token, rank in self.ranks.items()}
        byte_of = {c: b for b, c in enumerate(letters)}
        self.bytes_of: list[bytes] = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.spelled.items():
            self.bytes_of[rank] = bytes(byte_of[c] for c in token)
        self.sizes = np.array([len(b) for b in self.bytes_of], dtype=np.int64)
        self.pattern = pattern
        self.memory: dict[str, bytes] = {}

    @cached_property
    def pieces(self):
        import regex

        return regex.compile(self.pattern).findall

    @cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer, models, pre_tokenizers

        ranks, name = self.ranks, {rank: token for token, rank in self.spelled.items()}
        merges = sorted(
            (rank, ranks[token[:i]], ranks[token[i:]])
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        )
        model = models.BPE(vocab=self.spelled, merges=[(name[a], name[b]) for _, a, b in merges])
        made = Tokenizer(model)
        # a piece is one word here: it is only spelled in the byte alphabet, not split again
        made.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        return made

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        split = [self.pieces(t) for t in texts]
        if len(self.memory) > REMEMBERED:
            self.memory.clear()
        memory = self.memory
        new = list({p for pieces in split for p in pieces if p not in memory})
        for i in range(0, len(new), 5_000):
            self._learn(new[i : i + 5_000])
        return [b"".join([memory[p] for p in pieces]) for pieces in split]

    def _learn(self, pieces: list[str]) -> None:
        found = self.tokenizer.encode(pieces, is_pretokenized=True, add_special_tokens=False)
        ids = np.array(found.ids, dtype="<u4").tobytes()
        owner = np.array(found.word_ids, dtype=np.int64)
        ends = np.searchsorted(owner, np.arange(len(pieces)), side="right").tolist()
        start = 0
        for piece, end in zip(pieces, ends):
            self.memory[piece] = ids[4 * start : 4 * end]
            start = end

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and end character of each token, and whether it begins or ends inside one."""
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        first = (data & 0xC0) != 0x80
        index = np.cumsum(first) - 1  # the character each byte belongs to
        ends = np.cumsum(self.sizes[ids])
        starts = ends - self.sizes[ids]
        opens = np.append(first, True)
        return index[starts], index[ends - 1] + 1, ~(opens[starts] & opens[ends])

    def decode(self, ids: np.ndarray) -> bytes:
        table = self.bytes_of
        return b"".join([table[i] for i in ids.tolist()])


@cache
def codec(vocabulary: str, pattern: str | None) -> Codec:
    """`vocabulary` is a file name of the installed vocabularies or a path on every worker."""
    import os

    import public_tokenizers

    path = vocabulary if os.path.isabs(vocabulary) else public_tokenizers.path(vocabulary)
    return Codec(path, pattern or public_tokenizers.PATTERN)


def _slices(texts: pa.StringArray) -> Iterator[tuple[int, int]]:
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        end = min(int(np.searchsorted(ends, before + SLICE_BYTES)) + 1, len(texts))
        yield start, end
        start = end


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    flat = np.concatenate(values) if values else np.array([], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32), type=pa.int32()), type=kind)


def encode(
    docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY, pattern: str | None = None,
    offsets: bool = True,
) -> DataFrame:
    """Add `ids`, `n_tokens`, `n_split` (tokens that begin or end inside a character) and, if asked for,
    `starts` and `ends`: the characters each token covers, in part or whole."""
    rows = drop_columns(docs, "ids", "n_tokens", "n_split", "starts", "ends")
    order = [c for c in rows.columns if c != text or text == "text"]
    # a column named `text` stays, and goes to the worker once
    kept = [c for c in rows.columns if c != text]
    rows = rows.select(*[F.col(f"`{c}`") for c in kept], F.col(text).alias("text" if text == "text" else "_text"))
    passed = len(kept) + (text == "text")
    added = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType()),
             T.StructField("n_split", T.LongType())]
    if offsets:
        added += [T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("starts", "ends")]
    schema = T.StructType([*rows.schema.fields[:passed], *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary, pattern)
        kind = pa.list_(pa.int32())
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for start, end in _slices(texts):
                part = [t or "" for t in texts.slice(start, end - start).to_pylist()]
                ids = [np.frombuffer(b, dtype="<u4") for b in own.encode(part)]
                placed = [own.offsets(t, i) for t, i in zip(part, ids)]
                columns = [*batch.slice(start, end - start).columns[:passed]]
                columns += [_lists(ids, kind), pa.array([len(i) for i in ids], pa.int64())]
                columns.append(pa.array([int(p[2].sum()) for p in placed], pa.int64()))
                if offsets:
                    columns += [_lists([p[k] for p in placed], kind) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    made = rows.mapInArrow(run, schema)
    return made.select(*[F.col(f"`{c}`") for c in order], *[f.name for f in added])


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY, pattern: str | None = None) -> DataFrame:
    """Replace `ids` by `decoded`, the bytes they stand for, and `ids_packed`, the ids themselves as
    little-endian unsigned 32-bit integers, the form in which token files hold them."""
    rows = drop_columns(encoded, "decoded", "ids_packed")
    others = [c for c in rows.columns if c != "ids"]
    rows = rows.select(*[F.col(f"`{c}`") for c in others], "ids")
    added = [T.StructField("decoded", T.BinaryType()), T.StructField("ids_packed", T.BinaryType())]
    schema = T.StructType([*rows.drop("ids").schema.fields, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary, pattern)
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            ends = lists.offsets.to_numpy()
            flat = lists.values.to_numpy()
            for start in range(0, batch.num_rows, 500):
                end = min(start + 500, batch.num_rows)
                ids = [flat[ends[i] : ends[i + 1]] for i in range(start, end)]
                columns = [*batch.slice(start, end - start).columns[:-1]]
                columns.append(pa.array([own.decode(i) for i in ids], pa.binary()))
                columns.append(pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)
