"""Language-model scores from Brown classes.

Words are put into classes by exchange clustering; a class bigram model gives each token of a text
`transition(class | class before) * emission(word | class)`, interpolated with the add-one unigram
model, so every text has a proper probability.

Every word seen twice or more in the training text has a class. Words seen once, and unseen ones, share
one, whose emission is add-one over those seen once and one unseen word.

1. The head: words of at least `1/MAX_HEAD` of all tokens. By that definition they are no more than
   `MAX_HEAD`, so their classes and the class matrix may be broadcast at any size of the corpus. Exchange in
   passes: with the class counts of the last pass frozen, a word moves to the class that makes the corpus
   most likely, its own counts taken along. In the first pass the words outside the most frequent ones are
   inserted; later only half of the words (by turns) may move in a pass, so that words do not swap places
   forever. It ends when fewer than 1 in 200 words move, or after `PASSES`; `Trained.moved` has the last share.
2. The rest: all other words seen twice or more, however many. They stay in the vocabulary table, in hash
   buckets, and move by the same rule: slices of text tell a word's bucket the classes around it, where it
   takes its best class. They move once; their neighbours of the rest count as one class in that.
3. With all classes known, class bigrams are counted again over all training text. The training blocks are written
   with what they were told, so that scoring the training texts (`score_trained`) neither reads nor asks again.

Counts travel packed: a slice of documents names each word, or pair, once. A slice asks the buckets for the
counts and classes of its rest words; texts are not shuffled, but their word numbers are. There are as many
buckets as the bytes of the text ask for.

Tokens are runs of non-white-space bytes with A-Z lower-cased, and one end token per text. Null text is
empty: just the end token. Rows that repeat count, and are scored, each time.
"""

from __future__ import annotations

import ctypes
import math
import uuid
from array import array
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hooklens.llm.common import forget, written
from hooklens.llm.packing import pack, spans_of, unpack

MAX_HEAD = 200_000
CLASSES = 64
PASSES = 8
#: Weight of the class model against the unigram model, and of a class's unigram share in transitions.
CLASS_WEIGHT = 0.95
PRIOR = 20.0
#: Words of text, and distinct words, that a worker holds at once.
SLICE_TOKENS = 500_000
SLICE_WORDS = 300_000
#: Bytes of training text whose words a bucket holds on average.
BUCKET_BYTES = 16_000_000

END, RARE, FIRST = 0, 1, 2


def _words(text: bytes) -> list[bytes]:
    import re

    return re.findall(rb"[^\x20\x09-\x0d]+", text.lower())


def _texts(docs: DataFrame, text: str) -> DataFrame:
    return docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))


@dataclass
class Slice:
    """Documents as word numbers, an end after each; `rare` has, in order, the places of rare words in `asked`."""

    ids: list
    numbers: np.ndarray
    sizes: np.ndarray
    rare: np.ndarray
    asked: list[bytes]


def _slices(batches: Iterator[pa.RecordBatch], number: dict[bytes, int]) -> Iterator[Slice]:
    """About SLICE_TOKENS words at a time. Words are turned into numbers document by document, so that only
    the rare ones of a slice, once each, stay in memory."""
    get = number.get
    ids: list = []
    parts: list[np.ndarray] = []
    rare, place, size = array("I"), {}, 0

    def done() -> Slice:
        sizes = np.array([len(p) for p in parts], dtype=np.int64)
        found = np.frombuffer(rare, dtype=np.uint32) if len(rare) else np.array([], dtype=np.uint32)
        return Slice(ids, np.concatenate(parts), sizes, found, list(place))

    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            words = _words(text.as_py())
            found = [get(w, RARE) for w in words]
            rare.extend([place.setdefault(w, len(place)) for w, n in zip(words, found) if n == RARE])
            found.append(END)
            ids.append(doc_id.as_py())
            parts.append(np.array(found, dtype=np.int32))
            size += len(found)
            if size >= SLICE_TOKENS:
                yield done()
                ids, parts, rare, place, size = [], [], array("I"), {}, 0
    if ids:
        yield done()


def _bucket_of(words: list[bytes], buckets: int) -> np.ndarray:
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(w) % buckets for w in words], dtype=np.int64)


def _give_back() -> None:
    """Freed memory goes back to the system: workers live on beside those that other steps need."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library alone
    if trim:
        trim(0)


def _thrifty(run: Callable, tables: int = 0) -> Callable:
    """The same function, whose worker keeps nothing when it is through: of Arrow batches, or of one or two tables
    of a group."""

    def batchwise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        _give_back()

    def grouped(table: pa.Table) -> pa.Table:
        result = run(table)
        _give_back()
        return result

    def cogrouped(left: pa.Table, right: pa.Table) -> pa.Table:
        result = run(left, right)
        _give_back()
        return result

    return (batchwise, grouped, cogrouped)[tables]


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


# --- word counts -----------------------------------------------------------------------------------


def _word_counter(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        texts = 0
        for batch in batches:
            for text in batch.column(1):
                counts.update(_words(text.as_py()))
                texts += 1
                if len(counts) >= SLICE_WORDS:
                    yield _counted(counts, texts, buckets)
                    counts, texts = Counter(), 0
        if texts:
            yield _counted(counts, texts, buckets)

    return run


def _counted(counts: Counter, texts: int, buckets: int) -> pa.RecordBatch:
    words = list(counts)
    place = _bucket_of(words, buckets)
    order = np.argsort(place, kind="stable")
    count = np.array(list(counts.values()), dtype=np.int64)
    rows = [(0, b"", b"", texts)]
    for key, start, end in spans_of(place[order]):
        which = order[start:end]
        rows.append((key, b"\n".join([words[i] for i in which]), pack(count[which]), 0))
    return _batch(rows, ["bucket", "words", "counts", "texts"], [pa.int64(), pa.binary(), pa.binary(), pa.int64()])


def _word_adder(table: pa.Table) -> pa.Table:
    total: Counter = Counter()
    texts = 0
    for words, counts, n in zip(*[table.column(c).to_pylist() for c in ("words", "counts", "texts")]):
        texts += n
        if words:
            for word, count in zip(words.split(b"\n"), unpack(counts, "i8").tolist()):
                total[word] += count
    values = np.array(list(total.values()), dtype=np.int64)
    return pa.table({
        "bucket": pa.array([table.column("bucket")[0].as_py()], pa.int64()),
        "words": pa.array([b"\n".join(total)], pa.binary()), "counts": pa.array([pack(values)], pa.binary()),
        "tokens": pa.array([int(values.sum())], pa.int64()), "distinct": pa.array([len(total)], pa.int64()),
        "texts": pa.array([texts], pa.int64()),
    })


def bucket_count(docs: DataFrame, text: str = "text") -> int:
    """Buckets for these texts, never fewer than the session's shuffle partitions."""
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / BUCKET_BYTES))


def vocabulary(train: DataFrame, buckets: int, text: str = "text") -> DataFrame:
    """Word counts in hash buckets, written: a row has the words of a bucket, joined by line ends, and
    their counts, with the sums of both and, in bucket 0, the number of texts."""
    counted = _texts(train, text).mapInArrow(
        _thrifty(_word_counter(buckets)), "bucket long, words binary, counts binary, texts long"
    )
    return written(counted.groupBy("bucket").applyInArrow(
        _thrifty(_word_adder, 1), "bucket long, words binary, counts binary, tokens long, distinct long, texts long"
    ), "vocabulary")


def _frequent(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                count = unpack(counts, "i8")
                chosen = np.flatnonzero(count >= least)
                if len(chosen):
                    parts = words.split(b"\n")
                    rows = [(parts[i], int(count[i])) for i in chosen]
                    yield _batch(rows, ["word", "count"], [pa.binary(), pa.int64()])

    return run


# --- texts as word numbers --------------------------------------------------------------------------

_BLOCK = "block long, words binary, numbers binary, rare binary, sizes binary, ids binary, asked long"


def _blocker(shared):
    """Slices of documents as rows: the words without a number, joined by line ends, and for each document
    its word numbers, an end after each; `rare` has the places, among the words, of those without."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches, shared.value):
            # ids, and which rows have one
            ids = np.array([[0 if i is None else i for i in part.ids], [i is not None for i in part.ids]], dtype=np.int64)
            row = (uuid.uuid4().int >> 65, b"\n".join(part.asked), pack(part.numbers.astype(np.int32)), pack(part.rare),
                   pack(part.sizes), ids.tobytes(), len(part.asked))
            names = ["block", "words", "numbers", "rare", "sizes", "ids", "asked"]
            yield _batch([row], names, [pa.int64(), *[pa.binary()] * 5, pa.int64()])

    return run


def blocks_of(docs: DataFrame, number: dict[bytes, int], text: str = "text") -> DataFrame:
    """The documents as blocks of word numbers, written."""
    shared = docs.sparkSession.sparkContext.broadcast(number)
    return written(_texts(docs, text).mapInArrow(_thrifty(_blocker(shared)), _BLOCK), "blocks")


def _questioner(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, joined in zip(batch.column(0), batch.column(1)):
                words = _split(joined.as_py())
                bucket = _bucket_of(words, buckets)
                order = np.argsort(bucket, kind="stable")
                rows = []
                for key, a, b in spans_of(bucket[order]):
                    which = order[a:b]
                    rows.append((key, block.as_py(), b"\n".join([words[i] for i in which]), pack(which.astype(np.uint32))))
                kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
                yield _batch(rows, ["bucket", "block", "words", "places"], kinds)

    return run


def _split(joined: bytes) -> list[bytes]:
    return joined.split(b"\n") if joined else []


def _answer(asked: pa.Table, words: pa.Table) -> pa.Table:
    place: dict[bytes, int] = {}
    counts, classes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint16)]
    for joined, count, own in zip(*[words.column(c).to_pylist() for c in ("words", "counts", "classes")]):
        for word in _split(joined):
            place[word] = len(place)
        counts.append(unpack(count, "i8"))
        classes.append(unpack(own, "u2"))
    count, own = np.concatenate(counts), np.concatenate(classes)
    rows = []
    for block, joined, places in zip(*[asked.column(c).to_pylist() for c in ("block", "words", "places")]):
        at = np.array([place.get(w, -1) for w in _split(joined)], dtype=np.int64)
        there = at >= 0
        rows.append((block, pack(unpack(places, "u4")[there]), pack(count[at[there]]), pack(own[at[there]])))
    kinds = [pa.int64(), *[pa.binary()] * 3]
    columns = zip(*rows) if rows else [[]] * 4
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], ["block", "places", "counts", "classes"])


def answers(blocks: DataFrame, words: DataFrame, buckets: int) -> DataFrame:
    """`block, places, counts, classes`: what the vocabulary has of each block's words without a number."""
    asked = blocks.select("block", "words").mapInArrow(
        _thrifty(_questioner(buckets)), "bucket long, block long, words binary, places binary"
    )
    return asked.groupBy("bucket").cogroup(words.select("bucket", "words", "counts", "classes").groupBy("bucket")).applyInArrow(
        _thrifty(_answer, 2), "block long, places binary, counts binary, classes binary"
    )


def _told(places: list[bytes], values: list[bytes], kind: str, size: int, other: int) -> np.ndarray:
    """Answers by place; `other` where there is none."""
    out = np.full(size, other, dtype=np.int64)
    for p, v in zip(places, values):
        out[unpack(p, "u4")] = unpack(v, kind)
    return out


_TOLD = "numbers binary, rare binary, sizes binary, ids binary, counts binary, classes binary"
_TOLD_NAMES = ["numbers", "rare", "sizes", "ids", "counts", "classes"]


def _teller(blocks: pa.Table, told: pa.Table) -> pa.Table:
    """A block with the counts and classes of its words without a number, in their order."""
    places, counts, classes = (told.column(c).to_pylist() for c in ("places", "counts", "classes"))
    rows = []
    for numbers, rare, sizes, ids, asked in zip(*[blocks.column(c).to_pylist() for c in (*_TOLD_NAMES[:4], "asked")]):
        count = _told(places, counts, "i8", asked, 0)
        own = _told(places, classes, "u2", asked, RARE)
        rows.append((numbers, rare, sizes, ids, pack(count), pack(own.astype(np.uint16))))
    columns = zip(*rows) if rows else [[]] * len(_TOLD_NAMES)
    return pa.table([pa.array(c, pa.binary()) for c in columns], _TOLD_NAMES)


def told_blocks(
    blocks: DataFrame, words: DataFrame, buckets: int, teller: Callable = _teller, schema: str = _TOLD
) -> DataFrame:
    """Blocks with what the vocabulary has of their words, or what `teller` makes of it in the same step; the words
    themselves are not shuffled."""
    known = answers(blocks, words, buckets)
    bare = blocks.select("block", "numbers", "rare", "sizes", "ids", "asked")
    return bare.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(_thrifty(teller, 2), schema)


# --- bigrams ---------------------------------------------------------------------------------------


def _summed(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their values. The lists are emptied, to hold a key no more than thrice."""
    key, value = np.concatenate(keys), np.concatenate(values)
    keys.clear()
    values.clear()
    order = np.argsort(key)
    key, value = key[order], value[order]
    del order
    starts = np.flatnonzero(np.concatenate((key[:1] == key[:1], key[1:] != key[:-1])))
    return key[starts], np.add.reduceat(value, starts, dtype=np.int64).astype(np.float64) if len(key) else np.zeros(0)


_PAIRS = "bucket long, following binary, following_n binary, preceding binary, preceding_n binary"
_PAIR_NAMES = ["bucket", "following", "following_n", "preceding", "preceding_n"]
_PAIR_KINDS = [pa.int64(), *[pa.binary()] * 4]


def _pair_counter(size: int, buckets: int):
    """Bigrams of blocks, told to the bucket of either word: keys are `word * size + other word`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for numbers in batch.column(0):
                found = unpack(numbers.as_py(), "i4").astype(np.int64)
                before = np.concatenate(([END], found[:-1]))
                keys, counts = np.unique(before * size + found, return_counts=True)
                left, right = keys // size, keys % size
                rows: dict[int, list] = {}
                for side, (word, other) in enumerate(((left, right), (right, left))):
                    turned = word * size + other
                    order = np.lexsort((turned, word % buckets))
                    for key, start, end in spans_of((word % buckets)[order]):
                        which = order[start:end]
                        row = rows.setdefault(key, [key, b"", b"", b"", b""])
                        row[1 + 2 * side : 3 + 2 * side] = pack(turned[which]), pack(counts[which].astype(np.int64))
                yield _batch([tuple(r) for r in rows.values()], _PAIR_NAMES, _PAIR_KINDS)

    return run


def _pair_adder(table: pa.Table) -> pa.Table:
    row = [table.column("bucket")[0].as_py()]
    for side in ("following", "preceding"):
        keys, counts = ([unpack(x.as_py(), "i8") for x in table.column(c)] for c in (side, f"{side}_n"))
        unique, total = _summed(keys, counts)
        row += [pack(unique), pack(total.astype(np.int64))]
    return pa.table([pa.array([v], k) for v, k in zip(row, _PAIR_KINDS)], _PAIR_NAMES)


# --- exchange --------------------------------------------------------------------------------------


def _class_counter(shared):
    """Class bigrams under the current classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, width = shared.value
        size = len(classes)
        total = np.zeros(width * width, dtype=np.int64)
        for batch in batches:
            for keys, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                key = unpack(keys, "i8")
                cell = classes[key // size] * width + classes[key % size]
                total += np.bincount(cell, weights=unpack(counts, "i8"), minlength=width * width).astype(np.int64)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), pa.array(total[there])], ["cell", "n"])

    return run


def class_matrix(pairs: DataFrame, classes: np.ndarray, width: int) -> np.ndarray:
    """Counts of class after class; at most width * width numbers reach the driver."""
    shared = pairs.sparkSession.sparkContext.broadcast((classes, width))
    cells = pairs.select("following", "following_n").mapInArrow(_thrifty(_class_counter(shared)), "cell long, n long")
    matrix = np.zeros(width * width, dtype=np.float64)
    for row in cells.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        matrix[row["cell"]] = row["n"]
    shared.unpersist()
    return matrix.reshape(width, width)


def _mover(shared, turn: int):
    """The words of a bucket that better move, with their new classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, matrix = shared.value
        size, width = len(classes), len(matrix)
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in _PAIR_NAMES[1:]]
            for following, following_n, preceding, preceding_n in zip(*columns):
                sides = []
                words = np.unique(np.concatenate([unpack(following, "i8") // size, unpack(preceding, "i8") // size]))
                for keys, counts in ((following, following_n), (preceding, preceding_n)):
                    key = unpack(keys, "i8")
                    cell = np.searchsorted(words, key // size) * width + classes[key % size]
                    got = np.bincount(cell, weights=unpack(counts, "i8"), minlength=len(words) * width)
                    sides.append(got.reshape(len(words), width))
                may = words >= FIRST
                if turn:
                    may &= (words * 2_654_435_761 >> 7) % 2 == turn % 2
                chosen = np.flatnonzero(may)
                moved, to = [], []
                for start in range(0, len(chosen), 128):
                    part = chosen[start : start + 128]
                    best = _best_class(classes[words[part]], sides[0][part], sides[1][part], matrix)
                    change = best != classes[words[part]]
                    moved += words[part][change].tolist()
                    to += best[change].tolist()
                yield _batch(list(zip(moved, to)), ["word", "class"], [pa.int64(), pa.int64()])

    return run


def _best_class(own: np.ndarray, after: np.ndarray, before: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """The class of highest likelihood for each word, given the classes around its occurrences.

    Every class is rated as if the word were in it.
    """
    width = len(matrix)
    clusters = np.arange(FIRST, width)
    inside = own[:, None] == clusters[None, :]  # there the counts hold the word already
    extra = np.where(inside, 0.0, 1.0)
    into = matrix[:, clusters].T[None] + before[:, None, :] * extra[:, :, None]  # word, class, class before
    out = matrix[clusters][None] + after[:, None, :] * extra[:, :, None]
    count = after.sum(axis=1)
    mass = matrix[clusters].sum(axis=1)[None] + count[:, None] * extra
    rate = (before[:, None, :] * np.log(into + 0.1)).sum(axis=2) + (after[:, None, :] * np.log(out + 0.1)).sum(axis=2)
    # transitions out are shares of the class, and so is the emission of the word
    rate -= 2 * count[:, None] * np.log(mass + 0.1)
    return clusters[np.argmax(rate, axis=1)]


def exchange(
    pairs: DataFrame, words: int, classes: int = CLASSES, passes: int = PASSES
) -> tuple[np.ndarray, np.ndarray, float]:
    """Class of each word number, the class matrix, and the share of words that moved in the last pass.

    The driver holds one number per word of the head, of which there are at most `MAX_HEAD`.
    """
    width = FIRST + max(1, min(classes, words))
    own = np.full(FIRST + words, RARE, dtype=np.int64)
    own[END] = END
    own[FIRST:width] = np.arange(FIRST, min(width, FIRST + words))
    context = pairs.sparkSession.sparkContext
    share = 0.0
    for turn in range(passes):
        shared = context.broadcast((own, class_matrix(pairs, own, width)))
        moves = pairs.mapInArrow(_thrifty(_mover(shared, turn)), "word long, class long").collect()
        shared.unpersist()
        own = own.copy()
        for row in moves:
            own[row["word"]] = row["class"]
        share = len(moves) / max(1, words)
        if turn > 2 and share < 1 / 200:
            break
    return own, class_matrix(pairs, own, width), share


# --- the rest ----------------------------------------------------------------------------------------


def _class_sequence(own: np.ndarray, numbers: bytes, rare: bytes, classes: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers of a told block, the classes of its tokens, and each unnumbered token's place among its words."""
    found, at = unpack(numbers, "i4"), unpack(rare, "u4")
    sequence = own[found]
    sequence[found == RARE] = unpack(classes, "u2")[at]
    return found, sequence, at


_AROUND = ["bucket", "words", "cells", "counts"]


def _around(shared, buckets: int):
    """For each word of a block without a number, the classes before and after it, told to its bucket: cells
    are `place in words * 2 * width + class after`, and `+ width` for the class before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, width = shared.value
        for batch in batches:
            for joined, numbers, rare in zip(*[batch.column(c) for c in ("words", "numbers", "rare")]):
                words, at = _split(joined.as_py()), unpack(rare.as_py(), "u4")
                found = unpack(numbers.as_py(), "i4")
                sequence = own[found]
                where = np.flatnonzero(found == RARE)
                bucket = _bucket_of(words, buckets)
                # places among the words of their bucket
                order = np.argsort(bucket, kind="stable")
                spans = spans_of(bucket[order])
                base = np.zeros(len(words), dtype=np.int64)
                for _, a, b in spans:
                    base[order[a:b]] = np.arange(b - a) * 2 * width
                after = sequence[where + 1]  # a text ends with its end, so a word has one after it
                before = np.where(where > 0, sequence[where - 1], END)
                cell = np.concatenate([base[at] + after, base[at] + width + before])
                goes = np.concatenate([bucket[at], bucket[at]])
                by = np.argsort(goes, kind="stable")
                rows = []
                for (key, a, b), (_, c, d) in zip(spans_of(goes[by]), spans):
                    cells, counts = np.unique(cell[by[a:b]], return_counts=True)
                    named = b"\n".join([words[i] for i in order[c:d]])
                    rows.append((key, named, pack(cells), pack(counts.astype(np.uint32))))
                yield _batch(rows, _AROUND, [pa.int64(), *[pa.binary()] * 3])

    return run


def _best_sparse(own: np.ndarray, owner: np.ndarray, cell: np.ndarray, n: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """`_best_class` of words with few contexts, given as `owner` (ascending, each there), cell and count."""
    width = len(matrix)
    clusters = np.arange(FIRST, width)
    extra = own[:, None] != clusters[None]
    level = np.concatenate([matrix[clusters].T, matrix[:, clusters]])[cell]
    rate = n[:, None] * np.log(level + n[:, None] * extra[owner] + 0.1)
    starts = np.searchsorted(owner, np.arange(len(own)))
    count = np.bincount(owner, weights=n * (cell < width), minlength=len(own))
    mass = matrix[clusters].sum(axis=1)[None] + count[:, None] * extra
    total = np.add.reduceat(rate, starts, axis=0) - 2 * count[:, None] * np.log(mass + 0.1)
    return clusters[np.argmax(total, axis=1)]


_CLASSED = "bucket long, words binary, counts binary, tokens long, distinct long, texts long, classes binary"


def _placer(shared, least: float):
    """The vocabulary's buckets with the best class of every word of the rest."""

    def run(words: pa.Table, around: pa.Table) -> pa.Table:
        matrix = shared.value
        width = len(matrix)
        if not words.num_rows:
            return words.append_column("classes", pa.array([], pa.binary()))
        names = _split(words.column("words")[0].as_py())
        count = unpack(words.column("counts")[0].as_py(), "i8")
        own = np.full(len(names), RARE, dtype=np.int64)
        place = {w: i for i, w in enumerate(names)}
        keys, values = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
        for joined, cells, counts in zip(*[around.column(c) for c in _AROUND[1:]]):
            at = np.array([place[w] for w in _split(joined.as_py())], dtype=np.int64)
            cell = unpack(cells.as_py(), "i8")
            keys.append(at[cell // (2 * width)] * 2 * width + cell % (2 * width))
            values.append(unpack(counts.as_py(), "u4"))
        del around, place
        key, total = _summed(keys, values)
        chosen = np.flatnonzero((count >= 2) & (count < least))
        word = key // (2 * width)
        for start in range(0, len(chosen), 256):
            part = chosen[start : start + 256]
            a, b = np.searchsorted(word, [part[0], part[-1] + 1])
            here = np.isin(word[a:b], part)
            owner = np.searchsorted(part, word[a:b][here])
            own[part] = _best_sparse(own[part], owner, key[a:b][here] % (2 * width), total[a:b][here], matrix)
        return words.append_column("classes", pa.array([pack(own.astype(np.uint16))], pa.binary()))

    return run


def _matrix_counter(shared):
    """Class bigrams of told blocks under the classes of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, width = shared.value
        total = np.zeros(width * width, dtype=np.int64)
        for batch in batches:
            for numbers, rare, classes in zip(*[batch.column(c) for c in ("numbers", "rare", "classes")]):
                _, sequence, _ = _class_sequence(own, numbers.as_py(), rare.as_py(), classes.as_py())
                before = np.concatenate(([END], sequence[:-1]))
                total += np.bincount(before * width + sequence, minlength=width * width)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), pa.array(total[there], pa.int64())], ["cell", "n"])

    return run


def _class_sums(width: int, least: float):
    """Tokens and words of the vocabulary outside of the head, by class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for counts, classes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                count, own = unpack(counts, "i8"), unpack(classes, "u2")
                rest = count < least
                tokens = np.bincount(own[rest], weights=count[rest], minlength=width).astype(np.int64)
                words = np.bincount(own[rest], minlength=width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(width)), pa.array(tokens), pa.array(words.astype(np.int64))], ["class", "tokens", "words"]
                )

    return run


def place_rest(
    blocks: DataFrame, words: DataFrame, own: np.ndarray, matrix: np.ndarray, least: float, buckets: int
) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """The vocabulary with a class for every word of the rest, the told blocks, both written, and the class matrix
    with all words in their classes. Head words have the class of rare ones in the vocabulary, which nothing reads."""
    context = blocks.sparkSession.sparkContext
    width = len(matrix)
    state = context.broadcast((own, width))
    around = blocks.select("words", "numbers", "rare").mapInArrow(
        _thrifty(_around(state, buckets)), "bucket long, words binary, cells binary, counts binary"
    )
    words = written(words.groupBy("bucket").cogroup(around.groupBy("bucket")).applyInArrow(
        _thrifty(_placer(context.broadcast(matrix), least), 2), _CLASSED
    ), "classes")
    told = written(told_blocks(blocks, words, buckets), "told")
    cells = told.select("numbers", "rare", "classes").mapInArrow(_thrifty(_matrix_counter(state)), "cell long, n long")
    matrix = np.zeros(width * width, dtype=np.float64)
    for row in cells.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        matrix[row["cell"]] = row["n"]
    return words, told, matrix.reshape(width, width)


# --- the model -------------------------------------------------------------------------------------


@dataclass(frozen=True)
class BrownModel:
    """Everything of bounded size; counts and classes of the rest stay in the vocabulary table."""

    number: dict[bytes, int]
    classes: np.ndarray
    transition: np.ndarray  # class before, class
    share: np.ndarray  # tokens of a class; of the class of rare words, what its emission is divided by
    counts: np.ndarray  # by word number
    tokens: int
    distinct: int

    @property
    def floor(self) -> float:
        return 1.0 / (self.tokens + self.distinct + 1)

    def emission(self, counts: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Probability of words of these counts in their classes."""
        return np.where(classes == END, 1.0, (counts + (classes == RARE)) / self.share[classes])


@dataclass(frozen=True)
class Trained:
    model: BrownModel
    vocabulary: DataFrame
    buckets: int
    moved: float  # share of the head's words that moved in the last pass
    told: DataFrame  # the training texts as blocks of word numbers, with counts and classes


def train(docs: DataFrame, text: str = "text", classes: int = CLASSES, passes: int = PASSES) -> Trained:
    """Count, cluster and estimate. Runs its jobs when called."""
    buckets = bucket_count(docs, text)
    words = vocabulary(docs, buckets, text)
    sums = words.agg(F.sum("tokens"), F.sum("distinct"), F.sum("texts")).first()
    seen, distinct, texts = (int(v or 0) for v in sums)
    tokens = seen + texts
    least = max(2.0, tokens / MAX_HEAD)
    head = words.select("words", "counts").mapInArrow(_frequent(least), "word binary, count long").collect()
    ranked = sorted(((-r["count"], bytes(r["word"])) for r in head))
    number = {w: FIRST + i for i, (_, w) in enumerate(ranked)}
    counts = np.array([texts, 0, *[-c for c, _ in ranked]], dtype=np.float64)
    blocks = blocks_of(docs, number, text)
    slices = blocks.select("numbers").mapInArrow(_thrifty(_pair_counter(len(number) + FIRST, buckets)), _PAIRS)
    pairs = written(slices.groupBy("bucket").applyInArrow(_thrifty(_pair_adder, 1), _PAIRS), "bigrams")
    own, matrix, moved = exchange(pairs, len(number), classes, passes)
    forget(pairs)
    width = len(matrix)
    counted = words
    words, told, matrix = place_rest(blocks, counted, own, matrix, least, buckets)
    forget(counted)
    forget(blocks)
    tokens_of = np.bincount(own, weights=counts, minlength=width)
    once = 0
    sums = words.select("counts", "classes").mapInArrow(_class_sums(width, least), "class long, tokens long, words long")
    for row in sums.groupBy("class").agg(F.sum("tokens").alias("tokens"), F.sum("words").alias("words")).collect():
        tokens_of[row["class"]] += row["tokens"]
        once = row["words"] if row["class"] == RARE else once
    # every class can follow any other, and text can go on after what was never followed
    prior = (tokens_of + 1.0) / (tokens_of.sum() + width)
    transition = (matrix + PRIOR * prior[None]) / (matrix.sum(axis=1, keepdims=True) + PRIOR)
    share = np.maximum(tokens_of, 1.0)
    share[RARE] = tokens_of[RARE] + once + 1
    model = BrownModel(number, own, transition, share, counts, tokens, distinct + (1 if texts else 0))
    return Trained(model, words, buckets, moved, told)


# --- scores ----------------------------------------------------------------------------------------


_SCORES = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
_SCORE_SCHEMA = pa.schema([
    *[(c, pa.int64()) for c in ("doc_id", "n_tokens", "n_known", "train_tokens")],
    *[(c, pa.float64()) for c in ("base_score", "score")],
])


def _scorer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: BrownModel = shared.value
        for batch in batches:
            for row in zip(*[batch.column(c) for c in _TOLD_NAMES]):
                yield _scored(model, *[value.as_py() for value in row])

    return run


def _telling_scorer(shared):
    """`_teller` and `_scorer` in one worker, so that a task never has two."""

    def run(blocks: pa.Table, told: pa.Table) -> pa.Table:
        return pa.Table.from_batches(_scorer(shared)(_teller(blocks, told).to_batches()), _SCORE_SCHEMA)

    return run


def _scored(
    model: BrownModel, numbers: bytes, rare: bytes, sizes: bytes, ids: bytes, counts: bytes, classes: bytes
) -> pa.RecordBatch:
    found, own, at = _class_sequence(model.classes, numbers, rare, classes)
    doc, there = np.frombuffer(ids, dtype=np.int64).reshape(2, -1)
    size = unpack(sizes, "i8")
    count = model.counts[found]
    count[found == RARE] = unpack(counts, "i8")[at]
    before = np.concatenate(([END], own[:-1]))
    unigram = (count + 1.0) * model.floor
    mixed = CLASS_WEIGHT * model.transition[before, own] * model.emission(count, own) + (1 - CLASS_WEIGHT) * unigram
    first = np.cumsum(size) - size
    return pa.RecordBatch.from_arrays([
        pa.array(doc, pa.int64(), mask=there == 0), pa.array(size),
        pa.array(np.add.reduceat((count > 0).astype(np.int64), first)),
        pa.array(np.full(len(doc), model.tokens, dtype=np.int64)),
        pa.array(np.add.reduceat(np.log10(unigram), first)), pa.array(np.add.reduceat(np.log10(mixed), first)),
    ], schema=_SCORE_SCHEMA)


def _for_scores(table: DataFrame, model: BrownModel):
    """The model on the executors, without the words themselves, which blocks have as numbers."""
    return table.sparkSession.sparkContext.broadcast(replace(model, number={}))


def _with_perplexity(scores: DataFrame) -> DataFrame:
    return scores.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def score(docs: DataFrame, trained: Trained, text: str = "text") -> DataFrame:
    """`doc_id, n_tokens, n_known, train_tokens, base_score, score, perplexity` of every document.

    Writes the documents' word numbers when called; the rest is lazy.
    """
    blocks = blocks_of(docs, trained.model.number, text)
    scorer = _telling_scorer(_for_scores(blocks, trained.model))
    return _with_perplexity(told_blocks(blocks, trained.vocabulary, trained.buckets, scorer, _SCORES))


def score_trained(trained: Trained) -> DataFrame:
    """`score` of the training documents, from their blocks: they are not read, nor looked up, again."""
    scorer = _thrifty(_scorer(_for_scores(trained.told, trained.model)))
    return _with_perplexity(trained.told.select(*_TOLD_NAMES).mapInArrow(scorer, _SCORES))
