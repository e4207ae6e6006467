"""Ranked lexical search by an Aho-Corasick scan of the document texts, without any document index.

All terms of the items form one automaton. A term is guarded by a boundary on either side and texts are
normalised to terms between boundaries, so only whole terms match. A first scan counts in how many documents each
term stands; a second one counts term frequencies document by document, maps the automaton's outputs to the items
that hold the term, and keeps the best `top` documents of each item. Only those leave a task, so neither postings
nor scores of all documents are ever shuffled.

Items are taken in blocks of about `BLOCK_BYTES` of text; a block's terms are all that reaches the driver and is
sent to the tasks. Texts are scanned twice for each block.

A text's terms are its maximal runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased; null has
none. Weight of a term: w = floor(1000 ln((2 N + 2) / (2 df + 1))), with N documents that have a term and df that
hold it. With n terms in the document and L in all, m = 25 + (75 n N) div L. The score adds
w ((10^9 tf) div (1000 tf + 8 m)) for every term of the item, repeats included.

Rows that repeat are documents and items of their own. Equal scores stand by ascending id, rows without an id
last. An item without terms, or found nowhere, has no rows; so has every item of an empty table. Other columns are
not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from hooklens.llm.common import written

TOP = 10
BLOCK_BYTES = 2_000_000
#: Documents scored at a time, so that scores take at most about this many cells.
_CELLS = 1 << 20
#: Parts in which an item's best documents meet first.
_PARTS = 32

_SAME = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_TABLE = bytes(b if b in _SAME else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def boundaries(text: bytes | None) -> bytes:
    """A UTF-8 text with a blank for every byte outside of terms, and one on either end."""
    return b" " + (text or b"").translate(_TABLE) + b" "


@dataclass
class Block:
    """The items of a block and their terms."""

    ids: list[int | None]
    terms: list[bytes]
    #: For each term the place of its first output; outputs are (item, how often the item holds the term).
    starts: np.ndarray = field(repr=False)
    items: np.ndarray = field(repr=False)
    times: np.ndarray = field(repr=False)

    @classmethod
    def of(cls, rows: list[tuple[int | None, bytes | None]]) -> Block:
        outputs: dict[bytes, list[tuple[int, int]]] = {}
        for item, (_, text) in enumerate(rows):
            for term, times in Counter(boundaries(text).split()).items():
                outputs.setdefault(term, []).append((item, times))
        pairs = [p for found in outputs.values() for p in found]
        sizes = [len(found) for found in outputs.values()]
        return cls(
            [i for i, _ in rows], list(outputs), np.cumsum([0, *sizes]),
            np.array([p[0] for p in pairs], dtype=np.int64), np.array([p[1] for p in pairs], dtype=np.int64),
        )

    @cached_property
    def automaton(self):
        import ahocorasick

        built = ahocorasick.Automaton()
        for number, term in enumerate(self.terms):
            # one character for each byte
            built.add_word(f" {term.decode('latin-1')} ", number)
        built.make_automaton()
        return built

    def found(self, guarded: bytes) -> Counter:
        """Occurrences of the block's terms in a text with boundaries."""
        if not self.terms:
            return Counter()
        return Counter(map(itemgetter(1), self.automaton.iter(guarded.decode("latin-1"))))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "automaton"}


def _counter(block: Block):
    """`term, n`: documents with each term; under -1 the documents with any term, under -2 all their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(len(block.terms), dtype=np.int64)
        with_terms = all_terms = 0
        for batch in batches:
            for text in batch.column(0):
                guarded = boundaries(text.as_py())
                n = len(guarded.split())
                if n:
                    with_terms, all_terms = with_terms + 1, all_terms + n
                    seen[list(block.found(guarded))] += 1
        here = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, -2, *here.tolist()], pa.int64()), pa.array([with_terms, all_terms, *seen[here].tolist()], pa.int64())],
            ["term", "n"],
        )

    return run


class _Best:
    """The best documents of each item so far."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.floor = np.ones(items, dtype=np.int64)  # a score below cannot enter
        self.item = self.score = self.doc = np.array([], dtype=np.int64)
        self.known = np.array([], dtype=bool)

    def take(self, scores: np.ndarray, docs: np.ndarray, known: np.ndarray) -> None:
        """Scores of some documents (rows) for all items (columns)."""
        row, item = np.nonzero(scores >= self.floor)
        self.item, self.score = np.append(self.item, item), np.append(self.score, scores[row, item])
        self.doc, self.known = np.append(self.doc, docs[row]), np.append(self.known, known[row])
        order = np.lexsort((self.doc, ~self.known, -self.score, self.item))
        item = self.item[order]
        first = np.searchsorted(item, item)
        rank = np.arange(len(item)) - first
        last = order[rank == self.top - 1]
        self.floor[self.item[last]] = self.score[last]
        kept = order[rank < self.top]
        self.item, self.score, self.doc, self.known = self.item[kept], self.score[kept], self.doc[kept], self.known[kept]


def _scorer(block: Block, weights: np.ndarray, n_docs: int, n_terms: int, top: int):
    """`item, item_id, doc_id, score`: the best documents among those of a task."""
    items = len(block.ids)
    sizes = np.diff(block.starts)

    def scores(found: list[Counter], lengths: list[int]) -> np.ndarray:
        term = np.array([t for c in found for t in c], dtype=np.int64)
        tf = np.array([n for c in found for n in c.values()], dtype=np.int64)
        doc = np.repeat(np.arange(len(found)), [len(c) for c in found])
        m = np.array([25 + 75 * n * n_docs // n_terms for n in lengths], dtype=np.int64)
        part = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
        width = sizes[term]
        first = np.cumsum(width) - width
        place = np.repeat(block.starts[term] - first, width) + np.arange(int(width.sum()))
        total = np.zeros(len(found) * items, dtype=np.int64)
        np.add.at(total, np.repeat(doc * items, width) + block.items[place], np.repeat(part, width) * block.times[place])
        return total.reshape(len(found), items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(items, top)
        step = max(1, _CELLS // max(1, items))
        for batch in batches:
            ids = batch.column(0)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            docs = ids.fill_null(0).to_numpy(zero_copy_only=False)
            for at in range(0, batch.num_rows, step):
                guarded = [boundaries(t.as_py()) for t in batch.column(1).slice(at, step)]
                found, lengths = [block.found(g) for g in guarded], [len(g.split()) for g in guarded]
                best.take(scores(found, lengths), docs[at : at + step], known[at : at + step])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(best.item), pa.array([block.ids[i] for i in best.item], pa.int64()),
                pa.array(best.doc, pa.int64(), mask=~best.known), pa.array(best.score),
            ], ["item", "item_id", "doc_id", "score"],
        )

    return run


def _ranked(found: DataFrame, top: int) -> DataFrame:
    """The best of each item over all tasks: first of some parts, so that no item's rows meet in one task."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = F.pmod(F.xxhash64("doc_id"), F.lit(_PARTS))
    in_part = found.withColumn("_r", F.row_number().over(W.partitionBy("item", part).orderBy(*order)))
    ranked = in_part.filter(F.col("_r") <= top).withColumn("rank", F.row_number().over(W.partitionBy("item").orderBy(*order)))
    return ranked.filter(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, text: str = "text") -> DataFrame:
    """`item_id, rank, doc_id, score`: the best documents of each item. Runs its jobs when called."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    asked = written(
        items.select(
            F.col("item_id").cast("bigint").alias("item_id"), F.col(text).cast("binary").alias("text"),
            F.monotonically_increasing_id().alias("number"),
        ), "items",
    )
    size = asked.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    answers = None
    for number in range(blocks):
        mine = asked.filter(F.pmod(F.xxhash64("number"), F.lit(blocks)) == number)
        block = Block.of([(r.item_id, r.text) for r in mine.orderBy("number").collect()])
        counted = rows.select("text").mapInArrow(_counter(block), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
        counts = {r.term: r.n for r in counted.collect()}  # at most the block's terms and two
        n_docs, n_terms = counts.get(-1, 0), counts.get(-2, 0)
        weights = np.array(
            [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * counts.get(t, 0) + 1))) for t in range(len(block.terms))],
            dtype=np.int64,
        )
        scored = rows.mapInArrow(
            _scorer(block, weights, n_docs, max(1, n_terms), top), "item long, item_id long, doc_id long, score long"
        )
        found = written(_ranked(scored, top), "found")
        answers = found if answers is None else answers.unionAll(found)
    return answers
