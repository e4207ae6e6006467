"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over a sample of labelled text. A text is parsed
against it into the fewest phrases: each phrase is the longest stretch, from where the last one
ended, that occurs in the sample. The entropy estimate is `phrases * log2(sample size) / length`;
the language with the lowest one wins, ties go to the first name.

The sample is bounded: of the documents of a language, in the order of a hash of their id and text, the
first `SAMPLE_DOCS`, of each its first `SAMPLE_SHARE` symbols, until there are `SAMPLE_CHARS` in all. This
is the fit on a bounded sample of labelled rows; everything else covers the whole texts. Letters are lower-cased, each run of other characters is
one space.

The automaton walk is a table look-up per symbol, done for many rows of symbols at once: a text is
laid out in segments of `SEGMENT` symbols, each parsed from the root, so a very long text is as good
for this as many short ones. Tables are made once per worker from the samples; nothing is shuffled
but the candidates for the samples (a bounded number per task).

Null text and text without a letter is `und` with score 0. Null ids take part as the id null.
`lang`, `source` and `doc_id` are read only to choose the samples.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from hooklens.llm.common import drop_columns

SAMPLE_CHARS = 40_000
SAMPLE_DOCS = 64
#: A sample document gives at most this much, so that one very long one does not stand for a language.
SAMPLE_SHARE = 4_000
SEGMENT = 256
CHUNK_CHARS = 3_000_000
UNKNOWN = "und"


class Automaton:
    """Suffix automaton of a sequence of small integers; only its transitions are kept."""

    def __init__(self, symbols: list[int], alphabet: int) -> None:
        following: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for symbol in symbols:
            state = len(following)
            following.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and symbol not in following[p]:
                following[p][symbol] = state
                p = link[p]
            if p >= 0:
                q = following[p][symbol]
                if length[p] + 1 == length[q]:
                    link[state] = q
                else:
                    copy = len(following)
                    following.append(dict(following[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and following[p].get(symbol) == q:
                        following[p][symbol] = copy
                        p = link[p]
                    link[q] = link[state] = copy
            last = state
        # a missing transition ends the phrase: it leads where the symbol leads from the root, with the sign set
        root = [following[0].get(s, 0) for s in range(alphabet)]
        table = np.empty((len(following), alphabet), dtype=np.int32)
        table[:] = -1 - np.array(root, dtype=np.int32)
        for state, edges in enumerate(following):
            for symbol, target in edges.items():
                table[state, symbol] = target
        self.table = table.ravel()
        self.alphabet = alphabet

    def phrases(self, segments: np.ndarray) -> np.ndarray:
        """Phrases in each column of a (symbols, segments) matrix; symbol -1 is padding."""
        width = segments.shape[1]
        state = np.zeros(width, dtype=np.int32)
        count = np.zeros(width, dtype=np.int32)
        for row in segments:
            step = self.table[state * self.alphabet + np.maximum(row, 0)]
            ended = step < 0
            step = np.where(ended, -1 - step, step)
            used = row >= 0
            count += ended & used
            state = np.where(used, step, state)
        return count + 1


@lru_cache(maxsize=1)
def letter_map() -> np.ndarray:
    """Lower-cased code point of each letter, 0 for any other code point."""
    points = np.zeros(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        char = chr(c)
        if char.isalpha():
            lower = char.lower()
            points[c] = ord(lower) if len(lower) == 1 else c
    return points


def symbols_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, letters lower-cased and other runs as one space, with the text of each."""
    joined = "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.cumsum([len(t) + 1 for t in texts])
    owner = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))
    letters = letter_map()[points]
    plain = letters == 0
    kept = ~plain
    kept[1:] |= ~plain[:-1]  # the first of each run of others stands for it
    kept[0] |= True
    found = np.where(plain, np.uint32(32), letters)[kept]
    return found, owner[kept]


class Model:
    """Automata of all languages over one alphabet."""

    def __init__(self, samples: tuple[tuple[str, str], ...]) -> None:
        parts = [(name, symbols_of([text])[0][:SAMPLE_CHARS]) for name, text in samples]
        known = np.unique(np.concatenate([p for _, p in parts])) if parts else np.array([], dtype=np.uint32)
        # one more symbol stands for all that no sample has
        self.code = np.full(0x110000, len(known), dtype=np.int16)
        self.code[known] = np.arange(len(known), dtype=np.int16)
        self.names = [name for name, _ in parts]
        self.automata = [Automaton(self.code[p].tolist(), len(known) + 1) for _, p in parts]
        self.bits = np.array([np.log2(max(2, len(p))) for _, p in parts])

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        symbols, owner = symbols_of(texts)
        sizes = np.bincount(owner, minlength=len(texts))
        lettered = np.bincount(owner, weights=symbols != 32, minlength=len(texts)) > 0
        segments = -(-sizes // SEGMENT)
        first = np.cumsum(segments) - segments
        place = np.arange(len(symbols)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        column = first[owner] + place // SEGMENT
        grid = np.full((SEGMENT, int(segments.sum())), -1, dtype=np.int32)
        grid[place % SEGMENT, column] = self.code[symbols]
        of_text = np.repeat(np.arange(len(texts)), segments)
        entropy = np.empty((len(self.names), len(texts)))
        for k, automaton in enumerate(self.automata):
            counts = np.bincount(of_text, weights=automaton.phrases(grid), minlength=len(texts))
            entropy[k] = counts * self.bits[k] / np.maximum(sizes, 1)
        if not self.names:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        best = np.argmin(entropy, axis=0)
        lowest = entropy[best, np.arange(len(texts))]
        # how far the others are behind, in bits per symbol, as a share of belief in the best
        belief = 1.0 / np.exp2(-(entropy - lowest) * 8.0).sum(axis=0)
        names = [self.names[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
        return names, [float(b) if ok else 0.0 for b, ok in zip(belief, lettered)]


@lru_cache(maxsize=2)
def model_of(samples: tuple[tuple[str, str], ...]) -> Model:
    return Model(samples)


def learn_samples(labelled: DataFrame, text: str = "text", lang: str = "lang") -> tuple[tuple[str, str], ...]:
    """The bounded sample of each language, by name; this is what reaches the driver."""
    order = F.xxhash64("doc_id", text)
    rank = F.row_number().over(W.partitionBy(lang).orderBy(order, "doc_id"))
    # each task sends at most SAMPLE_DOCS short rows per language into the ranking
    rows = labelled.filter(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    chosen = rows.select(
        F.col(lang).alias("lang"), "doc_id", F.substring(text, 1, SAMPLE_SHARE).alias("text"), rank.alias("rank")
    ).filter(F.col("rank") <= SAMPLE_DOCS)
    found: dict[str, list[str]] = {}
    size: dict[str, int] = {}
    for row in chosen.orderBy("lang", "rank").collect():
        if size.get(row["lang"], 0) < SAMPLE_CHARS:
            found.setdefault(row["lang"], []).append(row["text"])
            size[row["lang"]] = size.get(row["lang"], 0) + len(row["text"])
    return tuple((name, " ".join(texts)) for name, texts in sorted(found.items()))


def identify(docs: DataFrame, samples: tuple[tuple[str, str], ...], text: str = "text") -> DataFrame:
    """Add `lang_pred` and `score`, the belief in the winner against the other languages (0 to 1)."""
    rows = drop_columns(docs, "lang_pred", "score", "_text")
    rows = rows.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    schema = T.StructType([*rows.drop("_text").schema.fields, *added])
    shared = docs.sparkSession.sparkContext.broadcast(samples)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(shared.value)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            start = size = 0
            for i in range(len(texts)):
                size += len(texts[i])
                if size >= CHUNK_CHARS or i + 1 == len(texts):
                    names, scores = model.predict(texts[start : i + 1])
                    columns = [*batch.slice(start, i + 1 - start).columns[:-1], pa.array(names), pa.array(scores)]
                    yield pa.RecordBatch.from_arrays(columns, names=schema.names)
                    start, size = i + 1, 0

    return rows.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))
