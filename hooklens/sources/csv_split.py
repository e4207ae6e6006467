"""CSV files of any size read by many tasks, quoted line breaks included.

Whether a line break ends a record depends on the quotes before it: on whether their number is even. So the file is
read as lines, split like any text file. A first pass counts the quotes of each byte range; the parities of all
earlier ranges, one row for each range, tell how a range begins. A second pass then cuts every range into records
by itself. Only a range's first and last piece can belong to a record of several ranges; those pieces meet by the
range in which their record begins. A record is as long as it likes; other records never leave their task.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

#: Stands for a field without quotes and without characters, as opposed to a quoted empty one.
_ABSENT = "\x00"
_PIECE = "file string, start long, kind int, text string"
RECORD, FIRST, LAST, HEADER = 0, 1, 2, 3


class _Range:
    """The lines of one byte range, taken batch by batch."""

    def __init__(self, file: str, start: int, inside: bool):
        self.file, self.start = file, start
        self.open = inside  # within quotes
        self.whole = not inside  # the range's first border is behind; a range outside of quotes begins with one
        self.header = start == 0  # the next record is the file's header
        self.held: list[str] = []

    def take(self, lines: pa.Array) -> tuple[list[int], list[str]]:
        """Kinds and texts of the pieces that are complete."""
        quotes = np.cumsum(pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)) + int(self.open)
        ends = np.flatnonzero(quotes % 2 == 0)
        values = lines.to_pylist()
        kinds, texts, at = [], [], 0
        for end in ends.tolist():
            piece = values[at] if end == at and not self.held else "\n".join([*self.held, *values[at : end + 1]])
            kinds.append(HEADER if self.header else RECORD if self.whole else FIRST)
            texts.append(piece)
            self.whole, self.header, self.held, at = True, False, [], end + 1
        self.held += values[at:]
        self.open = bool(quotes[-1] % 2) if len(quotes) else self.open
        return kinds, texts

    def rest(self) -> tuple[list[int], list[str]]:
        """The last piece: a record begins in it, or the range lies within one altogether."""
        return ([LAST if self.whole else FIRST], ["\n".join(self.held)]) if self.held else ([], [])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of rows `file, start, inside, value` in the order of their file."""
    now: _Range | None = None

    def told(of: _Range, found: tuple[list[int], list[str]]) -> pa.RecordBatch:
        kinds, texts = found
        n = len(kinds)
        return pa.RecordBatch.from_pydict({
            "file": pa.array([of.file] * n, pa.string()), "start": pa.array([of.start] * n, pa.int64()),
            "kind": pa.array(kinds, pa.int32()), "text": pa.array(texts, pa.string()),
        })

    for batch in batches:
        files, starts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        at = 0
        while at < batch.num_rows:
            end = at + 1
            while end < batch.num_rows and files[end] == files[at] and starts[end] == starts[at]:
                end += 1
            if now is None or (now.file, now.start) != (files[at], starts[at]):
                if now is not None:
                    yield told(now, now.rest())
                now = _Range(files[at], starts[at], batch.column(2)[at].as_py())
            yield told(now, now.take(batch.column(3).slice(at, end - at)))
            at = end
    if now is not None:
        yield told(now, now.rest())


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """`file, text, header`: the records of CSV files, each in one row, the first of each file marked.

    Quotes within quoted fields are doubled. A header ends within its file's first byte range.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"
    )
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    ranges = lines.groupBy("file", "start").agg(F.bit_xor(quotes % 2).alias("odd"))
    earlier = W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    inside = ranges.select("file", "start", (F.coalesce(F.bit_xor("odd").over(earlier), F.lit(0)) == 1).alias("inside"))
    # a row for each byte range of at least a MB, so a millionth of the input; the lines stay in their order
    placed = lines.join(F.broadcast(inside), ["file", "start"]).select("file", "start", "inside", "value")
    pieces = placed.mapInArrow(_cut, _PIECE)
    begins = F.when(F.col("kind") == LAST, F.col("start"))
    until = W.partitionBy("file").orderBy("start", "kind").rowsBetween(W.unboundedPreceding, 0)
    torn = pieces.filter(F.col("kind").isin(FIRST, LAST)).withColumn("begin", F.last(begins, ignorenulls=True).over(until))
    joined = torn.groupBy("file", "begin").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "text"))).alias("_p")
    ).select("file", F.array_join("_p.text", "\n").alias("text"), F.lit(False).alias("header"))
    whole = pieces.filter(F.col("kind").isin(RECORD, HEADER))
    found = whole.select("file", "text", (F.col("kind") == HEADER).alias("header")).unionByName(joined)
    return found.withColumn("text", F.rtrim("text", F.lit("\r"))).filter("text <> ''")


def read_csv_split(
    spark: SparkSession, path: str, schema: T.StructType | None = None, empty_as_null: bool = False
) -> DataFrame:
    """CSV files with one and the same header, each read by as many tasks as its size asks for.

    An empty field is null, a quoted empty one is the empty string (or null, too, with `empty_as_null`). Blank
    lines are no records. A given schema goes by position; without one all columns are strings. Runs a job for
    the header when called.
    """
    records = csv_records(spark, path)
    heads = records.filter("header").agg(F.min("text"), F.max("text")).first()
    if heads[0] != heads[1]:
        raise ValueError(f"files with different headers under {path}")
    if heads[0] is None:
        raise ValueError(f"no header under {path}")
    names = next(csv.reader(io.StringIO(heads[0])))
    layout = schema or T.StructType([T.StructField(n, T.StringType()) for n in names])
    if len(layout) != len(names):
        raise ValueError(f"{len(names)} columns in the header, {len(layout)} in the schema")
    absent = "" if empty_as_null else _ABSENT
    options = {"quote": '"', "escape": '"', "nullValue": absent, "emptyValue": "", "maxCharsPerColumn": "-1"}
    columns = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in layout)
    return records.filter("not header").select(F.from_csv("text", columns, options).alias("_r")).select("_r.*")
