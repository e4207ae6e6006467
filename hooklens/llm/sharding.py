"""Sharding by proportional stratified interleaving.

Rows are shuffled with a seed and ranked inside their source, sorted by fractional rank
`(rank - 1/2) / rows of the source`, and the sorted run is cut into shards of equal row count,
so every shard holds each source in its share of the whole.

No window sees a whole source or the whole table. A rank is the number of rows in earlier
buckets plus the place in the own bucket; buckets are ranges of the hash (or of the fractional
rank) that hold about `bucket_rows` rows, and only counts per bucket are summed up in order.
Only keys move; texts stay where they are.

Ties and repeated rows are ordered by their id and checksum; rows equal in all of these are
exchangeable. Null sources form a source of their own, null texts have no bytes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from hooklens.llm.common import written

LEAST_BUCKET = 1024


def bucket_rows(rows: int) -> int:
    """Rows a bucket should hold: so many buckets as rows in one, beyond a small table."""
    return max(LEAST_BUCKET, math.isqrt(rows))


def offsets(counted: DataFrame, stratum: str | None, bucket: str) -> DataFrame:
    """Rows before each bucket, and in the whole stratum, from the counts per bucket."""
    inside = W.partitionBy(*([stratum] if stratum else [])).orderBy(bucket)
    before = F.sum("n").over(inside.rowsBetween(W.unboundedPreceding, -1))
    return counted.withColumn("_before", F.coalesce(before, F.lit(0)).cast("bigint"))


def interleave(keys: DataFrame, shards: int, stratum: str, order: list[str], seed: int) -> DataFrame:
    """Add `shard` and `slot` to a narrow table of keys.

    Runs a count and one job that writes the keys, both without texts.
    """
    total = keys.count()
    per = bucket_rows(total)
    bits = min(20, max(0, math.ceil(math.log2(max(1, total / per)))))
    draw = F.xxhash64(F.lit(seed), *order)
    named = F.concat(F.when(F.col(stratum).isNull(), "-").otherwise("+"), F.coalesce(stratum, F.lit("")))
    drawn = keys.withColumns({
        "_stratum": named, "_draw": draw,
        "_part": F.shiftrightunsigned(draw, 64 - bits) if bits else F.lit(0).cast("bigint"),
    })
    drawn = written(drawn, "shard-keys")
    counts = drawn.groupBy("_stratum", "_part").agg(F.count("*").alias("n"))
    sizes = counts.groupBy("_stratum").agg(F.sum("n").alias("_size"))
    before = offsets(counts, "_stratum", "_part").drop("n").join(sizes, "_stratum")
    inside = W.partitionBy("_stratum", "_part").orderBy("_draw", *order)
    ranked = drawn.withColumn("_place", F.row_number().over(inside)).join(before, ["_stratum", "_part"])
    rank = F.col("_before") + F.col("_place")
    fraction = (rank * 2 - 1) / (F.col("_size") * 2).cast("double")
    slices = max(1, total // per)
    placed = ranked.withColumn("_fraction", fraction).withColumn(
        "_slice", F.floor(F.col("_fraction") * slices)
    ).drop("_before", "_place", "_size", "_draw", "_part")
    placed = written(placed, "shard-ranks")
    slice_before = offsets(placed.groupBy("_slice").agg(F.count("*").alias("n")), None, "_slice").drop("n")
    run = W.partitionBy("_slice").orderBy("_fraction", "_stratum")
    position = F.row_number().over(run) - 1
    located = placed.withColumn("_at", position).join(slice_before, "_slice")
    at = (F.col("_before") + F.col("_at")).cast("bigint")
    shard = F.expr(f"(_position * {shards}) div {max(1, total)}").cast("int")
    first = F.expr(f"(shard * {total}L + {shards - 1}) div {shards}")
    return (
        located.withColumn("_position", at)
        .withColumn("shard", shard)
        .withColumn("slot", F.col("_position") - first)
        .drop("_slice", "_at", "_before", "_position", "_fraction", "_stratum")
    )


def shard_keys(docs: DataFrame, text: str = "text") -> DataFrame:
    """`doc_id, source, size, text_crc32` of a document table."""
    value: Column = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        "doc_id", "source", (F.octet_length(value) + 1).cast("bigint").alias("size"),
        F.crc32(value.cast("binary")).alias("text_crc32"),
    )


def shard_documents(docs: DataFrame, shards: int = 8, seed: int = 20_011, text: str = "text") -> DataFrame:
    """`doc_id, source, size, text_crc32, law, shard, slot, grown_shard`: the law is equal row counts."""
    placed = interleave(shard_keys(docs, text), shards, "source", ["doc_id", "text_crc32", "size"], seed)
    return placed.select(
        "doc_id", "source", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
