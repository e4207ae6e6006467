"""Global row numbers without a one-partition window.

A table is cut into ordered ranges by Spark's range partitioner, whose outcome is written once; rows are counted per
range, and each row is placed inside its range on top of the count of all earlier ones. The cut points only balance
the work: any cuts give the same result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from hooklens.session import shuffle_partitions, written

#: monotonically_increasing_id() keeps the partition number above this many bits.
PLACE_BITS = 33


def with_row_number(
    df: DataFrame,
    order: Sequence[Column],
    name: str = "id",
    start: int = 1,
    buckets: int | None = None,
) -> DataFrame:
    """Add consecutive numbers in the given ascending order.

    The order must end in a unique column; then equal leading keys, even a third of the
    table, still fall into many ranges. Runs jobs when called: the rows are sorted by one
    range shuffle and written with their place (range number and position in it). The ranges
    are then counted, one row each, and the count of all earlier ones is joined back. The
    numbers do not depend on where the ranges were cut.
    """
    keys = {f"_key{i}": c for i, c in enumerate(order)}
    ranges = buckets or shuffle_partitions(df.sparkSession)
    others = [c for c in df.columns if c != name]
    ordered = df.withColumns(keys).repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    placed = written(
        ordered.select(*others, F.monotonically_increasing_id().alias("_place")), "numbered"
    )
    # the place holds the range above PLACE_BITS and the position below
    bucket = F.shiftright("_place", PLACE_BITS).alias("_bucket")
    inside = F.col("_place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    totals = placed.groupBy(bucket).agg(F.count("*").alias("_p"))
    earlier = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    before = totals.select("_bucket", F.coalesce(F.sum("_p").over(earlier), F.lit(0)).alias("_before"))
    joined = placed.withColumn("_bucket", bucket).join(F.broadcast(before), "_bucket")
    return joined.select((inside + F.col("_before") + start).cast("bigint").alias(name), *others)
