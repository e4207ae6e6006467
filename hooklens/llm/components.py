"""Connected components of a link table, and look-ups whose hot keys never shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hooklens.llm.common import forget, written

#: A key of more than 1/HOT of all rows is hot. There are fewer than HOT such keys, whatever the data.
HOT = 1000


def lookup(rows: DataFrame, facts: DataFrame, on: list[str], hot: Column) -> DataFrame:
    """Inner join of rows with facts, a cheap table, that are unique in their key.

    `hot` tells which facts belong to keys of more than 1/HOT of all rows: those facts, fewer than HOT by that
    definition, are broadcast and their rows stay where they are. All others meet by hash, where no key holds
    more than that share.
    """
    marked = facts.withColumn("_hot", F.coalesce(hot, F.lit(False)))
    often, seldom = marked.filter("_hot").drop("_hot"), marked.filter("not _hot").drop("_hot")
    if often.isEmpty():
        return rows.join(facts, on)
    there = F.broadcast(often.select(*on))
    return rows.join(F.broadcast(often), on).unionByName(
        rows.join(there, on, "left_anti").join(seldom, on)
    )


def _shares(rows: DataFrame, key: str, total: int) -> DataFrame:
    """The hot keys of a column, named `node`."""
    return rows.groupBy(F.col(key).alias("node")).agg(F.count("*").alias("_c")).filter(
        F.col("_c") * HOT > total
    ).select("node", F.lit(True).alias("_often"))


def _facts(labels: DataFrame, hot: DataFrame, key: str, value: str) -> DataFrame:
    """`key, value, _often` of the labels, the hot ones marked."""
    marked = labels.join(F.broadcast(hot), "node", "left")
    return marked.select(F.col("node").alias(key), F.col("label").alias(value), "_often")


def components(links: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """`node, label` of all nodes with links: the smallest node reachable.

    Each round every node takes the smallest label among its neighbours and then the label of that label, so
    long chains halve. Hub nodes and the labels of large components are hot keys; they are looked up by
    broadcast (`lookup`). A round's tables are written, and deleted after the next; the driver sees whether a
    label changed.
    """
    pair = links.select(F.col(x).alias("a"), F.col(y).alias("b")).filter("a <> b")
    edges = written(pair.unionAll(pair.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    total = edges.count()
    hubs = written(_shares(edges, "b", total), "hubs")
    last = written(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    labels = last
    size = labels.count()
    while True:
        seen = lookup(edges, _facts(labels, hubs, "b", "near"), ["b"], F.col("_often"))
        near = seen.groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        best = written(
            labels.join(near, "node").select("node", "label", F.least("label", "near").alias("next")), "best"
        )
        large = _shares(best, "next", size)
        jumped = lookup(best, _facts(labels, large, "next", "further"), ["next"], F.col("_often"))
        new = F.least("next", "further")
        moved = written(jumped.select("node", new.alias("label"), (new != F.col("label")).alias("moved")), "moved")
        labels = moved.select("node", "label")
        forget(best)
        forget(last)
        last = moved
        if moved.filter("moved").isEmpty():
            forget(edges)
            forget(hubs)
            return labels
