"""Mixing sources to target weights by iterative proportional fitting.

Documents are folded into cells (source, language, topic) with their token counts. Raking scales
the cells, dimension by dimension, until the token shares of every dimension meet its targets. A
document is then sampled with probability `rate * cell weight / cell share`; where this exceeds
one, the document is kept and carries the rest as `weight`, so weighted tokens still meet the
targets.

Only cells take part in the fitting: their number follows the categories, not the documents, and a
hot source is one row per language and topic. The draw of a document is a hash of its id, its
text checksum and the seed, so it does not depend on the order or number of tasks.

A null category is a category of its own. A category without a target has target 0 if targets are
given for its dimension, as has a target without documents, which is left out; the others share
its part. A cell of texts without words has weight and probability like the average cell.
Repeated rows are drawn alike. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from hooklens.llm.common import WORD, drop_columns, written

DIMENSIONS = ("source", "lang", "topic")
MISSING = "(none)"
#: Rounds of raking in one job, between two comparisons of the marginals with their targets.
ROUNDS_PER_CHECK = 4


def form_topic(text: Column) -> Column:
    """A topic by form, from the text alone: list, heading-like, short, long or middle prose."""
    text = F.coalesce(text, F.lit(""))
    size, lines = F.length(text), F.regexp_count(text, F.lit("\n")) + 1
    return (
        F.when(size == 0, "empty")
        .when(size < 40 * lines, "lines")
        .when(size < 600, "short")
        .when(size < 4000, "middle")
        .otherwise("long")
    )


def token_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def category(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(MISSING))


def target_column(cells: DataFrame, dimension: str, targets: Mapping[str, float] | float) -> DataFrame:
    """Add `_target_<dimension>`: given shares, or token shares raised to a power, both rescaled.

    A power of 1 keeps the shares, 0 makes all categories alike.
    """
    own = W.partitionBy(dimension)
    tokens = F.sum("tokens").over(own).cast("double")
    if isinstance(targets, Mapping):
        raw = F.coalesce(
            *[F.when(F.col(dimension) == k, float(v)) for k, v in targets.items()], F.lit(0.0)
        )
    else:
        raw = F.when(tokens > 0, F.pow(tokens, F.lit(float(targets)))).otherwise(0.0)
    marked = cells.withColumn("_raw", raw)
    # every cell of a category holds the raw target; a category counts once in their sum
    total = marked.select(dimension, "_raw").distinct().agg(F.sum("_raw")).scalar()
    marked = marked.withColumn("_all", total)
    share = F.when(F.col("_all") > 0, F.col("_raw") / F.col("_all")).otherwise(0.0)
    return marked.withColumn(f"_target_{dimension}", share).drop("_raw", "_all")


def rake(
    cells: DataFrame, targets: Mapping[str, Mapping[str, float] | float],
    tolerance: float = 1e-4, max_rounds: int = 40,
) -> DataFrame:
    """Add `share` and `weight`, both summing to one, to cells with `tokens`.

    Runs a job for every few rounds; the only value that reaches the driver is the largest gap
    between a marginal and its target. Targets that no weights can meet (empty cells between them)
    end after `max_rounds`.
    """
    for dimension, wanted in targets.items():
        cells = target_column(cells, dimension, wanted)
    whole = cells.agg(F.sum("tokens")).scalar()
    share = F.when(F.col("_whole") > 0, F.col("tokens") / F.col("_whole")).otherwise(0.0)
    cells = cells.withColumn("_whole", whole).withColumn("share", share).drop("_whole")
    cells = written(cells.withColumn("weight", F.col("share")), "mix-cells")
    done = 0
    while done < max_rounds:
        step = cells
        for _ in range(min(ROUNDS_PER_CHECK, max_rounds - done)):
            for dimension in targets:
                margin = F.sum("weight").over(W.partitionBy(dimension))
                scaled = F.when(margin > 0, F.col("weight") * F.col(f"_target_{dimension}") / margin)
                step = step.withColumn("weight", F.coalesce(scaled, F.lit(0.0)))
        cells = written(step, "mix-cells")
        done += ROUNDS_PER_CHECK
        if largest_gap(cells, list(targets)) <= tolerance:
            break
    kept = [c for c in cells.columns if not c.startswith("_target_") and c != "weight"]
    scaled = F.when(F.col("_total") > 0, F.col("weight") / F.col("_total")).otherwise(0.0)
    total = cells.agg(F.sum("weight")).scalar()
    return cells.withColumn("_total", total).select(*kept, scaled.alias("weight"))


def largest_gap(cells: DataFrame, dimensions: Sequence[str]) -> float:
    """The largest absolute gap between a marginal and its target, one number."""
    gaps = None
    for d in dimensions:
        of = cells.groupBy(d).agg(F.sum("weight").alias("w"), F.first(f"_target_{d}").alias("t"))
        part = of.select(F.abs(F.col("w") - F.col("t")).alias("gap"))
        gaps = part if gaps is None else gaps.unionAll(part)
    return (gaps.agg(F.max("gap")).first()[0] if gaps is not None else 0.0) or 0.0


def mix(
    docs: DataFrame, targets: Mapping[str, Mapping[str, float] | float] | None = None, rate: float = 0.5,
    seed: int = 71, text: str = "text", topic: Column | None = None, cut: bool = True,
) -> DataFrame:
    """Add `topic`, `n_tokens`, `cell_weight` (target share over own share), `probability`, `weight`
    and `sampled` to documents with `doc_id, source, lang`.

    `rate` is the share of all tokens to keep. `targets` has, by dimension, shares by category or a
    power; by default each dimension moves half way, in the power, to equal shares. The texts are read
    once for the cells and joined in by none: the draws come with their narrow rows.

    `topic` is a column of that name where the table has one, else the form of the text. Where a probability
    would be above one, the rest goes into `weight`; without `cut` the rate is lowered instead until none is, so
    that the sample itself meets the targets.
    """
    targets = targets or {d: 0.5 for d in DIMENSIONS}
    made = ("n_tokens", "cell_weight", "probability", "weight", "sampled")
    if topic is None:
        own = [c for c in docs.columns if c.lower() == "topic"]
        topic = F.col(f"`{own[0]}`") if own else form_topic(F.col(text))
    rows = docs.withColumn("_topic", topic)
    rows = drop_columns(rows, "topic", *made).withColumnRenamed("_topic", "topic")
    rows = rows.withColumn("n_tokens", token_count(F.col(text)))
    # cells are sums over a first reading of the texts; the documents are then read again and get
    # their cell's factor by a join on the cell, so no text is shuffled unless cells outgrow a broadcast
    keys = {f"_c_{d}": category(d) for d in targets}
    cells = (
        rows.select(*[v.alias(d) for d, v in zip(targets, keys.values())], "n_tokens")
        .groupBy(*targets).agg(F.sum("n_tokens").alias("tokens"))
    )
    weighted = rake(written(cells, "mix-counts"), targets)
    factor = F.when(F.col("share") > 0, F.col("weight") / F.col("share")).otherwise(1.0)
    by_cell = written(
        weighted.select(*[F.col(d).alias(k) for d, k in zip(targets, keys)], factor.alias("cell_weight")), "mix-factors"
    )
    if not cut:
        rate = min(rate, 1.0 / max(by_cell.agg(F.max("cell_weight")).first()[0] or 1.0, 1.0))
    joined = rows.withColumns(keys).join(by_cell, list(keys), "left").drop(*keys)
    wanted = F.col("cell_weight") * rate
    value = F.coalesce(F.col(text), F.lit(""))
    draw = F.xxhash64(F.lit(seed), "doc_id", F.crc32(value.cast("binary")))
    uniform = F.shiftrightunsigned(draw, 11) / F.lit(float(1 << 53))
    return joined.withColumns({
        "probability": F.least(wanted, F.lit(1.0)), "weight": F.greatest(wanted, F.lit(1.0)),
        "sampled": uniform < F.least(wanted, F.lit(1.0)),
    })
