"""Message scoring and feedback streams.

All transforms are row-wise, so the streams keep no state and need no watermark. Restarts
continue from the checkpoint; the file sink commits each micro-batch once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from hooklens.lists import RuleLists
from hooklens.models.experiments import score_messages
from hooklens.operators.rules import DEFAULT_THRESHOLD, evaluate_rules, hybrid_decision
from hooklens.schema import FEEDBACK, SCORING_REQUEST


def message_stream(
    spark: SparkSession, path: str, schema: StructType = SCORING_REQUEST, format: str = "json",
    files_per_trigger: int = 1000,
) -> DataFrame:
    reader = spark.readStream.format(format).schema(schema)
    return reader.option("maxFilesPerTrigger", files_per_trigger).load(path)


def decide(
    messages: DataFrame,
    scorer: PipelineModel | Callable[[DataFrame], DataFrame] | None = None,
    threshold: float = DEFAULT_THRESHOLD,
    rules: RuleLists = RuleLists(),
) -> DataFrame:
    """Score, rule reasons and decision of every message, for tables and streams alike.

    Without a scorer the table has to carry a `score` column.
    """
    if scorer is None:
        scored = messages
    elif isinstance(scorer, PipelineModel):
        scored = score_messages(scorer, messages)
    else:
        scored = scorer(messages)
    judged = hybrid_decision(evaluate_rules(scored, rules), threshold)
    return judged.select(
        "id", "score", "risk_score", "reasons", F.col("decision").alias("label"), "decision_source"
    )


def start_append(
    stream: DataFrame, path: str, checkpoint: str, format: str = "parquet", available_now: bool = True
) -> StreamingQuery:
    """Append a stream to a folder; by default process what is there and stop."""
    writer = stream.writeStream.format(format).outputMode("append").option("path", path)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def feedback_stream(spark: SparkSession, path: str) -> DataFrame:
    """Feedback records from JSON lines; rows without id or label are dropped as invalid."""
    records = spark.readStream.schema(FEEDBACK).json(path)
    return records.filter(F.col("id").isNotNull() & F.col("label_true").isNotNull())
