"""Continuously updated usage summary.

The state of the stream is one counter per (table, chart type, chart name); no list grows in it. Each
batch writes the counters it changed, and the summary is built from the newest value of each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.operators.usage import counted, summary, unnested
from weftgraph.streaming.log import fold, read_log, write_batch

COUNTS = "table_name string, chart_type string, chart_name string, n bigint"
KEYS = ["table_name", "chart_type", "chart_name"]


def count_usage(usage: DataFrame, root: str, checkpoint: str, **trigger: object) -> None:
    """Run until the input is used up (or as ``trigger`` says). Started again with the same folders it goes on
    with the counters it had."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, root, batch_id)

    (
        counted(unnested(usage))
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
        .awaitTermination()
    )


def _newest(changes: DataFrame) -> DataFrame:
    return changes.groupBy(*KEYS).agg(F.max_by("n", "batch").alias("n"), F.max("batch").alias("batch"))


def fold_usage(spark: SparkSession, root: str) -> None:
    """One row per counter in place of all changes so far."""
    fold(spark, root, COUNTS, _newest)


def current_summary(spark: SparkSession, root: str) -> DataFrame:
    return summary(_newest(read_log(spark, root, COUNTS)).drop("batch"))
