"""Incremental ingest: rows of a stream become nodes, and nodes are upserted batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.operators import graph
from weftgraph.plans import orchestration
from weftgraph.schemas import NODE
from weftgraph.session import stage_table
from weftgraph.sinks.tables import upsert
from weftgraph.streaming.log import fold, read_log, write_batch

TABLES = ("docs", "components", "failures")

Convert = Callable[[DataFrame], DataFrame]


def stream_table(
    spark: SparkSession, folder: str, name: str, schema: str, files_per_trigger: int = 1000
) -> DataFrame:
    """A folder of parquet files as a stream; ``name`` picks files by glob."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", name)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(folder)
    )


def ingest_nodes(
    records: DataFrame, convert: Convert, root: str, checkpoint: str, **trigger: object
) -> None:
    """Run until the input is used up (or as ``trigger`` says).

    Each batch adds the nodes it met to the log and never rewrites what was there.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(convert(batch), root, batch_id)

    (
        records.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
        .awaitTermination()
    )


VERSIONED = T.StructType([*NODE.fields, T.StructField("modified_at", T.TimestampType())])


def current_nodes(spark: SparkSession, root: str, published: DataFrame | None = None) -> DataFrame:
    """The node set after all batches, on top of an already ``published`` one.

    ``sinks.tables.write_version`` publishes the outcome; the batches below ``root`` can then go.
    """
    return upsert(published, read_log(spark, root, VERSIONED).drop("batch"))


def fold_nodes(spark: SparkSession, root: str) -> None:
    """The newest version of every node in place of all batches so far."""
    order = [F.col("modified_at"), F.col("node_type")]
    fold(spark, root, VERSIONED, lambda rows: graph.latest(rows, ["integration", "name"], order).select(*VERSIONED.names, "batch"))


def ingest_flows(artifacts: DataFrame, root: str, checkpoint: str, **trigger: object) -> None:
    """Orchestration files as they arrive or change: each batch is parsed and logged, not converted.

    Hand-offs and calls cross files, so nodes come from ``current_flows``, which knows all of them.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = orchestration.parse(batch, stage_table)
        for table in TABLES:
            write_batch(getattr(parsed, table), f"{root}/{table}", batch_id)

    (
        artifacts.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
        .awaitTermination()
    )


def _flow_logs(spark: SparkSession, root: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """The logs of all tables, and for every file the last batch that had it."""
    none = orchestration.parse(spark.createDataFrame([], "rel_path string, content string"))
    logs = {t: read_log(spark, f"{root}/{t}", getattr(none, t).schema) for t in TABLES}
    seen = [logs[t].select("rel_path", "batch") for t in ("docs", "failures")]
    newest = seen[0].unionByName(seen[1]).groupBy("rel_path").agg(F.max("batch").alias("batch"))
    return logs, stage_table(newest, "newest")


def current_flows(spark: SparkSession, root: str) -> orchestration.Parsed:
    """What the last batch said about each file, ready for ``orchestration.convert``."""
    logs, newest = _flow_logs(spark, root)
    return orchestration.Parsed(
        **{t: log.join(newest, ["rel_path", "batch"], "left_semi").drop("batch") for t, log in logs.items()}
    )


def fold_flows(spark: SparkSession, root: str) -> None:
    """The newest version of every file in place of all batches so far. Each table's snapshot is whole for
    itself, so breaking off between two of them loses nothing."""
    logs, newest = _flow_logs(spark, root)
    for table, log in logs.items():
        kept = lambda rows: rows.join(newest, ["rel_path", "batch"], "left_semi").select(*rows.columns)
        fold(spark, f"{root}/{table}", log.schema, kept)


def distinct_arrivals(records: DataFrame, time: str, keys: list[str], delay: str) -> DataFrame:
    """Drop replays of a record that arrive within ``delay``; state is bounded by the watermark.

    A record counts as long as it is no further behind the newest of earlier batches than ``delay``; what comes
    later than that is dropped, replays too, so none is ever let through once its key is forgotten.
    """
    return records.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def ingest_distinct(
    records: DataFrame, time: str, keys: list[str], delay: str, root: str, checkpoint: str, **trigger: object
) -> None:
    """Log every record once, however often it arrives. The keys seen are state, so a stream that is stopped and
    started again with the same folders still knows them."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, root, batch_id)

    (
        distinct_arrivals(records, time, keys, delay)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
        .awaitTermination()
    )
