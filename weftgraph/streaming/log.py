"""What the batches of a stream wrote, as a log that can be folded.

A batch writes to a folder of its own and a batch that runs again overwrites it, so the outcome is the same. Every
row tells its batch. Folding writes what still counts of all batches so far as a snapshot, and drops the folders it
stands for once it is complete; batches that come later stay beside it. A fold that breaks off leaves an unfinished
snapshot that no reader takes, and all batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.session import exists, folders, remove

Reduce = Callable[[DataFrame], DataFrame]


def write_batch(rows: DataFrame, root: str, batch: int) -> None:
    rows.withColumn("batch", F.lit(batch).cast("bigint")).write.mode("overwrite").parquet(f"{root}/changes={batch:012d}")


def _number(folder: str) -> int:
    return int(folder.rsplit("=", 1)[-1])


def _folders(spark: SparkSession, root: str) -> tuple[str | None, list[str]]:
    """The newest complete snapshot, and the folders of complete batches after it."""
    complete = [f for f in folders(spark, root) if exists(spark, f"{f}/_SUCCESS")]
    snapshots = sorted((f for f in complete if "/snapshot=" in f), key=_number)
    newest = snapshots[-1] if snapshots else None
    later = [f for f in complete if "/changes=" in f and (newest is None or _number(f) > _number(newest))]
    return newest, sorted(later, key=_number)


def read_log(spark: SparkSession, root: str, schema: T.StructType | str) -> DataFrame:
    """All rows that count or may count, with their ``batch``; empty if no batch is there."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    newest, later = _folders(spark, root)
    paths = [*([newest] if newest else []), *later]
    if "batch" not in schema.names:
        schema = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*paths)


def fold(spark: SparkSession, root: str, schema: T.StructType | str, reduce: Reduce) -> None:
    """Takes the batches so far to a snapshot of what ``reduce`` leaves of their rows. Not to be called while a
    reader still uses an older state."""
    newest, later = _folders(spark, root)
    if not later:
        return
    rows = reduce(read_log(spark, root, schema))
    rows.write.mode("overwrite").parquet(f"{root}/snapshot={_number(later[-1]):012d}")
    for folder in [*([newest] if newest else []), *later]:
        remove(spark, folder)


def drop_before(spark: SparkSession, root: str, batch: int) -> None:
    """Deletes the batches and snapshots before a batch, none of whose rows counts any more. What a fold says of
    readers holds here too."""
    for folder in folders(spark, root):
        if _number(folder) < batch:
            remove(spark, folder)
