"""The collapsed job graph kept up to date: accesses come and go in batches, and a batch renews the edges of the
tables it touches.

Three logs lie below a root: ``accesses`` (job, table_name, mode, present), ``edges``, and ``tables``, which tells
for every table the last batch that touched it and is written last. Whether an edge stays with its table depends on
that table's accesses alone, so the edges of a table are those its last batch wrote, maybe none, and tables that a
batch does not touch are neither shuffled nor written again. A batch that touches more than half of all tables
renews all of them instead: it writes a row without a table to ``tables``, and no edge before it counts.

The newest change of an access counts; of several in one batch, one that is present. Rows without a job, a table or
a mode are left out. A batch that runs again overwrites what it wrote.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.operators import graph
from weftgraph.plans import skew
from weftgraph.session import stage_table
from weftgraph.streaming.log import drop_before, fold, read_log, write_batch

ACCESS = ["job", "table_name", "mode"]
#: How the snapshot of accesses is sorted: names that are alike lie side by side, there and in shuffles of it.
IN_ORDER = ["table_name", "job"]
CHANGES = "job string, table_name string, mode string, present boolean"
EDGES = "src_kind string, src string, dst_kind string, dst string, table_name string"
TABLES = "table_name string"
#: Up to so many touched tables their digests, 8 bytes each, are sent to the accesses.
MOST_SENT = 1_000_000
#: Of ``tables``, after which no batch was whole yet.
NEVER = -1


def ingest_accesses(changes: DataFrame, root: str, checkpoint: str, **trigger: object) -> None:
    """Run until the input is used up (or as ``trigger`` says)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        renew(batch, root, batch_id)

    (
        changes.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
        .awaitTermination()
    )


def renew(changes: DataFrame, root: str, batch: int) -> None:
    """One batch of changes: they are logged, and the edges of their tables are made anew."""
    spark = changes.sparkSession
    write_batch(changes.select(*ACCESS, "present").dropna(subset=ACCESS), f"{root}/accesses", batch)
    log = read_log(spark, f"{root}/accesses", CHANGES).where(F.col("batch") <= batch)
    own = F.col("batch") == batch
    if _touches_most(log, own):
        rows, touched = log, spark.createDataFrame([(None,)], TABLES)
    else:
        touched = stage_table(log.where(own).select("table_name").distinct(), "touched")
        rows = of_tables(log, touched)
    _write_edges(rows, root, batch)
    write_batch(touched, f"{root}/tables", batch)


def _touches_most(log: DataFrame, own: Column) -> bool:
    """Whether about more than half of the tables are touched. Only the work depends on the estimate."""
    table = F.col("table_name")
    every, touched = log.agg(F.approx_count_distinct(table), F.approx_count_distinct(F.when(own, table))).first()
    return 2 * touched > every


def _write_edges(rows: DataFrame, root: str, batch: int) -> None:
    """The edges of the accesses that are there after the changes ``rows``."""
    n = skew.rows_if_light(rows, graph.TABLE)
    if n is None:
        edges = graph.job_edges(stage_table(_newest(rows).where("present").select(*ACCESS), "accesses"))
        write_batch(edges, f"{root}/edges", batch)
        return
    # One shuffle, by table; all that follows finds the rows where they lie.
    spark = rows.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, -(-n // skew.rows_per_split(spark)))
    placed = rows.select(*ACCESS, _age().alias("_age")).repartition(parts, "table_name")
    now = _newest(placed, F.col("_age")).where("present").select(*ACCESS)
    profiled = graph.profile_placed(now).persist(StorageLevel.DISK_ONLY)
    try:
        write_batch(graph.edges_of(graph.tag_profiled(profiled)), f"{root}/edges", batch)
    finally:
        profiled.unpersist()


def of_tables(log: DataFrame, touched: DataFrame) -> DataFrame:
    """The rows of the log on touched tables. Few tables go to the log as digests, and no other row of it is
    shuffled; many are joined, with heavy tables cut."""
    if touched.count() <= MOST_SENT:
        # Tables that share a digest come along, and their edges as they were.
        digests = touched.select(F.xxhash64("table_name").alias("_digest"))
        return log.withColumn("_digest", F.xxhash64("table_name")).join(F.broadcast(digests), "_digest", "left_semi").drop("_digest")
    hot = skew.find_hot(log, graph.TABLE)
    return skew.salted_join(log, touched, graph.TABLE, "left_semi", hot, ["job", "mode", "batch"]).select(log.columns)


def _age() -> Column:
    """Of a change, as a number, so that an aggregate needs no sorted rows: the batch, then presence."""
    return F.col("batch") * 2 + F.coalesce("present", F.lit(False)).cast("bigint")


def _newest(changes: DataFrame, age: Column | None = None) -> DataFrame:
    newest = F.max(_age() if age is None else age)
    found = changes.groupBy(*ACCESS).agg(newest.alias("_age"))
    return found.select(*ACCESS, F.expr("_age % 2 = 1").alias("present"), F.expr("_age div 2").alias("batch"))


def _last_touched(spark: SparkSession, root: str) -> tuple[int, DataFrame]:
    """The last batch that renewed all tables, and for each table touched later the last one to do so."""
    touched, none = read_log(spark, f"{root}/tables", TABLES), F.col("table_name").isNull()
    whole = touched.where(none).agg(F.max("batch")).first()[0]
    whole = NEVER if whole is None else whole
    later = touched.where(~none & (F.col("batch") > whole))
    return whole, later.groupBy("table_name").agg(F.max("batch").alias("batch"))


def _counting(edges: DataFrame, whole: int, later: DataFrame) -> DataFrame:
    """The edges that the last batch of their table wrote. Tables with very many edges are cut."""
    if later.isEmpty():
        return edges.where(F.col("batch") == whole)
    columns = edges.columns
    edges = edges.where(F.col("batch") >= whole)
    hot = skew.find_hot(edges, graph.TABLE)
    last = later.withColumnRenamed("batch", "_last")
    found = skew.salted_join(edges, last, graph.TABLE, "left", hot, ["src", "dst"])
    return found.where(F.col("batch") == F.coalesce("_last", F.lit(whole))).select(columns)


def current_edges(spark: SparkSession, root: str) -> DataFrame:
    """The edges after all batches, as ``graph.job_edges`` gives them from all accesses."""
    edges = read_log(spark, f"{root}/edges", EDGES)
    return _counting(edges, *_last_touched(spark, root)).drop("batch")


def fold_edges(spark: SparkSession, root: str) -> None:
    """What counts of all batches so far in place of them. Each log's snapshot is whole for itself, so breaking
    off between two of them loses nothing."""
    whole, later = _last_touched(spark, root)
    later = stage_table(later, "touched")
    fold(spark, f"{root}/accesses", CHANGES, lambda rows: _newest(rows).where("present").sortWithinPartitions(*IN_ORDER))
    # Edges of a batch that renewed all tables stay as they are while no later batch has touched any.
    drop_before(spark, f"{root}/edges", whole)
    if not later.isEmpty():
        fold(spark, f"{root}/edges", EDGES, lambda rows: _counting(rows, whole, later))
    fold(
        spark,
        f"{root}/tables",
        TABLES,
        lambda rows: rows.where(F.col("batch") >= whole).groupBy("table_name").agg(F.max("batch").alias("batch")),
    )
