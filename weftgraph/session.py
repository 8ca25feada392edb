"""Session defaults, and the one folder through which long lineages are cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings the jobs rely on. A cluster session that already carries them is left alone.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: str | int = "*", app: str = "weftgraph", **conf: str) -> SparkSession:
    """A local session for tests and measurements; on a cluster use the one spark-submit gives."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; only an unset one (tests) falls back to a local folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    fallback = spark.conf.get("spark.weftgraph.localDir", None)
    if not fallback:
        fallback = tempfile.mkdtemp(prefix="weftgraph-")
        spark.conf.set("spark.weftgraph.localDir", fallback)
    return fallback


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/weftgraph/{name}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder (with options of the writer) and go on from the written table.

    Used where a result is read by several later branches (the parsed corpus): a lost executor then
    costs a re-read of files, not a second run of the Python parse.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _path(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, files = _path(spark, path)
    return files.exists(at)


def folders(spark: SparkSession, path: str) -> list[str]:
    """The folders in a folder, none if it is not there."""
    at, files = _path(spark, path)
    found = files.listStatus(at) if files.exists(at) else []
    return [f.getPath().toString() for f in found if f.isDirectory()]


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder of the job's own in whatever store it lies."""
    at, files = _path(spark, path)
    files.delete(at, True)


#: Rows that one task gets where the work on a row is heavy but its input small in bytes.
ROWS_PER_TASK = 25_000


def spread_rows(df: DataFrame, rows: int) -> DataFrame:
    """Deal rows out evenly before heavy per-row work, in as many tasks as about ``rows`` of them need.

    Splits of a file and merged shuffle partitions go by bytes: a million short rows are one or two of them.
    A stated number of partitions is left as it is, and a row's values play no part in where it goes.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-rows // ROWS_PER_TASK)))


def spread_by(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition by the keys of the grouping that follows, which then needs no shuffle of its own.

    A stated number of partitions is not merged for being small in bytes: what comes next is heavy in
    time.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
