"""Writers: node documents, failures and usage tables as committed runs, and the upserted node catalogue."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.operators import graph
from weftgraph.schemas import APP_METADATA, NODE, PARSE_FAILURE, TABLE_USAGE
from weftgraph.session import exists, folders, remove


#: Tables of a run, by folder, with the form they are written in and their columns.
TABLES = {
    "nodes": ("json", NODE),
    "failures": ("json", PARSE_FAILURE),
    "table_usage": ("parquet", TABLE_USAGE),
    "app_metadata": ("parquet", APP_METADATA),
}
MANIFEST = "integration string, run string, tables array<string>, nr bigint"


class Run:
    """One run of an integration: its tables go to folders of their own, and count only once the run is
    committed. Then they take the place of what the integration's last run wrote, tables without rows and
    tables that this run has not written too; those of other integrations stay. A run that breaks off changes
    nothing for readers."""

    def __init__(self, spark: SparkSession, root: str, integration: str):
        self.spark, self.root, self.integration = spark, root.rstrip("/"), integration
        self.name = uuid.uuid4().hex
        self.tables: list[str] = []

    def write(self, table: str, rows: DataFrame) -> None:
        """Nodes and failures are JSON lines without null fields, so a dependency shows either shape."""
        kind = TABLES[table][0]
        # The folder tells the integration.
        rows = rows.drop("integration")
        options = {"ignoreNullFields": "true"} if kind == "json" else {}
        rows.write.mode("overwrite").options(**options).format(kind).save(_folder(self.root, table, self.integration, self.name))
        self.tables.append(table)

    def commit(self) -> None:
        """One row of the manifest, in a file of its own, which is there whole or not at all."""
        last = max([r["nr"] for r in _manifest(self.spark, self.root)], default=0)
        row = [(self.integration, self.name, self.tables, last + 1)]
        self.spark.createDataFrame(row, MANIFEST).coalesce(1).write.mode("append").json(f"{self.root}/runs")


def _folder(root: str, table: str, integration: str, run: str) -> str:
    return f"{root.rstrip('/')}/{table}/integration={integration}/run={run}"


def _manifest(spark: SparkSession, root: str) -> list[Row]:
    """The newest committed run of every integration: as many rows as there are integrations."""
    path = f"{root.rstrip('/')}/runs"
    if not exists(spark, path):
        return []
    rows = spark.read.schema(MANIFEST).json(path)
    newest = F.max_by(F.struct("run", "tables", "nr"), F.struct("nr", "run")).alias("r")
    runs = rows.groupBy("integration").agg(newest).select(F.struct("integration", "r.*").alias("run"))
    return runs.agg(F.collect_list("run").alias("runs")).first()["runs"]


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """What the newest committed runs of all integrations wrote to a table; empty if there is none."""
    kind, schema = TABLES[table]
    runs = [r for r in _manifest(spark, root) if table in r["tables"]]
    columns = [T.StructField("integration", T.StringType()), *(f for f in schema.fields if f.name != "integration")]
    schema = T.StructType(columns)
    if not runs:
        return spark.createDataFrame([], schema)
    paths = [_folder(root, table, r["integration"], r["run"]) for r in runs]
    base = f"{root.rstrip('/')}/{table}"
    rows = spark.read.schema(schema).option("basePath", base).format(kind).load(paths)
    return rows.select(schema.names)


def read_nodes(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, "nodes")


def write_app_metadata(run: Run, apps: DataFrame) -> None:
    """Apps with a title or a description; others leave no row."""
    rows = apps.filter(F.col("app_title").isNotNull() | F.col("app_description").isNotNull()).select(
        F.lit(1).cast("long").alias("id"),
        F.col("rel_path").alias("file_path"),
        "app_title",
        "app_description",
        F.current_timestamp().alias("created_at"),
    )
    run.write("app_metadata", rows)


def drop_old_runs(spark: SparkSession, root: str) -> int:
    """Deletes the folders of runs that are not the newest of their integration, and tells how many. To be
    called when no reader of an older run and no open run is left."""
    kept = {(r["integration"], r["run"]) for r in _manifest(spark, root)}
    gone = 0
    for table in TABLES:
        for of in folders(spark, f"{root.rstrip('/')}/{table}"):
            for run in folders(spark, of):
                names = of.rsplit("integration=", 1)[-1], run.rsplit("run=", 1)[-1]
                if names not in kept:
                    remove(spark, run)
                    gone += 1
    return gone


def upsert(existing: DataFrame | None, incoming: DataFrame) -> DataFrame:
    """Node set after a run: nodes are keyed by integration and name, the newest run wins.

    Both sides carry ``modified_at``; a row without one is older than any with one.
    """
    keys = ["integration", "name"]
    rows = incoming if existing is None else existing.unionByName(incoming)
    return graph.latest(rows, keys, [F.col("modified_at"), F.col("node_type")])


def write_version(rows: DataFrame, root: str, version: str) -> str:
    """Write a new version of a table next to the old ones and give its path. Overwriting a version
    makes a retried run harmless."""
    path = f"{root.rstrip('/')}/version={version}"
    rows.write.mode("overwrite").parquet(path)
    return path
