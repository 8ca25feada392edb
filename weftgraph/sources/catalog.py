"""Integration and node-type dimensions, node validation, and non-file record sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.schemas import INTEGRATION, NODE, NODE_TYPE

# The node types of the integrations.
NODE_TYPES = {
    "Matillion": ("Pipeline", "Job"),
    "Streamlit": ("App", "Chart"),
    "Snowflake Notebooks": ("Notebook", "Cell"),
}


class InvalidNodes(ValueError):
    """A nodes file with a node of the wrong shape or type."""


def read_integration(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INTEGRATION).json(path, multiLine=True)


def read_node_types(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(NODE_TYPE).json(path, multiLine=True)


def known_types(spark: SparkSession) -> DataFrame:
    rows = [(i, t) for i, types in NODE_TYPES.items() for t in types]
    return spark.createDataFrame(rows, "integration string, node_type string")


def read_records(spark: SparkSession, kind: str, path: str | None = None, **options: str) -> DataFrame:
    """Records of a warehouse query (``jdbc``) or of files on a drive (``parquet``, ``json``, ``csv``,
    ``orc``), for the parent/child converter."""
    reader = spark.read.format(kind).options(**options)
    return reader.load(path) if path else reader.load()


def _bad_dep(dep: Column) -> Column:
    node = dep["integration_name"].isNotNull() & dep["node_type"].isNotNull() & dep["node_name"].isNotNull()
    no_node = dep["integration_name"].isNull() & dep["node_type"].isNull() & dep["node_name"].isNull()
    table = dep["table_name"].isNotNull()
    return dep.isNull() | ~((node & ~table) | (no_node & table))


def problem() -> Column:
    """What is wrong with a node: it misses a field, or has a dependency of neither shape; null if nothing is. A
    parent may leave its downstream list out; the upstream list must be there."""
    lineage = F.col("lineage")
    up, down = lineage["upstream_dependencies"], lineage["downstream_dependencies"]
    none = F.array().cast(up_type())
    return (
        F.when(F.coalesce(F.col("name"), F.lit("")) == "", "no name")
        .when(F.col("node_type").isNull(), "no type")
        .when(F.col("attributes").isNull(), "no attributes")
        .when(F.col("attributes.description").isNull(), "no description")
        .when(F.col("attributes.url").isNull(), "no url")
        .when(lineage.isNull(), "no lineage")
        .when(up.isNull(), "no upstream list")
        .when(F.exists(up, _bad_dep), "bad upstream dependency")
        .when(F.exists(F.coalesce(down, none), _bad_dep), "bad downstream dependency")
    )


def invalid(nodes: DataFrame) -> DataFrame:
    """Nodes with a problem."""
    return nodes.filter(problem().isNotNull())


def reread(spark: SparkSession, path: str) -> DataFrame:
    """Every line of written nodes as a node, with the ``line`` itself and its ``problem``: a line that is no such
    document is one, with all other columns null. Lines without a problem are the nodes that are fit to read."""
    lines = spark.read.text(path)
    schema = f"{NODE.simpleString()[7:-1]},_line:string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_line"}
    rows = lines.select(F.col("value").alias("line"), F.from_json("value", f"struct<{schema}>", options).alias("node"))
    rows = rows.select("line", "node.*")
    unreadable = F.col("_line").isNotNull()
    kept = [F.when(~unreadable, F.col(c)).alias(c) for c in NODE.names]
    return rows.select("line", *kept, F.when(unreadable, "unreadable").otherwise(problem()).alias("problem"))


def up_type() -> str:
    from weftgraph.schemas import DEP

    return f"array<{DEP.simpleString()}>"


def checked(nodes: DataFrame, types: DataFrame | None = None) -> DataFrame:
    """``nodes``, or an error naming a few offenders."""
    from weftgraph.operators.graph import unknown_types

    offenders = invalid(nodes).select("name")
    if types is not None:
        offenders = offenders.unionByName(unknown_types(nodes, types).select("name"))
    found = [r["name"] for r in offenders.take(5)]
    if found:
        raise InvalidNodes(f"invalid nodes, such as {found}")
    return nodes
