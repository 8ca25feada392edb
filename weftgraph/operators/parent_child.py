"""Generic integration: one parent node per source, one child node per record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.functions.text import fill
from weftgraph.operators import graph


# Formats of descriptions.
PARENT = "Auto-generated parent node for {}."
CHILD = "Child node: {}."


def parent_child_nodes(
    records: DataFrame,
    integration: str,
    parent: Column,
    child: Column,
    table: Column,
    url: Column,
    parent_type: str = "ParentNode",
    child_type: str = "ChildNode",
    direction: str = "downstream",
    sources: DataFrame | None = None,
) -> DataFrame:
    """Nodes of records from any source (files, a warehouse query, a stream).

    Parents are those of ``sources`` (rows with what ``parent`` and ``url`` ask for, whether or not they
    hold records), or else of the records.

    ``direction`` tells whether a child writes its table (``downstream``) or reads it (``upstream``);
    a child of the second kind feeds its parent, one of the first kind belongs to it.
    """
    rows = records.select(
        parent.alias("parent"),
        F.coalesce(child, F.lit("unknown")).alias("child"),
        F.nullif(F.lower(table), F.lit("")).alias("table_name"),
        url.alias("url"),
    )
    name = F.lit(integration)
    of_parent = F.array(graph.node_ref(name, F.lit(parent_type), F.col("parent")))
    of_table = F.when(
        F.col("table_name").isNotNull(), F.array(graph.table_ref(F.col("table_name")))
    ).otherwise(graph.no_deps())
    up, down = (of_parent, of_table) if direction == "downstream" else (of_table, of_parent)

    def nodes(rows: DataFrame, node: Column, kind: str, text: Column, up: Column, down: Column):
        return rows.select(
            name.alias("integration"),
            node.alias("name"),
            F.lit(kind).alias("node_type"),
            F.struct(text.alias("description"), F.col("url")).alias("attributes"),
            F.struct(
                up.alias("upstream_dependencies"), down.alias("downstream_dependencies")
            ).alias("lineage"),
        )

    held = rows if sources is None else sources.select(parent.alias("parent"), url.alias("url"))
    parents = held.groupBy("parent").agg(F.min("url").alias("url"))
    return nodes(
        parents,
        F.col("parent"),
        parent_type,
        fill(PARENT, F.col("parent")),
        graph.no_deps(),
        F.lit(None).cast(graph.no_deps_type()),
    ).unionByName(
        nodes(
            rows,
            F.concat_ws(".", "parent", "child"),
            child_type,
            fill(CHILD, F.col("child")),
            up,
            down,
        )
    )
