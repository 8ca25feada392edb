"""Usage analytics over ``table_usage`` rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.operators import graph
from weftgraph.plans import skew

TABLE = ("table_name",)


def unnested(usage: DataFrame) -> DataFrame:
    """One row per table of a query; empty names are dropped."""
    return usage.select(
        F.explode("tables_used").alias("table_name"), "chart_type", "chart_name"
    ).filter(F.col("table_name").isNotNull() & (F.col("table_name") != ""))


def counted(rows: DataFrame) -> DataFrame:
    """Uses per (table, chart type, chart name). What streams keep as state."""
    return rows.groupBy("table_name", "chart_type", "chart_name").agg(F.count(F.lit(1)).alias("n"))


def totals(counts: DataFrame) -> DataFrame:
    """table -> usage_count and its sorted chart types, of which there are few."""
    return counts.groupBy(*TABLE).agg(
        F.sum("n").alias("usage_count"),
        F.array_sort(F.collect_set("chart_type")).alias("used_in_chart_types"),
    )


def summary(counts: DataFrame) -> DataFrame:
    """Tables by usage, each with a row per distinct chart name (a null name counts as one): table_name,
    usage_count, used_in_chart_types, chart_name. Starts from ``counted`` rows; no list of names is built."""
    names = counts.select(*TABLE, "chart_name").distinct()
    return names.join(totals(counts), list(TABLE)).select(
        *TABLE, "usage_count", "used_in_chart_types", "chart_name"
    ).orderBy(F.desc("usage_count"), *TABLE, "chart_name")


def usage_summary(usage: DataFrame) -> DataFrame:
    return summary(counted(unnested(usage)))


def with_ids(usage: DataFrame, order: list[str]) -> DataFrame:
    """``id`` from 1 within each file, in ``order``."""
    return skew.number_rows(usage, ["file_path"], order, "id")


def results(usage: DataFrame) -> DataFrame:
    """The usage table in id order."""
    return usage.orderBy("file_path", "id")


def file_tables(usage: DataFrame) -> DataFrame:
    """(file_path, position, table_name): the distinct tables of every file in order, a row each."""
    pairs = usage.select("file_path", F.explode("tables_used").alias("table_name")).distinct()
    return skew.number_rows(pairs, ["file_path"], ["table_name"], "position")


def first_metadata(metadata: DataFrame) -> DataFrame:
    """The first metadata row of each file."""
    return graph.earliest(metadata, ["file_path"], [F.col("created_at"), F.col("id")])
