"""Dashboard corpus (``*.py`` that import streamlit) to table usage and nodes.

The Python worker reads string literals only; from there on queries are rows: sniffed, reduced to their
first occurrence, searched for tables, and placed in their chart by windows over marker lines.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.functions import sqlrefs, text
from weftgraph.functions.pyliterals import python_literals
from weftgraph.operators import charts, graph
from weftgraph.session import spread_by

INTEGRATION = "Streamlit"
SUFFIX = "*.py"
MARK = "import streamlit"

# Formats of names and descriptions.
TITLED = "{} - {}"
APP = "Streamlit application with {} SQL queries"
APP_TABLES = " using tables: {}"
CHART_NAME = "{} (Line {})"
CHART = "{} chart (line {}) using {}"
LINE_ANCHOR = "{}#L{}"


@dataclass(frozen=True)
class Parsed:
    apps: DataFrame  # rel_path, app_title, app_description
    usage: DataFrame  # table_usage rows, file_path = rel_path
    failures: DataFrame


def discover(artifacts: DataFrame) -> DataFrame:
    """Dashboard sources, told by their content before any Python runs."""
    return artifacts.filter(F.col("content").contains(MARK))


def extract(artifacts: DataFrame) -> DataFrame:
    """Per file: string literals, ``session.sql`` texts, marker lines, title. The text ends here."""
    content = F.col("content")
    return (
        artifacts.withColumn("_lit", python_literals(content))
        .select(
            "rel_path",
            F.col("_lit.ok").alias("ok"),
            F.col("_lit.error").alias("error"),
            # A file that is no Python has no queries, also none by pattern.
            F.when(
                F.col("_lit.ok"), F.concat("_lit.items", sqlrefs.session_calls(content))
            ).alias("items"),
            charts.marker_lines(content).alias("lines"),
            F.size(F.split(content, "\n", -1)).alias("n_lines"),
            text.app_title(content).alias("app_title"),
            F.nullif(text.app_description(content), F.lit("")).alias("app_description"),
        )
    )


def rows_of(extracted: DataFrame) -> DataFrame:
    """Rows (rel_path, n_lines, idx, line, query): every marker line, and every text that is SQL.

    A file is shuffled as the one row that it is, and all that follows finds its rows together.
    """
    # A file that is no Python has no texts; its lines count for one of the same path.
    texts = F.coalesce("items", F.array().cast("array<struct<line:int,text:string>>"))
    marker, sql = F.col("seq") >= F.col("n_texts"), F.col("sql_query")
    return (
        spread_by(extracted.select("rel_path", "n_lines", "items", "lines"), "rel_path")
        .select(
            "rel_path",
            "n_lines",
            F.size(texts).alias("n_texts"),
            F.posexplode(F.concat(texts, "lines")).alias("seq", "x"),
        )
        .withColumn("sql_query", text.strip(F.col("x.text")))
        .filter(marker | (text.looks_like_sql(sql) & ~text.reads_like_prose(sql)))
        .select(
            "rel_path",
            "n_lines",
            F.coalesce("x.line", F.lit(0)).cast("long").alias("idx"),
            F.when(marker, F.col("x.text")).alias("line"),
            F.when(~marker, F.struct("seq", F.col("x.line").alias("line_number"), sql)).alias("query"),
        )
    )


def first_occurrences(queries: DataFrame) -> DataFrame:
    """Each SQL text once per file, where it stands first."""
    same = Window.partitionBy("rel_path", "sql_query").orderBy("seq")
    return queries.withColumn("_nth", F.row_number().over(same)).filter("_nth = 1").drop("_nth")


def parse(artifacts: DataFrame, stage=lambda df, name: df) -> Parsed:
    extracted = stage(extract(artifacts), "extracted")
    numbered = first_occurrences(charts.infer(rows_of(extracted))).withColumn("id", usage_id())
    usage = sqlrefs.with_qualified_refs(numbered, "sql_query", "tables_used").select(
        "id",
        F.col("rel_path").alias("file_path"),
        "chart_type",
        "chart_name",
        "chart_caption",
        F.col("line_number").cast("int").alias("line_number"),
        "sql_query",
        "tables_used",
        F.current_timestamp().alias("created_at"),
    )
    failures = extracted.filter(~F.col("ok")).select(
        F.lit(INTEGRATION).alias("integration"), "rel_path", F.lit("file").alias("stage"), "error"
    )
    return Parsed(
        extracted.select("rel_path", "app_title", "app_description"),
        stage(usage, "usage"),
        failures,
    )


def usage_id() -> Column:
    """Number of the query within its app, from 1. Apps are numbered on their own."""
    return F.row_number().over(Window.partitionBy("rel_path").orderBy("seq")).cast("long")


def app_metadata(apps: DataFrame) -> DataFrame:
    """Only apps with a title or a description."""
    return apps.filter(F.col("app_title").isNotNull() | F.col("app_description").isNotNull())


def app_tables(usage: DataFrame) -> DataFrame:
    """Per file: number of queries and sorted distinct tables, also of queries without a chart."""
    return (
        usage.select("file_path", "id", F.explode_outer("tables_used").alias("t"))
        .groupBy("file_path")
        .agg(
            F.count_distinct("id").alias("n_queries"),
            F.sort_array(F.collect_set("t")).alias("tables"),
        )
    )


def app_description(title: Column, description: Column, n_queries: Column, tables: Column) -> Column:
    titled = F.when(description != "", text.fill(TITLED, title, description)).otherwise(title)
    using = F.when(F.size(tables) > 0, text.fill(APP_TABLES, text.preview(tables, 3))).otherwise("")
    return F.when(F.coalesce(title != "", F.lit(False)), titled).otherwise(
        F.concat(text.fill(APP, n_queries), using)
    )


def chart_label(name: Column, kind: Column, line: Column) -> Column:
    """Name of a chart within its app; the line keeps charts under one header apart."""
    at = F.coalesce(line.cast("string"), F.lit("None"))
    return text.fill(CHART_NAME, F.coalesce(F.nullif(name, F.lit("")), kind), at)


def chart_description(
    label: Column, caption: Column, kind: Column, line: Column, tables: Column
) -> Column:
    return F.when(
        F.coalesce(caption != "", F.lit(False)), text.fill(TITLED, label, caption)
    ).otherwise(text.fill(CHART, kind, line, text.preview(tables, 2)))


def charted(usage: DataFrame) -> DataFrame:
    """Queries that name at least one table."""
    return usage.filter(F.size("tables_used") > 0)


def convert(
    parsed: Parsed,
    repo_url: str | None,
    branch: str,
    single_app_name: str | None = None,
) -> DataFrame:
    """App and Chart nodes. ``single_app_name`` names the app of a one-file run; without ``repo_url``
    links are the bare paths of a local run."""
    path = F.col("rel_path")
    name = F.lit(single_app_name) if single_app_name else text.app_name(path)
    url = text.source_url(F.lit(repo_url), F.lit(branch), path) if repo_url else path

    apps = (
        parsed.apps.join(
            app_tables(parsed.usage).withColumnRenamed("file_path", "rel_path"), "rel_path", "left"
        )
        .select(
            F.lit(INTEGRATION).alias("integration"),
            name.alias("name"),
            F.lit("App").alias("node_type"),
            F.struct(
                app_description(
                    F.col("app_title"),
                    F.col("app_description"),
                    F.coalesce("n_queries", F.lit(0)),
                    F.coalesce("tables", F.array().cast("array<string>")),
                ).alias("description"),
                url.alias("url"),
            ).alias("attributes"),
            F.struct(
                graph.no_deps().alias("upstream_dependencies"),
                F.lit(None).cast(graph.no_deps_type()).alias("downstream_dependencies"),
            ).alias("lineage"),
        )
    )
    c = F.col
    label = chart_label(c("chart_name"), c("chart_type"), c("line_number"))
    chart_nodes = (
        charted(parsed.usage)
        .withColumnRenamed("file_path", "rel_path")
        .withColumn("_label", label)
        .select(
            F.lit(INTEGRATION).alias("integration"),
            F.concat_ws(".", name, "_label").alias("name"),
            F.lit("Chart").alias("node_type"),
            F.struct(
                chart_description(
                    c("_label"), c("chart_caption"), c("chart_type"), c("line_number"),
                    c("tables_used"),
                ).alias("description"),
                text.fill(LINE_ANCHOR, url, c("line_number")).alias("url"),
            ).alias("attributes"),
            F.struct(
                graph.table_refs(
                    F.filter(
                        F.transform("tables_used", text.bare_table), lambda t: t.isNotNull()
                    )
                ).alias("upstream_dependencies"),
                F.array(graph.node_ref(F.lit(INTEGRATION), F.lit("App"), name)).alias(
                    "downstream_dependencies"
                ),
            ).alias("lineage"),
        )
    )
    return apps.unionByName(chart_nodes)
