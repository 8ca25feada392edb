"""Notebook corpus (``*.ipynb``) to nodes. JSON is read as VARIANT; Python runs for Python cells only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.functions import nested, sqlrefs, text
from weftgraph.functions.pyliterals import python_literals
from weftgraph.operators import cells as cell_ops
from weftgraph.operators import graph

INTEGRATION = "Snowflake Notebooks"
SUFFIX = "*.ipynb"


@dataclass(frozen=True)
class Parsed:
    notebooks: DataFrame  # rel_path, notebook_name, description
    cells: DataFrame  # rel_path, cell_index, title, language, tables, source_snippet
    failures: DataFrame


def source_text(cell: Column) -> Column:
    """``source`` as a list of lines or as one string."""
    lines = F.try_variant_get(cell, "$.source", "array<string>")
    return F.coalesce(
        F.array_join(lines, ""), F.try_variant_get(cell, "$.source", "string"), F.lit("")
    )


def _unreadable(cell: Column) -> Column:
    """A null where a value must be, in a cell whose value is read."""
    kind = F.try_variant_get(cell, "$.cell_type", "string")
    code = F.lit(False)
    for path in ("$.metadata", "$.metadata.language", "$.metadata.title", "$.source"):
        code = code | nested.missing_or_null(cell, path)
    markdown = (kind == "markdown") & nested.missing_or_null(cell, "$.source")
    return F.coalesce(((kind == "code") & code) | markdown, F.lit(False))


def split_cells(artifacts: DataFrame) -> DataFrame:
    """rel_path, cells (array of VARIANT), error. Bad JSON leaves no cells but keeps the file."""
    v = F.try_parse_json("content")
    return artifacts.select("rel_path", v.alias("v")).select(
        "rel_path",
        F.coalesce(
            F.try_variant_get("v", "$.cells", "array<variant>"), F.array().cast("array<variant>")
        ).alias("cells"),
        F.when(F.col("v").isNull(), "invalid JSON")
        .when(F.try_variant_get("v", "$", "map<string,variant>").isNull(), "not an object")
        .alias("error"),
    )


def code_cells(notebooks: DataFrame) -> DataFrame:
    """One row per code cell with defaults filled in: cell_index, title, language, source."""
    cell = F.col("cell")
    lang = cell_ops.language(F.try_variant_get(cell, "$.metadata.language", "string"))
    return (
        notebooks.select("rel_path", F.posexplode("cells").alias("cell_index", "cell"))
        .filter(F.try_variant_get(cell, "$.cell_type", "string") == "code")
        .select(
            "rel_path",
            "cell_index",
            cell_ops.title(
                F.try_variant_get(cell, "$.metadata.title", "string"), F.col("cell_index"), lang
            ).alias("title"),
            lang.alias("language"),
            source_text(cell).alias("source"),
        )
    )


def notebook_heading(cells: Column) -> Column:
    """Heading of the first markdown cell that has one."""
    marked = F.filter(
        cells, lambda c: F.try_variant_get(c, "$.cell_type", "string") == "markdown"
    )
    headings = F.transform(marked, lambda c: text.heading(source_text(c)))
    return F.coalesce(F.get(F.filter(headings, lambda h: h.isNotNull()), F.lit(0)), F.lit(""))


def cell_tables(cells: DataFrame) -> DataFrame:
    """``tables`` and snippet per cell: SQL cells by their text, Python cells by their SQL-looking
    literals. Only these narrow rows are shuffled, the source text is not."""
    literal = python_literals(F.when(F.col("language") == "python", F.col("source")))
    found = F.transform(literal["items"], lambda i: text.strip(i["text"]))
    statements = F.when(F.col("language") == "sql", F.array("source")).otherwise(
        F.filter(found, text.looks_like_sql)
    )
    narrow = ["rel_path", "cell_index", "title", "language", "source_snippet"]
    each = cells.withColumn("source_snippet", text.snippet(F.col("source"))).select(
        *narrow, F.explode_outer(statements).alias("_one")
    )
    lists = F.flatten(F.collect_list("_tables"))
    return (
        sqlrefs.with_read_refs(each, "_one", "_tables")
        .groupBy(*narrow)
        .agg(F.array_sort(F.array_distinct(lists)).alias("tables"))
    )


def parse(artifacts: DataFrame, stage=lambda df, name: df) -> Parsed:
    files = split_cells(artifacts).withColumn(
        "error",
        F.coalesce(
            "error", F.when(F.exists("cells", _unreadable), "null where a value must be")
        ),
    )
    # A file that is no JSON still is a (nameless) notebook; one of the wrong shape is not.
    kept = files.filter(F.col("error").isNull() | (F.col("error") == "invalid JSON"))
    cells = stage(code_cells(kept), "cells")
    stem = text.file_stem(F.col("rel_path"))
    notebooks = kept.select(
        "rel_path",
        F.when(F.col("error").isNull(), text.title_case(F.translate(stem, "_", " ")))
        .otherwise(stem)
        .alias("notebook_name"),
        notebook_heading(F.col("cells")).alias("description"),
    )
    with_tables = cell_tables(cells)
    failures = files.filter(F.col("error").isNotNull()).select(
        F.lit(INTEGRATION).alias("integration"), "rel_path", F.lit("file").alias("stage"), "error"
    )
    return Parsed(stage(notebooks, "notebooks"), stage(with_tables, "cell-tables"), failures)


def convert(parsed: Parsed, repo_url: str, branch: str) -> DataFrame:
    """Notebook and Cell nodes; cells without tables are kept."""
    keys = ["rel_path"]
    url = text.source_url(F.lit(repo_url), F.lit(branch), F.col("rel_path"))
    heads = parsed.notebooks.join(cell_ops.counts(parsed.cells, keys), keys, "left").select(
        F.lit(INTEGRATION).alias("integration"),
        F.col("notebook_name").alias("name"),
        F.lit("Notebook").alias("node_type"),
        F.struct(
            cell_ops.notebook_description(
                F.col("description"),
                F.coalesce("n_cells", F.lit(0)),
                F.coalesce("n_sql_cells", F.lit(0)),
            ).alias("description"),
            url.alias("url"),
        ).alias("attributes"),
        F.struct(
            graph.no_deps().alias("upstream_dependencies"),
            F.lit(None).cast(graph.no_deps_type()).alias("downstream_dependencies"),
        ).alias("lineage"),
    )
    named = cell_ops.unique_titles(parsed.cells, keys).join(
        parsed.notebooks.select("rel_path", "notebook_name"), keys
    )
    cells = named.select(
        F.lit(INTEGRATION).alias("integration"),
        F.concat_ws(".", "notebook_name", "unique_title").alias("name"),
        F.lit("Cell").alias("node_type"),
        F.struct(
            cell_ops.cell_description(
                F.col("language"), F.col("unique_title"), F.col("tables"), F.col("source_snippet")
            ).alias("description"),
            url.alias("url"),
        ).alias("attributes"),
        F.struct(
            graph.table_refs(F.col("tables")).alias("upstream_dependencies"),
            F.array(
                graph.node_ref(F.lit(INTEGRATION), F.lit("Notebook"), F.col("notebook_name"))
            ).alias("downstream_dependencies"),
        ).alias("lineage"),
    )
    return heads.unionByName(cells)
