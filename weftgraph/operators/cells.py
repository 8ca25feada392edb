"""Notebook cells: defaults, unique titles, descriptions, counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.functions import text
from weftgraph.plans import skew

# Formats of titles and descriptions.
UNTITLED = "Cell {} ({})"
REPEATED = "{} ({})"
NOTEBOOK = "Snowflake Notebook with {} code cell(s){}."
QUERYING = ", {} querying dbt model output"
CELL = "{} cell: **{}**."
CELL_TABLES = " Queries tables: {}."
CELL_SOURCE = " `{}…`"
SOURCE_SHOWN = 120


def language(given: Column) -> Column:
    return F.lower(F.coalesce(given, F.lit("python")))


def title(given: Column, index: Column, lang: Column) -> Column:
    """A blank title becomes ``Cell <n> (<language>)``."""
    bare = F.coalesce(text.strip(given), F.lit(""))
    return F.when(bare == "", text.fill(UNTITLED, index + 1, lang)).otherwise(bare)


def unique_titles(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The k-th cell of equal title gets `` (k)``, in cell order; adds ``unique_title``."""
    numbered = skew.number_rows(cells, [*keys, "title"], ["cell_index"], "_k")
    return numbered.withColumn(
        "unique_title",
        F.when(F.col("_k") > 1, text.fill(REPEATED, F.col("title"), F.col("_k"))).otherwise(
            F.col("title")
        ),
    ).drop("_k")


def counts(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    return cells.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_cells"), F.count_if(F.size("tables") > 0).alias("n_sql_cells")
    )


def notebook_description(given: Column, n_cells: Column, n_sql: Column) -> Column:
    querying = F.when(n_sql > 0, text.fill(QUERYING, n_sql)).otherwise("")
    return F.coalesce(F.nullif(given, F.lit("")), text.fill(NOTEBOOK, n_cells, querying))


def cell_description(lang: Column, name: Column, tables: Column, snippet: Column) -> Column:
    quoted = F.transform(tables, lambda t: text.fill("`{}`", t))
    shown = text.fill(CELL_SOURCE, text.strip(F.substring(snippet, 1, SOURCE_SHOWN)))
    more = F.when(
        F.size(tables) > 0, text.fill(CELL_TABLES, text.preview(quoted, 3))
    ).otherwise(F.when(snippet != "", shown).otherwise(""))
    return F.concat(text.fill(CELL, F.upper(lang), name), more)
