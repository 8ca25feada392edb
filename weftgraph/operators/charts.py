"""Which chart a query ends up in: markers by line, windows around the query's line.

Only lines that mean something (a rendered result, a header, a tab, a caption) become rows, so a file
of any length is a few rows. Its rows come from one artifact, which one row of the corpus holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.functions.text import call_text, render_type

# How far rendering, tab definition and caption may be away, in lines.
RENDER_REACH = 50
TAB_REACH = 30
CAPTION_REACH = 10

# Patterns of a tab being used and of tabs being defined.
TAB_USE = r"with\s+(\w+)\[.*?\]"
TAB_DEF = r"(\w+)\s*=\s*st\.tabs\(\[(.*?)\]"


def marker_lines(content: Column) -> Column:
    """Array of (line, text) of the lines that can mean something; their numbers are 0-based."""
    lines = F.transform(
        F.split(content, "\n", -1), lambda x, i: F.struct(i.alias("line"), x.alias("text"))
    )
    return F.filter(
        lines,
        lambda x: x["text"].contains("st.")
        | x["text"].contains("to_pandas()")
        | x["text"].contains("with"),
    )


def markers(line: Column) -> list[Column]:
    """What a line means; all null where ``line`` is null."""

    def found(c: Column) -> Column:
        return F.nullif(c, F.lit(""))

    # Patterns are looked for in the lines that hold their words.
    def tabs(group: int) -> Column:
        return F.when(line.contains("st.tabs(["), found(F.regexp_extract(line, TAB_DEF, group)))

    use = F.when(line.contains("with"), found(F.regexp_extract(line, TAB_USE, 1)))
    return [
        render_type(line).alias("render"),
        F.coalesce(call_text(line, "subheader"), call_text(line, "header")).alias("title"),
        use.alias("tab"),
        tabs(1).alias("def_tab"),
        found(F.regexp_extract(tabs(2), r"""["']([^"']+)["']""", 1)).alias("def_label"),
        call_text(line, "caption").alias("caption"),
    ]


def infer(rows: DataFrame) -> DataFrame:
    """Adds chart_type, chart_name, chart_caption to the query rows of (rel_path, n_lines, idx, line, query) rows.

    A row is a line that can mean something, with its ``line``, or a query, with its columns in the struct ``query``
    and the index its search starts at: the 0-based one that equals its 1-based line number, that is, the line after
    its first.
    """
    rows = rows.select("rel_path", "n_lines", "idx", "query", *markers(F.col("line")))
    file = Window.partitionBy("rel_path").orderBy("idx")

    known = F.when(
        F.col("def_label").isNotNull() & (F.col("idx") >= 1),
        F.struct(F.col("def_tab").alias("tab"), F.col("def_label").alias("label")),
    )
    near = F.collect_list(known).over(file.rangeBetween(-(TAB_REACH - 1), 0))
    rows = rows.withColumn("_near", F.when(F.col("tab").isNotNull(), near))
    # A definition counts when the name before its "=" ends in the tab variable.
    label = F.try_element_at(
        F.filter("_near", lambda d: d["tab"].endswith(F.col("tab"))), F.lit(-1)
    )["label"]
    header = F.when(F.col("title").isNotNull(), F.struct(F.col("title").alias("name"))).when(
        F.col("tab").isNotNull(), F.struct(label.alias("name"))
    )
    rows = (
        rows.withColumn("_header", header)
        .withColumn(
            "_name",
            F.last("_header", True).over(file.rangeBetween(Window.unboundedPreceding, 0))["name"],
        )
        .withColumn(
            "_caption", F.first("caption", True).over(file.rangeBetween(0, CAPTION_REACH - 1))
        )
    )
    chart = F.struct(
        F.coalesce("render", F.lit("unknown")).alias("chart_type"),
        F.col("_name").alias("chart_name"),
        F.col("_caption").alias("chart_caption"),
    )
    rendered = F.when(F.col("render").isNotNull(), chart)
    following = F.first(rendered, True).over(file.rangeBetween(0, RENDER_REACH - 1))
    lost = F.struct(
        F.lit("unknown").alias("chart_type"),
        F.lit(None).cast("string").alias("chart_name"),
        F.lit(None).cast("string").alias("chart_caption"),
    )
    return (
        rows.withColumn("_next", following)
        .filter(F.col("query").isNotNull())
        .withColumn(
            "_chart",
            F.coalesce(
                "_next", F.when(F.col("idx") < F.col("n_lines"), chart).otherwise(lost)
            ),
        )
        .select("rel_path", "query.*", "_chart.*")
    )
