"""Prose documents as artifacts of their source folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.functions import text
from weftgraph.operators import graph
from weftgraph.plans import notebook
from weftgraph.queries.registry import query, table


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


@query("snippet", "SELECT doc_id, substring(text, 1, 200) AS snippet FROM documents")
def snippet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", text.snippet(F.col("text")).alias("snippet"))


WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160)"


@query(
    "md_heading",
    f"""
    WITH t AS (SELECT doc_id, repeat('#', CAST(doc_id % 4 AS INTEGER)) || ' ' || chr(10) || repeat('#', CAST(doc_id % 3 AS INTEGER)) || text AS md FROM documents)
    SELECT doc_id, [y for y in [trim(ltrim(x, '#'), {WHITE}) for x in string_split(md, chr(10))] if y <> ''][1] AS heading
    FROM t""",
)
def md_heading(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    marks = lambda n: F.repeat(F.lit("#"), (k % n).cast("int"))
    md = F.concat(marks(4), F.lit(" \n"), marks(3), "text")
    return documents(spark, sf_dir).select("doc_id", text.heading(md).alias("heading"))


@query(
    "dedupe_first",
    """SELECT source, doc_id, lang FROM (
      SELECT *, row_number() OVER (PARTITION BY source, text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""",
)
def dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First occurrence of equal texts within a folder."""
    rows = documents(spark, sf_dir).select("source", "text", "doc_id", "lang")
    # A text is told apart by its digest, so no text is sorted or shuffled as a key.
    rows = rows.select("source", F.sha2("text", 256).alias("digest"), "doc_id", "lang")
    return graph.earliest(rows, ["source", "digest"], [F.col("doc_id")]).select("source", "doc_id", "lang")


@query(
    "set_union_tables",
    """SELECT 't_' || l_partkey AS table_name FROM lineitem
    UNION SELECT 't_' || (props::JSON->>'k') FROM events""",
)
def set_union_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("t_"), "l_partkey").alias("table_name")
    )
    shown = table(spark, sf_dir, "events").select(
        F.concat(F.lit("t_"), F.get_json_object("props", "$.k")).alias("table_name")
    )
    return read.unionByName(shown).distinct()


@query(
    "set_difference",
    "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT conv_id FROM conversations)",
)
def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input files without those named as failed."""
    failed = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"))
    return documents(spark, sf_dir).select("doc_id", "source").join(failed, "doc_id", "left_anti")


@query(
    "fail_split",
    """SELECT 'd/' || doc_id || '.ipynb' AS rel_path, 'failed' AS outcome, 'invalid JSON' AS detail
    FROM documents WHERE doc_id % 3 = 0
    UNION ALL
    SELECT 'd/' || doc_id || '.ipynb', 'failed', 'null where a value must be' FROM documents WHERE doc_id % 3 = 1
    UNION ALL
    SELECT 'd/' || doc_id || '.ipynb', 'parsed', '' FROM documents WHERE doc_id % 3 = 2
    UNION ALL
    SELECT 'd/' || doc_id || '.ipynb', 'parsed', doc_id || '' FROM documents WHERE doc_id % 3 = 0""",
)
def fail_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as notebooks: every third is cut off, every third has a null source."""
    k = F.col("doc_id")
    body = F.to_json(F.array("text"))
    cell = F.concat(
        F.lit('{"cells": [{"cell_type": "markdown", "metadata": {}, "source": '),
        F.when(k % 3 == 1, "null").otherwise(body),
        F.lit("}]"),
        F.when(k % 3 == 0, "").otherwise("}"),
    )
    parsed = notebook.parse(
        documents(spark, sf_dir).select(
            F.concat(F.lit("d/"), k, F.lit(".ipynb")).alias("rel_path"), cell.alias("content")
        )
    )
    # Cut-off files keep a notebook under their bare stem; the others are known by their heading.
    known = F.when(F.col("description") == "", F.col("notebook_name")).otherwise("")
    return parsed.failures.select("rel_path", F.lit("failed").alias("outcome"), F.col("error").alias("detail")).unionByName(
        parsed.notebooks.select("rel_path", F.lit("parsed").alias("outcome"), known.alias("detail"))
    )
