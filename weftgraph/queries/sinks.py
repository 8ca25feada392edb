"""Runs written to the shared folder, read back as their newest committed state, and nodes checked line by line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.operators.parent_child import parent_child_nodes
from weftgraph.queries.pages import flat_nodes
from weftgraph.queries.registry import query, table
from weftgraph.queries.usage import USAGE_SQL, numbered
from weftgraph.session import fresh_path, stage_table
from weftgraph.sinks import tables as sinks
from weftgraph.sources import catalog


def _runs(spark: SparkSession, folder: str, rows: DataFrame, smaller: Column) -> DataFrame:
    """Three integrations: a larger and a smaller run, one run of everything, and one followed by an empty run. A
    last run of the first is not committed. Folders of older runs are dropped before reading."""
    root = fresh_path(spark, "runs")
    rows = stage_table(rows, "rows")
    parts = (("First", None), ("Second", None), ("Third", None), ("First", smaller), ("Third", F.lit(False)), ("First", F.lit(False)))
    for nr, (integration, kept) in enumerate(parts):
        run = sinks.Run(spark, root, integration)
        run.write(folder, rows if kept is None else rows.where(kept))
        if nr < len(parts) - 1:
            run.commit()
    sinks.drop_old_runs(spark, root)
    return sinks.read_table(spark, root, folder)


@query(
    "sink_nodes",
    """
    WITH w AS (SELECT n_name AS flow, s_name AS child, 't_' || s_suppkey AS t
               FROM supplier JOIN nation ON n_nationkey = s_nationkey),
    nodes AS (
      SELECT flow AS name, 'ParentNode' AS node_type, 'Auto-generated parent node for ' || flow || '.' AS description,
             flow AS url, '' AS upstream, CAST(NULL AS VARCHAR) AS downstream FROM (SELECT DISTINCT flow FROM w)
      UNION ALL
      SELECT flow || '.' || child, 'ChildNode', 'Child node: ' || child || '.', flow, 'ParentNode:' || flow, t FROM w)
    SELECT 'First' AS integration, * FROM nodes WHERE node_type = 'ChildNode' UNION ALL SELECT 'Second', * FROM nodes""",
)
def sink_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    nodes = parent_child_nodes(
        rows, "Lake", F.col("n_name"), F.col("s_name"), F.concat(F.lit("T_"), "s_suppkey"), F.col("n_name")
    )
    return flat_nodes(_runs(spark, "nodes", nodes, F.col("node_type") == "ChildNode"))


@query(
    "sink_usage",
    f"""WITH {USAGE_SQL}, kept AS (
      SELECT file_path, id, chart_type, chart_name, array_to_string(tables_used, ',') AS tables FROM usage)
    SELECT 'First' AS integration, * FROM kept WHERE tables <> '' UNION ALL SELECT 'Second', * FROM kept""",
)
def sink_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = numbered(spark, sf_dir).withColumn("id", F.col("id").cast("bigint"))
    some = F.array_join("tables_used", ",") != ""
    back = _runs(spark, "table_usage", rows, some)
    return back.select(
        "integration", "file_path", "id", "chart_type", "chart_name", F.array_join("tables_used", ",").alias("tables")
    )


@query(
    "sink_failures",
    """WITH failed AS (SELECT 'docs/' || doc_id AS rel_path, coalesce(lang, 'none') AS stage, 'no such file' AS error FROM documents)
    SELECT 'First' AS integration, * FROM failed WHERE stage = 'en' UNION ALL SELECT 'Second', * FROM failed""",
)
def sink_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(
        F.lit("any").alias("integration"),
        F.concat(F.lit("docs/"), "doc_id").alias("rel_path"),
        F.coalesce("lang", F.lit("none")).alias("stage"),
        F.lit("no such file").alias("error"),
    )
    return _runs(spark, "failures", rows, F.col("stage") == "en")


@query(
    "validate_nodes",
    """SELECT CAST(s_suppkey AS BIGINT) AS nr, CASE s_suppkey % 7 WHEN 0 THEN 'unreadable' WHEN 1 THEN 'no name' WHEN 2 THEN 'no lineage'
              WHEN 3 THEN 'bad upstream dependency' WHEN 4 THEN 'no url' END AS problem FROM supplier""",
)
def validate_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes written as text with faults of several kinds, read again with what is wrong with each line."""
    k = F.col("s_suppkey")
    url = F.when(k % 7 != 4, F.concat(F.lit("u/"), k))
    table_name = F.struct(F.concat(F.lit("t_"), k).alias("table_name"))
    both = F.struct(F.lit("t").alias("table_name"), F.lit("n").alias("node_name"))
    up = F.when(k % 7 == 3, F.to_json(F.array(both))).otherwise(F.to_json(F.array(table_name)))
    name = F.when(k % 7 == 1, F.lit('""')).otherwise(F.concat(F.lit('"'), "s_name", F.lit('"')))
    parts = [F.lit('{"integration":"Lake","node_type":"Job","name":'), name, F.lit(',"attributes":{"description":"supplier '), k.cast("string"), F.lit('"')]
    parts += [F.coalesce(F.concat(F.lit(',"url":"'), url, F.lit('"')), F.lit("")), F.lit("}")]
    parts += [F.when(k % 7 != 2, F.concat(F.lit(',"lineage":{"upstream_dependencies":'), up, F.lit("}"))).otherwise("")]
    parts += [F.when(k % 7 != 0, "}").otherwise("")]
    path = fresh_path(spark, "nodes-text")
    table(spark, sf_dir, "supplier").select(F.concat(*parts).alias("value")).write.text(path)
    return catalog.reread(spark, path).select(
        F.regexp_extract("line", r"supplier (\d+)", 1).cast("bigint").alias("nr"), "problem"
    )
