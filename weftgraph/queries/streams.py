"""The lake, the usage log and orchestration files as streams that come in parts, each run to its end."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.operators.parent_child import parent_child_nodes
from weftgraph.queries import components
from weftgraph.queries import usage as usage_queries
from weftgraph.queries.lineage import EDGES_SQL, jobs, staged_access
from weftgraph.queries.pages import flat_nodes
from weftgraph.queries.registry import SCHEMAS, query, table
from weftgraph.session import fresh_path, stage_table
from weftgraph.streaming import edges, ingest
from weftgraph.streaming import usage as usage_stream
from weftgraph.streaming.log import read_log


def arrivals(rows: DataFrame, part: Column, parts: int = 3) -> Iterator[str]:
    """A folder of the shared store to which one part of the rows after the other is added, all of them in the end."""
    folder = fresh_path(rows.sparkSession, "arrivals")
    dealt = rows.withColumn("_part", part.cast("int"))
    for nr in range(parts):
        dealt.where(F.col("_part") == nr).drop("_part").write.mode("append").parquet(folder)
        yield folder


@query(
    "stream_nodes",
    """
    WITH w AS (
      SELECT DISTINCT n_name AS flow, s_name || ' ' || l_linestatus AS child, 't_' || s_suppkey AS t
      FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey)
    SELECT 'Lake' AS integration, flow AS name, 'ParentNode' AS node_type,
           'Auto-generated parent node for ' || flow || '.' AS description, flow AS url, '' AS upstream,
           CAST(NULL AS VARCHAR) AS downstream FROM (SELECT DISTINCT flow FROM w)
    UNION ALL
    SELECT 'Lake', flow || '.' || child, 'ChildNode', 'Child node: ' || child || '.', flow,
           'ParentNode:' || flow, t FROM w""",
)
def stream_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items arrive in three parts; each part's suppliers become nodes of their nation."""
    root, checkpoint = fresh_path(spark, "nodes"), fresh_path(spark, "nodes-state")
    job_rows = jobs(spark, sf_dir)

    def convert(batch: DataFrame) -> DataFrame:
        touched = batch.select("l_suppkey", "l_linestatus").distinct()
        records = touched.join(job_rows, F.col("l_suppkey") == F.col("s_suppkey")).select(
            "flow",
            F.concat(F.substring_index("job", ".", -1), F.lit(" "), "l_linestatus").alias("child"),
            F.concat(F.lit("T_"), "s_suppkey").alias("t"),
        )
        nodes = parent_child_nodes(
            records, "Lake", F.col("flow"), F.col("child"), F.col("t"), F.col("flow")
        )
        return nodes.withColumn("modified_at", F.current_timestamp())

    rows = table(spark, sf_dir, "lineitem")
    for nr, folder in enumerate(arrivals(rows, F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(3)))):
        lines = ingest.stream_table(spark, folder, "*.parquet", SCHEMAS["lineitem"])
        ingest.ingest_nodes(lines, convert, root, checkpoint)
        if nr == 1:
            ingest.fold_nodes(spark, root)
    return flat_nodes(ingest.current_nodes(spark, root))


@query("stream_usage", usage_queries.SUMMARY_SQL)
def stream_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events arrive in three parts; the stream is stopped after each and goes on from its checkpoint."""
    root, checkpoint = fresh_path(spark, "usage"), fresh_path(spark, "usage-state")
    rows = table(spark, sf_dir, "events")
    for nr, folder in enumerate(arrivals(rows, F.pmod(F.xxhash64("event_id"), F.lit(3)))):
        events = ingest.stream_table(spark, folder, "*.parquet", SCHEMAS["events"])
        usage_stream.count_usage(usage_queries.of_events(events), root, checkpoint)
        if nr == 1:
            usage_stream.fold_usage(spark, root)
    return usage_queries.flat_summary(usage_stream.current_summary(spark, root))


@query(
    "stream_flows",
    components.YAML_SQL + " WHERE NOT rel_path LIKE '%0.orch.yaml'",
)
def stream_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files come with an older text, then with their own, and a tenth of them is emptied at last; the log is
    folded in between."""
    root, checkpoint = fresh_path(spark, "flows"), fresh_path(spark, "flows-state")
    files = stage_table(components.yaml_files(spark, sf_dir), "files")
    older = F.lit("pipeline:\n  components:\n    old:\n      type: start\n")
    versions = (
        files.select("rel_path", older.alias("content"), F.lit(0).alias("nr"))
        .union(files.select("rel_path", "content", F.lit(1)))
        .union(files.where(F.col("rel_path").like("%0.orch.yaml")).select("rel_path", F.lit("pipeline: {}\n"), F.lit(2)))
    )
    for nr, folder in enumerate(arrivals(versions, F.col("nr"))):
        records = ingest.stream_table(spark, folder, "*.parquet", "rel_path string, content string")
        ingest.ingest_flows(records, root, checkpoint)
        if nr == 1:
            ingest.fold_flows(spark, root)
    return components.flat_components(ingest.current_flows(spark, root).components)


@query("delta_edges", EDGES_SQL + "SELECT src_kind, src, dst_kind, dst, table_name FROM edges")
def delta_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accesses come in three parts, the first with a second job beside every reader, which the last takes back;
    the logs are folded in between."""
    root, checkpoint = fresh_path(spark, "edges"), fresh_path(spark, "edges-state")
    rows = staged_access(spark, sf_dir)
    retired = rows.where("mode = 'R'").withColumn("job", F.concat("job", F.lit(" retired")))
    there, part = F.lit(True), F.pmod(F.xxhash64("job", "table_name"), F.lit(3))
    changes = (
        rows.select("*", there.alias("present"), part.alias("nr"))
        .union(retired.select("*", there, F.lit(0)))
        .union(retired.select("*", F.lit(False), F.lit(2)))
    )
    for nr, folder in enumerate(arrivals(changes, F.col("nr"))):
        edges.ingest_accesses(ingest.stream_table(spark, folder, "*.parquet", edges.CHANGES), root, checkpoint)
        if nr == 1:
            edges.fold_edges(spark, root)
    return edges.current_edges(spark, root)


@query("stream_replays", "SELECT event_id, user_id, ts, event_type FROM events")
def stream_replays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events come in three stretches of time, a fifth of them one stretch late and all of them once more in the
    stretch after that: late ones within the delay are kept, replays are dropped."""
    root, checkpoint = fresh_path(spark, "replays"), fresh_path(spark, "replays-state")
    rows = table(spark, sf_dir, "events")
    seconds = F.col("ts").cast("timestamp").cast("double")
    first, last = rows.agg(F.min(seconds), F.max(seconds)).first()
    third = ((last or 0.0) - (first or 0.0)) / 3 + 1
    stretch = F.floor((seconds - F.lit(first or 0.0)) / third)
    arrives = F.least(stretch + (F.pmod("event_id", F.lit(5)) == 0).cast("int"), F.lit(2))
    again = F.least(arrives + 1, F.lit(2))
    sent = rows.select("*", arrives.alias("nr")).union(rows.select("*", again))
    for folder in arrivals(sent, F.col("nr")):
        events = ingest.stream_table(spark, folder, "*.parquet", SCHEMAS["events"])
        events = events.withColumn("at", F.col("ts").cast("timestamp"))
        ingest.ingest_distinct(events, "at", ["event_id"], f"{int(2 * third) + 2} seconds", root, checkpoint)
    return read_log(spark, root, SCHEMAS["events"]).select("event_id", "user_id", "ts", "event_type")
