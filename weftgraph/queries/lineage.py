"""The lineage lake: suppliers are jobs of their nation's flow, a part on a line number is a table, and
line items are accesses: returned ones (A) write, refused ones (R) read, all others (N) do both."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.operators import graph
from weftgraph.queries.registry import query, table
from weftgraph.session import stage_table

INTEGRATION = "Matillion"

# -- shared SQL ----------------------------------------------------------------------------------

ACCESS_SQL = """
access AS (
  SELECT DISTINCT n_name || '.' || s_name AS job, n_name AS flow, 't_' || l_partkey || '_' || l_linenumber AS table_name,
         mode
  FROM (SELECT *, unnest(CASE l_returnflag WHEN 'A' THEN ['W'] WHEN 'R' THEN ['R'] ELSE ['W', 'R'] END) AS mode
        FROM lineitem)
  JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey),
w AS (SELECT job, table_name FROM access WHERE mode = 'W'),
r AS (SELECT job, table_name FROM access WHERE mode = 'R'),
handoff AS (SELECT w.job AS producer, r.job AS consumer, table_name
            FROM w JOIN r USING (table_name) WHERE w.job <> r.job),
ext_w AS (SELECT * FROM w WHERE NOT EXISTS (
            SELECT 1 FROM r WHERE r.table_name = w.table_name AND r.job <> w.job)),
ext_r AS (SELECT * FROM r WHERE table_name NOT IN (SELECT table_name FROM w))
"""

EDGES_SQL = f"""
WITH {ACCESS_SQL},
edges AS (
  SELECT 'job' AS src_kind, producer AS src, 'job' AS dst_kind, consumer AS dst, table_name FROM handoff
  UNION ALL SELECT 'job', job, 'table', table_name, table_name FROM ext_w
  UNION ALL SELECT 'table', table_name, 'job', job, table_name FROM ext_r)
"""

JOBS_SQL = """
jobs AS (SELECT n_name AS flow, n_name || '.' || s_name AS job
         FROM supplier JOIN nation ON n_nationkey = s_nationkey)
"""

NODE_LISTS_SQL = f"""
WITH {ACCESS_SQL}, {JOBS_SQL},
up AS (
  SELECT job, 0 AS slot, 'Pipeline:' || flow AS dep FROM jobs
  UNION ALL SELECT job, 1, table_name FROM ext_r),
down AS (
  SELECT producer AS job, table_name AS t, 'Job:' || consumer AS dep FROM handoff
  UNION ALL SELECT job, table_name, table_name FROM ext_w)
"""

# -- data ------------------------------------------------------------------------------------------


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey",
        F.col("n_name").alias("flow"),
        F.concat_ws(".", "n_name", "s_name").alias("job"),
    )


def access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (job, table_name, mode); repeats vanish before names are looked up."""
    flag = F.col("l_returnflag")
    writes = F.coalesce(flag != "R", F.lit(True))
    reads = F.coalesce(flag != "A", F.lit(True))
    touched = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", "l_partkey", "l_linenumber")
        .agg(F.max(writes).alias("writes"), F.max(reads).alias("reads"))
    )
    modes = F.array_compact(F.array(F.when(F.col("writes"), F.lit("W")), F.when(F.col("reads"), F.lit("R"))))
    return touched.join(jobs(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey")).select(
        "job",
        F.concat_ws("_", F.lit("t"), "l_partkey", "l_linenumber").alias("table_name"),
        F.explode(modes).alias("mode"),
    )


def staged_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The accesses as a written table: line items are scanned and reduced once."""
    return stage_table(access(spark, sf_dir), "access")


def lake_deps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(job, direction, rank, dep): a row per dependency of a Job node, on jobs, flows and tables."""
    job_rows = jobs(spark, sf_dir)
    tagged = graph.tag_accesses(staged_access(spark, sf_dir))
    name = F.lit(INTEGRATION)

    def rank(slot: int, *parts: str):
        first, second = (*parts, None, None)[:2]
        return F.struct(
            F.lit(slot).alias("slot"),
            (F.col(first) if first else F.lit("")).alias("a"),
            (F.col(second) if second else F.lit("")).alias("b"),
        )

    return (
        job_rows.select(
            "job",
            F.lit("up").alias("direction"),
            rank(0).alias("rank"),
            graph.node_ref(name, F.lit("Pipeline"), F.col("flow")).alias("dep"),
        )
        .unionByName(
            graph.kept_reads(tagged).select(
                "job",
                F.lit("up").alias("direction"),
                rank(1, "table_name").alias("rank"),
                graph.table_ref(F.col("table_name")).alias("dep"),
            )
        )
        .unionByName(
            graph.handoffs(tagged).select(
                F.col("producer").alias("job"),
                F.lit("down").alias("direction"),
                rank(0, "table_name", "consumer").alias("rank"),
                graph.node_ref(name, F.lit("Job"), F.col("consumer")).alias("dep"),
            )
        )
        .unionByName(
            graph.kept_writes(tagged).select(
                "job",
                F.lit("down").alias("direction"),
                rank(0, "table_name").alias("rank"),
                graph.table_ref(F.col("table_name")).alias("dep"),
            )
        )
    )


def lake_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a node is without its dependencies: a Pipeline per nation, a Job per supplier."""
    flows = table(spark, sf_dir, "nation").select(
        F.lit(None).cast("string").alias("job"),
        F.lit(INTEGRATION).alias("integration"),
        F.col("n_name").alias("name"),
        F.lit("Pipeline").alias("node_type"),
        F.concat(F.lit("Flow "), F.col("n_name")).alias("description"),
        source_url(F.col("n_name")).alias("url"),
        F.lit(False).alias("has_downstream"),
    )
    return flows.unionByName(
        jobs(spark, sf_dir).select(
            "job",
            F.lit(INTEGRATION).alias("integration"),
            F.col("job").alias("name"),
            F.lit("Job").alias("node_type"),
            F.concat(F.lit("Matillion job: "), F.element_at(F.split("job", r"\."), -1), F.lit(".")).alias(
                "description"
            ),
            source_url(F.col("flow")).alias("url"),
            F.lit(True).alias("has_downstream"),
        )
    )


def lake_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One Pipeline node per nation, one Job node per supplier with its table and job dependencies."""
    return graph.assemble_nodes(lake_heads(spark, sf_dir), lake_deps(spark, sf_dir), ["job"])


def source_url(flow):
    from weftgraph.functions.text import source_url as url

    return url(
        F.lit("https://git.example.org/lake"),
        F.lit("main"),
        F.concat(F.lit("flows/"), F.lower(flow), F.lit(".orch.yaml")),
    )


# -- queries -----------------------------------------------------------------------------------------


@query("flagship", EDGES_SQL + "SELECT src_kind, src, dst_kind, dst, table_name FROM edges")
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.job_edges(staged_access(spark, sf_dir))


def _index(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    return graph.table_index(access(spark, sf_dir).filter(F.col("mode") == mode))


INDEX_SQL = """
SELECT table_name, row_number() OVER (PARTITION BY table_name ORDER BY job) AS position, job FROM {side}
"""


@query("agg_producers", f"WITH {ACCESS_SQL}" + INDEX_SQL.format(side="w"))
def agg_producers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index(spark, sf_dir, "W")


@query("agg_consumers", f"WITH {ACCESS_SQL}" + INDEX_SQL.format(side="r"))
def agg_consumers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index(spark, sf_dir, "R")


@query("join_external_reads", f"WITH {ACCESS_SQL} SELECT job, table_name FROM ext_r")
def join_external_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = graph.tag_accesses(staged_access(spark, sf_dir))
    return graph.kept_reads(tagged).select("job", "table_name")


@query("join_handoff_edges", f"WITH {ACCESS_SQL} SELECT producer, consumer, table_name FROM handoff")
def join_handoff_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = graph.tag_accesses(staged_access(spark, sf_dir))
    return graph.handoffs(tagged).select("producer", "consumer", "table_name")


@query("join_external_writes", f"WITH {ACCESS_SQL} SELECT job, table_name FROM ext_w")
def join_external_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = graph.tag_accesses(staged_access(spark, sf_dir))
    return graph.kept_writes(tagged).select("job", "table_name")


CALLS_SQL = """
WITH calls AS (SELECT c_custkey AS caller, 'NATION_' || (c_custkey % 30) AS called_pipeline FROM customer)
"""


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("caller"),
        F.concat(F.lit("NATION_"), F.col("c_custkey") % 30).alias("called_pipeline"),
    )


def call_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations and, as equal stems under greater paths, their regions: the greatest path must win."""
    from weftgraph.functions.text import title_case

    flows = table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("stem"),
        title_case(F.translate("n_name", "_", " ")).alias("pipeline_name"),
        F.concat(F.lit("a/"), F.col("n_name")).alias("rel_path"),
    )
    again = flows.filter(F.col("stem").endswith("7")).select(
        "stem",
        F.concat("pipeline_name", F.lit(" B")).alias("pipeline_name"),
        F.concat(F.lit("b/"), F.col("stem")).alias("rel_path"),
    )
    return graph.call_index(flows.unionByName(again))


@query(
    "join_resolve_calls",
    CALLS_SQL
    + """
SELECT caller, called_pipeline,
       'Nation ' || n_nationkey || CASE WHEN n_name LIKE '%7' THEN ' B' ELSE '' END AS resolved
FROM calls LEFT JOIN nation ON n_name = called_pipeline
""",
)
def join_resolve_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.resolve_calls(calls(spark, sf_dir), call_index(spark, sf_dir), ["caller"]).select(
        "caller", "called_pipeline", "resolved"
    )


@query(
    "join_unresolved_calls",
    CALLS_SQL
    + "SELECT caller, called_pipeline FROM calls WHERE called_pipeline NOT IN (SELECT n_name FROM nation)",
)
def join_unresolved_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.unresolved_calls(
        calls(spark, sf_dir), call_index(spark, sf_dir), ["caller"]
    ).select("caller", "called_pipeline")


STITCH_SQL = f"""
WITH {ACCESS_SQL},
charts AS (SELECT DISTINCT 'u' || user_id AS node, 't_' || (props::JSON->>'k') || '_' || (event_id % 7 + 1)
           AS table_name FROM events)
SELECT 'Matillion' AS integration, job AS node, table_name, 'W' AS mode FROM w
WHERE table_name IN (SELECT table_name FROM charts)
UNION ALL
SELECT 'Streamlit', node, table_name, 'R' FROM charts WHERE table_name IN (SELECT table_name FROM w)
"""


@query("join_stitch", STITCH_SQL)
def join_stitch(spark: SparkSession, sf_dir: str) -> DataFrame:
    charts = (
        table(spark, sf_dir, "events")
        .select(
            F.concat(F.lit("u"), F.col("user_id")).alias("node"),
            F.concat_ws(
                "_", F.lit("t"), F.get_json_object("props", "$.k"), F.col("event_id") % 7 + 1
            ).alias("table_name"),
        )
        .distinct()
    )
    edges = (
        access(spark, sf_dir)
        .filter(F.col("mode") == "W")
        .select(
            F.lit("Matillion").alias("integration"),
            F.col("job").alias("node"),
            "table_name",
            F.lit("W").alias("mode"),
        )
        .unionByName(
            charts.select(
                F.lit("Streamlit").alias("integration"), "node", "table_name", F.lit("R").alias("mode")
            )
        )
    )
    return graph.stitch(stage_table(edges, "table-edges")).select("integration", "node", "table_name", "mode")


@query(
    "node_assemble",
    NODE_LISTS_SQL
    + """,
u AS (SELECT job, string_agg(dep, ',' ORDER BY slot, dep) AS deps FROM up GROUP BY job),
d AS (SELECT job, string_agg(dep, ',' ORDER BY t, dep) AS deps FROM down GROUP BY job)
SELECT 'Matillion' AS integration, n_name AS name, 'Pipeline' AS node_type,
       '' AS upstream, CAST(NULL AS VARCHAR) AS downstream FROM nation
UNION ALL
SELECT 'Matillion', jobs.job, 'Job', u.deps, coalesce(d.deps, '')
FROM jobs LEFT JOIN u ON u.job = jobs.job LEFT JOIN d ON d.job = jobs.job
""",
)
def node_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    def labels(side: str):
        return F.array_join(
            F.transform(f"lineage.{side}_dependencies", graph.dep_label), ","
        ).alias(side)

    return lake_nodes(spark, sf_dir).select(
        "integration", "name", "node_type", labels("upstream"), labels("downstream")
    )


@query(
    "edge_list",
    NODE_LISTS_SQL
    + """
SELECT CASE WHEN slot = 0 THEN 'node' ELSE 'table' END AS src_kind, dep AS src,
       'node' AS dst_kind, 'Job:' || job AS dst FROM up
UNION ALL
SELECT 'node', 'Job:' || job, CASE WHEN dep LIKE 'Job:%' THEN 'node' ELSE 'table' END, dep FROM down
""",
)
def edge_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    deps = lake_deps(spark, sf_dir).withColumn("node", F.concat(F.lit("Job:"), F.col("job")))
    return graph.dependency_edges(deps)


URL_SQL = "'https://git.example.org/lake/blob/main/flows/' || lower(n_name) || '.orch.yaml'"


@query(
    "node_urls",
    f"""
SELECT n_name AS name, 'Pipeline' AS node_type, {URL_SQL} AS url FROM nation
UNION ALL
SELECT n_name || '.' || s_name, 'Job', {URL_SQL} FROM supplier JOIN nation ON n_nationkey = s_nationkey
""",
)
def node_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake_heads(spark, sf_dir).select("name", "node_type", "url")


@query(
    "node_upsert",
    """
SELECT 'Customers' AS integration, 'c' || o_custkey AS name, o_orderkey AS version, o_orderstatus AS status
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders) WHERE rn = 1
""",
)
def node_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders are versions of their customer's node; the newest stays."""
    versions = table(spark, sf_dir, "orders").select(
        F.lit("Customers").alias("integration"),
        F.concat(F.lit("c"), F.col("o_custkey")).alias("name"),
        F.col("o_orderkey").alias("version"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("modified_at"),
    )
    return graph.latest(
        versions, ["integration", "name"], [F.col("modified_at"), F.col("version")]
    ).select("integration", "name", "version", "status")


@query(
    "agg_run_summary",
    """
SELECT 'Matillion' AS integration, 'Pipeline' AS node_type, count(*) AS nodes FROM nation
UNION ALL
SELECT 'Matillion', 'Job', count(*) FROM supplier JOIN nation ON n_nationkey = s_nationkey
""",
)
def agg_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.run_summary(lake_heads(spark, sf_dir))
