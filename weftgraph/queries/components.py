"""Orchestration components derived from parts: four parts make one flow file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.functions import nested, sqlrefs, text
from weftgraph.operators import components as comp
from weftgraph.operators import graph
from weftgraph.plans import orchestration
from weftgraph.queries.registry import query, table
from weftgraph.session import spread_by

TYPES = (
    "API-Extract-Input-v2", "mongodb-query", "crm-OUTPUT", "run-orchestration", "run-shared-pipeline",
    "sql-executor", "start", "python-script", "Custom-Widget",
)

TYPE_LIST = ", ".join(f"'{t}'" for t in TYPES)
COMPONENTS_SQL = f"""
comp AS (
  SELECT 'flows/f_' || (p_partkey // 4) || '.orch.yaml' AS rel_path,
         CAST(p_partkey % 4 AS INTEGER) AS ordinal, p_name || '_' || p_partkey AS name,
         p_partkey AS k, p_size AS size, list_extract([{TYPE_LIST}], p_size % 9 + 1) AS type,
         p_size % 7 = 0 AS skipped,
         CASE WHEN p_size % 3 = 0 THEN '' ELSE upper(replace(p_name, ' ', '_')) || '_' || p_partkey
              || CASE WHEN p_size % 5 = 0 THEN '_lnd' ELSE '_LND' END END AS landing,
         CASE WHEN p_size % 4 = 0 THEN 'T_' || p_partkey END AS fallback,
         'SRC_' || p_partkey AS source_table,
         CASE WHEN p_size % 9 = 5 THEN CASE WHEN p_size % 2 = 0 THEN 'call db.x_stg_merge(' || p_partkey || ')'
              ELSE 'INSERT INTO s.T_' || (p_partkey + 1) || ' SELECT * FROM s.R_' || (p_partkey + 2) END END AS script
  FROM part),
typed AS (
  SELECT *, CASE WHEN lower(type) LIKE '%-input-%' OR lower(type) = 'mongodb-query' THEN 'ingestion_input'
                 WHEN lower(type) LIKE '%-output' THEN 'reverse_etl_output'
                 WHEN type = 'run-orchestration' THEN 'orchestrator_call'
                 WHEN type = 'run-shared-pipeline' THEN 'shared_pipeline_call'
                 WHEN type = 'sql-executor' THEN 'sql_transform' ELSE 'utility' END AS role,
         coalesce(nullif(landing, ''), nullif(fallback, '')) AS output_table,
         type = 'sql-executor' AND size % 2 = 1 AS moves
  FROM comp),
flow AS (
  SELECT rel_path,
         CASE WHEN bool_or(role = 'reverse_etl_output') THEN 'reverse_etl'
              WHEN bool_or(role = 'ingestion_input') THEN 'ingestion'
              WHEN bool_or(role IN ('orchestrator_call', 'shared_pipeline_call')) THEN 'orchestrator'
              WHEN bool_or(role = 'sql_transform') THEN 'sql_transform' ELSE 'unknown' END AS pipeline_type,
         count(*) FILTER (WHERE type <> 'start' AND NOT skipped) AS active_jobs,
         count(*) FILTER (WHERE type <> 'start' AND skipped) AS skipped_jobs,
         bool_or(type = 'sql-executor' AND size % 2 = 0) AS staged
  FROM typed GROUP BY rel_path)
"""


def raw_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size")
    upper = F.upper(F.translate("p_name", " ", "_"))
    landing = F.concat_ws("_", upper, k, F.when(size % 5 == 0, "lnd").otherwise("LND"))
    insert = F.concat(
        F.lit("INSERT INTO s.T_"), k + 1, F.lit(" SELECT * FROM s.R_"), k + 2
    )
    script = F.when(
        size % 2 == 0, F.concat(F.lit("call db.x_stg_merge("), k, F.lit(")"))
    ).otherwise(insert)
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("flows/f_"), F.floor(k / 4), F.lit(".orch.yaml")).alias("rel_path"),
        (k % 4).cast("int").alias("ordinal"),
        F.concat_ws("_", "p_name", k).alias("name"),
        k.alias("k"),
        size.alias("size"),
        F.get(F.array(*map(F.lit, TYPES)), size % 9).alias("type"),
        (size % 7 == 0).alias("skipped"),
        F.when(size % 3 == 0, "").otherwise(landing).alias("landing"),
        F.when(size % 4 == 0, F.concat(F.lit("T_"), k)).alias("fallback"),
        F.concat(F.lit("SRC_"), k).alias("source_table"),
        F.when(size % 9 == 5, script).alias("sql_script"),
    )


def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        raw_components(spark, sf_dir)
        .withColumn("role", comp.role(F.col("type")))
        .withColumn("output_table", text.first_non_empty(F.col("landing"), F.col("fallback")))
    )


def typed_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components with their script's tables and their flow's type."""
    rows = sqlrefs.with_script_io(
        components(spark, sf_dir), "sql_script", "sql_sources", "sql_targets"
    )
    return comp.with_flow(rows, comp.flows(components(spark, sf_dir)), ["ordinal"])


@query("orch_roles", f"WITH {COMPONENTS_SQL} SELECT rel_path, ordinal, type, role FROM typed")
def orch_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(spark, sf_dir).select("rel_path", "ordinal", "type", "role")


# Every known utility type and two that are none, dealt out over the utility components.
UTILITIES = (*comp.KNOWN_UTILITIES, "notify-team", "rest-call")
UTILITY_LIST = ", ".join(f"'{t}'" for t in UTILITIES)


@query(
    "orch_unclassified",
    f"""WITH {COMPONENTS_SQL},
    dealt AS (SELECT rel_path, ordinal, name, list_extract([{UTILITY_LIST}], k % {len(UTILITIES)} + 1) AS type
              FROM typed WHERE role = 'utility')
    SELECT rel_path, ordinal, name, type FROM dealt WHERE type IN ('notify-team', 'rest-call')""",
)
def orch_unclassified(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = F.get(F.array(*[F.lit(t) for t in UTILITIES]), (F.col("k") % len(UTILITIES)).cast("int"))
    rows = components(spark, sf_dir).filter("role = 'utility'").withColumn("type", dealt)
    return comp.unclassified(rows).select("rel_path", "ordinal", "name", "type")


@query("orch_output_table", f"WITH {COMPONENTS_SQL} SELECT rel_path, ordinal, output_table FROM typed")
def orch_output_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(spark, sf_dir).select("rel_path", "ordinal", "output_table")


@query(
    "orch_stg_rewrite",
    f"""WITH {COMPONENTS_SQL}
    SELECT rel_path, ordinal,
           CASE WHEN staged AND upper(output_table) LIKE '%\\_LND' ESCAPE '\\'
                THEN output_table[:-5] || '_STG' ELSE output_table END AS output_table
    FROM typed JOIN flow USING (rel_path)""",
)
def orch_stg_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = components(spark, sf_dir)
    return comp.rewrite_staging(comp.with_flow(rows, comp.flows(rows), ["ordinal"])).select(
        "rel_path", "ordinal", "output_table"
    )


@query("agg_flow_type", f"WITH {COMPONENTS_SQL} SELECT rel_path, pipeline_type FROM flow")
def agg_flow_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comp.flows(components(spark, sf_dir)).select("rel_path", "pipeline_type")


@query("agg_active_skipped", f"WITH {COMPONENTS_SQL} SELECT rel_path, active_jobs, skipped_jobs FROM flow")
def agg_active_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comp.flows(components(spark, sf_dir)).select("rel_path", "active_jobs", "skipped_jobs")


@query(
    "filter_data_bearing",
    f"WITH {COMPONENTS_SQL} SELECT rel_path, ordinal, role FROM typed WHERE moves OR role NOT IN ('utility', 'sql_transform')",
)
def filter_data_bearing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sqlrefs.with_script_io(
        components(spark, sf_dir), "sql_script", "sql_sources", "sql_targets"
    )
    return rows.filter(
        comp.data_bearing(F.col("role"), F.col("sql_sources"), F.col("sql_targets"))
    ).select("rel_path", "ordinal", "role")


@query(
    "desc_flow",
    f"""WITH {COMPONENTS_SQL}
    SELECT rel_path, CASE WHEN active_jobs % 3 = 1 THEN 'Given: ' || pipeline_type || '.' ELSE 'Matillion ' || CASE pipeline_type
             WHEN 'ingestion' THEN 'ingestion (SaaS → Snowflake)'
             WHEN 'reverse_etl' THEN 'reverse ETL (Snowflake → destination)'
             WHEN 'orchestrator' THEN 'orchestrator (calls other pipelines)'
             WHEN 'sql_transform' THEN 'SQL transform' ELSE 'orchestration' END
           || ' pipeline with ' || active_jobs || ' active job(s)'
           || CASE WHEN skipped_jobs > 0 THEN ' and ' || skipped_jobs || ' skipped job(s)' ELSE '' END
           || '.' END AS description
    FROM flow""",
)
def desc_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows of some sizes have a text of their own; others an empty one or none."""
    given = F.when(F.col("active_jobs") % 3 == 1, F.concat(F.lit("Given: "), "pipeline_type", F.lit("."))).when(
        F.col("active_jobs") % 3 == 2, F.lit("")
    )
    return comp.flows(components(spark, sf_dir)).select(
        "rel_path",
        comp.flow_description(
            given, F.col("pipeline_type"), F.col("active_jobs"), F.col("skipped_jobs")
        ).alias("description"),
    )


@query(
    "desc_job",
    f"""WITH {COMPONENTS_SQL},
    parts AS (
      SELECT rel_path, ordinal, name, skipped, concat_ws(' and ',
        CASE WHEN role = 'ingestion_input' THEN 'Calls the **/v1/' || k || '** API endpoint' END,
        CASE WHEN pipeline_type = 'ingestion' AND output_table IS NOT NULL
             THEN 'writes results to Snowflake table `' || output_table || '`'
             WHEN pipeline_type = 'reverse_etl' THEN 'reads from Snowflake table/view `' || source_table || '`' END,
        CASE WHEN moves THEN 'runs SQL writing `t_' || (k + 1) || '` from `r_' || (k + 2) || '`' END,
        CASE WHEN role = 'orchestrator_call' THEN 'runs orchestration `f_' || (k % 10) || '`' END,
        CASE WHEN role = 'shared_pipeline_call' THEN 'runs shared pipeline `DBT_RUN`'
             || CASE WHEN size % 2 = 0 THEN ' (dbt job `' || k || '`)' ELSE '' END END) AS said
      FROM typed JOIN flow USING (rel_path))
    SELECT rel_path, ordinal,
           CASE WHEN said <> '' THEN said || CASE WHEN skipped THEN ' *(currently skipped)*' ELSE '' END || '.'
                ELSE 'Matillion job: ' || name || '.' || CASE WHEN skipped THEN ' *(currently skipped)*' ELSE '' END
           END AS description
    FROM parts""",
)
def desc_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    dbt = F.when(F.col("size") % 2 == 0, F.create_map(F.lit("DBT_JOB_ID"), k.cast("string")))
    return (
        typed_components(spark, sf_dir)
        .withColumn("endpoint", F.when(F.col("role") == "ingestion_input", F.concat(F.lit("/v1/"), k)))
        .withColumn("called_pipeline", F.concat(F.lit("f_"), k % 10))
        .withColumn("shared_pipeline_name", F.lit("DBT_RUN"))
        .withColumn("shared_pipeline_vars", dbt)
        .select("rel_path", "ordinal", comp.job_description().alias("description"))
    )


@query(
    "validate_types",
    f"""WITH {COMPONENTS_SQL} SELECT 'Matillion' AS integration, type AS node_type, name FROM typed
    WHERE type NOT IN ('sql-executor', 'run-orchestration')""",
)
def validate_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component types against a declared list of two."""
    nodes = components(spark, sf_dir).select(
        F.lit("Matillion").alias("integration"), F.col("type").alias("node_type"), "name"
    )
    declared = spark.createDataFrame(
        [("Matillion", "sql-executor"), ("Matillion", "run-orchestration")],
        "integration string, node_type string",
    )
    return graph.unknown_types(nodes, F.broadcast(declared)).select("integration", "node_type", "name")


# -- nested values ---------------------------------------------------------------------------------


def moves(k: Column) -> Column:
    """Transitions of a component: two lists by condition and one scalar that is no list."""
    nxt = [F.concat(F.lit("c"), k + i) for i in (1, 2, 3)]
    return F.create_map(
        F.lit("success"), F.to_json(F.array(nxt[0], nxt[1])),
        F.lit("failure"), F.to_json(F.array(nxt[2])),
        F.lit("note"), F.lit("none"),
    )


@query(
    "nested_components",
    f"WITH {COMPONENTS_SQL} SELECT rel_path, ordinal, name, type FROM comp",
)
def nested_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files as ordered maps of components, exploded with their position."""
    files = raw_components(spark, sf_dir).groupBy("rel_path").agg(
        F.map_from_entries(
            F.transform(
                F.sort_array(F.collect_list(F.struct("ordinal", "name", "type"))),
                lambda c: F.struct(c["name"], c["type"]),
            )
        ).alias("components")
    )
    return files.select(
        "rel_path", F.posexplode(F.map_entries("components")).alias("ordinal", "c")
    ).select("rel_path", "ordinal", F.col("c.key").alias("name"), F.col("c.value").alias("type"))


@query(
    "nested_transitions",
    """SELECT p_partkey AS k, 'c' || (p_partkey + 1) || ',c' || (p_partkey + 2) || ',c' || (p_partkey + 3)
       AS transitions FROM part""",
)
def nested_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = F.transform_values("moves", lambda _, v: F.from_json(v, "array<string>"))
    return (
        table(spark, sf_dir, "part")
        .select(F.col("p_partkey").alias("k"), moves(F.col("p_partkey")).alias("moves"))
        .select("k", F.array_join(nested.flatten_lists(lists), ",").alias("transitions"))
    )


@query(
    "nested_pairs",
    """SELECT p_partkey AS k, CAST(2 AS BIGINT) AS n_keys, p_brand AS a, '' AS b FROM part""",
)
def nested_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A repeated key, a null value, a null key and an entry of one element."""
    none = F.lit(None).cast("string")
    pairs = F.array(
        F.array(F.lit("a"), F.col("p_name")),
        F.array(F.lit("b"), none),
        F.array(F.lit("alone")),
        F.array(none, F.lit("x")),
        F.array(F.lit("a"), F.col("p_brand")),
    )
    return (
        table(spark, sf_dir, "part")
        .select(F.col("p_partkey").alias("k"), nested.pairs_to_map(pairs).alias("m"))
        .select(
            "k",
            F.size("m").cast("bigint").alias("n_keys"),
            F.col("m")["a"].alias("a"),
            F.col("m")["b"].alias("b"),
        )
    )


def yaml_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The components rendered as YAML text, one file per four parts."""
    c = F.col

    def line(indent: int, *parts) -> Column:
        return F.concat(F.lit(" " * indent), *parts, F.lit("\n"))

    quoted = lambda x: F.to_json(F.array(x)).substr(F.lit(2), F.length(F.to_json(F.array(x))) - 2)
    block = F.concat(
        line(4, quoted(c("name")), F.lit(":")),
        line(6, F.lit("type: "), quoted(c("type"))),
        line(6, F.lit("skipped: "), c("skipped").cast("string")),
        line(6, F.lit("transitions: {success: [next_"), c("k").cast("string"), F.lit("], note: x}")),
        line(6, F.lit("parameters:")),
        line(8, F.lit("snowflake-output-connector-v0: {tableName: "), quoted(c("landing")), F.lit("}")),
        line(8, F.lit("targetTable: "), F.coalesce(c("fallback"), F.lit("null"))),
        line(8, F.lit("sourceTable: "), c("source_table")),
        line(8, F.lit("orchestrationJob: a/b/f_"), (c("k") % 10).cast("string"), F.lit(".orch.yaml")),
        F.coalesce(line(8, F.lit("sqlScript: "), quoted(c("sql_script"))), F.lit("")),
    )
    blocks = raw_components(spark, sf_dir).select(
        "rel_path", F.struct(c("ordinal"), block.alias("text")).alias("c")
    )
    return (
        spread_by(blocks, "rel_path")
        .groupBy("rel_path")
        .agg(F.sort_array(F.collect_list("c")).alias("cs"))
        .select(
            "rel_path",
            F.concat(
                F.lit("pipeline:\n  components:\n"),
                F.array_join(F.transform("cs", lambda x: x["text"]), ""),
            ).alias("content"),
        )
    )


YAML_SQL = f"""WITH {COMPONENTS_SQL}
    SELECT rel_path, CAST(row_number() OVER (PARTITION BY rel_path ORDER BY ordinal) - 1 AS INTEGER) AS ordinal,
           name, type, role, skipped, output_table, source_table,
           CASE WHEN type = 'run-orchestration' THEN 'f_' || (k % 10) END AS called_pipeline,
           'next_' || k AS transitions,
           CASE WHEN moves THEN 'r_' || (k + 2) ELSE '' END AS sql_sources,
           CASE WHEN moves THEN 't_' || (k + 1) ELSE '' END AS sql_targets
    FROM typed"""


def flat_components(rows: DataFrame) -> DataFrame:
    return rows.select(
        "rel_path", "ordinal", "name", "type", "role", "skipped", "output_table", "source_table",
        "called_pipeline", F.array_join("transitions", ",").alias("transitions"),
        F.array_join("sql_sources", ",").alias("sql_sources"),
        F.array_join("sql_targets", ",").alias("sql_targets"),
    )


@query("yaml_components", YAML_SQL)
def yaml_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_components(orchestration.parse(yaml_files(spark, sf_dir)).components)
