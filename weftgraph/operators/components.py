"""Orchestration components: roles, flow types, descriptions, and which of them move data.

Rows carry the columns of SURVEY's ``component`` table. What is a property of the whole flow (its type,
the staging rewrite) is aggregated per file and attached again, or computed in the file's own array by
the converter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.functions import text
from weftgraph.plans import skew

# Component types that carry no data and are known not to.
KNOWN_UTILITIES = (
    "start", "end-failure", "end-success", "or", "and", "retry", "query-to-scalar", "python-script",
    "iterator", "fixed-flow-iterator", "loop-iterator", "if", "case", "webhook-post",
)

# Flow types by precedence, with the roles that make them.
FLOW_TYPES = (
    ("reverse_etl", ("reverse_etl_output",)),
    ("ingestion", ("ingestion_input",)),
    ("orchestrator", ("orchestrator_call", "shared_pipeline_call")),
    ("sql_transform", ("sql_transform",)),
)

# How a flow type reads in a description.
TYPE_LABELS = {
    "ingestion": "ingestion (SaaS → Snowflake)",
    "reverse_etl": "reverse ETL (Snowflake → destination)",
    "orchestrator": "orchestrator (calls other pipelines)",
    "sql_transform": "SQL transform",
}
OTHER_LABEL = "orchestration"

STAGING_MARK = "_STG_MERGE"

# Formats of descriptions.
FLOW = "Matillion {} pipeline with {} active job(s){}."
FLOW_SKIPPED = " and {} skipped job(s)"
JOB = "Matillion job: {}."
JOB_SKIPPED = " *(currently skipped)*"
CALLS_ENDPOINT = "Calls the **{}** API endpoint"
WRITES_TABLE = "writes results to Snowflake table `{}`"
READS_TABLE = "reads from Snowflake table/view `{}`"
WRITES_FROM = "runs SQL writing `{}` from `{}`"
WRITES_ONLY = "runs SQL writing `{}`"
RUNS_FLOW = "runs orchestration `{}`"
RUNS_SHARED = "runs shared pipeline `{}`"
RUNS_DBT = "runs shared pipeline `{}` (dbt job `{}`)"
JOINED = " and "


def role(component_type: Column) -> Column:
    t = F.lower(component_type)
    return (
        F.when(t.contains("-input-") | (t == "mongodb-query"), "ingestion_input")
        .when(t.endswith("-output"), "reverse_etl_output")
        .when(t == "run-orchestration", "orchestrator_call")
        .when(t == "run-shared-pipeline", "shared_pipeline_call")
        .when(t == "sql-executor", "sql_transform")
        .otherwise("utility")
    )


def unclassified(components: DataFrame) -> DataFrame:
    return components.filter(
        (F.col("role") == "utility") & ~F.col("type").isin(*KNOWN_UTILITIES)
    )


def type_rank(role_col: Column) -> Column:
    """Place of the flow type a role stands for; the least of a file decides."""
    rank = F.lit(len(FLOW_TYPES))
    for place, (_, roles) in reversed(list(enumerate(FLOW_TYPES))):
        rank = F.when(role_col.isin(*roles), place).otherwise(rank)
    return rank


def type_of_rank(rank: Column) -> Column:
    out = F.lit("unknown")
    for place, (name, _) in reversed(list(enumerate(FLOW_TYPES))):
        out = F.when(rank == place, name).otherwise(out)
    return out


def active(c: str = "type") -> Column:
    return F.col(c) != "start"


def is_staging_merge(component_type: Column, script: Column) -> Column:
    return F.coalesce(
        (component_type == "sql-executor") & F.upper(script).contains(STAGING_MARK), F.lit(False)
    )


def flows(components: DataFrame, keys: Sequence[str] = ("rel_path",)) -> DataFrame:
    """One row per file: type, active and skipped job counts, staging flag."""
    return components.groupBy(*keys).agg(
        type_of_rank(F.min(type_rank(F.col("role")))).alias("pipeline_type"),
        F.count_if(active() & ~F.col("skipped")).alias("active_jobs"),
        F.count_if(active() & F.col("skipped")).alias("skipped_jobs"),
        F.bool_or(is_staging_merge(F.col("type"), F.col("sql_script"))).alias("staged"),
    )


def with_flow(components: DataFrame, flow_rows: DataFrame, spread: Sequence[str]) -> DataFrame:
    """Attach flow columns to components; the components of a huge file stay spread."""
    keys = ("rel_path",)
    return skew.salted_join(
        components, flow_rows, keys, "left", skew.find_hot(components, keys), spread
    )


def rewrite_staging(components: DataFrame) -> DataFrame:
    """``X_LND`` outputs become ``X_STG`` in files whose scripts merge into staging (column ``staged``)."""
    return components.withColumn(
        "output_table",
        F.when(F.col("staged"), text.landing_to_staging(F.col("output_table"))).otherwise(
            F.col("output_table")
        ),
    )


def data_bearing(role_col: Column, sources: Column, targets: Column) -> Column:
    """Connectors and calls always; SQL only with both a source and a target."""
    always = role_col.isin(
        "ingestion_input", "reverse_etl_output", "orchestrator_call", "shared_pipeline_call"
    )
    return always | ((role_col == "sql_transform") & (F.size(sources) > 0) & (F.size(targets) > 0))


def flow_description(given: Column, flow_type: Column, n_active: Column, n_skipped: Column) -> Column:
    label = F.coalesce(
        F.create_map(*[F.lit(x) for kv in TYPE_LABELS.items() for x in kv])[flow_type],
        F.lit(OTHER_LABEL),
    )
    skipped = F.when(n_skipped > 0, text.fill(FLOW_SKIPPED, n_skipped)).otherwise("")
    return F.coalesce(F.nullif(given, F.lit("")), text.fill(FLOW, label, n_active, skipped))


def job_description() -> Column:
    """What a component does, from the columns of a component row with its flow's type."""
    c = F.col

    def some(x: Column) -> Column:
        return F.coalesce(x != "", F.lit(False))

    def list_of(name: str) -> Column:
        return F.array_join(c(name), ", ")

    flow, role_, shared = c("pipeline_type"), c("role"), c("shared_pipeline_name")
    dbt_job = F.try_element_at(c("shared_pipeline_vars"), F.lit("DBT_JOB_ID"))
    writes = (role_ == "sql_transform") & (F.size("sql_targets") > 0)
    parts = F.concat_ws(
        JOINED,
        F.when(some(c("endpoint")), text.fill(CALLS_ENDPOINT, c("endpoint"))),
        F.when(
            (flow == "ingestion") & some(c("output_table")), text.fill(WRITES_TABLE, c("output_table"))
        ).when(
            (flow == "reverse_etl") & some(c("source_table")),
            text.fill(READS_TABLE, c("source_table")),
        ),
        F.when(
            writes & (F.size("sql_sources") > 0),
            text.fill(WRITES_FROM, list_of("sql_targets"), list_of("sql_sources")),
        ).when(writes, text.fill(WRITES_ONLY, list_of("sql_targets"))),
        F.when(
            (role_ == "orchestrator_call") & some(c("called_pipeline")),
            text.fill(RUNS_FLOW, c("called_pipeline")),
        ),
        F.when(
            (role_ == "shared_pipeline_call") & some(shared),
            F.when(some(dbt_job), text.fill(RUNS_DBT, shared, dbt_job)).otherwise(
                text.fill(RUNS_SHARED, shared)
            ),
        ),
    )
    skipped = F.when(c("skipped"), JOB_SKIPPED).otherwise("")
    return F.when(parts != "", F.concat(parts, skipped, F.lit("."))).otherwise(
        F.concat(text.fill(JOB, c("name")), skipped)
    )
