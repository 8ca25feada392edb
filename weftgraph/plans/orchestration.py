"""Orchestration corpus (``*.orch.yaml``) to nodes.

parse (Python worker, YAML only) -> component rows -> table indexes and hand-off joins -> nodes. The
barrier between "all files parsed" and "edges resolved" is an ordinary shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.functions import nested, sqlrefs, text
from weftgraph.functions.yamldoc import yaml_documents
from weftgraph.operators import components as comp
from weftgraph.operators import graph

INTEGRATION = "Matillion"
SUFFIX = "*.orch.yaml"
DOC = "description string, components array<struct<name string, body string>>"
OUTPUT_BLOCK = "$.parameters['snowflake-output-connector-v0']"
INPUT_BLOCK = "$.parameters['api-extract-input-v2']"


@dataclass(frozen=True)
class Parsed:
    """``docs``: one row per readable file. ``components``: one per usable component."""

    docs: DataFrame
    components: DataFrame
    failures: DataFrame


def parse_documents(artifacts: DataFrame) -> DataFrame:
    """rel_path, doc (JSON), error. The file text goes no further than this."""
    return artifacts.select("rel_path", yaml_documents(F.col("content")).alias("_y")).select(
        "rel_path", F.col("_y.doc").alias("doc"), F.col("_y.error").alias("error")
    )


def _python_text(v: Column) -> Column:
    """A scalar as the text a Python reader would make of it."""
    plain = F.try_variant_get(v, "$", "string")
    return F.when(F.schema_of_variant(v) == "BOOLEAN", F.initcap(plain)).otherwise(plain)


def _bad_component(v: Column, kind: Column) -> Column:
    """Null or a scalar where a mapping must be."""

    def not_mapping(path: str) -> Column:
        there = F.try_variant_get(v, path, "variant").isNotNull()
        return there & F.try_variant_get(v, path, "map<string,variant>").isNull()

    bad = nested.missing_or_null(v, "$.type")
    for path in ("$", "$.parameters", "$.transitions", OUTPUT_BLOCK, INPUT_BLOCK):
        bad = bad | not_mapping(path)
    no_script = nested.missing_or_null(v, "$.parameters.sqlScript") & (kind == "sql-executor")
    return v.isNull() | F.coalesce(bad | no_script, F.lit(False))


def component_rows(docs: DataFrame) -> DataFrame:
    """Explode parsed documents to components; ``bad`` marks those that cannot be read."""
    v = F.col("v")

    def get(path: str, kind: str = "string") -> Column:
        return F.nullif(F.try_variant_get(v, path, kind), F.lit("")) if kind == "string" else (
            F.try_variant_get(v, path, kind)
        )

    rows = (
        docs.filter(F.col("error").isNull())
        .select("rel_path", F.from_json("doc", DOC).alias("d"))
        .select("rel_path", F.posexplode("d.components").alias("ordinal", "c"))
        .select(
            "rel_path",
            "ordinal",
            F.col("c.name").alias("name"),
            F.try_parse_json("c.body").alias("v"),
            F.from_json("c.body", "transitions map<string,string>")["transitions"].alias("moves"),
        )
        .withColumn("type", F.coalesce(F.try_variant_get(v, "$.type", "string"), F.lit("unknown")))
    )
    flag = F.try_variant_get(v, "$.skipped", "boolean")
    given = F.try_variant_get(v, "$.skipped", "variant")
    is_sql = F.col("type") == "sql-executor"
    is_call = F.col("type") == "run-orchestration"
    is_shared = F.col("type") == "run-shared-pipeline"
    pairs = F.transform(
        F.try_variant_get(v, "$.parameters.setScalarVariables", "array<variant>"),
        lambda p: F.transform(F.try_variant_get(p, "$", "array<variant>"), _python_text),
    )
    lists = F.transform_values("moves", lambda _, x: F.from_json(x, "array<string>"))
    return rows.select(
        "rel_path",
        "ordinal",
        "name",
        "type",
        comp.role(F.col("type")).alias("role"),
        F.coalesce(flag, given.isNotNull() & ~F.is_variant_null(given), F.lit(False)).alias(
            "skipped"
        ),
        get(f"{INPUT_BLOCK}.endpoint").alias("endpoint"),
        text.first_non_empty(
            F.try_variant_get(v, f"{OUTPUT_BLOCK}.tableName", "string"),
            F.try_variant_get(v, "$.parameters.targetTable", "string"),
        ).alias("output_table"),
        get("$.parameters.sourceTable").alias("source_table"),
        F.when(is_sql, F.try_variant_get(v, "$.parameters.sqlScript", "string")).alias("sql_script"),
        F.when(is_call, F.try_variant_get(v, "$.parameters.orchestrationJob", "string")).alias(
            "called_pipeline_path"
        ),
        F.when(is_shared, F.try_variant_get(v, "$.parameters.pipelineName", "string")).alias(
            "shared_pipeline_name"
        ),
        F.when(is_shared, nested.pairs_to_map(pairs)).alias("shared_pipeline_vars"),
        F.coalesce(nested.flatten_lists(lists), F.array().cast("array<string>")).alias("transitions"),
        _bad_component(v, F.col("type")).alias("bad"),
    ).withColumn("called_pipeline", text.call_leaf(F.col("called_pipeline_path")))


def parse(artifacts: DataFrame, stage=lambda df, name: df) -> Parsed:
    """``stage`` may write the parsed documents and components once (see ``session.stage_table``)."""
    docs = stage(parse_documents(artifacts), "documents")
    rows = component_rows(docs)
    rows = stage(
        sqlrefs.with_script_io(rows, "sql_script", "sql_sources", "sql_targets"), "components"
    )
    usable = rows.filter(~F.col("bad")).drop("bad")
    failures = docs.filter(F.col("error").isNotNull()).select(
        F.lit(INTEGRATION).alias("integration"), "rel_path", F.lit("file").alias("stage"), "error"
    ).unionByName(
        rows.filter("bad").select(
            F.lit(INTEGRATION).alias("integration"),
            "rel_path",
            F.lit("component").alias("stage"),
            F.concat(F.lit("unreadable component "), "name").alias("error"),
        )
    )
    readable = docs.filter(F.col("error").isNull()).select(
        "rel_path", F.from_json("doc", DOC)["description"].alias("description")
    )
    return Parsed(readable, usable, failures)


def flow_rows(parsed: Parsed) -> DataFrame:
    """One row per file: name, type, counts, staging flag, given description."""
    stem = F.regexp_replace(text.file_stem(F.col("rel_path")), r"\.orch$", "")
    return (
        parsed.docs.join(comp.flows(parsed.components), ["rel_path"], "left")
        .withColumn("pipeline_name", text.display_name(F.col("rel_path")))
        .withColumn("stem", stem)
        .fillna({"pipeline_type": "unknown", "active_jobs": 0, "skipped_jobs": 0, "staged": False})
    )


def _url(repo_url: str, branch: str) -> Column:
    return text.source_url(F.lit(repo_url), F.lit(branch), F.col("rel_path"))


def _touched(jobs: DataFrame, kind: str, connector: str, sql: str) -> DataFrame:
    """Table touches of jobs: the connector's table in flows of type ``kind``, and those of scripts."""
    key = ["rel_path", "ordinal", "job", "emitted"]
    own = jobs.filter((F.col("pipeline_type") == kind) & F.col(connector).isNotNull()).select(
        *key, F.lit(1).alias("slot"), F.lit(0).alias("pos"), F.lower(connector).alias("table_name")
    )
    scripts = jobs.select(*key, F.lit(2).alias("slot"), F.posexplode(sql).alias("pos", "table_name"))
    return own.unionByName(scripts)


def convert(
    parsed: Parsed, repo_url: str, branch: str, stage=lambda df, name: df
) -> DataFrame:
    """Pipeline and Job nodes of the whole corpus."""
    flows = stage(flow_rows(parsed), "flows")
    name = F.lit(INTEGRATION)

    pipelines = flows.select(
        name.alias("integration"),
        F.col("pipeline_name").alias("name"),
        F.lit("Pipeline").alias("node_type"),
        F.struct(
            comp.flow_description(
                F.col("description"),
                F.col("pipeline_type"),
                F.col("active_jobs"),
                F.col("skipped_jobs"),
            ).alias("description"),
            _url(repo_url, branch).alias("url"),
        ).alias("attributes"),
        F.struct(
            graph.no_deps().alias("upstream_dependencies"),
            F.lit(None).cast(graph.no_deps_type()).alias("downstream_dependencies"),
        ).alias("lineage"),
    )

    attached = comp.with_flow(
        parsed.components,
        flows.select("rel_path", "pipeline_name", "pipeline_type", "staged"),
        ["ordinal"],
    )
    jobs = stage(
        comp.rewrite_staging(attached)
        .withColumn("job", F.concat_ws(".", "pipeline_name", "name"))
        .withColumn(
            "emitted",
            comp.data_bearing(F.col("role"), F.col("sql_sources"), F.col("sql_targets")),
        ),
        "jobs",
    )
    # The indexes know every component, also those that become no node.
    access = stage(
        graph.accesses(
            _touched(jobs, "ingestion", "output_table", "sql_targets"),
            _touched(jobs, "reverse_etl", "source_table", "sql_sources"),
        ),
        "access",
    )
    tagged = graph.tag_accesses(access)
    own = tagged.filter("emitted")

    def dep(direction: str, ref: Column, slot="slot", pos="pos", path=F.lit(""), at=F.lit(0)):
        slot, pos = (x if isinstance(x, Column) else F.col(x) for x in (slot, pos))
        return [
            "rel_path",
            "ordinal",
            F.lit(direction).alias("direction"),
            F.struct(
                slot.alias("slot"), pos.alias("pos"), path.alias("path"), at.alias("at")
            ).alias("rank"),
            ref.alias("dep"),
        ]

    table = graph.table_ref(F.col("table_name"))
    emitted = jobs.filter("emitted")
    calls = emitted.filter(
        (F.col("role") == "orchestrator_call") & F.col("called_pipeline").isNotNull()
    ).select("rel_path", "ordinal", "called_pipeline")
    resolved = graph.resolve_calls(
        calls, graph.call_index(flows), ["rel_path", "ordinal"]
    ).filter(F.col("resolved").isNotNull())

    deps = (
        emitted.select(
            *dep(
                "up",
                graph.node_ref(name, F.lit("Pipeline"), F.col("pipeline_name")),
                F.lit(0),
                F.lit(0),
            )
        )
        .unionByName(graph.kept_reads(own).select(*dep("up", table)))
        .unionByName(graph.kept_writes(own).select(*dep("down", table)))
        .unionByName(
            graph.handoffs(tagged, own).select(
                *dep(
                    "down",
                    graph.node_ref(name, F.lit("Job"), F.col("consumer")),
                    path=F.col("c_rel_path"),
                    at=F.col("c_ordinal"),
                )
            )
        )
        .unionByName(
            resolved.select(
                *dep(
                    "down",
                    graph.node_ref(name, F.lit("Pipeline"), F.col("resolved")),
                    F.lit(9),
                    F.lit(0),
                )
            )
        )
    )
    deps = stage(deps, "dependencies")
    heads = emitted.select(
        "rel_path",
        "ordinal",
        name.alias("integration"),
        F.col("job").alias("name"),
        F.lit("Job").alias("node_type"),
        comp.job_description().alias("description"),
        _url(repo_url, branch).alias("url"),
        F.lit(True).alias("has_downstream"),
    )
    keys = ["rel_path", "ordinal"]
    return pipelines.unionByName(graph.assemble_nodes(heads, deps, keys))


def unresolved(parsed: Parsed) -> DataFrame:
    """Calls of flows that are not in the corpus."""
    calls = parsed.components.filter(
        (F.col("role") == "orchestrator_call") & F.col("called_pipeline").isNotNull()
    ).select("rel_path", "ordinal", "name", "called_pipeline")
    return graph.unresolved_calls(
        calls, graph.call_index(flow_rows(parsed)), ["rel_path", "ordinal"]
    )
