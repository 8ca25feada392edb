"""One run of an integration: read, parse, convert, check, write."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from weftgraph.plans import dashboard, registry
from weftgraph.sinks import tables as sinks
from weftgraph.sources import artifacts as src
from weftgraph.sources import catalog
from weftgraph.session import stage_table


@dataclass(frozen=True)
class Outcome:
    nodes: DataFrame
    failures: DataFrame
    summary: DataFrame
    missing: DataFrame | None


def run(
    spark: SparkSession,
    name: str,
    input_path: str,
    output_path: str,
    repo_url: str,
    branch: str = "main",
    files: str = "",
    app_name: str | None = None,
    local: bool = False,
) -> Outcome:
    """Writes ``nodes``, ``failures`` (if any) and, for dashboards, the usage tables below ``output_path``, and commits
    them together. ``files`` is a comma-separated allow-list of paths relative to the input. The summary has the
    nodes of each type, their total and the failures, counted while they are written."""
    job = registry.get(name)
    corpus = src.read_artifacts(spark, input_path, job.suffix, name)
    absent = src.missing(corpus, src.allow_list(spark, files)) if src.strip_text(files) else None
    # A listed file is taken as it is; discovery by content is for runs over everything.
    chosen = src.select_artifacts(corpus if absent is not None else job.select(corpus), files)
    parsed = job.parse(chosen, stage_table)
    where = registry.Run(repo_url, branch, app_name, local)
    nodes = stage_table(job.convert(parsed, where, stage_table), "nodes")
    declared = spark.createDataFrame(
        [(name, t) for t in job.node_types], "integration string, node_type string"
    )
    catalog.checked(nodes, F.broadcast(declared))
    written = sinks.Run(spark, output_path, name)
    counts = Observation("nodes")
    of_types = [F.count_if(F.col("node_type") == t).alias(t) for t in job.node_types]
    written.write("nodes", nodes.observe(counts, F.count(F.lit(1)).alias("total"), *of_types))
    total = {"failures": 0}
    if not parsed.failures.isEmpty():
        failed = Observation("failures")
        written.write("failures", parsed.failures.observe(failed, F.count(F.lit(1)).alias("failures")))
        total |= failed.get
    if isinstance(parsed, dashboard.Parsed):
        written.write("table_usage", parsed.usage)
        sinks.write_app_metadata(written, parsed.apps)
    written.commit()
    total |= counts.get
    lines = [(name, t, total[t]) for t in (*job.node_types, "total", "failures")]
    summary = spark.createDataFrame(lines, "integration string, node_type string, nodes bigint")
    return Outcome(nodes, parsed.failures, summary, absent)
