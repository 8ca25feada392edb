"""Sources, sinks, whole runs, user-supplied parsers and streams."""

import json
import os

import pytest
from helpers import FIXTURES, by_name
from pyspark.sql import functions as F

from weftgraph.jobs import run
from weftgraph.operators import graph, usage
from weftgraph.plans import registry
from weftgraph.schemas import NODE, PARSE_FAILURE, TABLE_USAGE
from weftgraph.sinks import tables as sinks
from weftgraph.sources import artifacts as src
from weftgraph.sources import catalog
from weftgraph.session import stage_table
from weftgraph.streaming import ingest
from weftgraph.streaming import usage as usage_stream


def test_artifacts(spark):
    rows = src.read_artifacts(spark, f"{FIXTURES}/orchestration", "*.orch.yaml", "M").collect()
    paths = {r["rel_path"] for r in rows}
    assert "a/dup.orch.yaml" in paths and "main.orch.yaml" in paths and "other.yaml" not in paths
    assert all(r["modified_at"] is not None for r in rows)
    one = src.read_artifacts(spark, f"{FIXTURES}/orchestration/main.orch.yaml", "*.orch.yaml", "M")
    assert [r["rel_path"] for r in one.collect()] == ["main.orch.yaml"]


def test_paths(spark, tmp_path):
    """The root's name may come again below it; names may hold blanks and plus signs."""
    for name in ("in/x.py", "in/in/a b+c.py", "in/in/in/y.py"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("1")
    root = str(tmp_path / "in")
    for given in (root, root + "/", f"file://{root}", os.path.relpath(root)):
        rows = src.read_artifacts(spark, given, "*.py", "S").collect()
        assert {r["rel_path"] for r in rows} == {"x.py", "in/a b+c.py", "in/in/y.py"}, given


def test_allow_list(spark):
    corpus = src.read_artifacts(spark, f"{FIXTURES}/orchestration", "*.orch.yaml", "M")
    listed = " main.orch.yaml ,, a/dup.orch.yaml,gone.orch.yaml"
    chosen = src.select_artifacts(corpus, listed)
    assert {r["rel_path"] for r in chosen.collect()} == {"main.orch.yaml", "a/dup.orch.yaml"}
    absent = src.missing(corpus, src.allow_list(spark, listed)).collect()
    assert [r["rel_path"] for r in absent] == ["gone.orch.yaml"]
    assert src.select_artifacts(corpus, " , ").count() == corpus.count()
    with pytest.raises(src.NoArtifacts):
        src.select_artifacts(corpus, "gone.orch.yaml")
    with pytest.raises(src.NoArtifacts):
        src.select_artifacts(corpus.filter("false"))


@pytest.mark.parametrize(
    "name, folder, parents",
    [
        ("Matillion", "orchestration", 10),
        ("Streamlit", "dashboard", 11),
        ("Snowflake Notebooks", "notebook", 5),
    ],
)
def test_run(spark, tmp_path, name, folder, parents):
    out = run(spark, name, f"{FIXTURES}/{folder}", str(tmp_path), "https://g/r")
    kinds = registry.get(name).node_types
    assert out.summary.filter(F.col("node_type") == kinds[0]).first()["nodes"] == parents
    # The written documents have the documented shape: no null fields, either form of dependency.
    lines = []
    for folder_, _, files in os.walk(tmp_path / "nodes"):
        lines += [
            json.loads(x)
            for f in files
            if f.endswith(".json")
            for x in open(os.path.join(folder_, f), encoding="utf-8")
        ]
    assert len(lines) == out.nodes.count()
    for node in lines:
        assert set(node) == {"name", "node_type", "attributes", "lineage"}
        assert ("downstream_dependencies" in node["lineage"]) == (node["node_type"] == kinds[1])
        for dep in sum(node["lineage"].values(), []):
            assert set(dep) in ({"table_name"}, {"integration_name", "node_type", "node_name"})
    back = sinks.read_nodes(spark, str(tmp_path))
    assert by_name(back).keys() == by_name(out.nodes).keys()
    assert catalog.invalid(back).isEmpty()
    assert sinks.read_table(spark, str(tmp_path), "failures").count() == out.failures.count()
    counted = {r["node_type"]: r["nodes"] for r in out.summary.collect()}
    assert counted["total"] == len(lines) and counted["failures"] == out.failures.count()
    # A second run replaces the first.
    run(spark, name, f"{FIXTURES}/{folder}", str(tmp_path), "https://g/r")
    assert sinks.read_nodes(spark, str(tmp_path)).count() == len(lines)
    if name == "Streamlit":
        metadata = sinks.read_table(spark, str(tmp_path), "app_metadata")
        assert metadata.count() == 2
        assert usage.first_metadata(metadata).count() == 2
        log = sinks.read_table(spark, str(tmp_path), "table_usage").withColumnRenamed("file_path", "f")
        top = usage.usage_summary(log).first()
        assert top["usage_count"] >= 2


def test_smaller_second_run(spark, tmp_path):
    """What a second run writes is all that is there, but for other integrations."""
    root = str(tmp_path)
    args = (spark, "Streamlit", f"{FIXTURES}/dashboard", root, "https://g/r")
    run(*args)
    first = sinks.read_table(spark, root, "table_usage").count()
    out = run(spark, "Matillion", f"{FIXTURES}/orchestration", root, "https://g/r")
    failed = out.failures.count()
    run(*args)
    assert sinks.read_table(spark, root, "table_usage").count() == first
    failures = sinks.read_table(spark, root, "failures")
    assert failures.filter("integration = 'Matillion'").count() == failed > 0
    others = sinks.read_nodes(spark, root).filter("integration = 'Matillion'").count()
    out = run(*args, files="plain.py")
    back = sinks.read_nodes(spark, root)
    assert by_name(back.filter("integration = 'Streamlit'")) == by_name(out.nodes)
    assert back.filter("integration = 'Matillion'").count() == others > 0
    log = sinks.read_table(spark, root, "table_usage")
    assert {r["file_path"] for r in log.select("file_path").distinct().collect()} <= {"plain.py"}


def usage_of(spark, *files):
    return spark.createDataFrame([(1, f) for f in files], "id bigint, file_path string").select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in ("id", "file_path") else F.lit(None).cast(f.dataType).alias(f.name) for f in TABLE_USAGE.fields]
    )


def test_committed_runs(spark, tmp_path):
    """A larger, a smaller and an empty run, a run that is never committed, and a second integration."""
    root = f"{tmp_path}/out"
    failure = lambda *paths: spark.createDataFrame([("x", p, "parse", "no") for p in paths], PARSE_FAILURE)

    def go(integration, *paths, commit=True):
        one = sinks.Run(spark, root, integration)
        one.write("failures", failure(*paths))
        one.write("table_usage", usage_of(spark, *paths))
        if commit:
            one.commit()

    def there():
        return [
            sorted((r["integration"], r[c]) for r in sinks.read_table(spark, root, t).collect())
            for t, c in (("failures", "rel_path"), ("table_usage", "file_path"))
        ]

    assert there() == [[], []]
    go("A", "a", "b", "c")
    go("B b", "a")
    assert there() == [[("A", "a"), ("A", "b"), ("A", "c"), ("B b", "a")]] * 2
    go("A", "d")
    go("A", "never", commit=False)
    assert there() == [[("A", "d"), ("B b", "a")]] * 2
    go("A")
    assert there() == [[("B b", "a")]] * 2
    assert sinks.drop_old_runs(spark, root) == 6 and there() == [[("B b", "a")]] * 2
    # Tables that a run does not write are gone with the run before.
    sinks.Run(spark, root, "B b").commit()
    assert there() == [[], []]


def test_run_of_listed_file(spark, tmp_path):
    out = run(
        spark, "Streamlit", f"{FIXTURES}/dashboard", str(tmp_path), "https://g/r",
        files="plain.py,gone.py", app_name="Mine",
    )
    assert {n for n in by_name(out.nodes)} == {"Mine", "Mine.unknown (Line 1)"}
    assert [r[0] for r in out.missing.collect()] == ["gone.py"]
    assert not os.path.exists(tmp_path / "failures")


def test_validation(spark):
    dep = {"table_name": "t"}
    both = {"table_name": "t", "node_name": "n", "node_type": "x", "integration_name": "i"}
    good = {"name": "n", "node_type": "Job", "attributes": {"description": "d", "url": "u"}, "lineage": {"upstream_dependencies": [dep]}}
    bad = [
        {**good, "name": None},
        {**good, "attributes": {"description": "d"}},
        {**good, "lineage": {}},
        {**good, "lineage": {"upstream_dependencies": [both]}},
        {**good, "lineage": {"upstream_dependencies": [{"node_name": "n"}]}},
        {k: v for k, v in good.items() if k != "lineage"},
    ]
    text = spark.createDataFrame([(json.dumps(x),) for x in [good, *bad]], "value string")
    nodes = text.select(F.from_json("value", NODE).alias("n")).select("n.*")
    assert catalog.invalid(nodes).count() == len(bad)
    with pytest.raises(catalog.InvalidNodes):
        catalog.checked(nodes)
    ok = nodes.limit(1).withColumn("integration", F.lit("Matillion"))
    assert catalog.checked(ok, catalog.known_types(spark)).count() == 1
    with pytest.raises(catalog.InvalidNodes):
        catalog.checked(ok.withColumn("node_type", F.lit("Nope")), catalog.known_types(spark))


def test_dimensions(spark, tmp_path):
    (tmp_path / "i.json").write_text('{\n "name": "X",\n "logo_url": "https://l"\n}')
    (tmp_path / "t.json").write_text('[\n {"node_type": "A", "icon_name": "i", "color": "c"},\n {"node_type": "B"}]')
    assert catalog.read_integration(spark, str(tmp_path / "i.json")).first()["name"] == "X"
    types = catalog.read_node_types(spark, str(tmp_path / "t.json"))
    assert [r["node_type"] for r in types.collect()] == ["A", "B"]


def nodes_at(spark, when, *names):
    rows = [(n, f"{n}@{when}") for n in names]
    return spark.createDataFrame(rows, "name string, d string").select(
        F.lit("I").alias("integration"), "name", F.lit("Job").alias("node_type"),
        F.struct(F.col("d").alias("description"), F.lit("u").alias("url")).alias("attributes"),
        F.lit(when).alias("modified_at"),
    )


def test_upsert(spark, tmp_path):
    first = sinks.upsert(None, nodes_at(spark, 1, "a", "b"))
    path = sinks.write_version(first, str(tmp_path), "1")
    second = sinks.upsert(spark.read.parquet(path), nodes_at(spark, 2, "a", "c"))
    found = {r["name"]: r["attributes"]["description"] for r in second.collect()}
    assert found == {"a": "a@2", "b": "b@1", "c": "c@2"}
    replay = sinks.upsert(second, nodes_at(spark, 1, "c"))
    assert {r["attributes"]["description"] for r in replay.collect()} == {"a@2", "b@1", "c@2"}
    undated = nodes_at(spark, 1, "c", "d").withColumn("modified_at", F.lit(None).cast("int"))
    kept = {r["attributes"]["description"] for r in sinks.upsert(second, undated).collect()}
    assert kept == {"a@2", "b@1", "c@2", "d@1"}


def test_user_parser(spark, tmp_path):
    (tmp_path / "in" / "x").mkdir(parents=True)
    (tmp_path / "in" / "my_jobs.jobs").write_text("load,Raw_T\nclean,\n")
    (tmp_path / "in" / "x" / "bad.jobs").write_text("nothing here\n")

    def jobs(rel_path, content):
        for line in content.split():
            name, table = line.split(",")
            yield {"name": name, "table": table}

    registry.register(registry.template("Jobs", "*.jobs", jobs))
    out = run(spark, "Jobs", str(tmp_path / "in"), str(tmp_path / "out"), "https://g/r")
    named = by_name(out.nodes)
    assert set(named) == {"My Jobs", "My Jobs.load", "My Jobs.clean"}
    assert named["My Jobs.load"][0][3:] == (["ParentNode:My Jobs"], ["raw_t"])
    assert named["My Jobs.clean"][0][4] == []
    assert [r["rel_path"] for r in out.failures.collect()] == ["x/bad.jobs"]


def test_records_from_elsewhere(spark, tmp_path):
    spark.range(3).selectExpr("concat('c', id) as child", "'P' as parent").write.parquet(f"{tmp_path}/r")
    rows = catalog.read_records(spark, "parquet", f"{tmp_path}/r")
    from weftgraph.operators.parent_child import parent_child_nodes

    nodes = parent_child_nodes(
        rows, "R", F.col("parent"), F.col("child"), F.lit("Tab"), F.lit("u"), direction="upstream"
    )
    named = by_name(nodes)
    assert named["P.c1"][0][3:] == (["tab"], ["ParentNode:P"]) and len(named) == 4


def test_streamed_artifacts(spark, tmp_path):
    """Files of a later batch replace nodes of the same name."""
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "one.orch.yaml").write_text("pipeline: {metadata: {description: first}}\n")
    job = registry.get("Matillion")

    def convert(batch):
        where = registry.Run("https://g/r")
        nodes = job.convert(job.parse(batch, stage_table), where, stage_table)
        return nodes.withColumn("modified_at", F.current_timestamp())

    def go():
        ingest.ingest_nodes(
            src.stream_artifacts(spark, str(folder), job.suffix, "Matillion"),
            convert, f"{tmp_path}/log", f"{tmp_path}/state",
        )
        rows = ingest.current_nodes(spark, f"{tmp_path}/log").collect()
        return {r["name"]: r["attributes"]["description"] for r in rows}

    assert go() == {"One": "first"}
    (folder / "two.orch.yaml").write_text("pipeline: {metadata: {description: second}}\n")
    (folder / "sub").mkdir()
    (folder / "sub" / "one.orch.yaml").write_text("pipeline: {metadata: {description: newer}}\n")
    assert go() == {"One": "newer", "Two": "second"}
    assert go() == {"One": "newer", "Two": "second"}


def test_streamed_flows(spark, tmp_path):
    """Edges between files of different batches."""
    folder = tmp_path / "in"
    folder.mkdir()
    sql = "pipeline: {components: {J: {type: sql-executor, parameters: {sqlScript: %r}}}}\n"

    def go():
        ingest.ingest_flows(
            src.stream_artifacts(spark, str(folder), "*.orch.yaml", "Matillion"),
            f"{tmp_path}/log", f"{tmp_path}/state",
        )
        parsed = ingest.current_flows(spark, f"{tmp_path}/log")
        nodes = by_name(registry.get("Matillion").convert(parsed, registry.Run("u"), stage_table))
        return {k: v[0][3:] for k, v in nodes.items() if v[0][0] == "Job"}

    (folder / "one.orch.yaml").write_text(sql % "INSERT INTO mid SELECT * FROM src")
    assert go() == {"One.J": (["Pipeline:One", "src"], ["mid"])}
    (folder / "two.orch.yaml").write_text(sql % "INSERT INTO out SELECT * FROM mid")
    assert go() == {
        "One.J": (["Pipeline:One", "src"], ["Job:Two.J"]), "Two.J": (["Pipeline:Two"], ["out"]),
    }


def test_streamed_usage(spark, tmp_path):
    log = spark.range(300).select(
        F.array(F.concat(F.lit("t"), F.col("id") % 7), F.lit("")).alias("tables_used"),
        F.lit("table").alias("chart_type"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("c"), F.col("id") % 5)).alias("chart_name"),
    )
    log.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = ingest.stream_table(spark, f"{tmp_path}/in", "*.parquet", log.schema.simpleString()[7:-1].replace(":", " ").replace("array<string>", "array<string>"), 1)
    usage_stream.count_usage(stream, f"{tmp_path}/out", f"{tmp_path}/state")
    got = usage_stream.current_summary(spark, f"{tmp_path}/out")
    want = usage.usage_summary(log)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert len(os.listdir(f"{tmp_path}/out")) >= 3
    usage_stream.fold_usage(spark, f"{tmp_path}/out")
    assert len(os.listdir(f"{tmp_path}/out")) == 1
    again = usage_stream.current_summary(spark, f"{tmp_path}/out")
    assert again.exceptAll(want).isEmpty() and want.exceptAll(again).isEmpty()


def test_replays(spark, tmp_path):
    rows = spark.range(20).select(
        (F.col("id") % 10).alias("key"), F.lit("2024-01-01").cast("timestamp").alias("ts")
    )
    rows.write.parquet(f"{tmp_path}/in")
    stream = ingest.stream_table(spark, f"{tmp_path}/in", "*.parquet", "key bigint, ts timestamp")
    seen = []
    (
        ingest.distinct_arrivals(stream, "ts", ["key"], "1 hour")
        .writeStream.foreachBatch(lambda df, i: seen.append(df.count()))
        .option("checkpointLocation", f"{tmp_path}/state")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    assert sum(seen) == 10


def test_graph_set_operations(spark):
    old = nodes_at(spark, 1, "a", "b")
    assert graph.run_summary(old).first()["nodes"] == 2
