import pytest
from helpers import FIXTURES, by_name

from weftgraph.operators import components as comp
from weftgraph.operators import graph
from weftgraph.plans import orchestration
from weftgraph.session import stage_table
from weftgraph.sources.artifacts import read_artifacts

ROOT = f"{FIXTURES}/orchestration"


@pytest.fixture(scope="module")
def parsed(spark):
    files = read_artifacts(spark, ROOT, orchestration.SUFFIX, "Matillion")
    return orchestration.parse(files, stage_table)


@pytest.fixture(scope="module")
def nodes(parsed):
    return stage_table(orchestration.convert(parsed, "https://g/r", "dev", stage_table), "n")


@pytest.fixture(scope="module")
def named(nodes):
    return by_name(nodes)


def test_pipelines(named):
    url = "https://g/r/blob/dev/{}.orch.yaml"
    assert named["Ingest"] == [
        (
            "Pipeline",
            "Matillion ingestion (SaaS → Snowflake) pipeline with 2 active job(s) and 1 skipped job(s).",
            url.format("ingest"), [], None,
        )
    ]
    assert named["Ingest Stg"][0][1] == "Lands and merges."
    assert named["Reverse"][0][1].startswith("Matillion reverse ETL (Snowflake → destination)")
    assert named["Main"][0][1] == (
        "Matillion orchestrator (calls other pipelines) pipeline with 4 active job(s)."
    )
    assert named["Sql"][0][1] == "Matillion SQL transform pipeline with 5 active job(s)."
    assert named["No Pipeline"][0][1] == "Matillion orchestration pipeline with 0 active job(s)."
    assert named["No Components"][0][1] == "Empty one"
    assert "Empty" not in named and "Bad" not in named and "Other" not in named
    assert [n[2] for n in sorted(named["Dup"], key=lambda n: n[2])] == [
        url.format("a/dup"), url.format("b/dup"),
    ]


def test_ingestion_jobs(named):
    assert named["Ingest.Load Cases"][0][1] == (
        "Calls the **/cases** API endpoint and writes results to Snowflake table `CASES_RAW`."
    )
    # cases_raw is read by Build, so it is handed over; users_raw stays a table
    assert named["Ingest.Load Cases"][0][3:] == (["Pipeline:Ingest"], ["Job:Sql.Build"])
    assert named["Ingest.Load Users"][0][1] == (
        "writes results to Snowflake table `USERS_RAW` *(currently skipped)*."
    )
    assert named["Ingest.Load Users"][0][4] == ["users_raw"]
    assert "Ingest.Start" not in named and "Ingest.Alert" not in named


def test_staging_rewrite(named):
    assert named["Ingest Stg.Land A"][0][4] == ["case_stg"]
    assert named["Ingest Stg.Land B"][0][4] == ["x_stg"]
    assert "`x_STG`" in named["Ingest Stg.Land B"][0][1]
    assert named["Ingest Stg.Land C"][0][4] == ["other"]
    assert "Ingest Stg.Merge" not in named


def test_reverse_jobs(named):
    assert named["Reverse.Push Known"][0][3] == ["Pipeline:Reverse"]
    assert named["Reverse.Push Unknown"][0][3] == ["Pipeline:Reverse", "db.mart.x"]
    assert named["Reverse.Push Unknown"][0][1] == "reads from Snowflake table/view `DB.MART.X`."


def test_calls(named, parsed):
    assert named["Main.Call Known"][0][1] == "runs orchestration `ingest_stg`."
    assert named["Main.Call Known"][0][4] == ["Pipeline:Ingest Stg"]
    assert named["Main.Call Unknown"][0][4] == []
    assert named["Main.Run dbt"][0][1] == "runs shared pipeline `DBT_RUN_JOB` (dbt job `77`)."
    assert named["Main.Run plain"][0][1] == "runs shared pipeline `CLEANUP`."
    assert named["Dup.Call"][0][4] == ["Pipeline:Dup"]
    missing = {(r["rel_path"], r["called_pipeline"]) for r in orchestration.unresolved(parsed).collect()}
    assert missing == {("main.orch.yaml", "nowhere")}


def test_sql_jobs(named):
    assert named["Sql.Build"][0][1] == "runs SQL writing `v_cases` from `c, cases_raw, ext_t`."
    assert named["Sql.Build"][0][3:] == (
        ["Pipeline:Sql", "c", "ext_t"], ["Job:Reverse.Push Known"],
    )
    # A statement's own target is no source, whatever the other statements read.
    assert named["Sql.Self"][0][3:] == (["Pipeline:Sql", "ext_u"], ["self_t"])
    # Target Only becomes no node, yet its table counts as produced.
    assert "Sql.Target Only" not in named and "Sql.Broken SQL" not in named
    assert named["Sql.Ghost Reader"][0][3:] == (["Pipeline:Sql"], ["sink"])


def test_odd_components(named, parsed):
    rows = {r["name"]: r for r in parsed.components.filter("rel_path = 'odd.orch.yaml'").collect()}
    assert set(rows) == {"Widget", "Big", "No Type"}
    assert rows["No Type"]["type"] == "unknown" and rows["Big"]["role"] == "orchestrator_call"
    assert rows["Big"]["called_pipeline"] is None
    assert named["Odd.Big"][0][1] == "Matillion job: Big."
    left = {r["name"] for r in comp.unclassified(parsed.components).collect()}
    assert left == {"Widget", "No Type"}


def test_failures(parsed):
    found = {(r["rel_path"], r["stage"]) for r in parsed.failures.collect()}
    assert found == {
        ("empty.orch.yaml", "file"), ("bad.orch.yaml", "file"), ("odd.orch.yaml", "component"),
    }
    assert parsed.failures.filter("rel_path = 'odd.orch.yaml'").count() == 3


def test_components(parsed):
    rows = {r["name"]: r for r in parsed.components.collect()}
    assert rows["Load Cases"]["transitions"] == ["End", "Alert"]
    assert rows["Load Users"]["skipped"] is True and rows["Load Cases"]["skipped"] is False
    assert rows["Run dbt"]["shared_pipeline_vars"] == {"DBT_JOB_ID": "77", "FLAG": "True", "EMPTY": ""}
    order = parsed.components.filter("rel_path = 'sql.orch.yaml'").orderBy("ordinal").collect()
    assert [r["name"] for r in order] == ["Build", "Self", "Target Only", "Ghost Reader", "Broken SQL"]


def test_graph_checks(nodes):
    assert graph.dangling_refs(nodes).count() == 0
    assert {r["name"] for r in graph.duplicate_names(nodes).collect()} == {"Dup"}
    edges = graph.edge_list(nodes)
    to_build = {r["src"] for r in edges.filter("dst = 'Job:Sql.Build'").collect()}
    assert to_build == {"Pipeline:Sql", "c", "ext_t", "Job:Ingest.Load Cases"}
    from_load = {r["dst"] for r in edges.filter("src = 'Job:Ingest.Load Cases'").collect()}
    assert from_load == {"Job:Sql.Build"}
