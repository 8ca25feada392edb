"""Shapes of plans, and rules the library keeps."""

import pathlib
import re

from pyspark.sql import functions as F

from weftgraph.operators import graph
from weftgraph.plans import dashboard, notebook, orchestration, skew
from weftgraph.queries import QUERIES
from weftgraph.queries import lineage as lake
from weftgraph.sources.artifacts import read_artifacts
from helpers import FIXTURES

SF = "/root/testdata/sf0.001"
ROOT = pathlib.Path(__file__).parent.parent / "weftgraph"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_run_before_python(spark):
    """Discovery and allow-list sit below the Python stage, which runs once."""
    files = read_artifacts(spark, f"{FIXTURES}/dashboard", "*.py", "Streamlit")
    text = plan(dashboard.extract(dashboard.discover(files)))
    assert text.count("ArrowEvalPython") == 1
    above, below = text.split("ArrowEvalPython")
    assert "Filter" not in above and re.search(r"Filter .*Contains\(value.*import streamlit", below)
    yaml = read_artifacts(spark, f"{FIXTURES}/orchestration", "*.orch.yaml", "M")
    parsed = orchestration.parse(yaml.filter("rel_path = 'main.orch.yaml'"))
    text = plan(parsed.components)
    assert text.count("ArrowEvalPython") == 1
    assert "main.orch.yaml" in text.split("ArrowEvalPython")[1]


def test_text_is_not_shuffled(spark):
    """File contents never cross an exchange."""
    files = read_artifacts(spark, f"{FIXTURES}/notebook", "*.ipynb", "N")
    parsed = notebook.parse(files)
    for df in (parsed.cells, orchestration.parse(files).components):
        for line in plan(df).splitlines():
            if "Exchange" in line:
                assert "content" not in line and "source#" not in line


def test_narrow_stages(spark):
    """Parsing, SQL extraction and component rules need no shuffle."""
    for name in ("sql_read_refs", "sql_script_io", "py_literals", "orch_roles", "nested_transitions"):
        text = plan(QUERIES[name](spark, SF))
        # The one exchange spreads a one-split test table over the cores.
        assert len(re.findall(r"Exchange (?:hash|range)partitioning", text)) == 0, name


def test_pushdown(spark):
    text = plan(lake.access(spark, SF))
    scan = next(x for x in text.splitlines() if "lineitem.parquet" in x)
    assert "IsNotNull(l_suppkey)" in scan
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_linenumber:int,l_returnflag:string>" in scan


def test_accesses_are_shuffled_once(spark):
    """Where no side is small enough to be sent around, writes and reads each cross one exchange."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    access = lake.staged_access(spark, SF)
    spark.conf.set(key, "-1")
    try:
        edges = graph.job_edges(access)
        edges.collect()
        text = plan(edges).split("== Initial Plan ==")[0]
    finally:
        spark.conf.set(key, before)
    assert text.count("ReusedExchange [job") == 2
    assert len(re.findall(r"FileScan parquet \[job", text)) == 2


def test_no_cross_joins(spark):
    for df in (graph.job_edges(lake.access(spark, SF)), *(QUERIES[n](spark, SF) for n in ("chart_infer", "join_tab_range", "conv_nodes"))):
        text = plan(df)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_hot_side_is_spread(spark):
    """A heavy key adds the piece to the join keys."""
    left = spark.range(100).select(F.lit("k").alias("k"), "id")
    right = spark.createDataFrame([("k", 1)], "k string, v int")
    hot = skew.find_hot(left, ["k"], 10)
    joined = skew.salted_join(left, right, ["k"], "inner", hot, ["id"])
    assert "_piece" in plan(joined) and joined.count() == 100
    spread = left.select(F.pmod(F.xxhash64("id"), F.lit(10)).alias("p")).distinct().count()
    assert spread == 10


def test_library_rules():
    """No driver-side data, no local checkpoints, no explicit RDDs; broadcasts are of literal rows."""
    for path in ROOT.rglob("*.py"):
        if "llm" in path.relative_to(ROOT).parts:
            continue
        text = path.read_text(encoding="utf-8")
        assert "toPandas" not in text and "localCheckpoint" not in text and "crossJoin" not in text
        assert not re.search(r"F\.udf\(|@udf|mapPartitions|sparkContext\.parallelize", text), path
        assert ".collect()" not in text, path


def test_heavy_rows_are_dealt_by_their_number(spark, monkeypatch):
    """SQL text is searched in tasks of a bounded number of rows, however few bytes the keys are."""
    from weftgraph import session
    from weftgraph.queries import sqltext

    rows = sqltext.table(spark, SF, "orders").count()
    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)
    for name in ("sql_script_io", "sql_read_refs", "sql_qualified_refs"):
        df = QUERIES[name](spark, SF)
        sizes = [n for n in df.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect() if n]
        assert len(sizes) >= rows // 100 and max(sizes) < 200, name


def test_lists_of_a_node_come_from_sorted_rows(spark):
    """Rows are in order before they are collected; lists are those of a plain sort, repeats and ties kept."""
    names = [f"t{i % 7}" for i in range(40)]
    deps = spark.createDataFrame(
        [(f"n{i % 3}" if i % 3 < 2 else None, ("up", "down")[i % 5 == 0], i % 4, t) for i, t in enumerate(names)],
        "k string, direction string, slot int, t string",
    ).select("k", "direction", F.struct("slot").alias("rank"), graph.table_ref(F.col("t")).alias("dep"))
    heads = spark.createDataFrame(
        [(k, "I", k or "none", "Job", "d", "u", True) for k in ("n0", "n1", None, "bare")],
        "k string, integration string, name string, node_type string, description string, url string, "
        "has_downstream boolean",
    )
    nodes = graph.assemble_nodes(heads, deps, ["k"])
    assert re.search(r"collect_list.*\n(?:.*\n)*?.*Sort \[k#\d+ ASC", plan(nodes))
    rows = deps.select("k", "direction", "rank.slot", "dep.table_name").collect()
    for n in nodes.collect():
        for direction, side in (("up", "upstream"), ("down", "downstream")):
            want = sorted((r.slot, r.table_name) for r in rows if r.k == n.name and r.direction == direction)
            assert [d.table_name for d in n.lineage[f"{side}_dependencies"]] == [t for _, t in want]
