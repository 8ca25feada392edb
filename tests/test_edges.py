"""The maintained job graph against the graph made from all accesses, batch by batch."""

import random
import re

import pytest
from pyspark.sql import functions as F

from weftgraph.operators import graph
from weftgraph.session import fresh_path
from weftgraph.streaming import edges, ingest
from weftgraph.streaming.log import read_log


def rows_of(df):
    columns = sorted(df.columns)
    return sorted(map(repr, df.select(*columns).collect()))


def changes(spark, rows):
    return spark.createDataFrame(rows, edges.CHANGES)


def expected(spark, batches):
    """What is there after all batches, kept in a plain set."""
    there = set()
    for rows in batches:
        whole = [r for r in rows if None not in r[:3]]
        there -= {r[:3] for r in whole if not r[3]}
        there |= {r[:3] for r in whole if r[3]}
    return graph.job_edges(spark.createDataFrame(sorted(there), "job string, table_name string, mode string"))


@pytest.mark.parametrize("sent", [edges.MOST_SENT, 0])
def test_batches_come_and_go(spark, monkeypatch, sent):
    """Random changes, a folded log in between, a repeated batch, and both ways to find touched tables."""
    monkeypatch.setattr(edges, "MOST_SENT", sent)
    if not sent:
        spark.conf.set("spark.weftgraph.rowsPerSplit", "8")
    try:
        rnd, root, batches = random.Random(3), fresh_path(spark, "edges"), []
        for nr in range(4):
            rows = [
                (f"j{rnd.randrange(6)}", f"t{rnd.randrange(9) // 3}", rnd.choice("RW"), rnd.random() < 0.7) for _ in range(25)
            ]
            rows += [(None, "t0", "R", True), ("j0", None, "W", True), ("j0", "t0", None, True)]
            batches.append(rows)
            edges.renew(changes(spark, rows), root, nr)
            if nr == 2:
                edges.renew(changes(spark, rows), root, nr)
                edges.fold_edges(spark, root)
            assert rows_of(edges.current_edges(spark, root)) == rows_of(expected(spark, batches)), nr
    finally:
        spark.conf.unset("spark.weftgraph.rowsPerSplit")


def test_only_touched_tables_are_renewed(spark):
    root = fresh_path(spark, "edges")
    edges.renew(changes(spark, [("a", "t", "W", True), ("b", "t", "R", True), ("a", "u", "W", True)]), root, 0)
    edges.renew(changes(spark, [("c", "u", "R", True)]), root, 1)
    made = read_log(spark, f"{root}/edges", edges.EDGES).where("batch = 1").collect()
    assert [(r.src, r.dst, r.table_name) for r in made] == [("a", "c", "u")]
    # A table that loses all accesses loses its edges, and an empty batch changes nothing.
    edges.renew(changes(spark, [("a", "t", "W", False), ("b", "t", "R", False)]), root, 2)
    edges.renew(changes(spark, []), root, 3)
    assert [r.table_name for r in edges.current_edges(spark, root).collect()] == ["u"]
    edges.fold_edges(spark, root)
    assert [r.table_name for r in edges.current_edges(spark, root).collect()] == ["u"]


def test_batch_on_most_tables_renews_all(spark, monkeypatch):
    """No join finds touched tables or the edges that count, rows are shuffled once, and removed accesses are gone."""
    joins = []
    monkeypatch.setattr(edges.skew, "salted_join", lambda *a: joins.append(a))
    root, there = fresh_path(spark, "edges"), []
    for nr, present in enumerate((True, True, False)):
        rows = [(f"j{(i * 7 + nr) % 5}", f"t{i % 4}", "RW"[(i + nr) % 2], present or i % 3 == 0) for i in range(30)]
        there.append(sorted(rows))
        edges.renew(changes(spark, rows + rows), root, nr)
        if nr == 1:
            edges.fold_edges(spark, root)
    touched = read_log(spark, f"{root}/tables", edges.TABLES).collect()
    assert {r.table_name for r in touched} == {None}
    found = edges.current_edges(spark, root)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    last = {}
    for nr, rows in enumerate(there):
        for job, table, mode, present in rows:
            last[job, table, mode] = max(last.get((job, table, mode), (0, False)), (nr, present))
    want = [key for key, (_, present) in last.items() if present]
    assert joins == []
    monkeypatch.undo()
    assert rows_of(found) == rows_of(graph.job_edges(spark.createDataFrame(want, "job string, table_name string, mode string")))


def test_touched_tables_after_a_whole_batch(spark):
    """A batch on few tables after one on most: both kinds of edges count, folded or not."""
    root = fresh_path(spark, "edges")
    first = [(f"j{i}", f"t{i % 8}", m, True) for i in range(24) for m in "RW"]
    later = [("j0", "t0", "W", False), ("new", "t0", "R", True)]
    edges.renew(changes(spark, first), root, 0)
    edges.renew(changes(spark, later), root, 1)
    want = rows_of(expected(spark, [first, later]))
    assert rows_of(edges.current_edges(spark, root)) == want
    edges.fold_edges(spark, root)
    assert rows_of(edges.current_edges(spark, root)) == want


def test_profiled_accesses_are_not_shuffled_again(spark):
    rows = [(f"j{i % 7}", f"t{i % 5}", "RW"[i % 2]) for i in range(60)]
    access = spark.createDataFrame(rows, "job string, table_name string, mode string").distinct()
    kept = graph.profile_placed(access.repartition(3, "table_name")).persist()
    made = graph.edges_of(graph.tag_profiled(kept))
    text = made._jdf.queryExecution().optimizedPlan().toString()
    assert rows_of(made) == rows_of(graph.job_edges(access))
    above = made._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
    assert "Exchange" not in above and "InMemoryRelation" in text
    kept.unpersist()


def test_untouched_tables_are_not_shuffled(spark):
    root = fresh_path(spark, "edges")
    edges.renew(changes(spark, [("a", "t", "W", True), ("b", "u", "R", True)]), root, 0)
    log = read_log(spark, f"{root}/accesses", edges.CHANGES)
    found = edges.of_tables(log, log.where("job = 'a'").select("table_name"))
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "LeftSemi" in text
    assert not re.search(r"(?<!Broadcast)Exchange (?:hash|range)partitioning", text)
    assert [r.table_name for r in found.collect()] == ["t"]


def test_nothing_yet(spark):
    assert edges.current_edges(spark, fresh_path(spark, "edges")).count() == 0


def test_replays_and_late_records(spark, tmp_path):
    """Within the delay: late records stay, replays go, over restarts. Beyond it: all goes."""
    root, state, source = fresh_path(spark, "replays"), str(tmp_path / "state"), str(tmp_path / "in")
    schema = "key string, at timestamp"

    def arrive(*rows):
        frame = spark.createDataFrame(rows, "key string, at string").withColumn("at", F.to_timestamp("at"))
        frame.coalesce(1).write.mode("append").parquet(source)
        ingest.ingest_distinct(ingest.stream_table(spark, source, "*.parquet", schema), "at", ["key"], "1 hour", root, state)

    arrive(("a", "2024-01-01 10:00:00"), ("a", "2024-01-01 10:00:00"), ("b", "2024-01-01 10:30:00"))
    arrive(("a", "2024-01-01 10:00:00"), ("late", "2024-01-01 09:45:00"), ("c", "2024-01-01 14:00:00"))
    arrive(("late", "2024-01-01 09:45:00"), ("a", "2024-01-01 10:00:00"), ("gone", "2024-01-01 12:00:00"), ("d", "2024-01-01 13:30:00"))
    assert sorted(r.key for r in read_log(spark, root, schema).collect()) == ["a", "b", "c", "d", "late"]
