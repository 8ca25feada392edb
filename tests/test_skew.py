"""Hot keys: with limits so low that everything is split, results are those of the plain operators."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from weftgraph.operators import graph, usage
from weftgraph.plans import skew


@pytest.fixture
def tight(spark):
    spark.conf.set(skew.ROWS_PER_SPLIT, "20")
    yield
    spark.conf.unset(skew.ROWS_PER_SPLIT)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def sides(spark):
    """A third of the accesses of both sides touch one table."""
    n = spark.range(900)
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot"))
    w = n.select(
        F.concat(F.lit("j"), F.col("id") % 400).alias("job"),
        F.coalesce(hot, F.concat(F.lit("t"), F.col("id") % 70)).alias("table_name"),
    ).distinct()
    r = n.select(
        F.concat(F.lit("j"), (F.col("id") * 7) % 500).alias("job"),
        F.coalesce(hot, F.concat(F.lit("t"), F.col("id") % 90)).alias("table_name"),
    ).distinct()
    return w.persist(), r.persist()


def pieces(hot):
    return {r["_key"]: r["_pieces"] for r in hot.table.collect()} if hot else {}


def test_find_hot(spark, sides, tight):
    w, r = sides
    hot = skew.find_hot(w, graph.TABLE)
    counted = {
        k: n
        for k, n in w.groupBy(F.xxhash64("table_name")).count().collect()
        if n > 20
    }
    assert pieces(hot) == {k: -(-n // 20) for k, n in counted.items()} and hot
    assert not skew.find_hot(w, graph.TABLE, 10_000)
    assert pieces(skew.hot_of(w.groupBy("table_name").agg(F.count("*").alias("n")), graph.TABLE)) == pieces(hot)


def test_small_share(spark):
    """A key above the limit is split however small its share of all rows."""
    df = spark.range(200_000).select(F.col("id").alias("k"), "id").unionByName(
        spark.range(60).select(F.lit(-1).cast("long").alias("k"), "id")
    )
    hot = skew.find_hot(df, ["k"], 10)
    assert list(pieces(hot).values()) == [6]
    spark.conf.set(skew.ROWS_PER_SPLIT, "10")
    try:
        numbered = skew.number_rows(df, ["k"], ["id"], "n").filter("k = -1")
        assert sorted(r["n"] for r in numbered.collect()) == list(range(1, 61))
    finally:
        spark.conf.unset(skew.ROWS_PER_SPLIT)


def test_edges(spark, sides, tight):
    w, r = sides
    split = rows(graph.job_edges(graph.accesses(w, r)))
    w.createOrReplaceTempView("w")
    r.createOrReplaceTempView("r")
    want = spark.sql("""
      select 'job', w.job, 'job', r.job, table_name from w join r using (table_name) where w.job <> r.job
      union all select 'job', job, 'table', table_name, table_name from w where not exists
        (select 1 from r where r.table_name = w.table_name and r.job <> w.job)
      union all select 'table', table_name, 'job', job, table_name from r
        where table_name not in (select table_name from w)""")
    assert split == rows(want)
    # Each write is handed over or external, never both; each read has a producer or is external.
    tagged = graph.tag_accesses(graph.accesses(w, r))
    handed = graph.handoffs(tagged).select(F.col("producer").alias("job"), "table_name").distinct()
    external = graph.kept_writes(tagged)
    assert handed.count() + external.count() == w.count()
    assert handed.join(external, ["job", "table_name"], "left_semi").isEmpty()


def test_crowded_table(spark, tight):
    """All pairs of a table with 300 writers and 300 readers, in cells of a grid; hubs on request only."""
    job = F.concat(F.lit("j"), "id")
    w = spark.range(300).select(job.alias("job"), F.lit("t").alias("table_name"))
    r = spark.range(200, 500).select(job.alias("job"), F.lit("t").alias("table_name"))
    edges = graph.job_edges(graph.accesses(w, r))
    assert edges.count() == edges.distinct().count() == 300 * 300 - 100
    assert edges.filter("src_kind <> 'job' or dst_kind <> 'job' or src = dst").isEmpty()
    hubs = graph.job_edges(graph.accesses(w, r), hubs=True)
    assert hubs.groupBy("src_kind").count().orderBy("src_kind").collect() == [("job", 300), ("table", 300)]


def test_index_rows(spark, sides, tight):
    w, _ = sides
    at = Window.partitionBy("table_name").orderBy("job")
    want = w.select("table_name", "job", F.row_number().over(at).cast("long").alias("position"))
    assert rows(graph.table_index(w).select("table_name", "job", "position")) == rows(want)


def test_summary_rows(spark, tight):
    log = spark.range(600).select(
        F.array(F.lit("hot"), F.concat(F.lit("t"), F.col("id") % 5)).alias("tables_used"),
        F.when(F.col("id") % 2 == 0, "table").otherwise("metric").alias("chart_type"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("c"), F.col("id") % 200)).alias("chart_name"),
    )
    hot = usage.usage_summary(log).filter("table_name = 'hot'").collect()
    assert {(r["usage_count"], *r["used_in_chart_types"]) for r in hot} == {(600, "metric", "table")}
    names = [r["chart_name"] for r in hot]
    assert len(names) == len(set(names)) and set(names) == {None} | {f"c{i % 200}" for i in range(600) if i % 7}


@pytest.fixture(scope="module")
def lines(spark):
    """One file holds most lines; values are sparse and nulls sit on both sides of block borders."""
    return spark.range(500).select(
        F.when(F.col("id") % 3 < 2, "big").otherwise(F.concat(F.lit("f"), F.col("id") % 9)).alias("f"),
        F.col("id").alias("o"),
        F.when(F.xxhash64("id") % 11 == 0, F.col("id")).alias("v"),
    )


@pytest.mark.parametrize("limit", ["20", "1000000"])
def test_block_windows(spark, lines, tight, limit):
    spark.conf.set(skew.ROWS_PER_SPLIT, limit)
    w = Window.partitionBy("f").orderBy("o")
    want = lines.withColumn("n", F.row_number().over(w).cast("long"))
    got = skew.number_rows(lines, ["f"], ["o"], "n")
    assert rows(got.select("f", "o", "n")) == rows(want.select("f", "o", "n"))

    numbered = want.withColumn("i", F.col("n") - 1).persist()
    at = Window.partitionBy("f").orderBy("i")
    last = F.last("v", True).over(at.rowsBetween(Window.unboundedPreceding, 0))
    got = skew.carry_last(numbered, ["f"], "i", F.col("v"), "x")
    assert rows(got.select("f", "i", "x")) == rows(numbered.select("f", "i", last))

    for reach in (1, 2, 9, 20):
        following = F.first("v", True).over(at.rowsBetween(0, reach - 1))
        got = skew.next_within(numbered, ["f"], "i", F.col("v"), reach, "x")
        assert rows(got.select("f", "i", "x")) == rows(numbered.select("f", "i", following))
        before = F.last("v", True).over(at.rowsBetween(-(reach - 1), 0))
        got = skew.last_within(numbered, ["f"], "i", F.col("v"), reach, "x")
        assert rows(got.select("f", "i", "x")) == rows(numbered.select("f", "i", before))


def test_stitch(spark, sides, tight):
    w, r = sides
    edges = w.select(
        F.lit("A").alias("integration"), F.col("job").alias("node"), "table_name", F.lit("W").alias("mode")
    ).unionByName(
        r.select(
            F.when(F.col("table_name").isin("hot", "t1"), "B").otherwise("A").alias("integration"),
            F.col("job").alias("node"), "table_name", F.lit("R").alias("mode"),
        )
    )
    met = graph.stitch(edges)
    assert {r["table_name"] for r in met.select("table_name").distinct().collect()} == {"hot", "t1"}
    assert met.count() == edges.filter("table_name in ('hot', 't1')").count()
