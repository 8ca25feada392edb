"""Every registered query against its SQL, at the smallest scale."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check import compare, connect  # noqa: E402

from weftgraph.queries import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert name in ORACLES
    assert compare(spark, con, name, QUERIES[name], ORACLES[name], SF) is None


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["src_kind", "src", "dst_kind", "dst", "table_name"]


def test_every_page_is_a_child(spark):
    nodes = QUERIES["tmpl_parent_child_whole"](spark, SF)
    pages = spark.read.parquet(f"{SF}/pages.parquet").count()
    parents = {r.name for r in nodes.filter("node_type = 'ParentNode'").collect()}
    assert nodes.filter("node_type = 'ChildNode'").count() == pages
    assert {p for p in parents if p.startswith("empty.")} == {f"empty.{p}" for p in parents if not p.startswith("empty.")}
