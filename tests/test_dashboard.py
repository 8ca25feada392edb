import pytest
from helpers import FIXTURES, by_name

from weftgraph.plans import dashboard
from weftgraph.session import stage_table
from weftgraph.sources.artifacts import containing, read_artifacts

ROOT = f"{FIXTURES}/dashboard"


@pytest.fixture(scope="module")
def files(spark):
    return read_artifacts(spark, ROOT, dashboard.SUFFIX, "Streamlit")


@pytest.fixture(scope="module")
def parsed(files):
    return dashboard.parse(dashboard.discover(files), stage_table)


@pytest.fixture(scope="module")
def usage(parsed):
    rows = {}
    for r in parsed.usage.orderBy("file_path", "id").collect():
        rows.setdefault(r["file_path"].split("/")[-1], []).append(r)
    return rows


@pytest.fixture(scope="module")
def named(parsed):
    return by_name(dashboard.convert(parsed, "https://g/r", "main"))


def test_discovery(files):
    found = [r["rel_path"] for r in containing(files, dashboard.MARK).select("rel_path").collect()]
    assert found == sorted(found) and "plain.py" not in found and "app1/app.py" in found
    assert len(found) == 11


def test_app(usage, named):
    first, second, bare, third = usage["app.py"]
    # The f-string of the call, the plain string, and the call's raw text found by pattern.
    assert first["line_number"] == 10 and "{x}.{x}.INT_RACE" in first["sql_query"]
    assert first["tables_used"] == ["dims.Drivers", "placeholder.placeholder.INT_RACE"]
    assert second["tables_used"] == ["t1", "t2", "t3"] and second["line_number"] == 21
    assert third["line_number"] == 10 and "{db}.{schema}.INT_RACE" in third["sql_query"]
    # The search for rendering starts after the query's first line: to_pandas() comes before bar_chart.
    assert first["chart_type"] == "pandas_dataframe" and first["chart_name"] == "Winners"
    assert first["chart_caption"] == "Per driver"
    assert second["chart_type"] == "table" and second["chart_name"] == "Tables"
    assert [r["id"] for r in usage["app.py"]] == [1, 2, 3, 4]
    assert bare["tables_used"] == []  # a query, but of no table: no chart

    app = [n for n in named["app1"]]
    assert app[0][1] == "Race Results - Results by season."
    assert app[0][3:] == ([], None) and app[0][2] == "https://g/r/blob/main/app1/app.py"
    chart = named["app1.Winners (Line 10)"]
    assert len(chart) == 2  # equal names, told apart by nothing: the upsert keeps one
    assert chart[0][1] == "Winners (Line 10) - Per driver"
    assert chart[0][3:] == (["drivers", "int_race"], ["App:app1"])
    assert named["app1.Tables (Line 21)"][0][1] == "table chart (line 21) using t1, t2 and 1 more"
    assert named["app1.Tables (Line 21)"][0][2].endswith("app1/app.py#L21")


def test_tabs(usage):
    assert usage["tab_29.py"][0]["chart_name"] == "One"
    assert usage["tab_30.py"][0]["chart_name"] is None
    assert usage["tab_top.py"][0]["chart_name"] is None
    assert {usage[f][0]["chart_type"] for f in ("tab_29.py", "tab_30.py")} == {"dataframe"}


def test_reach(usage):
    assert usage["far_49.py"][0]["chart_type"] == "metric"
    assert usage["far_50.py"][0]["chart_type"] == "unknown"
    assert usage["one_liner.py"][0]["chart_type"] == "unknown"
    last = usage["last_line.py"][0]
    assert (last["chart_type"], last["chart_name"], last["chart_caption"]) == ("unknown", None, None)


def test_prose_and_quotes(usage, named):
    assert [r["sql_query"] for r in usage["prose.py"]] == ["SELECT a FROM t a WHERE a.is_x"]
    full, cut = usage["quotes.py"]
    assert full["tables_used"] == ["q_table"] and full["chart_type"] == "line_chart"
    # The pattern's text ends at the quote and is no statement: a query without tables, so no chart.
    assert cut["sql_query"] == "SELECT x FROM q_table WHERE x =" and cut["tables_used"] == []


def test_broken(parsed, usage, named):
    failed = parsed.failures.collect()
    assert [f["rel_path"] for f in failed] == ["app2/broken.py"] and "SyntaxError" in failed[0]["error"]
    assert "broken.py" not in usage
    assert ("App", "Broken") in {(n[0], n[1]) for n in named["app2"]}


def test_untitled_and_single(parsed, named):
    texts = {n[2].split("/")[-1]: n[1] for n in named["app2"]}
    assert texts["far_49.py"] == "Streamlit application with 1 SQL queries using tables: far_table"
    one = dashboard.Parsed(
        parsed.apps.filter("rel_path = 'app2/far_49.py'"),
        parsed.usage.filter("file_path = 'app2/far_49.py'"),
        parsed.failures,
    )
    single = by_name(dashboard.convert(one, None, "local", "My App"))
    assert set(single) == {"My App", "My App.metric (Line 2)"}
    assert single["My App"][0][2] == "app2/far_49.py"


def test_metadata(parsed):
    rows = {r["rel_path"]: r for r in dashboard.app_metadata(parsed.apps).collect()}
    assert set(rows) == {"app1/app.py", "app2/broken.py"}
    assert rows["app1/app.py"]["app_description"] == "Results by season."


def test_files_are_shuffled_once(spark):
    """As one row each, before lines and queries are taken out of them; files of one path count as one."""
    first = 'import streamlit\nst.header("H")\nq = "SELECT a FROM t1 WHERE b"\nst.table(q)\nst.caption("C")\n'
    other = 'import streamlit\nq = "SELECT a FROM t1 WHERE b"\n\nr = "SELECT a FROM t2 WHERE b"\n'
    files = [("a.py", first), ("a.py", first), ("a.py", other), ("b.py", first), ("c.py", other), ("c.py", "x = ="), ("d.py", None)]
    parsed = dashboard.parse(spark.createDataFrame(files, "rel_path string, content string"))
    plan = parsed.usage._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Aggregate" not in plan
    found = [(r.file_path, r.id, r.line_number, r.chart_type, r.chart_name, r.chart_caption, r.tables_used) for r in parsed.usage.collect()]
    a, b, c = ([r[1:] for r in sorted(found) if r[0] == f"{x}.py"] for x in "abc")
    assert [r[0] for r in a] == [1, 2] and sorted(r[-1] for r in a) == [["t1"], ["t2"]]
    assert a[0][2:5] == ("table", "H", "C") and a[1][2:5] == ("unknown", "H", "C")
    assert b == [(1, 3, "table", "H", "C", ["t1"])]
    assert c == [(1, 2, "unknown", None, None, ["t1"]), (2, 4, "unknown", None, None, ["t2"])]
    assert len(found) == 5
