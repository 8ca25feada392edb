import pytest
from helpers import FIXTURES, by_name

from weftgraph.operators import graph
from weftgraph.plans import notebook
from weftgraph.session import stage_table
from weftgraph.sources.artifacts import read_artifacts


@pytest.fixture(scope="module")
def parsed(spark):
    files = read_artifacts(spark, f"{FIXTURES}/notebook", notebook.SUFFIX, notebook.INTEGRATION)
    return notebook.parse(files, stage_table)


@pytest.fixture(scope="module")
def nodes(parsed):
    return notebook.convert(parsed, "https://g/r", "main")


@pytest.fixture(scope="module")
def named(nodes):
    return by_name(nodes)


def test_notebooks(named):
    assert named["Explore My Data"][0] == (
        "Notebook", "Race  analysis", "https://g/r/blob/main/explore_my_data.ipynb", [], None,
    )
    assert named["Py Cells"][0][1] == (
        "Snowflake Notebook with 4 code cell(s), 1 querying dbt model output."
    )
    assert named["No Lang"][0][1] == "Snowflake Notebook with 1 code cell(s)."
    # Unreadable JSON keeps its bare stem and has no cells.
    assert named["bad_one"][0][1] == "Snowflake Notebook with 0 code cell(s)."
    assert "Listed" not in named and "Null Source" not in named


def test_sql_cells(named):
    cell = named["Explore My Data.Load"][0]
    assert cell[0] == "Cell" and cell[3] == ["base", "dim", "nested_t"]
    assert cell[1] == "SQL cell: **Load**. Queries tables: `base`, `dim`, `nested_t`."
    assert cell[4] == ["Notebook:Explore My Data"]
    again = named["Explore My Data.Load (2)"][0]
    assert again[1] == "SQL cell: **Load (2)**. Queries tables: `a1`, `a2`, `a3` and 1 more."


def test_python_cells(named):
    assert named["Py Cells.Both"][0][3] == ["f_t", "plain_t"]
    assert named["Py Cells.Cell 2 (python)"][0][1] == "PYTHON cell: **Cell 2 (python)**. `x = 1…`"
    assert named["Py Cells.Bad"][0][3] == []
    assert named["Py Cells.Cell 4 (python)"][0][1] == "PYTHON cell: **Cell 4 (python)**."
    assert named["No Lang.Cell 1 (python)"][0][3] == []


def test_titles(named, nodes):
    names = {n.split(".", 1)[1] for n in named if n.startswith("Titles.")}
    assert names == {"A", "A (2)", "Cell 3 (python)", "Cell 4 (python)", "A (3)"}
    assert len(named["Titles.A (2)"]) == 2
    assert [r["name"] for r in graph.duplicate_names(nodes).collect()] == ["Titles.A (2)"]


def test_failures(parsed):
    found = {r["rel_path"]: r["error"] for r in parsed.failures.collect()}
    assert found == {
        "bad_one.ipynb": "invalid JSON",
        "listed.ipynb": "not an object",
        "null_source.ipynb": "null where a value must be",
    }
