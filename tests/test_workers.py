"""Python workers that cannot import the package still run its stages."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import functions as F
from weftgraph.functions.pyliterals import python_literals
from weftgraph.functions.yamldoc import yaml_documents
from weftgraph.plans.registry import parse_rows
from weftgraph.session import local_session
spark = local_session(2)
df = spark.createDataFrame([("p", "a = 'text'")], "rel_path string, content string")
row = df.select(python_literals(F.col("content")).alias("x"), yaml_documents(F.lit("pipeline: {{}}")).alias("y")).first()
assert row.x["items"][0].text == "text" and row.y.error is None, row
parse = parse_rows(lambda path, text: [{{"n": text}}], "n string", "I")
assert parse(df, lambda d, n: d).rows.first().n == "a = 'text'"
print("fine")
"""


def test_without_the_package_on_workers(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120
    )
    assert done.stdout.strip().endswith("fine"), done.stderr[-2000:]


def test_statements_without_quotes_are_not_looked_into(monkeypatch):
    """What is found stays the same, whatever ends the lines and wherever a string stands."""
    import ast

    from weftgraph.functions import pyliterals

    looked = []
    children = pyliterals._children
    monkeypatch.setattr(pyliterals, "_children", lambda node: looked.append(node) or children(node))
    assert list(pyliterals.literals("x = 'a'\n" + "y = 1\n" * 500 + "z = f(b, 'c')\n")) == [(1, "a"), (502, "c")]
    assert len(looked) < 10
    sources = [
        "x = 1\r'a'\ry = 'b'\r\nz = '''q\r\n w'''\n",
        "@d('x')\ndef f():\n  'doc'\n  @e(\n 'y')\n  class A: pass\n",
        "a = (1,\n2,\n'''x\n y'''\n)\nif a:\n  pass\nelse:\n  b = f'{a!r}' 'c'\n",
        "match x:\n  case 'a': pass\n  case 1: y = 2\n",
        "\x0cx = '\u2028a'\ny = 1\nz = '\x85'\n",
        "try:\n  pass\nexcept E:\n  t = 1; u = '2'\n",
    ]
    for source in sources:
        found = sorted(pyliterals.literals(source))
        monkeypatch.setattr(pyliterals, "_quotes_before", lambda text: range(len(text) + 2))
        assert found == sorted(pyliterals.literals(source)) and found
        monkeypatch.undo()
    assert ast.parse(sources[0]).body[1].lineno == 2


def test_plain_statements_are_not_parsed(monkeypatch):
    """Runs of them are one node each; where a line only looks like one, the whole source is parsed."""
    import ast
    import itertools

    from weftgraph.functions import pyliterals

    parse, sizes = ast.parse, []

    def parsed(source, *rest):
        tree = parse(source, *rest)
        sizes.append(sum(1 for _ in ast.walk(tree)))
        return tree

    monkeypatch.setattr(ast, "parse", parsed)
    plain = "import a.b as c\nx = f('p', k=[1, \"q\"])  # it's\ny = \"\"\"r\n 's'\n\"\"\"\ny.z = None\n"
    source = plain * 100 + "if x:\n" + "    x = 't'\n" * 100 + "else:\n    x = 'u' 'v'\n"
    one = [(2, "p"), (2, "q"), (3, "r\n 's'\n")]
    expected = [(line + 6 * i, text) for i in range(100) for line, text in one]
    expected += [(602 + i, "t") for i in range(100)] + [(703, "uv")]
    assert list(pyliterals.literals(source)) == expected
    assert sizes and max(sizes) < 20

    def by_tree(text):
        try:
            nodes = [n for n in ast.walk(parse(text)) if isinstance(n, ast.Constant) and isinstance(n.value, str)]
            return True, sorted((n.lineno, n.value) for n in nodes)
        except Exception as exc:  # noqa: BLE001
            return False, f"{type(exc).__name__}: {exc}"

    run = "a = 'b'\nc = \"\"\"d\"\"\"\n"
    before = ["", "x = '''\n", 'x = """\n', "f(\n", "x = 1 + \\\n", "if x:\n", "if x: \\\n", "@d\n", "try:\n", "\ufeff"]
    before += ["y = [\r", "if = 1\n", "x = 01\n", "f(k=1, 2)\n", "x = '\\x41'\n", "x = 'a''b'\n", "u.if = ''\n"]
    before += ["from . import f\n", "x = '\x00'\n", "from __future__ import barry_as_FLUFL\nx <> y\n"]
    after = ["", "'''\n", '"""\n', ")\n", "  y = 1\n", "else:\n  z\n", "]\r\n", "x = 'y"]
    valid = 0
    for head, indent, tail in itertools.product(before, ("", "  "), after):
        text = head + indent + run.replace("\nc", "\n" + indent + "c") + tail
        ok, error, items = pyliterals._extract(text)
        assert (ok, sorted(items) if ok else error) == by_tree(text), text
        valid += ok
    assert valid >= 10


def test_yaml_is_what_the_loader_makes_of_it():
    """Values and errors of plain and of unusual documents, aliases shared and not expanded."""
    import json

    import yaml

    from weftgraph.functions import yamldoc

    def told(load, text):
        try:
            return json.dumps(load(text), default=str)
        except Exception as exc:  # noqa: BLE001
            return f"{type(exc).__name__}: {exc}"

    texts = ["", None, "a: 1\nb: 0x1f\nc: 2020-01-01\nd: yes\ne: ~\nf: 'yes'\ng: [1.5, x, {y: z}]", "{a: 1, a: 2, 1: x, true: y, null: z}"]
    texts += ["x: &a {b: 1}\ny: {<<: *a, c: 2}\nz: *a", "&a [*a]", "&a {x: *a}", "? [a, b]\n: c", "? {a: 1}\n: c", "=: 5\na: ="]
    texts += ["a: !!set {x, y}", "a: !!str 5\nb: !!int '7'", "a: !!int x", "a: !foo b", "a: [", "a: 1\n---\nb: 2", "a: !!str [x]"]
    texts += ["a: !!map [x]", "a: !!omap [x: 1]", "a: !!binary aGk=", "a: 2020-13-45", "\x00", "a: 1:30", "- 1\n- 2"]
    for text in texts:
        assert told(yamldoc.load, text) == told(lambda t: yaml.load(t, Loader=yaml.CSafeLoader), text), text
    names = "abcdefghijklmnopqrstuvwxyz"
    nested = "a: &a [1, 2]\n" + "".join(f"{y}: &{y} [*{x}, *{x}, *{x}]\n" for x, y in zip(names, names[1:]))
    made = yamldoc.load(nested)
    assert made["z"][0] is made["z"][2] is made["y"]
