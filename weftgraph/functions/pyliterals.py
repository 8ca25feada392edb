"""String literals of Python source text, read with the language's own syntax tree."""

from __future__ import annotations

import ast
import gc
import keyword
import re
import sys
from collections.abc import Iterator
from itertools import accumulate, repeat

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

LITERALS = "struct<ok:boolean, error:string, items:array<struct<line:int, text:string>>>"


def _literal(node: ast.AST) -> str | None:
    """Text of a string node; the holes of an f-string read ``{x}``."""
    if isinstance(node, ast.JoinedStr):
        return "".join(
            str(v.value) if isinstance(v, ast.Constant) else "{x}" for v in node.values
        )
    if isinstance(node, ast.Constant) and isinstance(node.value, str):
        return node.value
    return None


# Plain statements, each on lines of its own: imports, and values or calls of names, numbers, strings without prefix
# or backslash and lists of these, assigned to a name or not. They are valid wherever ``pass`` is.
_NAME = rf"(?!(?:{'|'.join(keyword.kwlist)})\b)[A-Za-z_][A-Za-z0-9_]*+"
_DOTTED = rf"{_NAME}(?:\.{_NAME}){{0,20}}+"
_NUMBER = r"(?:0|[1-9][0-9]{0,17})(?:\.[0-9]{1,17})?+"
_STRING = (
    r"""(?:\"{3}[^"\\\0]*+\"{3}|"[^"\\\n\0]*+"(?!")"""
    r"""|'{3}[^'\\\0]*+'{3}|'[^'\\\n\0]*+'(?!'))"""
)
_ATOM = rf"(?:{_NUMBER}|{_STRING}|{_DOTTED}|(?:None|True|False)\b)"
_LIST = rf"\[(?:{_ATOM}(?:, *+{_ATOM})*+)?+\]"
_ITEM = rf"(?:{_ATOM}|{_LIST})(?! *+=)"
_KEYWORD = rf"{_NAME} *+= *+{_ITEM}"
_ARGUMENTS = rf"(?:{_ITEM}(?:, *+{_ITEM})*+(?:, *+{_KEYWORD})*+|{_KEYWORD}(?:, *+{_KEYWORD})*+)?+"
_VALUE = rf"(?:{_DOTTED}(?:\({_ARGUMENTS}\))?+|{_ATOM}|{_LIST})"
_IMPORT = rf"import {_DOTTED}(?: as {_NAME})?+|from (?!__future__){_DOTTED} import {_NAME}(?:, *+{_NAME})*+"
_PLAIN = rf"(?:(?:{_DOTTED} *+= *+)?+{_VALUE}|{_IMPORT}) *+(?:#[^\n\0]*+)?+(?=\n)"
# A line that goes on on the next one, or may, does not come before them.
_PLAIN_RUN = re.compile(rf"\n(?<!\\\n)([ \t]*+){_PLAIN}(?:\n\1{_PLAIN})*+")
_PLAIN_STRINGS = re.compile(r"""(\"{3}[^"]*+\"{3}|'{3}[^']*+'{3}|"[^"]*+"|'[^']*+'|#[^\n]*+)""")

# Nodes and fields below which no string can be.
_LEAVES = (ast.Import, ast.ImportFrom, ast.Global, ast.Nonlocal)
# Their lines do not count their decorators.
_DECORATED = (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)
_BARE_FIELDS = frozenset({"ctx", "op", "ops", "kind", "type_comment"})


def _children(node: ast.AST) -> list[ast.AST]:
    found: list[ast.AST] = []
    for name in node._fields:
        if name not in _BARE_FIELDS:
            value = getattr(node, name, None)
            found.extend(value if isinstance(value, list) else (value,))
    return [v for v in found if isinstance(v, ast.AST) and not isinstance(v, _LEAVES)]


def _unified(source: str) -> str:
    """Lines ended as the parser sees them."""
    return source.replace("\r\n", "\n").replace("\r", "\n")


def _quotes_before(source: str) -> list[int]:
    """Per line, counted from 1 as the parser counts them: how many quotes the lines up to it hold."""
    lines = _unified(source).replace("'", '"').split("\n")
    return list(accumulate(map(str.count, lines, repeat('"')), initial=0))


def _plain_strings(run: str, line: int) -> list[tuple[int, str]]:
    """(line, text) of the strings of a run of plain statements, which begins with the end of the line before ``line``."""
    found = []
    pieces = _PLAIN_STRINGS.split(run)
    line -= 1
    for between, token in zip(pieces[::2], pieces[1::2]):
        line += between.count("\n")
        if token[0] != "#":
            width = 3 if len(token) > 5 and token[1] == token[2] == token[0] else 1
            found.append((line, token[width:-width]))
            line += token.count("\n")
    return found


def _thinned(source: str) -> tuple[str, dict[int, list[tuple[int, str]]]]:
    """The source with one ``pass`` for each run of plain statements, and the (line, text) of their strings by the
    line of that ``pass``. Lines stay where they are, and where strings were taken away a quote stays in a comment."""
    text = f"\n{source}"
    strings: dict[int, list[tuple[int, str]]] = {}
    line = at = 0

    def shorten(run: re.Match[str]) -> str:
        nonlocal line, at
        begin, taken = run.start() + 1, run[0]
        line += text.count("\n", at, begin)
        at = begin
        found = _plain_strings(taken, line) if '"' in taken or "'" in taken else []
        if found:
            strings[line] = found
        return f"\n{run[1]}pass{'#\"' if found else ''}" + "\n" * (taken.count("\n") - 1)

    return _PLAIN_RUN.sub(shorten, text)[1:], strings


def _found(source: str, strings: dict[int, list[tuple[int, str]]]) -> Iterator[tuple[int, int, str | None]]:
    """First line, last line and text of strings and other constants, those of plain statements at their ``pass``."""
    todo: list[ast.AST] = [ast.parse(source)]
    quotes = _quotes_before(source)
    while todo:
        node = todo.pop()
        kind = node.__class__
        if isinstance(node, ast.stmt) and not isinstance(node, _DECORATED):
            if quotes[node.end_lineno] == quotes[node.lineno - 1]:
                continue
        if kind is ast.Constant or kind is ast.JoinedStr:
            yield node.lineno, node.end_lineno, _literal(node)
        elif kind is ast.Pass:
            for line, text in strings.get(node.lineno, ()):
                yield line, line, text
        elif kind is not ast.Name:
            todo.extend(_children(node)[::-1])


def _found_thinned(source: str) -> list[tuple[int, int, str | None]] | None:
    """What is found once the source is thinned; null if only the whole source can tell.

    A ``pass`` in brackets is an error, and one in a string stands on the lines of that string. Where there is
    neither, every ``pass`` is a statement, and so were those it stands for.
    """
    thinned, strings = _thinned(source)
    try:
        if thinned.count('"') + thinned.count("'") == len(strings):
            # No string is left in what has to be parsed. Statements follow each other as their lines do.
            if thinned.strip("\n") not in ("pass", 'pass#"'):
                ast.parse(thinned)
            return [(line, line, text) for found in strings.values() for line, text in found]
        found = list(_found(thinned, strings))
    except Exception:  # noqa: BLE001 - the whole source tells which error it is
        return None
    spread = [(first - 1, last) for first, last, _ in found if last > first]
    if spread:
        before, after = source.split("\n"), thinned.split("\n")
        if any(before[first:last] != after[first:last] for first, last in spread):
            return None
    return found


def literals(source: str) -> Iterator[tuple[int, str]]:
    """(line, text) in source order. What is inside an f-string is not looked at on its own.

    Every string has a quote on its first line, so nodes on lines without one are not looked into, and plain
    statements are read by a pattern: of most of a program's lines no tree is built.
    """
    found = _found_thinned(_unified(source))
    for line, _, text in _found(source, {}) if found is None else found:
        if text is not None:
            yield line, text


def _extract(source: str | None) -> tuple[bool, str | None, list[tuple[int, str]]]:
    if source is None:
        return True, None, []
    try:
        # A lone surrogate cannot travel as UTF-8 and is not part of any query.
        found = [(n, t if t.isascii() else t.encode("utf-8", "replace").decode()) for n, t in literals(source)]
    except Exception as exc:  # noqa: BLE001 - a bad file is a failure row, never a failed job
        return False, f"{type(exc).__name__}: {exc}", []
    return True, None, found


def _struct(**fields: pa.Array) -> pa.Array:
    return pa.StructArray.from_arrays(list(fields.values()), names=list(fields))


def python_literals(source: Column) -> Column:
    """Struct (ok, error, items) per source; null source has no items."""

    @F.arrow_udf(LITERALS)
    def extract(batch: pa.Array) -> pa.Array:
        # Trees hold no cycles, and looking for some among their many nodes takes long.
        collects = gc.isenabled()
        gc.disable()
        try:
            ok, error, items = zip(*map(_extract, batch.to_pylist())) if len(batch) else ((), (), ())
        finally:
            if collects:
                gc.enable()
        ends = pa.array(accumulate(map(len, items), initial=0), pa.int32())
        line = pa.array([n for found in items for n, _ in found], pa.int32())
        text = pa.array([t for found in items for _, t in found], pa.string())
        items = pa.ListArray.from_arrays(ends, _struct(line=line, text=text))
        return _struct(ok=pa.array(ok, pa.bool_()), error=pa.array(error, pa.string()), items=items)

    # Kept from being copied into filters above it, which would run Python once per mention.
    return extract.asNondeterministic()(source)


# The functions above travel inside the job, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
