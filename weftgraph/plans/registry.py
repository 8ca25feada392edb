"""Integrations by name, the three built-in ones and those users add.

An integration is a file suffix, a parser (artifacts to anything) and a converter (that to node rows).
``parse_rows`` turns a plain Python function into a parser with the fault rule of the built-in ones: a
file it cannot read becomes a failure row and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.functions import text
from weftgraph.operators.parent_child import parent_child_nodes
from weftgraph.plans import dashboard, notebook, orchestration

Stage = Callable[[DataFrame, str], DataFrame]


@dataclass(frozen=True)
class Run:
    """Where the artifacts of a run come from."""

    repo_url: str
    branch: str = "main"
    app_name: str | None = None
    local: bool = False


@dataclass(frozen=True)
class Integration:
    name: str
    suffix: str
    node_types: tuple[str, ...]
    #: artifacts, stage -> an object with ``failures`` and whatever the converter wants
    parse: Callable[[DataFrame, Stage], Any]
    #: parsed, run, stage -> nodes
    convert: Callable[[Any, Run, Stage], DataFrame]
    #: which artifacts belong to the integration, told before any parsing
    select: Callable[[DataFrame], DataFrame] = lambda artifacts: artifacts


_KNOWN: dict[str, Integration] = {}


def register(integration: Integration) -> Integration:
    _KNOWN[integration.name] = integration
    return integration


def get(name: str) -> Integration:
    return _KNOWN[name]


def names() -> list[str]:
    return sorted(_KNOWN)


def _dashboard_nodes(parsed: dashboard.Parsed, run: Run, stage: Stage) -> DataFrame:
    # The configured name is that of a one-file run; two rows tell such a run from a larger one.
    single = run.app_name if len(parsed.apps.select("rel_path").take(2)) == 1 else None
    return dashboard.convert(parsed, None if run.local else run.repo_url, run.branch, single)


register(
    Integration(
        orchestration.INTEGRATION,
        orchestration.SUFFIX,
        ("Pipeline", "Job"),
        orchestration.parse,
        lambda parsed, run, stage: orchestration.convert(parsed, run.repo_url, run.branch, stage),
    )
)
register(
    Integration(
        dashboard.INTEGRATION,
        dashboard.SUFFIX,
        ("App", "Chart"),
        dashboard.parse,
        _dashboard_nodes,
        dashboard.discover,
    )
)
register(
    Integration(
        notebook.INTEGRATION,
        notebook.SUFFIX,
        ("Notebook", "Cell"),
        notebook.parse,
        lambda parsed, run, stage: notebook.convert(parsed, run.repo_url, run.branch),
    )
)


# -- user-supplied parsers -------------------------------------------------------------------------


@dataclass(frozen=True)
class Records:
    """What a user's parser found: the record columns and ``rel_path``."""

    rows: DataFrame
    failures: DataFrame
    #: rel_path of every file that was read without failure, with or without records
    sources: DataFrame


def parse_rows(
    fn: Callable[[str, str], Iterable[dict[str, Any]]], schema: str, integration: str
) -> Callable[[DataFrame, Stage], Records]:
    """Parser from ``fn(rel_path, content) -> records``; ``schema`` declares the record's columns."""
    record = T.StructType.fromDDL(schema)
    names_ = [f.name for f in record.fields]
    out = f"rel_path string, _error string, {schema}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for rel_path, content in zip(batch["rel_path"], batch["content"]):
                try:
                    found = [
                        (rel_path, None, *(r.get(n) for n in names_)) for r in fn(rel_path, content)
                    ]
                except Exception as exc:  # noqa: BLE001 - a bad file is a failure row
                    found = [(rel_path, f"{type(exc).__name__}: {exc}", *[None] * len(names_))]
                rows.extend(found)
            yield pd.DataFrame(rows, columns=["rel_path", "_error", *names_])

    def parse(artifacts: DataFrame, stage: Stage) -> Records:
        rows = stage(artifacts.select("rel_path", "content").mapInPandas(run, out), "records")
        failures = rows.filter(F.col("_error").isNotNull()).select(
            F.lit(integration).alias("integration"),
            "rel_path",
            F.lit("file").alias("stage"),
            F.col("_error").alias("error"),
        )
        sources = artifacts.select("rel_path").join(failures.select("rel_path"), "rel_path", "left_anti")
        return Records(rows.filter(F.col("_error").isNull()).drop("_error"), failures, sources)

    return parse


def template(
    integration: str,
    suffix: str,
    fn: Callable[[str, str], Iterable[dict[str, Any]]],
    direction: str = "downstream",
) -> Integration:
    """A parent/child integration from a function that yields ``{"name": ..., "table": ...}`` records."""

    def convert(parsed: Records, run: Run, stage: Stage) -> DataFrame:
        path = F.col("rel_path")
        return parent_child_nodes(
            parsed.rows,
            integration,
            text.title_case(F.translate(text.file_stem(path), "_", " ")),
            F.col("name"),
            F.col("table"),
            text.source_url(F.lit(run.repo_url), F.lit(run.branch), path),
            direction=direction,
            sources=parsed.sources,
        )

    return Integration(
        integration,
        suffix,
        ("ParentNode", "ChildNode"),
        parse_rows(fn, "name string, table string", integration),
        convert,
    )
