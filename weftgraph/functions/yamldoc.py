"""YAML text to JSON text. Everything after that is Spark's."""

from __future__ import annotations

import json
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

try:
    import yaml
except ImportError:  # pragma: no cover - the orchestration job needs PyYAML on the executors
    yaml = None

DOC = "struct<doc:string, error:string>"

TAG = "tag:yaml.org,2002:"


class _Unusual(Exception):
    """A node that only the loader's own way of building values is right for."""


def _value(loader, node, built: dict):
    """What the loader makes of a node of mappings, lists and scalars. Anything else (merges, tagged collections,
    keys that are no scalars, nodes in themselves) is left to the loader. ``built``: what aliases share."""
    tag, kind = node.tag, type(node)
    if kind is yaml.ScalarNode:
        return node.value if tag == TAG + "str" else loader.construct_object(node, deep=True)
    if node in built:
        if built[node] is None:
            raise _Unusual
        return built[node]
    built[node] = None
    if kind is yaml.MappingNode and tag == TAG + "map":
        made = {}
        for key, value in node.value:
            if type(key) is not yaml.ScalarNode or key.tag in (TAG + "merge", TAG + "value"):
                raise _Unusual
            made[_value(loader, key, built)] = _value(loader, value, built)
    elif kind is yaml.SequenceNode and tag == TAG + "seq":
        made = [_value(loader, x, built) for x in node.value]
    else:
        raise _Unusual
    built[node] = made
    return made


def load(text: str | None):
    """``yaml.load`` with the safe loader. Plain nodes are built directly, what is unusual or
    wrong goes the loader's own way, so values and errors are its."""
    kind = getattr(yaml, "CSafeLoader", yaml.SafeLoader)
    try:
        loader = kind(text)
        try:
            node = loader.get_single_node()
            return None if node is None else _value(loader, node, {})
        finally:
            loader.dispose()
    except Exception:  # noqa: BLE001 - the loader's own way tells what is wrong
        return yaml.load(text, Loader=kind)


def to_json(text: str | None) -> tuple[str | None, str | None]:
    """(json, error). Mappings become lists of ``{"k": key, "v": value}`` only for the components, whose
    order counts."""
    try:
        root = load(text)
        if not isinstance(root, dict):
            raise ValueError("document is not a mapping")
        flow = root.get("pipeline", {}) or {}
        meta, parts = flow.get("metadata", {}), flow.get("components", {})
        if not isinstance(meta, dict) or not isinstance(parts, dict):
            raise ValueError("metadata or components is not a mapping")
        doc = {
            "description": meta.get("description", ""),
            "components": [
                {"name": str(k), "body": json.dumps(v, default=str)} for k, v in parts.items()
            ],
        }
        return json.dumps(doc, default=str), None
    except Exception as exc:  # noqa: BLE001 - a bad file is a failure row, never a failed job
        return None, f"{type(exc).__name__}: {exc}"


def yaml_documents(text: Column) -> Column:
    """Struct (doc, error) per YAML text."""

    @F.pandas_udf(DOC)
    def convert(batch: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([to_json(t) for t in batch], columns=["doc", "error"])

    # Kept from being copied into filters above it, which would run Python once per mention.
    return convert.asNondeterministic()(text)


# The functions above travel inside the job, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
