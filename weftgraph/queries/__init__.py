"""Driver queries over the given tables; importing this package registers all of them."""

from weftgraph.queries import (  # noqa: F401
    components,
    docs,
    lineage,
    notebooks,
    pages,
    sinks,
    sqltext,
    streams,
    usage,
)
from weftgraph.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
