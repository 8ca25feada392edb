"""Headline queries, each run twice (once to warm up, once measured). Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from weftgraph.queries import QUERIES  # noqa: E402
from weftgraph.session import local_session  # noqa: E402

HEADLINES = (
    "flagship",
    "usage_summary",
    "sql_read_refs",
    "sql_script_io",
    "node_assemble",
    "join_handoff_edges",
    "join_stitch",
    "node_upsert",
    "win_next",
    "win_prev",
    "dedupe_first",
    "desc_job",
    "yaml_components",
    "py_literals",
    "chart_infer",
    "pages_nodes",
    "conv_nodes",
    "stream_usage",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "*"), "weftgraph-bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINES:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_wall",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
