"""``spark-submit``-able entry: ``python -m weftgraph Matillion --input DIR --output DIR``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from weftgraph.jobs import run
from weftgraph.plans import registry
from weftgraph.session import DEFAULTS


def main() -> None:
    parser = argparse.ArgumentParser(prog="weftgraph")
    parser.add_argument("integration", choices=registry.names())
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--repo-url", default="")
    parser.add_argument("--branch", default="main")
    parser.add_argument("--files", default="", help="comma-separated paths relative to the input")
    parser.add_argument("--app-name", help="name of the app when the run has one file")
    parser.add_argument("--local", action="store_true", help="link bare paths")
    args = parser.parse_args()

    builder = SparkSession.builder.appName(f"weftgraph {args.integration}")
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    outcome = run(
        builder.getOrCreate(),
        args.integration,
        args.input,
        args.output,
        args.repo_url,
        args.branch,
        args.files,
        args.app_name,
        args.local,
    )
    outcome.summary.show(truncate=False)
    if outcome.missing is not None:
        outcome.missing.show(truncate=False)


if __name__ == "__main__":
    main()
