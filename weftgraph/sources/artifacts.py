"""Corpora of code artifacts as DataFrames."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.functions.text import strip


class NoArtifacts(ValueError):
    """A run without any input file."""


def read_artifacts(spark: SparkSession, root: str, suffix: str, integration: str) -> DataFrame:
    """Every file below ``root`` (or the one file ``root``) whose name matches ``suffix``, one row each."""
    files = (
        spark.read.format("text")
        .option("wholetext", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", suffix)
        .load(root)
    )
    return _rows(files, root, integration)


def stream_artifacts(spark: SparkSession, root: str, suffix: str, integration: str) -> DataFrame:
    """The same rows as they arrive."""
    files = (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", suffix)
        .schema("value string")
        .load(root)
    )
    return _rows(files, root, integration)


def _rows(files: DataFrame, root: str, integration: str) -> DataFrame:
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    # What follows the first mention of the root, whatever scheme and slashes the path is written with.
    base = root.split("://")[-1].rstrip("/")
    if os.path.exists(base):
        base = os.path.abspath(base)
    tail = path.substr(F.locate(base, path) + len(base), F.lit(2**30))
    rel = F.regexp_replace(tail, r"^/+", "")
    return files.select(
        F.lit(integration).alias("integration"),
        path.alias("path"),
        # A single file is known by its name.
        F.when(rel == "", F.element_at(F.split(path, "/"), -1)).otherwise(rel).alias("rel_path"),
        F.col("value").alias("content"),
        F.col("_metadata.file_modification_time").alias("modified_at"),
    )


def containing(artifacts: DataFrame, mark: str) -> DataFrame:
    """Content-based discovery, in path order."""
    return artifacts.filter(F.col("content").contains(mark)).orderBy("rel_path")


def allow_list(spark: SparkSession, listed: str) -> DataFrame:
    """A comma-separated parameter as rows: trimmed, blanks dropped."""
    text = spark.range(1).select(F.explode(F.split(F.lit(listed), ",")).alias("rel_path"))
    return text.select(strip(F.col("rel_path")).alias("rel_path")).filter("rel_path <> ''").distinct()


def allowed(artifacts: DataFrame, listed: DataFrame) -> DataFrame:
    """Artifacts on the list. Applied before any parsing; the list is no larger than its parameter, and
    whether it is sent to all executors is left to its measured size."""
    return artifacts.join(listed, "rel_path", "left_semi")


def missing(artifacts: DataFrame, listed: DataFrame) -> DataFrame:
    """Listed paths that are not there."""
    return listed.join(artifacts.select("rel_path"), "rel_path", "left_anti")


def select_artifacts(artifacts: DataFrame, listed: str = "") -> DataFrame:
    """The artifacts of a run: all, or those of a comma-separated list; none at all is an error."""
    if strip_text(listed):
        artifacts = allowed(artifacts, allow_list(artifacts.sparkSession, listed))
    if artifacts.select("rel_path").isEmpty():
        raise NoArtifacts("no input files" + (f" among: {listed}" if listed else ""))
    return artifacts


def strip_text(listed: str) -> str:
    return listed.replace(",", " ").strip()
