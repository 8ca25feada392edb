"""The lineage graph: producer and consumer indexes, hand-offs, external tables, calls, nodes, edges.

Access rows are ``(job, table_name, mode)`` with mode W or R. They stay exploded through every join; lists
are built last, per node.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.plans import skew
from weftgraph.schemas import DEP
from weftgraph.session import spread_by, stage_table

TABLE = ("table_name",)
#: Into how many pieces the writes and the reads of a table are cut.
PIECES = ("w_pieces", "r_pieces")


def _others(df: DataFrame) -> list[str]:
    """What tells accesses of one table apart."""
    return [c for c in df.columns if c not in TABLE]


# -- dependency structs ------------------------------------------------------------------------


def node_ref(integration: Column, node_type: Column, name: Column) -> Column:
    return F.struct(
        integration.alias("integration_name"),
        node_type.alias("node_type"),
        name.alias("node_name"),
        F.lit(None).cast("string").alias("table_name"),
    )


def table_ref(table: Column) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(
        none.alias("integration_name"),
        none.alias("node_type"),
        none.alias("node_name"),
        table.alias("table_name"),
    )


def table_refs(tables: Column) -> Column:
    return F.transform(tables, table_ref)


def no_deps_type() -> str:
    return f"array<{DEP.simpleString()}>"


def no_deps() -> Column:
    return F.array().cast(no_deps_type())


def dep_label(dep: Column) -> Column:
    """``t`` for a table, ``Type:name`` for a node."""
    return F.coalesce(dep["table_name"], F.concat_ws(":", dep["node_type"], dep["node_name"]))


# -- indexes and table joins -------------------------------------------------------------------


def table_index(access: DataFrame) -> DataFrame:
    """(table_name, position, job): the jobs of every table in order, a row each, however many they are."""
    return skew.number_rows(access.select(*TABLE, "job"), TABLE, ["job"], "position")


def accesses(writes: DataFrame, reads: DataFrame) -> DataFrame:
    """Both sides as one table with ``mode`` W or R."""
    w, r = writes.withColumn("mode", F.lit("W")), reads.withColumn("mode", F.lit("R"))
    return w.unionByName(r)


def table_profile(access: DataFrame) -> DataFrame:
    """One row per table: how many write and read it, and its first and last reader by name."""
    w, r = F.col("mode") == "W", F.col("mode") == "R"
    return access.groupBy(*TABLE).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(w).alias("n_writes"),
        F.count_if(r).alias("n_reads"),
        F.min(F.when(r, F.col("job"))).alias("first_reader"),
        F.max(F.when(r, F.col("job"))).alias("last_reader"),
    )


def tag_accesses(access: DataFrame, hubs: bool = False) -> DataFrame:
    """Adds ``kept``: whether the access stays an edge to its table instead of becoming job-to-job edges.

    A write is kept if no other job reads the table, a read if no job writes it; with ``hubs`` every
    access is kept, so a table stands between its jobs and edges grow with accesses, not with pairs.
    The profile answers all of this, so no pair is made to find out. If tables stand for so many pairs
    that one task should not make them all, the pieces their writes and reads are cut into are added.
    """
    # Stated here so that all branches below ask the same of their scan and share its shuffle.
    access = access.filter(F.col("job").isNotNull() & F.col("table_name").isNotNull())
    if hubs:
        return access.withColumn("kept", F.lit(True))
    profile = stage_table(table_profile(access), "profile")
    hot = skew.hot_of(profile, TABLE)
    pieces = _pieces(profile)
    return skew.salted_join(access, profile, TABLE, "inner", hot, _others(access)).select(
        *access.columns, _kept().alias("kept"), *pieces
    )


def _pieces(profile: DataFrame) -> list[Column]:
    """Columns of the pieces that writes and reads are cut into, none if no table is crowded."""
    limit = skew.rows_per_split(profile.sparkSession)
    side = max(1, int(limit**0.5))
    crowded = F.col("n_writes").cast("double") * F.col("n_reads") > limit
    if profile.filter(crowded).first() is None:
        return []
    return [
        F.when(crowded, F.ceil(F.col(n) / side)).otherwise(1).cast("int").alias(name)
        for n, name in zip(("n_writes", "n_reads"), PIECES)
    ]


def _kept() -> Column:
    """Of an access beside its table's profile."""
    c = F.col
    alone = (c("n_reads") == 0) | (
        (c("first_reader") == c("job")) & (c("last_reader") == c("job"))
    )
    return F.when(c("mode") == "W", alone).otherwise(c("n_writes") == 0)


def profile_placed(access: DataFrame) -> DataFrame:
    """Accesses with their table's profile, for rows that lie partitioned by table, none of them heavy: neither
    this nor what ``tag_profiled`` and ``edges_of`` make of it shuffles rows, if it is kept as it lies."""
    w, r, table = F.col("mode") == "W", F.col("mode") == "R", Window.partitionBy(*TABLE)
    return access.withColumns(
        {
            "n_writes": F.count_if(w).over(table),
            "n_reads": F.count_if(r).over(table),
            "first_reader": F.min(F.when(r, F.col("job"))).over(table),
            "last_reader": F.max(F.when(r, F.col("job"))).over(table),
        }
    ).select(*access.columns, "n_writes", "n_reads", _kept().alias("kept"))


def tag_profiled(profiled: DataFrame) -> DataFrame:
    """``tag_accesses`` of accesses with their profile."""
    return profiled.select("*", *_pieces(profiled)).drop("n_writes", "n_reads")


def kept_writes(tagged: DataFrame) -> DataFrame:
    """Writes that stay edges to their table."""
    return tagged.filter((F.col("mode") == "W") & F.col("kept")).drop(*PIECES)


def kept_reads(tagged: DataFrame) -> DataFrame:
    """Reads that stay edges from their table."""
    return tagged.filter((F.col("mode") == "R") & F.col("kept")).drop(*PIECES)


def handoffs(tagged: DataFrame, producers: DataFrame | None = None) -> DataFrame:
    """producer -> consumer for every table that joins two different jobs and is not kept.

    ``producers`` narrows the writing side. Consumer columns get the prefix ``c_``. Both sides of a
    crowded table are spread over a grid: every piece of its writes meets every piece of its reads in
    a cell of its own, of bounded size.
    """
    made = (tagged if producers is None else producers).filter(
        (F.col("mode") == "W") & ~F.col("kept")
    )
    used = tagged.filter((F.col("mode") == "R") & ~F.col("kept"))
    keys = list(TABLE)
    if set(PIECES) <= set(tagged.columns):
        writes, reads = (F.col(x) for x in PIECES)
        made = made.withColumn("_row", skew.piece(["job"], writes)).withColumn("_cell", skew.pieces_of(reads))
        used = used.withColumn("_cell", skew.piece(["job"], reads)).withColumn("_row", skew.pieces_of(writes))
        keys += ["_row", "_cell"]
    used = used.drop("mode", "kept", *PIECES)
    renamed = {"job": "consumer"} | {x: f"c_{x}" for x in _others(used) if x not in ("job", *keys)}
    return (
        made.drop("mode", "kept", *PIECES)
        .withColumnRenamed("job", "producer")
        .join(used.withColumnsRenamed(renamed), keys)
        .drop("_row", "_cell")
        .filter(F.col("producer") != F.col("consumer"))
    )


def job_edges(access: DataFrame, hubs: bool = False) -> DataFrame:
    """The collapsed job graph of (job, table_name, mode): hand-offs, external inputs and outputs."""
    return edges_of(tag_accesses(access, hubs))


def edges_of(tagged: DataFrame) -> DataFrame:
    """The same of tagged accesses."""

    def edges(rows: DataFrame, src_kind: str, src: str, dst_kind: str, dst: str) -> DataFrame:
        return rows.select(
            F.lit(src_kind).alias("src_kind"),
            F.col(src).alias("src"),
            F.lit(dst_kind).alias("dst_kind"),
            F.col(dst).alias("dst"),
            "table_name",
        )

    return (
        edges(handoffs(tagged), "job", "producer", "job", "consumer")
        .unionByName(edges(kept_writes(tagged), "job", "job", "table", "table_name"))
        .unionByName(edges(kept_reads(tagged), "table", "table_name", "job", "job"))
    )


# -- calls -------------------------------------------------------------------------------------


def call_index(flows: DataFrame) -> DataFrame:
    """stem -> display name; of equal stems the greatest path wins."""
    return flows.groupBy("stem").agg(F.max_by("pipeline_name", "rel_path").alias("resolved"))


def resolve_calls(calls: DataFrame, index: DataFrame, spread: Sequence[str]) -> DataFrame:
    """Adds ``resolved`` (null where nothing matches) for ``called_pipeline``."""
    keys = ("called_pipeline",)
    return skew.salted_join(
        calls,
        index.withColumnRenamed("stem", "called_pipeline"),
        keys,
        "left",
        skew.find_hot(calls, keys),
        spread,
    )


def unresolved_calls(calls: DataFrame, index: DataFrame, spread: Sequence[str]) -> DataFrame:
    keys = ("called_pipeline",)
    return skew.salted_join(
        calls,
        index.select(F.col("stem").alias("called_pipeline")),
        keys,
        "left_anti",
        skew.find_hot(calls, keys),
        spread,
    )


# -- nodes -------------------------------------------------------------------------------------


def assemble_nodes(heads: DataFrame, deps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Node documents from one head per node and one row per dependency, the form they are stored in.

    ``heads``: keys, integration, name, node_type, description, url, has_downstream.
    ``deps``: keys, direction ``up``/``down``, ``rank`` (sort struct) and ``dep``. Lists are built here,
    for output, and nowhere before: from rows that are already in order, so that sorting a list only has to
    look it through. Rows are sorted by generated code that can spill, elements of a list one call each.
    """
    deps = spread_by(deps, *keys).sortWithinPartitions(*keys, "direction", "rank", "dep")
    ranked = F.struct("rank", "dep")

    def side(direction: str) -> Column:
        lists = F.sort_array(F.collect_list(F.when(F.col("direction") == direction, ranked)))
        return F.transform(lists, lambda x: x["dep"])

    lists = deps.groupBy(*keys).agg(side("up").alias("_up"), side("down").alias("_down"))
    down = F.when(F.col("has_downstream"), F.coalesce("_down", no_deps()))
    return heads.join(lists, list(keys), "left").select(
        "integration",
        "name",
        "node_type",
        F.struct("description", "url").alias("attributes"),
        F.struct(
            F.coalesce("_up", no_deps()).alias("upstream_dependencies"),
            down.alias("downstream_dependencies"),
        ).alias("lineage"),
    )


def dependency_edges(deps: DataFrame) -> DataFrame:
    """Every dependency (node, direction, dep) as one directed edge: an upstream one d -> node, a downstream
    one node -> d."""
    kind = F.when(F.col("dep.table_name").isNotNull(), F.lit("table")).otherwise(F.lit("node"))
    up, other = F.col("direction") == "up", dep_label(F.col("dep"))
    return deps.select(
        F.when(up, kind).otherwise(F.lit("node")).alias("src_kind"),
        F.when(up, other).otherwise(F.col("node")).alias("src"),
        F.when(up, F.lit("node")).otherwise(kind).alias("dst_kind"),
        F.when(up, F.col("node")).otherwise(other).alias("dst"),
    )


def edge_list(nodes: DataFrame) -> DataFrame:
    """The edges of node documents."""

    def of(direction: str, side: str) -> DataFrame:
        return nodes.select(
            F.concat_ws(":", "node_type", "name").alias("node"),
            F.lit(direction).alias("direction"),
            F.explode(f"lineage.{side}_dependencies").alias("dep"),
        )

    return dependency_edges(of("up", "upstream").unionByName(of("down", "downstream")))


def stitch(table_edges: DataFrame) -> DataFrame:
    """Table edges that meet an edge of another integration on the other side of the table.

    ``table_edges``: integration, node, table_name, mode ``W``/``R``. The table stays the hub between
    the two sides, so the result is linear in the edges.
    """

    def mode_of(mode: str) -> DataFrame:
        return table_edges.filter(F.col("mode") == mode)

    def met(edges: DataFrame, others: DataFrame) -> DataFrame:
        sides = others.groupBy("table_name").agg(
            F.min("integration").alias("_first"), F.max("integration").alias("_last")
        )
        other = (F.col("_first") != F.col("integration")) | (F.col("_last") != F.col("integration"))
        return (
            skew.salted_join(
                edges, sides, TABLE, "inner", skew.find_hot(edges, TABLE), _others(edges)
            )
            .filter(other)
            .drop("_first", "_last")
        )

    writes, reads = mode_of("W"), mode_of("R")
    return met(writes, reads).unionByName(met(reads, writes))


def unknown_types(nodes: DataFrame, types: DataFrame) -> DataFrame:
    """Nodes whose type is not declared for their integration."""
    return nodes.join(types, ["integration", "node_type"], "left_anti")


def duplicate_names(nodes: DataFrame) -> DataFrame:
    """Names that an integration uses for more than one node."""
    return (
        nodes.groupBy("integration", "name")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
    )


def dangling_refs(nodes: DataFrame) -> DataFrame:
    """Dependencies on a node of the same set that was never emitted."""
    refs = nodes.select(
        F.explode(
            F.concat(
                F.coalesce("lineage.upstream_dependencies", no_deps()),
                F.coalesce("lineage.downstream_dependencies", no_deps()),
            )
        ).alias("dep")
    ).filter(F.col("dep.node_name").isNotNull())
    known = nodes.select(
        F.col("integration").alias("integration_name"), "node_type", F.col("name").alias("node_name")
    )
    return (
        refs.select("dep.integration_name", "dep.node_type", "dep.node_name")
        .distinct()
        .join(known, ["integration_name", "node_type", "node_name"], "left_anti")
    )


def latest(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The newest row per key. An aggregate, so copies of one key shrink before the shuffle."""
    payload = [c for c in rows.columns if c not in keys]
    return (
        rows.groupBy(*keys)
        .agg(F.max_by(F.struct(*payload), F.struct(*order)).alias("_row"))
        .select(*keys, "_row.*")
    )


def earliest(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key."""
    payload = [c for c in rows.columns if c not in keys]
    return (
        rows.groupBy(*keys)
        .agg(F.min_by(F.struct(*payload), F.struct(*order)).alias("_row"))
        .select(*keys, "_row.*")
    )


def run_summary(nodes: DataFrame) -> DataFrame:
    """Nodes per integration and type."""
    return nodes.groupBy("integration", "node_type").agg(F.count(F.lit(1)).alias("nodes"))
