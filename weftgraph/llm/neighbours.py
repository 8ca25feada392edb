"""Approximate nearest neighbours by cosine: few stable projections, a kd-tree over them, verified in order.

Vectors of length one are projected on ``DIMENSIONS`` normal random directions. Then the squared projected
distance of two vectors, divided by their squared true distance, follows a chi-square distribution. A
kd-tree fitted on a bounded sample cuts the projected space into leaves, every row goes to its leaf, and in
a leaf (or a part of a crowded one) a finer kd-tree yields boxes in the order of their projected distance to
the query. The vectors in a box are verified on the originals; the search stops when a closer vector than the
k-th found would have been met already with probability ``SURE``.

A query first searches its own leaf. What it finds bounds the projected radius beyond which the same test
stops, and only leaves within it are searched after that. Leaves are cut into parts and their queries into
blocks, both of bounded size, so neither many equal vectors nor many queries in one place meet in one task.

Vectors that are null, zero, of another length than most, or hold a null or a number that is not finite
take no part, nor do rows with a null id. An id that repeats counts once, with its best score. With fewer
than k candidates all are found. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.session import stage_table

DIMENSIONS = 6
NEIGHBOURS = 5
SURE = 0.99
#: Rows of the sample the leaves are fitted on, about.
SAMPLE_ROWS = 50_000
#: Rows of a part of a leaf and queries of a block, on average at most.
PART_ROWS = 16_384
BLOCK_QUERIES = 1024
#: Vectors in a box of the finer tree.
BOX_ROWS = 64
SEED = 20_140_901


def directions(length: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((length, dimensions))


def chi_square(x: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Distribution function for an even number of dimensions."""
    half = np.minimum(np.asarray(x, dtype=float) / 2, 700.0)
    return 1 - np.exp(-half) * sum(half**i / math.factorial(i) for i in range(dimensions // 2))


def chi_square_inverse(p: float, dimensions: int = DIMENSIONS) -> float:
    low, high = 0.0, 1400.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, dimensions) < p else (low, middle)
    return high


def split(points: np.ndarray, rows: int) -> list[np.ndarray]:
    """Leaves of a kd-tree as positions: median cuts of the widest dimension until ``rows`` are left."""
    leaves, stack = [], [np.arange(len(points))]
    while stack:
        at = stack.pop()
        spread = np.ptp(points[at], axis=0) if len(at) else np.zeros(1)
        if len(at) <= rows or not spread.max() > 0:
            leaves.append(at)
            continue
        dimension = int(spread.argmax())
        order = at[np.argsort(points[at, dimension], kind="stable")]
        stack += [order[len(order) // 2 :], order[: len(order) // 2]]
    return leaves


class Leaves:
    """The coarse tree: cuts as (dimension, value, below, above), negative numbers are leaves."""

    def __init__(self, points: np.ndarray, leaves: int):
        self.cuts: list[list] = []
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        m = points.shape[1]
        stack = [(points, leaves, np.full(m, -np.inf), np.full(m, np.inf), None)]
        while stack:
            rows, count, low, high, parent = stack.pop()
            value = 0.0
            if count > 1 and len(rows) > 1:
                dimension = int(np.ptp(rows, axis=0).argmax())
                value = float(np.median(rows[:, dimension]))
                below = rows[:, dimension] < value
            if count <= 1 or len(rows) < 2 or not below.any():
                me = -1 - len(self.low)
                self.low.append(low)
                self.high.append(high)
            else:
                me = len(self.cuts)
                self.cuts.append([dimension, value, None, None])
                cut_high, cut_low = high.copy(), low.copy()
                cut_high[dimension] = cut_low[dimension] = value
                stack.append((rows[~below], count // 2, cut_low, high, (me, 3)))
                stack.append((rows[below], count - count // 2, low, cut_high, (me, 2)))
            if parent:
                self.cuts[parent[0]][parent[1]] = me

    def of(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), dtype=np.int64)
        stack = [(0 if self.cuts else -1, np.arange(len(points)))]
        while stack:
            node, at = stack.pop()
            if node < 0:
                out[at] = -1 - node
                continue
            dimension, value, below, above = self.cuts[node]
            under = points[at, dimension] < value
            stack += [(below, at[under]), (above, at[~under])]
        return out

    def within(self, point: np.ndarray, radius: float) -> np.ndarray:
        return np.flatnonzero(box_distance(point, np.array(self.low), np.array(self.high)) <= radius)


def box_distance(point: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    gap = np.maximum(np.maximum(low - point, point - high), 0.0)
    return np.sqrt((gap * gap).sum(axis=1))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of numbers of one length. Row sums below are per row, so equal vectors have equal scores."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def norms(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors * vectors).sum(axis=1))


def project(vectors: np.ndarray) -> np.ndarray:
    return (vectors / norms(vectors)[:, None]) @ directions(vectors.shape[1])


def search(
    ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, reach: np.ndarray, k: int
) -> list[tuple[int, int, float]]:
    """(query, id, score) of the best k of these rows for each query, as far as the test goes. ``reach`` is
    the distance of the k-th neighbour known before."""
    points, sizes = project(vectors), norms(vectors)
    boxes = split(points, BOX_ROWS)
    low = np.array([points[b].min(axis=0) for b in boxes])
    high = np.array([points[b].max(axis=0) for b in boxes])
    limit = chi_square_inverse(SURE)
    found = []
    for query, own, size, point, known in zip(queries, query_ids, norms(queries), project(queries), reach):
        away = box_distance(point, low, high)
        best_scores, best_ids, far = np.zeros(0), np.zeros(0, dtype=np.int64), known
        order = np.argsort(away, kind="stable")
        step, at = 4, 0
        while at < len(order):
            # The test: a chi-square value beyond the limit for the next box. Rounding is no distance.
            if away[order[at]] > max(far, 1e-6) * math.sqrt(limit):
                break
            rows = np.concatenate([boxes[b] for b in order[at : at + step]])
            at, step = at + step, min(step * 2, 64)
            rows = rows[ids[rows] != own]
            if not len(rows):
                continue
            scores = (vectors[rows] * query).sum(axis=1) / (sizes[rows] * size)
            best_scores = np.concatenate((best_scores, scores))
            best_ids = np.concatenate((best_ids, ids[rows]))
            order_ids = np.lexsort((best_ids, -best_scores))
            _, firsts = np.unique(best_ids[order_ids], return_index=True)
            keep = order_ids[np.sort(firsts)][:k]
            best_scores, best_ids = best_scores[keep], best_ids[keep]
            if len(keep) == k:
                far = min(known, math.sqrt(max(0.0, 2 - 2 * best_scores[-1])))
        found += [(int(own), int(i), float(s)) for i, s in zip(best_ids, best_scores)]
    return found


FOUND = "query_id bigint, vec_id bigint, score double"


def valid(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vec) of the rows that take part."""
    rows = vectors.select(vectors[f"`{key}`"].cast("long").alias("id"), vectors[f"`{vector}`"].alias("vec"))
    bad = "x -> x is null or isnan(x) or abs(x) = double('infinity')"
    rows = rows.where("id is not null and vec is not null and size(vec) > 0").where(
        F.expr(f"not exists(vec, {bad}) and exists(vec, x -> x <> 0)")
    )
    usual = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("vec") == (usual.n if usual else 0))


def nearest(
    vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = NEIGHBOURS
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row of ``vectors`` for which
    ``is_query`` (a condition on column ``id``) holds."""
    spark = vectors.sparkSession
    rows = valid(vectors, key, vector)
    count = rows.count()
    share = min(1.0, SAMPLE_ROWS / max(count, 1))
    sample = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    points = [project(matrix(b.column(0))) for b in [sample.select("vec").toArrow()] if b.num_rows]
    leaves = Leaves(points[0] if points else np.zeros((0, DIMENSIONS)), max(1, -(-count // PART_ROWS)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = pa.array(leaves.of(project(matrix(b.column("vec")))) if b.num_rows else [], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns, made], names=["id", "vec", "leaf"])

    index = stage_table(rows.mapInArrow(place, f"id bigint, vec {rows.schema['vec'].dataType.simpleString()}, leaf bigint"), "neighbours")
    own = index.where(is_query).select(
        F.col("id").alias("q"), F.col("vec").alias("q_vec"), F.col("leaf").alias("q_leaf"), F.lit(float("inf")).alias("reach")
    )
    first = stage_table(_search_leaves(index, own, k), "neighbours-first")
    reached = first.groupBy("query_id").agg(
        F.when(F.count("*") >= k, F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * _kth(k)))).otherwise(float("inf")).alias("reach")
    )
    again = own.drop("reach").join(reached, F.col("q") == F.col("query_id"), "left")
    again = again.select("q", "q_vec", "q_leaf", F.coalesce("reach", F.lit(float("inf"))).alias("reach"))
    wide = math.sqrt(chi_square_inverse(SURE))

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            near = [
                leaves.within(p, max(r, 1e-6) * wide)
                for p, r in zip(project(matrix(b.column("q_vec"))), b.column("reach").to_numpy())
            ]
            home = b.column("q_leaf").to_numpy()
            near = [n[n != h] for n, h in zip(near, home)]
            rows = b.take(pa.array(np.repeat(np.arange(b.num_rows), [len(n) for n in near])))
            to = pa.array(np.concatenate(near).astype(np.int64))
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), to, rows.column(3)], names=["q", "q_vec", "q_leaf", "reach"])

    second = _search_leaves(index, again.mapInArrow(others, again.schema), k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        first.unionByName(second)
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _kth(k: int) -> Column:
    """The k-th greatest score of a query's rows, of which there are k per part of its leaf."""
    return F.element_at(F.sort_array(F.collect_list("score"), asc=False), k)


def _search_leaves(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Every query against all parts of the leaf in its row."""
    parts = index.groupBy(F.col("leaf").alias("l")).agg(F.ceil(F.count("*") / PART_ROWS).cast("int").alias("parts"))
    asked = queries.groupBy("q_leaf").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("blocks"))
    cut = parts.join(asked, F.col("l") == F.col("q_leaf")).select("l", "parts", "blocks")
    rows = index.join(cut, F.col("leaf") == F.col("l")).select(
        "leaf",
        F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        "id",
        "vec",
    )
    asks = queries.join(cut, F.col("q_leaf") == F.col("l")).select(
        "q_leaf",
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("q_part"),
        F.pmod(F.xxhash64("q"), F.col("blocks")).cast("int").alias("q_block"),
        "q",
        "q_vec",
        "reach",
    )

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            found = search(
                left.column("id").to_numpy(),
                matrix(left.column("vec")),
                right.column("q").to_numpy(),
                matrix(right.column("q_vec")),
                right.column("reach").to_numpy(),
                k,
            )
        columns = zip(*found) if found else ([], [], [])
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["query_id", "vec_id", "score"])

    sides = rows.groupBy("leaf", "part", "block"), asks.groupBy("q_leaf", "q_part", "q_block")
    return sides[0].cogroup(sides[1]).applyInArrow(meet, FOUND)
