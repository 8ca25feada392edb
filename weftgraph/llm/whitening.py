"""Whitening of vectors: their principal directions, each scaled to variance one.

Numbers become whole ones, so counts, sums and deviations are exact. The directions are fitted on every distinct
vector once. Tasks reduce their centred rows by blockwise QR to one small triangle each, and triangles are
stacked and reduced again, a bounded number at a time, until one is left: its singular values are those of all
centred rows. It is small (vector length squared), so the driver takes it to a bidiagonal one, gets the singular
values by dqds and the directions by twisted factorisations (module ``bidiagonal``).

Vectors that are null or hold a null or a number that is not finite are left out. Shorter vectors count as if
filled up with zeros to the greatest length. Floors are held within 2**47 either way; a deviation that does not fit
a long is null. Rows with equal or null keys are rows of their own. Of components with equal variance any
orthogonal choice may come out. Components without variance are none (fewer distinct vectors than components, a
table of equal vectors), so a table may give no rows; an empty one gives none. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.llm.bidiagonal import singular_pairs
from weftgraph.llm.vectors import finite, longest, padded
from weftgraph.session import stage_table

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
#: Triangles that are stacked at once.
STACKED = 32
MOST = 1 << 47


def whole_numbers(vectors: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """(key, x) of the vectors that take part, as whole numbers of one length, and that length."""
    kept = vectors.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v"))
    kept = kept.where(finite(F.col("v")))
    length = longest(kept, "v")
    held = lambda c: F.floor(F.least(F.greatest(c * F.lit(float(SCALE)), F.lit(-float(MOST))), F.lit(float(MOST))))
    x = F.transform(padded(F.col("v"), length), lambda c: held(c) + F.lit(SHIFT))
    return kept.select("key", x.alias("x")), length


def rows_of(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), length)


def sums_of(fit: DataFrame, length: int) -> tuple[int, list[int]]:
    """Rows and the exact sum of every place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = rows_of(batch.column("x"), length).sum(axis=0)
            places = np.arange(length + 1)
            yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(np.append(total, batch.num_rows))], names=["place", "total"])

    made = fit.select("x").mapInArrow(run, "place bigint, total bigint")
    found = made.groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    totals = {r.place: int(r.total) for r in found}
    return totals.get(length, 0), [totals.get(i, 0) for i in range(length)]


def differences(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exact: as longs where they surely fit."""
    most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    if n * most + max(map(abs, sums), default=0) < 1 << 62:
        return x * n - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (differences(x, n, sums) / n).astype(np.float64)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The squares of the differences, added up."""
    d = differences(x, n, sums)
    most = max(abs(int(d.max(initial=0))), abs(int(d.min(initial=0))))
    if d.dtype == object or most * most * d.shape[1] >= 1 << 63:
        exact = (d.astype(object) ** 2).sum(axis=1)
        return [v if v < 1 << 63 else None for v in exact.tolist()]
    return (d * d).sum(axis=1).tolist()


def triangle(rows: np.ndarray) -> np.ndarray:
    """A triangle with the same products of columns as the rows; no larger than the columns squared."""
    return np.linalg.qr(rows, mode="r") if len(rows) > rows.shape[1] else rows


def one_triangle(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The triangle of all centred rows."""
    length = len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.zeros((0, length))
        for batch in batches:
            whole = triangle(np.concatenate((whole, centred(rows_of(batch.column("x"), length), n, sums))))
        if len(whole):
            columns = [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([whole.ravel()])]
            yield pa.RecordBatch.from_arrays(columns, names=["nr", "numbers"])

    def stack(table: pa.Table) -> pa.Table:
        table = table.sort_by("nr")
        made = np.concatenate([np.array(r.values).reshape(-1, length) for r in table.column("numbers")])
        nr = table.column("nr")[0].as_py() // STACKED
        return pa.table({"nr": pa.array([nr], pa.int64()), "numbers": pa.array([triangle(made).ravel()])})

    schema = "nr bigint, numbers array<double>"
    made = stage_table(fit.select("x").mapInArrow(run, schema), "triangles")
    while made.count() > STACKED:
        made = stage_table(made.groupBy(F.floor(F.col("nr") / STACKED)).applyInArrow(stack, schema), "triangles")
    last = [np.array(r.numbers).reshape(-1, length) for r in made.orderBy("nr").collect()]
    whole = triangle(np.concatenate(last)) if last else np.zeros((0, length))
    return np.concatenate((whole, np.zeros((length - len(whole), length))))


def identity_error(fit: DataFrame, n: int, sums: list[int], directions: np.ndarray) -> float:
    """The largest entry of the whitened vectors' covariance less the identity. Whitened vectors are products of
    centred ones, so they are centred too."""
    length, k = len(sums), len(directions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.zeros((k, k))
        for batch in batches:
            z = centred(rows_of(batch.column("x"), length), n, sums) @ directions.T
            whole += z.T @ z
        columns = [pa.array(np.arange(k * k)), pa.array(whole.ravel())]
        yield pa.RecordBatch.from_arrays(columns, names=["place", "total"])

    made = fit.select("x").mapInArrow(run, "place bigint, total double").groupBy("place").agg(F.sum("total").alias("total"))
    covariance = np.zeros(k * k)
    for r in made.collect():
        covariance[r.place] = r.total / n
    return float(np.abs(covariance.reshape(k, k) - np.eye(k)).max())


def whiten(table: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error), a row per vector and component."""
    rows, length = whole_numbers(table, key, vector)
    fit = stage_table(rows.select("x").distinct(), "distinct-vectors", compression="zstd")
    n, sums = sums_of(fit, length)
    kind = table.schema[key].dataType.simpleString()
    pairs, error, shares = [], 0.0, []
    if n and length:
        whole = one_triangle(fit, n, sums)
        pairs = singular_pairs(whole, components)
        shares = [value / float((whole**2).sum()) for value, _ in pairs]
    directions = np.array([z / np.sqrt(value / n) for value, z in pairs])
    if len(pairs):
        error = identity_error(fit, n, sums, directions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches if len(directions) else ():
            x = rows_of(batch.column("x"), length)
            z = centred(x, n, sums) @ directions.T
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(directions)), pa.array(z.ravel()))
            columns = [batch.column("key"), pa.array(deviations(x, n, sums), pa.int64()), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "deviation", "z"])

    made = rows.mapInArrow(run, f"key {kind}, deviation bigint, z array<double>")
    made = made.select("key", "deviation", F.posexplode("z").alias("place", "whitened"))
    explained = F.element_at(F.array(*map(F.lit, shares or [0.0])), F.col("place") + 1)
    return made.select(
        F.col("key").alias(key),
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained.alias("explained"),
        F.lit(error).alias("identity_error"),
    )
