"""Vector codes by k-means per part, exact in whole numbers, over metric trees of the anchors hierarchy.

A vector's components become whole numbers and are cut into equal consecutive parts; each part's codebook is
trained by rounds of k-means and a vector's code is its parts' nearest entries. Rows are packed into blocks.
For every part of a block a metric tree is built once from the middle out: about the square root of its points
become anchors, each new one the point farthest from its own anchor, which takes the points nearer to it (those
closer to their anchor than half the way to the new one are not looked at). The anchors' balls are merged
upwards, two that make the smallest ball first, and every anchor's points are treated alike downwards. A ball
caches the sum and the count of its points.

A round walks every tree from the root with the list of entries that may still own a point. A ball inherits the
list of the ball around it and drops the entries that some other entry beats for every point of the ball. Where
one entry is left the ball is wholly owned and its cached sum and count are added; in a leaf the points are
compared with the entries left. Sums of whole numbers per entry come back from all blocks, a number of rows that
depends on the codebooks alone, and the next codebook goes out.

Vectors that are null or hold a null or a number that is not finite are left out. Shorter vectors count as if
filled up with zeros to the greatest length, that rounded up to a multiple of the parts. Components are held within
the bounds in which squared distances fit a long (for parts of eight, numbers below 131,072). The first
codebook is that of the least keys; rows with equal keys follow by vector, rows with a null key come last. With
fewer vectors than entries there are as many entries as vectors. Ties go to the lower index. An empty table gives
an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.llm.vectors import finite, longest, padded
from weftgraph.session import stage_table

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Points up to which a ball is a leaf.
LEAF = 32
#: Numbers in a block's vectors, about.
BLOCK_NUMBERS = 1 << 19
#: What rounding may add to a comparison of distances, as a share of these.
SLACK = 1e-9


def whole_numbers(vectors: np.ndarray, part: int) -> np.ndarray:
    most = math.isqrt((1 << 61) // part)
    return np.clip(np.floor(SCALE * vectors), -most, most).astype(np.int64)


@dataclass
class Tree:
    """Points in the order of the leaves, where each came from, and the balls: the points' range, the two balls
    inside (-1 in a leaf), and the cached sum and radius. The count is the range's length."""

    points: np.ndarray
    order: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    left: np.ndarray
    right: np.ndarray
    sums: np.ndarray
    radius: np.ndarray

    def stored(self) -> bytes:
        return pickle.dumps(tuple(vars(self).values()))


def stored_tree(stored: pa.BinaryScalar) -> Tree:
    return Tree(*pickle.loads(stored.as_py()))


def anchors(points: np.ndarray) -> np.ndarray:
    """The anchor of every point, by number."""
    many = max(2, math.isqrt(len(points)))
    pivots = [0]
    away = np.sqrt(((points - points[0]) ** 2).sum(axis=1))
    owner = np.zeros(len(points), dtype=np.int64)
    while len(pivots) < many:
        # The farthest point of the widest anchor.
        far = int(away.argmax())
        if away[far] == 0:
            break
        between = np.sqrt(((points[pivots] - points[far]) ** 2).sum(axis=1))
        maybe = np.flatnonzero(away > between[owner] / 2)
        new = np.sqrt(((points[maybe] - points[far]) ** 2).sum(axis=1))
        nearer = new < away[maybe]
        taken = maybe[nearer]
        owner[taken], away[taken] = len(pivots), new[nearer]
        pivots.append(far)
    return owner


def merges(centres: np.ndarray, counts: np.ndarray, radii: np.ndarray) -> list[tuple[int, int]]:
    """The pairs of balls to merge, in order; merged balls are numbered on from the given ones."""
    k = len(centres)
    at, n, r = centres.copy(), counts.astype(float), radii.copy()
    names = list(range(k))
    between = np.sqrt(((at[:, None, :] - at[None]) ** 2).sum(axis=2))
    size = np.maximum((between + r[:, None] + r) / 2, np.maximum(r[:, None], r))
    np.fill_diagonal(size, np.inf)
    out = []
    for step in range(k - 1):
        a, b = divmod(int(size.argmin()), k)
        out.append((names[a], names[b]))
        r[a] = size[a, b]
        at[a] = (at[a] * n[a] + at[b] * n[b]) / (n[a] + n[b])
        n[a] += n[b]
        names[a], names[b] = k + step, -1
        between = np.sqrt(((at - at[a]) ** 2).sum(axis=1))
        row = np.maximum((between + r + r[a]) / 2, np.maximum(r, r[a]))
        row[[x < 0 for x in names]] = np.inf
        row[a] = np.inf
        size[a, :] = size[:, a] = row
        size[b, :] = size[:, b] = np.inf
    return out


def build(points: np.ndarray) -> Tree:
    """The tree of whole-number points."""
    near = points.astype(np.float64)
    children: list[tuple[int, int] | None] = []
    leaves: dict[int, np.ndarray] = {}

    def ball(at: np.ndarray) -> int:
        owner = anchors(near[at]) if len(at) > LEAF else np.zeros(len(at), dtype=np.int64)
        if not owner.any():
            children.append(None)
            leaves[len(children) - 1] = at
            return len(children) - 1
        order = np.argsort(owner, kind="stable")
        groups = [at[x] for x in np.split(order, np.flatnonzero(np.diff(owner[order])) + 1)]
        centres = np.array([near[g].mean(axis=0) for g in groups])
        radii = np.array([np.sqrt(((near[g] - c) ** 2).sum(axis=1).max()) for g, c in zip(groups, centres)])
        names = [ball(g) for g in groups]
        for a, b in merges(centres, np.array([len(g) for g in groups]), radii):
            children.append((names[a], names[b]))
            names.append(len(children) - 1)
        return names[-1]

    root = ball(np.arange(len(points)))
    # Balls are numbered anew from the root, each before those inside it; leaves from left to right.
    number, begin, end, left, right, order = {}, [], [], [], [], []
    stack, placed = [root], 0
    while stack:
        old = stack.pop()
        number[old] = len(begin)
        inside = children[old]
        begin.append(placed)
        left.append(-1 if inside is None else inside[0])
        right.append(-1 if inside is None else inside[1])
        if inside is None:
            order.append(leaves[old])
            placed += len(leaves[old])
        else:
            stack += [inside[1], inside[0]]
        end.append(placed)
    left = np.array([x if x < 0 else number[x] for x in left], dtype=np.int32)
    right = np.array([x if x < 0 else number[x] for x in right], dtype=np.int32)
    begin, end = np.array(begin, dtype=np.int32), np.array(end, dtype=np.int32)
    for i in range(len(left) - 1, -1, -1):
        if left[i] >= 0:
            end[i] = end[right[i]]
    order = np.concatenate(order).astype(np.int32)
    points = points[order]
    before = np.concatenate((np.zeros((1, points.shape[1]), np.int64), np.cumsum(points, axis=0)))
    sums = before[end] - before[begin]
    small = np.result_type(*[np.min_scalar_type(x) for x in (int(points.min()), int(points.max()), -1)])
    tree = Tree(points.astype(small), order, begin, end, left, right, sums, np.zeros(len(begin)))
    for level in _levels(tree):
        n = end[level] - begin[level]
        at = _ranges(begin[level], n)
        centre = sums[level] / n[:, None]
        away = ((points[at] - np.repeat(centre, n, axis=0)) ** 2).sum(axis=1)
        tree.radius[level] = np.sqrt(np.maximum.reduceat(away, np.cumsum(n) - n)) * (1 + SLACK)
    return tree


def _ranges(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.repeat(begin - np.cumsum(n) + n, n) + np.arange(n.sum())


def _levels(tree: Tree) -> Iterator[np.ndarray]:
    level = np.zeros(1, dtype=np.int64)
    while len(level):
        yield level
        level = level[tree.left[level] >= 0]
        level = np.concatenate((tree.left[level], tree.right[level]))


@dataclass
class Owned:
    """Balls wholly owned by an entry, and points of other leaves with the entry that owns each."""

    balls: np.ndarray
    ball_entries: np.ndarray
    points: np.ndarray
    point_entries: np.ndarray


def walk(tree: Tree, entries: np.ndarray) -> Owned:
    """Who owns what, from the root down; every list of entries is that of the ball around less those beaten."""
    k = len(entries)
    at = entries.astype(np.float64)
    between = np.sqrt(((at[:, None, :] - at[None]) ** 2).sum(axis=2))
    # An entry equal to an earlier one owns nothing.
    first = np.array([not (entries[:i] == e).all(axis=1).any() for i, e in enumerate(entries)])
    frontier, alive = np.zeros(1, dtype=np.int64), first[None, :]
    balls, owners, leaves, lists = [], [], [], []
    while len(frontier):
        n = tree.end[frontier] - tree.begin[frontier]
        centre = tree.sums[frontier] / n[:, None]
        away = np.where(alive, ((centre[:, None, :] - at[None]) ** 2).sum(axis=2), np.inf)
        best = away.argmin(axis=1)
        least = away[np.arange(len(best)), best][:, None]
        # How far an entry's squared distance can come down against that of the best inside the ball.
        reach = 2 * tree.radius[frontier][:, None] * between[best]
        alive = alive & ~(away - least - reach > SLACK * (least + reach + 1))
        single = alive.sum(axis=1) == 1
        balls.append(frontier[single])
        owners.append(best[single])
        leaf = ~single & (tree.left[frontier] < 0)
        leaves.append(frontier[leaf])
        lists.append(alive[leaf])
        inner = ~single & ~leaf
        frontier, alive = frontier[inner], alive[inner]
        frontier, alive = np.concatenate((tree.left[frontier], tree.right[frontier])), np.concatenate((alive, alive))
    leaf, alive = np.concatenate(leaves), np.concatenate(lists)
    n = tree.end[leaf] - tree.begin[leaf]
    points = _ranges(tree.begin[leaf], n)
    alive = np.repeat(alive, n, axis=0)
    here = tree.points[points].astype(np.int64)
    nearest = np.full(len(points), np.iinfo(np.int64).max)
    entry = np.zeros(len(points), dtype=np.int64)
    for j in range(k):
        some = np.flatnonzero(alive[:, j])
        away = ((here[some] - entries[j]) ** 2).sum(axis=1)
        nearer = away < nearest[some]
        nearest[some[nearer]], entry[some[nearer]] = away[nearer], j
    return Owned(np.concatenate(balls), np.concatenate(owners), points, entry)


def totals(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and count of the points of every entry."""
    owned = walk(tree, entries)
    sums, counts = np.zeros(entries.shape, dtype=np.int64), np.zeros(len(entries), dtype=np.int64)
    np.add.at(sums, owned.ball_entries, tree.sums[owned.balls])
    np.add.at(counts, owned.ball_entries, tree.end[owned.balls] - tree.begin[owned.balls])
    np.add.at(sums, owned.point_entries, tree.points[owned.points].astype(np.int64))
    np.add.at(counts, owned.point_entries, 1)
    return sums, counts


def assign(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entry of every point, in the order they were given, and its squared distance."""
    owned = walk(tree, entries)
    entry = np.zeros(len(tree.points), dtype=np.int64)
    n = tree.end[owned.balls] - tree.begin[owned.balls]
    entry[_ranges(tree.begin[owned.balls], n)] = np.repeat(owned.ball_entries, n)
    entry[owned.points] = owned.point_entries
    away = ((tree.points.astype(np.int64) - entries[entry]) ** 2).sum(axis=1)
    out, error = np.empty_like(entry), np.empty_like(away)
    out[tree.order], error[tree.order] = entry, away
    return out, error


def pack(vectors: DataFrame, length: int, parts: int, key: str, vector: str, label: str) -> DataFrame:
    """(keys, labels, trees): a written row per block, its trees by part."""
    rows = vectors.select(F.col(key).alias("key"), F.col(label).alias("label"), padded(F.col(vector), length).alias("vector"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    most = max(256, BLOCK_NUMBERS // max(length, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                block = batch.slice(at, most)
                numbers = block.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(block.num_rows, length)
                points = whole_numbers(numbers, length // parts)
                trees = [build(x).stored() for x in np.split(points, parts, axis=1)]
                columns = [_one_list(block.column("key")), _one_list(block.column("label")), _one_list(pa.array(trees, pa.binary()))]
                yield pa.RecordBatch.from_arrays(columns, names=["keys", "labels", "trees"])

    schema = f"keys array<{kinds['key']}>, labels array<{kinds['label']}>, trees array<binary>"
    return stage_table(rows.mapInArrow(run, schema), "metric-trees", compression="zstd")


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def next_codebooks(blocks: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """One round: every entry the floor of its points' mean, unused ones as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(codebooks.shape, dtype=np.int64), np.zeros(codebooks.shape[:2], dtype=np.int64)
        for batch in batches:
            for trees in batch.column("trees"):
                for part, tree in enumerate(trees.values):
                    more = totals(stored_tree(tree), codebooks[part])
                    sums[part] += more[0]
                    counts[part] += more[1]
        part, entry, place = np.indices(codebooks.shape)
        columns = [part, entry, place, sums, np.broadcast_to(counts[:, :, None], sums.shape)]
        arrays = [pa.array(x.ravel().astype(np.int64)) for x in columns]
        yield pa.RecordBatch.from_arrays(arrays, names=["part", "entry", "place", "total", "n"])

    made = blocks.select("trees").mapInArrow(run, "part bigint, entry bigint, place bigint, total bigint, n bigint")
    whole = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("total", "n")]
    out = codebooks.copy()
    for r in made.where("n > 0").groupBy("part", "entry", "place").agg(*whole).collect():
        out[r.part, r.entry, r.place] = int(r.total) // int(r.n)
    return out


def train(
    table: DataFrame, key: str, vector: str, label: str, parts: int, entries: int, rounds: int
) -> tuple[DataFrame, np.ndarray] | None:
    """The packed vectors and the codebooks (part, entry, place); none without vectors."""
    kept = table.select(key, label, F.col(vector).cast("array<double>").alias(vector))
    kept = kept.where(finite(F.col(vector)))
    length = max(1, -(-longest(kept, vector) // parts)) * parts
    first = kept.select(key, padded(F.col(vector), length).alias("v")).orderBy(F.col(key).asc_nulls_last(), "v").limit(entries)
    first = np.array([r.v for r in first.collect()], dtype=np.float64)
    if not len(first):
        return None
    codebooks = np.stack(np.split(whole_numbers(first, length // parts), parts, axis=1))
    blocks = pack(kept, length, parts, key, vector, label)
    for _ in range(rounds):
        codebooks = next_codebooks(blocks, codebooks)
    return blocks, codebooks


def codebooks_sha256(codebooks: np.ndarray) -> str:
    """Digest of all entries' numbers by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def compress(
    table: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """(key, label, codes, error) of every vector that takes part, a written table, and the codebooks."""
    kinds = {c: table.schema[c].dataType.simpleString() for c in (key, label)}
    schema = f"key {kinds[key]}, label {kinds[label]}, codes array<int>, error bigint"
    trained = train(table, key, vector, label, parts, entries, rounds)
    if trained is None:
        empty = table.sparkSession.createDataFrame([], schema)
        return empty.withColumnsRenamed({"key": key, "label": label}), np.zeros((parts, 0, 0), dtype=np.int64)
    blocks, codebooks = trained

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, labels, trees in zip(*(batch.column(c) for c in ("keys", "labels", "trees"))):
                found = [assign(stored_tree(t), codebooks[part]) for part, t in enumerate(trees.values)]
                codes = np.stack([f[0] for f in found], axis=1).astype(np.int32)
                codes = pa.FixedSizeListArray.from_arrays(pa.array(codes.ravel()), parts).cast(pa.list_(pa.int32()))
                columns = [keys.values, labels.values, codes, pa.array(sum(f[1] for f in found))]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "label", "codes", "error"])

    coded = stage_table(blocks.mapInArrow(run, schema), "codes")
    return coded.select(F.col("key").alias(key), F.col("label").alias(label), "codes", "error"), codebooks


def with_label_errors(coded: DataFrame, label: str = "label") -> DataFrame:
    """``coded`` with the error summed over rows of an equal label, null being one too."""
    named = F.struct(F.col(label).isNull().alias("none"), F.coalesce(F.col(label).cast("string"), F.lit("")).alias("name"))
    sums = coded.groupBy(named.alias("of")).agg(F.sum("error").alias("label_error"))
    return coded.withColumn("of", named).join(sums, "of").drop("of")


def sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same for vectors of one length that the parts divide, with distinct keys, comparing all with all."""
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS nth, len(embedding) // {parts} AS w,
         list_transform(embedding, lambda c: CAST(floor({SCALE} * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), parts AS MATERIALIZED (
  SELECT vec_id, label, nth, p, x[p * w + 1 : (p + 1) * w] AS v FROM kept, range({parts}) AS r(p)
), book0 AS MATERIALIZED (
  SELECT p, nth AS e, v FROM parts WHERE nth < {entries}
)"""
    ]
    for r in range(rounds + 1):
        steps.append(
            f"""own{r} AS MATERIALIZED (
  SELECT vec_id, label, parts.p, any_value(parts.v) AS v,
         min({entries} * list_sum(list_transform(list_zip(parts.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) + e) AS best
  FROM parts JOIN book{r} b ON parts.p = b.p GROUP BY vec_id, label, parts.p
)"""
        )
        if r < rounds:
            steps.append(
                f"""means{r} AS (
  SELECT p, CAST(best % {entries} AS BIGINT) AS e, i, sum(v[i]) AS s, count(*) AS n
  FROM own{r}, LATERAL (SELECT unnest(range(1, len(v) + 1)) AS i) GROUP BY ALL
), lists{r} AS (
  SELECT p, e, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM means{r} GROUP BY p, e
), book{r + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(l.v, b.v) AS v FROM book{r} b LEFT JOIN lists{r} l ON b.p = l.p AND b.e = l.e
)"""
            )
    return f"""WITH {', '.join(steps)}, coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', CAST(best % {entries} AS BIGINT)), '' ORDER BY p) AS code,
         CAST(sum(best // {entries}) AS BIGINT) AS error
  FROM own{rounds} GROUP BY vec_id, label
), digest AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded, digest"""
