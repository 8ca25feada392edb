"""Keeping hot keys out of single tasks.

One key may hold a large share of all rows. Every helper here splits such a key into bounded pieces
and leaves the result exactly what the plain operator gives:

* ``find_hot`` counts the rows of every key and keeps each one above the limit, whatever its share of
  all rows, as a table that is joined to the rows;
* ``salted_join`` spreads the rows of heavy keys and repeats the other side per piece;
* ``number_rows`` / ``carry_last`` / ``next_within`` / ``last_within`` are row_number, last-value-so-far
  and bounded-frame windows. Without heavy keys they are the plain window; with them the window is cut
  into blocks along the order, and what crosses a block border is carried over.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftgraph.session import stage_table

ROWS_PER_SPLIT = "spark.weftgraph.rowsPerSplit"


def rows_per_split(spark: SparkSession) -> int:
    """Rows of one key that a single task is trusted with."""
    return int(spark.conf.get(ROWS_PER_SPLIT, "1000000"))


@dataclass(frozen=True)
class HotKeys:
    """Heavy values of ``columns`` as a table (_key: digest of the key, _pieces), none if there are none."""

    columns: tuple[str, ...]
    table: DataFrame | None = None

    def __bool__(self) -> bool:
        return self.table is not None

    def tell(self, df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
        """Adds ``_pieces``: 1 for every key that is not heavy."""
        if self.table is None:
            return df.withColumn("_pieces", F.lit(1))
        key = F.xxhash64(*(columns or self.columns))
        return (
            df.withColumn("_key", key)
            .join(self.table.withColumnRenamed("_pieces", "_heavy"), "_key", "left")
            .withColumn("_pieces", F.coalesce("_heavy", F.lit(1)))
            .drop("_key", "_heavy")
        )


def find_hot(df: DataFrame, columns: Sequence[str], limit: int | None = None) -> HotKeys:
    """Every key of ``df`` with more than ``limit`` rows, by an exact count with partial sums."""
    return hot_of(df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")), columns, limit=limit)


def hot_of(counts: DataFrame, columns: Sequence[str], n: str = "n", limit: int | None = None) -> HotKeys:
    """The same from counts per key that are at hand: a table with one row per key.

    There are at most as many heavy keys as rows divided by the limit. They are written only if there
    are any.
    """
    limit = limit or rows_per_split(counts.sparkSession)
    heavy = counts.filter(F.col(n) > limit).select(
        F.xxhash64(*columns).alias("_key"), F.ceil(F.col(n) / limit).cast("int").alias("_pieces")
    )
    if heavy.first() is None:
        return HotKeys(tuple(columns))
    return HotKeys(tuple(columns), stage_table(heavy, "heavy-keys"))


#: Into so many slots keys fall when only the absence of heavy ones is to be shown.
SLOTS = 65_536


def rows_if_light(df: DataFrame, columns: Sequence[str]) -> int | None:
    """The number of rows if it is sure that no key is heavy, else none.

    Rows are counted per slot of keys, and no key has more of them than its slot: unlike a count per key, what is
    shuffled does not grow with the keys.
    """
    slot = F.pmod(F.xxhash64(*columns), F.lit(SLOTS))
    per_slot = df.groupBy(slot.alias("_slot")).agg(F.count(F.lit(1)).alias("n"))
    rows, most = per_slot.agg(F.sum("n"), F.max("n")).first()
    return (rows or 0) if (most or 0) <= rows_per_split(df.sparkSession) else None


def piece(spread: Sequence[str], pieces: Column) -> Column:
    return F.pmod(F.xxhash64(*spread), pieces.cast("long")).cast("int")


def pieces_of(pieces: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), pieces.cast("int") - 1))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    hot: HotKeys,
    spread: Sequence[str],
) -> DataFrame:
    """Equi-join whose heavy left keys are spread by the ``spread`` columns, which tell rows apart.

    Each left row still meets every right row of its key once, so inner, left, semi and anti joins all
    keep their meaning. ``right`` is repeated for heavy keys only.
    """
    if not hot:
        return left.join(right, list(keys), how)
    left = hot.tell(left, keys).withColumn("_piece", piece(spread, F.col("_pieces"))).drop("_pieces")
    right = hot.tell(right, keys).withColumn("_piece", pieces_of(F.col("_pieces"))).drop("_pieces")
    return left.join(right, [*keys, "_piece"], how).drop("_piece")


def _known(hot: HotKeys | None, df: DataFrame, keys: Sequence[str]) -> HotKeys:
    """Heavy keys the caller already knows of, or a look at the data."""
    return find_hot(df, keys) if hot is None else hot


def _carry_join(df: DataFrame, carried: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(carried, [*keys, "_block"], "left").drop("_block")


def _in_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Adds ``_block``: equal shares of the rows in key and order, whatever their values.

    Range bounds come from a sample, so the table is written before anything depends on them: a lost
    executor re-reads the same blocks.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(ranges, *keys, *order)
    return stage_table(placed.withColumn("_block", F.spark_partition_id()), "ranges")


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    out: str,
    hot: HotKeys | None = None,
) -> DataFrame:
    """1-based position within ``keys`` along ``order``, which must tell rows apart."""
    if not _known(hot, df, keys):
        plain = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(out, F.row_number().over(plain).cast("long"))
    df = _in_ranges(df, keys, order)
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy(*keys, "_block")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*keys, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    within = Window.partitionBy(*keys, "_block").orderBy(*order)
    numbered = df.withColumn("_at", F.row_number().over(within))
    return (
        _carry_join(numbered, offsets, keys)
        .withColumn(out, (F.col("_before") + F.col("_at")).cast("long"))
        .drop("_before", "_at")
    )


def _block_of(df: DataFrame, position: str) -> Column:
    """Positions are dense, so equal stretches of them are equal shares of rows."""
    return F.floor(F.col(position) / rows_per_split(df.sparkSession))


def carry_last(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    value: Column,
    out: str,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Last non-null ``value`` at or before the row, along the dense ``position`` within ``keys``."""
    up_to = (Window.unboundedPreceding, Window.currentRow)
    if not _known(hot, df, keys):
        plain = Window.partitionBy(*keys).orderBy(position).rowsBetween(*up_to)
        return df.withColumn(out, F.last(value, True).over(plain))
    df = df.withColumn("_block", _block_of(df, position)).withColumn("_value", value)
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    seen = F.when(F.col("_value").isNotNull(), F.col(position))
    carried = (
        df.groupBy(*keys, "_block")
        .agg(F.max_by("_value", seen).alias("_last"))
        .select(*keys, "_block", F.last("_last", True).over(before).alias("_carried"))
    )
    within = Window.partitionBy(*keys, "_block").orderBy(position).rowsBetween(*up_to)
    return (
        _carry_join(df.withColumn("_seen", F.last("_value", True).over(within)), carried, keys)
        .withColumn(out, F.coalesce("_seen", "_carried"))
        .drop("_value", "_seen", "_carried")
    )


def _in_frame(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    value: Column,
    frame: tuple[int, int],
    pick: Callable[[Column], Column],
    out: str,
    hot: HotKeys | None,
) -> DataFrame:
    """``pick(value)`` over the positions ``p + frame[0] .. p + frame[1]``, one end of which is 0.

    Rows with a value near a block border are shown to the neighbour block as well, so that every frame
    is whole inside its block.
    """
    if not _known(hot, df, keys):
        plain = Window.partitionBy(*keys).orderBy(position).rangeBetween(*frame)
        return df.withColumn(out, pick(value).over(plain))
    size = rows_per_split(df.sparkSession)
    if max(map(abs, frame)) >= size:
        raise ValueError("the frame is longer than a block")
    df = df.withColumn("_value", value).withColumn("_block", _block_of(df, position))
    inside = F.col(position) % size
    ahead = frame[1] > 0
    near = inside < frame[1] if ahead else inside >= size + frame[0]
    halo = df.filter(F.col("_value").isNotNull() & near).withColumn(
        "_block", F.col("_block") + (-1 if ahead else 1)
    )
    rows = df.withColumn("_own", F.lit(True)).unionByName(halo.withColumn("_own", F.lit(False)))
    within = Window.partitionBy(*keys, "_block").orderBy(position).rangeBetween(*frame)
    return (
        rows.withColumn(out, pick(F.col("_value")).over(within))
        .filter("_own")
        .drop("_own", "_block", "_value")
    )


def next_within(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    value: Column,
    reach: int,
    out: str,
    hot: HotKeys | None = None,
) -> DataFrame:
    """First non-null ``value`` on positions ``p .. p + reach - 1``."""
    frame = (0, reach - 1)
    return _in_frame(df, keys, position, value, frame, lambda v: F.first(v, True), out, hot)


def last_within(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    value: Column,
    reach: int,
    out: str,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Last non-null ``value`` on positions ``p - reach + 1 .. p``."""
    frame = (-(reach - 1), 0)
    return _in_frame(df, keys, position, value, frame, lambda v: F.last(v, True), out, hot)
