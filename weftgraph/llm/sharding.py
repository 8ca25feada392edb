"""Sharding by a permutation-filled lookup table.

Every shard has its own permutation of the slots of a prime-sized table (a start and a step from digests of
its name). The shards take turns, each claiming the first slot of its permutation that is still free, until
none is left. A key is placed by its digest modulo the size: one look-up. When shards come or go, nearly all
slots keep their shard. The table has ``slots`` rows whatever the data, so it is broadcast.

A null key has the slot of the empty text; repeated rows share a shard; an empty table stays empty. Columns
of the input keep their names and values; one named like a result gives way to it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Slots of the table, a prime over a hundred times the number of shards.
SLOTS = 16381
SHARDS = 64
#: A table beyond this is refused: it would no longer be a small broadcast.
MOST_SLOTS = 1_000_003


def shard_names(count: int = SHARDS) -> list[str]:
    return [f"shard-{i:04d}" for i in range(count)]


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The shard number in every slot."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards must be named, each once")
    if not len(shards) <= slots <= MOST_SLOTS or any(slots % p == 0 for p in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"slots must be a prime from the number of shards to {MOST_SLOTS}")
    at = [_number(f"{name} start") % slots for name in shards]
    step = [_number(f"{name} step") % (slots - 1) + 1 if slots > 1 else 0 for name in shards]
    table = [-1] * slots
    for claimed in range(slots):
        turn = claimed % len(shards)
        while table[at[turn]] >= 0:
            at[turn] = (at[turn] + step[turn]) % slots
        table[at[turn]] = turn
    return table


def lookup_table(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """(slot, shard), one row per slot, from one literal."""
    table, names = ",".join(map(str, fill(shards, slots))), ",".join(shards)
    return (
        spark.range(1)
        .select(F.posexplode(F.split(F.lit(table), ",")).alias("slot", "turn"))
        .select("slot", F.element_at(F.split(F.lit(names), ","), F.col("turn").cast("int") + 1).alias("shard"))
    )


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(slots)).cast("int")


def place(
    df: DataFrame, key: str, shards: list[str], slots: int = SLOTS, slot: str = "slot", shard: str = "shard"
) -> DataFrame:
    """``df`` with the slot and the shard of every row; no shuffle."""
    if any("," in name for name in shards):
        raise ValueError("a shard's name has a comma")
    kept = [c for c in df.columns if c.lower() not in (slot.lower(), shard.lower())]
    table = lookup_table(df.sparkSession, shards, slots)
    table = table.select(F.col("slot").alias("claimed_slot"), F.col("shard").alias("claimed_by"))
    row = F.struct(F.lit(0).alias("nothing"), *[df[f"`{c}`"] for c in kept]).alias("row")
    out = df.select(row, slot_of(df[f"`{key}`"], slots).alias("at"))
    out = out.join(F.broadcast(table), F.col("at") == F.col("claimed_slot"))
    return out.select(*[F.col(f"row.`{c}`") for c in kept], F.col("at").alias(slot), F.col("claimed_by").alias(shard))


def write_shards(placed: DataFrame, path: str, shard: str = "shard", most_rows: int = 1_000_000) -> None:
    """One folder per shard. A shard's rows go to as many tasks as the writer had input splits, so a shard
    of any size is written in files of at most ``most_rows`` rows without passing through one task."""
    placed.write.option("maxRecordsPerFile", most_rows).partitionBy(shard).parquet(path)


def sql() -> str:
    table = ",".join(map(str, fill(shard_names())))
    return f"""
WITH placed AS (
  SELECT doc_id, CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT
                      % {SLOTS} AS INT) AS slot
  FROM documents
), claimed AS (
  SELECT unnest([{table}]) AS turn, unnest(range({SLOTS})) AS slot
)
SELECT p.doc_id, p.slot, printf('shard-%04d', c.turn) AS shard
FROM placed p JOIN claimed c ON p.slot = c.slot
"""
