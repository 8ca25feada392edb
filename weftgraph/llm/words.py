"""Words, folds and text columns that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of rows that a Python worker gets at once. Both sides of the hand-over hold a whole batch, and by default
#: one has 10,000 rows however long these are.
BATCH_BYTES = 4 << 20
#: A word: code points other than space and the five ASCII controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold(key: Column, folds: int, held: int) -> Column:
    """Whether crc32 of the key as text leaves ``held``; a null key is never held out."""
    return F.coalesce(F.crc32(key.cast("string")) % folds == held, F.lit(False))


def split_words(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, pa.Array]:
    """All words of a batch in order, and where each text's words begin (one bound more than texts)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    words = lists.flatten()
    full = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    bounds = np.concatenate(([0], np.cumsum(full)))[bounds].astype(np.int64)
    return bounds, words.filter(pa.array(full))


def coded(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """A code per word and the distinct words the codes stand for."""
    encoded = words.dictionary_encode()
    return encoded.indices.to_numpy(), encoded.dictionary


def blocks(batch: pa.RecordBatch, column: str, most: int = 2 << 20):
    """Parts of a batch with about ``most`` bytes of text (or items of lists) each; a longer one stands alone.

    They are copies, no slices: Arrow's functions on text can misread where a slice begins. After the last one Arrow's
    pool gives back what it keeps of memory that is free; a worker would hold it in all later tasks."""
    values = batch.column(column)
    size = pc.list_value_length if pa.types.is_list(values.type) else pc.binary_length
    sizes = pc.fill_null(size(values), 0).to_numpy(zero_copy_only=False)
    begin, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield batch.take(pa.array(np.arange(begin, i)))
            begin, total = i, 0
        total += int(n)
    if begin < batch.num_rows:
        yield batch.take(pa.array(np.arange(begin, batch.num_rows))) if begin else batch
    pa.default_memory_pool().release_unused()


def map_texts(df: DataFrame, run: Callable, schema: T.StructType | str, most: int = BATCH_BYTES) -> DataFrame:
    """``df.mapInArrow`` for rows with whole texts: batches go by bytes, from here on for all of the session. A row
    beyond the limit is a batch of its own."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", most)
    return df.mapInArrow(run, schema)


def attach(
    df: DataFrame, column: str, results: list[T.StructField], maker: Callable[[], Callable[[pa.Array], list[pa.Array]]]
) -> DataFrame:
    """``df`` with columns made from one of its columns. ``maker`` is called once per task and gives the
    function that makes them for a block of rows. An input column named like a result gives way to it."""
    taken = {f.name.lower() for f in results}
    at = df.columns.index(column)
    rows = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    made = [T.StructField(f"r{i}", f.dataType) for i, f in enumerate(results)]
    schema = T.StructType([*rows.schema.fields, *made])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = maker()
        for batch in batches:
            for part in blocks(batch, f"c{at}"):
                yield pa.RecordBatch.from_arrays([*part.columns, *make(part.column(at))], names=names)

    kept = [F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns) if c.lower() not in taken]
    new = [F.col(f"r{i}").alias(f.name) for i, f in enumerate(results)]
    return map_texts(rows, run, schema).select(*kept, *new)
