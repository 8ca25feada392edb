"""Near-duplicates by SimHash fingerprints that differ in few bits, found by deletion-variant signatures.

A fingerprint has 64 bits; a bit is set if over half of the text's shingles, repeats included, have it set in
their XXH64 digest. For links at ``bits`` differing bits the fingerprint is cut into only ``bits // 2 + 1``
segments: of two linked fingerprints at least one segment differs by one bit at most. A segment is indexed
by its variants with one bit wiped out, one signature per bit. Segments that differ by that bit alone, or not
at all, agree there, so every link meets at an equal signature, and a fingerprint has 64 of them.

Equal fingerprints are one node from the start. Fingerprints that agree in a whole segment are first compared
with the least of these, which settles most of a group of near copies without its pairs. Then only the
signatures whose fingerprints lie in several components matter: there, members outside the commonest component
are compared with all that are in another one. A group above ``CROWDED`` members is cut before that: the bits
outside its segment fall into one piece more than may differ, linked fingerprints agree on a piece, and signature
and piece make finer groups, which are treated like the others. Only verified links are ever emitted, and no link
is lost.

Null texts and texts without words have the fingerprint zero, which is linked like any other. Texts with fewer
words than a shingle has are one shingle. Texts of any length are read whole, in slices. A null key takes part;
it names no component, which is null where it has no other keys. Rows that repeat a key are texts of their
own. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.llm.components import components
from weftgraph.llm.words import blocks, map_texts, split_words
from weftgraph.session import stage_table

WIDTH = 4
BITS = 4
SEED = 42
#: Members from which a group that lies in several components is cut into finer ones.
CROWDED = 64
#: Shingles that are digested at once; longer texts take several slices.
SLICE = 1 << 18

#: For a byte, its bits in the eight bytes of a number, so that bits are counted by adding numbers.
SPREAD = np.array([sum(((v >> k) & 1) << (8 * k) for k in range(8)) for v in range(256)], dtype=np.uint64)


def shingle_spans(texts: pa.Array, width: int) -> tuple[np.ndarray, memoryview, np.ndarray, np.ndarray]:
    """Shingles of every text, how many: with words lower-cased and joined by one space in a buffer, where
    each shingle begins and ends."""
    bounds, words = split_words(texts, lower=True)
    n = np.diff(bounds)
    joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(bounds), words), pa.scalar(" ", pa.large_string()))
    joined = joined.combine_chunks() if isinstance(joined, pa.ChunkedArray) else joined
    lengths = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    # A word begins after all words before it, each with its space but the last of a text.
    ends = np.cumsum(lengths + 1) - 1 - np.repeat(np.cumsum(n > 0) - 1, n)
    starts = ends - lengths
    count = np.where(n == 0, 0, np.maximum(n - width + 1, 1))
    first = np.repeat(bounds[:-1] - np.cumsum(count) + count, count) + np.arange(count.sum())
    last = np.minimum(first + width, np.repeat(bounds[1:], count)) - 1
    data = joined.buffers()[2]
    return count, memoryview(data if data is not None else b""), starts[first], ends[last]


def bit_counts(digests: np.ndarray) -> np.ndarray:
    """How many of the numbers have each of the 64 bits, the lowest first."""
    lanes = SPREAD[digests.view(np.uint8).reshape(-1, 8)]
    # A byte holds counts up to 255.
    runs = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)
    return runs.view(np.uint8).reshape(len(runs), 64).sum(axis=0, dtype=np.int64)


def fingerprints(texts: pa.Array, width: int = WIDTH) -> np.ndarray:
    """The fingerprint of every text, as an unsigned number."""
    count, data, starts, ends = shingle_spans(texts, width)
    out = np.zeros(len(count), dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    powers = np.uint64(1) << np.arange(64, dtype=np.uint64)
    at = np.concatenate(([0], np.cumsum(count)))
    # Texts are taken in runs of at most a slice of shingles; a longer text is summed over its slices.
    text = 0
    while text < len(count):
        upto = max(text + 1, int(np.searchsorted(at, at[text] + SLICE, side="right")) - 1)
        if upto == text + 1:
            bits = np.zeros(64, dtype=np.int64)
            for low in range(at[text], at[upto], SLICE):
                bits += bit_counts(_digests(digest, data, starts, ends, low, min(low + SLICE, at[upto])))
            out[text] = powers[bits * 2 > count[text]].sum(dtype=np.uint64)
        else:
            digests = _digests(digest, data, starts, ends, at[text], at[upto])
            for i in range(text, upto):
                if count[i]:
                    bits = bit_counts(digests[at[i] - at[text] : at[i + 1] - at[text]])
                    out[i] = powers[bits * 2 > count[i]].sum(dtype=np.uint64)
        text = upto
    return out


def _digests(digest, data, starts, ends, low: int, high: int) -> np.ndarray:
    spans = zip(starts[low:high].tolist(), ends[low:high].tolist())
    return np.fromiter((digest(data[a:b], SEED) for a, b in spans), np.uint64, high - low)


def with_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """(key, fingerprint) of every text; the fingerprint as a signed long of the same bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                made = pa.array(fingerprints(part.column("text"), width).view(np.int64), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("key"), made], names=["key", "fingerprint"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(docs[f"`{key}`"].alias("key"), docs[f"`{text}`"].alias("text"))
    return map_texts(rows, run, f"key {kind}, fingerprint bigint")


def segments(bits: int) -> list[tuple[int, int]]:
    """(lowest bit, bit after the highest) of every segment."""
    many = bits // 2 + 1
    cuts = [64 * i // many for i in range(many + 1)]
    return list(zip(cuts[:-1], cuts[1:]))


def _mask(positions) -> int:
    value = sum(1 << p for p in positions)
    return value - (1 << 64) if value >> 63 else value


def _near(a: str, b: str, bits: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= bits


def whole_segments(prints: DataFrame, bits: int) -> DataFrame:
    """(signature, fingerprint, part): one row per segment, uncut."""
    values = [
        F.struct(F.lit(low).alias("low"), F.col("fingerprint").bitwiseAND(F.lit(_mask(range(low, high)))).alias("value"))
        for low, high in segments(bits)
    ]
    rows = prints.select("fingerprint", "part", F.explode(F.array(*values)).alias("signature"))
    return rows.select(F.xxhash64("signature").alias("signature"), "fingerprint", "part")


def signed(prints: DataFrame, bits: int) -> DataFrame:
    """(signature, fingerprint, part): one row per bit of the fingerprint, the bit's number in the upper half and
    its segment without that bit in the lower."""
    variants = [
        F.shiftrightunsigned(F.col("fingerprint").bitwiseAND(F.lit(_mask(set(range(low, high)) - {p}))), low).bitwiseOR(F.lit(p << 32))
        for low, high in segments(bits)
        for p in range(low, high)
    ]
    return prints.select(F.explode(F.array(*variants)).alias("signature"), "fingerprint", "part")


def _cut(groups: DataFrame, bits: int) -> DataFrame:
    """Members of groups under finer signatures: the group's with one piece of the bits outside its segment."""

    def pieces(low: int, high: int) -> Column:
        rest = [p for p in range(64) if not low <= p < high]
        many = bits + 1
        cuts = [len(rest) * i // many for i in range(many + 1)]
        masks = [_mask(rest[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
        return F.array(*[F.xxhash64("signature", F.lit(j), F.col("fingerprint").bitwiseAND(F.lit(m))) for j, m in enumerate(masks)])

    bit = F.shiftright("signature", 32)
    by_segment = F.coalesce(*[F.when((bit >= low) & (bit < high), pieces(low, high)) for low, high in segments(bits)])
    return groups.select(F.explode(by_segment).alias("signature"), "fingerprint", "part")


def _stars(rows: DataFrame, bits: int) -> DataFrame:
    """Links (a, b) of the least fingerprint of every group."""
    heads = rows.groupBy("signature").agg(F.min("fingerprint").alias("a"), F.max("fingerprint").alias("most"))
    heads = heads.where("a <> most").select(F.col("signature").alias("s"), "a")
    met = rows.select("signature", F.col("fingerprint").alias("b")).join(
        heads, (F.col("signature") == F.col("s")) & (F.col("a") != F.col("b")) & _near("a", "b", bits)
    )
    return met.select("a", "b").distinct()


def _mixed(rows: DataFrame, bits: int) -> DataFrame:
    """(signature, fingerprint, part, main, members) of the groups that lie in several components, ``main`` being
    the one with most members. Of a group of two the count tells already whether they are linked; most groups that
    chance makes are no more than that.

    Rows are dealt out by signature once. A fingerprint has one row in each of its many signatures, so no group
    holds more than that share of the rows, and a group is never collected.
    """
    one = Window.partitionBy("signature")
    rows = (
        rows.withColumn("least", F.min("fingerprint").over(one))
        .withColumn("most", F.max("fingerprint").over(one))
        .withColumn("low", F.min("part").over(one))
        .withColumn("high", F.max("part").over(one))
        .withColumn("members", F.count("*").over(one))
        .where((F.col("low") != F.col("high")) & ((F.col("members") > 2) | _near("least", "most", bits)))
        .select("signature", "fingerprint", "part", "members")
        .withColumn("n", F.count("*").over(Window.partitionBy("signature", "part")))
        .withColumn("main", F.max(F.struct("n", "part")).over(one).getField("part"))
    )
    return stage_table(rows.select("signature", "fingerprint", "part", "main", "members"), "mixed")


def _across(groups: DataFrame, bits: int) -> DataFrame:
    """Links (a, b) between members of different components of a group: members outside the commonest component
    meet all others."""
    few = groups.where("part <> main").select(
        F.col("signature").alias("s"), F.col("fingerprint").alias("a"), F.col("part").alias("a_part")
    )
    all_ = groups.select("signature", F.col("fingerprint").alias("b"), F.col("part").alias("b_part"), "main")
    once = (F.col("b_part") == F.col("main")) | (F.col("a") < F.col("b"))
    met = few.join(all_, (F.col("s") == F.col("signature")) & (F.col("a_part") != F.col("b_part")) & once & _near("a", "b", bits))
    return met.select("a", "b").distinct()


def _parts(prints: DataFrame, parts: DataFrame) -> DataFrame:
    """(fingerprint, part) of all fingerprints."""
    named = prints.select("fingerprint").join(parts, F.col("fingerprint") == F.col("node"), "left")
    return stage_table(named.select("fingerprint", F.coalesce("component", "fingerprint").alias("part")), "parts")


def near_components(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """(node, component): the least fingerprint that links reach, for every one but that itself, of distinct
    fingerprints."""
    alone = prints.select("fingerprint", F.col("fingerprint").alias("part"))
    links = stage_table(_stars(whole_segments(alone, bits), bits), "links")
    groups = _mixed(signed(_parts(prints, components(links)), bits), bits)
    links = stage_table(links.union(_across(groups.where(F.col("members") <= CROWDED), bits)), "links")
    fine = _cut(groups.where(F.col("members") > CROWDED), bits)
    if not fine.isEmpty():
        links = stage_table(links.union(_stars(fine, bits)), "links")
        known = _parts(prints, components(links)).select(F.col("fingerprint").alias("f"), F.col("part").alias("now"))
        fine = fine.join(known, F.col("fingerprint") == F.col("f")).select("signature", "fingerprint", F.col("now").alias("part"))
        links = links.union(_across(_mixed(fine, bits), bits))
    return components(links)


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, bits: int = BITS
) -> DataFrame:
    """(key, fingerprint, component) of every text: the least key that its links reach, its own included."""
    rows = stage_table(with_fingerprints(docs, key, text, width), "fingerprints")
    prints = stage_table(rows.groupBy("fingerprint").agg(F.min("key").alias("label")), "distinct")
    parts = near_components(prints.select("fingerprint"), bits)
    named = prints.join(parts, F.col("fingerprint") == F.col("node"), "left")
    named = stage_table(named.select("fingerprint", "label", F.coalesce("component", "fingerprint").alias("part")), "named")
    least = named.groupBy(F.col("part").alias("p")).agg(F.min("label").alias("component"))
    named = named.join(least, F.col("part") == F.col("p")).select(F.col("fingerprint").alias("f"), "component")
    named = stage_table(named, "components")
    return rows.join(named, F.col("fingerprint") == F.col("f")).select(
        F.col("key").alias(key), "fingerprint", "component"
    )


def as_hex(fingerprint: Column) -> Column:
    """16 lower-case hex digits of a fingerprint."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
