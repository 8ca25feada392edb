"""Join of near-duplicate texts by PartEnum signatures: exact Jaccard similarity of word shingles.

Texts with the same set of shingles are one class. Sizes fall into bands wide enough that linked sets lie
in one band or in neighbouring ones. For a band the domain of shingles is cut into parts, and each part into
``PIECES`` pieces. The subset of all pieces of a part but one is a signature: the shingles in it. A set signs
for its own band, and for the next one if a set of that band can be linked with it.

Its size bounds how many shingles a set and a linked one that is no smaller can differ in. Of more parts than
half of these, one has at most one difference, so a subset of it has none: linked sets agree there. A subset
that holds no shingle says nothing. So a set takes parts in their order until so many of them are *full*, that
is, have no empty subset, and signs with what is not empty in them. Of two linked sets let the one that takes
fewer parts (the smaller one, if both take as many) be looked at: one of its full parts has a subset on which
both agree; it is not empty and the other one takes that part too, so no link is lost. A set with too few full
parts signs with all it has and goes on to another scheme, a new cut of the domain; of two linked sets, both
reach the first scheme in which one of them has full parts enough. Only a set that is short in all
``SCHEMES`` signs with empty subsets in the last: one with very few shingles, or at a low similarity.

Signatures that several classes share are written out. First every class is compared with the least one of
each of its groups, which settles large groups of near copies without their pairs. Then, of what lies in
different components but shares a signature, pairs that size or the counts of shingles per slice of the
domain rule out are skipped, and the others are compared too. Comparing reads the texts again and counts the
common shingles of both sets. Small groups list their pairs; in large ones the sets of members that may be linked
meet in blocks, which give links that join components but no pairs.

Null and empty texts have an empty set and no link. A null key takes part; its text's class is named by the
least key that is not null. Rows that repeat a key are texts of their own. Sets and shingles are told apart
by 64-bit digests. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.llm.components import components
from weftgraph.llm.words import blocks, coded, map_texts, split_words
from weftgraph.session import stage_table

PIECES = 2
SPARE = 1.2
#: Ways to cut the domain that a set tries before it signs with empty subsets; at a similarity so low that
#: differences fill half of a set, none gives full parts enough, so there is one.
SCHEMES = 12
#: Slices of the domain whose counts bound the difference of two sets from below.
SLICES = 256
COARSE = 32
#: Members of a block of a crowded group, shingles of a block of its sets, and of how many of its signatures a class
#: brings the numbers along.
BLOCK = 2048
ITEMS = 1 << 20
FIRST = 32
#: Bits of the fixed-size filter that spares most texts that are not compared.
FILTER_BITS = 1 << 26

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit digest of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every text: where each text's begin, and all of them.

    A text of fewer words than ``width`` has all its words as one shingle.
    """
    bounds, words = split_words(texts, lower=True)
    codes, distinct = coded(words)
    digests = np.array([xxhash.xxh3_64_intdigest(w) for w in distinct.to_pylist()], dtype=np.uint64)
    of = digests[codes] if len(codes) else np.zeros(0, np.uint64)
    n = np.diff(bounds)
    count = np.where(n == 0, 0, np.maximum(n - width + 1, 1))
    owner = np.repeat(np.arange(len(n)), count)
    start = np.repeat(bounds[:-1] - np.cumsum(count) + count, count) + np.arange(len(owner))
    with np.errstate(over="ignore"):
        # A shingle is the sum of its words' digests, each times an odd number for its place.
        odd = mix(np.arange(1, width + 1, dtype=np.uint64) * GOLDEN) | np.uint64(1)
        summed = np.zeros(max(len(of) - width + 1, 0), dtype=np.uint64)
        for j in range(width):
            summed += of[j : len(of) - width + 1 + j] * odd[j]
        short = n[owner] < width
        value = np.zeros(len(owner), dtype=np.uint64)
        value[~short] = summed[start[~short]]
        for i in np.flatnonzero(short):
            words_ = of[start[i] : start[i] + n[owner[i]]]
            value[i] = (words_ * odd[: len(words_)]).sum() + np.uint64(len(words_))
        value = mix(value)
        # Equal shingles of one text have equal digests with the text's number mixed in.
        marked = value ^ mix(owner.astype(np.uint64) * GOLDEN + GOLDEN)
    order = np.argsort(marked)
    marked = marked[order]
    first = np.ones(len(order), dtype=bool)
    first[1:] = marked[1:] != marked[:-1]
    new = np.zeros(len(order), dtype=bool)
    new[order[first]] = True
    owner, value = owner[new], value[new]
    return np.searchsorted(owner, np.arange(len(n) + 1)), value


def segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums modulo 2**64 between bounds; 0 where there is nothing."""
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def set_digests(bounds: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        sums = segment_sums(mix(shingles + GOLDEN), bounds)
        return mix(sums + mix(np.diff(bounds).astype(np.uint64)))


@dataclass(frozen=True)
class Bands:
    """Sizes as bands for sets that are linked when 100 * common >= percent * all."""

    percent: int
    tops: list[int] = field(default_factory=lambda: [0])

    def top(self, band: int) -> int:
        """The greatest size in a band: two links up from the least, so that links skip no band."""
        while len(self.tops) <= band:
            least = self.tops[-1] + 1
            self.tops.append(least * 100 // self.percent * 100 // self.percent)
        return self.tops[band]

    def of(self, sizes: np.ndarray) -> np.ndarray:
        while self.tops[-1] < int(sizes.max(initial=0)):
            self.top(len(self.tops))
        return np.searchsorted(self.tops, sizes)


def most_differences(sizes, percent: int):
    """Most shingles in one of two linked sets but not the other, by the size of the smaller one."""
    return sizes * (100 - percent) // percent


def signatures(bounds: np.ndarray, shingles: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of the set, signature) of every signature of every set that is not empty."""
    bands = Bands(percent)
    sizes = np.diff(bounds)
    own = bands.of(sizes)
    # Sets so small that no other one is linked with them have themselves as their signature.
    alone = np.flatnonzero((sizes > 0) & (most_differences(sizes, percent) == 0))
    texts, signed = [alone], [set_digests(*_some_sets(bounds, shingles, alone))]
    many = most_differences(sizes, percent) > 0
    for band in np.unique(own[many]).tolist():
        here = np.flatnonzero((own == band) & many)
        # What a set can at most be linked with reaches into the next band.
        up = here[sizes[here] * 100 >= percent * (bands.top(band) + 1)]
        for which, of in ((here, band), (up, band + 1)):
            for texts_, signed_ in _sign(which, bounds, shingles, of, bands):
                texts.append(texts_)
                signed.append(signed_)
    return np.concatenate(texts), np.concatenate(signed)


def _sign(which: np.ndarray, bounds: np.ndarray, shingles: np.ndarray, band: int, bands: Bands):
    """Per scheme of a band (numbers of sets, signatures), until every set has had full parts enough."""
    most = most_differences(bands.top(band), bands.percent) // 2 + 1
    parts = int(np.ceil(most * SPARE))
    cells = parts * PIECES
    number = (np.arange(cells, dtype=np.uint64) + np.uint64(1)).reshape(1, parts, PIECES)
    schemes = SCHEMES if 2 * (100 - bands.percent) < bands.percent else 1
    for scheme in range(schemes):
        if not len(which):
            return
        lengths = np.diff(bounds)[which]
        needed = most_differences(lengths, bands.percent) // 2 + 1
        with np.errstate(over="ignore"):
            salt = mix(np.full(1, (band + 1) * SCHEMES + scheme, np.uint64) * GOLDEN)[0]
            ends, values = _some_sets(bounds, shingles, which)
            owner = np.repeat(np.arange(len(which)), lengths)
            cell = (mix(values ^ salt) >> np.uint64(32)) * np.uint64(cells) >> np.uint64(32)
            place = owner * cells + cell.astype(np.int64)
            order = np.argsort(place, kind="stable")
            at = np.searchsorted(place[order], np.arange(len(which) * cells + 1))
            sums = segment_sums(mix(values + salt)[order], at).reshape(len(which), parts, PIECES)
            counts = np.diff(at).reshape(len(which), parts, PIECES)
            # A subset of all pieces but one; its number, its part and its scheme are in the signature.
            kept_sums = sums.sum(axis=2, dtype=np.uint64)[:, :, None] - sums
            holds = counts.sum(axis=2)[:, :, None] > counts
            signed = mix(kept_sums ^ mix(number * GOLDEN + salt))
        full = holds.all(axis=2)
        through = np.cumsum(full, axis=1)
        emit = holds & (through - full < needed[:, None])[:, :, None]
        short = through[:, -1] < needed
        if scheme == schemes - 1:
            emit |= (short[:, None] & (np.arange(parts) < needed[:, None]))[:, :, None]
        yield np.broadcast_to(which[:, None, None], emit.shape)[emit], signed[emit]
        which = which[short]


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64), pa.int64())


def _classes(docs: DataFrame, width: int, key: str, text: str) -> DataFrame:
    """(key, size, class, slices) of every text; a small row, whatever the text."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                bounds, shingles = shingle_sets(part.column("text"), width)
                sizes = np.diff(bounds)
                counts = pa.array([row.tobytes() for row in slice_counts(bounds, shingles)], pa.binary())
                columns = [part.column("key"), pa.array(sizes, pa.int64()), _long(set_digests(bounds, shingles)), counts]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "size", "class", "slices"])

    rows = docs.select(docs[f"`{key}`"].alias("key"), docs[f"`{text}`"].alias("text"))
    return map_texts(rows, run, f"key {kind}, size bigint, class bigint, slices binary")


def _signed(docs: DataFrame, width: int, percent: int, text: str) -> DataFrame:
    """(class, signature); a task signs for a class once, however many copies it meets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            for part in blocks(batch, "text"):
                bounds, shingles = shingle_sets(part.column("text"), width)
                digests = set_digests(bounds, shingles)
                new = _first_met(digests, met)
                owner, signed = signatures(*_some_sets(bounds, shingles, new), percent)
                for at in range(0, len(owner), 200_000):
                    cut = slice(at, at + 200_000)
                    columns = [_long(digests[new][owner[cut]]), _long(signed[cut])]
                    yield pa.RecordBatch.from_arrays(columns, names=["class", "signature"])

    return map_texts(docs.select(docs[f"`{text}`"].alias("text")), run, "class bigint, signature bigint")


def _first_met(digests: np.ndarray, met: set[int]) -> np.ndarray:
    new = []
    for i, d in enumerate(digests.tolist()):
        if d not in met:
            met.add(d)
            new.append(i)
    return np.array(new, dtype=np.int64)


def _some_sets(bounds: np.ndarray, shingles: np.ndarray, which: np.ndarray):
    lengths = np.diff(bounds)[which]
    ends = np.concatenate(([0], np.cumsum(lengths)))
    take = np.repeat(bounds[which] - ends[:-1], lengths) + np.arange(ends[-1])
    return ends, shingles[take]


def _marks(wanted: DataFrame, column: str, sizes: DataFrame) -> np.ndarray:
    """A fixed number of bits, one of which stands for the key of a wanted class. Other keys may share it."""
    labels = wanted.join(sizes.select(F.col("class").alias("w"), "label"), F.col(column) == F.col("w"))
    rows = (
        labels.select(F.pmod(F.xxhash64("label"), F.lit(FILTER_BITS)).alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
        .toArrow()
    )
    bits = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    bits[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return bits


def _marked(bits: np.ndarray, digests: np.ndarray) -> np.ndarray:
    bit = digests.view(np.uint64) % np.uint64(FILTER_BITS)
    words = bits.view(np.uint64)[(bit >> np.uint64(6)).astype(np.int64)]
    return (words >> (bit & np.uint64(63))) & np.uint64(1) == 1


@dataclass(frozen=True)
class Corpus:
    """The texts of a join, and what of their sets it needs to know."""

    docs: DataFrame
    key: str
    text: str
    width: int
    percent: int

    def sets(self, wanted: DataFrame, column: str, sizes: DataFrame) -> DataFrame:
        """(class, shingles) of the wanted classes and some more, one row each, from the text with the
        class's least key."""
        shared = self.docs.sparkSession.sparkContext.broadcast(_marks(wanted, column, sizes))
        width = self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            met: set[int] = set()
            for batch in batches:
                keys = batch.column("mark").to_numpy()
                batch = batch.take(pa.array(np.flatnonzero(_marked(shared.value, keys))))
                for part in blocks(batch, "text") if batch.num_rows else ():
                    bounds, shingles = shingle_sets(part.column("text"), width)
                    digests = set_digests(bounds, shingles)
                    which = np.flatnonzero(np.diff(bounds) > 0)
                    which = which[_first_met(digests[which], met)]
                    ends, items = _some_sets(bounds, shingles, which)
                    made = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _long(items))
                    yield pa.RecordBatch.from_arrays([_long(digests[which]), made], names=["class", "shingles"])

        key, text = self.docs[f"`{self.key}`"], self.docs[f"`{self.text}`"]
        rows = self.docs.select(F.xxhash64(key).alias("mark"), text.alias("text"))
        rows = map_texts(rows, run, "class bigint, shingles array<bigint>")
        return rows.groupBy("class").agg(F.any_value("shingles").alias("shingles"))


def slice_counts(ends: np.ndarray, items: np.ndarray) -> np.ndarray:
    """Shingles of every set per slice of the domain, none above 255."""
    owner = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    place = owner * SLICES + (items % np.uint64(SLICES)).astype(np.int64)
    counts = np.bincount(place, minlength=(len(ends) - 1) * SLICES)
    return np.minimum(counts, 255).astype(np.uint8).reshape(-1, SLICES)


def _linked(corpus: Corpus, pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes that are linked. Of those that sizes and slices don't rule out, the sets
    are compared shingle by shingle.

    A class with many pairs has its set copied to as many tasks as ``BLOCK`` pairs each need.
    """
    percent = corpus.percent
    ends = [
        sizes.select(*[F.col(c).alias(f"{x}_{c}") for c in ("class", "size", "slices")]) for x in "ab"
    ]
    known = pairs.join(ends[0], F.col("a") == F.col("a_class")).join(ends[1], F.col("b") == F.col("b_class"))
    known = known.where(100 * F.least("a_size", "b_size") >= percent * F.greatest("a_size", "b_size"))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (as_counts(batch.column(f"{x}_slices")) for x in "ab")
            both = batch.column("a_size").to_numpy() + batch.column("b_size").to_numpy()
            apart = np.abs(left - right).sum(axis=1)
            kept = pa.array(np.flatnonzero(apart * (100 + percent) <= both * (100 - percent)))
            yield pa.RecordBatch.from_arrays([batch.column("a").take(kept), batch.column("b").take(kept)], names=["a", "b"])

    known = known.select("a", "b", "a_size", "b_size", "a_slices", "b_slices")
    pairs = stage_table(known.mapInArrow(fit, "a bigint, b bigint"), "pairs")
    many = pairs.groupBy(F.col("a").alias("of")).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("tasks"))
    many = stage_table(many, "pair-tasks")
    dealt = pairs.join(many, F.col("a") == F.col("of")).withColumn(
        "task", F.pmod(F.xxhash64("b"), F.col("tasks")).cast("int")
    )
    right = corpus.sets(pairs, "b", sizes).select(F.col("class").alias("r"), F.col("shingles").alias("right"))
    left = (
        corpus.sets(many, "of", sizes)
        .select(F.col("class").alias("l"), F.col("shingles").alias("left"))
        .join(many, F.col("l") == F.col("of"))
        .select("l", "left", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("l_task"))
    )
    common = F.size(F.array_intersect("left", "right"))
    every = F.size("left") + F.size("right") - common
    both = dealt.join(right, F.col("b") == F.col("r")).join(
        left, (F.col("a") == F.col("l")) & (F.col("task") == F.col("l_task"))
    )
    return stage_table(both.where(100 * common >= percent * every).select("a", "b"), "linked")


def _groups(docs: DataFrame, width: int, percent: int, text: str) -> DataFrame:
    """(signature, class, least) of signatures that several classes share."""
    one = Window.partitionBy("signature")
    return stage_table(
        _signed(docs, width, percent, text)
        .withColumn("least", F.min("class").over(one))
        .withColumn("most", F.max("class").over(one))
        .where("least <> most")
        .select("signature", "class", "least"),
        "signatures",
    )


def _apart(groups: DataFrame, parts: DataFrame) -> DataFrame:
    """(signature, class, part, members) of groups whose classes lie in different components."""
    one = Window.partitionBy("signature")
    named = groups.join(parts.withColumnRenamed("node", "n"), F.col("class") == F.col("n"), "left")
    named = named.select("signature", "class", F.coalesce("component", "class").alias("part"))
    return stage_table(
        named.withColumn("low", F.min("part").over(one))
        .withColumn("high", F.max("part").over(one))
        .withColumn("members", F.count("*").over(one))
        .where("low <> high")
        .select("signature", "class", "part", "members"),
        "apart",
    )


#: Groups up to this size give their pairs by a list, which is in proportion; larger ones are compared in blocks.
FEW = 48


def _few_pairs(apart: DataFrame) -> DataFrame:
    """All pairs across components of the small groups."""
    lists = (
        apart.where(F.col("members") <= FEW)
        .groupBy("signature")
        .agg(F.sort_array(F.collect_list(F.struct("class", "part"))).alias("of"))
    )
    across = F.expr(
        "flatten(transform(of, x -> transform(filter(of, y -> y.class > x.class and y.part <> x.part), "
        "y -> struct(x.class as a, y.class as b))))"
    )
    return lists.select(F.explode(across).alias("p")).select("p.a", "p.b").distinct()


def _meeting(many: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """(signature, class, part, size): members of the large groups that may be linked with one of another component,
    by sizes and slices. A pair that shares several of its classes' first signatures meets at the least of them alone.

    Every block of a group meets every other in a task of its own.
    """
    firsts = many.groupBy(F.col("class").alias("c")).agg(F.slice(F.sort_array(F.collect_set("signature")), 1, FIRST).alias("firsts"))
    known = sizes.select(F.col("class").alias("c"), "size", "slices").join(firsts, "c")
    blocks_ = F.ceil(F.col("members") / BLOCK).cast("int")
    columns = ["own", "class", "part", "size", "slices", "firsts"]
    rows = _met(many.join(known, F.col("class") == F.col("c")), blocks_, columns)

    def run(table: pa.Table) -> pa.Table:
        get = lambda name: table.column(name).to_numpy()
        two = table.column("low")[0].as_py() != table.column("high")[0].as_py()
        met = meeting(
            get("signature")[0], table.column("firsts").to_pylist(), get("part"), get("size"),
            as_counts(table.column("slices")), get("own"), two, percent,
        )
        return table.select(["signature", "class", "part", "size"]).take(pa.array(met))

    kind = "signature bigint, class bigint, part bigint, size bigint"
    return stage_table(rows.groupBy("signature", "low", "high").applyInArrow(run, kind).distinct(), "meeting")


def _met(members: DataFrame, blocks_: Column, columns: list[str]) -> DataFrame:
    """Members of groups once for every two blocks of their group, ``low`` and ``high``, that they belong to."""
    return (
        members.withColumn("own", F.pmod(F.xxhash64("class"), blocks_).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks_ - 1)))
        .select("signature", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), *columns)
    )


def _block_links(corpus: Corpus, many: DataFrame, sizes: DataFrame) -> DataFrame:
    """(a, b): links across components of the large groups, fewer in a block than it has members; what they join is
    what all links of the group join.

    The sets themselves go to the blocks, of about ``ITEMS`` shingles each, and are compared there.
    """
    percent = corpus.percent
    met = _meeting(many, sizes, percent)
    total = met.groupBy(F.col("signature").alias("s")).agg(F.ceil(F.sum("size") / ITEMS).cast("int").alias("blocks"))
    rows = _met(met.join(total, F.col("signature") == F.col("s")), F.col("blocks"), ["own", "class", "part"])
    sets = corpus.sets(met, "class", sizes).select(F.col("class").alias("c"), "shingles")

    def run(table: pa.Table) -> pa.Table:
        get = lambda name: table.column(name).to_numpy()
        two = table.column("low")[0].as_py() != table.column("high")[0].as_py()
        lists = table.column("shingles").combine_chunks()
        ends = lists.offsets.to_numpy().astype(np.int64)
        items = lists.values.to_numpy().view(np.uint64)
        a, b = links_between(get("class"), get("part"), ends, items, get("own"), two, percent)
        return pa.Table.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    both = rows.join(sets, F.col("class") == F.col("c")).drop("c")
    found = both.groupBy("signature", "low", "high").applyInArrow(run, "a bigint, b bigint")
    return stage_table(found.distinct(), "linked")


def as_counts(slices: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(slices.to_pylist()), np.uint8).reshape(-1, SLICES).astype(np.int16)


def coarse_counts(slices: np.ndarray) -> np.ndarray:
    """Sums over neighbouring slices, which differ by no more than the slices do, and rule most pairs out already."""
    return slices.reshape(len(slices), COARSE, -1).sum(axis=2, dtype=np.int16)


def may_link(i: int, rest: np.ndarray, sizes: np.ndarray, counts: tuple[np.ndarray, ...], percent: int) -> np.ndarray:
    """Those of ``rest`` that neither sizes nor counts per slice keep from being linked with ``i``."""
    small, great = np.minimum(sizes[rest], sizes[i]), np.maximum(sizes[rest], sizes[i])
    rest = rest[100 * small >= percent * great]
    for count in counts:
        apart = np.abs(count[rest] - count[i]).sum(axis=1)
        rest = rest[apart * (100 + percent) <= (sizes[rest] + sizes[i]) * (100 - percent)]
    return rest


def meeting(signature, firsts, parts, sizes, slices, own, two: bool, percent: int) -> np.ndarray:
    """Members of a block that meet one of another part there, which they may be linked with; with ``two``, one of the
    other block. Two that both meet others already are not looked at."""
    counts = (coarse_counts(slices), slices)
    firsts = [set(f) for f in firsts]
    met = np.zeros(len(parts), dtype=bool)
    for i in range(len(parts) - 1):
        after = slice(i + 1, None)
        open_ = parts[after] != parts[i]
        if two:
            open_ &= own[after] != own[i]
        if met[i]:
            open_ &= ~met[after]
        for j in may_link(i, np.flatnonzero(open_) + i + 1, sizes, counts, percent).tolist():
            if min(firsts[i] & firsts[j], default=signature) == signature:
                met[i] = met[j] = True
    return np.flatnonzero(met)


def links_between(classes, parts, ends, items, own, two: bool, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b), a < b, across different parts; parts that one joins count as one from then on. With ``two``, only
    across the two blocks."""
    sizes = np.diff(ends)
    slices = slice_counts(ends - ends[0], items[ends[0] : ends[-1]]).astype(np.int16)
    counts = (coarse_counts(slices), slices)
    parts = parts.copy()
    out_a, out_b = [], []
    for i in range(len(classes) - 1):
        after = slice(i + 1, None)
        open_ = parts[after] != parts[i]
        if two:
            open_ &= own[after] != own[i]
        rest = may_link(i, np.flatnonzero(open_) + i + 1, sizes, counts, percent)
        if not len(rest):
            continue
        one = np.sort(items[ends[i] : ends[i + 1]])
        bounds, others = _some_sets(ends, items, rest)
        at = np.minimum(np.searchsorted(one, others), len(one) - 1)
        common = np.diff(np.concatenate(([0], np.cumsum(one[at] == others)))[bounds])
        rest = rest[100 * common >= percent * (sizes[rest] + sizes[i] - common)]
        _, first = np.unique(parts[rest], return_index=True)
        rest = rest[first]
        parts[np.isin(parts, parts[rest])] = parts[i]
        out_a.append(np.minimum(classes[rest], classes[i]))
        out_b.append(np.maximum(classes[rest], classes[i]))
    if not out_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_a), np.concatenate(out_b)


def _resolve(docs: DataFrame, key: str, text: str, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(key, size, class) of every text, and (class, label, part): every class that is not empty with its
    least key and its component. Both are written tables."""
    corpus = Corpus(docs, key, text, width, percent)
    rows = stage_table(_classes(docs, width, key, text), "texts", compression="zstd")
    same = [F.min("key").alias("label"), F.max("size").alias("size"), F.any_value("slices").alias("slices")]
    sizes = stage_table(rows.where("size > 0").groupBy("class").agg(*same), "classes", compression="zstd")
    groups = _groups(docs, width, percent, text)
    stars = groups.where("class <> least").select(F.col("least").alias("a"), F.col("class").alias("b")).distinct()
    links = _linked(corpus, stars, sizes)
    parts = components(links)
    apart = _apart(groups, parts)
    more = _linked(corpus, _few_pairs(apart), sizes)
    rest = _block_links(corpus, apart.where(F.col("members") > FEW), sizes)
    parts = components(links.union(more).union(rest))
    named = sizes.join(parts, F.col("class") == F.col("node"), "left").select(
        "class", "label", F.coalesce("component", "class").alias("part")
    )
    return rows.drop("slices"), stage_table(named, "components")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """(key, size, component) of every text: the number of its shingles and the least key its links reach."""
    rows, named = _resolve(docs, key, text, width, percent)
    least = named.groupBy(F.col("part").alias("p")).agg(F.min("label").alias("component"))
    named = named.join(least, F.col("part") == F.col("p")).select(F.col("class").alias("c"), "component")
    named = stage_table(named, "components")
    return rows.join(named, (F.col("class") == F.col("c")) & (F.col("size") > 0), "left").select(
        F.col("key").alias(key), "size", F.when(F.col("size") > 0, F.col("component")).otherwise(F.col("key")).alias("component")
    )


def one_per_group(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """The rows of ``docs``, one of each group of near duplicates: the one with the least key, null last; of
    several with that key and that set, one. Rows without words are in no group and stay.

    A task passes on a row only if its key is less than those of all copies it has met, so a text with many
    copies has few rows left when they are brought together.
    """
    _, named = _resolve(docs, key, text, width, percent)
    rank = F.struct(F.col("label").isNull(), "label", "class")
    keepers = named.groupBy("part").agg(F.min_by(F.struct("class", "label"), rank).alias("k"))
    keepers = stage_table(keepers.select("k.class", F.col("k.label").alias("label")), "keepers")
    # Each column goes along once, under a name of its own.
    own = [f"c{i}" for i in range(len(docs.columns))]
    rows, at_key, at_text = docs.toDF(*own), own[docs.columns.index(key)], own[docs.columns.index(text)]
    fields = [*rows.schema.fields, T.StructField("size", T.LongType()), T.StructField("digest", T.LongType())]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[int, object] = {}
        for batch in batches:
            for part in blocks(batch, at_text):
                bounds, shingles = shingle_sets(part.column(at_text), width)
                sizes, digests = np.diff(bounds), set_digests(bounds, shingles)
                kept = []
                for i, (n, d, k) in enumerate(zip(sizes.tolist(), digests.tolist(), part.column(at_key).to_pylist())):
                    if n and d in least and (k is None or (least[d] is not None and k >= least[d])):
                        continue
                    least[d] = k
                    kept.append(i)
                take = pa.array(kept, pa.int64())
                columns = [*part.take(take).columns, pa.array(sizes).take(take), _long(digests).take(take)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    made = map_texts(rows, run, T.StructType(fields))
    # Rows without words share a digest but are no group: they are spread by their key.
    made = made.withColumn("at", F.when(F.col("size") > 0, F.col("digest")).otherwise(F.xxhash64(at_key)))
    both = made.join(keepers, (F.col("at") == F.col("class")) & (F.col("size") > 0), "left")
    kept = both.where((F.col("size") == 0) | (F.col("class").isNotNull() & F.col(at_key).eqNullSafe(F.col("label"))))
    nth = F.row_number().over(Window.partitionBy("at", at_key).orderBy(at_text))
    kept = kept.withColumn("nth", nth).where("size = 0 or nth = 1")
    return kept.select(*[F.col(o).alias(c) for o, c in zip(own, docs.columns)])
