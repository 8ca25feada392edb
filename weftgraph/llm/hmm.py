"""Hidden Markov language model: Baum-Welch over all training texts, exact likelihood by the forward recursion.

A state emits one of ``CLASSES`` word classes (by a hash of the word; the end of a text is a class of its
own), and a class emits its words by their smoothed counts over all training texts. So what is broadcast,
states times classes, has a fixed size however large the vocabulary; the counts of words stay a table.
The likelihood of a text is that of its classes under the hidden chain times that of its words in their
classes, an unseen word taking the share that its class keeps for unseen ones.

Texts are first packed in chunks of bounded size, each with its own list of words. A chunk's counts are
added up inside it before they meet those of other chunks, and the totals come back per chunk, so a word
costs a row per chunk and not per occurrence.

A text of more than ``WHOLE`` tokens is cut into segments; for all segments at once the chain's transfer
matrices are multiplied up, and combining them in order gives the exact forward (and backward) vectors at
every segment's ends. A shorter text is one segment, whose ends are known. Every round takes all training texts.

A null text is empty: one end token. A null key is scored but never learned from. Repeated rows are learned
from as often as they occur and scored alike. Without training texts every token is unknown with
probability 1. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.llm.words import blocks, coded, map_texts, split_words
from weftgraph.session import stage_table

STATES = 6
CLASSES = 16_384
ROUNDS = 7
#: Bytes of text in a chunk, about; a longer text is a chunk of its own.
CHUNK_BYTES = 6 << 20
#: A word's class and a mark stand in so many bits below its count.
TOTAL_BITS = 16
#: A task numbers its chunks in this many bits; with the task's own number a chunk's is unique.
CHUNK_BITS = 32
SEGMENT = 64
#: Tokens of a text that is not cut.
WHOLE = 1024
#: Weight, in tokens, of the overall class frequencies in a state's emissions is the number of classes the
#: state has met, and at least this.
LEAST_PRIOR = 50
SEED = 1970

#: No word is empty, so the empty text can stand for the end.
END = ""


def pack(docs: DataFrame, key: str, text: str, learn: str) -> DataFrame:
    """Chunks: keys, whether each text is learned from, where each text's tokens end, the tokens as numbers of the chunk's words, the words' classes, the words, and how often each
    occurs in texts that are learned from. A chunk is numbered by its task and its place there."""
    kind = docs.schema[key].dataType
    schema = T.StructType(
        [
            T.StructField("chunk", T.LongType()),
            T.StructField("keys", T.ArrayType(kind)),
            T.StructField("learned", T.BinaryType()),
            T.StructField("ends", T.ArrayType(T.IntegerType())),
            T.StructField("codes", T.BinaryType()),
            T.StructField("kinds", T.BinaryType()),
            T.StructField("words", T.ArrayType(T.StringType())),
            T.StructField("counts", T.ArrayType(T.IntegerType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << CHUNK_BITS
        for batch in batches:
            for part in blocks(batch, text, CHUNK_BYTES):
                bounds, flat = split_words(part.column(text), lower=True)
                codes, words = coded(flat)
                ends = bounds[1:] + np.arange(1, len(bounds))
                tokens = np.full(int(ends[-1]), len(words), dtype=np.int64)
                inside = np.ones(len(tokens), dtype=bool)
                inside[ends - 1] = False
                tokens[inside] = codes
                learned = part.column(learn).to_numpy(zero_copy_only=False).astype(bool)
                each = np.repeat(learned, np.diff(ends, prepend=0))
                counts = np.bincount(tokens[each], minlength=len(words) + 1)
                kinds = np.array([class_of(w) for w in words.to_pylist()] + [CLASSES], dtype=np.uint16)
                # Frequent words get small numbers, most bytes of which are zero.
                order = np.argsort(-np.bincount(tokens, minlength=len(kinds)), kind="stable")
                number_of = np.empty(len(order), dtype=np.int64)
                number_of[order] = np.arange(len(order))
                tokens, kinds, counts = number_of[tokens], kinds[order], counts[order]
                words = pa.concat_arrays([words.cast(pa.string()), pa.array([END])]).take(pa.array(order))
                row = [
                    pa.array([number], pa.int64()),
                    _one(part.column(key)),
                    _bytes(learned),
                    _one(pa.array(ends, pa.int32())),
                    _bytes(planes(tokens)),
                    _bytes(kinds),
                    _one(words),
                    _one(pa.array(counts, pa.int32())),
                ]
                number += 1
                yield pa.RecordBatch.from_arrays(row, names=schema.names)

    return stage_table(map_texts(docs.select(key, text, learn), run, schema, 64 << 20), "model-chunks", compression="zstd")


def _bytes(values: np.ndarray) -> pa.Array:
    return pa.array([values.tobytes()], pa.binary())


def planes(tokens: np.ndarray) -> np.ndarray:
    """The lowest bytes of all numbers, then the next ones, and so on: zeros lie together and compress."""
    return np.ascontiguousarray(tokens.astype("<u4").view(np.uint8).reshape(-1, 4).T)


def from_planes(data) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _one(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def class_of(word: str) -> int:
    return zlib.crc32(word.encode()) % CLASSES if word else CLASSES


def word_totals(chunks: DataFrame) -> DataFrame:
    """(of, words): for every chunk its words in order, each as one number: its count over all chunks, its
    class, and whether this chunk is the first that holds it. A word has one row per chunk on the way."""
    words = chunks.select("chunk", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w"))
    words = words.select("chunk", "at", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    one = Window.partitionBy("word")
    kind = F.when(F.col("word") == END, CLASSES).otherwise(F.crc32(F.col("word").cast("binary")) % CLASSES)
    first = (F.row_number().over(one.orderBy("chunk")) == 1).cast("long")
    number = F.shiftleft(F.sum("n").over(one), TOTAL_BITS) + F.shiftleft(kind.cast("long"), 1) + first
    gathered = (
        words.select("chunk", F.struct("at", number.alias("number")).alias("w"))
        .groupBy(F.col("chunk").alias("of"))
        .agg(F.sort_array(F.collect_list("w")).alias("w"))
        .select("of", F.col("w.number").alias("words"))
    )
    return stage_table(gathered, "model-words", compression="zstd")


class Chain:
    """Parameters of the hidden chain, and the recursions over many texts at once."""

    def __init__(self, start: np.ndarray, step: np.ndarray, emit: np.ndarray):
        self.start, self.step, self.emit = start, step, emit

    def segments(self, ends: np.ndarray):
        """(first token, length, text, number in the text, whether the text is cut) per segment, longest first."""
        begins = np.concatenate(([0], ends[:-1]))
        cut = ends - begins > WHOLE
        per_text = np.where(cut, -(-(ends - begins) // SEGMENT), 1)
        text = np.repeat(np.arange(len(ends)), per_text)
        number = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        at = begins[text] + number * SEGMENT
        length = np.minimum(np.where(cut[text], SEGMENT, WHOLE), ends[text] - at)
        order = np.argsort(-length, kind="stable")
        return at[order], length[order], text[order], number[order], cut[text[order]]

    def transfers(self, classes: np.ndarray, at, length, number, kind=np.float64):
        """Per segment the product of its steps, scaled, and the log of the scale. A first segment begins
        with the start distribution whatever comes in."""
        k = len(self.start)
        step, emit = self.step.astype(kind), self.emit.astype(kind)
        product = np.empty((len(at), k, k), dtype=kind)
        product[:] = np.where((number == 0)[:, None, None], self.start.astype(kind)[None, None, :], step[None])
        product *= emit[classes[at]][:, None, :]
        scale = np.zeros(len(at))
        for t in range(1, int(length.max(initial=0))):
            n = int(np.searchsorted(-length, -t, side="left"))
            moved = (product[:n].reshape(-1, k) @ step).reshape(n, k, k)
            moved *= emit[classes[at[:n] + t]][:, None, :]
            product[:n] = moved
            if t % 4 == 0:
                self._scale(product[:n], scale[:n])
        self._scale(product, scale)
        return product, scale

    @staticmethod
    def _scale(product: np.ndarray, scale: np.ndarray) -> None:
        most = product.max(axis=(1, 2))
        product /= most[:, None, None]
        scale += np.log(most)

    def forward(self, product, scale, text, number, texts: int):
        """Vector that comes into every segment, and the log likelihood of every text."""
        k = len(self.start)
        vector, likelihood = np.full((texts, k), 1.0 / k), np.zeros(texts)
        incoming = np.empty((len(text), k))
        for rows in _by_number(number):
            which = text[rows]
            incoming[rows] = vector[which]
            moved = np.einsum("si,sij->sj", vector[which], product[rows])
            total = moved.sum(axis=1)
            vector[which] = moved / total[:, None]
            likelihood[which] += np.log(total) + scale[rows]
        return incoming, likelihood

    def backward(self, product, text, number, texts: int) -> np.ndarray:
        k = len(self.start)
        vector, outgoing = np.ones((texts, k)), np.empty((len(text), k))
        for rows in reversed(_by_number(number)):
            which = text[rows]
            outgoing[rows] = vector[which]
            moved = np.einsum("sij,sj->si", product[rows], vector[which])
            vector[which] = moved / moved.sum(axis=1)[:, None]
        return outgoing

    def likelihood(self, classes: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Exact natural log likelihood of every text's classes."""
        at, length, text, number, cut = self.segments(ends)
        product, scale = self.transfers(classes, at[cut], length[cut], number[cut])
        found = self.forward(product, scale, text[cut], number[cut], len(ends))[1]
        at, length, text = at[~cut], length[~cut], text[~cut]
        vector, scale = self.start * self.emit[classes[at]], np.zeros(len(at))
        for t in range(int(length.max(initial=0))):
            n = int(np.searchsorted(-length, -t, side="left"))
            if t:
                vector[:n] = vector[:n] @ self.step * self.emit[classes[at[:n] + t]]
            if t % 4 == 0:
                total = vector[:n].sum(axis=1)
                vector[:n] /= total[:, None]
                scale[:n] += np.log(total)
        found[text] = scale + np.log(vector.sum(axis=1))
        return found

    def expected(self, classes: np.ndarray, ends: np.ndarray):
        """Expected counts of starts, steps and emissions over all texts."""
        kind = np.float32
        k = len(self.start)
        at, length, text, number, cut = self.segments(ends)
        product, scale = self.transfers(classes, at[cut], length[cut], number[cut], kind)
        product = product.astype(np.float64)
        incoming, outgoing = np.zeros((len(at), k), kind), np.ones((len(at), k), kind)
        incoming[cut] = self.forward(product, scale, text[cut], number[cut], len(ends))[0]
        outgoing[cut] = self.backward(product, text[cut], number[cut], len(ends))
        first = number == 0
        step, emit, start = self.step.astype(kind), self.emit.astype(kind), self.start.astype(kind)
        longest = int(length.max(initial=0))
        active = [int(np.searchsorted(-length, -t, side="left")) for t in range(longest)]
        every = [classes[at[:n] + t].astype(np.intp) for t, n in enumerate(active)]
        shown = [emit.take(where, axis=0, mode="clip") for where in every]
        ahead, one = [np.empty((0, k), kind)] * longest, np.ones((k, 1), kind)
        vector = np.where(first[:, None], start[None, :], incoming @ step)
        for t in range(longest):
            n = active[t]
            vector = vector[:n] if t == 0 else vector[:n] @ step
            vector = vector * shown[t]
            vector /= vector @ one
            ahead[t] = vector
        steps, emissions = np.zeros((k, k)), np.zeros((len(self.emit), k))
        starts = np.zeros(k)
        after = outgoing.copy()
        for t in range(longest - 1, -1, -1):
            n = active[t]
            now = after[:n]
            state = ahead[t] * now
            state /= state @ one
            ahead[t] = state
            seen = np.multiply(shown[t], now, out=shown[t])
            if t:
                before = ahead[t - 1][:n]
            else:
                starts += state[first[:n]].sum(axis=0)
                before = np.where(first[:n, None], 0, incoming[:n])
            reach = before @ step
            weight = (reach * seen) @ one
            np.divide(before, weight, out=before if t == 0 else (before := before.copy()), where=weight > 0)
            steps += (before.T @ seen).astype(np.float64)
            back = seen @ step.T
            np.divide(back, back @ one, out=now)
        every = np.concatenate(every) if longest else np.zeros(0, int)
        states = np.concatenate(ahead) if longest else np.zeros((0, k))
        for s in range(k):
            emissions[:, s] = np.bincount(every, weights=states[:, s], minlength=len(self.emit))
        return starts, steps * self.step, emissions


def _by_number(number: np.ndarray) -> list[np.ndarray]:
    """Positions of the first segments of all texts, of the second ones, and so on."""
    order = np.argsort(number, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(number[order])) + 1) if len(order) else []


def unpack(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token numbers, their ends, class of every word) of a chunk."""
    kinds = np.frombuffer(batch.column("kinds")[i].as_buffer(), dtype=np.uint16)
    codes = from_planes(batch.column("codes")[i].as_buffer())
    return codes, batch.column("ends")[i].values.to_numpy().astype(np.int64), kinds


def some_texts(tokens: np.ndarray, ends: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.diff(ends, prepend=0)
    return tokens[np.repeat(chosen, lengths)], np.cumsum(lengths[chosen])


def fit(chunks: DataFrame, classes: np.ndarray, states: int = STATES) -> Chain:
    """``classes``: tokens of every class in all training texts, from which the first emissions are made by
    random factors. Only sums, states times classes of them, come to the driver."""
    share = (classes + 0.5) / (classes + 0.5).sum()
    noise = np.random.default_rng(SEED)
    emit = share[:, None] * np.exp(noise.standard_normal((len(classes), states)))
    chain = Chain(
        np.full(states, 1 / states), np.full((states, states), 0.1 / states) + 0.9 * np.eye(states), emit / emit.sum(axis=0)
    )
    for _ in range(ROUNDS):
        chain = _round(chunks, chain, share)
    return chain


def _round(chunks: DataFrame, chain: Chain, share: np.ndarray) -> Chain:
    k = len(chain.start)
    shared = chunks.sparkSession.sparkContext.broadcast((chain.start, chain.step, chain.emit))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = Chain(*shared.value)
        starts, steps, emissions = np.zeros(k), np.zeros((k, k)), np.zeros((len(chain.emit), k))
        for batch in batches:
            for i in range(batch.num_rows):
                chosen = np.frombuffer(batch.column("learned")[i].as_buffer(), dtype=bool)
                if not chosen.any():
                    continue
                tokens, ends, kinds = unpack(batch, i)
                tokens, ends = some_texts(tokens, ends, chosen)
                made = chain.expected(kinds[tokens], ends)
                starts, steps, emissions = starts + made[0], steps + made[1], emissions + made[2]
        used = np.flatnonzero(emissions.sum(axis=1))
        kind = np.concatenate([np.zeros(1, int), np.ones(k, int), np.full(len(used), 2)])
        place = np.concatenate([np.zeros(1, int), np.arange(k), used])
        values = np.concatenate([starts[None], steps, emissions[used]])
        columns = [pa.array(kind, pa.int32()), pa.array(place, pa.int32()), *[pa.array(values[:, s]) for s in range(k)]]
        yield pa.RecordBatch.from_arrays(columns, names=names)

    sums = [f"s{i}" for i in range(k)]
    names = ["kind", "place", *sums]
    made = chunks.mapInArrow(run, "kind int, place int, " + ", ".join(f"{s} double" for s in sums))
    rows = made.groupBy("kind", "place").agg(*[F.sum(s).alias(s) for s in sums]).toArrow()
    kind, place = rows.column("kind").to_numpy(), rows.column("place").to_numpy()
    values = np.stack([rows.column(s).to_numpy() for s in sums], axis=1) if len(kind) else np.zeros((0, k))
    starts, steps, emissions = np.zeros(k), np.zeros((k, k)), np.zeros((len(share), k))
    for target, which in ((steps, 1), (emissions, 2)):
        target[place[kind == which]] = values[kind == which]
    starts += values[kind == 0].sum(axis=0)
    if not emissions.sum():
        return chain
    starts, steps = starts + 0.1, steps + 0.1
    # The more classes a state has met for its tokens, the more it leaves to those it has not met.
    emissions = emissions + np.maximum((emissions > 0.5).sum(axis=0), LEAST_PRIOR) * share[:, None]
    return Chain(starts / starts.sum(), steps / steps.sum(axis=1, keepdims=True), emissions / emissions.sum(axis=0))


SCORES = "n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def score(docs: DataFrame, learn: str, key: str = "doc_id", text: str = "text", states: int = STATES) -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score) of every text, by the model of the texts
    for which the boolean column ``learn`` holds."""
    chunks = pack(docs, key, text, learn)
    totals = word_totals(chunks)
    stats = (
        totals.select(F.explode("words").alias("w"))
        .where((F.col("w").bitwiseAND(1) == 1) & (F.col("w") >= 1 << TOTAL_BITS))
        .select(
            F.shiftright("w", TOTAL_BITS).alias("total"),
            F.shiftright(F.col("w").bitwiseAND((1 << TOTAL_BITS) - 1), 1).alias("class"),
        )
        .groupBy("class")
        .agg(F.sum("total").alias("tokens"), F.count("*").alias("words"))
        .toArrow()
    )
    tokens, words = np.zeros(CLASSES + 1), np.zeros(CLASSES + 1)
    tokens[stats.column("class").to_numpy()] = stats.column("tokens").to_numpy()
    words[stats.column("class").to_numpy()] = stats.column("words").to_numpy()
    chain = fit(chunks.select("learned", "ends", "codes", "kinds"), tokens, states)
    shared = docs.sparkSession.sparkContext.broadcast((chain.start, chain.step, chain.emit, tokens, words))
    both = chunks.select("chunk", "keys", "ends", "codes", "kinds").join(
        totals.withColumnRenamed("words", "totals"), F.col("chunk") == F.col("of")
    )
    kind = docs.schema[key].dataType.simpleString()
    names = [key, "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *chain, in_class, words_in = shared.value
        chain = Chain(*chain)
        n, v = in_class.sum(), words_in.sum()
        for batch in batches:
            for i in range(batch.num_rows):
                codes, ends, kinds = unpack(batch, i)
                totals = (batch.column("totals")[i].values.to_numpy() >> TOTAL_BITS).astype(np.float64)
                base = np.log10((totals + 0.5) / (n + 0.5 * (v + 1)))
                inside = np.log10((totals + 0.5) / (in_class[kinds] + 0.5 * (words_in[kinds] + 1)))
                begins = np.concatenate(([0], ends[:-1]))
                add = lambda per_word: np.add.reduceat(per_word[codes], begins)
                model = chain.likelihood(kinds[codes], ends) / np.log(10.0)
                columns = [
                    batch.column("keys")[i].values,
                    pa.array(np.diff(ends, prepend=0)),
                    pa.array(add((totals > 0).astype(np.int64))),
                    pa.array(np.full(len(ends), int(n))),
                    pa.array(add(base)),
                    pa.array(model + add(inside)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return both.mapInArrow(run, f"`{key}` {kind}, {SCORES}")
