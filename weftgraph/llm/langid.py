"""Language identification, word first with back-off to character n-grams.

A known word scores, per language, the negative log10 of its frequency there (``PENALTY`` where it never
occurs). An unseen word is cut into character n-grams of the greatest length of which any is known, and
scores their mean; if none of a length is known, the next shorter one is tried. A text scores the mean of
its words, and the language with the lowest score wins.

The model is fitted on a bounded sample of labelled rows: about ``TRAIN_ROWS`` rows per language, chosen by
a hash of the text, and keeps every word and n-gram of theirs, so that its size depends on that bound alone and it
can be broadcast whatever the size of the corpus. Every text is judged whole.

Null texts and texts without a letter are ``und`` with score 0, as is every text if no row is labelled. A
tie goes to the language first in code point order. Rows with a null language are predicted but never
learned from. Repeated rows are judged alike. Other columns are carried along; one named
like a result gives way to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.llm.words import attach, blocks, coded, map_texts, split_words
from weftgraph.session import stage_table

TRAIN_ROWS = 4000
LONGEST = 5
#: Score of what a language does not have: less frequent than anything it has.
PENALTY = 7.0
#: Unseen words a worker remembers; beyond it starts anew. No result depends on it.
REMEMBERED = 100_000
UNKNOWN = "und"


def _words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """All words of the texts in lower case, runs of letters, and where each text's begin."""
    lowered = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    return split_words(pc.replace_substring_regex(lowered, r"\PL+", " "))


def _sample_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, count) of the words of labelled texts, by block of texts."""
    for batch in batches:
        for part in blocks(batch, "text"):
            bounds, words = _words(part.column("text"))
            langs = part.column("lang").take(pa.array(np.repeat(np.arange(part.num_rows), np.diff(bounds))))
            counts = pa.table({"lang": langs, "gram": words.cast(pa.string())}).group_by(["lang", "gram"])
            yield from counts.aggregate([([], "count_all")]).rename_columns(["lang", "gram", "count"]).to_batches()


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", rows: int = TRAIN_ROWS) -> dict:
    """The model: languages, and per length n (0: whole words) the strings with a row of scores each."""
    labelled = docs.select(docs[text].alias("text"), docs[lang].alias("lang")).where(
        "text is not null and lang is not null"
    )
    counts = {r.lang: r["count"] for r in labelled.groupBy("lang").count().collect()}
    langs = sorted(counts)
    if not langs:
        return {"langs": [], "grams": {}}
    # A language with few rows is taken whole, one with many at a rate that leaves about ``rows``.
    limit = 1 << 30
    rate = F.create_map(*[F.lit(x) for k in langs for x in (k, int(min(1.0, rows / counts[k]) * limit))])
    # Copies are chosen together and count once, so a text with many copies doesn't swell the sample.
    sample = labelled.where(F.pmod(F.xxhash64("text"), F.lit(limit)) < rate[F.col("lang")]).dropDuplicates()
    words = stage_table(
        map_texts(sample, _sample_words, "lang string, gram string, count bigint")
        .groupBy("lang", "gram")
        .agg(F.sum("count").alias("count")),
        "language-words",
    )
    padded = F.concat(F.lit(" "), F.col("gram"), F.lit(" "))
    pieces = [words.select("lang", F.lit(0).alias("n"), "gram", "count")]
    for n in range(1, LONGEST + 1):
        grams = F.expr(f"transform(sequence(1, length(p) - {n - 1}), i -> substring(p, i, {n}))")
        long = words.withColumn("p", padded if n > 1 else F.col("gram")).where(F.length("p") >= n)
        pieces.append(
            long.select("lang", F.lit(n).alias("n"), F.explode(grams).alias("gram"), "count")
            .groupBy("lang", "n", "gram")
            .agg(F.sum("count").alias("count"))
        )
    every = pieces[0]
    for piece in pieces[1:]:
        every = every.unionByName(piece)
    every = stage_table(every, "language-grams")
    totals = {(r.lang, r.n): r.total for r in every.groupBy("lang", "n").agg(F.sum("count").alias("total")).collect()}
    place = F.create_map(*[F.lit(x) for i, k in enumerate(langs) for x in (k, i)])
    found = every.select(
        "n", "gram", F.struct(place[F.col("lang")].alias("at"), F.col("count").cast("double").alias("count")).alias("of")
    )
    table = found.groupBy("n", "gram").agg(F.collect_list("of").alias("of")).toArrow().combine_chunks()
    length, of = table.column("n").to_numpy(), table.column("of").combine_chunks()
    row = np.repeat(np.arange(len(length)), pc.list_value_length(of).to_numpy())
    at, count = of.flatten().field("at").to_numpy(), of.flatten().field("count").to_numpy()
    total = np.array([[totals.get((k, n), 1) for k in langs] for n in range(LONGEST + 1)], dtype=float)
    scores = np.full((len(length), len(langs)), PENALTY)
    scores[row, at] = -np.log10(count / total[length[row], at])
    names = table.column("gram").combine_chunks()
    grams = {n: (names.filter(pa.array(length == n)), scores[length == n]) for n in range(LONGEST + 1)}
    return {"langs": langs, "grams": grams}


class Judge:
    """Scores of words under one model, with a memory of unseen words."""

    def __init__(self, model: dict):
        self.langs = model["langs"]
        if not self.langs:
            return
        self.known, self.scores = model["grams"][0]
        self.grams = {n: model["grams"][n][1] for n in range(1, LONGEST + 1)}
        self.rows = {n: {g: i for i, g in enumerate(model["grams"][n][0].to_pylist())} for n in self.grams}
        self.unseen: dict[str, np.ndarray] = {}
        self.nothing = np.full(len(self.langs), PENALTY)

    def words(self, words: pa.Array) -> np.ndarray:
        """A row of scores per word."""
        row = pc.index_in(words.cast(self.known.type), value_set=self.known)
        new = np.flatnonzero(row.is_null().to_numpy(zero_copy_only=False))
        scores = np.empty((len(words), len(self.langs)))
        row = pc.fill_null(row, -1).to_numpy()
        scores[row >= 0] = self.scores[row[row >= 0]]
        for i, word in zip(new, words.take(pa.array(new)).to_pylist()):
            found = self.unseen.get(word)
            if found is None:
                if len(self.unseen) >= REMEMBERED:
                    self.unseen.clear()
                found = self.unseen[word] = self._back_off(word)
            scores[i] = found
        return scores

    def _back_off(self, word: str) -> np.ndarray:
        for n in range(LONGEST, 0, -1):
            # Blanks mark where a word begins and ends; alone they say nothing.
            rows, padded = self.rows[n], f" {word} " if n > 1 else word
            found = [r for i in range(len(padded) - n + 1) if (r := rows.get(padded[i : i + n])) is not None]
            if found:
                return self.grams[n][found].sum(axis=0) / len(found)
        return self.nothing

    def texts(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        bounds, words = _words(texts)
        counts = np.diff(bounds)
        names, scores = np.full(len(counts), UNKNOWN, dtype=object), np.zeros(len(counts))
        full = np.flatnonzero(counts)
        if not self.langs or not len(full):
            return names.tolist(), scores
        codes, distinct = coded(words)
        table = self.words(distinct)
        means = np.add.reduceat(table[codes], bounds[full], axis=0) / counts[full, None]
        best = means.argmin(axis=1)
        odds = np.power(10.0, means.min(axis=1)[:, None] - means)
        names[full], scores[full] = np.array(self.langs, dtype=object)[best], 1.0 / odds.sum(axis=1)
        return names.tolist(), scores


def predict(
    docs: DataFrame, model: dict, text: str = "text", lang: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """``docs`` with the language of every text and how clearly it wins: 10 to the power of minus the mean
    score, as a share of all languages'."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def maker():
        judge = Judge(shared.value)

        def make(texts: pa.Array) -> list[pa.Array]:
            names, scores = judge.texts(texts)
            return [pa.array(names, pa.string()), pa.array(scores)]

        return make

    return attach(docs, text, [T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())], maker)
