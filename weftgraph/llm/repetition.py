"""Quality rules: repetition inside a text, from a suffix array of its words.

Neighbours in the suffix array with their longest common prefixes give, for every position, the longest
string of words that begins there and also elsewhere in the text, and the longest that stands there and in two
other places. Strings of at least ``shortest`` words, or of ``often_shortest`` words that stand three times or
more, are its maximal repeats; the union of their spans, as a fraction of the text, and the longest string that
occurs twice are limited. With a length of 3 the same union gives the words of repeated three-word windows.

Many texts share one array: a suffix begins with the number of its text, so texts never mix and each sorts
by itself. Ranks double in length from round to round, only for suffixes that are not yet told apart.

Null and empty texts have no words and fail the base rules; a line without a word is no duplicate; repeated
rows are judged alike. Other columns are carried along; one named like a result gives way to it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from weftgraph.llm.words import attach, coded, split_words

FEWEST_WORDS = 50
MOST_REPEATED_PERCENT = 50
WINDOW = 3
#: A repeat counts from this many words: two places may share a phrase, a title or a quotation of a sentence.
SHORTEST = 15
#: One that stands three times or more counts from so many words: shorter ones are set phrases of a language.
OFTEN_SHORTEST = 5
#: Above this share of words in repeats, or a repeat longer than this, a text is rejected.
MOST_COVERED = 0.3
LONGEST = 100

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"

RESULTS = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField("base_failed", T.BooleanType()), T.StructField("covered", T.DoubleType())]
    + [T.StructField("longest_repeat", T.LongType()), T.StructField("kept", T.BooleanType())]
)


def longest_repeats(bounds: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per word position, the length of the longest string that begins there and elsewhere in its text, and of the
    longest that begins there and in two other places."""
    n = len(codes)
    out, often = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    if not n:
        return out, often
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    end = np.repeat(bounds[1:], np.diff(bounds))
    # Rank of the first word within its text. A rank is the place of a group's first member, so ranks of
    # one text lie together and differ from those of all other texts.
    key = owner.astype(np.int64) * (int(codes.max()) + 1) + codes
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, dtype=np.int64)
    rank[order] = _heads(key[order])
    levels, active, length = [rank.copy()], order, 1
    while True:
        active = active[_shared(rank[active])]
        if not len(active):
            break
        # Beyond the end of the text stands nothing, which sorts before every word.
        after = np.where(active + length < end[active], rank[np.minimum(active + length, n - 1)] + 1, 0)
        before = rank[active]
        place = np.lexsort((after, before))
        active, before, after = active[place], before[place], after[place]
        first = np.ones(len(active), dtype=bool)
        first[1:] = before[1:] != before[:-1]
        fresh = first.copy()
        fresh[1:] |= after[1:] != after[:-1]
        at = np.arange(len(active))
        group = np.maximum.accumulate(np.where(first, at, 0))
        new = before + np.maximum.accumulate(np.where(fresh, at, 0)) - group
        rank = rank.copy()
        rank[active] = new
        levels.append(rank)
        length *= 2
    suffixes = np.empty(n, dtype=np.int64)
    suffixes[rank] = np.arange(n)
    # Longest common prefix of neighbours: from the greatest power of two down, as far as ranks agree.
    pair = np.flatnonzero(levels[0][suffixes[1:]] == levels[0][suffixes[:-1]])
    left, right = suffixes[pair].copy(), suffixes[pair + 1].copy()
    common = np.zeros(len(pair), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = (left + (1 << k) <= end[suffixes[pair]]) & (right + (1 << k) <= end[suffixes[pair]])
        same = inside & (levels[k][np.minimum(left, n - 1)] == levels[k][np.minimum(right, n - 1)])
        step = np.where(same, 1 << k, 0)
        left, right, common = left + step, right + step, common + step
    np.maximum.at(out, suffixes[pair], common)
    np.maximum.at(out, suffixes[pair + 1], common)
    # Three places share what both pairs of three neighbours share.
    after = np.flatnonzero(pair[1:] == pair[:-1] + 1)
    shared = np.minimum(common[after], common[after + 1])
    for k in range(3):
        np.maximum.at(often, suffixes[pair[after] + k], shared)
    return out, often


def _heads(keys: np.ndarray) -> np.ndarray:
    """For sorted keys, the place of the first equal one."""
    at = np.arange(len(keys))
    first = np.ones(len(keys), dtype=bool)
    first[1:] = keys[1:] != keys[:-1]
    return np.maximum.accumulate(np.where(first, at, 0))


def _shared(ranks: np.ndarray) -> np.ndarray:
    """Which of the ranks, equal ones side by side, are not alone."""
    same = np.zeros(len(ranks), dtype=bool)
    equal = ranks[1:] == ranks[:-1]
    same[1:] |= equal
    same[:-1] |= equal
    return same


def covered_words(bounds: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Words per text in spans, given as the number of words from each position on, 0 for none."""
    at = np.arange(len(spans))
    reach = at + spans
    # A span never leaves its text, so one running maximum serves all texts.
    inside = np.maximum.accumulate(reach) > at if len(at) else np.zeros(0, dtype=bool)
    total = np.concatenate(([0], np.cumsum(inside)))
    return total[bounds[1:]] - total[bounds[:-1]]


def duplicate_lines(text: str) -> int:
    seen: set[str] = set()
    count = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            count += line in seen
            seen.add(line)
    return count


def judge_texts(
    texts: pa.Array,
    fewest: int = FEWEST_WORDS,
    most_percent: int = MOST_REPEATED_PERCENT,
    shortest: int = SHORTEST,
    often_shortest: int = OFTEN_SHORTEST,
    most_covered: float = MOST_COVERED,
    longest: int = LONGEST,
) -> pa.StructArray:
    """One row of results per text."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    bounds, words = split_words(texts)
    n_words = np.diff(bounds)
    codes, _ = coded(words)
    repeats, often = longest_repeats(bounds, codes.astype(np.int64))
    n_repeat = covered_words(bounds, np.where(repeats >= WINDOW, WINDOW, 0))
    spans = np.maximum(np.where(repeats >= shortest, repeats, 0), np.where(often >= often_shortest, often, 0))
    covered = covered_words(bounds, spans) / np.maximum(n_words, 1)
    most = np.zeros(len(n_words), dtype=np.int64)
    full = np.flatnonzero(n_words)
    if len(full):
        most[full] = np.maximum.reduceat(repeats, bounds[full])

    def times(characters: str) -> np.ndarray:
        total = np.zeros(len(texts), dtype=np.int64)
        for c in characters:
            total += pc.count_substring(texts, c).to_numpy()
        return total

    chars = pc.utf8_length(texts).to_numpy() - times(SPACES)
    lines = np.array([duplicate_lines(t) for t in texts.to_pylist()], dtype=np.int64)
    failed = (n_words < fewest) | (100 * n_repeat > most_percent * n_words)
    kept = ~failed & (covered <= most_covered) & (most <= longest)
    values = [n_words, chars, times(SYMBOLS), lines, n_repeat, failed, covered, most, kept]
    return pa.StructArray.from_arrays([pa.array(v) for v in values], names=RESULTS.names)


def judge(docs: DataFrame, text: str = "text", **limits) -> DataFrame:
    """``docs`` with the base figures, the repeats and the verdict of every text."""
    return attach(docs, text, RESULTS.fields, lambda: lambda texts: judge_texts(texts, **limits).flatten())
