"""Operators on single texts, against brute force and the tokenizers library."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weftgraph.llm import bpe, langid, repetition
from weftgraph.llm.queries import QUERIES, tokenizer
from weftgraph.llm.words import BATCH_BYTES, blocks, map_texts, split_words

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", " \n\t ", "a", "é ü x\x1cy", "Zz zz\x0b\x0czz\r\nzz", "🎉 ÀB " * 40, "x" * 300_000]


def test_words_of_slices():
    texts = [t for t in ODD for _ in range(3)]
    batch = pa.record_batch([pa.array(texts), pa.array(range(len(texts)))], names=["text", "n"])
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for most in (1, 50, 1 << 20):
        got = []
        for part in blocks(batch, "text", most):
            bounds, words = split_words(part.column(0), lower=True)
            words = words.to_pylist()
            got += [words[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        assert got == [WORD.findall((t or "").translate(lower)) for t in texts]


def test_batches_go_by_bytes(spark):
    """Rows of whole texts come to Python in batches of a bounded size, all of them, and a row beyond it too."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "size": [batch.nbytes]})

    lengths = [20_000] * 900 + [2 * BATCH_BYTES] + [0] * 20
    docs = spark.createDataFrame(list(enumerate(lengths)), "doc_id bigint, n int").coalesce(1)
    docs = docs.select("doc_id", F.expr("repeat('x', n)").alias("text"))
    got = map_texts(docs, run, "n bigint, size bigint").collect()
    assert sum(r.n for r in got) == len(lengths) and sum(r.size for r in got) > sum(lengths)
    assert all(r.size < 1.1 * BATCH_BYTES for r in got if r.size < 2 * BATCH_BYTES)
    assert all(r.size < 3.1 * BATCH_BYTES for r in got) and len(got) >= 5


# Byte-pair encoding.


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.load(tokenizer("byte_bpe_50k.json")))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))


def test_ids_equal_the_library(codec, library, prose):
    rnd = random.Random(7)
    texts = ["", "a" * 5000, " " * 301 + "x", "\n\n \t aaaa<|endoftext|>b<|endoftext|><|endof", "don't we'll I've"]
    texts += ["日本語テキスト 🎉🎉🎉 नमस्ते" * 5, "é" * 77, prose("fr", 3000)]
    texts += ["".join(rnd.choice("abcdeth ing  \n'sé&1234") for _ in range(300)) for _ in range(300)]
    texts += ["".join(rnd.choice("aab ") for _ in range(80)) for _ in range(300)]
    for text, known in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        ids = codec.encode(text)
        assert ids == known.ids
        assert codec.decode(np.array(ids, np.int64), np.array([0, len(ids)])) == [text]


def test_pieces_are_encoded_together(library, prose, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    codec, alone = bpe.Codec(bpe.load(tokenizer("byte_bpe_50k.json"))), []
    one = codec.encode_piece
    monkeypatch.setattr(codec, "encode_piece", lambda piece: alone.append(piece) or one(piece))
    rnd = random.Random(8)
    texts = [prose("fr", 300, n) for n in range(30)] + ["x" * 200, "é" * 70, "", "Ā Āb", "\u0100", "a<|endoftext|>"]
    texts += [" ".join("".join(rnd.choice("thanedouiré日") for _ in range(rnd.randrange(1, 30))) for _ in range(99)) for _ in range(9)]
    known = [found.ids for found in library.encode_batch(texts, add_special_tokens=False)]
    for _ in range(3):
        assert [codec.encode(t) for t in texts] == known
    assert {len(p) for p in alone} == {200, 70}
    assert len(codec.pieces) < 1000


def test_tokens_cut_inside_characters(codec, library):
    ids = library.encode("🎉", add_special_tokens=False).ids[:-1] + [99_999_999]
    known = library.decode(ids[:-1], skip_special_tokens=False)
    assert codec.decode(np.array(ids), np.array([0, len(ids), len(ids)])) == [known, ""]


def test_encode_rows(spark, library):
    path = tokenizer("byte_bpe_50k.json")
    texts = [*ODD, "<|endoftext|>"]
    df = spark.createDataFrame([(i, t, "x", [1]) for i, t in enumerate(texts)], "n int, text string, decoded string, IDS array<int>")
    got = {r.n: r for r in bpe.decode(bpe.encode(df, path), path).collect()}
    for i, text in enumerate(texts):
        assert got[i].ids == library.encode(text or "", add_special_tokens=False).ids
        assert got[i].decoded == (text or "")
    empty = bpe.decode(bpe.encode(df.limit(0), path), path)
    assert empty.columns == ["n", "text", "ids", "decoded"] and empty.count() == 0
    lists = spark.createDataFrame([(None,), ([],), ([-5, 64],)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(lists, path).collect()] == ["", "", "a"]


# Repetition.


def longest_elsewhere(words, places=2):
    """Per position, the longest string that begins there and, in all, in so many places."""
    n = len(words)
    out = [0] * n
    for i in range(n):
        shared = []
        for j in range(n):
            k = 0
            while i != j and max(i, j) + k < n and words[i + k] == words[j + k]:
                k += 1
            shared.append(k)
        out[i] = sorted(shared, reverse=True)[places - 2] if len(shared) >= places else 0
    return out


def test_suffix_array():
    rnd = random.Random(3)
    docs = [[rnd.randrange(3) for _ in range(rnd.randrange(30))] for _ in range(200)] + [[1] * 70, [], [2, 2], [5]]
    bounds = np.cumsum([0, *map(len, docs)])
    twice, often = repetition.longest_repeats(bounds, np.array([x for d in docs for x in d]))
    assert list(twice) == [x for d in docs for x in longest_elsewhere(d)]
    assert list(often) == [x for d in docs for x in longest_elsewhere(d, 3)]


def base(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(inside), failed


def spans(words):
    repeats, often = longest_elsewhere(words), longest_elsewhere(words, 3)
    inside = {j for i, n in enumerate(repeats) if n >= repetition.SHORTEST for j in range(i, i + n)}
    inside |= {j for i, n in enumerate(often) if n >= repetition.OFTEN_SHORTEST for j in range(i, i + n)}
    return len(inside), max(repeats, default=0)


def test_judged_texts(spark, prose):
    once, again = prose("en", 120, 1), prose("de", 30, 2)
    texts = [*ODD[:-1], once, f"{once}\n{again}\nfin {again}", f"{again} " * 9, f"{prose('es', 300, 3)} {once} {once}"]
    texts += [f"|a|\n {w}\n" * 40 for w in ("x", "y z")] + [once]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "n int, text string, KEPT int")
    got = {r.n: r for r in repetition.judge(df).collect()}
    for i, text in enumerate(texts):
        words = WORD.findall(text or "")
        covered, longest = spans(words)
        want = base(text)
        assert tuple(got[i])[2:8] == want
        assert got[i].longest_repeat == longest
        assert got[i].kept == (
            not want[-1] and covered <= repetition.MOST_COVERED * len(words) and longest <= repetition.LONGEST
        )
    assert not got[texts.index(f"{prose('es', 300, 3)} {once} {once}")].kept and got[len(texts) - 1].kept
    assert repetition.judge(df.limit(0)).count() == 0


def test_short_repeats(spark, prose):
    """A line of twelve words twenty times is no text, whatever stands between; twice it is a title."""
    line = " ".join(f"l{i}" for i in range(12))
    runs = [" ".join(f"w{i}x{j}" for j in range(13)) for i in range(20)]
    texts = [" ".join(f"{line} {r}" for r in runs), f"{line} {' '.join(runs)} {line}", prose("en", 400, 5), prose("de", 400, 6)]
    got = repetition.judge(spark.createDataFrame(list(enumerate(texts)), "n int, text string")).orderBy("n").collect()
    assert [r.kept for r in got] == [False, True, True, True] and not got[0].base_failed and got[0].covered == 0.48


def test_repetition_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op4_repetition"](spark, SF).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(docs[r.doc_id])
        assert not (r.base_failed and r.kept)


# Languages.


def test_held_out_accuracy(spark):
    got = QUERIES["op1_language"](spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").where("held_out").collect()
    assert len(rows) > 100 and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97


def test_languages(spark, rows, prose):
    docs = rows([(i, prose(lang, 60, i), lang, None) for i, lang in enumerate(("de", "en", "es", "fr") * 12)])
    model = langid.fit(docs.unionByName(rows([(99, None, "fr", None), (98, "xx", None, None)])))
    assert model["langs"] == ["de", "en", "es", "fr"]
    asked = rows([(i, prose(lang, 20, 500 + i), lang, None) for i, lang in enumerate(("de", "en", "es", "fr"))])
    for r in langid.predict(asked.withColumn("SCORE", F.lit("old")), model).collect():
        assert r.lang_pred == r.lang and r.score > 0.5
    odd = rows([(i, t, None, None) for i, t in enumerate([None, "", "12 *** 7", "日本"])])
    got = [(r.lang_pred, r.score) for r in langid.predict(odd, model).orderBy("doc_id").collect()]
    # Nothing is known of the last one: all languages tie, and the first in code point order is told.
    assert got == [("und", 0.0)] * 3 + [("de", 0.25)]


def test_back_off():
    known = {0: {"abc": np.array([1.0, 7.0])}, 1: {"z": np.array([2.0, 1.0])}, 2: {"zq": np.array([7.0, 3.0])}, 3: {}, 4: {}, 5: {}}
    none = (pa.array([], pa.string()), np.zeros((0, 2)))
    table = {n: (pa.array(list(of)), np.array(list(of.values()))) if of else none for n, of in known.items()}
    judge = langid.Judge({"langs": ["a", "b"], "grams": table})
    one = lambda w: judge.words(pa.array([w]))[0]
    assert list(one("abc")) == [1.0, 7.0]
    assert list(one("zq")) == [7.0, 3.0]
    assert list(one("zz")) == [2.0, 1.0]
    assert list(one("qq")) == [langid.PENALTY] * 2


def test_nothing_labelled(spark, rows, prose):
    docs = rows([(1, prose("en", 9), None, None)])
    model = langid.fit(docs)
    assert [(r.lang_pred, r.score) for r in langid.predict(docs, model).collect()] == [("und", 0.0)]
    assert langid.predict(docs.limit(0), model).count() == 0


def plain_prediction(model_texts, text):
    """The whole prediction from plain counts: words first, then the longest n-grams of which any is known."""

    def words_of(t):
        # Letter by letter, each into one.
        return re.findall(r"[^\W\d_]+", "".join(c.lower()[0] for c in t))

    langs, counts = sorted({k for _, k in model_texts}), {}
    for t, k in set(model_texts):
        for w in words_of(t):
            for n in range(6):
                p = f" {w} " if n > 1 else w
                for g in [w] if n == 0 else [p[i : i + n] for i in range(len(p) - n + 1)]:
                    counts.setdefault((n, k), Counter())[g] += 1

    def score(n, g):
        of = [counts.get((n, k), Counter()) for k in langs]
        if not any(g in c for c in of):
            return None
        return [-math.log10(c[g] / sum(c.values())) if g in c else langid.PENALTY for c in of]

    def word(w):
        if score(0, w):
            return score(0, w)
        for n in range(5, 0, -1):
            p = f" {w} " if n > 1 else w
            known = [s for i in range(len(p) - n + 1) if (s := score(n, p[i : i + n]))]
            if known:
                return [sum(x) / len(known) for x in zip(*known)]
        return [langid.PENALTY] * len(langs)

    found = [word(w) for w in words_of(text)]
    if not found:
        return "und", 0.0
    means = [sum(x) / len(found) for x in zip(*found)]
    best = min(means)
    return langs[means.index(best)], 1 / sum(10 ** (best - m) for m in means)


def test_whole_prediction(rows, prose):
    """Against plain counts, with letters that languages lower in their own ways, and a repeated labelled row."""
    taught = [(prose(k, 40, i) + extra, k) for i in range(3) for k, extra in (("de", " Straße ΛΟΓΟΣ"), ("es", " İZMİR ñu"), ("fr", " Çé"))]
    taught += taught[:1]
    model = langid.fit(rows([(i, t, k, None) for i, (t, k) in enumerate(taught)]))
    asked = [prose(k, 30, 77) for k in ("de", "es", "fr", "en")] + ["ΛΟΓΟΣ", "İZMİR Ñu", "straßen", "1 2", "zzzq ΛΟΓ"]
    asked += asked[:1]
    got = langid.predict(rows([(i, t, None, None) for i, t in enumerate(asked)]), model).orderBy("doc_id").collect()
    for r, text in zip(got, asked):
        lang, score = plain_prediction(taught, text)
        assert r.lang_pred == lang and r.score == pytest.approx(score, abs=1e-9), text
