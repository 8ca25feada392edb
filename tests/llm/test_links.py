"""Near-duplicate join, components and the pipeline, against brute force."""

import os
import random
import re
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from weftgraph.llm import components, langid, mixing, partenum, repetition  # noqa: E402
from weftgraph.llm.queries import QUERIES, tokenizer  # noqa: E402

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def brute(texts, width, percent):
    """Component of every position: the least position linked, over several steps."""
    sets = [shingles(t, width) for t in texts]
    of = list(range(len(sets)))

    def top(x):
        while of[x] != x:
            x = of[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and 100 * common >= percent * (len(a) + len(sets[j]) - common):
                x, y = sorted((top(i), top(j)))
                of[y] = x
    return [top(i) for i in range(len(sets))], [len(s) for s in sets]


def edited(words, count, rnd):
    words = list(words)
    for _ in range(count):
        words[rnd.randrange(len(words))] = f"new{rnd.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def near(prose):
    """Groups of copies with few and many changes, short texts, and a passage many texts share."""
    rnd = random.Random(11)
    texts = []
    for n, size in enumerate((3, 5, 9, 14, 25, 60, 150, 400)):
        words = prose("en", size, n).split()
        texts += [edited(words, rnd.choice((0, 0, 1, 1, 2, size // 40)), rnd) for _ in range(14)]
    passage = prose("fr", 30, 99)
    texts += [f"{prose('de', 12, i)} {passage}" for i in range(60)]
    texts += [None, "", " \n", "a", "A", "b c", "B  c\n", *texts[:9], texts[70].upper()]
    rnd.shuffle(texts)
    return texts


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (1, 50)])
def test_against_brute_force(spark, near, width, percent, monkeypatch):
    of, sizes = brute(near, width, percent)
    df = spark.createDataFrame([(i, t, "x", -1) for i, t in enumerate(near)], "doc_id int, text string, class string, size int")
    # Small limits send groups through blocks and their sets to several tasks.
    for few, block in ((48, 2048), (3, 5)):
        monkeypatch.setattr(partenum, "FEW", few)
        monkeypatch.setattr(partenum, "BLOCK", block)
        got = {r.doc_id: (r.component, r["size"]) for r in partenum.near_duplicates(df, width=width, percent=percent).collect()}
        assert got == {i: (of[i], sizes[i]) for i in range(len(near))}


def test_rows_of_a_crowded_group(spark, monkeypatch):
    """Sets that sizes and slices don't tell apart, though no two are linked, give no rows for their pairs."""
    common = [f"w{i}" for i in range(80)]
    sets = [" ".join([*common, *(f"own{n}x{i}" for i in range(11))]) for n in range(120)]
    sets += [f"{sets[5]} more", f"{sets[60]} more"]  # these link 5 to 120 and 60 to 121, but nothing else
    rows, stage = {}, partenum.stage_table

    def staged(df, name, **options):
        written = stage(df, name, **options)
        rows[name] = max(rows.get(name, 0), written.count())
        return written

    monkeypatch.setattr(partenum, "stage_table", staged)
    df = spark.createDataFrame(list(enumerate(sets)), "doc_id int, text string")
    got = {r.doc_id: r.component for r in partenum.near_duplicates(df, width=1, percent=80).collect()}
    assert got == {i: {120: 5, 121: 60}.get(i, i) for i in range(122)}
    assert rows["apart"] > 48 * 10  # many groups beyond those whose pairs are listed
    assert all(n <= rows["apart"] for n in rows.values()) or max(rows, key=rows.get) == "signatures"


def test_pairs_meet_at_one_signature():
    counts, own = np.zeros((3, partenum.SLICES), np.int16), np.zeros(3, int)
    firsts, parts, sizes = [[3, 5], [5, 9], [9]], np.arange(3), np.full(3, 20)
    for signature, met in ((3, []), (5, [0, 1]), (9, [0, 1, 2])):
        here = [i for i in range(3) if signature in firsts[i]] if signature != 9 else [0, 1, 2]
        got = partenum.meeting(signature, [firsts[i] for i in here], parts[here], sizes[here], counts[here], own[here], False, 80)
        # 0 and 2 have no first signature in common: they meet wherever they are.
        assert [here[i] for i in got] == met


def test_linked_sets_share_a_signature(near):
    for width, percent in ((1, 50), (2, 80), (4, 85)):
        bounds, values = partenum.shingle_sets(pa.array(near, pa.string()), width)
        owner, signed = partenum.signatures(bounds, values, percent)
        sets = [set(values[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:])]
        assert [len(s) for s in sets] == [len(shingles(t, width)) for t in near]
        have = [set() for _ in near]
        for o, s in zip(owner.tolist(), signed.tolist()):
            have[o].add(s)
        for i, a in enumerate(sets):
            for j in range(i):
                common = len(a & sets[j])
                if a and 100 * common >= percent * (len(a) + len(sets[j]) - common):
                    assert have[i] & have[j]


def test_keys(spark, prose):
    a, b = prose("en", 40, 1), prose("en", 40, 2)
    items = [(None, a), (4, a), (3, a + " x"), (None, b), (None, b), (7, None), (7, None), (8, a), (8, prose("de", 40)), (9, "")]
    df = spark.createDataFrame(items, "doc_id int, text string")
    got = sorted(((r.doc_id, r.component) for r in partenum.near_duplicates(df).collect()), key=str)
    want = [(None, 3), (4, 3), (3, 3), (None, None), (None, None), (7, 7), (7, 7), (8, 3), (8, 8), (9, 9)]
    assert got == sorted(want, key=str)
    kept = sorted(((r.doc_id, r.text) for r in partenum.one_per_group(df.repartition(3)).collect()), key=str)
    want = [(3, a + " x"), (None, b), (7, None), (7, None), (8, prose("de", 40)), (9, "")]
    assert kept == sorted(want, key=str)
    assert partenum.near_duplicates(df.limit(0)).count() == 0 and partenum.one_per_group(df.limit(0)).count() == 0


def test_join_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    of, sizes = brute([d.text for d in docs], 4, 85)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op9_partenum"](spark, SF).collect()}
    assert got == {d.doc_id: (n, docs[c].doc_id) for d, n, c in zip(docs, sizes, of)}


def test_components(spark):
    rnd = random.Random(4)
    links = [(i, i + 1) for i in range(100, 130)] + [(1, 1)] + [(rnd.randrange(200, 400), rnd.randrange(200, 400)) for _ in range(120)]
    links += [(500, i) for i in range(501, 560)] + [(2, 559)]
    of = {x: x for link in links for x in link}
    while True:
        new = {x: min([of[x], *(of[b] for a, b in links if a == x), *(of[a] for a, b in links if b == x)]) for x in of}
        if new == of:
            break
        of = new
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {x: c for x, c in of.items() if x != c}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# The pipeline.


def test_pipeline_against_brute_force(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    verdict = repetition.judge_texts(pa.array([d.text for d in docs])).to_pylist()
    docs = [d for d, v in zip(docs, verdict) if v["kept"]]
    df = spark.createDataFrame(docs)
    judge = langid.Judge(langid.fit(df))
    names, scores = judge.texts(pa.array([d.text for d in docs]))
    docs = [d for d, n, s in zip(docs, names, scores) if n != "und" and s >= corpus_pipeline.SURE_LANGUAGE]
    of, _ = brute([d.text for d in docs], 5, 80)
    docs = [d for i, d in enumerate(docs) if of[i] == i]
    taken = {r.row.doc_id: r.copies for r in mixing.mix(spark.createDataFrame(docs)).collect()}
    library = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    want = []
    for d in docs:
        want += [(d.doc_id, tuple(library.encode(d.text, add_special_tokens=False).ids))] * taken[d.doc_id]
    got = [(r.doc_id, tuple(r.ids)) for r in corpus_pipeline.run(spark, SF).collect()]
    assert sorted(got) == sorted(want) and len(got) > 50


def test_stages_keep_columns(spark, prose):
    given = [(i, prose(lang, 90, i), lang, f"s{i % 2}", "own") for i, lang in enumerate(("en", "de") * 6)]
    given += [(20, given[0][1], None, None, None), (None, prose("en", 90, 77), "en", "s0", None), (21, None, None, None, None)]
    given += [given[1], (22, "", "en", "s1", ""), (23, "word " * 400, "en", "s1", "x"), (24, "1 2 3 " * 30, "en", None, "x")]
    df = spark.createDataFrame(given, "doc_id bigint, text string, lang string, source string, kept string")
    for docs in (df.withColumn("row", F.lit(1)).withColumn("score", F.col("kept")), df.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            made = stage(spark, docs, SF)
            assert made.columns == docs.columns and made.dtypes == docs.dtypes, name
            made.count()
            docs = made
        last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        assert last.columns == ["doc_id", "n_tokens", "ids"]
    kept = {r.doc_id for r in corpus_pipeline.quality_rules(spark, df, SF).collect()}
    assert kept == {*range(12), 20, None, 0}
    one = corpus_pipeline.near_duplicates(spark, df, SF)
    assert sorted(str(r.doc_id) for r in one.collect()) == sorted(map(str, [*range(12), None, 21, 22, 23, 24]))
