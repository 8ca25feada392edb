"""SimHash components, vector codes and whitening, against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from weftgraph.llm import anchors, bidiagonal, simhash, whitening
from weftgraph.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# SimHash.


def plain_print(text, width=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    hashes = [
        xxhash.xxh64_intdigest(" ".join(words[i : i + width]).encode(), 42) for i in range(max(1, len(words) - width + 1))
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, bits=4):
    of = list(range(len(prints)))

    def top(x):
        while of[x] != x:
            x = of[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if bin(a ^ prints[j]).count("1") <= bits:
                x, y = sorted((top(i), top(j)))
                of[y] = x
    return [top(i) for i in range(len(prints))]


def test_fingerprints(prose, monkeypatch):
    texts = [None, "", " \t\n", "Word", "a b c", "a  B c\nd", prose("en", 300), "ß É " * 30, prose("de", 900), "x"]
    want = [plain_print(t) for t in texts]
    assert simhash.fingerprints(pa.array(texts, pa.string())).tolist() == want
    monkeypatch.setattr(simhash, "SLICE", 100)
    assert simhash.fingerprints(pa.array(texts, pa.string())).tolist() == want
    assert simhash.fingerprints(pa.array([], pa.string())).tolist() == []
    assert simhash.fingerprints(pa.array([None, ""], pa.string())).tolist() == [0, 0]


@pytest.fixture(scope="module")
def prints():
    """Clouds around centres, chains of steps of four bits, fingerprints that agree in long runs of bits."""
    rnd = random.Random(5)
    out = [0, 1, (1 << 64) - 1, 0b11111]
    flip = lambda x, n: x ^ sum(1 << b for b in rnd.sample(range(64), n))
    for size in (3, 40, 150):
        centre = rnd.getrandbits(64)
        out += [flip(centre, rnd.randrange(0, 9)) for _ in range(size)]
    x = rnd.getrandbits(64)
    for _ in range(20):
        x = flip(x, rnd.choice((4, 4, 4, 5)))
        out.append(x)
    out += [(rnd.getrandbits(43) << 21) | 12345 for _ in range(100)]
    rnd.shuffle(out)
    return out


@pytest.mark.parametrize(("bits", "crowded"), [(4, 4), (3, 64)])
def test_components_against_brute_force(spark, prints, bits, crowded, monkeypatch):
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    distinct = sorted(set(prints), key=lambda x: x - (1 << 64) if x >> 63 else x)
    signed = [x - (1 << 64) if x >> 63 else x for x in distinct]
    of = plain_components(distinct, bits)
    df = spark.createDataFrame([(x,) for x in signed], "fingerprint bigint")
    got = {r.node: r.component for r in simhash.near_components(df, bits).collect()}
    assert got == {x: signed[c] for x, c, i in zip(signed, of, range(len(of))) if c != i}


def test_linked_prints_share_a_signature():
    rnd = random.Random(8)
    for bits in (1, 2, 3, 4, 5, 7):
        cuts = simhash.segments(bits)
        assert cuts[0][0] == 0 and cuts[-1][1] == 64
        for _ in range(300):
            differ = set(rnd.sample(range(64), bits))
            assert any(sum(low <= p < high for p in differ) <= 1 for low, high in cuts)


def test_simhash_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    prints = [plain_print(d.text) for d in docs]
    of = plain_components(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op13_simhash"](spark, SF).collect()}
    assert got == {d.doc_id: (f"{p:016x}", docs[c].doc_id) for d, p, c in zip(docs, prints, of)}


def test_simhash_rows(spark, prose):
    a, b = prose("en", 80, 1), prose("de", 80, 2)
    items = [(None, a), (4, a), (3, a.upper()), (None, b), (None, b), (7, None), (7, ""), (9, " "), (8, a), (8, prose("fr", 90))]
    df = spark.createDataFrame(items, "doc_id int, text string").withColumn("fingerprint", F.lit("x")).withColumn("key", F.lit(1))
    got = sorted(((r.doc_id, r.component) for r in simhash.near_duplicates(df).collect()), key=str)
    want = [(None, 3), (4, 3), (3, 3), (None, None), (None, None), (7, 7), (7, 7), (9, 7), (8, 3), (8, 8)]
    assert got == sorted(want, key=str)
    assert simhash.near_duplicates(df.limit(0)).count() == 0


# Vector codes.


def plain_codes(vectors, parts=8, entries=16, rounds=6):
    """Codebooks, codes and errors of whole-number vectors in the order of their keys, all against all."""
    points = np.stack(np.split(vectors, parts, axis=1)).astype(object)
    books = [[list(v) for v in p[:entries]] for p in points]

    def nearest(point, book):
        return min((sum((a - b) ** 2 for a, b in zip(point, entry)), i) for i, entry in enumerate(book))

    for _ in range(rounds):
        for part, book in zip(points, books):
            own = [nearest(x, book)[1] for x in part]
            for j in range(len(book)):
                mine = [x for x, o in zip(part, own) if o == j]
                if mine:
                    book[j] = [sum(c) // len(mine) for c in zip(*mine)]
    found = [[nearest(x, book) for x in part] for part, book in zip(points, books)]
    codes = [[f[i][1] for f in found] for i in range(len(vectors))]
    return books, codes, [sum(f[i][0] for f in found) for i in range(len(vectors))]


def clouds(rnd, rows, length, spread):
    centres = rnd.normal(size=(5, length))
    return centres[rnd.integers(0, 5, rows)] + spread * rnd.normal(size=(rows, length))


@pytest.mark.parametrize("spread", [0.0, 0.01, 1.0])
def test_trees(spread):
    rnd = np.random.default_rng(3)
    points = anchors.whole_numbers(np.concatenate((clouds(rnd, 700, 5, spread), np.zeros((90, 5)))), 5)
    tree = anchors.build(points)
    assert sorted(tree.order.tolist()) == list(range(len(points))) and (tree.points == points[tree.order]).all()
    for b, e, l, r, s, radius in zip(tree.begin, tree.end, tree.left, tree.right, tree.sums, tree.radius):
        assert e > b and (tree.points[b:e].sum(axis=0, dtype=np.int64) == s).all()
        assert np.sqrt(((tree.points[b:e] - s / (e - b)) ** 2).sum(axis=1)).max() <= radius * (1 + 1e-6) + 1e-6
        if l >= 0:
            assert tree.begin[l] == b and tree.end[l] == tree.begin[r] and tree.end[r] == e
    for entries in (points[:16], points[[3, 3, 9, 3, 5, 9]], points[:1], points[100:116] + 7):
        away = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)
        entry, error = anchors.assign(tree, entries)
        assert (entry == away.argmin(axis=1)).all() and (error == away.min(axis=1)).all()
        sums, counts = anchors.totals(tree, entries)
        assert (counts == np.bincount(entry, minlength=len(entries))).all()
        for j in range(len(entries)):
            assert (sums[j] == points[entry == j].sum(axis=0)).all()
    if spread == 0.01:
        assert len(anchors.walk(tree, points[:4]).points) < len(points) / 2


def test_codes_against_brute_force(spark):
    rnd = np.random.default_rng(7)
    vectors = np.concatenate((clouds(rnd, 260, 16, 0.3), np.tile(rnd.normal(size=16), (130, 1)), rnd.normal(size=(20, 16)) * 50))
    vectors = vectors[rnd.permutation(len(vectors))].astype(np.float32)
    labels = [None if i % 3 == 0 else int(i % 4) for i in range(len(vectors))]
    items = [(i * 2, v.tolist(), x, "own") for i, (v, x) in enumerate(zip(vectors, labels))]
    bad = [(-1, None, 1, "x"), (-2, [1.0] * 15 + [None], 1, "x"), (-3, [float("nan")] * 16, 1, "x"), (-4, [1.0, float("-inf")] * 8, 1, "x")]
    df = spark.createDataFrame(items + bad, "vec_id bigint, embedding array<float>, label int, codes string").repartition(5)
    coded, books = anchors.compress(df)
    want_books, want_codes, want_errors = plain_codes(np.floor(4096 * vectors.astype(float)).astype(np.int64))
    assert books.tolist() == want_books
    of = {}
    for x, e in zip(labels, want_errors):
        of[x] = of.get(x, 0) + e
    got = {r.vec_id: (r.codes, r.error, r.label, r.label_error) for r in anchors.with_label_errors(coded).collect()}
    assert got == {2 * i: (c, e, x, of[x]) for i, (c, e, x) in enumerate(zip(want_codes, want_errors, labels))}


def test_code_rows(spark):
    schema = "vec_id int, embedding array<double>, label string"
    rows = [(1, [1.0] * 10, "a"), (1, [0.5] * 10, "a"), (None, [2.0] * 9, None), (3, [], ""), (4, [-1e30] * 10, None)]
    coded, books = anchors.compress(spark.createDataFrame(rows, schema))
    assert books.shape == (8, 5, 2) and books[0, :, 0].tolist()[:3] == [2048, 4096, 0]
    assert {(r.vec_id, r.label, r.error) for r in coded.collect()} == {(1, "a", 0), (None, None, 0), (3, "", 0), (4, None, 0)}
    empty, none = anchors.compress(spark.createDataFrame([(1, None, "a")], schema))
    assert empty.columns == ["vec_id", "label", "codes", "error"] and empty.count() == 0 and none.shape == (8, 0, 0)
    assert anchors.with_label_errors(empty).count() == 0


# Whitening.


def matrices():
    rnd = np.random.default_rng(1)
    rotated = np.linalg.qr(rnd.normal(size=(40, 40)))[0]
    gaps = rnd.normal(size=(300, 20))
    gaps[:, 5], gaps[:, 7] = gaps[:, 4], 0
    wide = np.concatenate((rnd.normal(size=(5, 20)), np.zeros((15, 20))))
    yield from (rnd.normal(size=(d, d)) for d in (1, 2, 3, 8, 64))
    yield from (np.triu(rnd.normal(size=(40, 40))) * np.logspace(0, -9, 40), np.linalg.qr(gaps, mode="r"), wide, np.eye(6))
    yield from (np.diag([3.0] * 10 + [2.0] * 20 + [1.0] * 10) @ rotated, np.diag(3 + 1e-9 * np.arange(40)) @ rotated)
    yield from (np.diag([1] + [1e-3] * 39) @ rotated, np.zeros((4, 4)), 2 * np.eye(10) + np.eye(10, k=1))


def test_singular_pairs():
    for matrix in matrices():
        pairs = bidiagonal.singular_pairs(matrix, 100)
        want = np.linalg.svd(matrix, compute_uv=False)
        assert len(pairs) == (want > 1e-13 * want[0]).sum()
        if pairs:
            assert np.allclose([v**0.5 for v, _ in pairs], want[: len(pairs)], rtol=1e-12, atol=1e-15 * want[0])
            z = np.array([x for _, x in pairs])
            assert np.abs(z @ z.T - np.eye(len(z))).max() < 1e-9
            assert np.abs(matrix.T @ (matrix @ z.T) - z.T * [v for v, _ in pairs]).max() < 1e-12 * max(want[0] ** 2, 1e-300)
        assert [v for v, _ in bidiagonal.singular_pairs(matrix, 3)] == [v for v, _ in pairs[:3]]


def plain_whitening(vectors, components=16):
    x = np.floor(64 * np.asarray(vectors, dtype=float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    middle = sums / n
    values, z = np.linalg.eigh(np.cov(fit.T, bias=True))
    values, z = values[::-1][:components], z.T[::-1][:components]
    share = values / np.cov(fit.T, bias=True).trace()
    deviation = ((n * x.astype(object) - sums.astype(object)) ** 2).sum(axis=1)
    return n, deviation.tolist(), (x - middle) @ z.T / np.sqrt(values), share


def check_whitening(got, ids, vectors, k):
    n, deviation, z, share = plain_whitening(vectors)
    rows = {(r.vec_id, r.component): r for r in got}
    assert len(rows) == len(got) == len(ids) * k
    signs = [1 if rows[ids[0], c + 1].whitened * z[0, c] > 0 else -1 for c in range(k)]
    for i, key in enumerate(ids):
        for c in range(k):
            r = rows[key, c + 1]
            assert (r.n, r.deviation) == (n, deviation[i]) and 0 <= r.identity_error < 1e-9
            assert abs(r.whitened * signs[c] - z[i, c]) < 1e-6 and abs(r.explained - share[c]) < 1e-10


def test_whitening_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    check_whitening(QUERIES["op12_whitening"](spark, SF).collect(), [r.vec_id for r in rows], [r.embedding for r in rows], 16)


def test_whitening_rows(spark, monkeypatch):
    monkeypatch.setattr(whitening, "STACKED", 2)
    rnd = np.random.default_rng(2)
    vectors = (rnd.normal(size=(90, 6)) * [9, 7, 5, 3, 2, 1]).tolist()
    items = list(enumerate(vectors)) + [(100 + i, vectors[4]) for i in range(60)]
    bad = [(-1, None), (-2, [1.0, None, 1.0]), (-3, [float("nan")] * 6), (-4, [float("inf")] * 6)]
    schema = "vec_id int, embedding array<double>"
    df = spark.createDataFrame(items + bad, schema).withColumn("component", F.lit("x")).repartition(7)
    check_whitening(whitening.whiten(df).collect(), [i for i, _ in items], [v for _, v in items], 6)
    # Two distinct vectors have one component, one or none has none; keys may repeat or be null.
    two = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0]), (None, [1.0, 2.0])], schema)).collect()
    assert [(r.vec_id, r.component, r.n, abs(r.whitened)) for r in two] == [(1, 1, 2, 1.0), (1, 1, 2, 1.0), (None, 1, 2, 1.0)]
    for rows in ([(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])], [(1, None)], []):
        made = whitening.whiten(spark.createDataFrame(rows, schema))
        assert made.count() == 0 and made.columns[:3] == ["vec_id", "component", "n"]
    far = whitening.whiten(spark.createDataFrame([(1, [1e30, 0.0]), (2, [-1e30, 5.0]), (3, [0.0, 1.0])], schema)).collect()
    assert len(far) >= 3 and {r.deviation for r in far} >= {None}
