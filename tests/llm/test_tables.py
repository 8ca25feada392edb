"""Operators on whole tables, against SQL, brute force and round trips."""

import math
import os
import re
import sys
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

from check import compare, connect  # noqa: E402

from weftgraph.llm import hmm, maintext, mixing, neighbours, sharding, warc  # noqa: E402
from weftgraph.llm.queries import ORACLES, QUERIES  # noqa: E402
from weftgraph.session import fresh_path  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    assert compare(spark, connect(SF), name, QUERIES[name], ORACLES[name], SF) is None


def test_every_number_has_a_query():
    assert [sum(q.startswith(f"op{n}_") for q in QUERIES) for n in range(1, 11)] == [1] * 10


# Mixing.


def test_targets(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 100), ("c", 1000), (None, 5), ("d", 0)], "source string, source_size bigint")
    got = {r.source: r for r in mixing.targets(sizes).collect()}
    # By turns 5, 2, 1, 5, 2: a, d and the null source are full at 30, 0 and 15; b at 300.
    assert [got[s].place for s in ("a", "b", "c", "d", None)] == [0, 1, 2, 3, 4]
    assert (got["a"].target, got["d"].target, got[None].target, got["b"].target) == (30.0, 0.0, 15.0, 300.0)
    assert got["c"].target == 1115.0 - 345.0


def test_odd_documents(spark, rows):
    items = [(i, "w " * (i % 9), None, f"s{i % 3}") for i in range(300)]
    items += [(None, "a b", None, None), (7, None, None, None), (8, " ", None, "s0")] + [(5, "x y z", None, "s1")] * 4
    docs = rows(items).withColumn("size", F.lit("own")).withColumn("row", F.lit(1))
    mixed = mixing.mix(docs)
    got = [(r.row.doc_id, r.row.size, r["size"], r.taken, r.copies) for r in mixed.collect()]
    assert len(got) == len(items) and {g[1] for g in got} == {"own"}
    assert all(t % n == 0 and t <= 3 * n if n else t == 0 for _, _, n, t, _ in got)
    assert sorted(got, key=str) == sorted(
        [(r.row.doc_id, r.row.size, r["size"], r.taken, r.copies) for r in mixing.mix(docs.repartition(7)).collect()], key=str
    )
    by_source = mixed.groupBy("source").agg(F.sum("taken").alias("t"), F.max("target").alias("to"), F.max("size").alias("m"))
    assert all(abs(r.t - r.to) <= r.m for r in by_source.collect())
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns and out.count() == sum(g[4] for g in got)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_pieces_do_not_matter(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = sorted((r.row.doc_id, r.taken) for r in mixing.mix(docs, ["doc_id"]).collect())
    monkeypatch.setattr(mixing, "PIECE_ROWS", 3)
    monkeypatch.setattr(mixing, "TIME_PIECES", 7)
    assert sorted((r.row.doc_id, r.taken) for r in mixing.mix(docs, ["doc_id"]).collect()) == want


# Sharding.


def claim_by_claim(shards, slots):
    number = lambda text: int(__import__("hashlib").md5(text.encode()).hexdigest()[:15], 16)
    order = []
    for s in shards:
        start, step = number(f"{s} start") % slots, number(f"{s} step") % (slots - 1) + 1
        order.append([(start + i * step) % slots for i in range(slots)])
    table = {}
    while len(table) < slots:
        for turn, wishes in enumerate(order):
            if len(table) < slots:
                table[next(w for w in wishes if w not in table)] = turn
    return [table[i] for i in range(slots)]


def test_table_of_claims():
    names = sharding.shard_names(5)
    assert sharding.fill(names, 101) == claim_by_claim(names, 101)
    whole, less = sharding.fill(sharding.shard_names()), sharding.fill(sharding.shard_names()[:-1])
    assert max(Counter(whole).values()) - min(Counter(whole).values()) <= 1
    # A shard that goes moves its own slots and few others.
    assert sum(a != b for a, b in zip(whole, less)) < 0.06 * len(whole)
    for bad in ((["a", "a"], 7), ([], 7), (["a"], 8), (["a"], 10_000_019)):
        with pytest.raises(ValueError):
            sharding.fill(*bad)


def test_placed_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (None, None)], "k int, SLOT string")
    placed = sharding.place(df, "k", sharding.shard_names(3), 101)
    got = placed.collect()
    assert placed.columns == ["k", "slot", "shard"] and got[0] == got[1] and all(r.shard for r in got)
    assert sharding.place(df.limit(0), "k", ["a"], 7).count() == 0
    sharding.write_shards(placed, str(tmp_path / "out"), most_rows=1)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    assert "Python" not in placed._jdf.queryExecution().toString()


# WARC.


@pytest.mark.parametrize("limit", ["1000000", "2"])
def test_archives(spark, limit):
    """With a limit of two rows a key every join is spread."""
    spark.conf.set("spark.weftgraph.rowsPerSplit", limit)
    same, pages = "<p>" + "é" * 60, []
    pages += [(5, "http://b.example/ x\r\n<>", same), (3, "http://a.example/", same), (None, None, same)]
    pages += [(9, "u", None), (10, "u", None), (11, "", "short"), (12, "v", "short")]
    pages += [(20, "w", same + "\r\n\r\nWARC/1.1\r\n\r\n")] * 4
    pages += [(20, "x", pages[-1][2])] * 2 + [(21, "w", pages[-1][2])] * 3
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id bigint, url string, html string, digest string")
    path = fresh_path(spark, "test-archives")
    warc.write_archives(df, path)
    captures = warc.assemble(spark, path)
    assert captures.count() == len(pages)
    rows = captures.collect()
    assert all(r.request.block.startswith("GET ") and "\n" not in r.target.strip("\n") if r.target else True for r in rows)
    stored = Counter(bytes(r.response.payload).decode() for r in rows if r.response.type == "response")
    assert stored == Counter({same: 1, "": 2, "short": 2, pages[-1][2]: 1})
    got = Counter((r.key, r.url, r.record_type, r.payload_bytes, r.refers_to) for r in warc.resolve(captures).collect())
    size = len(same.encode())
    assert got == Counter(
        [(3, pages[1][1], "response", size, None), (5, pages[0][1], "revisit", size, 3), (None, None, "revisit", size, 3)]
        + [(9, "u", "response", 0, None), (10, "u", "response", 0, None)]
        + [(11, "", "response", 5, None), (12, "v", "response", 5, None)]
        + [(20, "w", "response", size + 16, None)]
        + [(20, "w", "revisit", size + 16, 20)] * 3
        + [(20, "x", "revisit", size + 16, 20)] * 2
        + [(21, "w", "revisit", size + 16, 20)] * 3
    )
    empty = fresh_path(spark, "test-archives")
    warc.write_archives(df.limit(0), empty)
    assert warc.assemble(spark, empty).count() == 0
    spark.conf.unset("spark.weftgraph.rowsPerSplit")


def test_broken_archive():
    good = b"WARC/1.1\r\nWARC-Type: metadata\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [block for _, block in warc.parse_archive(good * 2)] == [b"abc"] * 2
    for bad in (good[:-1], b"x" + good, good[:-6]):
        with pytest.raises(ValueError):
            list(warc.parse_archive(bad))


# Pages.


PAGE = """<html><head><title>t</title><script>if (a</b) "</p>"</script></head><body class="page ads-off"><header><p>Site
of many words that nobody needs to read at all</p></header><div class="cookie-notice">We use cookies and many other things</div>
<main><article><header><h1>Head &amp; line</h1><p>By X</p></header><section><p>First with a <a href="x>y">link</a> and more text
that goes on.<li>one<li>two</section><section><h2>Part</h2><p>Second  text&nbsp;goes<br>on &lt;tag&gt; &bogus; 5 < 6.<p>Third</p>
<!-- x > <p>no</p> --></section><form>Sub <input> scribe</form><div id="relatedPosts"><p>Other things to read</p></div></article>
<section id="comments"><p>A very long comment by a reader that nobody wants in the text of the page.</p></section></main>
<aside>Side</aside><footer>&copy; c</footer></body></html>"""


def test_main_text(spark):
    want = ["Head & line", "First with a link and more text that goes on.", "one", "two", "Part",
            "Second text goes on <tag> &bogus; 5 < 6.", "Third"]
    deep = "<div>" * 20_000 + "x y" + "</div>" * 20_000
    pages = [PAGE, None, "", "just <b>bold</b>\n text", deep, "<nav>menu</nav>", "<p>a<p>b</p>c</p>d", "<!doctype html><!-- open"]
    df = spark.createDataFrame([(i, p, "old") for i, p in enumerate(pages)], "n int, html string, Text string")
    got = maintext.extract(df)
    assert got.columns == ["n", "html", "text"]
    assert [r.text for r in got.orderBy("n").collect()] == [
        "\n\n".join(want), "", "", "just bold text", "x y", "", "a\n\nb\n\nc\n\nd", ""]
    assert maintext.extract(df.limit(0)).count() == 0


def test_without_marked_article():
    text = "Long text of the article one two three four five six seven eight nine ten."
    links = "".join(f'<a href="{i}">link {i}</a>' for i in range(20))
    page = f'<body><div class="top">{links}</div><div class="post"><p>{text}</p><p>{text}</p></div><div>{links}</div></body>'
    assert maintext.main_text(page) == f"{text}\n\n{text}"


WRAPPERS = ["overflow-hidden", "has-sidebar", "comments-open", "elementor-widget-container", "skip social menu"]


@pytest.mark.parametrize("name", WRAPPERS)
def test_named_wrappers(name):
    text = "Long text of the article one two three four five six seven eight nine ten."
    both, wrap = f"<p>{text}</p><p>{text}</p>", f'<div class="{name}">'
    comments = f'<div id="comments">{"".join(f"<article><p>Comment {i} of a reader</p></article>" for i in range(40))}</div>'
    other = f'<div class="sidebar"><p>Side</p></div><div class="related"><article><p>Other text</p></article></div>{comments}'
    for page in (
        f"{wrap}<article>{both}</article></div>{other}",
        f"{wrap}{wrap}<main>{both}</main></div></div><div class='cookie'><p>We use cookies</p></div>",
        f"<main>{wrap}<div id='sidebar-page'><article>{both}</article></div></div>{other}</main>",
        f"<article>{wrap}<p>{text}</p></div>{wrap}<p>{text}</p></div></article>{other}",
        f"{wrap}<div class='post'>{both}</div></div><div class='share'>Share</div>",
    ):
        assert maintext.main_text(f"<body>{page}</body>") == f"{text}\n\n{text}"


def test_names_remove_furniture():
    text = "Long text of the article one two three four five six seven eight nine ten."
    page = f'<body><div class="post"><p>{text}</p></div><div class="related"><article><p>Other text</p></article></div></body>'
    assert maintext.main_text(page) == text
    deep = '<div class="widget"><div class="menu">' * 10_000 + "x y" + "</div>" * 20_000
    assert maintext.main_text(deep) == "x y"


def test_several_articles():
    text = "Long text of the article one two three four five six seven eight nine ten."
    other = "Another text of a sibling eleven twelve thirteen fourteen fifteen sixteen seventeen."
    links = "".join(f'<p><a href="{i}">link {i}</a></p>' for i in range(20))
    both, nested = f"<p>{text}</p>" * 6, f"<p>{other}</p><article>{f'<p>{text}</p>' * 6}</article><p>End</p>"
    siblings = f"<article>{both}</article><article><p>{other}</p></article><article>{links}</article>"
    for page in (siblings, f"<main>{siblings}</main>", f"<div><div>{siblings}</div></div>"):
        assert maintext.main_text(f"<body><div>{links}</div>{page}</body>") == "\n\n".join([text] * 6 + [other])
    page = f"<body><div>{links}</div><article>{nested}</article></body>"
    assert maintext.main_text(page) == "\n\n".join([other] + [text] * 6 + ["End"])


def test_given_pages(spark):
    import html

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for r in maintext.extract(pages).collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", article.replace("<br>", " "))
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in blocks]
        assert r.text == "\n\n".join(b for b in blocks if b)


# Neighbours.


def exact(vectors, k=5):
    ids, rows = np.array([i for i, _ in vectors]), np.array([v for _, v in vectors], float)
    sizes = np.sqrt((rows * rows).sum(1))
    out = {}
    for j in np.flatnonzero(ids % 50 == 0):
        scores = (rows * rows[j]).sum(1) / (sizes * sizes[j])
        order = [x for x in np.lexsort((ids, -scores)) if ids[x] != ids[j]][:k]
        out[int(ids[j])] = [(int(ids[x]), float(scores[x])) for x in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r["rank"]
    return out


def test_recall(spark):
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want, got = exact(vectors), found(QUERIES["op2_neighbours"](spark, SF))
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in got[q]}) for q in want)
    assert set(want) == set(got) and hits >= 0.9 * sum(map(len, want.values()))
    known = {q: dict(w) for q, w in want.items()}
    assert all(known[q].get(i, s) == pytest.approx(s, abs=1e-12) for q, g in got.items() for i, s in g)


def test_odd_vectors(spark, monkeypatch):
    rng = np.random.default_rng(5)
    good = [(i, rng.standard_normal(8).tolist()) for i in range(1, 301)]
    same = [(i, [1.0] * 8) for i in range(400, 700)]
    nan, inf = float("nan"), float("inf")
    bad = [(50, None), (1000, []), (1001, [0.0] * 8), (1002, [nan] + [1.0] * 7), (1003, [inf] + [1.0] * 7)]
    bad += [(1004, [None] + [1.0] * 7), (None, [1.0] * 8), (1050, [1.0] * 3)]
    monkeypatch.setattr(neighbours, "PART_ROWS", 64)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 3)
    df = spark.createDataFrame(good + same + same[:20] + bad, "vec_id bigint, embedding array<double>")
    got = found(neighbours.nearest(df.withColumn("leaf", F.lit("x")), F.col("id") % 50 == 0))
    want = exact(good + same)
    assert set(got) == set(want)
    # Equal vectors tie: the least ids come first. An id that repeats is found once.
    assert [i for i, _ in got[400]] == [401, 402, 403, 404, 405]
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in got[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert neighbours.nearest(df.limit(0), F.col("id") % 50 == 0).count() == 0
    few = spark.createDataFrame([(50, [1.0, 0.0]), (1, [0.0, 1.0])], "vec_id bigint, embedding array<float>")
    assert found(neighbours.nearest(few, F.col("id") % 50 == 0)) == {50: [(1, 0.0)]}


def test_chi_square():
    assert neighbours.chi_square(0.0) == 0 and neighbours.chi_square_inverse(0.95) == pytest.approx(12.5916, abs=1e-3)


# Language model.


def plain(chain, classes):
    forward = chain.start * chain.emit[classes[0]]
    total, ahead = np.log(forward.sum()), [forward / forward.sum()]
    for c in classes[1:]:
        forward = (ahead[-1] @ chain.step) * chain.emit[c]
        total += np.log(forward.sum())
        ahead.append(forward / forward.sum())
    after, steps, emissions = np.ones(len(chain.start)), np.zeros_like(chain.step), np.zeros_like(chain.emit)
    for t in range(len(classes) - 1, -1, -1):
        state = ahead[t] * after / (ahead[t] * after).sum()
        emissions[classes[t]] += state
        if t:
            seen = chain.emit[classes[t]] * after
            both = ahead[t - 1][:, None] * chain.step * seen[None]
            steps += both / both.sum()
            after = chain.step @ seen
            after /= after.sum()
    return total, state, steps, emissions


def test_recursions():
    rng = np.random.default_rng(0)
    k, c = 3, 5
    chain = hmm.Chain(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(c), k).T)
    texts = [rng.integers(0, c, n) for n in (1, 2, 63, 64, 65, 130, 300)]
    classes, ends = np.concatenate(texts), np.cumsum([len(t) for t in texts])
    want = [plain(chain, t) for t in texts]
    assert np.allclose(chain.likelihood(classes, ends), [w[0] for w in want])
    for made, i in zip(chain.expected(classes, ends), (1, 2, 3)):
        assert np.allclose(made, sum(w[i] for w in want), atol=1e-4)


def test_recursions_of_cut_and_whole_texts():
    rng = np.random.default_rng(1)
    k, c = 3, 5
    chain = hmm.Chain(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(c), k).T)
    texts = [rng.integers(0, c, n) for n in (3, hmm.WHOLE + 1, hmm.WHOLE, 70, 3 * hmm.WHOLE + 5)]
    classes, ends = np.concatenate(texts), np.cumsum([len(t) for t in texts])
    assert chain.segments(ends)[4].any() and not chain.segments(ends)[4].all()
    want = [plain(chain, t) for t in texts]
    assert np.allclose(chain.likelihood(classes, ends), [w[0] for w in want])
    for made, i in zip(chain.expected(classes, ends), (1, 2, 3)):
        assert np.allclose(made, sum(w[i] for w in want), rtol=1e-4, atol=1e-3)


def test_every_round_learns_from_all_texts(spark, rows, prose):
    """Which keys the texts have, and whether all have the same, changes nothing."""
    texts = [prose(lang, 40, i) for i, lang in enumerate(["de", "en", "es", "fr"] * 6)]
    got = []
    for key in (lambda i: i, lambda i: 1000 - 7 * i, lambda i: 5):
        docs = rows([(key(i), t, None, None) for i, t in enumerate(texts)])
        scores = hmm.score(docs.coalesce(1).withColumn("learn", F.lit(True)), "learn").collect()
        got.append(sorted(r.score for r in scores))
    assert got[1] == pytest.approx(got[0], rel=1e-6) and got[2] == pytest.approx(got[0], rel=1e-6)


def test_scores(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = {i: [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower)), ""] for i, t in docs.items()}
    counts = Counter(w for i, ws in tokens.items() if zlib.crc32(str(i).encode()) % 5 != 1 for w in ws)
    n, v = sum(counts.values()), len(counts)
    model = baseline = 0.0
    for r in QUERIES["op10_model"](spark, SF).collect():
        words = tokens[r.doc_id]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(counts[w] > 0 for w in words), n)
        assert r.base_score == pytest.approx(base) and r.score < 0
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1)
        model, baseline = model + r.score * r.held_out, baseline + r.base_score * r.held_out
    assert model > baseline


def test_held_out_texts(spark):
    """With 800 texts to learn from, nearly every held-out text is likelier than by single words."""
    rows = QUERIES["op10_model"](spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert sum(r.score > r.base_score for r in rows) > 0.9 * len(rows) > 100


def test_odd_texts(spark, rows, prose):
    items = [(i, t, None, None) for i, t in enumerate([None, "", " \n", "Word word", prose("en", 30_000), prose("de", 300)])]
    docs = rows(items + items[3:4] + [(None, "null key", None, None)]).withColumn("score", F.lit(1))
    got = hmm.score(docs.withColumn("learn", F.col("doc_id") > 2), "learn").collect()
    assert len(got) == 8 and [r.n_tokens for r in got if r.doc_id in (0, 1, 2)] == [1, 1, 1]
    assert all(math.isfinite(r.score) for r in got) and len({r.score for r in got if r.doc_id == 3}) == 1
    unknown = hmm.score(docs.withColumn("learn", F.lit(False)), "learn").collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and abs(r.base_score) < 1e-9 for r in unknown)
    assert hmm.score(docs.limit(0).withColumn("learn", F.lit(True)), "learn").count() == 0
