"""Whitening, periodic runs and language-model scores against brute force, with nulls, empty and long texts, ties,
repeated rows, empty tables and columns with clashing names."""

import hashlib
import math
import random
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from recordloom.llm import runs, treeweight, whitening

SF = "/root/testdata/sf0.001"


# whitening


def vectors():
    r = random.Random(3)
    rows = [(i, [r.gauss(0, 0.1 + k) for k in range(5)], "a") for i in range(60)]
    rows += [rows[4], rows[4], (None, rows[7][1], None)]
    rows += [(100, None, "n"), (101, [], "n"), (102, [1.0, None, 1.0, 1.0, 1.0], "n"), (103, [float("nan")] * 5, "n"), (104, [float("inf")] * 5, "n")]
    rows += [(110, [1.0, 2.0], "two"), (111, [3.0, 2.0], "two"), (112, [3.0, 5.0], "two"), (120, [2.0, 2.0, 2.0], "one")]
    return rows


def test_whitening_equals_brute_force(spark):
    df = spark.createDataFrame(vectors(), "vec_id long, embedding array<double>, whitening string").repartition(3)
    found = whitening.whiten(df)
    assert found.columns == ["vec_id", "embedding", "whitening", "whitening_"]
    rows = found.collect()
    assert len(rows) == 63 + 3 + 1
    for width in (2, 3, 5):
        own = [r for r in rows if len(r.embedding) == width]
        x = np.floor(64 * np.array([r.embedding for r in own])).astype(np.int64) + 1_000_000
        fit = np.unique(x, axis=0)
        n, s = len(fit), fit.sum(axis=0)
        y = fit - s / n
        values, vecs = np.linalg.eigh(y.T @ y / n)
        values, vecs = values[::-1], vecs[:, ::-1]
        for r, row in zip(own, x):
            w = r.whitening_
            assert (w.n, w.deviation) == (n, sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)))
            assert [p.component for p in w.parts] == list(range(1, width + 1))
            if width == 3:
                assert [p.whitened for p in w.parts] == [None] * 3 and w.identity_error is None
        if width != 3:
            want = (x - s / n) @ vecs / np.sqrt(values)
            got = np.array([[p.whitened for p in r.whitening_.parts] for r in own])
            assert np.abs(got - want * np.sign((got * want).sum(axis=0))).max() < 1e-9
            assert own[0].whitening_.identity_error < 1e-12
            assert np.allclose([p.explained for p in own[0].whitening_.parts], values / values.sum(), rtol=1e-12)


def test_clustered_eigenvalues():
    turn = np.linalg.qr(np.random.default_rng(0).normal(size=(30, 30)))[0]
    want = np.concatenate([1 + np.arange(5) * 1e-9, 0.5 + np.arange(5) * 1e-12, np.full(3, 0.45), np.linspace(0.1, 0.4, 17)])
    a = ((turn * want) @ turn.T).astype(np.longdouble)
    a = (a + a.T) / 2
    values, x = whitening.components(a)
    eps = np.finfo(np.longdouble).eps
    assert np.abs(x.T @ x - np.eye(30)).max() < 100 * eps
    assert np.abs(a @ x - x * values).max() < 1000 * eps
    assert np.abs(values - np.sort(want)[::-1]).max() < 1e-14


def test_whole_sums_and_empty_table(spark):
    y = np.array([[2**30, -(2**30) + 1], [5, 2**30]], np.int64)
    want = y.astype(object).T @ y.astype(object)
    assert (sum(p.astype(object) for p in whitening.products(y)) == want).all()
    small = np.random.default_rng(1).integers(-(2**25), 2**25, (50, 3))
    assert (sum(p.astype(object) for p in whitening.products(small)) == small.astype(object).T @ small.astype(object)).all()
    assert whitening.whiten(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    far = spark.createDataFrame([(1, [1e9]), (2, [-1e9])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="does not fit a long"):
        whitening.whiten(far).collect()


# periodic runs


def brute_runs(w, least, times):
    n, out = len(w), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, times * q):
                part = w[i : i + size]
                if not any(part[d:] == part[:-d] for d in range(1, q)):
                    out.append((i, size, q))
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    r, seen = random.Random(1), 0
    for _ in range(3000):
        letters = "abcdefgh"[: r.choice([1, 2, 2, 3, 5])]
        w = [r.choice(letters) for _ in range(r.randint(0, 70))]
        if len(w) > 10 and r.random() < 0.6:
            a = r.randrange(len(w))
            p = 1 + (len(w) - a) // r.randint(2, 9)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
            for _ in range(r.choice([0, 0, 1, 2])):
                w[r.randrange(len(w))] = "z"
        for least, times in ((6, 4), (2, 2), (8, 3)):
            want = brute_runs(w, least, times)
            seen += len(want)
            assert runs.runs_of(w, least, times) == want
    assert seen > 10000


def test_long_runs():
    assert runs.runs_of(["a"] * 200_000) == [(0, 200_000, 1)]
    w = ["x%d" % i for i in range(20_000)] + ["p%d" % (i % 30_000) for i in range(120_000)] + ["end"]
    assert runs.runs_of(w) == [(20_000, 120_000, 30_000)]


def test_runs_of_odd_rows(spark):
    texts = [None, "", " \t\n", "a", "a a a a a a", "la la la la la la la de\tla  é É é É é É é É", "one two three"]
    rows = [(i, t, "z", "f") for i, t in enumerate(texts)] + [(4, texts[4], "z", "f"), (None, texts[4], None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, extra string, found string")
    out = runs.find_runs(df)
    assert out.columns == ["doc_id", "text", "extra", "found", "found_"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        w = (r.text or "").split()
        want = brute_runs(w, 6, 4)
        assert [tuple(x) for x in r.found_.runs] == want and r.found_.n_words == len(w)
        gone = {i for s, m, q in want for i in range(s + q, s + m)}
        assert r.found_.collapsed == " ".join(x for i, x in enumerate(w) if i not in gone)
    assert runs.find_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        runs.runs_of(["a"] * 9, 2, 1)


def test_op12_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = runs.op12(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        w = (docs[r.doc_id] or "").encode().split()
        h, n = zlib.crc32(str(r.doc_id).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        want = brute_runs(w, 6, 4) if n < 700 else runs.runs_of(w)
        assert r.n_runs == len(want)
        assert r.runs_sha256 == hashlib.sha256("".join("%d,%d,%d\n" % x for x in want).encode()).hexdigest()
        gone = {i for s, m, q in want for i in range(s + q, s + m)}
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()
        best = min(want, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None,) * 3)
        assert (r.start, r.length, r.period) == best
        assert r.exponent_milli == (1000 * best[1] // best[2] if want else None)


# language-model scores


def brute_scores(docs, depth):
    low = [(i, (t or "").encode().translate(treeweight.LOWER)) for i, t in docs]
    count = {}

    def steps(symbol):
        return [((1 << k) | symbol >> (8 - k), symbol >> (7 - k) & 1) for k in range(8)]

    for i, b in low:
        x = bytes(depth) + b + b"\xff"
        for j in range(depth, len(x) if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2 else 0):
            for prefix, bit in steps(x[j]):
                for d in range(depth + 1):
                    count.setdefault((prefix, x[j - d : j]), [0, 0])[bit] += 1
    children = {}
    for prefix, context in count:
        if context:
            children.setdefault((prefix, context[1:]), []).append((prefix, context))

    def own(node):
        a, b = count[node]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    @lru_cache(None)
    def weighted(node):
        if len(node[1]) == depth:
            return own(node)
        return np.logaddexp(own(node), sum(map(weighted, children[node]))) - math.log(2)

    def one(node, context):
        if node not in count:
            return 0.5
        a, b = count[node]
        mine, d = (b + 0.5) / (a + b + 1), len(node[1])
        if d == depth:
            return mine
        share = 1 / (1 + math.exp(min(700, sum(map(weighted, children[node])) - own(node))))
        return share * mine + (1 - share) * one((node[0], context[len(context) - d - 1 :]), context)

    out = []
    for i, b in low:
        x, total = bytes(depth) + b + b"\xff", 0
        for j in range(depth, len(x)):
            for prefix, bit in steps(x[j]):
                p = one((prefix, b""), x[j - depth : j])
                total += math.log10(p if bit else 1 - p)
        out.append((i, b, total))
    return out


@pytest.mark.parametrize("depth,chunk", [(1, 64), (2, 10**6), (4, 64)])
def test_scores_equal_brute_force(spark, depth, chunk):
    texts = ["Hello hello world", "the cat sat", "The Cat sat on", "", "été x", "zz zz zz zz", "a\nb\tc  D"]
    docs = list(enumerate(texts * 3)) + [(None, "the cat"), (5, None), (5, "zz zz zz zz")]
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, scores string")
    out = treeweight.score_texts(df, ~treeweight.held_out(F.col("doc_id")), depth=depth, chunk_bytes=chunk)
    assert out.columns == ["doc_id", "text", "scores", "scores_"]
    train = Counter(w for i, t in docs if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2 for w in [*(t or "").encode().translate(treeweight.LOWER).split(), None])
    total, kinds = sum(train.values()), len(train)
    want = []
    for i, b, score in brute_scores(docs, depth):
        tokens = [*b.split(), None]
        base = sum(math.log10((train[w] + 1) / (total + kinds + 1)) for w in tokens)
        want.append((-1 if i is None else i, len(tokens), sum(train[w] > 0 for w in tokens), total, round(base, 8), round(score, 8)))
    got = [(-1 if r.doc_id is None else r.doc_id, r.scores_.n_tokens, r.scores_.n_known, r.scores_.train_tokens, round(r.scores_.base_score, 8), round(r.scores_.score, 8)) for r in out.collect()]
    assert sorted(got) == sorted(want)


def test_probabilities_of_a_context_add_up(spark):
    grams = [(c << 8 | s, n) for c in (0x6162, 0x7A62, 0x0000, 0x6263) for s in range(256) for n in [(s * c) % 5 if s < 90 else 0]]
    df = spark.createDataFrame(grams, "gram long, n long")
    sums = Counter()
    for r in treeweight.probabilities(df, 2).collect():
        sums[r.gram >> 8] += 10**r.value
    assert len(sums) == 4 and all(abs(x - 1) < 1e-12 for x in sums.values())


def test_scores_without_training_and_empty_table(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: r.scores for r in treeweight.score_texts(df, F.lit(False)).collect()}
    assert abs(rows[1].score - 24 * math.log10(0.5)) < 1e-9 and abs(rows[2].score - 8 * math.log10(0.5)) < 1e-9
    assert (rows[1].n_tokens, rows[1].n_known, rows[1].train_tokens, rows[1].base_score) == (2, 0, 0, 0.0)
    assert treeweight.score_texts(df.limit(0), F.lit(True)).count() == 0


def test_slices_of_long_texts(monkeypatch):
    monkeypatch.setattr(treeweight, "SLICE_BYTES", 7)
    bodies = [b"abcdefghijklmnopqrstuvwxyz", b"", b"ab", b"cd", b"x" * 7, b"yz"]
    got = {k: [] for k in range(len(bodies))}
    for first, grams, begins in treeweight.slices(bodies, 3):
        for k, part in enumerate(np.split(grams, begins[1:])):
            got[first + k] += part.tolist()
    for k, b in enumerate(bodies):
        x = bytes(3) + b + b"\xff"
        assert got[k] == [int.from_bytes(x[j - 3 : j + 1], "big") for j in range(3, len(x))]


def test_blocks_hold_whole_tails(monkeypatch):
    monkeypatch.setattr(treeweight, "BLOCK_ROWS", 10)
    tails = sorted([1] * 25 + list(range(2, 40)) * 2)
    batches = [pa.RecordBatch.from_arrays([pa.array(tails[k : k + 7], pa.int64())], names=["tail"]) for k in range(0, len(tails), 7)]
    parts = [b["tail"].to_pylist() for b in treeweight.blocks(iter(batches))]
    assert [x for p in parts for x in p] == tails and len(parts) > 3
    assert sum(len(set(p)) for p in parts) == len(set(tails))
