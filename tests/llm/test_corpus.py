"""Corpus operators against brute force on a small table with every odd case: nulls, empty and long texts, ties,
repeated rows, empty tables, extra columns with clashing names."""

import collections
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from recordloom.llm import decontaminate, htmltext, licenses, mixing, neardup, pii, quality, sharding, substrings, urlfilter
from recordloom.llm.components import components
from recordloom.llm.suffix import suffix_array

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, size string, label string, n long, key string"
ITEM = "which of the following rivers flows through the largest number of countries before it reaches the sea"


def texts():
    r = random.Random(5)
    vocabulary = ["w%d" % i for i in range(400)] + ["the", "of", "and", "de", "is"] * 12
    base = [r.choice(vocabulary) for _ in range(160)]
    shared = " ".join(r.choice(vocabulary) for _ in range(60))
    out = [None, "", " \t\n", "one two", "one two", "under the MIT License", "a", "\n\n"]
    for k in range(6):
        words = list(base)
        for _ in range(k):
            words[r.randrange(len(words))] = "x%d" % r.randrange(50)
        out.append(" ".join(words))
    out += [" ".join(base)] * 4
    for k in range(5):
        fresh = " ".join(r.choice(vocabulary) for _ in range(90))
        out.append(f"{fresh} {shared}\n{fresh[:50]} é\u00fc {ITEM if k % 2 else ''} mail a.b@c.de, +44 20 7946 0958 or 10.0.0.256 10.0.0.1 or 4111 1111 1111 1111.")
    out.append(" ".join(r.choice(vocabulary) for _ in range(6000)))
    out.append("ab" * 1500)
    out.append("Licensed under the Apache License, Version 2.0; CC BY NC. under the mit license under the mit license")
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", None if i % 7 == 0 else "s%d" % (i % 3), 1, 9, "z", "y", 3, "k") for i, t in enumerate(texts())]
    rows += [rows[9], (None, "one two", None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def split(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def test_suffix_array():
    r = random.Random(2)
    for _ in range(400):
        x = [r.randint(0, r.choice([1, 3])) for _ in range(r.randint(0, 25))]
        assert suffix_array(x) == sorted(range(len(x)), key=lambda i: x[i:])


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 100: 100, 101: 100, 102: 100}


def test_quality(docs, empty):
    for r in quality.quality_rules(docs).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        w = split(r["text"])
        seen = collections.Counter(zip(w, w[1:], w[2:]))
        hit = {i + k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in (r["text"] or "").split("\n") if split(x)]
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"], r["n_dup_lines"]) == (len(w), sum(map(len, w)), len(hit), len(lines) - len(set(lines)))
        assert r["base_failed"] == (len(w) < 50 or 100 * len(hit) > 50 * len(w))
    assert quality.keep_good(docs).columns == docs.columns and quality.keep_good(empty).isEmpty()


def test_near_duplicates(docs, empty, spark):
    placed = neardup.with_place(docs.select("doc_id", "text"))
    got = neardup.near_duplicates(placed, 3, 85).collect()
    sets = {}
    for r in docs.collect():
        w = (r["text"] or "").lower().split()
        sets.setdefault(r["doc_id"], frozenset(zip(w, w[1:], w[2:])) if len(w) > 2 else frozenset([tuple(w)] if w else []))
    label = {i: i for i in sets if i is not None}
    for _ in label:
        for i in label:
            for j in label:
                both = len(sets[i] & sets[j])
                if both and 100 * both >= 85 * len(sets[i] | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
    for r in got:
        assert r["n"] == len(sets[r["doc_id"]])
        assert r["component"] == (label[3] if r["doc_id"] is None else label[r["doc_id"]])
    kept = neardup.keep_one(docs, width=3, percent=85)
    assert kept.columns == docs.columns and neardup.keep_one(empty).isEmpty()
    full = {i for i, c in label.items() if i == c and sets[i]}
    assert sorted(r["doc_id"] for r in kept.collect() if sets[r["doc_id"]]) == sorted(full)


@pytest.mark.parametrize(("width", "percent", "sizes"), [(3, 85, (5, 6, 7)), (5, 80, (3, 4, 5, 6, 7))])
def test_near_duplicates_of_few_shingles(spark, width, percent, sizes):
    # each text is the one before and a word more: n of n + 1 shingles are shared
    rows = [(10 * k + n, " ".join(f"v{k}x{i}" for i in range(n + width - 1))) for k in range(8) for n in sizes]
    placed = neardup.with_place(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: (r["n"], r["component"]) for r in neardup.near_duplicates(placed, width, percent).collect()}
    # the first can only be linked to equal texts, the others form a chain
    assert got == {10 * k + n: (n, 10 * k + (n if n == sizes[0] else sizes[1])) for k in range(8) for n in sizes}


@pytest.mark.parametrize("crowd", [0, 64])
def test_near_duplicates_in_crowded_buckets(spark, monkeypatch, crowd):
    # pages of one template share bands but are not linked (similarity 0.74); some have a near copy, some of these another
    monkeypatch.setattr(neardup, "CROWD", crowd)
    r = random.Random(11)
    common = [f"c{i}" for i in range(180)]
    rows, want = [], {}
    for k in range(240):
        words = common + [f"o{k}x{i}" for i in range(30)]
        for copy in range(3 if k % 9 == 0 else 2 if k % 3 == 0 else 1):
            if copy:
                words[r.randrange(60)] = f"e{k}x{copy}"
            rows.append((1000 * copy + k, " ".join(words)))
            want[1000 * copy + k] = k
    placed = neardup.with_place(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {x["doc_id"]: x["component"] for x in neardup.near_duplicates(placed, 3, 85).collect()}
    assert got == want


def test_pairs_of_crowded_buckets_are_named_once(spark, monkeypatch):
    """Pairs that meet by several rare shingles came once for each of them, and every shared shingle of a crowded page was joined."""
    seen = []

    def across(labelled, split, sketches, percent, banded):
        pairs = real(labelled, split, sketches, percent, banded)
        if not banded:
            seen.append((labelled.count(), pairs.count(), pairs.distinct().count()))
        return pairs

    real = neardup.across
    monkeypatch.setattr(neardup, "across", across)
    monkeypatch.setattr(neardup, "CROWD", 8)
    # pages of one template, just below the threshold with each other and close enough for the estimate
    common = [f"c{i}" for i in range(180)]
    rows = [(k, " ".join([*common, *(f"o{k // 2 if i < 10 else k}x{i}" for i in range(28))])) for k in range(80)]
    placed = neardup.with_place(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {x["doc_id"]: (x["n"], x["component"]) for x in neardup.near_duplicates(placed, 3, 85).collect()}
    assert got == {k: (206, k) for k in range(80)}
    # each page keeps no more of its 206 shingles than the 31 by which linked sets must meet, and only those that others have
    assert seen and all(keys <= 80 * 31 and pairs == distinct > 0 for keys, pairs, distinct in seen)


@pytest.mark.parametrize("most", [1, 256])
def test_repeated_passages(docs, empty, most):
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()]
    seen = collections.Counter(d[i : i + 200] for _, d in rows for i in range(len(d) - 199))
    want = []
    for i, d in rows:
        gone = bytearray(len(d))
        for k in range(len(d) - 199):
            if seen[d[k : k + 200]] > 1:
                gone[k : k + 200] = b"\1" * 200
        rest = bytes(c for c, g in zip(d, gone, strict=True) if not g)
        want.append((i, len(d), sum(gone), sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1])), hashlib.sha256(rest).hexdigest()))
    got = [tuple(r)[:5] for r in substrings.remove_repeats(docs, most=most).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert substrings.remove_repeats(empty).isEmpty()


def test_decontamination(spark, docs, empty):
    items = spark.createDataFrame([(1, ITEM), (2, "never seen words in any text of this table"), (3, None), (4, "too short"), (1, ITEM)], "item_id long, text string")
    want = sorted(r["doc_id"] for r in docs.collect() if ITEM in (r["text"] or ""))
    leaks = decontaminate.find_leaks(docs, items, block_bytes=10).collect()
    assert sorted({r["doc_id"] for r in leaks}) == want and {r["item_id"] for r in leaks} == {1}
    clean = decontaminate.without_leaks(docs, items)
    assert clean.columns == docs.columns and clean.count() == docs.count() - len(want)
    assert decontaminate.find_leaks(empty, items).isEmpty() and decontaminate.find_leaks(docs, items.limit(0)).isEmpty()


def test_decontamination_by_item_length(spark):
    r = random.Random(11)
    items = [[f"i{k}w{j}" for j in range(n)] for k, n in enumerate((5, 6, 7, 8, 20, 66, 69, 90))]
    rows = []
    for d in range(150):
        words = [f"v{r.randrange(5000)}" for _ in range(r.randrange(8, 300))]
        for item in items:
            part = list(item)
            if len(item) > 8 and d % 3:
                part[r.randrange(len(item))] = "changed"
            at = r.randrange(len(words))
            words[at:at] = part
        rows.append((d, " ".join(words)))

    def shingles(w):
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    want = {}
    for d, text in rows:
        whole = shingles(text.split())
        for i, item in enumerate(items):
            n, both = len(shingles(item)), len(shingles(item) & whole)
            if both >= 0.8 * n:
                want[d, i] = (n, both)
    leaks = decontaminate.find_leaks(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    )
    assert {(x["doc_id"], x["item_id"]): (x["n_shingles"], x["n_shared"]) for x in leaks.collect()} == want


def test_mixing(docs, empty):
    sized = docs.select("doc_id", "source", mixing.word_count(docs["text"]).alias("size"))
    got = mixing.mix(sized, ["doc_id"]).collect()
    assert len(got) == docs.count() and all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in got)
    by = collections.defaultdict(lambda: [0, 0])
    for r in got:
        by[r["source"]][0] += r["taken"]
        by[r["source"]][1] = r["target"]
    total = sum(r["size"] for r in got)
    assert abs(sum(t for _, t in by.values()) - 1.5 * total) < 1e-3 * total
    # whole texts are taken: half of the largest at most, of which one source has one of 6000 words and the others of 170
    largest = collections.defaultdict(int)
    for r in got:
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert all(abs(a - t) <= largest[s] / 2 for s, (a, t) in by.items()), by
    # reruns agree, also where a group of equal size is dealt in salted parts
    for rows in (2048, 4):
        one, two = (mixing.mix(d, ["doc_id"], salt_rows=rows).collect() for d in (sized, sized.repartition(5)))
        assert sorted(map(tuple, one), key=repr) == sorted(map(tuple, two), key=repr)
    assert mixing.mix_rows(docs).columns == docs.columns and mixing.mix_rows(empty).isEmpty()


def test_sharding(docs, empty, spark):
    got = sharding.shard_rows(spark.range(1000).withColumnRenamed("id", "slot"), 7).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    assert sorted(map(len, by.values())) == [142, 143, 143, 143, 143, 143, 143]
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    matrix = [r["counts"] for r in sharding.communication_matrix(spark, 1000, 7, 3, block_rows=64).orderBy("block").collect()]
    assert [sum(c) for c in matrix] == [64] * 15 + [40] and sorted(map(sum, zip(*matrix, strict=True))) == [142, *[143] * 6]
    assert sharding.shard_rows(docs, 40).count() == docs.count() and sharding.shard_rows(empty).isEmpty()


def test_sharding_keeps_columns(spark):
    df = spark.range(100).selectExpr("id", "id * 2 as Slot", "cast(null as string) as shard", "id as slot_")
    got = sharding.shard_rows(df, 3)
    assert got.columns == ["id", "Slot__", "shard_", "slot_", "shard", "slot"]
    rows = got.collect()
    assert {(r["id"], r["Slot__"], r["slot_"]) for r in rows} == {(i, 2 * i, i) for i in range(100)}
    assert sorted((r["shard"], r["slot"]) for r in rows) == [(k, j) for k in range(3) for j in range(34 if k == 0 else 33)]


def test_mixing_of_many_sizes(spark):
    # one source with every size once and one with a few: words come near the targets, whole texts only
    rows = [(i, "a", i + 1) for i in range(20000)] + [(20000 + i, "b", 50 + i % 7) for i in range(4000)] + [(30000, "b", 300000), (30001, "a", 0)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, size long"), ["doc_id"]).collect()
    assert len(got) == len(rows) and all(r["copies"] in (0, 1, 2) and r["taken"] == r["copies"] * r["size"] for r in got)
    taken, target = collections.Counter(), {}
    for r in got:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    # multipliers are found to a millionth of the target; the smallest documents have one word and 50
    assert all(abs(taken[s] - target[s]) <= 1e-6 * target[s] + least for s, least in (("a", 1), ("b", 25)))


def test_licenses(docs, empty):
    rows = {r["doc_id"]: r for r in licenses.scan_licenses(docs).collect()}
    last = rows[max(i for i in rows if i is not None)]
    assert (last["n_base"], last["first_word"], last["last_word"], last["base_labels"]) == (4, 3, 15, "apache-2,cc-by-nc,mit")
    assert (rows[5]["n_base"], rows[5]["labels"], rows[0]["n_words"], rows[0]["score"]) == (1, "mit", 0, 0.0)
    assert licenses.scan_licenses(empty).isEmpty()


def test_licenses_of_edited_notices(spark):
    bsd, mit = (max((t.words for t in licenses.TEMPLATES if t.label == x), key=len) for x in ("bsd", "mit"))

    def changed(words, *places):
        return ["other" if i in places else w for i, w in enumerate(words)]

    cases = [
        (changed(bsd, 6, 13), "bsd", 19 / 21), (changed(mit, 8, 18), "mit", (len(mit) - 2) / len(mit)), (changed(bsd, 1, 19), "bsd", 19 / 21),
        (changed(bsd, 3, 5, 12, 14), "bsd", 17 / 21), (changed(bsd, 3, 5, 7, 12, 14), "", 16 / 21),
        # two words in addition after one, and one missing
        ([*bsd[:7], "x", "y", *bsd[7:]], "bsd", 1.0), (bsd[:9] + bsd[10:], "bsd", 20 / 21),
        # a single word before an addition, and one behind it, next to changed ones
        ([*changed(bsd, 6)[:8], "x", *changed(bsd, 9)[8:]], "bsd", 19 / 21),
        (bsd[:10], "", 10 / 21),
    ]
    table = spark.createDataFrame([(i, " ".join(["some", "words", *w, "more"])) for i, (w, _, _) in enumerate(cases)], "doc_id long, text string")
    got = {r["doc_id"]: (r["labels"], round(r["score"], 6)) for r in licenses.scan_licenses(table).collect()}
    assert got == {i: (label, round(score, 6)) for i, (_, label, score) in enumerate(cases)}


def test_personal_data(docs, empty):
    for r in pii.find_personal_data(docs.filter("text like '%mail a.b@c.de%'")).join(docs.select("doc_id", "text"), "doc_id").collect():
        found = {(s["kind"], r["text"][s["start"] : s["end"]]) for s in r["base"]}
        assert found == {(0, "a.b@c.de"), (1, "10.0.0.1"), (2, "4111 1111 1111 1111"), (3, "+44 20 7946 0958")}
        assert set(map(tuple, r["base"])) <= set(map(tuple, r["spans"]))
    assert pii.find_personal_data(docs).count() == docs.count() and pii.find_personal_data(empty).isEmpty()


def test_personal_data_of_any_length(spark):
    for k in (1, 3, 4000):
        secret, word, name, number = "a1B2c3D4e5F6g7H8i9J0" * k, "p4ssw0rd-!" * k, "first.last" * k, "12 34-5678" * k
        text = f"key {secret} or password={word} or {name}@{name}.org or {number} end"
        got = spark.createDataFrame([(text,)], "text string").select(pii.candidates(F.col("text")).alias("c")).collect()[0]["c"]
        spans = {(c["kind"], text[c["start"] : c["end"]]) for c in got}
        assert {(6, secret), (6, f"password={word}"), (5, f"{name}@{name}.org"), (4, number)} <= spans


def test_personal_data_of_a_rare_generator(spark):
    # of 4,012 candidates 12 are addresses: a sample of the whole has none of them
    rows = [(1, i, 0, 6, i % 2 == 0, float(i % 2), 6.0) for i in range(4000)] + [(2, i, 0, 5, i % 3 > 0, float(i % 3 == 0), 5.0) for i in range(12)]
    cands = spark.createDataFrame(rows, f"{pii.FILE} long, {pii.ROW} long, start int, kind int, label boolean, f_mark double, f_kind double")
    got = pii.scored(cands, train_rows=60).collect()
    assert len(got) == len(rows) and all(r["chosen"] == r["label"] for r in got)


def test_urls(spark):
    urls = [None, "", "no host", "http://ORG", "http://x.Example.ORG/es/1", "a://example.org/en/12?q", "http://com/de/", "http://notcom/de/", "://a.com/fr/x#y", "http://xorg/"]
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    want = [
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("org", "", None, "allow"), ("x.example.org", "/es/1", "example.org/es/", "block"),
        ("example.org", "/en/12", "example.org/en/1", "block"), ("com", "/de/", "com/de/", "block"), ("notcom", "/de/", None, "allow"), ("a.com", "/fr/x", "com/fr/", "allow"),
        ("xorg", "/", None, "allow"),
    ]
    for limit in (urlfilter.MAX_BYTES, 0):
        got = urlfilter.filter_urls(rows, max_bytes=limit).orderBy("page_id").collect()
        assert [tuple(r)[1:] for r in got] == want
    assert urlfilter.filter_urls(rows.limit(0)).isEmpty()


def test_html():
    page = (
        "<html><head><title>t</title><style>p{}</style></head><body><nav><a>Home</a></nav><div class='cookie-notice'>We use cookies, and so on, always.</div>"
        "<div id=main><h1>A title &amp; more</h1><p>First <b>long\n paragraph, with words, and marks.<br>next<p>Second long paragraph, also with words; and marks.</div>"
        "<div class=comments><p>I like this text, it is long, and a comment.</p></div><footer>&copy; somebody</footer>"
    )
    want = "A title & more\n\nFirst long paragraph, with words, and marks. next\n\nSecond long paragraph, also with words; and marks."
    assert htmltext.main_text(page) == want
    assert [htmltext.main_text(x) for x in (None, "", "<p>", "<script>x")] == [""] * 4


def test_html_in_several_containers():
    long, short = "A long paragraph, with words, and marks; it goes on. " * 7, "Another paragraph, with words, and marks. " * 4
    want = f"A title\n\n{long.strip()}\n\n{short.strip()}\n\nShort end"
    nav, foot = "<nav><a>Home</a></nav>", "<footer>somebody, somewhere.</footer>"
    for tag in ("section", "div"):
        page = f"<html><body>{nav}<article><h1>A title</h1><{tag}><p>{long}</p></{tag}><{tag}><p>{short}</p></{tag}><p>Short end</p></article>{foot}"
        assert htmltext.main_text(page) == want
    page = f"<body>{nav}<div><h1>A title</h1><table><tr><td><p>{long}</p></td><td><p>{short}</p></td></tr></table><p>Short end</p></div>{foot}"
    assert htmltext.main_text(page) == want
    # text outside of main is foreign
    assert htmltext.main_text(f"<body><div><p>{short}</p></div><main><p>{long}</p><p>{short}</p></main>{foot}") == f"{long.strip()}\n\n{short.strip()}"


@pytest.mark.parametrize("name", ["content has-sidebar", "no-sidebar", "related-work", "search-engines", "widget", "site-header", "social", "hidden"])
def test_html_names_that_hold_the_content(name):
    long = "A long paragraph, with words, and marks; it goes on."
    page = (
        f"<html><body><div class='main-nav menu'>Home, sweet</div><div class='{name}'><h1>A title</h1><p>{long} {long}</p><p>{long}<span class='share'>Share</span><br>end</p></div>"
        f"<div id=sidebar><p>Also with marks, and words.</p></div><div class='x comment-list comments'><p>{long} {long} {long} {long} {long} {long}</p></div>"
    )
    assert htmltext.main_text(page) == f"A title\n\n{long} {long}\n\n{long} end"


def test_html_names_on_a_section():
    long = "A long paragraph, with words, and marks; it goes on. " * 3
    page = f"<body><article><section><p>{long}</p></section><section id='related-work'><p>{long}</p></section><div class='x related'><p>{long}</p></div></article>"
    assert htmltext.main_text(page) == f"{long.strip()}\n\n{long.strip()}"


def test_pipeline(spark, docs, tmp_path):
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert out and all(ITEM not in r["text"] and len(split(r["text"])) >= 50 for r in out)
    assert len(corpus_pipeline.STAGES) == 5
