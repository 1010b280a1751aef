"""Columns that contracts fix, of whole tables, against brute force: mixing, license scans, sharding."""

import re
import zlib
from collections import Counter

import pytest

from recordloom.llm import licenses, mixing, sharding

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_op1_targets(spark, docs):
    rows = {r.doc_id: r for r in mixing.op1(spark, SF).collect()}
    sizes = {i: len(re.findall(r"[^\x20\x09-\x0D]+", d.text or "")) for i, d in docs.items()}
    held = Counter()
    for i, d in docs.items():
        held[d.source] += sizes[i]
    names = sorted((s for s in held if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in held)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    total, full = 1.5 * sum(held.values()), set()
    while True:
        rest = total - sum(2 * held[s] for s in full)
        open_weight = sum(weight[s] for s in names if s not in full)
        target = {s: 2.0 * held[s] if s in full else rest * weight[s] / open_weight for s in names}
        over = {s for s in names if s not in full and target[s] > 2 * held[s]}
        if not over:
            break
        full |= over
    taken = Counter()
    for i, d in docs.items():
        r = rows[i]
        assert (r["size"], r.source_size) == (sizes[i], held[d.source]) and abs(r.target - target[d.source]) < 1e-6 * max(1, target[d.source])
        assert 0 <= r.taken <= 2 * r["size"] and (not r["size"] or r.taken % r["size"] == 0)
        taken[d.source] += r.taken
    for s in names:
        largest = max(sizes[i] for i, d in docs.items() if d.source == s)
        assert abs(taken[s] - target[s]) <= max(largest, 0.02 * target[s])


def test_op5_base_columns(spark, docs):
    phrases = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
    rows = {r.doc_id: r for r in licenses.op5(spark, SF).collect()}
    assert len(rows) == len(docs)
    seen = 0
    for i, d in docs.items():
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in d.text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = [(k, label) for p, label in phrases.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
        seen += len(places)
        starts = [k for k, _ in places]
        r = rows[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(words), len(places), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert seen


def test_op6_columns(spark, docs):
    rows = sharding.op6(spark, SF).collect()
    assert len(rows) == len(docs)
    slots = {}
    for r in rows:
        body = (docs[r.doc_id].text or "").encode()
        assert (r["size"], r.text_crc32) == (len(body) + 16, zlib.crc32(body))
        slots.setdefault(r.shard, []).append(r.slot)
    counts = [len(slots.get(k, [])) for k in range(40)]
    assert max(counts) - min(counts) <= 1 and all(sorted(s) == list(range(len(s))) for s in slots.values())
