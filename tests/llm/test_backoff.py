"""The backoff automaton against a dictionary model, and as a distribution over the vocabulary."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from millrace.llm import lm


class Dictionary:
    def __init__(self, texts, priors):
        self.priors, self.counts, self.history = priors, Counter(), Counter()
        for t in texts:
            tokens = ["<s>", *t.encode().lower().split(), "</s>"]
            for i in range(1, len(tokens)):
                for k in range(len(priors) + 1):
                    if i - k >= 0:
                        self.counts[tuple(tokens[i - k : i + 1])] += 1
                        self.history[tuple(tokens[i - k : i])] += 1
        self.n, self.v = self.history[()], sum(1 for g in self.counts if len(g) == 1)

    def probability(self, history, word):
        if not history:
            return (self.counts[(word,)] + 1) / (self.n + self.v + 1)
        prior = self.priors[len(history) - 1]
        return (self.counts[(*history, word)] + prior * self.probability(history[1:], word)) / (self.history[history] + prior)

    def score(self, text):
        tokens = ["<s>", *text.encode().lower().split(), "</s>"]
        return sum(math.log10(self.probability(tuple(tokens[max(0, i - len(self.priors)) : i]), tokens[i])) for i in range(1, len(tokens)))


def rows(seed=2, n=200):
    rng = random.Random(seed)
    words = "a B c d e é of the in".split()
    return [(k, " ".join(rng.choice(words) if rng.random() < 0.9 else f"w{rng.randint(0, 99)}" for _ in range(rng.randint(0, 25)))) for k in range(n)] + [(7, ""), (8, "the the the"), (8, "the the the")]


@pytest.mark.parametrize("priors", [(), (3.0,), (50.0, 2.0), (10.0, 5.0, 1.5)])
def test_scores_equal_a_dictionary_model(spark, priors):
    data = rows()
    held = {k for k, _ in data if zlib.crc32(str(k).encode()) % 7 == 2}
    model = Dictionary([t for k, t in data if k not in held], priors)
    got = lm.score(spark.createDataFrame(data, "doc_id long, text string"), priors=priors, block_bytes=500).collect()
    want = sorted((k, k in held, round(model.score(t), 6)) for k, t in data)
    assert sorted((r.doc_id, r.held_out, round(r.score, 6)) for r in got) == want and any(r.held_out for r in got)


def test_probabilities_of_all_words_sum_to_one(spark):
    """Texts that differ in one word alone: their scores' ratios are the word's probabilities after a history, times what follows."""
    data = rows()
    held = {k for k, _ in data if zlib.crc32(str(k).encode()) % 7 == 2}
    train = [t for k, t in data if k not in held]
    vocabulary = sorted({w for t in train for w in t.encode().lower().split()}) + [b"never-seen"]
    free = [k for k in range(10_000, 30_000) if zlib.crc32(str(k).encode()) % 7 == 2]
    priors = (50.0, 2.0)
    model = Dictionary(train, priors)
    for history in (["of", "the"], ["the"], [], ["unheard", "of"]):
        ids = free[: len(vocabulary) + 1]
        probes = [(k, " ".join([*history, w.decode()])) for k, w in zip(ids, vocabulary, strict=False)] + [(ids[-1], " ".join(history))]
        got = {r.doc_id: r.score for r in lm.score(spark.createDataFrame(data + probes, "doc_id long, text string"), priors=priors).filter("doc_id >= 10000").collect()}
        tokens = ["<s>", *(h.encode() for h in history)]
        before = sum(math.log10(model.probability(tuple(tokens[max(0, i - 2) : i]), tokens[i])) for i in range(1, len(tokens)))
        total = 0.0
        for k, w in zip(ids, vocabulary, strict=False):
            after = math.log10(model.probability((tokens[-1], w), "</s>"))
            total += 10 ** (got[k] - before - after)
        total += 10 ** (got[ids[-1]] - before)
        assert abs(total - 1) < 1e-9


def test_odd_tables(spark):
    data = [(None, None, 1), (None, "x y", 2), (1, "", 3), (1, "x y", 4), (2, "x " * 300_000, 5)]
    frame = spark.createDataFrame(data, "doc_id long, text string, score int").withColumnRenamed("score", "held_out")
    got = lm.score(frame).collect()
    assert len(got) == 5 and sorted(r.n_tokens for r in got) == [1, 1, 3, 3, 300_001] and all(math.isfinite(r.score) for r in got)
    assert len({r.score for r in got if r.n_tokens == 3}) == 1
    assert lm.score(frame.limit(0)).count() == 0
    alone = spark.createDataFrame([(k, "a b") for k in range(200) if zlib.crc32(str(k).encode()) % 7 == 2], "doc_id long, text string")
    assert {r.score for r in lm.score(alone).collect()} == {0.0}


def test_equal_rows_fill_blocks_of_their_own(spark):
    """Rows that are all alike are dealt as they come: no block takes them all, and each counts."""
    same = spark.range(100_000).selectExpr("cast(null as long) doc_id", "'the same few words' text")
    got = lm.score(same, block_bytes=1 << 18)
    assert got.selectExpr("count(*) n", "min(n_tokens) a", "max(n_tokens) b", "max(train_tokens) t", "count(distinct score) s").first()[:] == (100_000, 5, 5, 500_000, 1)
    layout = "block long, ids array<long>, held_out array<boolean>, lengths array<int>, texts binary, size long"
    rows = same.selectExpr("doc_id", "cast(text as binary) text", "false held_out")
    sizes = [r.n for r in rows.mapInArrow(lm._deal(1 << 18, pa.int64()), layout).selectExpr("size(ids) n").collect()]
    assert sum(sizes) == 100_000 and max(sizes) * (18 + lm.ROW_BYTES) <= 1 << 18


def test_longer_histories_foretell_held_out_texts_better(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    bigrams, trigrams = (lm.score(docs, priors=p).filter("held_out").selectExpr("sum(score) / sum(n_tokens) s", "sum(base_score) / sum(n_tokens) b").first() for p in (lm.PRIORS[:1], lm.PRIORS))
    assert trigrams.b == pytest.approx(bigrams.b) and trigrams.s > bigrams.s > bigrams.b
    assert len(lm.PRIORS) == 2


def test_keys_are_ascending_and_come_back():
    grams = np.unique(np.random.default_rng(1).integers(0, 1 << 56, 5000, dtype=np.uint64))
    for buckets in (1, 16, 1000, 1 << 20):
        for k in (0, 1):
            keys = lm._keys(grams, k, buckets)
            steps = lm._unpacked(lm._packed(np.diff(keys, prepend=np.uint64(0))))
            assert (np.cumsum(steps, dtype=np.uint64) == keys).all() and (k == 0 or int(keys.max()).bit_length() <= lm.KEY_BITS)
