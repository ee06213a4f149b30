"""Personal data: rules against plain patterns, messages against enumeration, and damaged repetitions on held-out documents."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from millrace.llm import pii

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def plainly(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            double = sum(int(d) if k % 2 == 0 else (2 * int(d) - 9 if int(d) > 4 else 2 * int(d)) for k, d in enumerate(digits[::-1]))
            fits = (True, all(int(x) < 256 for x in m.group().split(".")) if kind == 1 else True, 12 <= len(digits) <= 19 and double % 10 == 0, 9 <= len(digits) <= 15)
            if fits[kind]:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_rules_equal_plain_patterns():
    rng = random.Random(3)
    parts = ["a", ".", "@", "1", "23", "255", "256", "007", " ", "-", "+", "(", ")", "\n", "x.y", "4111111111111111", "_", "é", "@b.c", "0"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        assert pii.by_rules(text) == plainly(text), text


def test_rules_on_long_texts_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" * 150_000, "a@" * 150_000, "1 " * 150_000 + "x"):
        rules = pii.by_rules(text)
        pii.tokens(text, rules)


def test_messages_are_exact_on_trees_and_near_on_loops():
    rng = np.random.default_rng(0)
    for loop in (False, True):
        unary = rng.normal(size=(6, 3))
        edges = np.array([(0, 1), (1, 2), (1, 3), (3, 4), (0, 5)] + ([(4, 5)] if loop else []))
        tables = rng.normal(size=(len(edges), 3, 3)) * (0.5 if loop else 1.5)
        want = np.zeros((6, 3))
        for labels in itertools.product(range(3), repeat=6):
            weight = np.exp(sum(unary[k, v] for k, v in enumerate(labels)) + sum(t[labels[a], labels[b]] for (a, b), t in zip(edges, tables)))
            for k, v in enumerate(labels):
                want[k, v] += weight
        want /= want.sum(axis=1, keepdims=True)
        assert np.abs(pii.beliefs(unary, edges, tables) - want).max() < (0.05 if loop else 1e-3)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.1/documents.parquet")


@pytest.fixture(scope="module")
def field(documents):
    return pii.train(documents.filter("crc32(cast(cast(doc_id as string) as binary)) % 2 = 0"))


def test_damaged_repetitions_of_held_out_documents(documents, field):
    """A field fitted to half of the documents finds damaged repetitions in the others, through its skip edges, and leaves damaged strangers alone."""
    rows = documents.filter("crc32(cast(cast(doc_id as string) as binary)) % 2 = 1 and text rlike '[0-9@]'").select("text").collect()
    texts = sorted(r.text for r in rows)
    mentions = [(t[s:e], kind) for t in texts for s, kind, e in pii.by_rules(t)]
    counts = {"own": [0, 0], "own without skips": [0, 0], "strangers": [0, 0]}
    alone = field._replace(skip=field.skip * 0)
    for text in texts:
        rng = random.Random(text)
        text, marks = pii._with_copies(text, pii.by_rules(text), rng.sample(mentions, 2), rng)
        rules = pii.by_rules(text)
        t = pii.tokens(text, rules)
        for name, weights in (("own", field), ("own without skips", alone)):
            spans = pii.added(t, pii.label_probabilities(weights, [t])[0])
            for s, e, label in marks:
                if not any(a < e and s < b for a, _, b in rules):
                    hit = any(a < e and s < b and kind + 1 == (label or kind + 1) for a, kind, b in spans)
                    if label or name == "own":
                        counts[name if label else "strangers"][0] += hit
                        counts[name if label else "strangers"][1] += 1
    (own, n), (without, _), (wrong, m) = counts.values()
    assert n > 100 and own >= 0.9 * n and without <= 0.1 * n and wrong <= 0.05 * m
    plain = list(pii.describe(texts, field))
    assert sum(r[-1] for r in plain) <= 0.02 * len(texts)


def test_consistency_over_a_document(field):
    text = "write to jo.27@mail3.example.com soon; later jo.27 said no, and 217.75.41.129 fell, again 217 75 41 129 fell. call +1 (437) 555-0689, I mean 437.555.0689 now"
    ((n_email, n_ip, n_card, n_phone, base, spans, more),) = pii.describe([text], field)
    assert (n_email, n_ip, n_card, n_phone, more) == (1, 1, 0, 1, 3) and base == hashlib.sha256(pii.named(plainly(text)).encode()).hexdigest()
    found = [(s.split(":")[0], text[slice(*map(int, s.split(":")[1:]))]) for s in spans.split(",")]
    assert ("email", "jo.27") in found and ("ip", "217 75 41 129") in found and ("phone", "437.555.0689") in found
    ((*_, spans, more),) = pii.describe(["later jo.27 said no, and again 217 75 41 129 fell, I mean 437.555.0689 now"], field)
    assert (spans, more) == ("", 0)


def test_odd_tables(spark):
    mail = "a.b1@c.example and a.b1 again"
    rows = [(1, None, "x"), (2, "", "x"), (None, mail, "x"), (3, mail, "x"), (3, mail, "x"), (4, f"{mail} " * 20_000, "x"), (5, "no mark at all", "x"), (6, "é 4111 1111 1111 1111\n", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = pii.find(docs).collect()
    assert len(got) == len(rows) and [r.n_email for r in sorted(got, key=lambda r: r.doc_id or 0)] == [1, 0, 0, 1, 1, 20_000, 0, 0]
    assert all(r.base_sha256 == hashlib.sha256(pii.named(plainly(t or "")).encode()).hexdigest() for r in got for d, t, _ in rows if d == r.doc_id)
    assert {r.spans for r in got if r.doc_id == 6} == {"card:2:21"} and len({(r.spans, r.n_added) for r in got if r.doc_id == 3}) == 1
    assert pii.find(docs.limit(0)).count() == 0
    unfitted = pii.find(docs.filter("doc_id = 5")).collect()
    assert [(r.n_added, r.spans) for r in unfitted] == [(0, "")]
