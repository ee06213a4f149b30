"""Benchmark passages in texts: recall at the full bound for items of every size, verdicts by text alone, odd tables."""

import numpy as np
import pytest
from millrace.llm import decontaminate

VOCABULARY = np.array([f"w{k}" for k in range(5000)])


def text(words):
    return " ".join(VOCABULARY[np.asarray(words, np.int64)]).encode()


def nearest(item, body):
    """Least edit distance from the item to any stretch of the body, one cell at a time."""
    row = [0] * (len(body) + 1)
    for k, x in enumerate(item, 1):
        new = [k]
        for j, y in enumerate(body, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


@pytest.mark.parametrize(("least", "most"), [(1, 1), (2, 3), (4, 7), (8, 15), (16, 31), (32, 63), (64, 127), (128, 255), (256, 600)])
def test_recall_at_a_fifth_of_edits(least, most):
    rng = np.random.default_rng([least, most])
    items = [rng.integers(0, 5000, int(rng.integers(least, most + 1))) for _ in range(40)]
    index = decontaminate.Index(list(enumerate(map(text, items))))
    hits = planted = 0
    for _ in range(3):
        bodies = []
        for item in items:
            copy = decontaminate.edited(item.astype(np.uint64), int(decontaminate.EDITS * len(item)), rng).astype(np.int64) % 5000
            body = rng.integers(0, 5000, 120)
            at = int(rng.integers(0, 121))
            bodies.append(np.concatenate([body[:at], copy, body[at:]]))
        found = index.search([text(b) for b in bodies])
        for k, (body, got) in enumerate(zip(bodies, found, strict=True)):
            planted += 1
            hits += k in {g[0] for g in got}
            for item, start, n, distance in got:
                assert distance <= decontaminate.EDITS * len(items[item])
                if len(body) < 200:
                    assert nearest(items[item].tolist(), body.tolist()) == distance == nearest(items[item].tolist(), body[start : start + n].tolist())
    assert hits >= 0.95 * planted


def test_short_texts_against_brute_force():
    """Few distinct words, so that stretches repeat and tie: what is reported holds, and nearly all that brute force finds is reported."""
    rng = np.random.default_rng(4)
    items = [rng.integers(0, 12, int(rng.integers(1, 20))) for _ in range(30)]
    bodies = [rng.integers(0, 12, int(rng.integers(0, 60))) for _ in range(60)]
    found = decontaminate.Index(list(enumerate(map(text, items)))).search([text(b) for b in bodies])
    want = {(d, k): nearest(i.tolist(), b.tolist()) for d, b in enumerate(bodies) for k, i in enumerate(items) if len(b)}
    want = {pair: n for pair, n in want.items() if n <= decontaminate.EDITS * len(items[pair[1]])}
    got = {(d, g[0]): g[3] for d, some in enumerate(found) for g in some}
    assert set(got) <= set(want) and len(got) >= 0.95 * len(want)
    assert sum(got[p] == want[p] for p in got) >= 0.95 * len(got)


def test_a_text_is_judged_by_itself():
    rng = np.random.default_rng(8)
    items = [rng.integers(0, 5000, int(rng.integers(1, 300))) for _ in range(50)]
    index = decontaminate.Index(list(enumerate(map(text, items))))
    bodies = []
    for k in range(100):
        item = items[k % 50]
        copy = decontaminate.edited(item.astype(np.uint64), int(decontaminate.EDITS * len(item)), rng).astype(np.int64) % 5000
        bodies.append(text(np.concatenate([rng.integers(0, 5000, k % 7), copy, rng.integers(0, 5000, k % 5)])))
    alone = [index.search([b])[0] for b in bodies]
    assert index.search(bodies) == alone and index.search(bodies[::-1]) == alone[::-1]


def test_odd_tables(spark):
    prose = "when the seven old boats came back from the far northern islands nobody stood on the quay to greet them"
    docs = spark.createDataFrame(
        [(1, None, "a", 1), (2, "", "b", 2), (3, f"It began so: {prose.upper()}!", "c", 3), (3, f"It began so: {prose.upper()}!", "c", 3), (None, prose, None, None), (4, "word " * 200_000 + prose, "d", 4), (5, prose.replace("quay", "pier").replace("old", "new"), "e", 5), (6, " ".join(prose.split()[:12]), "f", 6)],
        "doc_id long, text string, item_id string, __leaks int",
    )
    bench = spark.createDataFrame([(10, prose, "x"), (11, prose + ".", "x"), (12, None, None), (13, "", ""), (None, "!!! ...", "")], "item_id long, text string, doc_id string")
    found = decontaminate.matches(docs, bench)
    got = sorted((str(r.doc_id), r.item_id, r.distance) for r in found.collect())
    assert got == sorted((d, i, n) for d, n in (("3", 0), ("3", 0), ("None", 0), ("4", 0), ("5", 2)) for i in (10, 11))
    kept = decontaminate.keep_unleaked(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 6]
    assert decontaminate.keep_unleaked(docs, bench.limit(0)).count() == docs.count() and decontaminate.matches(docs, bench.limit(0)).count() == 0
    assert decontaminate.matches(docs.limit(0), bench).count() == 0 and decontaminate.keep_unleaked(docs.limit(0), bench).count() == 0
    assert sorted((str(r.doc_id), r.item_id, r.distance) for r in decontaminate.matches(docs, bench, items=1).collect()) == got
