"""The two classifiers and the toxicity stage on odd tables, and their held-out precision and recall."""

import numpy as np
import pytest
from millrace.llm import labelled, nbsvm, svm, toxicity


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, None, "a", 1), (2, "", "b", 2), (3, "word", None, None), (3, "word", None, None), (None, "you worthless fool", "c", 3), (4, "a " * 200_000, "d", 4), (5, "plain words here", "e", 5), (5, "another text", "e", 5)]
    return spark.createDataFrame(rows, "doc_id long, text string, y string, id int").withColumnRenamed("id", "__toxicity")


@pytest.fixture(scope="module")
def few(spark):
    return spark.createDataFrame([(1, 0, 1, "x"), (3, 1, 0, "x"), (3, 0, 1, "x"), (5, 1, 0, "x"), (None, 1, 1, "x"), (4, None, 2, "x")], "doc_id long, quality int, toxic int, text string")


def test_clashing_columns_nulls_and_repeats(odd, few):
    for judge in (toxicity.judge, nbsvm.judge):
        got = judge(odd, few).collect()
        assert len(got) == 8 and all(0 <= r.score <= 1 for r in got) and set(got[0].asDict()) == {"doc_id", "held_out", "score", "predicted"}
        assert len({r.score for r in got if r.doc_id == 3}) == 1
        assert judge(odd.limit(0), few).count() == 0 and judge(odd, few.limit(0)).count() == 8
    kept = toxicity.keep_clean(odd, few)
    assert kept.columns == odd.columns and kept.count() <= 8
    assert toxicity.keep_clean(odd, few.limit(0)).count() == 8 and toxicity.keep_clean(odd.limit(0), few).count() == 0


def test_sample_is_one_row_an_id_whatever_the_order(odd, few, spark):
    held = toxicity.held_out("doc_id")
    got = {(r.id, r.y, bytes(r.text)) for parts in (1, 4) for r in labelled.sample(odd.repartition(parts), few, "toxic", held).collect()}
    ids = [k for k, _, _ in got]
    assert len(ids) == len(set(ids)) and (5, 0, b"another text") in got or 5 not in ids
    repeated = odd.unionByName(odd).unionByName(odd)
    assert labelled.sample(repeated, few, "toxic", held).count() == labelled.sample(odd, few, "toxic", held).count()
    assert labelled.sample(odd, few, "toxic", held, max_rows=1).count() <= 1


def test_held_out_precision_and_recall(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    for judge, label, kind, precision, recall in ((toxicity.judge, "toxic", 1, 0.75, 0.8), (nbsvm.judge, "quality", 0, 0.85, 0.85)):
        rows = judge(docs, labels).join(labels, "doc_id").filter("held_out").select("predicted", label).collect()
        hit = sum(r.predicted == kind == r[label] for r in rows)
        assert hit >= precision * sum(r.predicted == kind for r in rows) and hit >= recall * sum(r[label] == kind for r in rows)


def test_kernel_weights_by_counting_subsequences():
    """The feature of a unit: for each three letters at growing places within the span, DECAY to the power of the characters skipped."""
    units = [b"idiot", b"i.d.i.o.t", b"xx", b"aaaa", b"longwordlongwordlongwordlong"]
    rng = np.random.default_rng(0)
    weights = rng.normal(size=toxicity.ALPHABET**3).astype(np.float32)
    weights[0] = 0
    want = []
    for u in units:
        best = -np.inf
        chars = [ord(c) - 96 if c.isalpha() else 0 for c in u.decode()]
        pieces = max(1, -(-(len(chars) - toxicity.PIECE) // (toxicity.PIECE // 2)) + 1)
        for turn in range(pieces):
            at = turn * (toxicity.PIECE // 2)
            codes = [toxicity.START if turn == 0 else 0, *chars[at : at + toxicity.PIECE]]
            total = norm = 0.0
            for a in range(len(codes)):
                for b in range(a + 1, len(codes)):
                    for c in range(b + 1, min(len(codes), a + toxicity.LONGEST_SPAN)):
                        if codes[a] and codes[b] and codes[c]:
                            w = toxicity.DECAY ** (c - a - 2)
                            total += w * float(weights[(codes[a] * toxicity.ALPHABET + codes[b]) * toxicity.ALPHABET + codes[c]])
                            norm += w * w
            best = max(best, total / np.sqrt(max(norm, 1e-9)))
        want.append(best + 0.25)
    assert np.allclose(toxicity.margins(units, weights, 0.25), want, atol=1e-4)


def test_dual_descent_reaches_the_optimum():
    """The weights' primal objective equals the dual's, which only holds at the optimum."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 5))
    y = np.where(x @ np.array([1, -2, 0.5, 0, 0]) + 0.3 * rng.normal(size=60) > 0, 1, -1)
    every = np.arange(5)
    w, bias = svm.dual_coordinate_descent([(every, row) for row in x], y, 5, rounds=5000)
    cost = np.where(y > 0, 60 / (2 * (y > 0).sum()), 60 / (2 * (y < 0).sum()))
    primal = lambda w, b: (w @ w + b * b) / 2 + (cost * np.maximum(0, 1 - y * (x @ w + b))).sum()
    best = primal(w, bias)
    for _ in range(500):
        step = rng.normal(size=6) * rng.choice([0.001, 0.01, 0.1])
        assert primal(w + step[:5], bias + step[5]) >= best - 1e-3


def test_ratios_are_smoothed_log_counts():
    texts, y = [b"good good text", b"good words", b"bad text", b"bad bad bad"], [1, 1, 0, 0]
    found = [nbsvm.features(t) for t in texts]
    count = np.ones((2, nbsvm.WIDTH))
    for f, k in zip(found, y, strict=True):
        count[k, f] += 1
    ratio = np.log(count[1] / count[1].sum()) - np.log(count[0] / count[0].sum())
    weights, *_ = nbsvm.fit(texts, y)
    used = np.unique(np.concatenate(found))
    assert (np.sign(weights[used]) * np.sign(ratio[used]) >= -0.5).all() and set(np.flatnonzero(weights)) <= set(used)
    assert nbsvm.fit(texts, [1, 1, 1, 1])[0].any() == np.False_
