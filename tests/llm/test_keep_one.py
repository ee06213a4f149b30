"""Near-duplicate removal where ids are null or repeated."""

import numpy as np
from millrace.llm import simhash

rng = np.random.default_rng(11)
TEXTS = [" ".join("".join(rng.choice(list("abcdefghij"), 6)) for _ in range(80)) for _ in range(8)]
A, B, C, D, E, G, H, J = TEXTS
ROWS = [(None, A, "x"), (None, B, "x"), (None, B, "y"), (None, C, "x"), (1, C, "x"), (2, D, "x"), (2, E, "x"), (3, D, "x"), (4, G, "x"), (4, G, "y"), (5, H, "x"), (5, J, "x"), (0, J, "x"), (6, None, "x"), (6, "", "y")]


def test_one_row_of_each_class_stays_whatever_the_ids(spark):
    frame = spark.createDataFrame(ROWS, "doc_id long, text string, other string")
    for parts in (1, 5):
        got = [(r.doc_id, r.text or "") for r in simhash.keep_one(frame.repartition(parts)).collect()]
        want = [(None, A), (None, B), (1, C), (2, D), (2, E), (4, G), (5, H), (0, J), (6, "")]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert simhash.keep_one(frame).columns == frame.columns
    assert simhash.keep_one(frame.limit(0)).count() == 0


def test_clashing_columns_and_long_texts(spark):
    frame = spark.createDataFrame([(1, A, "p", 1), (2, A, "q", 2), (None, "word " * 200_000, None, None)], "doc_id long, text string, __digest string, __keep int")
    got = simhash.keep_one(frame)
    assert got.columns == frame.columns and sorted(got.collect(), key=str) == sorted([frame.collect()[0], frame.collect()[2]], key=str)


def test_hot_fingerprints_are_dealt_out(spark, monkeypatch):
    frame = spark.createDataFrame([(k, A if k % 3 else f"{B} {k}", "x") for k in range(60)], "doc_id long, text string, fp string")
    want = sorted(simhash.components(frame).collect())
    monkeypatch.setattr(simhash, "HOT", 5)
    assert sorted(simhash.components(frame).collect()) == want and len(want) == 60
