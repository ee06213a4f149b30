"""Similarity of many names at once, against one pair at a time and against DuckDB's."""

import random

import duckdb
import numpy as np
from millrace.operators import identity


def _names(seed, n):
    rng = random.Random(seed)
    letters = ["ab", "abcd", "aéß😀", "abcdefghijklmnopqrstuvwxyz"]
    return ["".join(rng.choice(letters[k % 4]) for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 13, 40]))) for k in range(n)]


def test_many_pairs_at_once():
    a, b = _names(1, 4000), _names(2, 4000)
    near = ["".join(random.Random(k).sample(x, len(x))) if k % 2 else x[:-1] + "zz" for k, x in enumerate(a)]
    for other in (b, near, a):
        want = [identity.jaro_winkler(x, y) for x, y in zip(a, other, strict=True)]
        assert np.array_equal(identity.jaro_winkler_all(a, other), want)


def test_agrees_with_duckdb():
    a, b = _names(3, 1500), _names(4, 1500)
    plain = [(x, y) for x, y in zip(a, b, strict=True) if x and y and (x + y).isascii()]
    got = identity.jaro_winkler_all([x for x, _ in plain], [y for _, y in plain])
    con = duckdb.connect()
    want = [con.execute("SELECT jaro_winkler_similarity(?, ?)", p).fetchone()[0] for p in plain]
    assert np.allclose(got, want, atol=1e-9)


def test_nulls_empty_long_and_odd_names(spark):
    rows = [("ann", None), (None, None), ("", ""), ("", "a"), ("martha", "marhta"), ("a\0b", "a\0b"), ("x" * 5000, "x" * 4999 + "y")]
    frame = identity.similar_names(spark.createDataFrame(rows, "a string, b string"), "a", "b", "s")
    got = {(r.a, r.b): r.s for r in frame.collect()}
    assert got["", ""] == got["", "a"] == 0.0 and round(got["martha", "marhta"], 4) == 0.9611 and got["a\0b", "a\0b"] == 1.0
    assert got["ann", None] is None and got[None, None] is None
    assert got["x" * 5000, "x" * 4999 + "y"] == identity.jaro_winkler("x" * 5000, "x" * 4999 + "y")
