"""Sketches of whole texts, against sets of runs of words, and pairs that carry their columns."""

import numpy as np
from millrace.functions.sketches import runs_of_words, sketches
from millrace.operators import relational
from pyspark.sql import functions as F


def test_runs_are_one_for_each_word():
    hashes, first = runs_of_words(["a B c d", "", "b c", "A b C"], 3)
    assert first.tolist() == [0, 4, 5, 7, 10]
    # The first run and the shorter last ones agree wherever their words do.
    assert hashes[0] == hashes[7] and len(set(hashes.tolist())) == 7
    assert hashes[1] != hashes[5] and hashes[5] == hashes[8] and hashes[6] == hashes[9]


def test_sketch_estimates_shared_runs(spark):
    rng = np.random.default_rng(3)
    words = [f"w{k}" for k in rng.integers(0, 10**6, 4000)]
    near = words[:3000] + [f"x{k}" for k in range(1000)]
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, None), (4, ""), (5, " ".join(words).upper()), (6, "one " * 300_000)]
    got = {r.id: r.s for r in spark.createDataFrame(rows, "id int, t string").select("id", sketches(F.col("t"), size=512).alias("s")).collect()}
    shared = len(set(got[1].sketch) & set(got[2].sketch)) / 512
    # Of 5,000 runs 3,000 are shared; of the 512 least of one side, those among the other's are the shared ones that are least in both.
    assert 0.55 < shared < 0.85
    assert got[1] == got[5] and got[3] == got[4] and len(got[3].sketch) == 1 and len(got[6].sketch) == 3
    assert all(len(s.least) == 8 for s in got.values()) and len(set(got[1].least)) == 8


def test_pairs_carry_columns_through_tiles(spark):
    df = spark.createDataFrame([(k, k % 2, k % 3, f"n{k}") for k in range(40)], "id int, a int, b int, name string")
    want = {(x, y, f"n{x}", f"n{y}") for x in range(40) for y in range(x + 1, 40) if x % 2 == y % 2 or x % 3 == y % 3}
    for rows in (1000, 4):
        pairs = relational.candidate_pairs(df, "id", [["a"], ["b"]], tile_rows=rows, carry=["name"])
        got = [(r.id_l, r.id_r, r.name_l, r.name_r) for r in pairs.collect()]
        assert len(got) == len(want) and set(got) == want
