"""Linkage training: random pairs, levels learnt without labels, and levels of names and dates."""

import datetime as dt

from pyspark.sql import functions as F

from millrace.operators import identity
from millrace.plans import catalog

DATA = "/root/testdata/sf0.01"


def test_random_pairs_are_about_n_and_repeatable(spark):
    left = spark.range(2000).withColumnRenamed("id", "id_l")
    right = spark.range(3000).withColumnRenamed("id", "id_r")
    one = identity.random_pairs(left, right, n=50_000)
    assert 0.8 * 50_000 < one.count() < 1.25 * 50_000
    assert sorted(one.collect()) == sorted(identity.random_pairs(left.repartition(7), right, n=50_000).collect())
    assert one.distinct().count() == one.count()
    # Each side takes part about evenly.
    assert one.select("id_l").distinct().count() > 1900


def test_levels_are_learnt_without_labels(spark):
    """The altered shares of the made-up source: last names differ in 1/11 + 1/17 of pairs, areas are never another one."""
    rows = {(r.comparison, r.level): (r.m, r.u) for r in catalog.QUERIES["i09_trained_levels"](spark, DATA).collect()}
    assert abs(rows["last", 0][0] - (1 - 1 / 11 - 1 / 17)) < 0.06 and abs(rows["first", 0][0] - 2 / 3) < 0.06 and rows["zip", 0][0] > 0.9
    assert all(rows[c, 0][0] > 20 * rows[c, 0][1] for c in ("last", "born", "zip")) and abs(rows["first", 1][0] - 1 / 3) < 0.06


def test_name_and_date_levels(spark):
    rows = [("ann", "ann", 0, False), ("anne", "nancy", 1, True), ("martha", "marhta", 2, False), ("dwayne", "duane", 4, False), ("ann", None, -1, False), ("ann", "zoe", 5, False)]
    frame = spark.createDataFrame(rows, "a string, b string, want int, nick boolean")
    frame = identity.similar_names(frame, "a", "b", "similarity")
    level = identity.name_levels(F.col("a"), F.col("b"), F.col("nick"), F.col("similarity"), "n")
    assert all(r.gamma_n == r.want for r in identity.compare(frame, [level]).collect())
    day = dt.date(2000, 1, 31)
    dates = [(day, day, 0), (day, dt.date(2000, 1, 30), 1), (day, dt.date(2000, 2, 20), 2), (day, dt.date(2000, 11, 22), 3), (day, dt.date(2007, 8, 9), 4), (day, dt.date(1950, 4, 5), 5), (None, day, -1)]
    frame = spark.createDataFrame(dates, "a date, b date, want int")
    assert all(r.gamma_d == r.want for r in identity.compare(frame, [identity.date_levels(F.col("a"), F.col("b"), "d")]).collect())


def test_prior_and_nicknames_of_several_names(spark):
    assert identity.prior_from_rules(80, 100, 1000) == 80 / 0.8 / 100_000 and identity.prior_from_rules(0, 10) == 1e-12
    people = spark.createDataFrame([(1, "al"), (2, "ann"), (3, None)], "k long, name string")
    nicknames = spark.createDataFrame([("al", "albert"), ("al", "alan")], "nick string, name string")
    got = identity.harmonise({"a": (people, {"id": F.col("k"), "first": F.col("name")})}, nicknames).collect()
    assert sorted((r.source, r.id, r.first, r.canonical) for r in got) == [("a", 1, "al", "alan"), ("a", 2, "ann", "ann"), ("a", 3, None, None)]


def test_near_copies_by_brute_force(spark):
    """Texts that share four in five of their runs of three words are joined by accepted pairs, directly or through others; texts that share few are not."""
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    root = {k: k for k in texts}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    split = {k: t.lower().split() for k, t in texts.items()}
    words = {k: set(zip(w, w[1:], w[2:], strict=False)) for k, w in split.items()}
    like = lambda a, b: float(texts[a] == texts[b]) or len(words[a] & words[b]) / max(1, len(words[a] | words[b]))
    accepted = [(r.id_l, r.id_r) for r in catalog.QUERIES["i10_linkage"](spark, DATA).filter("decision = 'accept'").collect()]
    assert sum(like(a, b) < 0.4 for a, b in accepted) <= 0.05 * len(accepted)
    for a, b in accepted:
        root[find(a)] = find(b)
    ids = sorted(k for k in texts if len(words[k]) >= 20)
    near = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if abs(len(words[a]) - len(words[b])) <= 0.2 * len(words[a]) and like(a, b) >= 0.8]
    assert len(near) > 20 and sum(find(a) == find(b) for a, b in near) >= 0.95 * len(near)
