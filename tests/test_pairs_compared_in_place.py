"""Pairs of people are scored where they are made: the rows that are shuffled grow with the people, not with their pairs."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import identity
from millrace.plans import catalog


@pytest.fixture(scope="module")
def crowded(spark, tmp_path_factory):
    """1,200 customers of forty birth dates, so that pairs outnumber them by far."""
    folder = str(tmp_path_factory.mktemp("crowded"))
    k = F.col("id")
    key = (F.floor(k / 40) * 20_000 + k % 40).cast("long")
    spark.range(1200).select(key.alias("c_custkey"), F.lit(1).alias("c_nationkey"), F.lit(5.0).alias("c_acctbal"), F.lit("A").alias("c_mktsegment")).write.parquet(f"{folder}/customer.parquet")
    return folder


@pytest.mark.parametrize("name", ["i10_scores", "i06_adjusted_scores", "i09_trained_levels", "i10_trained_scores", "i11_trained_dedupe", "i11_dedupe", "i12_decisions", "i14_cross_reference", "i15_review_queue", "i16_decision_audit", "i17_match_quality"])
def test_no_exchange_of_pairs(spark, crowded, name):
    wide = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    wrapper = spark.sparkContext._jvm.java.lang.Class.forName("org.apache.spark.status.StageDataWrapper")
    stages = lambda: {s.info().stageId(): s.info().shuffleWriteRecords() for s in _all(spark, wrapper)}
    before = set(stages())
    try:
        catalog.QUERIES[name](spark, crowded).write.format("noop").mode("overwrite").save()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", wide)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    # About 36,000 pairs (of the pairs drawn for u, which are bounded, none are shuffled either).
    assert max(n for s, n in stages().items() if s not in before) <= 6_000


def _all(spark, wrapper):
    found = spark.sparkContext._jsc.sc().statusStore().store().view(wrapper).iterator()
    while found.hasNext():
        yield found.next()


def test_best_two_with_ties(spark):
    rows = [(1, 5, 0.9), (1, 3, 0.9), (1, 4, 0.9), (1, 9, 0.99), (2, 8, 0.7), (2, 6, 0.7), (2, 7, 0.7), (2, 1, 0.2), (3, 1, 0.5)]
    got = {tuple(r) for r in identity.best_two(spark.createDataFrame(rows, "id_l long, id_r long, match_probability double")).collect()}
    assert got == {(1, 9, 0.99, 3, 0.9), (2, 6, 0.7, 7, 0.7), (3, 1, 0.5, None, 0.0)}


def test_sole_match_is_the_rules_one_candidate(spark):
    rows = [(k, k % 7 if k % 5 else None, k % 11) for k in range(60)]
    people = spark.createDataFrame(rows, "id long, a long, b long")
    rules = {"one": ["a", "b"], "two": ["b"]}
    some = people.filter("id < 14")
    want = {(r.id_l, r.id_r) for r in identity.deterministic_match(people, some, rules).collect() if r.id_r is not None}
    assert {tuple(r) for r in identity.sole_match(people, some, rules).collect()} == want and want
