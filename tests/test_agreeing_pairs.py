"""Pairs that are given, such as reviewed ones, are scored without making any other pair."""

from pyspark.sql import functions as F

from millrace.operators import relational
from millrace.plans import catalog


def test_as_of_all_candidates(spark):
    people = spark.createDataFrame([(k, k % 3 if k % 4 else None, k % 5, f"p{k}") for k in range(40)], "id long, a long, b long, name string")
    rules = (("a",), ("a", "b"), ("b",))
    given = spark.createDataFrame([(a, b) for a in range(40) for b in range(0, 44, 3)] * 2, "id_l long, id_r long")
    for right in (None, people.filter("id > 9")):
        every = {tuple(r) for r in relational.candidate_pairs(people, "id", rules, right, carry=["name"]).collect()}
        want = {r for r in every if r[1] % 3 == 0}
        got = [tuple(r) for r in relational.agreeing_pairs(given, people, "id", rules, right, carry=["name"]).collect()]
        assert len(got) == len(set(got)) and set(got) == want and want


def test_audit_of_one_large_block_makes_reviewed_pairs_alone(spark, tmp_path):
    k = (F.col("id") * 20_000).cast("long")  # One birth date: 1,200 x 1,200 candidate pairs, 131 reviews.
    spark.range(1200).select(k.alias("c_custkey"), F.lit(1).alias("c_nationkey"), F.lit(5.0).alias("c_acctbal"), F.lit("A").alias("c_mktsegment")).write.parquet(f"{tmp_path}/customer.parquet")
    audit = catalog.QUERIES["i16_decision_audit"](spark, str(tmp_path))
    audit.collect()
    joined = [n for n in _rows_of_joins(audit._jdf.queryExecution().executedPlan()) if n is not None]
    assert joined and max(joined) <= 2400


def _rows_of_joins(plan):
    name = plan.nodeName()
    inner = [plan.executedPlan()] if name == "AdaptiveSparkPlan" else [plan.plan()] if "QueryStage" in name else []
    children = plan.children()
    inner += [children.apply(k) for k in range(children.size())]
    metric = plan.metrics().get("numOutputRows")
    return [metric.get().value() if "Join" in name and metric.isDefined() else None] + [n for p in inner for n in _rows_of_joins(p)]
