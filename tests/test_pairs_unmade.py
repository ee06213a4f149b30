"""Matches are worked out without making pairs that only a count or a flag is wanted of."""

from pyspark.sql import functions as F

from millrace.operators import jobs


def _shuffled(df) -> int:
    """Rows that the plan's widest exchange has sent."""
    df.collect()
    seen, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if name in ("ShuffleExchangeExec", "SortMergeJoinExec", "BroadcastHashJoinExec", "ShuffledHashJoinExec", "ProjectExec"):
            for key in ("shuffleRecordsWritten", "numOutputRows"):
                found = node.metrics().get(key)
                if found.isDefined():
                    seen = max(seen, found.get().value())
        todo += [node.children().apply(k) for k in range(node.children().size())]
    return seen


def test_members_are_not_paired_with_requests(spark):
    """Five hundred people of one birth date and name are no 250,000 pairs."""
    members = spark.range(500).select(F.lit("A").alias("payer"), F.col("id").alias("member_id"), F.lit(1).alias("birth_date"), F.array(F.lit("x"), F.concat(F.lit("y"), (F.col("id") % 400).cast("string"))).alias("names"))
    asked = members.select(F.col("member_id").alias("request_id"), "payer", F.lit(None).cast("long").alias("member_id"), "birth_date", "names")
    own = asked.withColumn("request_id", F.col("request_id") + 1000).withColumn("names", F.slice("names", 2, 1))
    got = jobs.match_members(asked.unionByName(own), members)
    rows = {r.request_id: (r.member_id, r.reason) for r in got.collect()}
    assert all(rows[k] == (None, "ambiguous") for k in range(500))
    assert all(rows[1000 + k] == ((k, "demographics") if 100 <= k < 400 else (None, "ambiguous")) for k in range(500))
    assert _shuffled(got) < 20_000
