"""Places without gaps at a size where ranges are sampled, under hot keys and ties."""

import pytest
from millrace.operators import jobs, relational
from pyspark.sql import functions as F


@pytest.mark.parametrize(("adaptive", "rows"), [("true", 3_000_000), ("false", 300_000)])
def test_intake_of_three_million_rows(spark, adaptive, rows):
    """Ids are unique and without gaps with all columns read, and handing the rows in again adds nothing."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        new = spark.range(rows).select((F.col("id") % 1000).alias("provider"), F.col("id").alias("submission"), (F.xxhash64("id") % 5000).alias("day"), F.sha2(F.col("id").cast("string"), 256).alias("body"))
        old = spark.createDataFrame([(17, 0, 0)], "id long, provider long, submission long")
        got = jobs.intake(old, new, ["provider", "submission"], "id", ["day"])
        row = got.agg(F.count("id"), F.countDistinct("id"), F.min("id"), F.max("id"), F.countDistinct("body")).first()
        assert tuple(row) == (rows - 1, rows - 1, 18, 17 + rows - 1, rows - 1)
        # Ids follow the order: each range of ids holds days that do not overlap those of the next.
        spans = got.groupBy(F.floor((F.col("id") - 18) / (rows // 100)).alias("part")).agg(F.min("day").alias("a"), F.max("day").alias("b")).orderBy("part").collect()
        assert all(x.b <= y.a for x, y in zip(spans, spans[1:]))
        assert jobs.intake(old.unionByName(got.select("id", "provider", "submission")), new, ["provider", "submission"], "id", ["day"]).count() == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("ranges", [None, 5])
def test_places_in_hot_groups_with_ties(spark, ranges):
    rows = [("hot", 1)] * 300 + [("hot", k % 7) for k in range(200)] + [(None, 3), (None, None), ("cold", 2)]
    got = relational.placed(spark.createDataFrame(rows, "g string, v int"), ["g"], ["v"], ranges).collect()
    assert len(got) == len(rows)
    for group in ("hot", None, "cold"):
        mine = sorted((r.pos, r.v) for r in got if r.g == group)
        values = sorted((v is not None, v or 0) for g, v in rows if g == group)
        assert [p for p, _ in mine] == list(range(len(values))) and [v or 0 for _, v in mine] == [v for _, v in values]
        assert {r.n for r in got if r.g == group} == {len(values)}
    assert relational.placed(spark.createDataFrame([], "g string, v int"), ["g"], ["v"], ranges).count() == 0
