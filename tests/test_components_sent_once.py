"""Components bring a node's least neighbour to its edges once, but in shares where the node has very many."""

from pyspark.sql import functions as F

from millrace.operators import relational


def _components(edges):
    seat = {}
    def top(x):
        while seat.setdefault(x, x) != x:
            x = seat[x]
        return x
    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        seat[b] = a
    return {x: top(x) for x in seat}


def test_chains_and_a_hub(spark, monkeypatch):
    chains = [(10 * c + (7 * k) % 10, 10 * c + (7 * k + 7) % 10) for c in range(30) for k in range(9)]
    edges = chains + [(1_000, 2_000 + k) for k in range(200)] + [(1_000, 5), (2_100, 25)]
    df = spark.createDataFrame(edges, "a long, b long")
    for hot_rows in (100_000, 20):
        monkeypatch.setattr(relational, "HOT_ROWS", hot_rows)
        assert {r.node: r.component for r in relational.connected_components(df).collect()} == _components(edges)


def test_rows_of_ordinary_keys_are_sent_once(spark):
    many = spark.range(4000).select((F.col("id") % 1000).alias("k"), F.col("id").alias("v"))
    one = spark.range(1000).select(F.col("id").alias("k"), F.lit(4).alias("n"), (F.col("id") * 2).alias("w"))
    joined = relational.hot_join(many, one, "k", "v", "n")
    assert joined.count() == 4000 and joined.filter("w <> 2 * k").isEmpty()
    assert "Generate" not in joined._jdf.queryExecution().optimizedPlan().toString()
    hot = relational.hot_join(many, one.withColumn("n", F.when(F.col("k") == 3, 4).otherwise(1)), "k", "v", "n", 1)
    assert hot.count() == 4000 and hot.filter("w <> 2 * k").isEmpty()
