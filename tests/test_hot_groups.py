"""Joins, pairs, windows and quantiles where one key or block holds most rows, against plain Python."""

import datetime as dt
import random
from collections import Counter

import pytest
from millrace.operators import changes, relational
from pyspark.sql import functions as F

DAY = dt.date(2020, 1, 1)


def held(spans, k, at):
    return [(s, e, n) for key, s, e, n in spans if k is not None and key == k and at is not None and s is not None and s <= at and (e is None or e >= at)]


@pytest.fixture(scope="module")
def timeline(spark):
    rng = random.Random(5)
    day = lambda n: DAY + dt.timedelta(days=n)
    spans = [("hot", day(s := rng.randrange(3000)), rng.choice([None, day(s + rng.choice([0, 1, 9, 200, 2500])), day(s - 1)]), n) for n in range(300)]
    spans += [("cold", day(10), day(20), 1), ("cold", day(15), None, None), (None, day(0), None, 5), ("x", None, None, 6), ("x", day(7), day(7), 7)]
    events = [(k, rng.choice(["hot"] * 9 + ["cold", "x", "none", None]), rng.choice([None, *map(day, range(0, 3400, 7))])) for k in range(800)]
    events += events[:50]
    return events, spans, spark.createDataFrame(events, "e long, k string, at date"), spark.createDataFrame(spans, "k string, s date, t date, n int")


def test_interval_joins(timeline):
    events, spans, e, s = timeline
    key = lambda rows: sorted(rows, key=repr)
    every = [(i, k, at, *hit) for i, k, at in events for hit in held(spans, k, at) or [(None, None, None)]]
    assert key(map(tuple, relational.interval_join(e, s, "k", "at", "s", "t").collect())) == key(every)
    least = [(i, k, at, min((n for *_, n in held(spans, k, at) if n is not None), default=None)) for i, k, at in events]
    assert key(map(tuple, relational.interval_join(e, s, "k", "at", "s", "t", "min", value="n").collect())) == key(least)
    last = {(i, k, at): min(held(spans, k, at), key=lambda h: (-h[0].toordinal(), h[2] is None, h[2] or 0), default=(None, None, None)) for i, k, at in events}
    got = relational.interval_join(e, s, "k", "at", "s", "t", "latest", id_cols=["e", "k", "at"], value="n").collect()
    assert key(map(tuple, got)) == key((*x, *h) for x, h in last.items())
    assert relational.interval_join(e.limit(0), s, "k", "at", "s", "t").count() == 0 and relational.interval_join(e, s.limit(0), "k", "at", "s", "t").count() == len(events)


def test_interval_join_meets_few_spans_that_do_not_hold(spark):
    """A key with many short spans and many instants: rows that meet are in the order of those that hold, not spans by instants."""
    spans = spark.range(4000).select(F.lit("k").alias("k"), (F.col("id") * 60).alias("a"), (F.col("id") * 60 + 90).alias("b"))
    events = spark.range(20_000).select(F.lit("k").alias("k"), (F.col("id") * 12).alias("at"))
    found = relational.spans_at(events, spans, "k", "at", "a", "b")
    n = found.count()
    met = [node for node in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in node]
    assert 20_000 < n < 60_000 and met
    wide = found._jdf.queryExecution().optimizedPlan().toString()
    assert "__bucket" in wide
    loose = relational.spans_at(events, spans.withColumn("a", F.col("a") - 0), "k", "at", "a", "b")
    assert loose.count() == n


def test_pairs_of_a_hot_block_in_tiles(spark):
    rng = random.Random(6)
    rows = [(k, rng.choice(["hot"] * 6 + ["a", "b", None]), rng.randrange(3), rng.choice([None, 1, 2])) for k in range(400)] + [(None, "hot", 1, 1)]
    df = spark.createDataFrame(rows, "id long, x string, y int, z int")
    agree = lambda a, b, cols: all(a[c] is not None and a[c] == b[c] for c in cols)
    known = [r for r in rows if r[0] is not None]
    want = {(a[0], b[0]) for a in known for b in known if a[0] < b[0] and agree(a, b, [1])}
    for tile_rows in (10**6, 16):
        got = Counter(tuple(r) for r in relational.pairs_in_group(df, "id", ["x"], tile_rows).collect())
        assert set(got) == want and max(got.values()) == 1
    rules, cols = [["x", "y"], ["x", "z"], ["y", "z"]], {"x": 1, "y": 2, "z": 3}
    first = lambda a, b: next((k for k, rule in enumerate(rules) if agree(a, b, [cols[c] for c in rule])), None)
    want = {(a[0], b[0], first(a, b)) for a in known for b in known if a[0] < b[0] and first(a, b) is not None}
    others = [r for r in known if r[0] % 3 == 0]
    across = {(a[0], b[0], first(a, b)) for a in known for b in others if first(a, b) is not None}
    for tile_rows in (10**6, 16):
        assert {tuple(r) for r in relational.candidate_pairs(df, "id", rules, tile_rows=tile_rows).collect()} == want
        assert {tuple(r) for r in relational.candidate_pairs(df, "id", rules, df.filter("id % 3 = 0"), tile_rows).collect()} == across
    counts = Counter(k for *_, k in want)
    report = {r.rule: (r.marginal, r.cumulative, r.possible) for r in relational.blocking_report(df, "id", rules).collect()}
    assert report == {k: (counts[k], sum(counts[j] for j in range(k + 1)), len(rows) * (len(rows) - 1) // 2) for k in range(3)}


def test_no_tile_holds_more_than_its_share(spark):
    """Half of 4,000 rows are one block: cut into 20 parts, no two of its tiles make more than a sixteenth of the pairs."""
    df = spark.range(4000).select("id", F.when(F.col("id") < 2000, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    rows = df.select("k", F.struct("id").alias("row"))
    pairs = relational._tiled(rows, None, ["k"], 100)
    part = lambda side: F.pmod(F.xxhash64(f"{side}.id"), F.lit(20))
    tiles = pairs.select(F.least(part("l"), part("r")).alias("i"), F.greatest(part("l"), part("r")).alias("j")).groupBy("i", "j").count().collect()
    total = sum(t["count"] for t in tiles)
    assert total == 2000 * 1999 // 2 and len(tiles) == 210 and max(t["count"] for t in tiles) < total / 32


def test_report_makes_no_pairs(spark):
    df = spark.range(1_000_000).select("id", F.lit(1).alias("k"))
    (row,) = relational.blocking_report(df, "id", [["k"]]).collect()
    assert tuple(row) == (0, 499_999_500_000, 499_999_500_000, 499_999_500_000)


def test_gaps_and_places_in_ranges(spark):
    rng = random.Random(7)
    start = dt.datetime(2020, 1, 1)
    rows = [(k, rng.choice(["hot"] * 8 + ["a", None]), rng.choice([None, start + dt.timedelta(seconds=rng.randrange(500))])) for k in range(900)]
    df = spark.createDataFrame(rows, "id long, k string, at timestamp")
    plain, ranged = (sorted(map(tuple, relational.gap_seconds(df, "k", "at", "id", group_rows, 7).collect()), key=repr) for group_rows in (10**6, 10))
    assert plain == ranged and sum(r[-1] is not None for r in plain) > 300
    order = [F.desc_nulls_last("at"), F.asc("id")]
    plain, ranged = (sorted(map(tuple, relational.numbered(df, ["k"], order, group_rows=group_rows, ranges=7).collect()), key=repr) for group_rows in (10**6, 10))
    assert plain == ranged
    counted = {r.k: (r.id, r.versions) for r in relational.dedupe_with_count(df, ["k"], order).collect()}
    for k in ("hot", "a", None):
        mine = [r for r in rows if r[1] == k]
        best = min(mine, key=lambda r: (r[2] is None, -(r[2] or start).timestamp(), r[0]))
        assert counted[k] == (best[0], len(mine))


def test_only_two_rows_a_key_are_shuffled(spark):
    df = spark.range(10_000).select((F.col("id") % 2).alias("k"), (F.col("id") % 100).alias("v"), F.col("id").alias("t"))
    found = relational.best_and_second(df, "k", "v", "t")
    assert sorted(tuple(r) for r in found.select("k", "v", "t", "second_t", "second_v").collect()) == [(0, 98, 98, 198, 98), (1, 99, 99, 199, 99)]
    assert "WindowGroupLimit" in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("ranges", [None, 6])
def test_quantiles_equal_percentile(spark, ranges):
    rng = random.Random(8)
    rows = [(rng.choice(["hot"] * 8 + ["a", None]), rng.choice([None, 1.0, 2.5, -3.0, rng.random() * 1e6])) for _ in range(2000)] + [("one", 4.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    wanted = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p100": 1.0, "odd": 0.3337}
    got = {r.g: r for r in relational.quantiles(df, ["g"], "v", wanted, ranges).collect()}
    for r in df.groupBy("g").agg(*(F.percentile("v", p).alias(n) for n, p in wanted.items())).collect():
        assert (r.g not in got and r.p50 is None) or all(abs(r[n] - got[r.g][n]) < 1e-6 for n in wanted), r


def test_quantiles_of_many_different_values(spark):
    """A group of 2,000,000 different values; no aggregate holds more than the values around a quantile."""
    df = spark.range(2_000_000).select(F.lit("k").alias("g"), (F.col("id") * 3).alias("v"))
    row = relational.quantiles(df, ["g"], "v", {"a": 0.5, "b": 0.95}, 16).first()
    assert tuple(row) == ("k", 3 * 1_999_999 / 2, pytest.approx(3 * 1_999_999 * 0.95))


def test_latest_observation_at_ties(spark):
    at = dt.datetime(2020, 1, 1)
    rows = [("s", at, 10, "lost"), ("s", at, 20, "reserved"), ("t", at, 5, "unreserved"), ("t", at, 5, "lost")]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "slot_name string, observed_at timestamp, retained_bytes long, wal_status string").coalesce(1)
        assert {r.slot_name: r.problems for r in changes.slot_health(df).collect()} == {"s": [], "t": ["lost"]}


def test_pairs_of_many_rows_are_dealt_to_many_tasks(spark, monkeypatch):
    """As many tasks as pairs need, with small inputs too, which would else be put together into few."""
    df = spark.range(600).selectExpr("id", "id % 20 AS a").select("id", "a")
    plain = {tuple(r) for r in relational.candidate_pairs(df, "id", [["a"]]).collect()}
    monkeypatch.setattr(relational, "TASK_PAIRS", 1_000)
    for tile_rows in (2048, 7):
        dealt = relational.candidate_pairs(df, "id", [["a"]], tile_rows=tile_rows)
        assert {tuple(r) for r in dealt.collect()} == plain
        assert dealt.rdd.getNumPartitions() >= 18
