"""Small hand-made rows for the reference's operators: boundaries, ties, nulls, tombstones, replays."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from millrace.functions import columns as c
from millrace.operators import changes, identity, quality, relational, views


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_scalars(spark):
    df = spark.createDataFrame([("20240230", "1234567893", "0002-7597-01"), ("", "12345", "50242-040-62"), (None, None, None)], "d string, npi string, ndc string")
    got = [tuple(r) for r in df.select(c.parse_date(F.col("d")), c.luhn_valid(F.col("npi")), c.ndc11(F.col("ndc")), c.open_ended(F.col("d"))).collect()]
    assert got == [(None, True, "00002759701", None), (None, None, "50242004062", None), (None, None, None, None)]
    lsn = spark.createDataFrame([("1/A",)], "l string").select(c.lsn_to_long(F.col("l"))).first()[0]
    assert lsn == (1 << 32) + 10
    assert spark.range(1).select(c.norm_ascii(F.lit("Éàñ-x"))).first()[0] == "eanx"


def test_interval_join_boundaries_and_open_end(spark):
    spans = spark.createDataFrame([("a", date(2024, 1, 1), date(2024, 1, 31), 1), ("a", date(2024, 1, 15), None, 2)], "k string, s date, e date, n int")
    events = spark.createDataFrame([("a", date(2024, 1, 1)), ("a", date(2024, 1, 31)), ("a", date(2023, 1, 1)), ("b", date(2024, 1, 1)), ("a", None)], "k string, at date")
    least = relational.interval_join(events, spans, "k", "at", "s", "e", "min", value="n")
    assert rows(least.filter("at is not null"), "k", "at") == [("a", date(2023, 1, 1), None), ("a", date(2024, 1, 1), 1), ("a", date(2024, 1, 31), 1), ("b", date(2024, 1, 1), None)]
    assert least.count() == 5
    last = relational.interval_join(events.filter("k = 'a' and at = '2024-01-31'"), spans, "k", "at", "s", "e", "latest", id_cols=["k", "at"], value="n")
    assert last.first().n == 2


def test_components_of_a_chain_and_a_ring(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(1, 40)] + [(100, 101), (101, 102), (102, 100), (7, 7)], "a long, b long")
    got = {r.node: (r.component, r.size) for r in relational.connected_components(edges).collect()}
    assert all(got[k] == (1, 40) for k in range(1, 41)) and got[102] == (100, 3)
    assert relational.connected_components(edges.limit(0)).count() == 0


def test_closure_lists_what_leads_nowhere(spark):
    focal, targets = (spark.createDataFrame([(x,) for x in ids], "id string") for ids in (["a"], ["a", "b", "c"]))
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "gone")], "source string, target string")
    closure, lost = relational.reference_closure(focal, edges, targets)
    assert rows(closure, "target") == [("a", "a"), ("a", "b"), ("a", "c")] and rows(lost, "target") == [("a", "gone")]


LOG = [
    (1, "x", "S", 10, 0), (2, "y", "S", 10, 1), (1, "x2", "U", 20, 0), (1, "x3", "U", 20, 1), (2, None, "D", 30, 0), (2, "y2", "I", 40, 0), (3, "z", "I", 40, 1),
]


def test_incremental_state_equals_full_state_and_replays_do_no_harm(spark):
    log = spark.createDataFrame(LOG, "id int, v string, _op string, _lsn long, _seq int")
    full = changes.current_state(log, ["id"])
    assert rows(full.select("id", "v"), "id") == [(1, "x3"), (2, "y2"), (3, "z")]
    state = changes.changes_after(log.filter("_lsn <= 20"), ["id"], -1)
    for batch in (log.filter("_lsn > 20"), log.filter("_lsn > 20"), log.filter("_lsn <= 20")):
        state = changes.merge_state(state, batch, ["id"])
    assert rows(state.filter("_op <> 'D'"), "id") == rows(full, "id")
    assert rows(changes.current_state(log, ["id"], 30).select("id", "v"), "id") == [(1, "x3")]


def test_truncation_cuts_and_forces_a_reset(spark):
    log = spark.createDataFrame([*LOG, (0, None, "T", 35, 0)], "id int, v string, _op string, _lsn long, _seq int")
    assert rows(changes.current_state(log, ["id"]).select("id", "v"), "id") == [(2, "y2"), (3, "z")]
    assert changes.needs_reset(log.filter("_lsn <= 30"), log) and not changes.needs_reset(log.filter("_op <> 'T'"), log)
    assert changes.needs_reset(log.limit(0), log)


def test_open_transactions_are_left_out(spark):
    messages = spark.createDataFrame(
        [(1, 0, "B", None, "0/1", None), (1, 1, "I", "t", "0/1", "a"), (1, 2, "U", "t", "0/1", "b"), (1, 3, "C", None, "0/9", None), (2, 4, "I", "t", "0/A", "c"), (3, 5, "I", "t", "0/2", "d"), (3, 6, "C", None, "0/3", None)],
        "xid int, n int, action string, table string, lsn string, payload string",
    ).withColumn("timestamp", F.lit("2024-01-01"))
    got = changes.decode_changes(messages, 3)
    assert rows(got.select("op", "lsn", "seq", "payload"), "seq") == [("I", 9, 0, "a"), ("U", 9, 1, "b")]


def test_stream_keeps_the_same_state_as_a_batch(spark, tmp_path):
    from millrace.streaming.capture import keep_state, read_state

    schema = "id int, v string, _op string, _lsn long, _seq int"
    log = spark.createDataFrame(LOG, schema)
    for part in ("_lsn <= 20", "_lsn > 20", "_lsn <= 20"):
        log.filter(part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        keep_state(stream, str(tmp_path / "state"), ["id"], str(tmp_path / "check")).awaitTermination()
    got = read_state(spark, str(tmp_path / "state")).filter("_op <> 'D'")
    assert rows(got.select("id", "v"), "id") == rows(changes.current_state(log, ["id"]).select("id", "v"), "id")


def test_view_members_arrays_and_errors(spark):
    docs = spark.createDataFrame(
        [('{"resourceType":"P","id":"1","name":{"given":["a","b"]},"item":[{"n":1},{"n":2}]}',), ('{"resourceType":"P","id":"2","name":null,"item":[]}',), ('{"resourceType":"Q","id":"3"}',)], "j string"
    ).select(F.parse_json("j").alias("resource"))
    view = views.View("P", [views.Select([views.Col("id", views.path("id")), views.Col("given", views.path("name.given"), collection=True)], select=[views.Select([views.Col("n", views.path("n"), "int")], for_each=views.path("item"), or_null=True, row_index="i")])])
    assert rows(views.flatten_view(docs, view).select("id", "given", "i", "n"), "id", "i") == [("1", ["a", "b"], 0, 1), ("1", ["a", "b"], 1, 2), ("2", [], 0, None)]
    one = views.View("P", [views.Select([views.Col("given", views.path("name.given"))])])
    with pytest.raises(Exception, match="several values"):
        views.flatten_view(docs, one).collect()
    with pytest.raises(ValueError):
        views.flatten_view(docs, views.View("P", [views.Select([views.Col("x", views.path("id"))]), views.Select([views.Col("x", views.path("id"))])]))


def test_identity_scores_and_persons(spark):
    assert round(identity.jaro_winkler("MARTHA", "MARHTA"), 4) == 0.9611 and identity.jaro_winkler("", "a") == 0.0
    pairs = spark.createDataFrame([(1, 2, "ann", "ann"), (2, 3, "ann", "anne"), (4, 5, "bob", "zed"), (4, 6, None, "zed")], "id_l int, id_r int, a string, b string")
    level = identity.Comparison("name", F.col("a").isNull() | F.col("b").isNull(), (F.col("a") == F.col("b"), F.levenshtein("a", "b") <= 1))
    compared = identity.compare(pairs, [level])
    assert [r.gamma_name for r in compared.orderBy("id_l", "id_r").collect()] == [0, 1, 2, -1]
    u = {"name": {0: 0.01, 1: 0.04, 2: 0.95}}
    m, prior = identity.estimate_m(compared, [level], u, 0.5)
    kept = identity.decide_pairs(identity.score(compared, [level], m, u, prior)).filter("decision = 'accept'")
    people = identity.persons(kept, spark.range(1, 7).select(F.col("id").cast("int").alias("id")))
    assert rows(people, "id")[:3] == [(1, 1, 3), (2, 1, 3), (3, 1, 3)]


def test_parity_can_fail(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    assert rows(quality.parity({"same": (a, a), "less": (a, a.distinct())}), "comparison") == [("less", 1, 0), ("same", 0, 0)]


def test_files_round_trip(spark, tmp_path):
    from millrace.sources import files

    (tmp_path / "f.txt").write_bytes("00001A1  1short".ljust(20).encode() + b"caf\xe9\n")
    got = files.read_fixed_width(spark, str(tmp_path / "f.txt"), [("n", 1, 5, "int"), ("code", 6, 4, "string"), ("text", 11, 20, "string")]).first()
    assert (got.n, got.code, got.text) == (1, "A1", "short     café")
    (tmp_path / "d.txt").write_text("a|b\n1|x\n")
    assert files.read_delimited(spark, str(tmp_path / "d.txt")).first().asDict() == {"a": "1", "b": "x"}
    out = files.write_ndjson_by_type(spark.createDataFrame([("1", "P", "{}"), ("2", "P", "{}")], "id string, resource_type string, resource string"), str(tmp_path / "out"))
    assert rows(out, "resource_type") == [("P", 2)]
    log = files.logged_load(spark.range(5), lambda d: d.write.parquet(str(tmp_path / "t")), "s", "t", "r").first()
    assert (log.row_count, log.status) == (5, "success")
