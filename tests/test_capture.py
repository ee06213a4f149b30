"""Transactions that span batches, and state in buckets: what is written, what is read after a crash, and what replays add."""

import pytest
from millrace.operators import changes
from millrace.streaming import capture
from pyspark.sql import functions as F

MESSAGES = "xid long, n long, action string, `table` string, lsn string, timestamp timestamp, payload string"
STATE = "id long, v string, _op string, _lsn long, _seq int"


def message(xid, n, action, lsn):
    return (xid, n, action, None if action in "BC" else "t", f"0/{lsn:X}", None, None if action in "BC" else f'{{"n": {n}}}')


def test_transactions_over_batches(spark, tmp_path):
    """Rows in one batch and the commit in a later one appear once, in order; replays, even of whole batches, add nothing; what is open stays open."""
    batches = [
        [message(1, 0, "B", 5), message(1, 1, "I", 5), message(2, 2, "I", 6)],
        [message(1, 3, "U", 5), message(2, 4, "C", 8)],
        [message(1, 5, "C", 10), message(3, 6, "I", 12)],
        [message(1, 1, "I", 5), message(1, 3, "U", 5), message(1, 5, "C", 10), message(2, 2, "I", 6), message(2, 4, "C", 8), message(3, 6, "I", 12), message(3, 7, "D", 12)],
        [message(3, 8, "C", 20), message(4, 9, "I", 21)],
    ]
    want = [set(), {(8, 0, "I")}, {(8, 0, "I"), (10, 0, "I"), (10, 1, "U")}, None, {(8, 0, "I"), (10, 0, "I"), (10, 1, "U"), (20, 0, "I"), (20, 1, "D")}]
    want[3] = want[2]
    folder = str(tmp_path / "log")
    for k, batch in enumerate(batches):
        df = spark.createDataFrame(batch, MESSAGES)
        for _ in range(2):
            capture.advance_log(df, k, folder)
        got = [(r.lsn, r.seq, r.op) for r in capture.read_changes(spark, folder).collect()]
        assert len(got) == len(set(got)) and set(got) == want[k]
    assert [r.xid for r in capture.open_messages(spark, folder).collect()] == [4]


def test_messages_of_a_stream(spark, tmp_path):
    for part in ([message(1, 1, "I", 5)], [message(1, 2, "C", 7)], [message(1, 1, "I", 5), message(1, 2, "C", 7)]):
        spark.createDataFrame(part, MESSAGES).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(MESSAGES).parquet(str(tmp_path / "in"))
        capture.capture_log(stream, str(tmp_path / "log"), str(tmp_path / "check")).awaitTermination()
    assert [(r.lsn, r.op) for r in capture.read_changes(spark, str(tmp_path / "log")).collect()] == [(7, "I")]


def test_a_batch_lost_before_its_version_counts(spark, tmp_path, monkeypatch):
    folder, log = str(tmp_path / "state"), str(tmp_path / "log")
    first, second = spark.createDataFrame([(1, "a", "S", 1, 0), (2, "b", "S", 1, 0)], STATE), spark.createDataFrame([(1, None, "D", 5, 0), (3, "c", "I", 5, 1)], STATE)
    capture.advance(first, 0, folder, ["id"], 8)
    capture.advance_log(spark.createDataFrame([message(1, 1, "I", 5)], MESSAGES), 0, log)

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(capture, "_mark", fail)
        with pytest.raises(OSError):
            capture.advance(second, 1, folder, ["id"], 8)
        with pytest.raises(OSError):
            capture.advance_log(spark.createDataFrame([message(1, 2, "C", 7)], MESSAGES), 1, log)
    assert {(r.id, r.v) for r in capture.read_state(spark, folder).collect()} == {(1, "a"), (2, "b")} and capture.read_changes(spark, log).count() == 0
    capture.advance(second, 1, folder, ["id"], 8)
    capture.advance_log(spark.createDataFrame([message(1, 2, "C", 7)], MESSAGES), 1, log)
    assert {(r.id, r.v, r._op) for r in capture.read_state(spark, folder).collect()} == {(1, None, "D"), (2, "b", "S"), (3, "c", "I")} and capture.read_changes(spark, log).count() == 1


def test_a_small_batch_writes_few_buckets(spark, tmp_path):
    folder = str(tmp_path / "state")
    rows = lambda n, lsn: spark.range(n).select("id", F.lit(f"v{lsn}").alias("v"), F.lit("U").alias("_op"), F.lit(lsn).cast("long").alias("_lsn"), F.lit(0).alias("_seq"))
    capture.advance(rows(100_000, 1), 0, folder, ["id"], 512)
    before = capture._last_version(spark, folder, capture._VERSIONS).paths
    capture.advance(rows(100, 2), 1, folder, ["id"], 512)
    last = capture._last_version(spark, folder, capture._VERSIONS)
    assert len(last.paths) == len(before) == 512 and 0 < sum(last.paths[b] != before[b] for b in before) <= 100 and last.mark_lsn == 2
    assert {(r.v, r["count"]) for r in capture.read_state(spark, folder).groupBy("v").count().collect()} == {("v1", 99_900), ("v2", 100)}
    with pytest.raises(ValueError):
        capture.advance(rows(1, 3), 2, folder, ["id"], 64)


def test_another_snapshot_starts_anew_and_truncations_alone(spark, tmp_path):
    folder = str(tmp_path / "state")
    batches = [[(1, "a", "S", 1, 0), (2, "b", "S", 1, 1)], [(3, "c", "I", 4, 0)], [(1, "n", "S", 9, 0)], [(2, "old", "U", 5, 0), (4, "d", "I", 10, 0)], [(0, None, "T", 11, 0)], [(5, "e", "I", 12, 0)]]
    want = [{1: "a", 2: "b"}, {1: "a", 2: "b", 3: "c"}, {1: "n"}, {1: "n", 4: "d"}, {}, {5: "e"}]
    for k, (batch, state) in enumerate(zip(batches, want)):
        df = spark.createDataFrame(batch, STATE)
        if k == 2:
            assert changes.needs_reset(capture.read_state(spark, folder), df)
        capture.advance(df, k, folder, ["id"], 4)
        assert {r.id: r.v for r in capture.read_state(spark, folder).collect()} == state
