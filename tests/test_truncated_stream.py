"""A stream's state after truncations, in their own batch, among changes, and with older changes coming later."""

from millrace.operators import changes
from millrace.streaming.capture import keep_state, read_state

SCHEMA = "id int, v string, _op string, _lsn long, _seq int"
BATCHES = [
    [(1, "x", "S", 10, 0), (2, "y", "S", 10, 1), (5, "w", "I", 12, 0)],
    [(2, "y2", "U", 20, 0), (0, None, "T", 20, 1), (3, "z", "I", 20, 2)],
    [(4, "late", "I", 15, 0), (1, "late", "U", 16, 0)],
    [(6, "q", "I", 30, 0), (7, "r", "I", 31, 0), (6, None, "D", 32, 0)],
    [(0, None, "T", 30, 1)],
]


def test_stream_equals_batch_after_every_truncation(spark, tmp_path):
    seen = []
    for batch in BATCHES:
        seen += batch
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
        keep_state(stream, str(tmp_path / "state"), ["id"], str(tmp_path / "check")).awaitTermination()
        got = sorted((r.id, r.v) for r in read_state(spark, str(tmp_path / "state")).filter("_op <> 'D'").collect())
        assert got == sorted((r.id, r.v) for r in changes.current_state(spark.createDataFrame(seen, SCHEMA), ["id"]).collect())
    assert got == [(7, "r")]
