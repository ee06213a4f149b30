"""Continuous capture: messages of a log kept until their transaction is complete, and change rows kept as versioned keyed state, once whatever is replayed.

Both keep their progress in the shared folder: what a batch makes is written first, and counts from when its row in `versions` is written. A batch that fails
between leaves the version before it; delivered again, it writes the same place anew, or, where it had counted already, nothing. One writer at a time."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.changes import after_cut, complete_transactions, merge_state

_VERSIONS = "version long, buckets int, paths map<int,string>, schema string, cut_lsn long, cut_seq long, mark_lsn long, snapshot_lsn long"
_OPEN_VERSIONS = "version long, path string, mark_lsn long"


def _last_version(spark: SparkSession, folder: str, schema: str) -> Row | None:
    try:
        versions = spark.read.schema(schema).parquet(f"{folder}/versions")
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    return versions.orderBy(F.desc("version")).first()


def _mark(spark: SparkSession, folder: str, row: tuple, schema: str) -> None:
    """From here on the version counts."""
    spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(f"{folder}/versions")


# --- state by key, in buckets


def _bucket(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _cut(version: Row) -> tuple[int, int] | None:
    return None if version.cut_lsn is None else (version.cut_lsn, version.cut_seq)


def read_state(spark: SparkSession, folder: str) -> DataFrame | None:
    """The latest version of the state, or None before the first."""
    last = _last_version(spark, folder, _VERSIONS)
    if last is None or last.schema is None:
        return None
    schema = T.StructType.fromJson(json.loads(last.schema))
    if not last.paths:
        return spark.createDataFrame([], schema)
    return after_cut(spark.read.schema(schema).parquet(*last.paths.values()), _cut(last))


def advance(batch: DataFrame, batch_id: int, folder: str, key: Sequence[str], buckets: int = 256) -> None:
    """Merges a batch of change rows into the state. Only the buckets of keys that the batch names are read and written; the version's row lists all buckets.

    A change below what a key already holds loses by its log position; nothing is dropped by time. A truncation takes effect by its position, which stays with
    the version: what lies before it is left out when read, and goes for good when its bucket is next written. Rows of another, later snapshot than the one the
    state has start the state anew from that snapshot's position. `mark_lsn` of a version is the greatest position that has come."""
    spark = batch.sparkSession
    last = _last_version(spark, folder, _VERSIONS)
    if last is not None and last.version >= batch_id:
        return
    if last is not None and last.buckets != buckets:
        raise ValueError(f"the state has {last.buckets} buckets")
    cut_of_batch = F.max(F.when(F.col("_op") == "T", F.struct("_lsn", "_seq")))
    seen = batch.agg(cut_of_batch.alias("cut"), F.max("_lsn").alias("mark"), F.max(F.when(F.col("_op") == "S", F.col("_lsn"))).alias("snapshot")).first()
    paths, cut, snapshot = dict(last.paths or {}) if last else {}, _cut(last) if last else None, last.snapshot_lsn if last else None
    if seen.snapshot is not None and snapshot is not None and seen.snapshot > snapshot:
        paths, cut = {}, max(cut or (-1, 0), (seen.snapshot - 1, 2**31 - 1))
    if seen.cut is not None:
        cut = max(cut or (-1, 0), (seen.cut["_lsn"], seen.cut["_seq"]))
    fresh = after_cut(batch.filter("_op <> 'T'"), cut)
    touched = [r.b for r in fresh.select(_bucket(key, buckets).alias("b")).distinct().collect()]
    schema = T.StructType.fromJson(json.loads(last.schema)) if last and last.schema else fresh.schema
    if touched:
        known = [paths[b] for b in touched if b in paths]
        merged = merge_state(after_cut(spark.read.schema(schema).parquet(*known), cut), fresh, key) if known else merge_state(fresh.limit(0), fresh, key)
        schema, path = merged.schema, f"{folder}/data-{batch_id:012d}"
        merged.withColumn("__bucket", _bucket(key, buckets)).repartition("__bucket").write.mode("overwrite").partitionBy("__bucket").parquet(path)
        paths |= {b: f"{path}/__bucket={b}" for b in touched}
    marks = [m for m in (last.mark_lsn if last else None, seen.mark) if m is not None]
    snapshots = [s for s in (snapshot, seen.snapshot) if s is not None]
    _mark(spark, folder, (batch_id, buckets, paths, json.dumps(schema.jsonValue()), *(cut or (None, None)), max(marks, default=None), max(snapshots, default=None)), _VERSIONS)


def keep_state(stream: DataFrame, folder: str, key: Sequence[str], checkpoint: str, continuous: str | None = None, buckets: int = 256) -> StreamingQuery:
    """Advances the state by each micro-batch of change rows."""
    trigger = {"availableNow": True} if continuous is None else {"processingTime": continuous}
    return stream.writeStream.foreachBatch(lambda batch, batch_id: advance(batch, batch_id, folder, key, buckets)).option("checkpointLocation", checkpoint).trigger(**trigger).start()


# --- transactions


def read_changes(spark: SparkSession, folder: str) -> DataFrame | None:
    """Changes of all complete transactions so far, or None before the first batch."""
    last = _last_version(spark, folder, _OPEN_VERSIONS)
    return None if last is None else spark.read.parquet(f"{folder}/changes").filter(F.col("batch") <= last.version).drop("batch")


def open_messages(spark: SparkSession, folder: str) -> DataFrame | None:
    """Messages of transactions whose commit has not come."""
    last = _last_version(spark, folder, _OPEN_VERSIONS)
    return None if last is None else spark.read.parquet(last.path)


def advance_log(batch: DataFrame, batch_id: int, folder: str, after_lsn: int = 0) -> None:
    """Takes a batch of messages (as for `decode_changes`): changes of transactions that are complete now are written once, the rest is kept for later batches.
    Commits at or before the greatest one taken so far (at first `after_lsn`) are replays and add nothing."""
    spark = batch.sparkSession
    last = _last_version(spark, folder, _OPEN_VERSIONS)
    if last is not None and last.version >= batch_id:
        return
    pending = None if last is None else spark.read.schema(batch.schema).parquet(last.path)
    done, kept, mark = complete_transactions(pending, batch, after_lsn if last is None else last.mark_lsn)
    path = f"{folder}/open-{batch_id:012d}"
    done.write.mode("overwrite").parquet(f"{folder}/changes/batch={batch_id}")
    kept.write.mode("overwrite").parquet(path)
    _mark(spark, folder, (batch_id, path, mark), _OPEN_VERSIONS)


def capture_log(stream: DataFrame, folder: str, checkpoint: str, after_lsn: int = 0, continuous: str | None = None) -> StreamingQuery:
    """Decodes a stream of messages; transactions may span any number of micro-batches."""
    trigger = {"availableNow": True} if continuous is None else {"processingTime": continuous}
    return stream.writeStream.foreachBatch(lambda batch, batch_id: advance_log(batch, batch_id, folder, after_lsn)).option("checkpointLocation", checkpoint).trigger(**trigger).start()
