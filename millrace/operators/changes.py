"""Change capture: decoding, current state, incremental merge, resets, latency."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import lsn_to_long
from millrace.operators.relational import bag_difference, gap_seconds, latest_per_key, numbered, quantiles, stack


def decode_changes(messages: DataFrame, after_lsn: int) -> DataFrame:
    """tbl, op, lsn, seq, commit_ts, payload of the changes of complete transactions beyond a position.

    messages: xid, n (order in the log), action (B, C, I, U, D, T), table, lsn (`high/low`), timestamp, payload. A transaction
    counts once its commit is there; changes are numbered within it."""
    commits = messages.filter("action = 'C'").select("xid", lsn_to_long(F.col("lsn")).alias("lsn"), F.col("timestamp").alias("commit_ts")).filter(F.col("lsn") > after_lsn)
    rows = messages.filter("action IN ('I','U','D','T')").select("xid", "n", F.col("table").alias("tbl"), F.col("action").alias("op"), "payload")
    placed = numbered(rows.join(commits, "xid"), ["xid"], [F.col("n")], "__seq", "__first")
    return placed.select("tbl", "op", "lsn", (F.col("__seq") - 1).alias("seq"), "commit_ts", "payload")


def complete_transactions(pending: DataFrame | None, batch: DataFrame, after_lsn: int) -> tuple[DataFrame, DataFrame, int]:
    """Changes of the transactions that a batch of messages completes, messages to keep until their commit comes, and the greatest commit position so far.

    pending: the messages kept by the step before. Messages that come again count once; those of transactions committed at or before `after_lsn` go with
    their commit."""
    messages = (batch if pending is None else pending.unionByName(batch)).dropDuplicates(["xid", "n", "action"])
    commits = messages.filter("action = 'C'").select("xid", lsn_to_long(F.col("lsn")).alias("lsn"))
    mark = commits.agg(F.max("lsn")).first()[0]
    kept = messages.filter("action IN ('I','U','D','T')").join(commits.select("xid").distinct(), "xid", "left_anti").select(*batch.columns)
    return decode_changes(messages, after_lsn), kept, max(after_lsn, mark if mark is not None else after_lsn)


def _latest(changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """The latest change per key by (position, sequence), reduced before the shuffle: a key with very many changes is one row a task."""
    rest = [c for c in changes.columns if c not in key]
    return changes.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct("_lsn", "_seq")).alias("__row")).select(*(F.col(c) if c in key else F.col(f"__row.{c}").alias(c) for c in changes.columns))


def route_changes(changes: DataFrame, schemas: dict[str, T.StructType], op: str = "op") -> dict[str, DataFrame]:
    """One change table per source table: its payload's columns, typed by the schema, and the change columns.

    changes: tbl, op, lsn, seq, commit_ts, payload (JSON text). Numbers keep the digits they are written with until they are cast; a
    value that does not fit its type is null. Each table is a filter of the same batch, to be cached by the caller if read more than once."""
    out = {}
    for name, schema in schemas.items():
        body = changes.filter(F.col("tbl") == name).withColumn("__p", F.try_parse_json("payload"))
        columns = [F.try_variant_get("__p", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in schema]
        out[name] = body.select(*columns, F.col(op).alias("_op"), F.col("lsn").alias("_lsn"), F.col("seq").alias("_seq"), F.col("commit_ts").alias("_commit_ts"))
    return out


def reconcile(tables: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """table, only_state, only_source: rows (as bags) that a state and its source do not share, for each table."""
    return stack(*(bag_difference(state, source.select(*state.columns)).select(F.lit(name).alias("table"), F.col("only_a").alias("only_state"), F.col("only_b").alias("only_source")) for name, (state, source) in tables.items()))


def snapshot_needed(tables: DataFrame, states: DataFrame, health: DataFrame) -> DataFrame:
    """table, reason of the tables that must be snapshot anew. tables: table, slot_name. states: table, rows. health: slot_name, problems (of `slot_health`)."""
    lost = health.filter(F.array_contains("problems", "lost")).select("slot_name").withColumn("__lost", F.lit(True))
    seen = states.groupBy("table").agg(F.sum("rows").alias("__rows"))
    found = tables.join(seen, "table", "left").join(F.broadcast(lost), "slot_name", "left")
    reason = F.when(F.col("__rows").isNull(), "no table").when(F.col("__rows") == 0, "no state").when(F.col("__lost"), "slot lost")
    return found.select("table", reason.alias("reason")).filter("reason IS NOT NULL")


def slot_lag(observations: DataFrame) -> DataFrame:
    """slot_name, observations, longest gap in seconds between them, median and greatest retained bytes, and the latest status."""
    gaps = gap_seconds(observations, "slot_name", "observed_at", "retained_bytes")
    counted = gaps.groupBy("slot_name").agg(
        F.count(F.lit(1)).alias("observations"), F.max("gap_s").alias("longest_gap_s"), F.max("retained_bytes").alias("most_bytes"),
        F.max_by("wal_status", F.struct("observed_at", "retained_bytes")).alias("last_status"),
    )
    medians = quantiles(observations, ["slot_name"], "retained_bytes", {"median_bytes": 0.5})
    return counted.join(medians, "slot_name", "left").select("slot_name", "observations", "longest_gap_s", "median_bytes", "most_bytes", "last_status")


def current_state(changes: DataFrame, key: Sequence[str], up_to: int | None = None) -> DataFrame:
    """Rows alive: after the last truncation, the latest change per key by (position, sequence), deletes left out."""
    if up_to is not None:
        changes = changes.filter(F.col("_lsn") <= up_to)
    cut = changes.agg(F.max(F.when(F.col("_op") == "T", F.struct("_lsn", "_seq"))).alias("cut"))
    live = changes.filter("_op <> 'T'").crossJoin(F.broadcast(cut)).filter(F.col("cut").isNull() | (F.struct("_lsn", "_seq") > F.col("cut"))).drop("cut")
    return _latest(live, key).filter("_op <> 'D'")


def changes_after(changes: DataFrame, key: Sequence[str], lsn: int) -> DataFrame:
    """The latest change per key beyond a position, deletes among them."""
    return _latest(changes.filter((F.col("_lsn") > lsn) & (F.col("_op") != "T")), key)


def merge_state(state: DataFrame, delta: DataFrame, key: Sequence[str]) -> DataFrame:
    """State with the delta's keys replaced; tombstones stay, so a replayed older change can't bring a row back."""
    both = state.unionByName(delta, allowMissingColumns=True)
    return _latest(both, key)


def last_cut(changes: DataFrame) -> tuple[int, int] | None:
    """(position, sequence) of the last truncation among changes, or None."""
    cut = changes.agg(F.max(F.when(F.col("_op") == "T", F.struct("_lsn", "_seq"))).alias("cut")).first().cut
    return None if cut is None else (cut["_lsn"], cut["_seq"])


def after_cut(rows: DataFrame, cut: tuple[int, int] | None) -> DataFrame:
    """The rows that a truncation leaves: those beyond its position."""
    return rows if cut is None else rows.filter((F.col("_lsn") > cut[0]) | ((F.col("_lsn") == cut[0]) & (F.col("_seq") > cut[1])))


def advance_state(state: DataFrame | None, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """The state after a batch of changes that all come later: a truncation in the batch removes what lies before it, in the state and in the batch.
    Tombstones stay."""
    cut = last_cut(batch)
    fresh = after_cut(batch.filter("_op <> 'T'"), cut)
    return merge_state(fresh if state is None else after_cut(state, cut), fresh, key)


def resets(states: DataFrame, changes: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """key, reset: for each table, as `key` names it, that has a state or changes, whether its state must be rebuilt: it is empty, another snapshot has come, or a
    truncation lies beyond it. All tables are judged in one pass over each side."""
    keys = [key] if isinstance(key, str) else list(key)
    snapshot = F.max(F.when(F.col("_op") == "S", F.col("_lsn")))
    s = states.groupBy(*keys).agg(F.max("_lsn").alias("__mark"), snapshot.alias("__had"))
    c = changes.groupBy(*keys).agg(F.max(F.when(F.col("_op") == "T", F.col("_lsn"))).alias("__cut"), snapshot.alias("__got"))
    tests = (F.col("__mark").isNull(), F.col("__got") != F.col("__had"), F.col("__cut") > F.col("__mark"))
    return s.join(c, keys, "full").select(*keys, F.greatest(*(F.coalesce(test, F.lit(False)) for test in tests)).alias("reset"))


def needs_reset(state: DataFrame, changes: DataFrame) -> bool:
    """`resets` of one table; a table without state and changes is rebuilt, too."""
    one = lambda df: df.withColumn("__table", F.lit(0))
    found = resets(one(state), one(changes), "__table").first()
    return found is None or found.reset


def change_latency(changes: DataFrame, key: str, started: str, ended: str) -> DataFrame:
    """Number of changes and exact median, 95th percentile and maximum of their delay in seconds."""
    delayed = changes.withColumn("__d", (F.unix_millis(ended) - F.unix_millis(started)) / 1000)
    counted = delayed.groupBy(key).agg(F.count(F.lit(1)).alias("changes"), F.max("__d").alias("max_s"))
    return counted.join(quantiles(delayed, [key], "__d", {"p50_s": 0.5, "p95_s": 0.95}), key, "left").select(key, "changes", "p50_s", "p95_s", "max_s")


def operation_latency(changes: DataFrame, key: str, op: str, started: str, ended: str, ops: Sequence[str] = ("S", "I", "U", "D", "T")) -> DataFrame:
    """`change_latency`, and the number of changes of each operation (`op_I` and so on) and their first and last end."""
    per_op = changes.groupBy(key).agg(*(F.count_if(F.col(op) == o).alias(f"op_{o}") for o in ops), F.min(ended).alias("first_at"), F.max(ended).alias("last_at"))
    return change_latency(changes, key, started, ended).join(per_op, key)


def slot_health(observations: DataFrame, max_mb: int = 512) -> DataFrame:
    """Problems of each slot's latest observation; of several at one instant, of that with the most retained bytes, then the first status by name."""
    last = latest_per_key(observations, ["slot_name"], [F.desc("observed_at"), F.desc("retained_bytes"), F.asc("wal_status")])
    tests = {"lost": F.col("wal_status") == "lost", "unreserved": F.col("wal_status") == "unreserved", "retains too much": F.col("retained_bytes") > max_mb * 1048576}
    problems = F.filter(F.array(*(F.when(test, F.lit(name)) for name, test in tests.items())), lambda x: x.isNotNull())
    return last.select("slot_name", "observed_at", problems.alias("problems"))
