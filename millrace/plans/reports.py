"""Registered queries of capture checks, run summaries, gates, sources and the smaller shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import columns as c
from millrace.operators import changes, quality, relational
from millrace.plans.registry import query
from millrace.sources import files
from millrace.sources.files import table
from millrace.sources.shared import shared_folder
from millrace.streaming import capture

# --- capture


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    op = F.when(F.col("event_type") == "error", "D").otherwise("U")
    return table(spark, sf_dir, "events").select("user_id", "value", F.col("event_id").alias("_seq"), F.unix_micros(F.col("ts").cast("timestamp")).alias("_lsn"), op.alias("_op"))


@query("cd07_reconcile", """WITH s AS (SELECT user_id, arg_max(value, (ts, event_id)) AS value, arg_max(event_type, (ts, event_id)) AS e FROM events GROUP BY 1), state AS (SELECT user_id FROM s WHERE e <> 'error')
    SELECT 'users' AS "table", (SELECT count(*) FROM state WHERE user_id % 10 = 0) AS only_state, (SELECT count(*) FROM state WHERE user_id % 10 = 0) AS only_source UNION ALL SELECT 'alive', 0, 0""")
def cd07(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of a log against its source; in one of the two the source's values of every tenth user have changed since."""
    state = changes.current_state(_log(spark, sf_dir), ["user_id"]).select("user_id", "value")
    newest = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max_by(F.struct("value", "event_type"), F.struct("ts", "event_id")).alias("x")).filter("x.event_type <> 'error'").select("user_id", F.col("x.value").alias("value"))
    moved = newest.withColumn("value", F.when(F.col("user_id") % 10 == 0, F.col("value") + 1).otherwise(F.col("value")))
    return changes.reconcile({"users": (state, moved), "alive": (state.select("user_id"), newest)})


def _observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as observations of slots: one slot for each type."""
    status = F.when(F.col("event_id") % 997 == 0, "lost").when(F.col("event_id") % 101 == 0, "unreserved").otherwise("reserved")
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("slot_name"), F.date_trunc("second", F.col("ts").cast("timestamp")).alias("observed_at"), (F.col("event_id") * 1000).alias("retained_bytes"), status.alias("wal_status"))


_OBSERVED_SQL = "SELECT event_type AS slot_name, date_trunc('second', ts) AS observed_at, event_id * 1000 AS retained_bytes, CASE WHEN event_id % 997 = 0 THEN 'lost' WHEN event_id % 101 = 0 THEN 'unreserved' ELSE 'reserved' END AS wal_status FROM events"


@query("cd09_slot_lag", f"""WITH o AS ({_OBSERVED_SQL}), g AS (SELECT *, epoch(observed_at) - epoch(lag(observed_at) OVER (PARTITION BY slot_name ORDER BY observed_at, retained_bytes)) AS gap FROM o)
    SELECT slot_name, count(*) AS observations, max(gap)::DOUBLE AS longest_gap_s, quantile_cont(retained_bytes, 0.5)::DOUBLE AS median_bytes, max(retained_bytes) AS most_bytes, arg_max(wal_status, (observed_at, retained_bytes)) AS last_status FROM g GROUP BY 1""")
def cd09(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.slot_lag(_observations(spark, sf_dir)).withColumn("longest_gap_s", F.col("longest_gap_s").cast("double"))


@query("cd10_slot_health", f"""WITH o AS ({_OBSERVED_SQL}), l AS (SELECT *, row_number() OVER (PARTITION BY slot_name ORDER BY observed_at DESC, retained_bytes DESC) AS n FROM o WHERE retained_bytes % 3000 = 0)
    SELECT slot_name, concat_ws(',', CASE WHEN wal_status = 'lost' THEN 'lost' END, CASE WHEN wal_status = 'unreserved' THEN 'unreserved' END, CASE WHEN retained_bytes > 1048576 THEN 'retains too much' END) AS problems FROM l WHERE n = 1""")
def cd10(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = _observations(spark, sf_dir).filter("retained_bytes % 3000 = 0").groupBy("slot_name", "observed_at").agg(F.max_by(F.struct("retained_bytes", "wal_status"), "retained_bytes").alias("x")).select("slot_name", "observed_at", "x.*")
    return changes.slot_health(seen, max_mb=1).select("slot_name", F.array_join("problems", ",").alias("problems"))


@query("cd10_slot_health_all", f"""WITH o AS ({_OBSERVED_SQL}), l AS (SELECT *, row_number() OVER (PARTITION BY slot_name ORDER BY observed_at DESC, retained_bytes DESC) AS n FROM o)
    SELECT slot_name, concat_ws(',', CASE WHEN wal_status = 'lost' THEN 'lost' END, CASE WHEN wal_status = 'unreserved' THEN 'unreserved' END, CASE WHEN retained_bytes > 1048576 THEN 'retains too much' END) AS problems FROM l WHERE n = 1""")
def cd10_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All observations, several at one instant among them."""
    return changes.slot_health(_observations(spark, sf_dir), max_mb=1).select("slot_name", F.array_join("problems", ",").alias("problems"))


@query("cd11_snapshots", """WITH s AS (SELECT event_type AS t, count(*) FILTER (WHERE value > 300) AS n FROM events WHERE event_type <> 'view' GROUP BY 1), l AS (SELECT event_type AS t, bool_or(event_id % 997 = 0) AS lost FROM events GROUP BY 1)
    SELECT t AS "table", CASE WHEN n IS NULL THEN 'no table' WHEN n = 0 THEN 'no state' ELSE 'slot lost' END AS reason FROM l LEFT JOIN s USING (t) WHERE n IS NULL OR n = 0 OR lost""")
def cd11(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    tables = events.select(F.col("event_type").alias("table"), F.col("event_type").alias("slot_name")).distinct()
    states = events.filter("event_type <> 'view'").groupBy(F.col("event_type").alias("table")).agg(F.count_if(F.col("value") > 300).alias("rows"))
    health = events.groupBy(F.col("event_type").alias("slot_name")).agg(F.array_distinct(F.collect_set(F.when(F.col("event_id") % 997 == 0, "lost"))).alias("problems"))
    return changes.snapshot_needed(tables, states, health)


_ROUTED_SQL = """SELECT 'orders' AS tbl, o_orderkey AS id, o_totalprice::DECIMAL(18,2)::VARCHAR AS amount, strftime(o_orderdate, '%Y-%m-%d') AS day, 'I' AS op, o_orderkey // 10 AS lsn, row_number() OVER (PARTITION BY o_orderkey // 10 ORDER BY o_orderkey) - 1 AS seq FROM orders WHERE (o_orderkey // 10) % 7 <> 0 AND o_orderkey // 10 > 20"""


def _messages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Ten orders are a transaction, of which every seventh is not committed: its rows, and its commits."""
    orders = table(spark, sf_dir, "orders").withColumn("xid", F.floor(F.col("o_orderkey") / 10))
    lsn = F.concat(F.lit("0/"), F.hex("xid"))
    body = F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.col("o_totalprice").cast("decimal(18,2)").alias("amount"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")))
    stamp = F.lit(None).cast("timestamp").alias("timestamp")
    rows = orders.select("xid", F.col("o_orderkey").alias("n"), F.lit("I").alias("action"), F.lit("orders").alias("table"), lsn.alias("lsn"), stamp, body.alias("payload"))
    commits = orders.filter("xid % 7 <> 0").select("xid", F.lit(0).cast("long").alias("n"), F.lit("C").alias("action"), F.lit(None).cast("string").alias("table"), lsn.alias("lsn"), stamp, F.lit(None).cast("string").alias("payload")).distinct()
    return rows, commits


def _routed(decoded: DataFrame) -> DataFrame:
    """Payloads typed by their table's schema."""
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("amount", T.DecimalType(18, 2)), T.StructField("day", T.DateType())])
    routed = changes.route_changes(decoded, {"orders": schema})["orders"]
    return routed.select(F.lit("orders").alias("tbl"), "id", F.col("amount").cast("string").alias("amount"), F.date_format("day", "yyyy-MM-dd").alias("day"), F.col("_op").alias("op"), F.col("_lsn").alias("lsn"), F.col("_seq").cast("long").alias("seq"))


@query("sc02_routed_changes", _ROUTED_SQL)
def sc02(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes up to a position are left out."""
    rows, commits = _messages(spark, sf_dir)
    return _routed(changes.decode_changes(rows.unionByName(commits), 20))


@query("sc02_split_transactions", _ROUTED_SQL)
def sc02_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages in four batches: every transaction's rows are split over two and its commit comes in the third; the first comes again in the fourth."""
    rows, commits = _messages(spark, sf_dir)
    folder, half = _fresh(spark, "log"), F.col("n") % 2 == 0
    for k, batch in enumerate((rows.filter(half), rows.filter(~half), commits, rows.filter(half).unionByName(commits.filter("xid % 2 = 0")))):
        capture.advance_log(batch, k, folder, 20)
    return _routed(capture.read_changes(spark, folder))


@query("sc01_snapshot", "SELECT s_suppkey, s_name, 'S' AS _op, 77 AS _lsn, true AS uncommitted FROM supplier")
def sc01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.snapshot_as_changes(table(spark, sf_dir, "supplier"), 77, "r").select("s_suppkey", "s_name", "_op", F.col("_lsn").cast("int").alias("_lsn"), F.col("_commit_ts").isNull().alias("uncommitted"))


# --- sources: what was written is read again


def _fresh(spark: SparkSession, name: str) -> str:
    from uuid import uuid4

    return f"{shared_folder(spark)}/{name}-{uuid4().hex}"


@query("sc05_delimited", "SELECT p_partkey::VARCHAR AS p_partkey, p_name, p_size::VARCHAR AS p_size FROM part")
def sc05(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _fresh(spark, "delimited")
    table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size").write.csv(path, sep="|", header=True)
    return files.read_delimited(spark, path, "|")


@query("sc06_fixed_width", "SELECT p_partkey::INT AS key, trim(left(p_name, 20)) AS name, p_size::INT AS size FROM part")
def sc06(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _fresh(spark, "fixed")
    line = F.concat(F.lpad(F.col("p_partkey").cast("string"), 10, " "), F.rpad("p_name", 20, " "), F.lpad(F.col("p_size").cast("string"), 5, " "))
    table(spark, sf_dir, "part").select(line).write.text(path)
    return files.read_fixed_width(spark, path, [("key", 1, 10, "int"), ("name", 11, 20, "string"), ("size", 31, 5, "int")])


@query("sc07_tab_separated", "SELECT doc_id::VARCHAR AS doc_id, lang, source FROM documents")
def sc07(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _fresh(spark, "tabs")
    table(spark, sf_dir, "documents").select("doc_id", "lang", "source").write.csv(path, sep="\t", header=True, encoding="ISO-8859-1", quote="")
    return files.read_delimited(spark, path, "\t", "ISO-8859-1")


@query("sc08_seed", "SELECT n_nationkey::INT AS n_nationkey, n_name FROM nation")
def sc08(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _fresh(spark, "seed")
    table(spark, sf_dir, "nation").select("n_nationkey", "n_name").write.csv(path, header=True)
    return files.read_seed(spark, path, "n_nationkey int, n_name string")


@query("sc04_resources", "SELECT c_custkey AS id, 'Patient' AS resource_type FROM customer")
def sc04(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written by type and read again whole."""
    path = _fresh(spark, "resources")
    body = F.to_json(F.struct(F.lit("Patient").alias("resourceType"), F.col("c_custkey").alias("id")))
    files.write_ndjson_by_type(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.lit("Patient").alias("resource_type"), body.alias("resource")), path)
    read = files.read_resources(spark, f"{path}/resources/resource_type=Patient", "r")
    return read.select(F.variant_get("resource", "$.id", "bigint").alias("id"), F.variant_get("resource", "$.resourceType", "string").alias("resource_type"))


@query("sc11_export_manifest", "SELECT CASE o_orderstatus WHEN 'F' THEN 'Claim' ELSE 'Coverage' END AS resource_type, count(*) AS rows FROM orders GROUP BY 1")
def sc11(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("o_orderstatus") == "F", "Claim").otherwise("Coverage")
    return files.write_ndjson_by_type(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), kind.alias("resource_type"), F.to_json(F.struct("o_orderkey")).alias("resource")), _fresh(spark, "export"))


@query("sc13_incremental", "SELECT user_id, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1")
def sc13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyed table built from half of the events and then merged with the other half."""
    path = _fresh(spark, "incremental")
    log = table(spark, sf_dir, "events").select("user_id", "value", F.unix_micros(F.col("ts").cast("timestamp")).alias("_lsn"), F.col("event_id").alias("_seq"))

    def merge(before: DataFrame | None, more: DataFrame) -> DataFrame:
        return changes.merge_state(more if before is None else before, more, ["user_id"])

    for half in (0, 1):
        made = files.materialize(log.filter(F.col("_seq") % 2 == half), "latest_events", "incremental", path, merge)
    return made.select("user_id", "value")


@query("sc09_load_log", "SELECT 'part' AS source, count(*) AS row_count, 'success' AS status FROM part")
def sc09(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _fresh(spark, "loads")
    files.logged_load(table(spark, sf_dir, "part"), lambda df: df.write.parquet(f"{path}/part"), "part", "copy", "r", f"{path}/log")
    return spark.read.parquet(f"{path}/log").select("source", "row_count", "status")


# --- run summaries and gates


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months as runs of a scale factor (their remainder by three), with two metrics."""
    month = F.date_format("o_orderdate", "yyyy-MM")
    wide = table(spark, sf_dir, "orders").groupBy(month.alias("run_key")).agg(F.count(F.lit(1)).cast("double").alias("orders"), F.countDistinct("o_custkey").cast("double").alias("customers"))
    return wide.withColumn("factor", F.substring("run_key", 6, 2).cast("int") % 3)


@query("q10_kpi", "WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS k, count(*)::DOUBLE AS v FROM orders GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY k DESC) AS n FROM m) SELECT 'orders' AS metric, max(v) FILTER (WHERE n = 1) AS value, max(v) FILTER (WHERE n = 2) AS previous, max(v) FILTER (WHERE n = 1) - max(v) FILTER (WHERE n = 2) AS change FROM r")
def q10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.kpi_row(_runs(spark, sf_dir).select("run_key", F.lit("orders").alias("metric"), F.col("orders").alias("value")), "orders", "run_key")


@query("q11_scale_summary", "WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS run_key, count(*)::DOUBLE AS orders, count(DISTINCT o_custkey)::DOUBLE AS customers FROM orders GROUP BY 1), f AS (SELECT *, right(run_key, 2)::INT % 3 AS factor FROM m) SELECT factor, run_key, orders, customers FROM (SELECT *, row_number() OVER (PARTITION BY factor ORDER BY run_key DESC) AS n FROM f) WHERE n = 1")
def q11(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = _runs(spark, sf_dir)
    metrics = wide.unpivot(["run_key", "factor"], ["orders", "customers"], "metric", "value")
    return quality.scale_summary(metrics, wide.select("run_key", "factor", F.col("run_key").alias("at")), "factor", "at", ["orders", "customers"])


@query("q12_issues", "SELECT CASE WHEN l_linenumber = 1 THEN 'known' WHEN l_returnflag = 'A' THEN 'unverified' ELSE 'real' END AS class, l_linestatus AS severity, 'line ' || l_linenumber AS message, count(*) AS issues FROM lineitem GROUP BY ALL")
def q12(spark: SparkSession, sf_dir: str) -> DataFrame:
    issues = table(spark, sf_dir, "lineitem").select(F.col("l_linestatus").alias("severity"), F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("message"), "l_returnflag")
    return quality.issue_summary(issues, F.col("message") == "line 1", F.col("l_returnflag") == "A")


@query("q13_compare_sets", "SELECT count(*) FILTER (WHERE o_orderkey % 10 = 0) AS missing, count(*) FILTER (WHERE o_orderkey % 15 = 0) AS extra, count(*) FILTER (WHERE o_orderkey % 7 = 0 AND o_orderkey % 10 <> 0) AS different FROM orders")
def q13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exported orders of which every tenth is missing, every fifteenth comes again under another id and every seventh is altered."""
    k = F.col("o_orderkey")
    gold = table(spark, sf_dir, "orders").select(k, F.to_json(F.struct("o_custkey", "o_totalprice")).alias("body"))
    altered = gold.filter(k % 10 != 0).withColumn("body", F.when(k % 7 == 0, F.concat("body", F.lit(" "))).otherwise(F.col("body")))
    return quality.compare_sets(gold, altered.unionByName(gold.filter(k % 15 == 0).withColumn("o_orderkey", -k - 1)), "o_orderkey", "body")


@query("q03_gates", "SELECT 'no negative balance' AS assertion, count(*) FILTER (WHERE c_acctbal < 0) AS rows FROM customer UNION ALL SELECT 'orders have customers', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 50 <> 0) UNION ALL SELECT 'keys are unique', 0")
def q03(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    missing = relational.orphans(orders, customers.filter("c_custkey % 50 <> 0"), "o_custkey", "c_custkey")
    return quality.gate({"no negative balance": customers.filter("c_acctbal < 0"), "orders have customers": missing, "keys are unique": relational.duplicates(orders, ["o_orderkey"])})


@query("q01_relationships", "SELECT 'order_customer' AS \"check\", 'warn' AS severity, count(*) AS failures FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 40 <> 0)")
def q01_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.relationship_failures(table(spark, sf_dir, "orders"), "o_custkey", table(spark, sf_dir, "customer").filter("c_custkey % 40 <> 0"), "c_custkey", "order_customer", "warn")


# --- smaller shapes


@query("w06_sequence", "SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)::INT AS number, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1 AS is_first FROM orders")
def w06(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.numbered(table(spark, sf_dir, "orders"), ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")]).select("o_orderkey", "number", "is_first")


@query("a15_latest_attributes", "SELECT c_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS o_orderstatus, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS o_totalprice FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1")
def a15(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return relational.with_latest(table(spark, sf_dir, "customer").select("c_custkey"), orders, "c_custkey", ["o_orderdate", "o_orderkey"], ["o_orderstatus", "o_totalprice"])


@query("j16_decided_join", """WITH d AS (SELECT o_orderkey AS k, o_custkey AS m, o_totalprice AS v, CASE WHEN o_orderstatus = 'F' THEN 'accept' ELSE 'reject' END AS d FROM orders WHERE o_orderkey % 3 = 0)
    SELECT l_orderkey, l_linenumber, l_suppkey, coalesce(a.v, b.v) AS v FROM lineitem LEFT JOIN (SELECT k, max(v) AS v FROM d WHERE d = 'accept' GROUP BY 1) a ON k = l_orderkey LEFT JOIN (SELECT m, max(v) AS v FROM d WHERE d = 'accept' GROUP BY 1) b ON m = l_suppkey""")
def j16(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    decisions = table(spark, sf_dir, "orders").filter("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("l_suppkey"), F.col("o_totalprice").alias("v"), F.when(F.col("o_orderstatus") == "F", "accept").otherwise("reject").alias("d"))
    return relational.decided_join(lines, decisions, [["l_orderkey"], ["l_suppkey"]], "d", "accept", ["v"])


@query("t03_latest_orders", "SELECT o_orderkey FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 20")
def t03(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.latest_n(table(spark, sf_dir, "orders"), ["o_orderdate", "o_orderkey"], 20).select("o_orderkey")


@query("t05_latest_runs", "WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS run_key FROM orders GROUP BY 1) SELECT right(run_key, 2)::INT % 3 AS factor, max(run_key) AS run_key FROM m GROUP BY 1")
def t05(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = _runs(spark, sf_dir).select("factor", F.col("run_key").alias("at"), "run_key")
    return quality.latest_per_factor(runs, "factor", "at").select("factor", "run_key")


@query("t01_scopes_in_order", "WITH s AS (SELECT 'all' AS scope, count(*) AS orders FROM orders UNION ALL SELECT o_orderpriority, count(*) FROM orders GROUP BY 1) SELECT scope, orders, row_number() OVER (ORDER BY scope = 'all' DESC, scope) AS place FROM s")
def t01(spark: SparkSession, sf_dir: str) -> DataFrame:
    scopes = relational.scoped_agg(table(spark, sf_dir, "orders"), F.array(F.lit("all"), F.col("o_orderpriority")), [F.count(F.lit(1)).alias("orders")])
    return _placed(relational.scopes_first(scopes, "scope"))


def _placed(ordered: DataFrame) -> DataFrame:
    """The order of a handful of scopes as a column."""
    return ordered.agg(F.collect_list(F.struct("scope", "orders")).alias("rows")).select(F.posexplode("rows").alias("place", "r")).select("r.scope", "r.orders", (F.col("place") + 1).cast("long").alias("place"))


@query("p09_exportable", "SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal >= 0 AND o_totalprice > 1000")
def p09(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only orders without a flag are exported; an input that is switched off adds none."""
    flagged = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left").withColumns({"no_account": F.coalesce(F.col("c_acctbal") < 0, F.lit(True)), "too_small": ~(F.col("o_totalprice") > 1000)})
    off = relational.only_if(table(spark, sf_dir, "orders"), False).select("o_orderkey")
    return quality.exportable(flagged, ["no_account", "too_small"]).select("o_orderkey").unionByName(off)


@query("p12_is_distinct_from", "SELECT o_orderkey FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey AND l_linenumber = 6 WHERE l_returnflag IS DISTINCT FROM 'N'")
def p12(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").filter("l_linenumber = 6").select("l_orderkey", "l_returnflag")
    joined = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.filter(c.is_distinct_from(F.col("l_returnflag"), F.lit("N"))).select("o_orderkey")


@query("j09_pairs_in_group", "SELECT a.o_orderkey AS id_l, b.o_orderkey AS id_r FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderdate::DATE = b.o_orderdate::DATE AND a.o_orderkey < b.o_orderkey")
def j09(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.pairs_in_group(table(spark, sf_dir, "orders").withColumn("day", F.col("o_orderdate").cast("date")), "o_orderkey", ["o_custkey", "day"])


@query("j06_versioned_lookup", """WITH v AS (SELECT p_partkey AS k, 'old' AS version, DATE '1992-01-01' AS a, DATE '1996-12-31' AS b FROM part UNION ALL SELECT p_partkey, 'new', DATE '1997-01-01', NULL FROM part WHERE p_partkey % 3 <> 0)
    SELECT l_orderkey, l_linenumber, l_partkey, version FROM lineitem LEFT JOIN v ON k = l_partkey AND a <= l_shipdate::DATE AND (b IS NULL OR b >= l_shipdate::DATE)""")
def j06(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = lambda s: F.lit(s).cast("date")
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"))
    old = parts.withColumns({"version": F.lit("old"), "valid_from": day("1992-01-01"), "valid_to": day("1996-12-31")})
    new = parts.filter("l_partkey % 3 <> 0").withColumns({"version": F.lit("new"), "valid_from": day("1997-01-01"), "valid_to": F.lit(None).cast("date")})
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").cast("date").alias("day"))
    return relational.versioned_lookup(lines, old.unionByName(new), "l_partkey", "day", "valid_from", "valid_to").select("l_orderkey", "l_linenumber", "l_partkey", "version")


@query("j10_orphans_of_some", "SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey <> 3)")
def j10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.orphans(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer").filter("c_nationkey <> 3"), "o_custkey", "c_custkey").select("o_orderkey")


@query("f06_dates", "SELECT o_orderkey, strftime(CASE WHEN month(o_orderdate) >= 10 THEN make_date(year(o_orderdate)::INT, 10, 1) ELSE make_date(year(o_orderdate)::INT - 1, 10, 1) END, '%Y-%m-%d') AS release, strftime(least(o_orderdate::DATE, DATE '1999-12-31'), '%Y-%m-%d') AS capped, TRY_CAST(o_orderpriority[1:1] AS INT) AS level, TRY_CAST(o_orderstatus AS INT) AS none FROM orders")
def f06(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", c.iso_date(c.release_year_start(day)).alias("release"), c.iso_date(F.least(day, F.lit("1999-12-31").cast("date"))).alias("capped"), c.typed(F.substring("o_orderpriority", 1, 1), "int").alias("level"), c.typed(F.col("o_orderstatus"), "int").alias("none")
    )


@query("f11_plain_letters", "SELECT doc_id, regexp_replace(lower(strip_accents(text)), '[^a-z]', '', 'g') AS letters FROM documents")
def f11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", c.norm_ascii(F.col("text")).alias("letters"))


@query("q13_compare_without_meta", "SELECT count(*) FILTER (WHERE o_orderkey % 10 = 0) AS missing, 0 AS extra, count(*) FILTER (WHERE o_orderkey % 7 = 0 AND o_orderkey % 10 <> 0) AS different FROM orders")
def q13_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exported orders with other `meta` and members in another order; every tenth is missing, every seventh has another total."""
    k, total, customer = F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_custkey").alias("customer")
    stamp = lambda text: F.struct(F.lit(text).alias("lastUpdated")).alias("meta")
    gold = table(spark, sf_dir, "orders").select(k, F.to_json(F.struct(stamp("then"), customer, total.alias("total"))).alias("body"))
    sent = table(spark, sf_dir, "orders").filter(k % 10 != 0).select(k, F.to_json(F.struct(F.when(k % 7 == 0, total + 1).otherwise(total).alias("total"), stamp("now"), customer)).alias("body"))
    return quality.compare_sets(gold, sent, "o_orderkey", "body", ignored=["meta"])


@query("a02_rounded_average", "SELECT o_orderpriority, min(o_totalprice) AS least, max(o_totalprice) AS most, round(avg(o_totalprice), 2) AS average FROM orders GROUP BY 1")
def a02(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.min(total).alias("least"), F.max(total).alias("most"), F.round(F.avg(total), 2).alias("average"))


@query("w03_nulls_first", "SELECT user_id, event_id, CASE WHEN event_id % 50 <> 0 THEN value END AS value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN event_id % 50 <> 0 THEN value END ASC NULLS FIRST, event_id) = 1")
def w03(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first event of each user by value, those without one before all others."""
    events = table(spark, sf_dir, "events").withColumn("value", F.when(F.col("event_id") % 50 != 0, F.col("value")))
    return relational.latest_per_key(events, ["user_id"], [F.asc_nulls_first("value"), F.asc("event_id")]).select("user_id", "event_id", "value")


@query("j19_reference_closure", """WITH e AS (SELECT c_custkey AS c, c_nationkey AS n, n_regionkey AS r, (SELECT min(x.n_nationkey) FROM nation x WHERE x.n_regionkey = nation.n_regionkey) AS back FROM customer JOIN nation ON c_nationkey = n_nationkey),
    t AS (SELECT 'c' || c AS focal, 'c' || c AS target FROM e UNION SELECT 'c' || c, 'n' || n FROM e UNION SELECT 'c' || c, 'r' || r FROM e UNION SELECT 'c' || c, 'n' || back FROM e)
    SELECT focal, target, NOT starts_with(target, 'n') OR substr(target, 2)::INT % 7 <> 0 AS found FROM t""")
def j19(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All that each customer reaches: its nation, the nation's region, the region's first nation (a cycle for some); every seventh nation is nowhere to be found."""
    name = lambda kind, c: F.concat(F.lit(kind), F.col(c).cast("string"))
    customers, nations = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    first = nations.groupBy("n_regionkey").agg(F.min("n_nationkey").alias("back"))
    edges = relational.stack(*(df.select(name(*a).alias("source"), name(*b).alias("target")) for df, a, b in ((customers, ("c", "c_custkey"), ("n", "c_nationkey")), (nations, ("n", "n_nationkey"), ("r", "n_regionkey")), (first, ("r", "n_regionkey"), ("n", "back")))))
    ids = [df.select(name(*a).alias("id")) for df, a in ((customers, ("c", "c_custkey")), (nations.filter("n_nationkey % 7 <> 0"), ("n", "n_nationkey")), (first, ("r", "n_regionkey")))]
    found, lost = relational.reference_closure(ids[0], edges, relational.stack(*ids))
    return found.withColumn("found", F.lit(True)).unionByName(lost.withColumn("found", F.lit(False)))
