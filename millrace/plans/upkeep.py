"""Registered queries of drained streams, resets, observations and snapshot files, persons, choice values and closures in documents, and dates and texts of old systems."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import columns as c
from millrace.operators import changes, identity, relational, views
from millrace.plans.registry import query
from millrace.sources import files
from millrace.sources.files import table
from millrace.sources.shared import settle, shared_folder
from millrace.streaming import capture


def _fresh(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid4().hex}"


# --- capture


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a log of their user's value: an error deletes it."""
    op = F.when(F.col("event_type") == "error", "D").otherwise("U")
    return table(spark, sf_dir, "events").select("user_id", "value", F.col("event_type").alias("kind"), F.col("event_id").alias("_seq"), F.unix_micros(F.col("ts").cast("timestamp")).alias("_lsn"), op.alias("_op"))


@query("cd06_drained_stream", """WITH s AS (SELECT user_id, arg_max(value, (ts, event_id)) AS value, arg_max(event_type, (ts, event_id)) AS e FROM events GROUP BY 1)
    SELECT user_id, value FROM s WHERE e <> 'error'""")
def cd06(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as files that a stream drains, a file or two a micro-batch, in two runs: more files come between them, and the second run takes up where the first one ended."""
    landed, folder, checkpoint = _fresh(spark, "landed"), _fresh(spark, "drained"), _fresh(spark, "drained-checkpoint")
    log = _log(spark, sf_dir).select("user_id", "value", "_seq", "_lsn", "_op")
    for half in (F.col("_seq") % 2 == 0, F.col("_seq") % 2 == 1):
        log.filter(half).coalesce(4).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 2).parquet(landed)
        capture.keep_state(stream, folder, ["user_id"], checkpoint, buckets=8).awaitTermination()
    return capture.read_state(spark, folder).filter("_op <> 'D'").select("user_id", "value")


@query("cd04_resets", """WITH m AS (SELECT quantile_disc(epoch_us(ts), 0.5) AS mark FROM events), e AS (SELECT event_type AS kind, epoch_us(ts) AS lsn, event_id FROM events)
    SELECT kind, count(*) FILTER (WHERE lsn <= mark AND event_id % 3 <> 0) = 0 OR coalesce(max(lsn) FILTER (WHERE lsn > mark AND event_id % 1009 = 0) > max(lsn) FILTER (WHERE lsn <= mark AND event_id % 3 <> 0), false) AS reset FROM e, m GROUP BY 1""")
def cd04(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each type of event, whether the state that two thirds of the log's first half leave must be rebuilt for the second half, in which some events are truncations."""
    log = settle(_log(spark, sf_dir))
    mark = log.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY _lsn)").alias("mark")).first().mark
    states = log.filter((F.col("_lsn") <= mark) & (F.col("_seq") % 3 != 0))
    later = log.filter(F.col("_lsn") > mark).withColumn("_op", F.when(F.col("_seq") % 1009 == 0, "T").otherwise(F.col("_op")))
    return changes.resets(states, later, "kind").select("kind", "reset")


@query("sc14_observations", """SELECT event_type AS slot_name, 2 * count(*) AS observations, 2 * sum(event_id * 1000)::BIGINT AS bytes, true AS stamped FROM events GROUP BY 1""")
def sc14(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations appended twice, each with the time it was made."""
    path = _fresh(spark, "observations")
    seen = table(spark, sf_dir, "events").select(F.col("event_type").alias("slot_name"), (F.col("event_id") * 1000).alias("retained_bytes"))
    for _ in range(2):
        files.record_observation(seen, path)
    stamped = F.bool_and(F.col("observed_at").isNotNull()).alias("stamped")
    return spark.read.parquet(path).groupBy("slot_name").agg(F.count(F.lit(1)).alias("observations"), F.sum("retained_bytes").alias("bytes"), stamped)


@query("sc12_snapshot_files", """WITH o AS (SELECT strftime(o_orderdate, '%Y-%m') AS run_key, o_orderpriority AS dimension, count(*)::DOUBLE AS value FROM orders GROUP BY 1, 2)
    SELECT run_key, 'orders' AS area, 'count' AS metric, dimension, CASE WHEN right(run_key, 2)::INT % 2 = 0 THEN value + 0.5 ELSE value END AS value FROM o""")
def sc12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots of monthly metrics as JSON files in two folders; those of even months come again, changed, in the second, which counts."""
    orders = table(spark, sf_dir, "orders")
    counted = orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("run_key"), F.col("o_orderpriority").alias("dimension")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    metric = lambda value: F.struct(F.lit("orders").alias("area"), F.lit("count").alias("metric"), "dimension", value.alias("value"))
    run = lambda df, value: df.groupBy("run_key").agg(F.collect_list(metric(value)).alias("metrics")).withColumn("run_at", F.to_timestamp(F.concat("run_key", F.lit("-01"))))
    paths = [_fresh(spark, "snapshots-old"), _fresh(spark, "snapshots-new")]
    run(counted, F.col("value")).write.json(paths[0])
    run(counted.filter(F.substring("run_key", 6, 2).cast("int") % 2 == 0), F.col("value") + 0.5).write.json(paths[1])
    return files.collect_runs(spark, paths, multi_line=False)[1].select("run_key", "area", "metric", "dimension", "value")


# --- people and documents


@query("i13_persons", """WITH n AS (SELECT o_orderkey AS id, o_custkey, lag(o_orderkey) OVER w AS before FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
    g AS (SELECT id, o_custkey, sum(CASE WHEN before IS NULL OR id % 11 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, id ROWS UNBOUNDED PRECEDING) AS g FROM n JOIN (SELECT o_orderkey AS id, o_orderdate FROM orders) USING (id))
    SELECT id, min(id) OVER (PARTITION BY o_custkey, g) AS person_id, count(*) OVER (PARTITION BY o_custkey, g) AS size FROM g""")
def i13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as identities: each is linked to its customer's order before it, but for every eleventh, so that persons are chains of any length and order of ids."""
    orders = table(spark, sf_dir, "orders")
    placed = relational.numbered(orders, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey", "number")
    before = placed.select("o_custkey", F.col("o_orderkey").alias("id_l"), (F.col("number") + 1).alias("number"))
    pairs = placed.filter("o_orderkey % 11 <> 0").join(before, ["o_custkey", "number"]).select("id_l", F.col("o_orderkey").alias("id_r"))
    return identity.persons(settle(pairs), orders.select(F.col("o_orderkey").alias("id"))).select("id", "person_id", F.col("size").cast("long").alias("size"))


@query("v07_choice_values", """SELECT l_orderkey::VARCHAR || '-' || l_linenumber AS id, CASE WHEN l_linenumber % 3 = 0 THEN l_quantity::DOUBLE END AS quantity, CASE WHEN l_linenumber % 3 = 1 THEN l_returnflag END AS code,
    CASE WHEN l_linenumber % 3 = 2 THEN l_linestatus = 'O' END AS open FROM lineitem""")
def v07(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as observations whose value is a quantity, a text or a truth value; each is read by its type."""
    kind = F.col("l_linenumber") % 3
    made = F.to_json(F.struct(
        F.lit("Observation").alias("resourceType"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
        F.when(kind == 0, F.struct(F.col("l_quantity").cast("double").alias("value"))).alias("valueQuantity"), F.when(kind == 1, F.col("l_returnflag")).alias("valueString"), F.when(kind == 2, F.col("l_linestatus") == "O").alias("valueBoolean"),
    ))
    value = lambda of: views.this().of_type("value", of)
    view = views.View("Observation", [views.Select([views.Col("id", views.path("id")), views.Col("quantity", value("Quantity").get("value"), "double"), views.Col("code", value("string")), views.Col("open", value("boolean"), "boolean")])])
    return views.flatten_view(table(spark, sf_dir, "lineitem").select(made.alias("resource")), view).select("id", "quantity", "code", "open")


@query("v15_closure", """WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_returnflag, l_linestatus) AS n FROM lineitem)
    SELECT l_orderkey::VARCHAR AS id, string_agg(link, '>' ORDER BY n, depth) AS links FROM (
        SELECT l_orderkey, n, 1 AS depth, l_linenumber::VARCHAR AS link FROM l UNION ALL
        SELECT l_orderkey, n, 2, l_linenumber || '.' || l_returnflag FROM l UNION ALL
        SELECT l_orderkey, n, 3, l_linenumber || '.' || l_returnflag || '.' || l_linestatus FROM l WHERE l_linenumber % 2 = 0) JOIN orders ON o_orderkey = l_orderkey GROUP BY 1""")
def v15(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questionnaires of items within items within items, from orders; all items of all depths, each before those it holds."""
    link = lambda *parts: F.concat_ws(".", *parts).alias("linkId")
    third = F.when(F.col("l_linenumber") % 2 == 0, F.array(F.struct(link("l_linenumber", "l_returnflag", "l_linestatus")))).alias("item")
    second = F.array(F.struct(link("l_linenumber", "l_returnflag"), third)).alias("item")
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(link("l_linenumber"), second))).alias("item"))
    made = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(F.to_json(F.struct(F.lit("Questionnaire").alias("resourceType"), F.col("o_orderkey").cast("string").alias("id"), "item")).alias("resource"))
    view = views.View("Questionnaire", [views.Select([views.Col("id", views.path("id")), views.Col("links", views.this().repeat("item").get("linkId").join(">"))])])
    return views.flatten_view(made, view).select("id", "links")


# --- dates and texts of old systems


@query("p06_open_ends", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_orderkey % 5 <> 0 THEN o_orderdate::DATE END AS ends, o_orderstatus <> 'F' OR o_orderkey % 5 = 0 OR o_orderdate::DATE >= DATE '1998-01-01' AS in_force FROM orders""")
def p06(spark: SparkSession, sf_dir: str) -> DataFrame:
    """End dates as text: open ones are written 99991231, some are empty or no date at all."""
    written = F.when(F.col("o_orderstatus") != "F", "99991231").when(F.col("o_orderkey") % 10 == 0, "").when(F.col("o_orderkey") % 5 == 0, "20240230").otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    ends = table(spark, sf_dir, "orders").select("o_orderkey", c.open_ended(written).alias("ends"))
    return ends.withColumn("in_force", c.in_force(F.lit("1990-01-01").cast("date"), F.col("ends"), F.lit("1998-01-01").cast("date")))


@query("f02_strict_dates", "SELECT o_orderdate::DATE AS day, count(*) AS orders FROM orders GROUP BY 1")
def f02(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = F.date_format("o_orderdate", "MM/dd/yyyy")
    return table(spark, sf_dir, "orders").groupBy(c.parse_date(written, "MM/dd/yyyy", strict=True).alias("day")).agg(F.count(F.lit(1)).alias("orders"))


@query("f23_padding", "SELECT p_partkey, p_brand AS fixed, p_brand || '  ' AS varying FROM part")
def f23(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns declared CHAR(n) lose the blanks they are filled with, others keep theirs."""
    padded = F.concat("p_brand", F.lit("  "))
    return table(spark, sf_dir, "part").select("p_partkey", c.strip_char_padding(padded, "CHAR(12)").alias("fixed"), c.strip_char_padding(padded, "VARCHAR(12)").alias("varying"))


@query("p14_hash_buckets", "SELECT count(*) AS rows, count(DISTINCT l_orderkey) AS keys, 0::BIGINT AS split_keys, 8::BIGINT AS buckets, true AS even FROM lineitem")
def p14(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines taken bucket by bucket: together they are all lines, no order is in two buckets, and none of the eight has over twice its share of the orders."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey")
    taken = relational.stack(*(lines.filter(c.hash_bucket(F.col("l_orderkey"), 8) == b).withColumn("bucket", F.lit(b)) for b in range(8)))
    keys = taken.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("rows"), F.min("bucket").alias("bucket"), F.max("bucket").alias("last"))
    each = keys.groupBy("bucket").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("keys"), F.count_if(F.col("bucket") != F.col("last")).alias("split_keys"))
    return each.agg(F.sum("rows").alias("rows"), F.sum("keys").alias("keys"), F.sum("split_keys").alias("split_keys"), F.count(F.lit(1)).alias("buckets"), (F.max("keys") <= F.sum("keys") / 4).alias("even"))
