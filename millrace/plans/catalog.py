"""Registered queries over the driver's tables. Each has a Spark form built from the operators and, where SQL can say it, an
equivalent for DuckDB under the same name."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import columns as c
from millrace.functions.sketches import sketches
from millrace.operators import changes, identity, quality, relational, resources, views
from millrace.plans.registry import QUERIES, SQL, query
from millrace.sources.files import table
from millrace.sources.shared import settle, shared_folder
from millrace.streaming import capture

AS_OF = "2001-09-28"
LATE_DAYS = 60


# --- claim roll-up with integrity flags (the flagship), dimensions and facts

_SPANS_SQL = """
    SELECT l_suppkey, min(l_shipdate)::DATE + 30 AS valid_from,
           CASE WHEN year(l_shipdate) < (SELECT max(year(l_shipdate)) FROM lineitem) THEN max(l_shipdate)::DATE - 30 END AS valid_to, year(l_shipdate) AS span_year
    FROM lineitem GROUP BY l_suppkey, year(l_shipdate)"""


def _spans(lines: DataFrame) -> DataFrame:
    """One span per supplier and year, from 30 days after its first shipment to 30 before its last; the last year is open."""
    last = lines.agg(F.max(F.year("l_shipdate")).alias("last_year"))
    by_year = lines.groupBy("l_suppkey", F.year("l_shipdate").alias("span_year")).agg(F.min("l_shipdate").alias("lo"), F.max("l_shipdate").alias("hi"))
    return by_year.crossJoin(F.broadcast(last)).select(
        "l_suppkey", F.date_add("lo", 30).alias("valid_from"), F.when(F.col("span_year") < F.col("last_year"), F.date_sub("hi", 30)).alias("valid_to"), "span_year"
    )


@query(
    "fct_claims",
    f"""
    WITH lines AS (
        SELECT l_orderkey, count(*) AS line_count, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS line_total, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship,
               count(*) FILTER (WHERE l_returnflag = 'R') AS returned_lines
        FROM lineitem GROUP BY 1)
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_date,
           CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' WHEN 'P' THEN 'partial' END AS status,
           coalesce(line_count, 0) AS line_count, line_total, coalesce(returned_lines, 0) AS returned_lines,
           c_custkey IS NOT NULL AS has_customer, line_total > o_totalprice AS lines_exceed_total,
           date_diff('day', o_orderdate, last_ship) AS days_to_ship,
           CASE WHEN last_ship IS NOT NULL THEN date_diff('day', o_orderdate, last_ship) <= {LATE_DAYS} END AS shipped_in_time
    FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey LEFT JOIN customer ON o_custkey = c_custkey""",
)
def fct_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines, customer = (table(spark, sf_dir, t) for t in ("orders", "lineitem", "customer"))
    totals = lines.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("line_count"), c.exact_sum(F.col("l_extendedprice")).alias("line_total"), F.max("l_shipdate").alias("last_ship"), F.count_if(F.col("l_returnflag") == "R").alias("returned_lines")
    )
    days = F.datediff("last_ship", "o_orderdate")
    return (
        orders.join(totals, orders.o_orderkey == totals.l_orderkey, "left")
        .join(customer.select("c_custkey"), F.col("o_custkey") == F.col("c_custkey"), "left")
        .select(
            "o_orderkey", c.iso_date(F.col("o_orderdate")).alias("order_date"), c.decode(F.col("o_orderstatus"), {"F": "finished", "O": "open", "P": "partial"}).alias("status"),
            F.coalesce("line_count", F.lit(0)).alias("line_count"), "line_total", F.coalesce("returned_lines", F.lit(0)).alias("returned_lines"), F.col("c_custkey").isNotNull().alias("has_customer"),
            (F.col("line_total") > F.col("o_totalprice")).alias("lines_exceed_total"), days.cast("long").alias("days_to_ship"), F.when(F.col("last_ship").isNotNull(), days <= LATE_DAYS).alias("shipped_in_time"),
        )
    )


@query(
    "fct_member_months",
    """
    WITH spans AS (SELECT l_orderkey, date_trunc('month', min(l_shipdate)) AS a, date_trunc('month', max(l_shipdate)) AS b FROM lineitem GROUP BY 1),
    months AS (SELECT l_orderkey, unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS m FROM spans)
    SELECT strftime(m, '%Y-%m') AS month, count(*) AS orders FROM months GROUP BY 1""",
)
def fct_member_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("a"), F.max("l_shipdate").alias("b"))
    return relational.expand_months(spans, "a", "b", "m").groupBy(F.date_format("m", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("orders"))


# --- projections, filters, predicates


@query(
    "p02_decode_otherwise",
    """SELECT CASE upper(trim(c_mktsegment)) WHEN 'BUILDING' THEN 'construction' WHEN 'MACHINERY' THEN 'industry' ELSE 'invalid' END AS segment, count(*) AS customers FROM customer GROUP BY 1""",
)
def p02(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = c.decode(F.upper(F.trim("c_mktsegment")), {"BUILDING": "construction", "MACHINERY": "industry"}, "invalid")
    return table(spark, sf_dir, "customer").groupBy(label.alias("segment")).agg(F.count(F.lit(1)).alias("customers"))


@query(
    "p03_classify_like",
    """SELECT CASE WHEN p_name ILIKE '%RING' THEN 'ring' WHEN p_name ILIKE 'red%' THEN 'red' END AS kind, count(*) AS parts FROM part GROUP BY 1""",
)
def p03(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = c.classify_like(F.col("p_name"), [("%RING", "ring"), ("red%", "red")], ignore_case=True)
    return table(spark, sf_dir, "part").groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("parts"))


@query(
    "p10_in_force",
    f"""WITH spans AS ({_SPANS_SQL}) SELECT l_suppkey, valid_to IS NULL AS open_ended FROM spans WHERE valid_from <= DATE '{AS_OF}' AND (valid_to IS NULL OR valid_to >= DATE '{AS_OF}')""",
)
def p10(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = _spans(table(spark, sf_dir, "lineitem"))
    return spans.filter(c.in_force(F.col("valid_from"), F.col("valid_to"), F.lit(AS_OF).cast("date"))).select("l_suppkey", F.col("valid_to").isNull().alias("open_ended"))


@query("p11_lookback", f"""SELECT o_orderkey FROM orders WHERE o_orderdate::DATE BETWEEN DATE '{AS_OF}' - INTERVAL 24 MONTH AND DATE '{AS_OF}'""")
def p11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").filter(c.within_lookback(F.col("o_orderdate").cast("date"), F.lit(AS_OF).cast("date"), 24)).select("o_orderkey")


@query(
    "p13_status_reason",
    """SELECT CASE WHEN l_quantity > 45 THEN 'pend' WHEN l_discount >= 0.09 THEN 'pend' WHEN l_returnflag = 'R' THEN 'deny' ELSE 'approve' END AS status,
              CASE WHEN l_quantity > 45 THEN 'quantity' WHEN l_discount >= 0.09 THEN 'discount' WHEN l_returnflag = 'R' THEN 'returned' ELSE 'none' END AS reason, count(*) AS lines
       FROM lineitem GROUP BY 1, 2""",
)
def p13(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = [(F.col("l_quantity") > 45, "pend", "quantity"), (F.col("l_discount") >= 0.09, "pend", "discount"), (F.col("l_returnflag") == "R", "deny", "returned"), (F.lit(True), "approve", "none")]
    status, reason = c.status_and_reason(cases)
    return table(spark, sf_dir, "lineitem").groupBy(status.alias("status"), reason.alias("reason")).agg(F.count(F.lit(1)).alias("lines"))


# --- joins


@query(
    "j03_composite_key",
    """SELECT a.l_orderkey, a.l_linenumber, b.versions FROM lineitem a JOIN (SELECT l_orderkey, l_linenumber, count(*) AS versions FROM lineitem GROUP BY 1, 2) b USING (l_orderkey, l_linenumber) WHERE l_quantity >= 49""",
)
def j03(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    return lines.filter("l_quantity >= 49").select(*keys).join(lines.groupBy(*keys).agg(F.count(F.lit(1)).alias("versions")), keys)


@query(
    "j03_composite_key_all",
    """SELECT a.l_orderkey, a.l_linenumber, b.versions FROM lineitem a JOIN (SELECT l_orderkey, l_linenumber, count(*) AS versions FROM lineitem GROUP BY 1, 2) b USING (l_orderkey, l_linenumber)""",
)
def j03_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    return lines.select(*keys).join(lines.groupBy(*keys).agg(F.count(F.lit(1)).alias("versions")), keys)


@query(
    "j04_interval_join",
    f"""WITH spans AS ({_SPANS_SQL}), e AS (SELECT DISTINCT l_suppkey, l_shipdate::DATE AS d FROM lineitem)
        SELECT e.l_suppkey, strftime(d, '%Y-%m-%d') AS ship_date, min(span_year) AS span_year
        FROM e LEFT JOIN spans s ON e.l_suppkey = s.l_suppkey AND valid_from <= d AND (valid_to IS NULL OR valid_to >= d) GROUP BY 1, 2""",
)
def j04(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    events = lines.select("l_suppkey", F.col("l_shipdate").cast("date").alias("d")).distinct()
    found = relational.interval_join(events, _spans(lines), "l_suppkey", "d", "valid_from", "valid_to", "min", value="span_year")
    return found.select("l_suppkey", c.iso_date(F.col("d")).alias("ship_date"), F.col("span_year").cast("long").alias("span_year"))


@query(
    "j05_interval_latest",
    f"""WITH spans AS ({_SPANS_SQL})
        SELECT l_orderkey, l_linenumber, l.l_suppkey, span_year FROM lineitem l LEFT JOIN spans s ON l.l_suppkey = s.l_suppkey AND valid_from <= l_shipdate::DATE AND (valid_to IS NULL OR valid_to >= l_shipdate::DATE)
        WHERE l_quantity >= 45
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l.l_suppkey, l_shipdate, l_partkey, l_extendedprice ORDER BY valid_from DESC NULLS LAST, span_year NULLS LAST) = 1""",
)
def j05(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    ids = ["l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_partkey", "l_extendedprice"]
    events = lines.filter("l_quantity >= 45").select(*ids, F.col("l_shipdate").cast("date").alias("d"))
    found = relational.interval_join(events, _spans(lines), "l_suppkey", "d", "valid_from", "valid_to", "latest", id_cols=ids, value="span_year")
    return found.select("l_orderkey", "l_linenumber", "l_suppkey", F.col("span_year").cast("long").alias("span_year"))


@query(
    "j05_interval_latest_all",
    f"""WITH spans AS ({_SPANS_SQL})
        SELECT l_orderkey, l_linenumber, l.l_suppkey, span_year FROM lineitem l LEFT JOIN spans s ON l.l_suppkey = s.l_suppkey AND valid_from <= l_shipdate::DATE AND (valid_to IS NULL OR valid_to >= l_shipdate::DATE)
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l.l_suppkey, l_shipdate, l_partkey, l_extendedprice ORDER BY valid_from DESC NULLS LAST, span_year NULLS LAST) = 1""",
)
def j05_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    ids = ["l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_partkey", "l_extendedprice"]
    found = relational.interval_join(lines.select(*ids, F.col("l_shipdate").cast("date").alias("d")), _spans(lines), "l_suppkey", "d", "valid_from", "valid_to", "latest", id_cols=ids, value="span_year")
    return found.select("l_orderkey", "l_linenumber", "l_suppkey", F.col("span_year").cast("long").alias("span_year"))


@query(
    "j07_bounds",
    """SELECT o_orderpriority, count(*) AS recent FROM orders, (SELECT max(o_orderdate) AS m FROM orders) WHERE o_orderdate >= m - INTERVAL 365 DAY GROUP BY 1""",
)
def j07(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    last = F.broadcast(orders.agg(F.max("o_orderdate").alias("m")))
    return orders.crossJoin(last).filter(F.col("o_orderdate") >= F.col("m") - F.expr("interval 365 days")).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("recent"))


@query(
    "j13_blocking",
    """WITH a AS (SELECT p_partkey AS id, p_brand, p_size, p_name, p_type FROM part),
       r0 AS (SELECT x.id AS id_l, y.id AS id_r FROM a x JOIN a y ON x.p_brand = y.p_brand AND x.p_size = y.p_size AND x.id < y.id),
       r1 AS (SELECT x.id AS id_l, y.id AS id_r FROM a x JOIN a y ON x.p_name = y.p_name AND x.p_size = y.p_size AND x.id < y.id WHERE NOT (x.p_brand = y.p_brand AND x.p_size = y.p_size))
       SELECT id_l, id_r, 0 AS rule FROM r0 UNION ALL SELECT id_l, id_r, 1 FROM r1""",
)
def j13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.candidate_pairs(table(spark, sf_dir, "part"), "p_partkey", [["p_brand", "p_size"], ["p_name", "p_size"]])


@query(
    "i18_blocking_report",
    """WITH a AS (SELECT c_custkey AS id, c_nationkey, c_mktsegment FROM customer), n AS (SELECT count(*) AS n FROM customer),
       m AS (SELECT count(*) AS marginal FROM a x JOIN a y ON x.c_nationkey = y.c_nationkey AND x.c_mktsegment = y.c_mktsegment AND x.id < y.id)
       SELECT 0 AS rule, marginal, marginal AS cumulative, (n * (n - 1) // 2)::BIGINT AS possible FROM m, n""",
)
def i18(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.blocking_report(table(spark, sf_dir, "customer"), "c_custkey", [["c_nationkey", "c_mktsegment"]])


@query("j10_anti", """SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""")
def j10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.orphans(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders"), "c_custkey", "o_custkey").select("c_custkey")


@query(
    "j15_roles",
    """SELECT s_suppkey, c_custkey, sn.n_name AS supplier_nation, cn.n_name AS customer_nation FROM supplier JOIN customer ON s_suppkey = c_custkey
       LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey""",
)
def j15(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "customer"), F.col("s_suppkey") == F.col("c_custkey"))
    named = relational.lookup_roles(both, table(spark, sf_dir, "nation"), "n_nationkey", {"s_": "s_nationkey", "c_": "c_nationkey"})
    return named.select("s_suppkey", "c_custkey", F.col("s_n_name").alias("supplier_nation"), F.col("c_n_name").alias("customer_nation"))


@query(
    "j17_components",
    """WITH RECURSIVE e AS (SELECT DISTINCT o_custkey AS a, (l_suppkey + 1000000000) AS b FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_quantity = 50 AND l_discount = 0.1 AND l_tax = 0.0),
       sym AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
       reach AS (SELECT a AS node, a AS r FROM sym UNION SELECT reach.node, sym.b FROM reach JOIN sym ON reach.r = sym.a),
       comp AS (SELECT node, min(r) AS component FROM reach GROUP BY 1)
       SELECT node, component, count(*) OVER (PARTITION BY component) AS size FROM comp""",
)
def j17(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").filter("l_quantity = 50 AND l_discount = 0.1 AND l_tax = 0.0")
    edges = lines.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").alias("a"), (F.col("l_suppkey") + 1000000000).alias("b"))
    return relational.connected_components(edges)


@query("j17_components_all")
def j17_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole graph of customers and suppliers; recursive SQL would be too slow on it."""
    lines = table(spark, sf_dir, "lineitem")
    edges = lines.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").alias("a"), (F.col("l_suppkey") + 1000000000).alias("b"))
    return relational.connected_components(edges)


# --- aggregates


@query(
    "a03_filtered",
    """SELECT event_type, count(*) AS n, count(*) FILTER (WHERE value > 20) AS large, round(100.0 * count(*) FILTER (WHERE value > 20) / count(*), 1) AS large_pct,
              sum(value::DECIMAL(18,2)) FILTER (WHERE value > 20)::DOUBLE AS large_sum FROM events GROUP BY 1""",
)
def a03(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = F.col("value") > 20
    return table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(large).alias("large"), c.rate_pct(large).alias("large_pct"), c.exact_sum(F.when(large, F.col("value"))).alias("large_sum")
    )


@query("j04_interval_all", f"""WITH spans AS ({_SPANS_SQL}) SELECT l_orderkey, l_linenumber, l.l_suppkey, span_year::BIGINT AS span_year FROM lineitem l LEFT JOIN spans s ON l.l_suppkey = s.l_suppkey AND valid_from <= l_shipdate::DATE AND (valid_to IS NULL OR valid_to >= l_shipdate::DATE)""")
def j04_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line with every span of its supplier that holds on its day; repeated lines stay."""
    lines = table(spark, sf_dir, "lineitem")
    found = relational.interval_join(lines.select("l_orderkey", "l_linenumber", "l_suppkey", F.col("l_shipdate").cast("date").alias("d")), _spans(lines), "l_suppkey", "d", "valid_from", "valid_to")
    return found.select("l_orderkey", "l_linenumber", "l_suppkey", F.col("span_year").cast("long").alias("span_year"))


@query("i18_blocking_rules", """WITH r AS (SELECT CASE WHEN a.p_brand = b.p_brand AND a.p_size = b.p_size THEN 0 WHEN a.p_type = b.p_type AND a.p_size = b.p_size THEN 1 ELSE 2 END AS rule
        FROM part a JOIN part b ON a.p_partkey < b.p_partkey AND (a.p_size = b.p_size AND (a.p_brand = b.p_brand OR a.p_type = b.p_type) OR a.p_brand = b.p_brand AND a.p_type = b.p_type)),
        c AS (SELECT k.range AS rule, count(r.rule) AS marginal FROM range(3) k LEFT JOIN r ON r.rule = k.range GROUP BY 1)
    SELECT rule::INT AS rule, marginal, sum(marginal) OVER (ORDER BY rule)::BIGINT AS cumulative, (SELECT count(*) * (count(*) - 1) // 2 FROM part)::BIGINT AS possible FROM c""")
def i18_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs that each of three rules adds, counted by inclusion and exclusion."""
    return relational.blocking_report(table(spark, sf_dir, "part"), "p_partkey", [["p_brand", "p_size"], ["p_type", "p_size"], ["p_brand", "p_type"]])


@query("w04_gaps_by_type", """SELECT event_id, (epoch_ms(ts) - epoch_ms(lag(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id))) / 1000 AS gap_s FROM (SELECT * REPLACE (date_trunc('millisecond', ts) AS ts) FROM events)""")
def w04_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps within a few event types, each of which holds many events: in ranges."""
    return relational.gap_seconds(table(spark, sf_dir, "events").withColumn("ts", F.date_trunc("millisecond", F.col("ts").cast("timestamp"))), "event_type", "ts", "event_id", group_rows=1000).select("event_id", "gap_s")


@query("w06_sequence_by_type", """SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id)::INT AS number, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id) = 1 AS is_first FROM events""")
def w06_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places within a few event types, latest first: in ranges."""
    return relational.numbered(table(spark, sf_dir, "events"), ["event_type"], [F.desc("ts"), F.asc("event_id")], group_rows=1000).select("event_id", "number", "is_first")


@query("a04_quantiles", """SELECT event_type, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95 FROM events GROUP BY 1""")
def a04(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = relational.quantiles(table(spark, sf_dir, "events"), ["event_type"], "value", {"p50": 0.5, "p95": 0.95})
    return found.select("event_type", F.round("p50", 6).alias("p50"), F.round("p95", 6).alias("p95"))


@query("a05_unique_or_ambiguous", """SELECT l_orderkey, count(DISTINCT l_suppkey) AS candidates, CASE WHEN count(DISTINCT l_suppkey) = 1 THEN min(l_suppkey) END AS l_suppkey FROM lineitem GROUP BY 1""")
def a05(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.unique_or_ambiguous(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_suppkey")


@query("a06_claimed_by_many", """SELECT l_partkey, count(DISTINCT l_suppkey) AS owners FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 1""")
def a06(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.claimed_by_many(table(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey")


@query("a07_duplicates", """SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def a07(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "a08_ordered_list",
    """SELECT user_id, string_agg(event_type, '>' ORDER BY ts, event_id) AS path, string_agg(event_id::VARCHAR, ',' ORDER BY event_id) FILTER (WHERE event_type = 'error') AS errors FROM events GROUP BY 1""",
)
def a08(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.struct("ts", "event_id")
    errors = c.ordered_list(F.col("event_id").cast("string"), F.col("event_id"), F.col("event_type") == "error")
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.array_join(c.ordered_list(F.col("event_type"), at), ">").alias("path"), F.when(F.size(errors) > 0, F.array_join(errors, ",")).alias("errors"))


@query(
    "a12_pivot",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, max(value) FILTER (WHERE event_type = 'click') AS click, max(value) FILTER (WHERE event_type = 'purchase') AS purchase FROM events GROUP BY 1""",
)
def a12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.pivot_metrics(table(spark, sf_dir, "events").withColumn("day", c.iso_date(F.col("ts"))), "day", "event_type", "value", ["click", "purchase"])


@query(
    "a13_scopes",
    """WITH s AS (SELECT 'all' AS scope, l_quantity AS q, l_discount AS d FROM lineitem UNION ALL SELECT 'flag ' || l_returnflag, l_quantity, l_discount FROM lineitem UNION ALL SELECT 'status ' || l_linestatus, l_quantity, l_discount FROM lineitem)
       SELECT scope, count(*) AS n, round(count(*) FILTER (WHERE q > 25 AND d > 0.05) / count(*) FILTER (WHERE q > 25), 4) AS precision, round(count(*) FILTER (WHERE q > 25 AND d > 0.05) / count(*) FILTER (WHERE d > 0.05), 4) AS recall FROM s GROUP BY 1""",
)
def a13(spark: SparkSession, sf_dir: str) -> DataFrame:
    scopes = F.array(F.lit("all"), F.concat(F.lit("flag "), "l_returnflag"), F.concat(F.lit("status "), "l_linestatus"))
    predicted, actual = F.col("l_quantity") > 25, F.col("l_discount") > 0.05
    precision, recall = c.precision_recall(F.count_if(predicted & actual), F.count_if(predicted), F.count_if(actual))
    return relational.scoped_agg(table(spark, sf_dir, "lineitem"), scopes, [F.count(F.lit(1)).alias("n"), precision.alias("precision"), recall.alias("recall")])


@query(
    "a16_scorecard",
    """SELECT 'high_quantity' AS "check", count(*) FILTER (WHERE l_quantity > 49) AS issues, count(*) AS population FROM lineitem
       UNION ALL SELECT 'untaxed_return', count(*) FILTER (WHERE l_tax = 0 AND l_returnflag = 'R'), count(*) FILTER (WHERE l_returnflag = 'R') FROM lineitem""",
)
def a16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.issue_scorecard(table(spark, sf_dir, "lineitem"), {"high_quantity": (F.col("l_quantity") > 49, F.lit(True)), "untaxed_return": (F.col("l_tax") == 0, F.col("l_returnflag") == "R")})


@query("a19_totals", """SELECT coalesce(c_mktsegment, 'all') AS segment, count(*) AS customers, sum(c_acctbal::DECIMAL(18,2))::DOUBLE AS balance FROM customer GROUP BY ROLLUP (c_mktsegment)""")
def a19(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = table(spark, sf_dir, "customer").rollup("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"), c.exact_sum(F.col("c_acctbal")).alias("balance"))
    return totals.select(F.coalesce("c_mktsegment", F.lit("all")).alias("segment"), "customers", "balance")


@query("a20_occurrences", """SELECT p_brand, count(DISTINCT l_orderkey) AS orders, count(*) AS occurrences, strftime(min(l_shipdate), '%Y-%m-%d') AS first_at, strftime(max(l_shipdate), '%Y-%m-%d') AS last_at FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def a20(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return joined.groupBy("p_brand").agg(F.countDistinct("l_orderkey").alias("orders"), F.count(F.lit(1)).alias("occurrences"), c.iso_date(F.min("l_shipdate")).alias("first_at"), c.iso_date(F.max("l_shipdate")).alias("last_at"))


# --- windows, samples, sets


@query("w02_dedupe_count", """SELECT user_id, event_id, event_type, count(*) OVER (PARTITION BY user_id) AS versions FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def w02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.dedupe_with_count(table(spark, sf_dir, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id", "event_type", "versions")


@query("w04_gaps", """SELECT event_id, user_id, date_diff('millisecond', lag(ts) OVER w, ts) / 1000 AS gap_s FROM (SELECT event_id, user_id, date_trunc('millisecond', ts) AS ts FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def w04(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("ts", F.date_trunc("millisecond", "ts"))
    return relational.gap_seconds(events, "user_id", "ts", "event_id").select("event_id", "user_id", "gap_s")


@query(
    "w09_best_second",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, lead(l_linenumber) OVER w AS second_l_linenumber, lead(l_extendedprice) OVER w AS second_l_extendedprice
       FROM (SELECT l_orderkey, l_linenumber, max(l_extendedprice) AS l_extendedprice FROM lineitem GROUP BY 1, 2) WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) QUALIFY row_number() OVER w = 1""",
)
def w09(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_extendedprice").alias("l_extendedprice"))
    return relational.best_and_second(lines, "l_orderkey", "l_extendedprice", "l_linenumber")


@query("t02_stable_sample", """SELECT doc_id, lang FROM documents ORDER BY md5('42' || doc_id::VARCHAR), doc_id LIMIT 50""")
def t02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.stable_sample(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", 50)


@query("t04_top_counts", """SELECT p_brand, p_type, count(*) AS rows FROM part GROUP BY 1, 2 ORDER BY rows DESC, p_brand, p_type LIMIT 20""")
def t04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.top_counts(table(spark, sf_dir, "part"), ["p_brand", "p_type"], 20)


@query(
    "u02_bag_difference",
    """WITH a AS (SELECT l_returnflag AS f, l_linestatus AS s, l_linenumber AS n FROM lineitem WHERE l_quantity < 30), b AS (SELECT l_returnflag AS f, l_linestatus AS s, l_linenumber AS n FROM lineitem WHERE l_quantity > 20)
       SELECT (SELECT count(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) AS only_a, (SELECT count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) AS only_b""",
)
def u02(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    pick = [F.col("l_returnflag").alias("f"), F.col("l_linestatus").alias("s"), F.col("l_linenumber").alias("n")]
    return relational.bag_difference(lines.filter("l_quantity < 30").select(*pick), lines.filter("l_quantity > 20").select(*pick))


# --- scalar functions


@query(
    "f_scalars",
    """SELECT s_suppkey, nullif(regexp_replace(upper(s_name), '[^A-Z]', '', 'g'), '') AS name, nullif(left(regexp_replace(s_name, '[^0-9]', '', 'g'), 5), '') AS zip,
              lpad(s_suppkey::VARCHAR, 5, '0') || lpad(s_nationkey::VARCHAR, 4, '0') || '07' AS ndc, round(s_acctbal * 1000 / 1048576, 2) AS mib,
              replace(replace(replace('<' || s_name || '&>', '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS html,
              try_strptime((19990000 + s_suppkey)::VARCHAR, '%Y%m%d') IS NOT NULL AS is_date
       FROM supplier""",
)
def f_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, key = F.col("s_name"), F.col("s_suppkey").cast("string")
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey", c.norm_name(name).alias("name"), c.norm_zip(name).alias("zip"), c.ndc11(F.concat_ws("-", key, F.col("s_nationkey").cast("string"), F.lit("7"))).alias("ndc"), c.mib(F.col("s_acctbal") * 1000).alias("mib"),
        c.narrative(F.concat(F.lit("<"), name, F.lit("&>"))).alias("html"), c.parse_date((F.lit(19990000) + F.col("s_suppkey")).cast("string")).isNotNull().alias("is_date"),
    )


@query(
    "f13_luhn",
    """WITH d AS (SELECT s_suppkey, '80840' || (1000000000 + s_suppkey * 7919)::VARCHAR AS n FROM supplier),
       v AS (SELECT s_suppkey, i, (n[i])::INT * (CASE WHEN (15 - i) % 2 = 1 THEN 2 ELSE 1 END) AS x FROM d, range(1, 16) t(i))
       SELECT s_suppkey, sum(CASE WHEN x > 9 THEN x - 9 ELSE x END) % 10 = 0 AS valid FROM v GROUP BY 1""",
)
def f13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select("s_suppkey", c.luhn_valid((F.lit(1000000000) + F.col("s_suppkey") * 7919).cast("string")).alias("valid"))


@query("f18_json", """SELECT event_id, (props->>'$.k')::INT AS k, json_exists(props, '$.k') AS has_k, json_exists(props, '$.z') AS has_z FROM events""")
def f18(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.col("props")
    return table(spark, sf_dir, "events").select("event_id", c.json_text(props, "$.k").cast("int").alias("k"), c.json_exists(props, "$.k").alias("has_k"), c.json_exists(props, "$.z").alias("has_z"))


@query("f05_elapsed", """SELECT event_id, round((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 3.6e9, 6) AS hours, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 3.6e9 <= 72 AS in_time FROM events""")
def f05(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = c.elapsed_hours(F.lit("2024-01-01 00:00:00").cast("timestamp"), F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select("event_id", F.round(hours, 6).alias("hours"), (hours <= 72).alias("in_time"))


# --- change capture

_CHANGES_SQL = """
    SELECT user_id, value, event_id AS _seq, epoch_us(ts) AS _lsn,
           CASE WHEN event_id = (SELECT min(event_id) FROM events WHERE event_type = 'signup' AND event_id >= 1000) THEN 'T' WHEN event_type = 'error' THEN 'D' ELSE 'U' END AS _op
    FROM events"""
_CURRENT_SQL = f"""
    WITH ch AS ({_CHANGES_SQL}), cut AS (SELECT max((_lsn, _seq)) AS c FROM ch WHERE _op = 'T'),
    live AS (SELECT ch.* FROM ch, cut WHERE _op <> 'T' AND (c IS NULL OR (_lsn, _seq) > c))
    SELECT user_id, value, _lsn, _seq, _op FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY _lsn DESC, _seq DESC) AS n FROM live) WHERE n = 1 AND _op <> 'D'"""


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as a change log: error deletes, and the first sign-up from event 1000 on truncates."""
    events = table(spark, sf_dir, "events")
    first = events.filter("event_type = 'signup' AND event_id >= 1000").agg(F.min("event_id").alias("cut_id"))
    op = F.when(F.col("event_id") == F.col("cut_id"), "T").when(F.col("event_type") == "error", "D").otherwise("U")
    return events.crossJoin(F.broadcast(first)).select("user_id", "value", F.col("event_id").alias("_seq"), F.unix_micros(F.col("ts").cast("timestamp")).alias("_lsn"), op.alias("_op"))


@query("cd01_current_state", _CURRENT_SQL)
def cd01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.current_state(_changes(spark, sf_dir), ["user_id"]).select("user_id", "value", "_lsn", "_seq", "_op")


@query("cd03_incremental_state", _CURRENT_SQL)
def cd03(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same state, from a state at half the log (rows deleted by then kept as tombstones) advanced by what came after, with truncations where they come."""
    log = _changes(spark, sf_dir)
    half = log.agg(F.percentile_approx("_lsn", 0.5).alias("h")).first().h or 0
    state = changes.advance_state(None, log.filter(F.col("_lsn") <= half), ["user_id"])
    merged = changes.advance_state(state, log.filter(F.col("_lsn") > half), ["user_id"])
    return merged.filter("_op <> 'D'").select("user_id", "value", "_lsn", "_seq", "_op")


@query("cd05_bucketed_state", _CURRENT_SQL)
def cd05(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same state kept in buckets over four batches of the log, the second of which comes twice."""
    log = _changes(spark, sf_dir)
    marks = log.agg(F.percentile_approx("_lsn", [0.25, 0.5, 0.75])).first()[0] or [0, 0, 0]
    folder = f"{shared_folder(spark)}/state-{uuid4().hex}"
    parts = [log.filter((F.col("_lsn") > a) & (F.col("_lsn") <= b)) for a, b in zip([-1, *marks], [*marks, 2**62])]
    for k, batch in enumerate([*parts[:2], parts[1], *parts[2:]]):
        capture.advance(batch, k, folder, ["user_id"], 16)
    return capture.read_state(spark, folder).filter("_op <> 'D'").select("user_id", "value", "_lsn", "_seq", "_op")


@query("cd08_operation_latency", """WITH e AS (SELECT * REPLACE (date_trunc('millisecond', ts) AS ts) FROM events), d AS (SELECT *, CASE WHEN event_id % 3 = 0 THEN 'I' WHEN event_id % 3 = 1 THEN 'U' ELSE 'D' END AS op, epoch_ms(date_trunc('day', ts) + INTERVAL 1 DAY) / 1000 - epoch_ms(ts) / 1000 AS d FROM e)
    SELECT event_type, count(*) AS changes, round(quantile_cont(d, 0.5), 6) AS p50_s, round(quantile_cont(d, 0.95), 6) AS p95_s, round(max(d), 6) AS max_s, count(*) FILTER (WHERE op = 'I') AS op_I, count(*) FILTER (WHERE op = 'U') AS op_U, count(*) FILTER (WHERE op = 'D') AS op_D FROM d GROUP BY 1""")
def cd08_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delay of events to the end of their day, and how many there are of each operation."""
    k = F.col("event_id") % 3
    events = table(spark, sf_dir, "events").withColumn("op", F.when(k == 0, "I").when(k == 1, "U").otherwise("D")).withColumn("ts", F.date_trunc("millisecond", F.col("ts").cast("timestamp")))
    found = changes.operation_latency(events.withColumn("landed", F.date_trunc("day", "ts") + F.expr("interval 1 day")), "event_type", "op", "ts", "landed", ("I", "U", "D"))
    return found.select("event_type", "changes", *(F.round(c, 6).alias(c) for c in ("p50_s", "p95_s", "max_s")), "op_I", "op_U", "op_D")


@query("cd08_latency", """WITH d AS (SELECT event_type, date_diff('millisecond', lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), ts) / 1000 AS d FROM (SELECT *  REPLACE (date_trunc('millisecond', ts) AS ts) FROM events))
    SELECT event_type, count(*) AS changes, round(quantile_cont(d, 0.5), 4) AS p50_s, round(quantile_cont(d, 0.95), 4) AS p95_s, max(d) AS max_s FROM d WHERE d IS NOT NULL GROUP BY 1""")
def cd08(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("ts", F.date_trunc("millisecond", "ts"))
    pairs = events.withColumn("before", F.lag("ts").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))).filter("before IS NOT NULL")
    found = changes.change_latency(pairs, "event_type", "before", "ts")
    return found.select("event_type", "changes", F.round("p50_s", 4).alias("p50_s"), F.round("p95_s", 4).alias("p95_s"), "max_s")


# --- quality


@query(
    "q01_checks",
    """SELECT 'total_positive' AS "check", 'error' AS severity, count(*) FILTER (WHERE NOT o_totalprice > 0) AS failures FROM orders
       UNION ALL SELECT 'status_known', 'warn', count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) FROM orders
       UNION ALL SELECT 'unique_o_orderkey', 'error', coalesce(sum(n - 1) FILTER (WHERE n > 1), 0)::BIGINT FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey)""",
)
def q01(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [quality.Check("total_positive", ~(F.col("o_totalprice") > 0)), quality.Check("status_known", ~F.col("o_orderstatus").isin("F", "O"), "warn")]
    return quality.run_checks(table(spark, sf_dir, "orders"), checks, [["o_orderkey"]])


@query(
    "q08_metric_snapshot",
    """WITH t AS (SELECT coalesce(c_mktsegment, 'all') AS dimension, count(*)::DOUBLE AS customers, sum(c_acctbal::DECIMAL(18,2))::DOUBLE AS balance FROM customer GROUP BY ROLLUP (c_mktsegment))
       SELECT 'customers' AS area, 'customers' AS metric, dimension, customers AS value FROM t UNION ALL SELECT 'customers', 'balance', dimension, balance FROM t""",
)
def q08(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = table(spark, sf_dir, "customer").select("c_mktsegment", F.lit(1).alias("customers"), F.col("c_acctbal").cast("decimal(18,2)").alias("balance"))
    return quality.snapshot_metrics(mart, ["c_mktsegment"], ["customers", "balance"], "customers")


@query(
    "q09_history",
    """WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS run_key, o_orderpriority AS dimension, count(*)::DOUBLE AS value FROM orders GROUP BY 1, 2),
       r AS (SELECT run_key, lag(run_key) OVER (ORDER BY run_key) AS previous_run FROM (SELECT DISTINCT run_key FROM m))
       SELECT m.run_key, m.dimension, m.value, p.value AS previous_value, m.value - p.value AS change FROM m JOIN r USING (run_key) LEFT JOIN m p ON p.run_key = r.previous_run AND p.dimension = m.dimension""",
)
def q09(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = table(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("run_key"), F.col("o_orderpriority").alias("dimension")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    metrics = metrics.withColumns({"area": F.lit("orders"), "metric": F.lit("orders")})
    runs = metrics.select("run_key", F.col("run_key").alias("run_at"), F.lit("month").alias("series")).distinct()
    return quality.quality_history(metrics, runs, ["series"]).select("run_key", "dimension", "value", "previous_value", "change")


# --- nested resources and their views


def _claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    heads = orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").cast("string").alias("member"), F.col("o_orderstatus").alias("status"), c.iso_date(F.col("o_orderdate")).alias("created"), F.col("o_totalprice").alias("total"))
    items = lines.select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), F.col("l_partkey").cast("string").alias("product"), F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("net"))
    return resources.claim_resources(heads, items)


_ITEMS = views.View(
    "ExplanationOfBenefit",
    [
        views.Select(
            [views.Col("claim_id", views.path("id")), views.Col("member_id", views.path("patient").reference_key())],
            select=[views.Select([views.Col("line", views.path("sequence"), "int"), views.Col("product", views.path("product")), views.Col("quantity", views.path("quantity"), "double")], for_each=views.path("item"), or_null=True, row_index="position")],
        )
    ],
)


@query(
    "v18_claim_items",
    """SELECT o_orderkey::VARCHAR AS claim_id, o_custkey::VARCHAR AS member_id, l_linenumber AS line, l_partkey::VARCHAR AS product, l_quantity AS quantity,
              (CASE WHEN l_orderkey IS NULL THEN 0 ELSE row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_partkey::VARCHAR, l_quantity, l_extendedprice) - 1 END)::INT AS position
       FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""",
)
def v18(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = resources.as_json(_claims(spark, sf_dir), "claim").select("id", F.col("claim").alias("resource"))
    return views.flatten_view(texts, _ITEMS).select("claim_id", "member_id", "line", "product", "quantity", "position")


@query("q04_round_trip_parity", """SELECT 'claim items' AS comparison, 0::BIGINT AS only_a, 0::BIGINT AS only_b""")
def q04(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables to JSON, JSON to rows by a view, rows against the tables: nothing may be on one side alone."""
    rows = v18(spark, sf_dir).filter("line IS NOT NULL").select("claim_id", "line", "product", "quantity")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("claim_id"), F.col("l_linenumber").alias("line"), F.col("l_partkey").cast("string").alias("product"), F.col("l_quantity").alias("quantity"))
    return quality.parity({"claim items": (rows, lines)})


@query("q06_redaction", """SELECT 0 AS id, 0 AS problems WHERE false""")
def q06(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims without amounts hold no amount anywhere."""
    redacted = resources.as_json(resources.redact_claims(_claims(spark, sf_dir)), "claim")
    return quality.redaction_problems(redacted, "id", "claim", ["total", "net"]).select(F.col("id").cast("int").alias("id"), F.size("found").alias("problems"))


@query("r06_redacted_items", """SELECT o_orderkey AS id, count(l_orderkey) AS items FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""")
def r06(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resources.redact_claims(_claims(spark, sf_dir)).select("id", F.coalesce(F.size("claim.item"), F.lit(0)).cast("long").alias("items"))


# --- identity


@query(
    "i04_jaro_winkler",
    """WITH n AS (SELECT DISTINCT p_name FROM part) SELECT a.p_name AS a, b.p_name AS b, round(jaro_winkler_similarity(a.p_name, b.p_name), 6) AS similarity, levenshtein(a.p_name, b.p_name) AS edits FROM n a JOIN n b ON a.p_name < b.p_name""",
)
def i04(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of the distinct part names: a dimension of a few dozen values, whatever the number of parts."""
    names = table(spark, sf_dir, "part").select("p_name").distinct()
    pairs = names.select(F.col("p_name").alias("a")).join(names.select(F.col("p_name").alias("b")), F.col("a") < F.col("b"))
    scored = identity.similar_names(pairs, "a", "b", "similarity")
    return scored.select("a", "b", F.round("similarity", 6).alias("similarity"), F.levenshtein("a", "b").cast("long").alias("edits"))


@query("i06_term_frequencies", """SELECT p_name, round(count(*) / (SELECT count(*) FROM part WHERE p_name IS NOT NULL), 8) AS frequency FROM part WHERE p_name IS NOT NULL GROUP BY 1""")
def i06(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.term_frequencies(table(spark, sf_dir, "part"), "p_name").select("p_name", F.round("frequency", 8).alias("frequency"))


SKETCH = 64


@query("i10_linkage")
def i10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies among documents. Equal texts are one: of them the least id is compared, and each copy is paired with it alone. Distinct texts are blocked by
    pairs of least hashes over all their runs of three words (under eight hash functions), compared by sketch, opening, closing
    and length, with u from random pairs and m and the share of matches by EM."""
    compared_by = ("n_chars", "opening", "closing", "sketch")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "n_chars", F.substring_index("text", " ", 8).alias("opening"), F.substring_index("text", " ", -8).alias("closing"),
        F.md5(F.coalesce("text", F.lit(""))).alias("same"), sketches(F.col("text"), size=SKETCH).alias("s"),
    )
    docs = settle(docs.select("doc_id", *compared_by[:3], "same", "s.sketch", *(F.get("s.least", F.lit(k)).alias(f"least_{k}") for k in range(8))))
    row = F.struct(*(x for x in docs.columns if x != "same"))
    distinct = settle(docs.groupBy("same").agg(F.min_by(row, "doc_id").alias("d"), F.count(F.lit(1)).alias("n")).select("same", "d.*", "n"))
    # Equal texts agree in all but perhaps the given length, so only that is fetched from the first of them.
    firsts = distinct.filter("n > 1").select("same", F.col("doc_id").alias("id_l"), F.col("n_chars").alias("n_chars_l"))
    copies = relational.salted_join(docs, firsts, "same", "doc_id").filter("doc_id > id_l")
    copies = copies.select("id_l", F.col("doc_id").alias("id_r"), "n_chars_l", F.col("n_chars").alias("n_chars_r"), *(F.col(x).alias(f"{x}_{s}") for x in compared_by[1:] for s in "lr"))
    pairs = relational.candidate_pairs(distinct, "doc_id", [[f"least_{k}", f"least_{k + 1}"] for k in (0, 2, 4, 6)], carry=compared_by).drop("rule").unionByName(copies)
    sides = [docs.select(F.col("doc_id").alias(f"id_{s}"), *(F.col(x).alias(f"{x}_{s}") for x in compared_by)) for s in ("l", "r")]
    either_null = lambda x: F.col(f"{x}_l").isNull() | F.col(f"{x}_r").isNull()
    near = lambda x: identity.Comparison(x, either_null(x), (F.col(f"{x}_l") == F.col(f"{x}_r"), F.levenshtein(f"{x}_l", f"{x}_r", 5) >= 0))
    length = identity.Comparison("n_chars", either_null("n_chars"), (F.col("n_chars_l") == F.col("n_chars_r"), F.abs(F.col("n_chars_l") - F.col("n_chars_r")) <= 20))
    shared = F.size(F.array_intersect("sketch_l", "sketch_r")) / F.greatest(F.size("sketch_l"), F.size("sketch_r"))
    comparisons = [identity.Comparison("sketch", either_null("sketch"), (shared >= 0.75, shared >= 0.4)), near("opening"), near("closing"), length]
    compared = settle(identity.compare(pairs, comparisons).select("id_l", "id_r", *(f"gamma_{c_.name}" for c_ in comparisons)))
    u = identity.gamma_shares(identity.compare(identity.random_pairs(*sides, n=100_000), comparisons), comparisons)
    m, prior = identity.estimate_m(compared, comparisons, u, 0.5)
    scored = identity.decide_pairs(identity.score(compared, comparisons, m, u, min(max(prior, 1e-6), 1 - 1e-6)))
    return scored.select("id_l", "id_r", "match_weight", "match_probability", "decision")


# --- batch jobs


@query(
    "x08_decisions",
    """WITH a AS (SELECT conv_id, count(*) FILTER (WHERE role = 'user') AS asked, count(*) FILTER (WHERE role = 'assistant') AS answered, max(length(text)) FILTER (WHERE role = 'assistant') AS longest FROM conversations GROUP BY 1)
       SELECT conv_id, CASE WHEN asked <= answered AND longest >= 100 THEN 'approve' ELSE 'pend' END AS decision,
              concat_ws(';', CASE WHEN asked > answered THEN 'unanswered' END, CASE WHEN coalesce(longest, 0) < 100 THEN 'short' END) AS reasons FROM a""",
)
def x08(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count_if(F.col("role") == "user").alias("asked"), F.count_if(F.col("role") == "assistant").alias("answered"), F.max(F.when(F.col("role") == "assistant", F.length("text"))).alias("longest"))
    reasons = F.concat_ws(";", F.when(F.col("asked") > F.col("answered"), "unanswered"), F.when(F.coalesce("longest", F.lit(0)) < 100, "short"))
    return turns.select("conv_id", F.when(reasons == "", "approve").otherwise("pend").alias("decision"), reasons.alias("reasons"))


@query(
    "x01_member_export",
    f"""SELECT o_orderkey, o_custkey FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        WHERE n_name = 'NATION_3' AND c_acctbal >= 0 AND o_orderdate::DATE BETWEEN DATE '{AS_OF}' - INTERVAL 60 MONTH AND DATE '{AS_OF}'""",
)
def x01(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of the last five years of the members of one nation, members that have opted out (negative balance) left out."""
    nation = table(spark, sf_dir, "nation").filter("n_name = 'NATION_3'").select("n_nationkey")
    customers = table(spark, sf_dir, "customer")
    members = customers.join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"), "left_semi")
    visible = members.join(customers.filter("c_acctbal < 0").select("c_custkey"), "c_custkey", "left_anti")
    orders = table(spark, sf_dir, "orders").filter(c.within_lookback(F.col("o_orderdate").cast("date"), F.lit(AS_OF).cast("date"), 60))
    return orders.join(visible, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey", "o_custkey")


from millrace.plans import benefits, documents, jobs, people, reports, upkeep  # noqa: E402, F401  (registers its queries)

__all__ = ["QUERIES", "SQL", "fct_claims"]
