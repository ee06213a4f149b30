"""Registered queries of the batch jobs: customers as members, suppliers as providers, orders as requests and services."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import jobs, relational
from millrace.plans.registry import query
from millrace.sources.files import table

AS_OF = "2001-09-28"
_DAY = "o_orderdate::DATE"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("day", F.col("o_orderdate").cast("date"))


@query("p18_visible", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') AND c_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def p18(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    listed = _orders(spark, sf_dir).filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return jobs.visible(customers, listed, customers.filter("c_acctbal < 0"), "c_custkey").select("c_custkey")


@query(
    "p16_exchange_scope",
    f"""SELECT o_orderkey, o_orderstatus FROM orders WHERE CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderstatus = 'O' OR {_DAY} >= DATE '{AS_OF}' - 365 ELSE {_DAY} >= DATE '{AS_OF}' - INTERVAL 60 MONTH END""",
)
def p16(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Urgent orders as authorizations (open ones undecided), all others as services."""
    kind = F.when(F.col("o_orderpriority") == "1-URGENT", "authorization").otherwise("service")
    decided = F.when(F.col("o_orderstatus") != "O", F.col("day"))
    return _orders(spark, sf_dir).filter(jobs.in_exchange_scope(kind, F.col("day"), decided, F.lit(AS_OF).cast("date"))).select("o_orderkey", "o_orderstatus")


_CONSENT_SQL = f"""
    SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 10 = 0 THEN 'other member' WHEN o_orderstatus <> 'F' THEN 'not active' WHEN {_DAY} > DATE '{AS_OF}' THEN 'not yet in force'
           WHEN {_DAY} + 365 < DATE '{AS_OF}' THEN 'expired' WHEN o_orderpriority = '5-LOW' THEN 'other receiver' WHEN o_totalprice > 300000 THEN 'restricted data' END AS problem FROM orders"""


def _consents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as consents: their customer's (every tenth another's), active when finished, for a year, to one receiver unless of low priority."""
    member = F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey"))
    receiver = F.when(F.col("o_orderpriority") != "5-LOW", "payer")
    consent = jobs.Consent(member, F.when(F.col("o_orderstatus") == "F", "active"), F.col("day"), F.date_add("day", 365), receiver, F.col("o_totalprice") > 300000)
    return _orders(spark, sf_dir).withColumn("problem", jobs.consent_problem(consent, F.col("o_custkey"), F.lit("payer"), F.lit(AS_OF).cast("date")))


@query("p17_consent", _CONSENT_SQL)
def p17(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _consents(spark, sf_dir).select("o_orderkey", "o_custkey", "problem")


_ASKED = "SELECT DISTINCT o_custkey + CASE WHEN o_orderkey % 50 = 0 THEN 10000000 ELSE 0 END AS m FROM orders WHERE o_orderpriority = '2-HIGH'"
_EXPORT_SQL = f"""
    WITH asked AS ({_ASKED}), ok AS (SELECT m FROM asked JOIN customer ON m = c_custkey WHERE c_acctbal >= 0),
    sent AS (SELECT o_custkey AS m, max(o_orderdate) AS sent_at FROM orders WHERE o_orderstatus = 'P' GROUP BY 1),
    rows AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'ExplanationOfBenefit' ELSE 'Coverage' END AS type, o_orderkey AS id, o_custkey AS member_id, o_custkey % 25 AS org
             FROM orders JOIN ok ON o_custkey = m LEFT JOIN sent USING (m) WHERE o_orderstatus <> 'P' AND {_DAY} >= DATE '1995-01-01' AND {_DAY} < DATE '2000-01-01' AND (sent_at IS NULL OR o_orderdate > sent_at))
    """


def _export(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders, customers = _orders(spark, sf_dir), table(spark, sf_dir, "customer")
    kind = F.when(F.col("o_orderstatus") == "F", "ExplanationOfBenefit").when(F.col("o_orderstatus") == "P", "Patient").otherwise("Coverage")
    resources = orders.select(kind.alias("type"), F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("member_id"), F.col("o_orderdate").alias("updated"), (F.col("o_custkey") % 25).alias("organization_id"))
    asked = orders.filter("o_orderpriority = '2-HIGH'").select((F.col("o_custkey") + F.when(F.col("o_orderkey") % 50 == 0, 10000000).otherwise(0)).alias("member_id"))
    members = customers.select(F.col("c_custkey").alias("member_id"))
    out = customers.filter("c_acctbal < 0").select(F.col("c_custkey").alias("member_id"))
    sent = orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("member_id"), F.col("o_orderdate").alias("sent_at"))
    organizations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("id"))
    return jobs.member_export(asked, members, out, resources, organizations, ["ExplanationOfBenefit", "Coverage"], F.lit("1995-01-01").cast("timestamp"), F.lit("2000-01-01").cast("timestamp"), sent)


@query("x01_group_export", _EXPORT_SQL + "SELECT type, id, member_id FROM rows UNION ALL SELECT 'Organization', n_nationkey, NULL FROM nation WHERE n_nationkey IN (SELECT org FROM rows)")
def x01_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _export(spark, sf_dir)[0]


@query("x01_export_issues", f"WITH asked AS ({_ASKED}) SELECT m AS member_id, CASE WHEN c_custkey IS NULL THEN 'not a member' ELSE 'opted out' END AS reason FROM asked LEFT JOIN customer ON m = c_custkey WHERE c_custkey IS NULL OR c_acctbal < 0")
def x01_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _export(spark, sf_dir)[1]


@query("x02_record_sent", _EXPORT_SQL + f"SELECT m AS member_id, strftime(max(day), '%Y-%m-%d') AS sent FROM (SELECT m, sent_at AS day FROM sent UNION ALL SELECT member_id, TIMESTAMP '{AS_OF}' FROM rows) GROUP BY 1")
def x02(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _orders(spark, sf_dir).filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("member_id"), F.col("o_orderdate").cast("timestamp").alias("sent_at"))
    return jobs.record_sent(log, _export(spark, sf_dir)[0], F.lit(AS_OF).cast("timestamp")).select("member_id", F.date_format("sent_at", "yyyy-MM-dd").alias("sent"))


_PEOPLE_SQL = """
    WITH p AS (SELECT c_custkey, CASE WHEN c_nationkey % 2 = 0 THEN 'A' ELSE 'B' END AS payer, c_nationkey * 100 + c_custkey % 40 AS born, c_mktsegment AS segment, c_custkey % 7 AS nick FROM customer),
    q AS (SELECT c_custkey AS rid, CASE WHEN c_custkey % 11 = 0 THEN 'Z' ELSE payer END AS payer, CASE WHEN c_custkey % 3 = 0 THEN c_custkey WHEN c_custkey % 3 = 1 THEN NULL ELSE -c_custkey END AS mid,
                 CASE WHEN c_custkey % 5 = 0 THEN born + 1 ELSE born END AS born, segment, nick FROM p),
    by_id AS (SELECT rid, c_custkey AS found FROM q JOIN p ON q.payer = p.payer AND mid = c_custkey AND q.born = p.born AND (q.segment = p.segment OR q.nick = p.nick)),
    by_name AS (SELECT rid, count(DISTINCT c_custkey) AS n, min(c_custkey) AS found FROM q JOIN p ON q.payer = p.payer AND q.born = p.born AND (q.segment = p.segment OR q.nick = p.nick) GROUP BY 1),
    m AS (SELECT q.rid, CASE WHEN q.payer = 'Z' THEN 'unknown payer' WHEN by_id.found IS NOT NULL THEN 'member id' WHEN n = 1 THEN 'demographics' WHEN n > 1 THEN 'ambiguous' ELSE 'no match' END AS reason,
                 coalesce(by_id.found, CASE WHEN n = 1 THEN by_name.found END) AS member_id FROM q LEFT JOIN by_id USING (rid) LEFT JOIN by_name USING (rid))
    """


def _people(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(requests, members): customers with a made-up birth number and two names; of the requests some name another payer, no or a wrong id, or a wrong birth number."""
    key = F.col("c_custkey")
    payer, names = F.when(F.col("c_nationkey") % 2 == 0, "A").otherwise("B"), F.array("c_mktsegment", F.concat(F.lit("nick "), (key % 7).cast("string")))
    born = F.col("c_nationkey") * 100 + key % 40
    members = table(spark, sf_dir, "customer").select(payer.alias("payer"), key.alias("member_id"), born.alias("birth_date"), names.alias("names"), F.col("c_acctbal").alias("balance"))
    mid = F.when(F.col("member_id") % 3 == 0, F.col("member_id")).when(F.col("member_id") % 3 == 2, -F.col("member_id"))
    requests = members.select(
        F.col("member_id").alias("request_id"), F.when(F.col("member_id") % 11 == 0, "Z").otherwise(F.col("payer")).alias("payer"), mid.alias("member_id"),
        (F.col("birth_date") + F.when(F.col("member_id") % 5 == 0, 1).otherwise(0)).alias("birth_date"), "names", "balance",
    )
    return requests, members.drop("balance")


@query("j20_member_match", _PEOPLE_SQL + "SELECT rid AS request_id, CASE WHEN reason <> 'unknown payer' THEN member_id END AS member_id, reason FROM m")
def j20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.match_members(*_people(spark, sf_dir))


@query(
    "x03_bulk_match",
    _PEOPLE_SQL
    + """SELECT rid AS request_id, CASE WHEN outcome = 'matched' THEN member_id END AS member_id, outcome, CASE WHEN outcome = 'consent constrained' THEN 'negative balance' ELSE reason END AS reason
         FROM (SELECT m.*, CASE WHEN member_id IS NULL OR reason = 'unknown payer' THEN 'no match' WHEN c_acctbal < 0 THEN 'consent constrained' ELSE 'matched' END AS outcome FROM m JOIN customer ON rid = c_custkey)""",
)
def x03(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.bulk_match(*_people(spark, sf_dir), F.when(F.col("balance") < 0, "negative balance"))


@query("x04_withdrawn", """WITH r AS (SELECT l_orderkey, max(l_shipdate) AS day FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) SELECT o_orderkey, coalesce(day >= o_orderdate + INTERVAL 30 DAY, false) AS withdrawn FROM orders LEFT JOIN r ON o_orderkey = l_orderkey""")
def x04(spark: SparkSession, sf_dir: str) -> DataFrame:
    exports = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderdate") + F.expr("interval 30 days")).alias("exported_at"))
    revoked = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_shipdate").alias("revoked_at"))
    return jobs.withdraw(exports, revoked, "o_orderkey").select("o_orderkey", "withdrawn")


@query("x05_member_claims", "SELECT l_orderkey, l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey < 5 AND c_acctbal >= 0)")
def x05(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the members on a list (five nations) that have not opted out."""
    customers = table(spark, sf_dir, "customer")
    seen = jobs.visible(customers, customers.filter("c_nationkey < 5"), customers.filter("c_acctbal < 0"), "c_custkey")
    orders = table(spark, sf_dir, "orders").join(seen, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey")
    return table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").select("l_orderkey", "l_linenumber")


@query(
    "x06_coverage_requirement",
    f"""WITH s AS (SELECT o_custkey AS m, min({_DAY}) + 90 AS a, CASE WHEN max({_DAY}) < DATE '2001-06-01' THEN max({_DAY}) - 30 END AS b FROM orders GROUP BY 1)
        SELECT o_orderkey AS order_id, {_DAY} >= a AND (b IS NULL OR {_DAY} <= b) AS covered, {_DAY} >= a AND (b IS NULL OR {_DAY} <= b) AND o_orderpriority IN ('1-URGENT', '3-MEDIUM') AS needs_authorization,
               CASE WHEN {_DAY} >= a AND (b IS NULL OR {_DAY} <= b) AND o_orderpriority = '1-URGENT' THEN 'urgency' END AS questionnaire FROM orders JOIN s ON o_custkey = m""",
)
def x06(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir).select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("member_id"), F.col("o_orderpriority").alias("service"), F.col("day").alias("on_date"))
    last = F.max("on_date")
    spans = orders.groupBy("member_id").agg(F.date_add(F.min("on_date"), 90).alias("valid_from"), F.when(last < F.lit("2001-06-01").cast("date"), F.date_sub(last, 30)).alias("valid_to"))
    rules = spark.createDataFrame([("1-URGENT", True, "urgency"), ("3-MEDIUM", True, None), ("5-LOW", False, "none")], "service string, needs_authorization boolean, questionnaire string")
    return jobs.coverage_requirement(orders, spans, F.broadcast(rules))


_ANSWERS_SQL = """
    SELECT l_orderkey AS request_id, 'mode ' || l_linenumber AS item, l_returnflag AS answer, 'A' AS source FROM lineitem
    UNION ALL SELECT l_orderkey, 'status ' || l_linenumber, l_linestatus, CASE WHEN l_quantity > 25 THEN 'O' ELSE 'M' END FROM lineitem WHERE l_quantity > 10"""


def _forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One form an order: for each line an item with the flag, and nested in it one with the status (not answered for small quantities)."""
    number = F.col("l_linenumber").cast("string")
    inner = F.struct(F.concat(F.lit("status "), number).alias("link_id"), F.when(F.col("l_quantity") > 10, F.col("l_linestatus")).alias("answer"), F.when(F.col("l_quantity") > 25, "O").otherwise("M").alias("source"))
    outer = F.struct(F.concat(F.lit("mode "), number).alias("link_id"), F.col("l_returnflag").alias("answer"), F.lit(None).cast("string").alias("source"), F.array(inner).alias("item"))
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("request_id")).agg(F.collect_list(outer).alias("items"))


@query("x07_answers", _ANSWERS_SQL)
def x07(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.flatten_answers(_forms(spark, sf_dir), "request_id", "items")


_DECIDED_SQL = f"""
    WITH a AS (SELECT request_id, item, max(answer) AS answer FROM ({_ANSWERS_SQL}) GROUP BY 1, 2),
    c AS (SELECT * FROM (VALUES ('1-URGENT', 'mode 1', 'N'), ('1-URGENT', 'status 1', 'O'), ('2-HIGH', 'mode 1', 'R'), ('2-HIGH', 'mode 2', 'N'), ('3-MEDIUM', 'status 2', 'F')) t(service, item, needed)),
    j AS (SELECT o_orderkey AS request_id, array_to_string(list(c.item ORDER BY c.item) FILTER (WHERE c.item IS NOT NULL AND answer IS NULL), ',') AS missing, array_to_string(list(c.item ORDER BY c.item) FILTER (WHERE answer <> needed), ',') AS unmet
          FROM orders LEFT JOIN c ON service = o_orderpriority LEFT JOIN a ON a.request_id = o_orderkey AND a.item = c.item GROUP BY 1),
    j2 AS (SELECT request_id, coalesce(missing, '') AS missing, coalesce(unmet, '') AS unmet FROM j),
    d AS (SELECT *, CASE WHEN missing = '' AND unmet = '' THEN 'approve' ELSE 'pend' END AS decision FROM j2)
    """


def _decided(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("request_id"), F.col("o_orderpriority").alias("service"))
    rules = [("1-URGENT", "mode 1", "N"), ("1-URGENT", "status 1", "O"), ("2-HIGH", "mode 1", "R"), ("2-HIGH", "mode 2", "N"), ("3-MEDIUM", "status 2", "F")]
    criteria = F.broadcast(spark.createDataFrame(rules, "service string, item string, needed string"))
    return jobs.decide_authorizations(requests, jobs.flatten_answers(_forms(spark, sf_dir), "request_id", "items"), criteria)


@query("x08_authorizations", _DECIDED_SQL + "SELECT request_id, decision, missing, unmet FROM d")
def x08(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decided(spark, sf_dir).select("request_id", "decision", F.array_join("missing", ",").alias("missing"), F.array_join("unmet", ",").alias("unmet"))


@query(
    "x09_review",
    _DECIDED_SQL
    + """SELECT request_id, decision, CASE WHEN decision <> 'pend' THEN decision WHEN unmet LIKE '%,%' THEN 'deny' WHEN missing = '' THEN 'approve' ELSE 'pend' END AS final,
                CASE WHEN decision <> 'pend' THEN 'rules' WHEN unmet LIKE '%,%' OR missing = '' THEN 'reviewer' END AS decided_by FROM d""",
)
def x09(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.review_pended(_decided(spark, sf_dir), F.size("unmet") > 1, F.size("missing") == 0).select("request_id", "decision", "final", "decided_by")


@query(
    "x10_requests",
    """WITH i AS (SELECT l_orderkey, list({'p': l_partkey, 'u': l_extendedprice / l_quantity, 'q': l_quantity, 'n': CASE WHEN l_linestatus = 'F' THEN l_extendedprice END} ORDER BY l_linenumber, l_partkey, l_quantity, l_extendedprice) AS items FROM lineitem WHERE l_linenumber <= 2 AND l_returnflag <> 'A' GROUP BY 1)
       SELECT o_orderkey AS request_id, items[1].p AS product, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority ELSE NULL END AS diagnosis, round(coalesce(items[1].n, items[1].u * items[1].q), 2) AS amount,
              CASE WHEN o_custkey % 20 = 0 THEN 'no member' WHEN items IS NULL THEN 'no item' WHEN len(items) > 1 THEN 'more than one item' WHEN o_orderstatus = 'P' THEN 'no diagnosis' END AS rejection
       FROM orders LEFT JOIN i ON o_orderkey = l_orderkey""",
)
def x10(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.struct(F.col("l_partkey").alias("product"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"), F.col("l_quantity").alias("quantity"), F.when(F.col("l_linestatus") == "F", F.col("l_extendedprice")).alias("net"))
    placed = F.struct("l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", item.alias("item"))
    items = table(spark, sf_dir, "lineitem").filter("l_linenumber <= 2 AND l_returnflag <> 'A'").groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(placed)), lambda x: x.item).alias("items"))
    code = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    diagnoses = F.array(F.struct(F.lit(2).alias("sequence"), F.lit("later").alias("code")), F.struct(F.lit(1).alias("sequence"), code.alias("code")))
    requests = table(spark, sf_dir, "orders").join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").alias("request_id"), F.when(F.col("o_custkey") % 20 != 0, F.col("o_custkey")).alias("member_id"), "items", F.filter(diagnoses, lambda d: (d.sequence == 1) | (F.col("o_orderstatus") != "P")).alias("diagnoses")
    )
    return jobs.flatten_requests(requests).withColumn("amount", F.round("amount", 2))


@query("x11_intake", """WITH e AS (SELECT * FROM orders WHERE o_orderkey % 3 = 0), n AS (SELECT o_custkey AS provider, o_orderkey AS submission, min(o_orderdate) AS day FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey % 3 <> 0 GROUP BY 1, 2)
    SELECT (SELECT max(o_orderkey) FROM e) + row_number() OVER (ORDER BY day, provider, submission) AS id, provider, submission FROM n""")
def x11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even orders handed in (each twice) where every third order is already there."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("provider"), F.col("o_orderkey").alias("submission"), F.col("o_orderdate").alias("at"))
    handed = orders.filter("submission % 2 = 0").drop("id")
    return jobs.intake(orders.filter("submission % 3 = 0"), handed.unionByName(handed), ["provider", "submission"], "id", ["at"]).select("id", "provider", "submission")


@query("x11_intake_rows", """WITH n AS (SELECT o_custkey AS provider, o_orderkey AS submission, o_orderdate AS day, o_totalprice AS amount, o_orderpriority AS body FROM orders WHERE o_orderkey % 3 <> 0)
    SELECT (SELECT max(o_orderkey) FROM orders WHERE o_orderkey % 3 = 0) + row_number() OVER (ORDER BY day, provider, submission) AS id, provider, submission, day, amount, body FROM n""")
def x11_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders handed in whole, where every third order is already there."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("provider"), F.col("o_orderkey").alias("submission"), F.col("o_orderdate").alias("day"), F.col("o_totalprice").alias("amount"), F.col("o_orderpriority").alias("body")
    )
    return jobs.intake(orders.filter("submission % 3 = 0"), orders.drop("id"), ["provider", "submission"], "id", ["day"])


@query("x12_events", """WITH d AS (SELECT o_orderkey, o_custkey % 10 AS provider, o_orderdate FROM orders WHERE o_orderstatus <> 'O'), told AS (SELECT provider AS sub, o_orderkey, row_number() OVER (PARTITION BY provider ORDER BY o_orderkey) AS n FROM d WHERE o_orderkey % 4 = 0),
    s AS (SELECT range AS sub FROM range(8)) SELECT sub AS subscription_id, o_orderkey AS request_id, (SELECT coalesce(max(n), 0) FROM told WHERE told.sub = s.sub) + row_number() OVER (PARTITION BY sub ORDER BY o_orderdate, o_orderkey) AS event_number
    FROM d JOIN s ON provider = sub WHERE o_orderkey % 4 <> 0""")
def x12(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'O'").select(F.col("o_orderkey").alias("request_id"), (F.col("o_custkey") % 10).alias("provider_id"), F.col("o_orderdate").alias("decided_at"))
    subscriptions = spark.range(8).select(F.col("id").alias("subscription_id"), F.col("id").alias("provider_id"))
    told = relational.numbered(decided.filter("request_id % 4 = 0 AND provider_id < 8"), ["provider_id"], [F.col("request_id")], "event_number").select(F.col("provider_id").alias("subscription_id"), "request_id", "event_number")
    return jobs.decision_events(decided, told, subscriptions)


@query("x13_truth_reviews", """SELECT o_custkey AS a, o_orderkey AS b, CASE WHEN o_orderstatus = 'F' THEN 'accept' ELSE 'reject' END AS decision FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderkey % 5 <> 0""")
def x13(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("a"), F.col("o_orderkey").alias("b"), "o_orderstatus", "o_orderpriority")
    return jobs.review_by_truth(pairs.filter("o_orderpriority = '1-URGENT'"), pairs.filter("o_orderstatus = 'F'"), pairs.filter("b % 5 = 0"), ["a", "b"])


@query("x14_attribution", """WITH e AS (SELECT l_suppkey AS p, o_custkey AS m, 'claim' AS s FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' UNION ALL SELECT l_suppkey, o_custkey, 'request' FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'P')
    SELECT p AS provider_id, m AS member_id, string_agg(DISTINCT s, ',' ORDER BY s) AS sources, count(*) AS events FROM e GROUP BY 1, 2 HAVING count(*) >= 2""")
def x14(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("l_suppkey").alias("provider_id"), F.col("o_custkey").alias("member_id"), "l_returnflag", "o_orderstatus")
    return jobs.attribution([("claim", both.filter("l_returnflag = 'R'")), ("request", both.filter("o_orderstatus = 'P'"))], least=2)


@query("x01_payer_export", f"""WITH m AS (SELECT c_custkey AS m, DATE '2000-01-01' AS a, CASE WHEN c_custkey % 4 = 0 THEN DATE '{AS_OF}' - 1 WHEN c_custkey % 4 = 1 THEN DATE '{AS_OF}' END AS b FROM customer WHERE c_custkey % 6 <> 0)
    SELECT 'ExplanationOfBenefit' AS type, o_orderkey AS id, m AS member_id, NULL AS reason FROM orders JOIN m ON o_custkey = m WHERE (b IS NULL OR b >= DATE '{AS_OF}') AND (CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus = 'O' OR {_DAY} + 5 >= DATE '{AS_OF}' - 365 ELSE {_DAY} >= DATE '{AS_OF}' - INTERVAL 5 YEAR END)
    UNION ALL SELECT NULL, NULL, c_custkey, CASE WHEN m IS NULL THEN 'not a member' ELSE 'consent ended' END FROM customer LEFT JOIN m ON c_custkey = m WHERE m IS NULL OR b < DATE '{AS_OF}'""")
def x01_payer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as benefits, a third of them authorizations; every sixth customer is outside the group, every fourth one's consent ended the day before."""
    customers, k, as_of = table(spark, sf_dir, "customer"), F.col("c_custkey"), F.lit(AS_OF).cast("date")
    matched = customers.filter(k % 6 != 0).select(k.alias("member_id"), F.lit("2000-01-01").cast("date").alias("consent_start"), F.when(k % 4 == 0, F.date_sub(as_of, 1)).when(k % 4 == 1, as_of).alias("consent_end"))
    benefit = F.col("o_orderkey") % 3
    resources = _orders(spark, sf_dir).select(
        F.lit("ExplanationOfBenefit").alias("type"), F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("member_id"), F.col("day").alias("updated"), F.lit(None).cast("long").alias("organization_id"),
        F.when(benefit == 0, "authorization").otherwise("claim").alias("kind"), F.col("day").alias("served"), F.when(F.col("o_orderstatus") != "O", F.date_add("day", 5)).alias("decided"),
    )
    none = spark.createDataFrame([], "id long")
    exported, issues = jobs.payer_export(customers.select(k.alias("member_id")), matched, resources, none, as_of)
    return exported.withColumn("reason", F.lit(None).cast("string")).unionByName(issues, allowMissingColumns=True).select("type", "id", "member_id", "reason")


@query("x05_provider_and_payer_views", f"""WITH v AS (SELECT DISTINCT 'provider ' || l_suppkey AS viewer_id, o_custkey AS m FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE c_acctbal >= 0
    UNION ALL SELECT 'payer ' || c_nationkey, c_custkey FROM customer WHERE c_custkey % 3 <> 0 AND (c_custkey % 4 <> 0 OR c_custkey % 8 = 0)) SELECT viewer_id, count(*) AS orders, sum(o_orderkey)::BIGINT AS keys FROM v JOIN orders ON o_custkey = m GROUP BY 1""")
def x05_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each provider (members with its lines) and each payer (a nation's customers with a consent in force) may see: orders by viewer."""
    customers, orders, k, as_of = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders"), F.col("c_custkey"), F.lit(AS_OF).cast("date")
    lines = table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    attributed = lines.select(F.concat(F.lit("provider "), F.col("l_suppkey").cast("string")).alias("provider_id"), F.col("o_custkey").alias("member_id"))
    ends = F.when(k % 8 == 0, as_of).when(k % 4 == 0, F.date_sub(as_of, 1))
    matched = customers.filter(k % 3 != 0).select(F.concat(F.lit("payer "), F.col("c_nationkey").cast("string")).alias("payer"), k.alias("member_id"), F.lit(None).cast("date").alias("consent_start"), ends.alias("consent_end"))
    views = jobs.provider_views(attributed, customers.filter("c_acctbal < 0").select(k.alias("member_id"))).unionByName(jobs.payer_views(matched, as_of))
    return jobs.seen_by(views, orders.select(F.col("o_custkey").alias("member_id"), "o_orderkey")).groupBy("viewer_id").agg(F.count(F.lit(1)).alias("orders"), F.sum("o_orderkey").alias("keys"))
