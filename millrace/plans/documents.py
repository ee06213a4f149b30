"""Registered queries of resources, their views, parity, references, redaction and terminology: orders as claims, customers as members, suppliers as providers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import quality, resources, views
from millrace.operators.views import Col, Select, View, constant, path, this
from millrace.plans.registry import query
from millrace.sources.files import table


def _read(made: DataFrame, view: View) -> DataFrame:
    return views.flatten_view(made.select("resource"), view)






# --- the builders


def _patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers; every seventh without a birth date; those with a multiple of five have one or two identifiers more."""
    k = F.col("c_custkey")
    born = F.when(k % 7 != 0, F.date_add(F.lit("1940-01-01").cast("date"), (k % 20000).cast("int")))
    customers = table(spark, sf_dir, "customer")
    members = customers.select(k.alias("id"), F.col("c_name").alias("family"), F.col("c_mktsegment").alias("given"), born.alias("birth_date"), F.when(k % 2 == 0, "female").otherwise("male").alias("gender"))
    more = customers.filter(k % 5 == 0).select(k.alias("id"), F.explode(F.when(k % 10 == 0, F.array(F.lit("pbm"), F.lit("card"))).otherwise(F.array(F.lit("pbm")))).alias("system"), (k * 3).alias("value"))
    return resources.patients(members, more)


_PATIENT = View("Patient", [Select([
    Col("id", this().resource_key()), Col("family", path("name").first().get("family")), Col("given", path("name").first().get("given").first()), Col("gender", path("gender")), Col("birth_date", path("birthDate")),
    Col("absent", path("_birthDate").extension("data-absent-reason").get("valueCode")), Col("identifiers", path("identifier.value").join(",")),
])])
_PATIENT_SQL = """SELECT c_custkey::VARCHAR AS id, c_name AS family, c_mktsegment AS given, CASE WHEN c_custkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender,
    CASE WHEN c_custkey % 7 <> 0 THEN strftime(DATE '1940-01-01' + (c_custkey % 20000)::INT, '%Y-%m-%d') END AS birth_date, CASE WHEN c_custkey % 7 = 0 THEN 'unknown' END AS absent,
    concat_ws(',', c_custkey, CASE WHEN c_custkey % 10 = 0 THEN (c_custkey * 3)::VARCHAR END, CASE WHEN c_custkey % 5 = 0 THEN (c_custkey * 3)::VARCHAR END) AS identifiers FROM customer"""


@query("r01_patients", _PATIENT_SQL)
def r01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(_patients(spark, sf_dir), _PATIENT)


def _coverages(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    spans = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.min(day).alias("valid_from"), F.max(day).alias("last"))
    spans = spans.select("id", F.col("id").alias("member_id"), F.concat(F.lit("plan"), (F.col("id") % 4).cast("string")).alias("plan"), "valid_from", F.when(F.col("last") < F.lit("2001-06-01").cast("date"), F.col("last")).alias("valid_to"))
    return resources.coverages(spans, spark.createDataFrame([("plan0", "base"), ("plan1", "silver"), ("plan2", "gold")], "plan string, label string"))


_COVERAGE = View("Coverage", [Select([
    Col("id", path("id")), Col("member_id", path("beneficiary").reference_key("Patient")), Col("status", path("status")), Col("start", path("period.start")), Col("until", path("period.end")),
    Col("plan", path("class.type.coding.code")), Col("label", path("class.name")),
])])
_COVERAGE_SQL = """SELECT o_custkey::VARCHAR AS id, o_custkey::VARCHAR AS member_id, CASE WHEN max(o_orderdate)::DATE < DATE '2001-06-01' THEN 'cancelled' ELSE 'active' END AS status, strftime(min(o_orderdate), '%Y-%m-%d') AS start,
    CASE WHEN max(o_orderdate)::DATE < DATE '2001-06-01' THEN strftime(max(o_orderdate), '%Y-%m-%d') END AS until, 'plan' || o_custkey % 4 AS plan, ([ 'base', 'silver', 'gold', NULL ])[o_custkey % 4 + 1] AS label FROM orders GROUP BY o_custkey"""


@query("r02_coverages", _COVERAGE_SQL)
def r02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(_coverages(spark, sf_dir), _COVERAGE)


def _organizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resources.organizations("The Payer", table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")))


_ORGANIZATION = View("Organization", [Select([Col("id", path("id")), Col("name", path("name")), Col("kind", path("type.coding.code")), Col("active", path("active"), "boolean")])])
_ORGANIZATION_SQL = "SELECT 'payer-1' AS id, 'The Payer' AS name, 'payer' AS kind, true AS active UNION ALL SELECT 'prov-' || s_suppkey, s_name, 'prov', true FROM supplier UNION ALL SELECT 'pharm-' || n_nationkey, n_name, 'pharm', true FROM nation"


@query("r03_organizations", _ORGANIZATION_SQL)
def r03(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(_organizations(spark, sf_dir), _ORGANIZATION)


def _benefits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as claims, their lines as items and, by part, diagnoses; events of one type as pharmacy claims."""
    k = F.col("o_orderkey")
    kind = F.when(k % 3 == 0, "inpatient").when(k % 3 == 1, "outpatient").otherwise("professional")
    day = F.col("o_orderdate").cast("date")
    claims = table(spark, sf_dir, "orders").select(k.alias("id"), F.col("o_custkey").alias("member_id"), F.concat(F.lit("prov-"), (F.col("o_custkey") % 10 + 1).cast("string")).alias("provider_id"), kind.alias("type"), F.lit("active").alias("status"), day.alias("created"), F.col("o_totalprice").alias("total"), F.when(k % 6 == 0, F.date_sub(day, 2)).alias("admitted"))
    lines = table(spark, sf_dir, "lineitem")
    items = lines.select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), F.col("l_partkey").cast("string").alias("product"), F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("net"))
    causes = lines.filter("l_linenumber <= 3").groupBy(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("sequence")).agg(F.concat(F.lit("D"), F.min(F.col("l_partkey") % 100).cast("string")).alias("code"))
    events = table(spark, sf_dir, "events").filter("event_type = 'purchase'")
    filled = events.select(F.col("event_id").alias("id"), F.col("user_id").alias("member_id"), F.concat(F.lit("N"), (F.col("event_id") % 50).cast("string")).alias("product"), F.lit(1.0).alias("quantity"), F.col("value").cast("double").alias("net"), F.col("ts").cast("date").alias("created"))
    return resources.benefits(claims, items, causes, filled)


_coding = path("coding").first()
_SUMMARY = View("ExplanationOfBenefit", [Select([
    Col("id", path("id")), Col("profile", path("meta.profile").first()), Col("type", path("type.coding").first().get("code")), Col("member_id", path("patient").reference_key("Patient")), Col("provider_id", path("provider").reference_key()),
    Col("created", path("created")), Col("total", path("total.amount.value").first(), "double"), Col("items", path("item").count()), Col("diagnoses", path("diagnosis").count()), Col("admitted", path("supportingInfo").filter(lambda s: s.path("category.coding.code").compare("=", constant("admission"))).get("timingDate")),
])])
_SUMMARY_SQL = """
    WITH i AS (SELECT l_orderkey AS k, count(*) AS items, count(DISTINCT l_linenumber) FILTER (WHERE l_linenumber <= 3) AS diagnoses FROM lineitem GROUP BY 1)
    SELECT o_orderkey::VARCHAR AS id, ([ 'eob-inpatient', 'eob-outpatient', 'eob-base' ])[o_orderkey % 3 + 1] AS profile, ([ 'inpatient', 'outpatient', 'professional' ])[o_orderkey % 3 + 1] AS type, o_custkey::VARCHAR AS member_id, 'prov-' || (o_custkey % 10 + 1) AS provider_id,
           strftime(o_orderdate, '%Y-%m-%d') AS created, o_totalprice AS total, coalesce(items, 0)::INT AS items, coalesce(diagnoses, 0)::INT AS diagnoses, CASE WHEN o_orderkey % 6 = 0 THEN strftime(o_orderdate::DATE - 2, '%Y-%m-%d') END AS admitted FROM orders LEFT JOIN i ON k = o_orderkey
    UNION ALL SELECT 'rx-' || event_id, 'eob-pharmacy', 'pharmacy', user_id::VARCHAR, NULL, strftime(ts, '%Y-%m-%d'), value::DOUBLE, 1, 0, NULL FROM events WHERE event_type = 'purchase'"""


@query("r04_benefit_summary", _SUMMARY_SQL)
def r04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(_benefits(spark, sf_dir), _SUMMARY)


_CODES = View("ExplanationOfBenefit", [Select([Col("id", path("id")), Col("on_date", path("created"))], union_all=[
    Select([Col("role", constant("diagnosis")), Col("system", path("diagnosisCodeableConcept.coding").first().get("system")), Col("code", path("diagnosisCodeableConcept.coding").first().get("code"))], for_each=path("diagnosis")),
    Select([Col("role", constant("product")), Col("system", path("productOrService.coding").first().get("system")), Col("code", path("productOrService.coding").first().get("code"))], for_each=path("item")),
])])
_CODES_SQL = """
    SELECT l_orderkey::VARCHAR AS id, strftime(o_orderdate, '%Y-%m-%d') AS on_date, 'diagnosis' AS role, 'icd' AS system, 'D' || min(l_partkey % 100) AS code FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_linenumber <= 3 GROUP BY l_orderkey, o_orderdate, l_linenumber
    UNION ALL SELECT l_orderkey::VARCHAR, strftime(o_orderdate, '%Y-%m-%d'), 'product', 'product', l_partkey::VARCHAR FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    UNION ALL SELECT 'rx-' || event_id, strftime(ts, '%Y-%m-%d'), 'product', 'product', 'N' || event_id % 50 FROM events WHERE event_type = 'purchase'"""


@query("v18_benefit_codes", _CODES_SQL)
def v18_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(_benefits(spark, sf_dir), _CODES)


def _authorizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    decision = F.when(F.col("o_orderstatus") == "F", "approve").when(F.col("o_orderstatus") == "P", "deny")
    rows = table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("member_id"), F.concat(F.lit("prov-"), (F.col("o_custkey") % 10 + 1).cast("string")).alias("provider_id"), F.col("o_orderpriority").alias("service"), decision.alias("decision"), F.when(decision.isNotNull(), F.date_add(day, 3)).alias("decided"), day.alias("created"))
    return resources.prior_authorizations(rows)


_AUTHORIZATION = View("ExplanationOfBenefit", [Select([
    Col("id", path("id")), Col("member_id", path("patient").reference_key()), Col("outcome", path("outcome")), Col("decided", path("preAuthDecided")), Col("decision", path("item.adjudication.category.coding.code")),
])], where=[path("use").compare("=", constant("preauthorization"))])
_AUTHORIZATION_SQL = """SELECT 'pa-' || o_orderkey AS id, o_custkey::VARCHAR AS member_id, CASE o_orderstatus WHEN 'F' THEN 'complete' WHEN 'P' THEN 'partial' ELSE 'queued' END AS outcome,
    CASE WHEN o_orderstatus IN ('F', 'P') THEN strftime(o_orderdate::DATE + 3, '%Y-%m-%d') END AS decided, CASE o_orderstatus WHEN 'F' THEN 'approve' WHEN 'P' THEN 'deny' END AS decision FROM orders WHERE o_orderpriority = '1-URGENT'"""


@query("r05_prior_authorizations", _AUTHORIZATION_SQL)
def r05(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(_authorizations(spark, sf_dir), _AUTHORIZATION)


@query("r07_consents", "SELECT c_custkey::VARCHAR AS id, c_custkey::VARCHAR AS member_id, '2000-01-01' AS start, strftime(DATE '2000-01-01' + (c_custkey % 500)::INT, '%Y-%m-%d') AS until FROM customer WHERE c_acctbal < 0")
def r07(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.lit("2000-01-01").cast("date")
    out = table(spark, sf_dir, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("id"), F.col("c_custkey").alias("member_id"), start.alias("start"), F.date_add(start, (F.col("c_custkey") % 500 + 1).cast("int")).alias("until"))
    view = View("Consent", [Select([Col("id", path("id")), Col("member_id", path("patient").reference_key()), Col("start", path("provision.period.start")), Col("until", path("provision.period.end"))])])
    return _read(resources.consents(out), view)


def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    return resources.attribution_groups(customers.select((F.col("c_custkey") % 25).alias("provider_id"), F.col("c_custkey").alias("member_id")), customers.filter("c_acctbal < 0").select(F.col("c_custkey").alias("member_id")))


_GROUP_SQL = "SELECT (c_custkey % 25)::VARCHAR AS id, count(*) FILTER (WHERE c_acctbal >= 0)::INT AS quantity, count(*) FILTER (WHERE c_acctbal < 0) AS opted_out, string_agg(c_custkey::VARCHAR, ',' ORDER BY c_custkey) FILTER (WHERE c_acctbal >= 0) AS members FROM customer GROUP BY c_custkey % 25"


@query("r08_groups", _GROUP_SQL)
def r08(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = View("Group", [Select([Col("id", path("id")), Col("quantity", path("quantity"), "int"), Col("opted_out", path("extension.valueInteger"), "bigint"), Col("members", lambda c: F.array_join(F.transform(path("member.entity.reference").texts()(c), lambda t: F.regexp_replace(t, "^.*/", "")), ","))])])
    return _read(_groups(spark, sf_dir), view)


# --- checks over them

_SUITE = ("patients", "coverages", "organizations", "benefit summaries", "benefit codes", "prior authorizations", "claim items of medical claims", "groups")


def _sides(spark: SparkSession, sf_dir: str) -> dict[str, tuple[DataFrame, DataFrame]]:
    """For each comparison the rows read back from JSON by a view, and the same rows made from the tables alone."""
    customers, orders, lines = (table(spark, sf_dir, t) for t in ("customer", "orders", "lineitem"))
    items = View("ExplanationOfBenefit", [Select([Col("id", path("id"))], select=[Select([Col("line", path("sequence"), "int"), Col("product", path("productOrService.coding").first().get("code")), Col("net", path("net.value"), "double")], for_each=path("item"))])], where=[views.negated(path("type.coding.code").compare("=", constant("pharmacy")))])
    made = _benefits(spark, sf_dir)
    key = F.col("o_custkey").cast("string")
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return {
        "patients": (_read(_patients(spark, sf_dir), _PATIENT).select("id", "family", "given"), customers.select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("family"), F.col("c_mktsegment").alias("given"))),
        "coverages": (_read(_coverages(spark, sf_dir), _COVERAGE).select("id", "start"), orders.groupBy(key.alias("id")).agg(day(F.min("o_orderdate")).alias("start"))),
        "organizations": (_read(_organizations(spark, sf_dir), _ORGANIZATION).filter("kind = 'prov'").select("id", "name"), table(spark, sf_dir, "supplier").select(F.concat(F.lit("prov-"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_name").alias("name"))),
        "benefit summaries": (_read(made, _SUMMARY).filter("type <> 'pharmacy'").select("id", "member_id", "total"), orders.select(F.col("o_orderkey").cast("string").alias("id"), key.alias("member_id"), F.col("o_totalprice").alias("total"))),
        "benefit codes": (_read(made, _CODES).filter("role = 'product' AND code NOT LIKE 'N%'").select("id", "code"), lines.select(F.col("l_orderkey").cast("string").alias("id"), F.col("l_partkey").cast("string").alias("code"))),
        "prior authorizations": (_read(_authorizations(spark, sf_dir), _AUTHORIZATION).select("id", "member_id"), orders.filter("o_orderpriority = '1-URGENT'").select(F.concat(F.lit("pa-"), F.col("o_orderkey").cast("string")).alias("id"), key.alias("member_id"))),
        "claim items of medical claims": (_read(made, items), lines.select(F.col("l_orderkey").cast("string").alias("id"), F.col("l_linenumber").alias("line"), F.col("l_partkey").cast("string").alias("product"), F.col("l_extendedprice").alias("net"))),
        "groups": (r08(spark, sf_dir).select("id", "quantity"), customers.groupBy((F.col("c_custkey") % 25).cast("string").alias("id")).agg(F.count_if(F.col("c_acctbal") >= 0).cast("int").alias("quantity"))),
    }


_ALTERED = {"patients": "c_custkey", "benefit summaries": "o_orderkey", "claim items of medical claims": "l_orderkey"}
_PARITY_SQL = """
    WITH n AS (SELECT 'patients' AS comparison, (SELECT count(*) FROM customer WHERE c_custkey % 100 = 0) AS n_rows FROM range(1) UNION ALL SELECT 'coverages', 0 UNION ALL SELECT 'organizations', 0
    UNION ALL SELECT 'benefit summaries', (SELECT count(*) FROM orders WHERE o_orderkey % 100 = 0) UNION ALL SELECT 'benefit codes', 0 UNION ALL SELECT 'prior authorizations', 0
    UNION ALL SELECT 'claim items of medical claims', (SELECT count(*) FROM lineitem WHERE l_orderkey % 100 = 0) UNION ALL SELECT 'groups', 0) SELECT comparison, n_rows AS only_view, n_rows AS only_tables FROM n"""


@query("q04_parity_suite", _PARITY_SQL)
def q04_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight comparisons of views with tables, both ways. In three of them every hundredth key of the tables' side is altered, and just those rows must show."""
    sides = _sides(spark, sf_dir)
    for name in _ALTERED:
        a, b = sides[name]
        changed = b.columns[-1]
        other = F.concat(F.col(changed).cast("string"), F.lit("!")) if dict(b.dtypes)[changed] == "string" else -F.col(changed) - 1
        sides[name] = a, b.withColumn(changed, F.when(F.col("id").cast("long") % 100 == 0, other).otherwise(F.col(changed)))
    return quality.parity(sides).select("comparison", F.col("only_a").alias("only_view"), F.col("only_b").alias("only_tables"))


@query("q05_references", """SELECT 'ExplanationOfBenefit/' || o_orderkey AS source, 'Patient' AS kind, o_custkey::VARCHAR AS target FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 9 <> 0)
    UNION ALL SELECT 'ExplanationOfBenefit/rx-' || event_id, 'Patient', user_id::VARCHAR FROM events WHERE event_type = 'purchase' AND user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 9 <> 0)
    UNION ALL SELECT 'ExplanationOfBenefit/' || o_orderkey, 'Organization', 'prov-' || (o_custkey % 10 + 1) FROM orders WHERE o_custkey % 10 + 1 NOT IN (SELECT s_suppkey FROM supplier)""")
def q05(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References of benefits that lead nowhere, where every ninth patient has been left out."""
    read = _read(_benefits(spark, sf_dir), _SUMMARY).select(F.concat(F.lit("ExplanationOfBenefit/"), F.col("id")).alias("source"), F.explode(F.array(F.struct(F.lit("Patient").alias("kind"), F.col("member_id").alias("target")), F.struct(F.lit("Organization").alias("kind"), F.col("provider_id").alias("target")))).alias("r"))
    there = _read(_patients(spark, sf_dir), _PATIENT).filter("CAST(id AS long) % 9 <> 0").select(F.lit("Patient").alias("kind"), "id").unionByName(_read(_organizations(spark, sf_dir), _ORGANIZATION).select(F.lit("Organization").alias("kind"), "id"))
    return quality.unresolved_references(read.select("source", "r.kind", "r.target"), there)


@query("q06_redaction_problems", """SELECT l_orderkey AS id, 'holds net' AS problem FROM lineitem WHERE l_orderkey % 50 = 0 GROUP BY 1 UNION ALL SELECT l_orderkey, 'lost items' FROM lineitem WHERE l_orderkey % 70 = 0 GROUP BY 1""")
def q06(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims without amounts, but for every fiftieth, which keeps its items' amounts, and every seventieth, which has lost its items."""
    lines = table(spark, sf_dir, "lineitem")
    heads = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").cast("string").alias("member"), F.lit("the net total").alias("status"), F.col("o_orderdate").cast("date").cast("string").alias("created"), F.col("o_totalprice").alias("total"))
    claims = resources.claim_resources(heads, lines.select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), F.col("l_partkey").cast("string").alias("product"), F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("net")))
    full = resources.as_json(claims, "claim").withColumnRenamed("claim", "resource")
    bare = resources.as_json(resources.redact_claims(claims), "claim").withColumnRenamed("claim", "resource").withColumn("resource", F.when(F.col("id") % 70 == 0, F.regexp_replace("resource", '"item"', '"gone"')).otherwise(F.col("resource")))
    faulty = bare.filter("id % 50 <> 0").unionByName(resources.as_json(claims.filter("id % 50 = 0").select("id", F.col("claim").dropFields("total").alias("claim")), "claim").withColumnRenamed("claim", "resource").withColumn("resource", F.when(F.col("id") % 70 == 0, F.regexp_replace("resource", '"item"', '"gone"')).otherwise(F.col("resource"))))
    return quality.leaked_members(faulty, full, "id", ["net", "total"], {"items": "$.item"})


@query(
    "q07_terminology",
    f"""WITH c AS (SELECT DISTINCT system, code, on_date::DATE AS on_date FROM ({_CODES_SQL})),
        ref AS (SELECT 'icd' AS system, 'D' || i AS code, DATE '1992-01-01' AS a, CASE WHEN i % 3 = 0 THEN DATE '1996-12-31' END AS b, i % 4 <> 0 AS billable FROM range(90) t(i) UNION ALL SELECT 'icd', 'D' || i, DATE '1999-01-01', NULL, true FROM range(0, 90, 3) t(i)),
        v AS (SELECT c.system, c.code, on_date, count(a) AS versions, count(*) FILTER (WHERE a <= on_date AND (b IS NULL OR b >= on_date)) AS holding, count(*) FILTER (WHERE a <= on_date AND (b IS NULL OR b >= on_date) AND billable) AS billing FROM c LEFT JOIN ref ON c.system = ref.system AND c.code = ref.code GROUP BY 1, 2, 3),
        r AS (SELECT *, CASE WHEN system <> 'icd' THEN 'no reference' WHEN versions = 0 THEN 'unknown code' WHEN holding = 0 THEN 'not in force' WHEN billing = 0 THEN 'not billable' ELSE 'in force' END AS reason FROM v)
        SELECT system, CASE reason WHEN 'in force' THEN 'valid' WHEN 'no reference' THEN 'unverified' ELSE 'invalid' END AS status, reason, count(*) AS codes FROM r GROUP BY ALL""",
)
def q07(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = _read(_benefits(spark, sf_dir), _CODES).select("system", "code", F.col("on_date").cast("date").alias("on_date"))
    day = lambda s: F.lit(s).cast("date")
    i = F.col("id")
    row = lambda df, a, b, billable: df.select(F.lit("icd").alias("system"), F.concat(F.lit("D"), i.cast("string")).alias("code"), a.alias("valid_from"), b.alias("valid_to"), billable.alias("billable"))
    reference = row(spark.range(90), day("1992-01-01"), F.when(i % 3 == 0, day("1996-12-31")), i % 4 != 0).unionByName(row(spark.range(0, 90, 3), day("1999-01-01"), F.lit(None).cast("date"), F.lit(True)))
    return quality.check_codes(codes, reference).groupBy("system", "status", "reason").agg(F.count(F.lit(1)).alias("codes"))
