"""Registered queries of whole explanations of benefit: orders as claims of four types, purchases as pharmacy claims; each document is read back from its JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import benefits
from millrace.plans.registry import query
from millrace.sources.files import table


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    claims = table(spark, sf_dir, "orders").select(
        k.alias("id"), F.element_at(F.array(*map(F.lit, ("inpatient", "outpatient", "professional", "pharmacy"))), (k % 4 + 1).cast("int")).alias("type"), F.when(k % 5 == 0, "out").otherwise("in").alias("network"),
        F.when(F.col("o_orderstatus") == "F", "paid").when(F.col("o_orderstatus") == "O", "pending").otherwise("void").alias("status"), F.col("o_custkey").alias("member_id"), F.concat(F.lit("prov-"), (F.col("o_custkey") % 10).cast("string")).alias("provider_id"),
        F.col("o_custkey").alias("coverage_id"), day.alias("served_from"), F.date_add(day, (k % 7).cast("int")).alias("served_to"), F.date_add(day, 2).alias("received"), F.when(F.col("o_orderstatus") != "O", F.date_add(day, 10)).alias("adjudicated"),
        day.cast("timestamp").alias("updated"), F.col("o_totalprice").alias("charged"), (F.col("o_totalprice") - 2).alias("paid"), F.when(k % 4 == 2, "11").alias("place"), (k % 30).alias("days_supply"), (k % 3).cast("string").alias("daw"),
        (k % 4).alias("refill"), (k % 6).alias("refills_authorized"),
    )
    part = F.col("l_partkey")
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), F.concat(F.lit("P"), part.cast("string")).alias("procedure"), F.concat(F.lit("N"), part.cast("string")).alias("drug"), F.concat(F.lit("D"), (part % 100).cast("string")).alias("diagnosis"),
        F.when(F.col("l_suppkey") % 3 != 0, (F.col("l_suppkey") % 1000).cast("string")).alias("revenue"), F.col("l_quantity").cast("long").alias("units"), F.col("l_extendedprice").alias("charged"), F.when(part % 10 != 0, F.col("l_extendedprice") - 1).alias("paid"),
    )
    e = F.col("event_id")
    pharmacy = table(spark, sf_dir, "events").filter("event_type = 'purchase'").select(
        F.concat(F.lit("rx-"), e.cast("string")).alias("id"), F.col("user_id").alias("member_id"), F.concat(F.lit("pharm-"), (e % 9).cast("string")).alias("pharmacy_id"), F.col("user_id").alias("coverage_id"), (e % 11 == 0).alias("reversed"),
        F.when(e % 5 == 0, "out").otherwise("in").alias("network"), F.col("ts").cast("date").alias("filled"), F.col("ts").cast("timestamp").alias("processed"), F.concat(F.lit("N"), (e % 50).cast("string")).alias("drug"), (e % 90).alias("quantity"),
        (e % 1000 / 4).alias("cost"), (e % 800 / 8).alias("plan_paid"), (e % 40 / 2).alias("patient_pay"), (e % 30).alias("days_supply"), (e % 3).cast("string").alias("daw"), (e % 4).alias("refill"), (e % 6).alias("refills_authorized"),
    )
    return benefits.benefit_documents(claims, lines, pharmacy)


def _mills(c: Column) -> Column:
    """Thousandths of an amount, as text."""
    return F.round(c * 1000).cast("long").cast("string")


def _code(c: Column) -> Column:
    return c["coding"][0]["code"]


#: Members that the columns are made of; the others are passed over as the JSON is read.
_TOLD = (
    "id", "meta.profile", "meta.lastUpdated", "identifier.system", "status", "type.coding.code", "subType.coding.code", "patient.reference", "billablePeriod", "created", "provider.reference", "outcome", "insurance.coverage.reference",
    "supportingInfo.category.coding.code", "supportingInfo.valueQuantity", "supportingInfo.code.coding.code", "supportingInfo.timingPeriod", "adjudication.category.coding.code", "adjudication.reason.coding.code", "adjudication.amount.value",
    "item.sequence", "item.productOrService.coding.code", "item.revenue.coding.code", "item.locationCodeableConcept.coding.code", "item.servicedDate", "item.quantity", "item.net.value", "item.adjudication.category.coding.code",
    "item.adjudication.reason.coding.code", "item.adjudication.amount.value", "diagnosis.sequence", "diagnosis.diagnosisCodeableConcept.coding.code", "diagnosis.type.coding.code", "text.div", "total.amount.value", "payment.amount.value",
)


def _only(kind: T.DataType, paths: Sequence[str]) -> T.DataType:
    """A nested type with only the members that paths lead to; lists are gone through."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_only(kind.elementType, paths))
    if not isinstance(kind, T.StructType) or "" in paths:
        return kind
    below = {f: [p.partition(".")[2] for p in paths if p.partition(".")[0] == f.name] for f in kind.fields}
    return T.StructType([T.StructField(f.name, _only(f.dataType, under)) for f, under in below.items() if under])


def _told(documents: DataFrame, amounts: bool) -> DataFrame:
    """Every part of the documents as columns, read back from their JSON."""
    schema = _only(documents.schema["document"].dataType, _TOLD)
    d = F.col("d")
    dash = lambda c: F.coalesce(c.cast("string"), F.lit("-"))
    adjudications = lambda a: F.array_join(F.transform(a, lambda x: F.concat(_code(x["category"]), F.lit("="), F.coalesce(_mills(x["amount"]["value"]) if amounts else F.lit(None).cast("string"), _code(x["reason"])))), "+")
    net = lambda x: _mills(x["net"]["value"]) if amounts else F.lit("-")
    item = lambda x: F.concat_ws(":", x["sequence"].cast("string"), _code(x["productOrService"]), dash(_code(x["revenue"])), dash(_code(x["locationCodeableConcept"])), x["servicedDate"], x["quantity"]["value"].cast("string"), net(x), dash(adjudications(x["adjudication"])))
    cause = lambda x: F.concat_ws(":", x["sequence"].cast("string"), _code(x["diagnosisCodeableConcept"]), dash(_code(x["type"][0])))
    info = lambda x: F.concat_ws("=", _code(x["category"]), F.coalesce(x["valueQuantity"]["value"].cast("string"), _code(x["code"]), F.concat_ws("/", x["timingPeriod"]["start"], x["timingPeriod"]["end"])))
    read = documents.select(F.explode(F.array(F.from_json(F.to_json("document"), schema))).alias("d"))
    columns = {
        "id": d["id"], "profile": d["meta"]["profile"][0], "updated": d["meta"]["lastUpdated"], "system": d["identifier"][0]["system"], "status": d["status"], "type": _code(d["type"]), "sub_type": _code(d["subType"]), "patient": d["patient"]["reference"],
        "period": F.concat_ws("/", d["billablePeriod"]["start"], d["billablePeriod"]["end"]), "created": d["created"], "provider": d["provider"]["reference"], "outcome": d["outcome"], "coverage": d["insurance"][0]["coverage"]["reference"],
        "info": F.array_join(F.transform(d["supportingInfo"], info), ";"), "adjudication": adjudications(d["adjudication"]), "items": F.array_join(F.transform(d["item"], item), ";"), "diagnoses": F.array_join(F.transform(d["diagnosis"], cause), ";"),
        "told": F.regexp_count(d["text"]["div"], F.lit("USD")).cast("int"),
    }
    if amounts:
        columns |= {"total": _mills(d["total"][0]["amount"]["value"]), "payment": _mills(d["payment"]["amount"]["value"])}
    return read.select(*(c.alias(name) for name, c in columns.items()))


def _sql(amounts: bool) -> str:
    """The same columns worked out from the tables."""
    basis = "" if amounts else " || '-basis'"
    mills = lambda x: f"round(({x}) * 1000)::BIGINT::VARCHAR"
    status = "'benefitpaymentstatus=' || CASE WHEN {k} % 5 = 0 THEN 'outofnetwork' ELSE 'innetwork' END"
    line_amounts = f"'submitted=' || {mills('l_extendedprice')} || '+benefit=' || {mills('CASE WHEN l_partkey % 10 <> 0 THEN l_extendedprice - 1 ELSE 0 END')}"
    per_line = f"{line_amounts} || CASE WHEN k % 4 = 2 THEN '+' || {status.format(k='k')} ELSE '' END" if amounts else f"CASE WHEN k % 4 = 2 THEN {status.format(k='k')} ELSE '-' END"
    net = lambda x: mills(x) if amounts else "'-'"
    dispensed = lambda k: f"'dayssupply=' || {k} % 30 || ';dawcode=' || {k} % 3 || ';refillnum=' || {k} % 4 || ';refillsauthorized=' || {k} % 6"
    rx_amounts = f"'submitted=' || {mills('event_id % 1000 / 4')} || '+benefit=' || {mills('event_id % 800 / 8')} || '+paidbypatient=' || {mills('event_id % 40 / 2')}" if amounts else "'-'"
    money = lambda a, b: f", {mills(a)} AS total, {mills(b)} AS payment" if amounts else ""
    told = lambda n: n if amounts else 0
    order = "ORDER BY l_linenumber, 'P' || l_partkey, l_suppkey % 3 <> 0, revenue, l_quantity::BIGINT, l_extendedprice"
    return f"""WITH o AS (SELECT *, o_orderkey AS k, o_orderdate::DATE AS day, ([ 'inpatient', 'outpatient', 'professional', 'pharmacy' ])[o_orderkey % 4 + 1] AS kind FROM orders),
        l AS (SELECT *, CASE WHEN l_suppkey % 3 <> 0 THEN (l_suppkey % 1000)::VARCHAR END AS revenue, row_number() OVER (PARTITION BY l_orderkey {order.replace(", revenue", ", CASE WHEN l_suppkey % 3 <> 0 THEN (l_suppkey % 1000)::VARCHAR END")}) AS nth FROM lineitem JOIN o ON l_orderkey = k),
        g AS (SELECT k, string_agg(l_linenumber || ':' || CASE WHEN kind = 'pharmacy' THEN 'N' ELSE 'P' END || l_partkey || ':' || coalesce(revenue, '-') || ':' || CASE WHEN k % 4 = 2 THEN '11' ELSE '-' END || ':' || strftime(day, '%Y-%m-%d') || ':' || l_quantity::BIGINT || ':' || {net('l_extendedprice')} || ':' || {per_line}, ';' ORDER BY nth) AS items,
            string_agg(l_linenumber || ':D' || l_partkey % 100 || ':' || CASE WHEN kind = 'pharmacy' THEN '-' WHEN nth = 1 THEN 'principal' WHEN kind = 'professional' THEN 'secondary' ELSE 'other' END, ';' ORDER BY nth) AS diagnoses FROM l GROUP BY k)
    SELECT o.k::VARCHAR AS id, 'eob-' || kind{basis} AS profile, strftime(day, '%Y-%m-%dT00:00:00Z') AS updated, 'https://payer.example/claim-id' AS system, CASE WHEN o_orderstatus = 'P' THEN 'cancelled' ELSE 'active' END AS status, CASE WHEN k % 4 < 2 THEN 'institutional' ELSE kind END AS type, CASE WHEN k % 4 < 2 THEN kind END AS sub_type,
        'Patient/' || o_custkey AS patient, strftime(day, '%Y-%m-%d') || '/' || strftime(day + (k % 7)::INT, '%Y-%m-%d') AS period, strftime(CASE WHEN o_orderstatus = 'O' THEN day + 2 ELSE day + 10 END, '%Y-%m-%d') AS created, 'Organization/prov-' || o_custkey % 10 AS provider, CASE WHEN o_orderstatus = 'O' THEN 'queued' ELSE 'complete' END AS outcome,
        'Coverage/cov-' || o_custkey AS coverage, CASE kind WHEN 'pharmacy' THEN {dispensed('k')} WHEN 'inpatient' THEN 'admissionperiod=' || strftime(day, '%Y-%m-%d') || '/' || strftime(day + (k % 7)::INT, '%Y-%m-%d') END AS info, CASE WHEN kind <> 'professional' THEN {status.format(k='k')} END AS adjudication, items, diagnoses, {told(2)} AS told{money('o_totalprice', 'o_totalprice - 2')}
    FROM o LEFT JOIN g USING (k)
    UNION ALL SELECT 'rx-' || event_id, 'eob-pharmacy'{basis}, strftime(ts, '%Y-%m-%dT%H:%M:%SZ'), 'https://pbm.example/rx-claim-id', CASE WHEN event_id % 11 = 0 THEN 'cancelled' ELSE 'active' END, 'pharmacy', NULL, 'Patient/' || user_id, strftime(ts, '%Y-%m-%d') || '/' || strftime(ts, '%Y-%m-%d'), strftime(ts, '%Y-%m-%d'), 'Organization/pharm-' || event_id % 9, 'complete',
        'Coverage/cov-' || user_id, {dispensed('event_id')}, {status.format(k='event_id')}, '1:N' || event_id % 50 || ':-:-:' || strftime(ts, '%Y-%m-%d') || ':' || event_id % 90 || ':' || {net('event_id % 1000 / 4')} || ':' || {rx_amounts}, NULL, {told(1)}{money('event_id % 1000 / 4', 'event_id % 800 / 8')} FROM events WHERE event_type = 'purchase'"""


@query("r04_benefit_documents", _sql(True))
def r04_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _told(documents(spark, sf_dir), True)


@query("r06_documents_without_amounts", _sql(False))
def r06_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents patched, not made anew."""
    return _told(benefits.without_amounts(documents(spark, sf_dir)), False)
