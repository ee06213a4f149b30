"""Explanations of benefit as whole documents: claims of four types and pharmacy claims, with adjudication, insurance, payment and supporting information, and
the same documents without amounts, derived from them by a patch."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.relational import stack
from millrace.operators.resources import coded, reference, text_narrative

# Public code systems and the codes taken from them.
C4BB = "http://hl7.org/fhir/us/carin-bb/CodeSystem/"
HL7 = "http://terminology.hl7.org/CodeSystem/"
ADJUDICATION, PAYER_STATUS = f"{HL7}adjudication", f"{C4BB}C4BBPayerAdjudicationStatus"
STATUS_CATEGORY, PAID_BY_PATIENT = f"{C4BB}C4BBAdjudicationDiscriminator", f"{C4BB}C4BBAdjudication"
SUPPORT, DRUG, PROCEDURE = f"{C4BB}C4BBSupportingInfoType", "http://hl7.org/fhir/sid/ndc", "http://www.ama-assn.org/go/cpt"
REVENUE, PLACE = "https://www.nubc.org/CodeSystem/RevenueCodes", "https://www.cms.gov/Medicare/Coding/place-of-service-codes/Place_of_Service_Code_Set"
AS_WRITTEN = f"{HL7}NCPDPDispensedAsWrittenOrProductSelectionCode"
PROFILES = {"professional": "eob-professional", "inpatient": "eob-inpatient", "outpatient": "eob-outpatient", "pharmacy": "eob-pharmacy"}

_MONEY = "struct<value:double,currency:string>"
_CODED = "struct<coding:array<struct<system:string,code:string>>>"


def money(value: Column) -> Column:
    """An amount with its currency; null without a value."""
    return F.when(value.isNotNull(), F.struct(value.cast("double").alias("value"), F.lit("USD").alias("currency")))


def _day(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def _adjudicated(category: tuple[str, str], amount: Column | None = None, reason: Column | None = None) -> Column:
    """An adjudication: a category, with an amount or a reason."""
    none = F.lit(None)
    return F.struct(coded(category[0], F.lit(category[1])).alias("category"), (none.cast(_CODED) if reason is None else reason).alias("reason"), (none.cast(_MONEY) if amount is None else amount).alias("amount"))


def _payment_status(network: Column) -> Column:
    """Under which network status a claim was paid; it has no amount."""
    return _adjudicated((STATUS_CATEGORY, "benefitpaymentstatus"), reason=coded(PAYER_STATUS, F.when(network == "in", "innetwork").otherwise("outofnetwork")))


def _information(sequence: int, kind: str, quantity: Column | None = None, code: Column | None = None, period: tuple[Column, Column] | None = None) -> Column:
    none = F.lit(None)
    return F.struct(
        F.lit(sequence).alias("sequence"), coded(SUPPORT, F.lit(kind)).alias("category"), (none.cast("struct<value:long>") if quantity is None else F.struct(quantity.cast("long").alias("value"))).alias("valueQuantity"),
        (none.cast(_CODED) if code is None else coded(AS_WRITTEN, code)).alias("code"), (none.cast("struct<start:string,end:string>") if period is None else F.struct(_day(period[0]).alias("start"), _day(period[1]).alias("end"))).alias("timingPeriod"),
    )


def _dispensed() -> Column:
    """What a pharmacy claim tells beside its item."""
    return F.array(_information(1, "dayssupply", F.col("days_supply")), _information(2, "dawcode", code=F.col("daw")), _information(3, "refillnum", F.col("refill")), _information(4, "refillsauthorized", F.col("refills_authorized")))


def _item(line: Column, product: Column, revenue: Column, place: Column, served: Column, units: Column, net: Column, diagnosis: Column, adjudication: Column) -> Column:
    return F.struct(
        line.cast("int").alias("sequence"), diagnosis.alias("diagnosisSequence"), coded(REVENUE, revenue).alias("revenue"), product.alias("productOrService"), _day(served).alias("servicedDate"), coded(PLACE, place).alias("locationCodeableConcept"),
        F.struct(units.cast("long").alias("value")).alias("quantity"), money(net).alias("net"), adjudication.alias("adjudication"),
    )


def _document(items: Column, diagnoses: Column, support: Column, header: Column, charged: Column, paid: Column, told: Column) -> Column:
    """The document of a claim whose columns are: id, type, sub_type, system, status, outcome, member_id, provider, served_from, served_to, created, updated, coverage_id."""
    profile = F.coalesce(*(F.when(F.coalesce("sub_type", "type") == kind, F.lit(p)) for kind, p in PROFILES.items()))
    total = F.struct(coded(ADJUDICATION, F.lit("submitted")).alias("category"), money(charged).alias("amount"))
    return F.struct(
        F.lit("ExplanationOfBenefit").alias("resourceType"), F.col("id").cast("string").alias("id"), F.struct(F.date_format("updated", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("lastUpdated"), F.array(profile).alias("profile")).alias("meta"),
        text_narrative(told).alias("text"), F.array(F.struct(F.col("system"), F.col("id").cast("string").alias("value"))).alias("identifier"), F.col("status"), coded(f"{HL7}claim-type", F.col("type")).alias("type"),
        coded(f"{C4BB}C4BBInstitutionalClaimSubType", F.col("sub_type")).alias("subType"), F.lit("claim").alias("use"), reference("Patient", F.col("member_id")).alias("patient"), F.struct(_day(F.col("served_from")).alias("start"), _day(F.col("served_to")).alias("end")).alias("billablePeriod"),
        _day(F.col("created")).alias("created"), reference("Organization", F.lit("payer")).alias("insurer"), reference("Organization", F.col("provider")).alias("provider"), F.col("outcome"), support.alias("supportingInfo"),
        F.array(F.struct(F.lit(True).alias("focal"), reference("Coverage", F.concat(F.lit("cov-"), F.col("coverage_id").cast("string"))).alias("coverage"))).alias("insurance"), diagnoses.alias("diagnosis"), items.alias("item"),
        header.alias("adjudication"), F.array(total).alias("total"), F.struct(money(paid).alias("amount")).alias("payment"),
    )


def benefit_documents(claims: DataFrame, lines: DataFrame, pharmacy: DataFrame) -> DataFrame:
    """id, document (struct) of claims with their lines, and of pharmacy claims, which are an item each.

    claims: id, type (professional, inpatient, outpatient, pharmacy), network (in, out), status (paid, pending, void), member_id, provider_id, coverage_id,
    served_from, served_to, received, adjudicated (null while open), updated, charged, paid, place, days_supply, daw, refill, refills_authorized. lines: id,
    line, procedure, drug, diagnosis, revenue, units, charged, paid (null counts as nothing). pharmacy: id, member_id, pharmacy_id, coverage_id, reversed
    (boolean), network, filled, processed, drug, quantity, cost, plan_paid, patient_pay, days_supply, daw, refill, refills_authorized.

    The first line's diagnosis is the principal one. Professional claims bear the payment status on each item, the others on the claim."""
    kind, institutional = F.col("type"), F.col("type").isin("inpatient", "outpatient")
    professional, drugs = kind == "professional", kind == "pharmacy"
    line = F.struct("line", "procedure", "drug", "diagnosis", "revenue", "units", "charged", "paid")
    gathered = lines.groupBy("id").agg(F.sort_array(F.collect_list(line)).alias("__lines"))

    def item(x: Column) -> Column:
        amounts = F.array(_adjudicated((ADJUDICATION, "submitted"), money(x.charged)), _adjudicated((ADJUDICATION, "benefit"), money(F.coalesce(x.paid, F.lit(0.0)))))
        product = F.when(drugs, coded(DRUG, x.drug)).otherwise(coded(PROCEDURE, x.procedure))
        status = F.array(_payment_status(F.col("network")))
        return _item(x.line, product, x.revenue, F.col("place"), F.col("served_from"), x.units, x.charged, F.array(x.line.cast("int")), F.when(professional, F.concat(amounts, status)).otherwise(amounts))

    def diagnosis(x: Column, k: Column) -> Column:
        other = coded(f"{C4BB}C4BBClaimDiagnosisType", F.when(professional, "secondary").otherwise("other"))
        role = F.when(k == 0, coded(f"{HL7}ex-diagnosistype", F.lit("principal"))).otherwise(other)
        return F.struct(x.line.cast("int").alias("sequence"), coded("http://hl7.org/fhir/sid/icd-10-cm", x.diagnosis).alias("diagnosisCodeableConcept"), F.when(~drugs, F.array(role)).alias("type"))

    made = claims.join(gathered, "id", "left").select(
        "*", F.when(institutional, "institutional").otherwise(kind).alias("__type"), F.when(institutional, kind).alias("sub_type"), F.lit("https://payer.example/claim-id").alias("system"), F.col("provider_id").alias("provider"),
        F.when(F.col("status") == "void", "cancelled").otherwise("active").alias("__status"), F.when(F.col("status") == "pending", "queued").otherwise("complete").alias("outcome"), F.coalesce("adjudicated", "received").alias("created"),
    )
    support = F.when(drugs, _dispensed()).when(kind == "inpatient", F.array(_information(1, "admissionperiod", period=(F.col("served_from"), F.col("served_to")))))
    told = F.concat_ws(", ", F.concat(F.initcap("type"), F.lit(" claim "), F.col("id").cast("string")), F.concat(F.lit("member "), F.col("member_id").cast("string")), F.concat(F.lit("charged "), F.format_number("charged", 2), F.lit(" USD")), F.concat(F.lit("paid "), F.format_number("paid", 2), F.lit(" USD")))
    parts = made.select(
        F.col("id").cast("string").alias("id"), F.col("__type").alias("type"), "sub_type", "system", F.col("__status").alias("status"), "outcome", "member_id", "provider", "served_from", "served_to", "created", "updated", "coverage_id", "charged", "paid",
        F.transform("__lines", item).alias("items"), F.transform("__lines", diagnosis).alias("diagnoses"), support.alias("support"), F.when(~professional, F.array(_payment_status(F.col("network")))).alias("header"), told.alias("told"),
    )
    medical = parts.select("id", _document(F.col("items"), F.col("diagnoses"), F.col("support"), F.col("header"), F.col("charged"), F.col("paid"), F.col("told")).alias("document"))

    amounts = F.array(_adjudicated((ADJUDICATION, "submitted"), money(F.col("cost"))), _adjudicated((ADJUDICATION, "benefit"), money(F.col("plan_paid"))), _adjudicated((PAID_BY_PATIENT, "paidbypatient"), money(F.col("patient_pay"))))
    none = F.lit(None).cast("string")
    one = _item(F.lit(1), coded(DRUG, F.col("drug")), none, none, F.col("filled"), F.col("quantity"), F.col("cost"), F.lit(None).cast("array<int>"), amounts)
    told = F.concat_ws(", ", F.concat(F.lit("Pharmacy claim "), F.col("id")), F.concat(F.lit("member "), F.col("member_id").cast("string")), F.concat(F.lit("plan paid "), F.format_number("plan_paid", 2), F.lit(" USD")))
    filled = pharmacy.withColumn("id", F.col("id").cast("string")).select(
        "id", F.lit("pharmacy").alias("type"), none.alias("sub_type"), F.lit("https://pbm.example/rx-claim-id").alias("system"), F.when(F.col("reversed"), "cancelled").otherwise("active").alias("status"), F.lit("complete").alias("outcome"), "member_id",
        F.col("pharmacy_id").alias("provider"), F.col("filled").alias("served_from"), F.col("filled").alias("served_to"), F.col("processed").alias("created"), F.col("processed").alias("updated"), "coverage_id", F.array(one).alias("items"),
        F.lit(None).cast(medical.schema["document"].dataType["diagnosis"].dataType).alias("diagnoses"), _dispensed().alias("support"), F.array(_payment_status(F.col("network"))).alias("header"), F.col("cost"), F.col("plan_paid"), told.alias("told"),
    )
    dispensed = filled.select("id", _document(F.col("items"), F.col("diagnoses"), F.col("support"), F.col("header"), F.col("cost"), F.col("plan_paid"), F.col("told")).alias("document"))
    return stack(medical, dispensed)


Change = Callable[[Column], Column]


def patched(value: Column, kind: T.DataType, drop: Sequence[str] = (), replace: Mapping[str, Change] | None = None, keep: Mapping[str, Change] | None = None) -> Column:
    """A nested value with members changed by path, at any depth: those of `drop` left out, those of `replace` made anew from their old value, and only those
    items of the lists of `keep` left for which a test holds; a list left without items is null.

    A path is names joined by dots; lists are gone through, so `item.net` is the member `net` of every item. Parts that no path leads into stay as they are.
    A path that leads nowhere is an error."""
    replace, keep = replace or {}, keep or {}
    wanted = {*drop, *replace, *keep}
    met: set[str] = set()

    def walk(v: Column, t: T.DataType, path: str) -> Column:
        met.add(path)
        if path in replace:
            v = replace[path](v)
        if isinstance(t, T.ArrayType):
            inside = any(p.startswith(f"{path}.") for p in wanted)
            items = F.filter(v, keep[path]) if path in keep else v
            items = F.transform(items, lambda x: struct(x, t.elementType, path)) if inside and isinstance(t.elementType, T.StructType) else items
            return F.when(F.exists(v, keep[path]), items) if path in keep else items
        return struct(v, t, path) if isinstance(t, T.StructType) else v

    def struct(v: Column, t: T.StructType, path: str) -> Column:
        if path and not any(p.startswith(f"{path}.") for p in wanted):
            return v
        names = [(f, f"{path}.{f.name}" if path else f.name) for f in t.fields]
        met.update(p for _, p in names)
        return F.when(v.isNotNull(), F.struct(*(walk(v[f.name], f.dataType, p).alias(f.name) for f, p in names if p not in drop)))

    out = walk(value, kind, "")
    if lost := sorted(p for p in wanted if p not in met):
        raise ValueError(f"no such paths: {lost}")
    return out


def without_amounts(documents: DataFrame) -> DataFrame:
    """The documents of `benefit_documents` without financial data: totals, payments, net amounts and every adjudication with an amount go (the payment status
    stays), the profile is the basic one, and the narrative names no amount."""
    amountless = lambda x: x["amount"].isNull()
    d = F.col("document")
    told = F.concat_ws(", ", F.concat(F.initcap(F.coalesce(d["subType"]["coding"][0]["code"], d["type"]["coding"][0]["code"])), F.lit(" claim "), F.col("id")), F.concat(F.lit("member "), F.substring_index(d["patient"]["reference"], "/", -1)), F.lit("no financial data"))
    body = patched(
        d, documents.schema["document"].dataType, drop=["total", "payment", "item.net"], replace={"meta.profile": lambda p: F.transform(p, lambda x: F.concat(x, F.lit("-basis"))), "text": lambda _: text_narrative(told)},
        keep={"adjudication": amountless, "item.adjudication": amountless},
    )
    return documents.select("id", body.alias("document"))
