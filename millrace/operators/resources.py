"""Nested resources as typed structs and JSON text: header and ordered items, redaction, null-free objects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import narrative, ordered_list


def json_object(**members: Column) -> Column:
    """JSON text of an object; null members and empty lists are left out."""
    return F.to_json(F.struct(*(c.alias(name) for name, c in members.items())))


def unless_empty(items: Column) -> Column:
    return F.when(F.size(items) > 0, items)


def identifier(system: str, value: Column) -> Column:
    return F.struct(F.lit(system).alias("system"), value.cast("string").alias("value"))


def text_narrative(c: Column) -> Column:
    return F.struct(F.lit("generated").alias("status"), F.concat(F.lit("<div>"), narrative(c), F.lit("</div>")).alias("div"))


def claim_resources(claims: DataFrame, lines: DataFrame) -> DataFrame:
    """id, claim (struct with its items in line order). claims: id, member, status, created, total; lines: id, line, product, quantity, net."""
    item = F.struct(F.col("line").alias("sequence"), F.col("product"), F.col("quantity"), F.col("net"))
    items = lines.groupBy("id").agg(ordered_list(item, F.col("line")).alias("items"))
    body = F.struct(
        F.lit("ExplanationOfBenefit").alias("resourceType"), F.col("id").cast("string").alias("id"), F.array(identifier("claim", F.col("id"))).alias("identifier"), F.col("status"),
        F.struct(F.concat(F.lit("Patient/"), F.col("member")).alias("reference")).alias("patient"), F.col("created"), unless_empty(F.col("items")).alias("item"), F.struct(F.col("total").alias("value")).alias("total"),
    )
    return claims.join(items, "id", "left").select("id", body.alias("claim"))


def redact_claims(claims: DataFrame, amounts: Sequence[str] = ("net",)) -> DataFrame:
    """The same claims without amounts: totals and the items' amounts go, the rest stays."""
    item = F.transform("claim.item", lambda x: x.dropFields(*amounts))
    return claims.select("id", F.col("claim").dropFields("total").withField("item", item).alias("claim"))


def as_json(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.to_json(column))


def meta(profile: str, updated: Column | None = None) -> Column:
    members = [F.array(F.lit(profile)).alias("profile")] + ([] if updated is None else [F.date_format(updated, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("lastUpdated")])
    return F.struct(*members)


def reference(kind: str, key: Column) -> Column:
    """A reference by type and id; null without an id."""
    return F.when(key.isNotNull(), F.struct(F.concat(F.lit(f"{kind}/"), key.cast("string")).alias("reference")))


def coded(system: str, code: Column) -> Column:
    return F.when(code.isNotNull(), F.struct(F.array(F.struct(F.lit(system).alias("system"), code.alias("code"))).alias("coding")))


def patients(members: DataFrame, linked: DataFrame) -> DataFrame:
    """id, resource: members (id, family, given, birth_date, gender) with their own and all linked identifiers in order (linked: id, system, value).

    An absent birth date is said so by an extension."""
    other = linked.groupBy("id").agg(ordered_list(F.struct("system", F.col("value").cast("string").alias("value")), F.struct("system", "value")).alias("__linked"))
    own = F.array(identifier("member", F.col("id")))
    absent = F.when(F.col("birth_date").isNull(), F.struct(F.array(F.struct(F.lit("data-absent-reason").alias("url"), F.lit("unknown").alias("valueCode"))).alias("extension")))
    body = F.struct(
        F.lit("Patient").alias("resourceType"), F.col("id").cast("string").alias("id"), meta("patient").alias("meta"), F.concat(own, F.coalesce("__linked", F.array().cast("array<struct<system:string,value:string>>"))).alias("identifier"),
        F.array(F.struct(F.col("family"), F.array("given").alias("given"))).alias("name"), F.col("gender"), F.col("birth_date").cast("string").alias("birthDate"), absent.alias("_birthDate"),
    )
    return members.join(other, "id", "left").select("id", F.to_json(body).alias("resource"))


def coverages(spans: DataFrame, plans: DataFrame) -> DataFrame:
    """id, resource of insured spans (id, member_id, plan, valid_from, valid_to open where null); plans, a small table: plan, label."""
    body = F.struct(
        F.lit("Coverage").alias("resourceType"), F.col("id").cast("string").alias("id"), F.when(F.col("valid_to").isNull(), "active").otherwise("cancelled").alias("status"), reference("Patient", F.col("member_id")).alias("beneficiary"),
        F.struct(F.col("valid_from").cast("string").alias("start"), F.col("valid_to").cast("string").alias("end")).alias("period"), F.array(F.struct(coded("plan", F.col("plan")).alias("type"), F.col("label").alias("name"))).alias("class"),
    )
    return spans.join(F.broadcast(plans), "plan", "left").select("id", F.to_json(body).alias("resource"))


def organizations(payer: str, providers: DataFrame, pharmacies: DataFrame) -> DataFrame:
    """id, resource of the payer itself, providers and pharmacies (each: id, name)."""
    spark = providers.sparkSession
    rows = spark.createDataFrame([("payer-1", payer, "payer")], "id string, name string, kind string")
    for kind, df in (("prov", providers), ("pharm", pharmacies)):
        rows = rows.unionByName(df.select(F.concat(F.lit(f"{kind}-"), F.col("id").cast("string")).alias("id"), "name", F.lit(kind).alias("kind")))
    body = F.struct(F.lit("Organization").alias("resourceType"), "id", F.lit(True).alias("active"), F.array(coded("organization-type", F.col("kind"))).alias("type"), "name")
    return rows.select("id", F.to_json(body).alias("resource"))


#: Profiles of claims by type; a type without one has the base profile.
PROFILES = {"inpatient": "eob-inpatient", "outpatient": "eob-outpatient", "pharmacy": "eob-pharmacy"}


def benefits(claims: DataFrame, lines: DataFrame, diagnoses: DataFrame, pharmacy: DataFrame) -> DataFrame:
    """id, resource: explanations of benefit of claims with items, diagnoses and supporting information by type, and of pharmacy claims.

    claims: id, member_id, provider_id, type, status, created, total, admitted (inpatient claims). lines: id, line, product, quantity, net. diagnoses: id,
    sequence, code (the first is principal). pharmacy: id, member_id, product, quantity, net, created: one item each."""
    item = F.struct(F.col("line").cast("int").alias("sequence"), coded("product", F.col("product")).alias("productOrService"), F.struct(F.col("quantity").alias("value")).alias("quantity"), F.struct(F.col("net").alias("value")).alias("net"))
    items = lines.groupBy("id").agg(ordered_list(item, F.col("line")).alias("item"))
    found = F.struct(F.col("sequence").cast("int").alias("sequence"), coded("icd", F.col("code")).alias("diagnosisCodeableConcept"), F.array(coded("diagnosis-type", F.when(F.col("sequence") == 1, "principal").otherwise("secondary"))).alias("type"))
    causes = diagnoses.groupBy("id").agg(ordered_list(found, F.col("sequence")).alias("diagnosis"))
    information = F.array(F.struct(F.lit(1).alias("sequence"), coded("information", F.lit("received")).alias("category"), F.col("created").cast("string").alias("timingDate")))
    admitted = F.array(F.struct(F.lit(2).alias("sequence"), coded("information", F.lit("admission")).alias("category"), F.col("admitted").cast("string").alias("timingDate")))
    support = F.when((F.col("type") == "inpatient") & F.col("admitted").isNotNull(), F.concat(information, admitted)).otherwise(information)
    medical = claims.join(items, "id", "left").join(causes, "id", "left").withColumn("supportingInfo", support)
    filled = pharmacy.select(
        F.concat(F.lit("rx-"), F.col("id").cast("string")).alias("id"), "member_id", F.lit(None).cast(claims.schema["provider_id"].dataType).alias("provider_id"), F.lit("pharmacy").alias("type"), F.lit("active").alias("status"), "created",
        F.col("net").alias("total"), F.array(F.struct(F.lit(1).alias("sequence"), coded("product", F.col("product")).alias("productOrService"), F.struct(F.col("quantity").alias("value")).alias("quantity"), F.struct("net").alias("net"))).alias("item"),
    )
    every = medical.withColumn("id", F.col("id").cast("string")).drop("admitted").unionByName(filled.withColumn("item", F.transform("item", lambda x: x.withField("net", F.struct(x.net.net.alias("value"))))), allowMissingColumns=True)
    profile = F.coalesce(*(F.when(F.col("type") == kind, F.lit(p)) for kind, p in PROFILES.items()), F.lit("eob-base"))
    body = F.struct(
        F.lit("ExplanationOfBenefit").alias("resourceType"), "id", F.struct(F.array(profile).alias("profile")).alias("meta"), "status", coded("claim-type", F.col("type")).alias("type"), F.lit("claim").alias("use"),
        reference("Patient", F.col("member_id")).alias("patient"), F.col("created").cast("string").alias("created"), reference("Organization", F.col("provider_id")).alias("provider"), "supportingInfo", "diagnosis", "item", F.array(F.struct(F.struct(F.col("total").alias("value")).alias("amount"))).alias("total"),
    )
    return every.select("id", F.to_json(body).alias("resource"))


def prior_authorizations(requests: DataFrame) -> DataFrame:
    """id, resource of authorizations (id, member_id, provider_id, service, decision null while open, decided, created), as pre-authorized benefits."""
    outcome = F.when(F.col("decision").isNull(), "queued").when(F.col("decision") == "approve", "complete").otherwise("partial")
    item = F.struct(F.lit(1).alias("sequence"), coded("service", F.col("service")).alias("productOrService"), F.when(F.col("decision").isNotNull(), F.array(F.struct(coded("decision", F.col("decision")).alias("category")))).alias("adjudication"))
    body = F.struct(
        F.lit("ExplanationOfBenefit").alias("resourceType"), F.concat(F.lit("pa-"), F.col("id").cast("string")).alias("id"), F.struct(F.array(F.lit("pa-eob")).alias("profile")).alias("meta"), F.lit("preauthorization").alias("use"),
        reference("Patient", F.col("member_id")).alias("patient"), reference("Organization", F.col("provider_id")).alias("provider"), F.col("created").cast("string").alias("created"), outcome.alias("outcome"), F.col("decided").cast("string").alias("preAuthDecided"), F.array(item).alias("item"),
    )
    return requests.select(F.concat(F.lit("pa-"), F.col("id").cast("string")).alias("id"), F.to_json(body).alias("resource"))


def consents(opted_out: DataFrame) -> DataFrame:
    """id, resource of opt-outs (id, member_id, start, until, the first day they no longer hold): a period's end is its last day."""
    period = F.struct(F.col("start").cast("string").alias("start"), F.date_sub("until", 1).cast("string").alias("end"))
    body = F.struct(F.lit("Consent").alias("resourceType"), F.col("id").cast("string").alias("id"), F.lit("active").alias("status"), reference("Patient", F.col("member_id")).alias("patient"), F.struct(F.lit("deny").alias("type"), period.alias("period")).alias("provision"))
    return opted_out.select("id", F.to_json(body).alias("resource"))


def attribution_groups(attributed: DataFrame, opted_out: DataFrame) -> DataFrame:
    """id, resource of each provider's members (attributed: provider_id, member_id) but for those who opted out (member_id), who are counted."""
    out = opted_out.select("member_id").distinct().withColumn("__out", F.lit(True))
    tagged = attributed.distinct().join(out, "member_id", "left")
    member = F.struct(reference("Patient", F.col("member_id")).alias("entity"))
    made = tagged.groupBy("provider_id").agg(ordered_list(member, F.col("member_id"), F.col("__out").isNull()).alias("member"), F.count_if("__out").alias("opted_out"))
    count = F.array(F.struct(F.lit("opted-out-count").alias("url"), F.col("opted_out").alias("valueInteger")))
    body = F.struct(F.lit("Group").alias("resourceType"), F.col("provider_id").cast("string").alias("id"), count.alias("extension"), F.size("member").alias("quantity"), reference("Organization", F.col("provider_id")).alias("managingEntity"), unless_empty(F.col("member")).alias("member"))
    return made.select(F.col("provider_id").alias("id"), F.to_json(body).alias("resource"))
