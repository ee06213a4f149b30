"""Batch jobs over members and requests: export, matching, consent, authorization, intake."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.relational import placed, stack

# --- who may see what


def visible(members: DataFrame, listed: DataFrame, opted_out: DataFrame, key: str) -> DataFrame:
    """Members on the list that have not opted out."""
    return members.join(listed.select(key), key, "left_semi").join(opted_out.select(key), key, "left_anti")


def in_exchange_scope(kind: Column, served: Column, decided: Column, as_of: Column, years: int = 5, days: int = 365) -> Column:
    """Services of the last `years` years, and authorizations that are undecided or were decided in the last `days` days."""
    authorization = decided.isNull() | (decided >= F.date_sub(as_of, days))
    return F.coalesce(F.when(kind == "authorization", authorization).otherwise(served >= F.add_months(as_of, -12 * years)), F.lit(False))


class Consent(NamedTuple):
    """Columns of a consent: who gives and receives, what it covers and when."""

    member: Column
    status: Column
    start: Column
    end: Column
    receiver: Column
    sensitive: Column


def consent_problem(c: Consent, member: Column, receiver: Column, on: Column) -> Column:
    """The first reason for which a consent does not hold, null where it does."""
    return (
        F.when(c.member.isNull() | ~c.member.eqNullSafe(member), "other member")
        .when(~c.status.eqNullSafe(F.lit("active")), "not active")
        .when(c.start > on, "not yet in force")
        .when(c.end < on, "expired")
        .when(~c.receiver.eqNullSafe(receiver), "other receiver")
        .when(F.coalesce(c.sensitive, F.lit(False)), "restricted data")
    )


# --- export


def member_export(
    requested: DataFrame, members: DataFrame, opted_out: DataFrame, resources: DataFrame, organizations: DataFrame,
    types: Sequence[str] | None = None, since: Column | None = None, until: Column | None = None, sent: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(exported, issues) of a group's export.

    requested, members, opted_out: member_id. resources: id, type, member_id, updated, organization_id. sent: member_id, sent_at of the last
    export: only later changes go. Organizations that an exported resource names go too, once. issues: member_id, reason."""
    asked = requested.select("member_id").distinct()
    known = asked.join(members.select("member_id").distinct(), "member_id", "left_semi")
    allowed = known.join(opted_out.select("member_id"), "member_id", "left_anti")
    rows = resources.join(allowed, "member_id", "left_semi")
    if types is not None:
        rows = rows.filter(F.col("type").isin(list(types)))
    if since is not None:
        rows = rows.filter(F.col("updated") >= since)
    if until is not None:
        rows = rows.filter(F.col("updated") < until)
    if sent is not None:
        last = sent.groupBy("member_id").agg(F.max("sent_at").alias("__sent"))
        rows = rows.join(last, "member_id", "left").filter(F.col("__sent").isNull() | (F.col("updated") > F.col("__sent"))).drop("__sent")
    named = organizations.join(rows.select(F.col("organization_id").alias("id")).distinct(), "id", "left_semi")
    exported = rows.select("type", "id", "member_id").unionByName(named.select(F.lit("Organization").alias("type"), "id", F.lit(None).cast(rows.schema["member_id"].dataType).alias("member_id")))
    unknown = asked.join(members.select("member_id"), "member_id", "left_anti").withColumn("reason", F.lit("not a member"))
    out = known.join(opted_out.select("member_id"), "member_id", "left_semi").withColumn("reason", F.lit("opted out"))
    return exported, stack(unknown, out)


def payer_export(
    requested: DataFrame, matched: DataFrame, resources: DataFrame, organizations: DataFrame, as_of: Column, types: Sequence[str] | None = None, until: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(exported, issues) of an export to another payer, at the time it runs: members of its match group whose consent holds on that day, and of their benefits those in scope.

    matched: member_id, consent_start, consent_end (null: open), as kept at the match. resources: as for `member_export`, and kind, served, decided of benefits
    (type ExplanationOfBenefit). issues name members outside the group and those whose consent has ended or has yet to start."""
    day = as_of.cast("date")
    late, early = F.col("consent_end") < day, F.col("consent_start") > day
    state = matched.groupBy("member_id").agg(F.bool_or(F.coalesce(~late, F.lit(True)) & F.coalesce(~early, F.lit(True))).alias("__holds"), F.bool_or(F.coalesce(early, F.lit(False))).alias("__early"))
    held = state.filter("__holds").select("member_id")
    in_scope = (F.col("type") != "ExplanationOfBenefit") | in_exchange_scope(F.col("kind"), F.col("served"), F.col("decided"), as_of)
    exported, strange = member_export(requested.join(state.filter("NOT __holds"), "member_id", "left_anti"), held, held.limit(0), resources.filter(in_scope), organizations, types, until=until)
    lapsed = requested.select("member_id").distinct().join(state.filter("NOT __holds"), "member_id").select("member_id", F.when(F.col("__early"), "consent not yet in force").otherwise("consent ended").alias("reason"))
    return exported, stack(strange, lapsed)


def provider_views(attributed: DataFrame, opted_out: DataFrame) -> DataFrame:
    """(viewer_id, member_id): the members on each provider's list (provider_id, member_id) who have not opted out."""
    return attributed.select(F.col("provider_id").alias("viewer_id"), "member_id").distinct().join(opted_out.select("member_id"), "member_id", "left_anti").select("viewer_id", "member_id")


def payer_views(matched: DataFrame, on: Column) -> DataFrame:
    """(viewer_id, member_id): the members matched for each payer (payer, member_id, consent_start, consent_end) whose consent holds on a day."""
    holds = (F.col("consent_start").isNull() | (F.col("consent_start") <= on)) & (F.col("consent_end").isNull() | (F.col("consent_end") >= on))
    return matched.filter(holds).select(F.col("payer").alias("viewer_id"), "member_id").distinct()


def seen_by(views: DataFrame, rows: DataFrame) -> DataFrame:
    """viewer_id and the rows (with a member_id) that each viewer may see."""
    return views.join(rows, "member_id").select("viewer_id", *rows.columns)


def record_sent(log: DataFrame, exported: DataFrame, at: Column) -> DataFrame:
    """member_id, sent_at: the log with the members of an export set to its time (never back)."""
    now = exported.filter("member_id IS NOT NULL").select("member_id", at.alias("sent_at")).distinct()
    return log.select("member_id", "sent_at").unionByName(now).groupBy("member_id").agg(F.max("sent_at").alias("sent_at"))


def withdraw(exports: DataFrame, revoked: DataFrame, key: str) -> DataFrame:
    """Exports with whether a revocation of their match group, at or after them, withdraws them. revoked: key, revoked_at."""
    last = revoked.groupBy(key).agg(F.max("revoked_at").alias("revoked_at"))
    return exports.join(last, key, "left").withColumn("withdrawn", F.coalesce(F.col("revoked_at") >= F.col("exported_at"), F.lit(False))).drop("revoked_at")


# --- matching members of another payer


def match_members(requests: DataFrame, members: DataFrame) -> DataFrame:
    """request_id, member_id and reason of each request.

    requests: request_id, payer, member_id, birth_date, names (list); members: payer, member_id, birth_date, names (list), all of a request's
    payer. By member id, confirmed by birth date and a name in common; else by birth date and a name where that is one member alone."""
    known = members.select("payer", F.col("member_id").alias("found"), F.col("birth_date").alias("born"), F.col("names").alias("called"))
    same = (F.col("birth_date") == F.col("born")) & F.arrays_overlap("names", "called")
    by_id = requests.join(known, (requests.payer == known.payer) & (F.col("member_id") == F.col("found"))).groupBy("request_id").agg(F.max(F.when(same, F.col("found"))).alias("by_id"))
    spread = requests.select("request_id", "payer", "birth_date", F.explode(F.array_distinct("names")).alias("name"))
    held = known.select(F.col("payer").alias("__payer"), "found", "born", F.explode(F.array_distinct("called")).alias("__name"))
    # Whether a request finds one member alone shows from the least and the greatest of each block, so its members are never paired with it.
    blocks = held.groupBy("__payer", "born", "__name").agg(F.min("found").alias("least"), F.max("found").alias("greatest"))
    found = spread.join(blocks, (spread.payer == blocks.__payer) & (F.col("birth_date") == F.col("born")) & (F.col("name") == F.col("__name")))
    by_name = found.groupBy("request_id").agg(F.min("least").alias("one"), F.max("greatest").alias("last"))
    payers = members.select(F.col("payer").alias("__known")).distinct()
    joined = requests.join(by_id, "request_id", "left").join(by_name, "request_id", "left").join(payers, F.col("payer") == F.col("__known"), "left")
    reason = (
        F.when(F.col("__known").isNull(), "unknown payer").when(F.col("by_id").isNotNull(), "member id").when(F.col("one") == F.col("last"), "demographics")
        .when(F.col("one") < F.col("last"), "ambiguous").otherwise("no match")
    )
    return joined.select("request_id", F.when(reason == "member id", F.col("by_id")).when(reason == "demographics", F.col("one")).alias("member_id"), reason.alias("reason"))


def bulk_match(requests: DataFrame, members: DataFrame, problem: Column, period: tuple[Column, Column] | None = None) -> DataFrame:
    """request_id, member_id, outcome (matched, no match, consent constrained), reason. `problem`: a request's consent problem, from its own columns; `period`:
    its consent's first and last day, which then stay with the match as consent_start and consent_end, to be held against the day of each export."""
    kept = [] if period is None else [day.alias(name) for day, name in zip(period, ("consent_start", "consent_end"), strict=True)]
    found = match_members(requests, members).join(requests.select("request_id", problem.alias("problem"), *kept), "request_id")
    outcome = F.when(F.col("member_id").isNull(), "no match").when(F.col("problem").isNotNull(), "consent constrained").otherwise("matched")
    return found.select("request_id", F.when(outcome == "matched", F.col("member_id")).alias("member_id"), outcome.alias("outcome"), F.when(outcome == "consent constrained", F.col("problem")).otherwise(F.col("reason")).alias("reason"),
                        *(F.when(outcome == "matched", F.col(c)).alias(c) for c in (("consent_start", "consent_end") if kept else ())))


# --- authorization


def coverage_requirement(orders: DataFrame, spans: DataFrame, rules: DataFrame) -> DataFrame:
    """order_id, covered, needs_authorization, questionnaire of each order.

    orders: order_id, member_id, service, on_date. spans: member_id, valid_from, valid_to (open where null). rules (a small table, one row a service):
    service, needs_authorization, questionnaire. Spans that hold are reduced to whether there is one."""
    hit = orders.join(spans, "member_id").filter((F.col("valid_from") <= F.col("on_date")) & (F.col("valid_to").isNull() | (F.col("valid_to") >= F.col("on_date"))))
    covered = hit.select("order_id").distinct().withColumn("covered", F.lit(True))
    found = orders.join(covered, "order_id", "left").withColumn("covered", F.coalesce("covered", F.lit(False))).join(rules, "service", "left")
    needs = F.col("covered") & F.coalesce("needs_authorization", F.lit(False))
    return found.select("order_id", "covered", needs.alias("needs_authorization"), F.when(needs, F.col("questionnaire")).alias("questionnaire"))


def flatten_answers(forms: DataFrame, id_col: str, items: str, depth: int = 3) -> DataFrame:
    """(id, item, answer, source) of a form's items and the items nested in them, to a depth.

    items: array of struct (link_id, answer, source, item: array of the same). A missing source is the answerer's own, `A`."""
    level = forms.select(id_col, F.explode(items).alias("i"))
    parts = []
    for k in range(depth):
        parts.append(level.filter(F.col("i.answer").isNotNull()).select(id_col, F.col("i.link_id").alias("item"), F.col("i.answer").alias("answer"), F.coalesce("i.source", F.lit("A")).alias("source")))
        below = level.schema["i"].dataType
        if k + 1 == depth or "item" not in below.fieldNames():
            break
        level = level.select(id_col, F.explode("i.item").alias("i"))
    return stack(*parts)


def decide_authorizations(requests: DataFrame, answers: DataFrame, criteria: DataFrame) -> DataFrame:
    """request_id, decision, missing and unmet items (sorted lists) of each request.

    requests: request_id, service. answers: request_id, item, answer. criteria (a small table): service, item, needed. All criteria of its service
    answered as needed approve a request; anything missing or unmet pends it; a service without criteria is approved."""
    given = answers.groupBy("request_id", "item").agg(F.max("answer").alias("answer"))
    asked = requests.join(criteria, "service").join(given, ["request_id", "item"], "left")
    missing, unmet = F.col("answer").isNull(), F.col("answer") != F.col("needed")
    judged = asked.groupBy("request_id").agg(F.array_sort(F.collect_list(F.when(missing, F.col("item")))).alias("missing"), F.array_sort(F.collect_list(F.when(unmet, F.col("item")))).alias("unmet"))
    none = F.array().cast("array<string>")
    found = requests.select("request_id").join(judged, "request_id", "left").withColumns({"missing": F.coalesce("missing", none), "unmet": F.coalesce("unmet", none)})
    return found.select("request_id", F.when((F.size("missing") == 0) & (F.size("unmet") == 0), "approve").otherwise("pend").alias("decision"), "missing", "unmet")


def review_pended(decided: DataFrame, denied: Column, approved: Column) -> DataFrame:
    """decided with the reviewer's decision on pended requests: `deny` where that rule holds, else `approve` where the other does, else still pended."""
    reviewed = F.when(F.col("decision") != "pend", F.col("decision")).when(denied, "deny").when(approved, "approve").otherwise("pend")
    return decided.withColumn("final", reviewed).withColumn("decided_by", F.when(F.col("decision") != "pend", "rules").when(F.col("final") != "pend", "reviewer"))


def flatten_requests(requests: DataFrame) -> DataFrame:
    """request_id, product, diagnosis, amount and rejection of each request.

    requests: request_id, member_id, items (list of struct product, unit_price, quantity, net), diagnoses (list of struct sequence, code). One item is
    taken; the diagnosis is that with the lowest sequence; an amount that is missing is unit price times quantity."""
    item = F.try_element_at("items", F.lit(1))
    diagnosis = F.try_element_at(F.array_sort(F.filter("diagnoses", lambda d: d.code.isNotNull())), F.lit(1))
    amount = F.coalesce(item["net"], item["unit_price"] * item["quantity"])
    rejection = (
        F.when(F.col("member_id").isNull(), "no member").when(F.coalesce(F.size("items"), F.lit(0)) < 1, "no item").when(F.size("items") > 1, "more than one item")
        .when(item["product"].isNull(), "no product").when(diagnosis.isNull(), "no diagnosis").when(amount.isNull(), "no amount")
    )
    return requests.select("request_id", item["product"].alias("product"), diagnosis["code"].alias("diagnosis"), amount.alias("amount"), rejection.alias("rejection"))


# --- intake, events, reviews


def intake(existing: DataFrame, submitted: DataFrame, key: Sequence[str], id_col: str, order: Sequence[str]) -> DataFrame:
    """Submissions that are new by key, each once, with ids that continue the greatest one. Submitting again adds nothing.

    Ids follow the given order without gaps, however many rows there are: rows are written in ranges of it once, and counted and numbered from these."""
    fresh = submitted.join(existing.select(*key), list(key), "left_anti").groupBy(*key).agg(F.min(F.struct(*order, *(c for c in submitted.columns if c not in (*key, *order)))).alias("__row"))
    rows = fresh.select(*key, "__row.*").select(*submitted.columns)
    last = existing.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("__last"))
    return placed(rows, [], [*order, *key]).crossJoin(F.broadcast(last)).select((F.col("__last") + F.col("pos") + 1).cast("long").alias(id_col), *submitted.columns)


def decision_events(decided: DataFrame, notified: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """subscription_id, request_id, event_number of decisions not yet told to a subscription of their provider; numbers go on from its last.

    decided: request_id, provider_id, decided_at. notified: subscription_id, request_id, event_number. subscriptions: subscription_id, provider_id."""
    told = notified.groupBy("subscription_id").agg(F.max("event_number").alias("__last"))
    new = decided.join(subscriptions, "provider_id").join(notified.select("subscription_id", "request_id"), ["subscription_id", "request_id"], "left_anti")
    n = F.row_number().over(Window.partitionBy("subscription_id").orderBy("decided_at", "request_id"))
    return new.join(told, "subscription_id", "left").select("subscription_id", "request_id", (F.coalesce("__last", F.lit(0)) + n).cast("long").alias("event_number"))


def review_by_truth(queue: DataFrame, truth: DataFrame, decisions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Decisions (keys, decision) on queued pairs that have none yet: `accept` where the truth holds the pair, else `reject`."""
    known = truth.select(*keys).distinct().withColumn("__true", F.lit(True))
    fresh = queue.select(*keys).distinct().join(decisions.select(*keys), list(keys), "left_anti")
    return fresh.join(known, list(keys), "left").select(*keys, F.when(F.col("__true"), "accept").otherwise("reject").alias("decision"))


def attribution(evidence: Sequence[tuple[str, DataFrame]], least: int = 1) -> DataFrame:
    """provider_id, member_id, sources (sorted), events: members of whom a provider has at least so many pieces of evidence. Each piece: provider_id, member_id."""
    every = stack(*(df.select("provider_id", "member_id", F.lit(name).alias("source")) for name, df in evidence)).filter("provider_id IS NOT NULL AND member_id IS NOT NULL")
    counted = every.groupBy("provider_id", "member_id").agg(F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"), F.count(F.lit(1)).alias("events"))
    return counted.filter(F.col("events") >= least)
