"""Data quality: declarative checks, parity of two tables, redaction, metric snapshots and run history."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.relational import bag_difference, stack


class Check(NamedTuple):
    name: str
    failing: Column
    severity: str = "error"


def run_checks(df: DataFrame, checks: Sequence[Check], unique: Sequence[Sequence[str]] = ()) -> DataFrame:
    """check, severity, failures: row checks in one pass, and one grouping per unique key."""
    counted = df.agg(*(F.count_if(c.failing).alias(c.name) for c in checks))
    rows = counted.select(F.inline(F.array(*(F.struct(F.lit(c.name).alias("check"), F.lit(c.severity).alias("severity"), F.col(c.name).alias("failures")) for c in checks))))
    for keys in unique:
        repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0)).alias("failures"))
        rows = rows.unionByName(repeated.select(F.lit("unique_" + "_".join(keys)).alias("check"), F.lit("error").alias("severity"), "failures"))
    return rows


def parity(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """comparison, only_a, only_b of each named pair of tables, compared as bags."""
    return stack(*(bag_difference(a, b).select(F.lit(name).alias("comparison"), "only_a", "only_b") for name, (a, b) in pairs.items()))


def snapshot_metrics(df: DataFrame, dims: Sequence[str], metrics: Sequence[str], area: str) -> DataFrame:
    """Long rows (area, metric, dimension, value) of a wide mart, with totals under the dimension `all`."""
    label = F.concat_ws("/", *(F.coalesce(F.col(d).cast("string"), F.lit("all")) for d in dims))
    wide = df.rollup(*dims).agg(*(F.sum(m).alias(m) for m in metrics)).withColumn("dimension", label)
    return wide.select("dimension", *(F.col(m).cast("double") for m in metrics)).unpivot("dimension", list(metrics), "metric", "value").select(F.lit(area).alias("area"), "metric", "dimension", "value")


def quality_history(metrics: DataFrame, runs: DataFrame, series: Sequence[str]) -> DataFrame:
    """Metrics of each run with the same metric of the run before it in its series, and the change."""
    before = runs.withColumn("previous_run", F.lag("run_key").over(Window.partitionBy(*series).orderBy("run_at", "run_key")))
    now = metrics.join(before, "run_key")
    old = metrics.select(F.col("run_key").alias("previous_run"), "area", "metric", "dimension", F.col("value").alias("previous_value"))
    joined = now.join(old, ["previous_run", "area", "metric", "dimension"], "left")
    return joined.withColumn("change", F.col("value") - F.col("previous_value"))


def _members(body: Column, ignored: Sequence[str]) -> Column:
    """Members of a JSON object in order of their names, each as text of its own, without some."""
    members = F.try_variant_get(F.parse_json(body), "$", "map<string,variant>")
    return F.array_sort(F.map_entries(F.transform_values(F.map_filter(members, lambda name, _: ~name.isin(*ignored)), lambda _, v: F.to_json(v))))


def compare_sets(expected: DataFrame, actual: DataFrame, id_col: str, body: str, ignored: Sequence[str] | None = None) -> DataFrame:
    """missing, extra, different: ids of one side only, and bodies that differ: as texts, or, where members to be ignored are named, as JSON objects but for
    these (the order of members does not count then)."""
    whole = F.col(body) if ignored is None else _members(F.col(body), ignored or ("",))
    e = expected.select(F.col(id_col).alias("e_id"), whole.alias("e_body"))
    a = actual.select(F.col(id_col).alias("a_id"), whole.alias("a_body"))
    both = e.join(a, F.col("e_id") == F.col("a_id"), "full")
    return both.agg(F.count_if(F.col("a_id").isNull()).alias("missing"), F.count_if(F.col("e_id").isNull()).alias("extra"), F.count_if(F.col("e_id").isNotNull() & F.col("a_id").isNotNull() & ~F.col("e_body").eqNullSafe(F.col("a_body"))).alias("different"))


def redaction_problems(redacted: DataFrame, id_col: str, text: str, forbidden: Sequence[str]) -> DataFrame:
    """Documents that still hold a forbidden key."""
    found = F.filter(F.array(*(F.when(F.col(text).contains(f'"{k}"'), F.lit(k)) for k in forbidden)), lambda x: x.isNotNull())
    return redacted.select(id_col, found.alias("found")).filter(F.size("found") > 0)


def relationship_failures(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, name: str, severity: str = "error") -> DataFrame:
    """check, severity, failures: rows whose key is not null and not among the parent's."""
    missing = child.filter(F.col(child_key).isNotNull()).join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")
    return missing.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("check"), F.lit(severity).alias("severity"), "failures")


def gate(assertions: dict[str, DataFrame]) -> DataFrame:
    """assertion, rows: how many offending rows each assertion returns; a gate is open where none does."""
    return stack(*(df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("assertion"), "rows") for name, df in assertions.items()))


def unresolved_references(references: DataFrame, resources: DataFrame) -> DataFrame:
    """references (source, kind, target) whose target is not among resources (kind, id)."""
    return references.filter(F.col("target").isNotNull()).join(resources.select("kind", F.col("id").alias("target")).distinct(), ["kind", "target"], "left_anti")


def leaked_members(redacted: DataFrame, original: DataFrame, id_col: str, forbidden: Sequence[str], kept: dict[str, str]) -> DataFrame:
    """id, problem of redacted JSON texts: a member with a forbidden name at any depth, or a part (name: path) of the original that has lost elements.

    redacted and original: id, resource. A member's name is a text before a colon, so values that hold the word do not count."""
    held = F.filter(F.array(*(F.when(F.col("resource").rlike(f'"{name}"\\s*:'), F.lit(f"holds {name}")) for name in forbidden)), lambda x: x.isNotNull())
    sizes = lambda c: [F.coalesce(F.json_array_length(F.get_json_object(c, path)), F.lit(0)) for path in kept.values()]
    both = redacted.join(original.select(id_col, F.col("resource").alias("__was")), id_col)
    lost = F.filter(F.array(*(F.when(a != b, F.lit(f"lost {name}")) for name, a, b in zip(kept, sizes(F.col("resource")), sizes(F.col("__was")), strict=True))), lambda x: x.isNotNull())
    return both.select(id_col, F.explode(F.concat(held, lost)).alias("problem"))


def check_codes(codes: DataFrame, reference: DataFrame) -> DataFrame:
    """system, code, on_date, status and reason of each distinct code used.

    codes: system, code, on_date. reference: system, code, valid_from, valid_to (open where null), billable. Valid where a version holds on the date and may be billed;
    unverified for systems without a reference. Distinct codes are looked up once, and a code's versions are reduced before the verdict."""
    wanted = codes.select("system", "code", "on_date").distinct()
    known = F.broadcast(reference.select("system").distinct().withColumn("__system", F.lit(True)))
    held = reference.select("system", "code", "valid_from", "valid_to", "billable")
    on = (F.col("valid_from") <= F.col("on_date")) & (F.col("valid_to").isNull() | (F.col("valid_to") >= F.col("on_date")))
    found = wanted.join(held, ["system", "code"], "left").groupBy("system", "code", "on_date").agg(
        F.count("valid_from").alias("versions"), F.count_if(on).alias("holding"), F.count_if(on & F.col("billable")).alias("billing")
    )
    reason = (
        F.when(F.col("code").isNull(), "no code").when(F.col("__system").isNull(), "no reference").when(F.col("versions") == 0, "unknown code").when(F.col("holding") == 0, "not in force")
        .when(F.col("billing") == 0, "not billable").otherwise("in force")
    )
    judged = found.join(known, "system", "left").withColumn("reason", reason)
    status = F.when(F.col("reason") == "in force", "valid").when(F.col("reason") == "no reference", "unverified").otherwise("invalid")
    return judged.select("system", "code", "on_date", status.alias("status"), "reason")


def latest_per_factor(runs: DataFrame, factor: str, at: str) -> DataFrame:
    """The latest run of each factor."""
    return runs.groupBy(factor).agg(F.max_by(F.struct(*(c for c in runs.columns if c != factor)), F.struct(at, *sorted(c for c in runs.columns if c not in (factor, at)))).alias("__r")).select(factor, "__r.*")


def scale_summary(metrics: DataFrame, runs: DataFrame, factor: str, at: str, wanted: Sequence[str]) -> DataFrame:
    """One row for each factor's latest run, with the wanted metrics as columns. runs: run_key, factor, at; metrics: run_key, metric, value."""
    last = latest_per_factor(runs.select("run_key", factor, at), factor, at)
    return metrics.select("run_key", "metric", "value").join(last, "run_key").groupBy(factor, "run_key").pivot("metric", list(wanted)).agg(F.max("value"))


def kpi_row(history: DataFrame, metric: str, at: str) -> DataFrame:
    """metric, value, previous, change: the latest value of a metric and the one before. Two rows are all that is sorted."""
    two = history.filter(F.col("metric") == metric).orderBy(F.desc(at)).limit(2)
    ranked = two.agg(F.max_by("value", at).alias("value"), F.when(F.count(F.lit(1)) > 1, F.min_by("value", at)).alias("previous"))
    return ranked.select(F.lit(metric).alias("metric"), "value", "previous", (F.col("value") - F.col("previous")).alias("change"))


def issue_summary(issues: DataFrame, known: Column, unverified: Column) -> DataFrame:
    """class (known, unverified, real), severity, message, issues: validation messages by what they are worth."""
    kind = F.when(known, "known").when(unverified, "unverified").otherwise("real")
    return issues.groupBy(kind.alias("class"), "severity", "message").agg(F.count(F.lit(1)).alias("issues"))


def exportable(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Rows without any of the integrity flags (a null flag counts as raised); the others stay in the mart, flagged."""
    return df.filter(~reduce(Column.__or__, (F.coalesce(F.col(f), F.lit(True)) for f in flags)))
