"""Sources by file name, snapshots of runs, dates with a sentinel and strict ones, padding, buckets, code formats, and consent at the time of an export."""

import datetime as dt
import json

import pytest
from millrace.functions import columns as c
from millrace.operators import jobs, quality
from millrace.sources import files
from pyspark.sql import functions as F


def test_types_by_file_name(spark, tmp_path):
    (tmp_path / "ExplanationOfBenefit.ndjson").write_text('{"resourceType": "X", "id": "1"}\n\n{"id": "2"}\n')
    (tmp_path / "Organization.1790553600000.ndjson").write_text('{"id": "3"}\n')
    read = files.read_resources(spark, str(tmp_path), "run").withColumn("table", files.landing_table(F.col("resource_type")))
    got = sorted((r.resource_type, r.table, r._source_file) for r in read.collect())
    assert got == [("ExplanationOfBenefit", "explanation_of_benefit", "ExplanationOfBenefit.ndjson")] * 2 + [("Organization", "organization", "Organization.1790553600000.ndjson")]
    landed = {r.resource_table: r.rows for r in files.land_resources(files.read_resources(spark, str(tmp_path), "run"), str(tmp_path / "landed")).collect()}
    assert landed == {"explanation_of_benefit": 2, "organization": 1}


def test_runs_of_snapshot_files(spark, tmp_path):
    metric = lambda v: {"area": "a", "metric": "m", "dimension": "d", "value": v}
    run = lambda key, v: {"run_key": key, "run_at": "2024-01-01T00:00:00Z", "metrics": [metric(v), metric(v + 1)]}
    (tmp_path / "old.json").write_text(json.dumps([run("r1", 1.0), run("r2", 5.0)]))
    (tmp_path / "new.json").write_text(json.dumps(run("r1", 10.0)))
    runs, metrics = files.collect_runs(spark, [str(tmp_path / "old.json"), str(tmp_path / "new.json")])
    assert sorted(r.run_key for r in runs.collect()) == ["r1", "r2"]
    assert sorted((r.run_key, r.value) for r in metrics.collect()) == [("r1", 10.0), ("r1", 11.0), ("r2", 5.0), ("r2", 6.0)]


def test_dates_with_a_sentinel_and_strict_ones(spark):
    df = spark.createDataFrame([("99991231",), ("20240131",), ("",), (None,), ("20240230",)], "d string")
    assert [r.x for r in df.select(c.open_ended(F.col("d")).alias("x")).collect()] == [None, dt.date(2024, 1, 31), None, None, None]
    fine = df.filter("d IN ('20240131', '')")
    assert [r.x for r in fine.select(c.parse_date(F.col("d"), strict=True).alias("x")).collect()] == [dt.date(2024, 1, 31), None]
    with pytest.raises(Exception, match="20240230"):
        df.select(c.parse_date(F.col("d"), strict=True).alias("x")).collect()


def test_padding_buckets_and_codes(spark):
    df = spark.createDataFrame([("ab  ", "E1165", "E11", "1234-5678-9"), (None, None, None, "12345-678-90"), (" c ", "A0", "", "12345-6789-0")], "p string, icd string, short string, ndc string")
    row = df.select(c.strip_char_padding(F.col("p"), "CHAR(4)").alias("a"), c.strip_char_padding(F.col("p"), "varchar(4)").alias("b"), c.dotted_icd(F.col("icd")).alias("i"), c.dotted_icd(F.col("short")).alias("s"), c.ndc11(F.col("ndc")).alias("n"))
    assert [tuple(r) for r in row.collect()] == [("ab", "ab  ", "E11.65", "E11", "01234567809"), (None, None, None, None, "12345067890"), (" c", " c ", "A0", "", "12345678900")]
    buckets = spark.range(4000).select(c.hash_bucket(F.col("id"), 8).alias("b")).groupBy("b").count().collect()
    assert sorted(r.b for r in buckets) == list(range(8)) and all(400 < r["count"] < 600 for r in buckets)
    assert spark.range(100).filter(c.hash_bucket(F.col("id"), 8) == 3).collect() == spark.range(100).repartition(5).filter(c.hash_bucket(F.col("id"), 8) == 3).orderBy("id").collect()


def test_consent_when_an_export_runs(spark):
    day = dt.date(2024, 6, 1)
    step = lambda n: day + dt.timedelta(days=n)
    matched = spark.createDataFrame([(1, None, None), (2, step(-9), step(-1)), (3, step(1), None), (4, step(-9), day), (5, step(-9), step(-5)), (5, day, None)], "member_id long, consent_start date, consent_end date")
    rows = [("ExplanationOfBenefit", f"{m}-{k}", m, kind, served, decided) for m in (1, 2, 3, 4, 5) for k, (kind, served, decided) in enumerate([("claim", step(-10), None), ("claim", step(-9000), None), ("authorization", step(-9000), step(-364)), ("authorization", step(-10), step(-366)), ("authorization", step(-10), None)])]
    rows += [("Coverage", f"c{m}", m, None, None, None) for m in (1, 2, 3, 4, 5)]
    resources = spark.createDataFrame(rows, "type string, id string, member_id long, kind string, served date, decided date").withColumn("updated", F.lit(day)).withColumn("organization_id", F.lit("o1"))
    organizations = spark.createDataFrame([("o1",), ("o2",)], "id string")
    exported, issues = jobs.payer_export(spark.createDataFrame([(m,) for m in (1, 2, 3, 4, 5, 6)], "member_id long"), matched, resources, organizations, F.lit(day))
    got = {(r.type, r.id) for r in exported.collect()}
    assert got == {("Organization", "o1")} | {("Coverage", f"c{m}") for m in (1, 4, 5)} | {("ExplanationOfBenefit", f"{m}-{k}") for m in (1, 4, 5) for k in (0, 2, 4)}
    assert {(r.member_id, r.reason) for r in issues.collect()} == {(6, "not a member"), (2, "consent ended"), (3, "consent not yet in force")}


def test_the_consent_period_stays_with_the_match(spark):
    people = "payer string, member_id string, birth_date date, names array<string>"
    born = dt.date(1980, 1, 1)
    members = spark.createDataFrame([("A", "1", born, ["x"])], people)
    requests = spark.createDataFrame([(1, "A", "1", born, ["x"], born, None), (2, "A", "9", born, ["y"], born, born)], f"request_id int, {people}, start date, until date")
    got = {r.request_id: (r.outcome, r.consent_start, r.consent_end) for r in jobs.bulk_match(requests, members, F.lit(None).cast("string"), (F.col("start"), F.col("until"))).collect()}
    assert got == {1: ("matched", born, None), 2: ("no match", None, None)}


def test_sets_compared_without_some_members(spark):
    one = spark.createDataFrame([(1, '{"a": 1, "meta": {"x": 1}, "b": [1, 2]}'), (2, '{"a": 1}'), (3, '{"a": 1}')], "id int, j string")
    two = spark.createDataFrame([(1, '{"b": [1,2], "meta": 5, "a": 1}'), (2, '{"a": 2}'), (4, "{}")], "id int, j string")
    assert tuple(quality.compare_sets(one, two, "id", "j", ["meta"]).first()) == (1, 1, 1) and tuple(quality.compare_sets(one, two, "id", "j", []).first()) == (1, 1, 2)
