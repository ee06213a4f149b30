"""Load logs of failed writes, releases, observations, versions of results, incremental states with truncations, and member match rules."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import changes, jobs, quality, relational
from millrace.sources import files


def test_a_failed_load_is_logged_and_raised(spark, tmp_path):
    log = str(tmp_path / "log")

    def fail(df):
        raise RuntimeError("no space")

    files.logged_load(spark.range(3), lambda d: d.write.parquet(str(tmp_path / "a")), "s", "a", "r1", log)
    with pytest.raises(RuntimeError):
        files.logged_load(spark.range(3), fail, "s", "b", "r2", log)
    got = sorted((r.run_id, r.target, r.row_count, r.status) for r in spark.read.parquet(log).collect())
    assert got == [("r1", "a", 3, "success"), ("r2", "b", None, "failure")]


def test_releases_and_observations_are_appended(spark, tmp_path):
    path, seen = str(tmp_path / "releases"), str(tmp_path / "seen")
    for version in ("2024", "2025"):
        files.record_release(spark, path, "icd", version, "http://x", "abc", f"{version}-10-01")
        files.record_observation(spark.createDataFrame([("slot", 5)], "slot_name string, retained_bytes long"), seen)
    assert sorted((r.version, str(r.published)) for r in spark.read.parquet(path).collect()) == [("2024", "2024-10-01"), ("2025", "2025-10-01")]
    assert spark.read.parquet(seen).filter("observed_at IS NOT NULL").count() == 2


def test_results_by_name(spark, tmp_path):
    path = str(tmp_path / "t")
    assert files.materialize(spark.range(3), "by_view", "view").count() == spark.table("by_view").count() == 3
    first = files.materialize(spark.range(3), "by_table", "table", path)
    assert files.materialize(spark.range(5), "by_table", "table", path).count() == spark.table("by_table").count() == 5 and first.count() == 3
    with pytest.raises(ValueError):
        files.materialize(spark.range(1), "x", "incremental", path)
    with pytest.raises(Exception):  # noqa: B017, PT011
        files.materialize(spark.range(3).select(F.raise_error(F.lit("bad")).alias("id")), "by_table", "table", path)
    assert files.materialize(spark.range(5, 7), "by_table", "incremental", path, lambda a, b: a.unionByName(b)).count() == 7


def test_state_advances_over_truncations(spark):
    rows = [(1, "U", 10), (2, "U", 11), (3, "D", 12), (None, "T", 20), (4, "U", 21), (1, "U", 22), (4, "D", 23), (5, "U", 24), (None, "T", 30), (6, "U", 31)]
    log = spark.createDataFrame([(k, op, lsn, 0) for k, op, lsn in rows], "k int, _op string, _lsn long, _seq int")
    for cuts in ([], [15], [15, 22], [20, 25], [11, 12, 23, 30]):
        state, before = None, 0
        for upto in [*cuts, 99]:
            state = changes.advance_state(state, log.filter((F.col("_lsn") > before) & (F.col("_lsn") <= upto)), ["k"])
            before = upto
        assert sorted(tuple(r) for r in state.filter("_op <> 'D'").collect()) == sorted(tuple(r) for r in changes.current_state(log, ["k"]).select(*state.columns).collect())


def test_routed_payloads_keep_digits_and_null_what_does_not_fit(spark):
    from pyspark.sql import types as T

    rows = [("a", "I", 1, 0, '{"id": 1, "amount": 12345678901234567.89}'), ("a", "U", 2, 0, '{"id": "x", "amount": 1.5}'), ("b", "D", 3, 0, '{"key": "k"}'), ("c", "I", 4, 0, "{}"), ("a", "I", 5, 0, None)]
    log = spark.createDataFrame(rows, "tbl string, op string, lsn long, seq int, payload string").withColumn("commit_ts", F.lit(None).cast("timestamp"))
    schemas = {"a": T.StructType([T.StructField("id", T.IntegerType()), T.StructField("amount", T.DecimalType(20, 2))]), "b": T.StructType([T.StructField("key", T.StringType())])}
    out = changes.route_changes(log, schemas)
    assert sorted(((r.id, str(r.amount), r["_lsn"]) for r in out["a"].collect()), key=lambda r: r[2]) == [(1, "12345678901234567.89", 1), (None, "1.50", 2), (None, "None", 5)]
    assert [(r.key, r["_op"]) for r in out["b"].collect()] == [("k", "D")]


def test_interval_join_keeps_repeated_events(spark):
    events = spark.createDataFrame([(1, "2020-01-05"), (1, "2020-01-05"), (2, "2020-01-05")], "k int, d string").withColumn("d", F.col("d").cast("date"))
    spans = spark.createDataFrame([(1, "2020-01-01", None, 7), (1, "2019-01-01", "2020-01-05", 5)], "k int, a string, b string, v int").select("k", F.col("a").cast("date").alias("a"), F.col("b").cast("date").alias("b"), "v")
    got = sorted((r.k, r.v) for r in relational.interval_join(events, spans, "k", "d", "a", "b", "min", value="v").collect())
    assert got == sorted([(1, 5), (1, 5), (2, None)], key=str)


def test_accents_fall_away(spark):
    from millrace.functions.columns import norm_ascii

    names = ["Škoda", "Őri", "Dvořák", "ﬁn", "Ñandú-7", "", None]
    frame = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in frame.select(norm_ascii(F.col("n"))).collect()] == ["skoda", "ori", "dvorak", "fin", "nandu", "", None]


def test_intake_again_adds_nothing_and_ids_go_on(spark):
    old = spark.createDataFrame([(4, "p", 1, 0)], "id long, provider string, submission long, day int")
    new = spark.createDataFrame([("p", 1, 9), ("p", 2, 3), ("q", 1, 2), ("q", 1, 5)], "provider string, submission long, day int")
    got = jobs.intake(old, new, ["provider", "submission"], "id", ["day"])
    assert sorted((r.id, r.provider, r.submission) for r in got.collect()) == [(5, "q", 1), (6, "p", 2)]
    assert jobs.intake(old.unionByName(got), new, ["provider", "submission"], "id", ["day"]).count() == 0


def test_code_check_reasons(spark):
    day = lambda s: F.to_date(F.lit(s))
    codes = spark.createDataFrame([("icd", "A"), ("icd", "A"), ("icd", "B"), ("icd", "C"), ("icd", None), ("x", "A"), ("icd", "D")], "system string, code string").withColumn("on_date", day("2020-05-01"))
    reference = spark.createDataFrame([("icd", "A", "2019-01-01", None, True), ("icd", "B", "2021-01-01", None, True), ("icd", "C", "2019-01-01", None, False)], "system string, code string, a string, b string, billable boolean")
    reference = reference.select("system", "code", F.to_date("a").alias("valid_from"), F.to_date("b").alias("valid_to"), "billable")
    got = {(r.system, r.code): (r.status, r.reason) for r in quality.check_codes(codes, reference).collect()}
    assert got == {
        ("icd", "A"): ("valid", "in force"), ("icd", "B"): ("invalid", "not in force"), ("icd", "C"): ("invalid", "not billable"), ("icd", "D"): ("invalid", "unknown code"), ("icd", None): ("invalid", "no code"), ("x", "A"): ("unverified", "no reference"),
    }
