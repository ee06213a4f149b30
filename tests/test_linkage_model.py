"""A linkage model learnt, stored and read back: its scores equal SQL given the same numbers, and its decisions equal the truth."""

import duckdb
import pytest
from millrace.operators import identity, relational
from millrace.plans import people
from millrace.sources.shared import settle

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def linked(spark):
    members, others = people._sides(spark, DATA)
    compared, comparisons, model = people.trained(spark, others, members, settle(relational.candidate_pairs(others, "id", people.RULES, members).select("id_l", "id_r")))
    return settle(compared), comparisons, model


def test_scores_equal_sql_given_the_same_numbers(spark, linked, tmp_path):
    compared, comparisons, model = linked
    identity.store_model(spark, model, str(tmp_path / "model"))
    assert identity.stored_model(spark, str(tmp_path / "model")) == model
    got = {(r.id_l, r.id_r): (r.match_weight, r.match_probability) for r in identity.score(compared, comparisons, model.m, model.u, model.prior, threshold=0.0).collect()}
    duck = duckdb.connect()
    duck.register("g", compared.select("id_l", "id_r", "gamma_first", "gamma_last", "gamma_born", "gamma_zip").toArrow())
    duck.sql(f"CREATE VIEW w AS SELECT comparison, level, log2(m / u) AS step, prior FROM '{tmp_path}/model/*.parquet'")
    steps = " + ".join(f"coalesce((SELECT step FROM w WHERE comparison = '{c}' AND level = gamma_{c}), 0)" for c in ("first", "last", "born", "zip"))
    rows = duck.sql(f"SELECT id_l, id_r, (SELECT log2(any_value(prior) / (1 - any_value(prior))) FROM w) + {steps} AS weight FROM g").fetchall()
    assert len(rows) == len(got) and all(abs(got[a, b][0] - w) < 1e-9 and abs(got[a, b][1] - 1 / (1 + 2.0**-w)) < 1e-9 for a, b, w in rows)


def test_trained_scores_find_the_same_people(linked):
    compared, comparisons, model = linked
    assert {c.name: len(model.m[c.name]) for c in comparisons} == {"first": 6, "last": 3, "born": 6, "zip": 2} and 1e-4 < model.prior < 1e-2
    sure = identity.score(compared, comparisons, model.m, model.u, model.prior, threshold=0.95).select("id_l", "id_r").collect()
    right = sum(r.id_l - people.OFFSET == r.id_r for r in sure)
    assert right >= 0.98 * len(sure) and right >= 0.9 * 1500


def test_dedupe_learns_its_own_u(spark):
    sure = [r for r in people.i11_trained(spark, DATA).collect() if r.match_probability >= 0.95]
    right = sum(r.id_r - r.id_l == 50_000_000 for r in sure)
    assert right >= 0.95 * len(sure) and right >= 0.9 * 150


def test_only_some_rows_of_large_tables_are_shuffled(spark):
    """Of 400,000 and 300,000 rows, 5,000 pairs: about as many rows a side are kept, and pairs are drawn evenly."""
    left, right = spark.range(400_000).withColumnRenamed("id", "id_l"), spark.range(300_000).withColumnRenamed("id", "id_r")
    drawn = identity.random_pairs(left, right, n=5_000).collect()
    assert 4_000 < len(drawn) < 6_000 and len(set(drawn)) == len(drawn) and abs(sum(r.id_l for r in drawn) / len(drawn) - 200_000) < 12_000
