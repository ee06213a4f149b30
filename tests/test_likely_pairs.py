"""Queries that ask for likely pairs alone do not make the pairs of large blocks that cannot be likely, and lose none that is."""

import math
from datetime import date, timedelta
from itertools import product

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace.operators import relational
from millrace.plans import catalog, people


def test_no_likely_pair_is_left_out():
    """Of all levels that a pair of the third rule can have, those of dates over a month apart and of unequal last names reach no even odds."""
    weight = lambda name, k: 0.0 if k < 0 else math.log2(people.M[name][k] / people.U[name][k])
    prior = math.log2(people.PRIOR / (1 - people.PRIOR))
    left_out = [prior + weight("first", f) + weight("last", n) + weight("born", 2) + weight("zip", 0) for f, n in product((0, 1, 2), (1, 2))]
    assert 1 / (1 + 2 ** -max(left_out)) < people.REVIEW
    assert people.LIKELY_RULES[:2] == people.RULES[:2] and people.LIKELY_RULES[2] == (*people.RULES[2][:2], "born_in")


@pytest.fixture(scope="module")
def crowded(spark, tmp_path_factory):
    """1,200 customers of one first name, area and month of birth, born on twenty days of seven years: most pairs of the third rule are years apart."""
    folder = str(tmp_path_factory.mktemp("likely"))
    start = date(1940, 1, 1)
    days = [d for d in range(0, 20_000, 10) if (start + timedelta(d)).month == 3][:20]
    keys = spark.createDataFrame([(d * pow(37, -1, 20_000) % 20_000 + 20_000 * k,) for d in days for k in range(60)], "c_custkey long")
    keys.withColumns({"c_nationkey": F.lit(1), "c_acctbal": F.lit(5.0), "c_mktsegment": F.lit("A")}).write.parquet(f"{folder}/customer.parquet")
    return folder


@pytest.mark.parametrize("name", ["i14_cross_reference", "i15_review_queue", "i17_match_quality"])
def test_unlikely_pairs_are_not_made(spark, crowded, name, monkeypatch):
    every = relational.candidate_pairs
    made = []
    monkeypatch.setattr(relational, "candidate_pairs", lambda *args, **more: made.append(every(*args, **more)) or made[-1])
    catalog.QUERIES[name](spark, crowded)
    members, others = people._sides(spark, crowded)
    candidates = every(others, "id", people.RULES, members).count()
    assert made and all(pairs.count() < candidates / 3 for pairs in made)
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW customer AS SELECT * FROM '{crowded}/customer.parquet/*.parquet'")
    got = catalog.QUERIES[name](spark, crowded).toArrow()
    duck.register("got", got)
    want, columns = catalog.SQL[name], ", ".join(got.column_names)
    assert duck.execute(f"SELECT (SELECT count(*) FROM ({want})) - count(*) FROM got").fetchall() == [(0,)]
    assert duck.execute(f"SELECT {columns} FROM ({want}) EXCEPT ALL SELECT {columns} FROM got").fetchall() == []


def test_carried_columns_of_rules_are_the_same(spark):
    rows = spark.createDataFrame([(k, k % 3, f"p{k}") for k in range(9)], "id long, a long, name string")
    got = {tuple(r) for r in relational.candidate_pairs(rows, "id", [("a",)], carry=["name", "a"]).select("id_l", "id_r", "name_l", "name_r", "a_l", "a_r").collect()}
    assert got == {(x, y, f"p{x}", f"p{y}", x % 3, y % 3) for x in range(9) for y in range(x + 1, 9) if x % 3 == y % 3}
