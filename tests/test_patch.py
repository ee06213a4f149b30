"""Patches by schema: members dropped, made anew and filtered at any depth, in lists and out; and documents without amounts."""

import json

import pytest
from millrace.operators import benefits
from millrace.plans import benefits as plans
from pyspark.sql import functions as F

SCHEMA = "d struct<a:int, b:struct<c:string, e:array<struct<f:int, g:array<struct<h:int, i:string>>>>>, k:array<int>>"


def test_patch_at_any_depth(spark):
    rows = [((1, ("x", [(1, [(1, "p"), (2, None)]), (2, None), (3, [(3, None)])]), [1, 2]),), ((None, None, None),), (None,)]
    df = spark.createDataFrame(rows, SCHEMA)
    kind = df.schema["d"].dataType
    made = lambda **how: [json.loads(r.j) if r.j else None for r in df.select(F.to_json(benefits.patched(F.col("d"), kind, **how)).alias("j")).collect()]
    assert made()[0] == {"a": 1, "b": {"c": "x", "e": [{"f": 1, "g": [{"h": 1, "i": "p"}, {"h": 2}]}, {"f": 2}, {"f": 3, "g": [{"h": 3}]}]}, "k": [1, 2]}
    got = made(drop=["a", "b.e.f", "b.e.g.h"], replace={"b.c": F.upper, "k": lambda k: F.transform(k, lambda x: x * 10)}, keep={"b.e.g": lambda x: x["i"].isNotNull()})
    assert got == [{"b": {"c": "X", "e": [{"g": [{"i": "p"}]}, {}, {}]}, "k": [10, 20]}, {}, None]
    with pytest.raises(ValueError, match="b.nothing"):
        made(drop=["b.nothing"])


def test_documents_without_amounts_hold_none(spark):
    docs = plans.documents(spark, "/root/testdata/sf0.001")
    whole, bare = docs.select(F.to_json("document").alias("j")), benefits.without_amounts(docs).select(F.to_json("document").alias("j"))
    assert whole.filter("j LIKE '%currency%'").count() == whole.count() == bare.count() and bare.filter("j LIKE '%currency%' OR j LIKE '%USD%' OR j LIKE '%paidbypatient%'").isEmpty()
    assert bare.filter("j NOT LIKE '%benefitpaymentstatus%'").select(F.get_json_object("j", "$.type.coding[0].code").alias("t")).filter("t <> 'professional'").isEmpty()
