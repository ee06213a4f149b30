"""Values at the end of members and places are taken straight from an item, and by lists only where the document is of another shape."""

import json

from pyspark.sql import functions as F

from millrace.operators.views import Col, Focused, Select, View, flatten_view, path

CODE = Col("code", path("kind.coding").first().get("code"))
VIEW = View("Claim", [Select([Col("id", path("id"))], union_all=[Select([CODE], for_each=path("a")), Select([CODE], for_each=path("b"))])])


def _docs(spark, *docs):
    return spark.createDataFrame([(json.dumps({"resourceType": "Claim", **d}),) for d in docs], "resource string")


def test_values_are_taken_straight(spark):
    assert "$.coding[0].code" in str(CODE.column(Focused(lambda: F.array(), F.col)))


def test_odd_shapes(spark):
    of = lambda *codes: {"kind": {"coding": [{"code": c} for c in codes]}}
    docs = [
        {"id": "plain", "a": [of("x", "y"), of("z")], "b": [of("w")]},
        {"id": "object", "a": {"kind": {"coding": {"code": "x"}}}},
        {"id": "lists", "a": [{"kind": [{"coding": [{"code": "x"}]}, {"coding": [{"code": "y"}]}]}]},
        {"id": "list value", "a": [of(["x"])]},
        {"id": "bracket", "b": [of("[x")]},
        {"id": "number", "b": [of(7)]},
        {"id": "none", "a": [{}, of(), of(None), {"kind": None}], "b": None},
        {"id": "no items"},
    ]
    got = sorted((r.id, r.code) for r in flatten_view(_docs(spark, *docs), VIEW).filter("code IS NOT NULL").collect())
    assert got == [("bracket", "[x"), ("list value", "x"), ("lists", "x"), ("number", "7"), ("object", "x"), ("plain", "w"), ("plain", "x"), ("plain", "z")]
    assert flatten_view(_docs(spark, *docs), VIEW).filter("id = 'none'").count() == 4
