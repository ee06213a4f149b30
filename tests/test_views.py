"""View expressions: comparisons, arithmetic, unions, closures, constants and validation."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import views as v

DOC = """{"resourceType": "Q", "id": "q1", "n": 3, "d": 1.5, "t": "x", "flag": true, "tags": ["a", "b", "a"], "other": ["b", "c"], "nothing": null,
 "subject": {"reference": "Patient/p1"}, "item": [{"linkId": "1", "item": [{"linkId": "1.1", "item": [{"linkId": "1.1.1"}]}, {"linkId": "1.2"}]}, {"linkId": "2"}],
 "mixed": ["s", 1, 2.5, true], "code": [{"k": 5}, {"k": 7.0}]}"""


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(DOC,), ('{"resourceType": "Q", "id": "q2"}',)], "text string").select(F.parse_json("text").alias("resource"))


def values(docs, **columns):
    """The first document's columns."""
    cols = [v.Col(name, e, *(("string", True) if isinstance(e, v.Expr) else ())) for name, e in columns.items()]
    rows = v.flatten_view(docs, v.View("Q", [v.Select([v.Col("key", v.this().resource_key()), *cols])])).collect()
    return next(r.asDict() for r in rows if r.key == "q1"), next(r.asDict() for r in rows if r.key == "q2")


def test_comparisons_and_booleans(docs):
    n, d, t, gone = v.path("n"), v.path("d"), v.path("t"), v.path("gone")
    one, two = values(
        docs, a=n.compare("=", v.constant(3.0)), b=n.compare(">", d), c=t.compare("!=", v.constant("x")), e=gone.compare("=", n), f=v.negated(n.compare("<=", v.constant(2))),
        g=v.both(gone.compare("=", n), n.compare("=", v.constant(4))), h=v.either(gone.compare("=", n), n.compare("=", v.constant(3))), i=v.one_of_two(n.compare("=", n), t.compare("=", v.constant("y"))),
        j=v.constant("10").compare("<", v.constant("9")), k=v.constant(10).compare("<", v.constant(9)),
    )
    assert [one[x] for x in "abcefghijk"] == [True, True, False, None, True, False, True, True, True, False]
    assert two["a"] is None and two["f"] is None


def test_arithmetic_union_and_types(docs):
    n, d = v.path("n"), v.path("d")
    one, two = values(
        docs, a=n.arithmetic("+", v.constant(4)), b=n.arithmetic("*", d), c=n.arithmetic("/", v.constant(2)), e=n.arithmetic("-", v.path("t")), f=v.path("tags").union(v.path("other")),
        g=v.path("mixed").values_of("string"), h=v.path("mixed").values_of("integer"), i=v.path("mixed").values_of("decimal"), j=v.path("mixed").values_of("boolean"),
        k=v.path("code").filter(lambda x: x.get("k").compare(">", v.constant(5))).get("k"),
    )
    assert [one[x] for x in "abcefghijk"] == [["7"], ["4.5"], ["1.5"], [], ["a", "b", "c"], ["s"], ["1"], ["2.5"], ["true"], ["7"]]
    assert two["a"] == [] and two["f"] == []


def test_closure_is_in_pre_order_and_bounded(docs):
    one, two = values(docs, a=v.this().repeat("item").get("linkId"), b=v.this().repeat("item", depth=2).get("linkId"))
    assert one["a"] == ["1", "1.1", "1.1.1", "1.2", "2"] and one["b"] == ["1", "1.1", "1.2", "2"] and two["a"] == []


def test_references(docs):
    one, two = values(docs, a=v.path("subject").reference_key(), b=v.path("subject").reference_key("Patient"), c=v.path("subject").reference_key("Group"))
    assert (one["a"], one["b"], one["c"], two["a"]) == ("p1", "p1", None, None)


def test_union_of_branches(docs):
    code = lambda e, kind: v.Select([v.Col("code", e), v.Col("kind", v.constant(kind))], for_each=v.path(kind))
    view = v.View("Q", [v.Select([v.Col("key", v.path("id"))], union_all=[code(v.this(), "tags"), code(v.path("linkId"), "item")])])
    got = sorted(tuple(r) for r in v.flatten_view(docs, view).collect())
    assert got == sorted([("q1", "a", "tags"), ("q1", "b", "tags"), ("q1", "a", "tags"), ("q1", "1", "item"), ("q1", "2", "item")])


def test_validation(docs):
    col = lambda name: v.Col(name, v.path("id"))
    bad = [
        [v.Select([col("a")]), v.Select([col("a")])], [v.Select([col("1a")])], [v.Select([col("a")], or_null=True)], [v.Select([col("a")], row_index="i")],
        [v.Select(union_all=[v.Select([col("a")]), v.Select([col("b")])])], [v.Select(union_all=[v.Select([col("a")], select=[v.Select([col("b")])])])],
    ]
    for select in bad:
        with pytest.raises(ValueError):
            v.flatten_view(docs, v.View("Q", select))
    with pytest.raises(ValueError):
        v.flatten_view(docs, v.View("Q", [v.Select([col("a")])], [v.path("id").count()]))
    assert v.flatten_view(docs, v.View("Q", [v.Select([col("a")])], [v.path("n").exists()])).count() == 1


def test_numbers_are_exact(docs):
    c, sums = v.constant, lambda a, op, b: v.constant(a).arithmetic(op, v.constant(b))
    one, _ = values(
        docs, a=sums(0.1, "+", 0.2), b=sums(1, "/", 4), c=sums(1, "/", 3), e=sums(2**53, "+", 1), f=sums(19.99, "*", 3), g=sums(0.3, "-", 0.1), h=sums(2**62, "*", 4), i=sums(1, "/", 0),
        j=c(2**53 + 1).compare("=", c(2**53)), k=c(2**53 + 1).compare(">", c(2**53)), l=sums(0.1, "+", 0.2).compare("=", c(0.3)), m=c(1).compare("=", c(1.0)), n=c(1e300).compare(">", c(2**60)), o=sums(1e300, "*", 10),
    )
    assert [one[x] for x in "abcefgi"] == [["0.3"], ["0.25"], ["0.33333333333333333333"], ["9007199254740993"], ["59.97"], ["0.2"], []]
    assert float(one["h"][0]) == 2.0**64 and float(one["o"][0]) == 1e301 and [one[x] for x in "jklmn"] == [False, True, True, True, True]


def test_members_that_are_arrays_or_not(spark):
    """A compiled view reads scalars, arrays, nulls and odd items alike from text and from VARIANT; several values for one column are an error."""
    texts = [
        '{"resourceType": "Q", "id": "a", "item": [{"n": 1, "p": {"q": [1, 2]}}, 5, null, {"n": [2], "p": [{"q": 3}, {"q": null}]}]}', '{"resourceType": "Q", "id": ["b"], "item": {"n": 7, "p": "x"}}',
        '{"resourceType": "Q", "id": null, "item": []}', '{"resourceType": "Q"}', '{"resourceType": "R", "id": "z", "item": [{"n": 9}]}', '{"id": "none"}',
    ]
    df = spark.createDataFrame([(t, k) for k, t in enumerate(texts)], "resource string, k int")
    part = v.Select([v.Col("n", v.path("n"), "int"), v.Col("q", v.path("p.q"), "int", True)], for_each=v.path("item"), or_null=True, row_index="at")
    view = v.View("Q", [v.Select([v.Col("id", v.path("id"))], select=[part])])
    want = sorted([(0, "a", 0, 1, [1, 2]), (0, "a", 1, None, []), (0, "a", 2, None, []), (0, "a", 3, 2, [3]), (1, "b", 0, 7, []), (2, None, 0, None, []), (3, None, 0, None, [])], key=repr)
    for source in (df, df.withColumn("resource", F.parse_json("resource"))):
        assert sorted(((r.k, r.id, r.at, r.n, r.q) for r in v.flatten_view(source, view, ["k"]).collect()), key=repr) == want
        several = source.filter("k = 0").select(F.lit('{"resourceType": "Q", "id": ["x", "y"]}').alias("resource"))
        for frame in (several, several.select(F.parse_json("resource").alias("resource"))):
            with pytest.raises(Exception, match="id has several values"):
                v.flatten_view(frame, v.View("Q", [v.Select([v.Col("id", v.path("id"))])])).collect()
            assert v.flatten_view(frame, v.View("Q", [v.Select([v.Col("id", v.path("id"), collection=True)])])).first().id == ["x", "y"]
    inner = v.Select([v.Col("v", v.this(), "int")], for_each=v.path("p.q"))
    nested = v.View("Q", [v.Select(select=[v.Select([v.Col("n", v.path("n"), "int")], for_each=v.path("item"), select=[inner])])])
    assert sorted((r.n, r.v) for r in v.flatten_view(df, nested).collect()) == [(1, 1), (1, 2), (2, 3)]


def test_compiled_plan_reads_only_members_used(docs, spark):
    text = spark.createDataFrame([(DOC,)], "resource string")
    plan = v.flatten_view(text, v.View("Q", [v.Select([v.Col("key", v.path("id"))])]))._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json(StructField(id,VariantType" in plan and "StructField(item" not in plan and "parseJson" not in plan
