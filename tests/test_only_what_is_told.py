"""Documents of benefits are read back without the members that no column is made of, and their lists are made once."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.benefits import patched
from millrace.plans import benefits


def test_only_members_on_a_path(spark):
    kind = T._parse_datatype_string("id string, kind struct<system: string, coding: array<struct<system: string, code: string>>>, span struct<start: string, until: string>, other int")
    got = benefits._only(kind, ["id", "kind.coding.code", "span", "gone.code"])
    assert got == T._parse_datatype_string("id string, kind struct<coding: array<struct<code: string>>>, span struct<start: string, until: string>")


def test_told_members_are_among_those_made(spark):
    documents = benefits.documents(spark, "/root/testdata/sf0.001")
    read = benefits._only(documents.schema["document"].dataType, benefits._TOLD)
    text = read.simpleString()
    assert "currency" not in text and "system:string,code" not in text and "insurer" not in text and "amount:struct<value:double>" in text


def test_kept_items_are_filtered_once(spark):
    df = spark.sql("SELECT id, named_struct('a', a) AS d FROM VALUES (1, array(1, null, 3)), (2, array(null, 3)), (3, array()), (4, null), (5, array(null)) AS t(id, a)")
    out = patched(F.col("d"), df.schema["d"].dataType, keep={"a": lambda x: x < 2})
    assert str(out).count("filter(") == 1
    assert [r.d.a for r in df.select("id", out.alias("d")).orderBy("id").collect()] == [[1], None, None, None, None]
