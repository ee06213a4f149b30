import sys
import unicodedata

from pyspark.sql import functions as F

from millrace.functions import columns as c


def test_every_character_as_decomposed(spark):
    chars = [chr(k) for k in (*range(1, 0xD800), *range(0xE000, sys.maxunicode + 1))]
    texts = ["".join(chars[k : k + 500]) for k in range(0, len(chars), 500)] + [f"A{x}b" for x in chars if unicodedata.decomposition(x)][::7] + ["", None]
    got = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").select("k", c.norm_ascii(F.col("t")).alias("n")).collect()
    want = [None if t is None else "".join(x for x in unicodedata.normalize("NFKD", t).lower() if "a" <= x <= "z") for t in texts]
    assert [r.n for r in sorted(got)] == want


def test_only_texts_with_ligatures_reach_python(spark, monkeypatch):
    """Of other texts Python is handed nulls, so its memory does not grow with them."""
    monkeypatch.setattr(c, "_plain_letters", lambda given: given)
    frame = spark.createDataFrame([("Éa-Ｂ",), ("oﬁn",), (None,)], "t string")
    assert [r[0] for r in frame.select(c.norm_ascii(F.col("t"))).collect()] == ["eab", "oﬁn", None]
