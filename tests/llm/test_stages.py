"""Each stage of the pipeline on an odd table: columns that clash, nulls, repeated rows, very long texts, none at all."""

import corpus_pipeline
import pytest

DATA = "/root/testdata/sf0.001"
PROSE = "the quick brown fox jumps over a lazy dog while seven clever birds watch from old trees by the quiet river and nobody else is there to see it"
ROWS = [
    (1, None, "en", "a", 0, "x"), (2, "", "en", "a", 0, "x"), (3, PROSE, "en", "a", 1, "x"), (3, PROSE, "en", "a", 1, "x"), (None, PROSE + " twice", None, None, None, None),
    (4, " ".join(f"{PROSE} {k}" for k in range(5000)), "en", "a", 1, "x"), (5, " \n\t ", "de", "b", 0, "y"), (6, "▁ \x00", "de", "b", 0, "y"),
]


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_stage_on_odd_tables(spark, name, stage):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long, `ids` string").withColumnRenamed("ids", "__quality")
    out = stage(spark, docs, DATA)
    rows = out.collect()
    assert stage(spark, docs.limit(0), DATA).count() == 0
    if name == "sentencepiece":
        assert out.columns == ["doc_id", "ids", "n_ids", "round_trip"] and len(rows) == len(ROWS) and all(r.round_trip for r in rows)
    else:
        assert out.columns == docs.columns and {tuple(r) for r in rows} <= set(ROWS) and {r.doc_id for r in rows} >= {3, None}
