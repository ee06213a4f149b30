"""What grows with pages or hosts does not go through the driver: it fits in memory there only while the tables are small."""

import pytest
from millrace.llm import url_filter as uf

BLOCK, ALLOW = "block", "allow"
LONG = "x" * 400
CASES = {
    "pages": [f"http://h{k % 3}.com/{'de' if k % 4 else 'en'}/{k}" for k in range(60_000)],
    "hosts": [f"http://h{k}.com/{'de' if k % 4 else 'en'}/{k}" for k in range(60_000)],
    "long paths without any label": [f"http://h{k % 3}.net/{LONG}/{k}" for k in range(20_000)],
}


@pytest.mark.parametrize("case", CASES)
def test_tables_that_grow_with_the_pages_are_not_broadcast(spark, case):
    """Spark refuses to broadcast more than 48 MB here; the least that a broadcast takes is one page of memory, 32 MB in these sessions."""
    frame = spark.createDataFrame(list(enumerate(CASES[case])), "page_id long, url string")
    spark.conf.set("spark.sql.maxBroadcastTableSize", "48m")
    try:
        got = {r.page_id: r for r in uf.judge(frame, cautious=True).collect()}
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    assert len(got) == len(CASES[case])
    assert all(got[k].verdict == (BLOCK if ".com/de/" in url else ALLOW) for k, url in enumerate(CASES[case]))
