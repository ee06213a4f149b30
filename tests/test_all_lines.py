"""Join queries over all lines of the smallest tables."""

import pyarrow.parquet as pq

from millrace.operators import relational
from millrace.plans import catalog

DATA = "/root/testdata/sf0.001"


def by_union_find(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    members = {}
    for x in root:
        members.setdefault(find(x), []).append(x)
    return {x: (c, len(xs)) for c, xs in members.items() for x in xs}


def test_components_of_all_lines(spark):
    lines, orders = (pq.read_table(f"{DATA}/{t}.parquet").to_pydict() for t in ("lineitem", "orders"))
    customer = dict(zip(orders["o_orderkey"], orders["o_custkey"], strict=True))
    edges = {(customer[o], s + 1000000000) for o, s in zip(lines["l_orderkey"], lines["l_suppkey"], strict=True) if o in customer}
    got = {r.node: (r.component, r.size) for r in catalog.QUERIES["j17_components_all"](spark, DATA).collect()}
    assert got == by_union_find(edges)


def test_components_of_many_classes(spark):
    edges = [(k * 7 % 90, 100 + k * 11 % 83) for k in range(60)]
    got = relational.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: (r.component, r.size) for r in got} == by_union_find(edges)


def test_every_line_is_joined(spark):
    n = pq.read_metadata(f"{DATA}/lineitem.parquet").num_rows
    assert catalog.QUERIES["j03_composite_key_all"](spark, DATA).count() >= n
