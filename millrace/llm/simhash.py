"""SimHash near-duplicates: exact linking of 64-bit fingerprints within a Hamming radius.

Distinct fingerprints are dealt to tiles: the 64 bits are cut into radius + 1 bands, and two fingerprints within the
radius agree on at least one whole band, so each band's leading bits name a tile in which every such pair meets. The
number of leading bits follows the number of fingerprints, which keeps tiles near one size at any scale. A tile is
compared exactly in numpy by exclusive-or and bit counts, in blocks sorted by population count; block pairs whose counts differ by
more than the radius are skipped. Tiles over `TILE_MAX` rows are cut into sub-tiles whose pairs go to separate tasks.
Each tile returns a spanning forest of its links (fewer rows than it read), and classes are joined by label spreading.

Defined cases: null and word-less texts have fingerprint zero and link like any other; repeated rows share a
fingerprint and a class; the class id is the smallest doc_id in it (null ids count only where a class has no other);
an empty table gives an empty result; further columns are neither read nor returned by `components`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from millrace.llm.common import fresh, small_batches, stash, text_bytes, words_of
from millrace.operators.relational import component_labels, salted_join

SHINGLE, SEED, RADIUS, BITS = 3, 42, 2, 64
#: Fingerprints that a tile holds on average, the most before it is cut, and the block compared at once.
TILE_ROWS, TILE_MAX, BLOCK = 1024, 8192, 512
#: Copies of a fingerprint beyond which its documents are dealt to several tasks, and to how many.
HOT, SHARES = 100_000, 64


def fingerprint(text: bytes) -> int:
    words = words_of(text)
    if not words:
        return 0
    shingles = [b" ".join(words)] if len(words) < SHINGLE else map(b" ".join, zip(words, words[1:], words[2:], strict=False))
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(s, SEED) for s in shingles], "<u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(h), 65536):
        ones += np.unpackbits(h[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


@pandas_udf(T.LongType())
def _fingerprint(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in texts:
        yield pd.Series(np.array([fingerprint(t) for t in part], np.uint64).view(np.int64))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.col(doc_id).alias("doc_id"), _fingerprint(text_bytes(text)).alias("fp"))


def close_pairs(values: np.ndarray, radius: int, other: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links within `values`, or between `values` and `other`: (fingerprint, smaller one it reaches).

    Blocks are sorted by population count, and block pairs whose counts differ by more than the radius are skipped."""
    nodes = values if other is None else np.concatenate([values, other])
    order = np.argsort(np.bitwise_count(nodes), kind="stable")
    nodes, side = nodes[order], np.zeros(len(nodes), bool) if other is None else (order >= len(values))
    ones = np.bitwise_count(nodes).astype(np.int16)
    root = np.arange(len(nodes))
    for a in range(0, len(nodes), BLOCK):
        for b in range(a, len(nodes), BLOCK):
            if ones[b] - ones[min(a + BLOCK, len(nodes)) - 1] > radius:
                break
            left, right = nodes[a : a + BLOCK], nodes[b : b + BLOCK]
            near = np.bitwise_count(left[:, None] ^ right[None, :]) <= radius
            if other is not None:
                near &= side[a : a + BLOCK, None] != side[None, b : b + BLOCK]
            i, j = np.nonzero(near)
            _join(root, a + i, b + j)
    linked = root != np.arange(len(nodes))
    return nodes[linked], nodes[root[linked]]


def _join(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the classes of i[k] and j[k] for all k at once; `root` holds each node's smallest class member."""
    while True:
        x, y = root[i], root[j]
        apart = x != y
        if not apart.any():
            return
        i, j, x, y = i[apart], j[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root[:] = root[root]


_EDGES = "a long, b long"


def _tile_edges(radius: int):
    def run(tile: pa.Table) -> pa.Table:
        fp, part = tile["fp"].to_numpy().view(np.uint64), tile["part"].to_numpy()
        one = tile["i"][0].as_py() == tile["j"][0].as_py()
        mine = part == tile["i"][0].as_py()
        a, b = close_pairs(fp, radius) if one else close_pairs(fp[mine], radius, fp[~mine])
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return run


def links(distinct: DataFrame, n: int, radius: int = RADIUS, tile_rows: int = TILE_ROWS, tile_max: int = TILE_MAX) -> DataFrame:
    """(a, b): links within tiles that join exactly the fingerprints within the radius. `distinct` has one row per fp."""
    widths = [BITS // (radius + 1) + (k < BITS % (radius + 1)) for k in range(radius + 1)]
    starts = np.cumsum([0, *widths[:-1]]).tolist()
    prefix = max(0, math.ceil(math.log2(max(1, n) / tile_rows)))
    if not prefix:
        starts, widths = [0], [BITS]
    bands = [
        F.struct(F.lit(k).alias("band"), F.shiftrightunsigned(F.shiftleft("fp", s), BITS - min(w, prefix)).alias("head") if prefix else F.lit(0).cast("long").alias("head"))
        for k, (s, w) in enumerate(zip(starts, widths, strict=True))
    ]
    dealt = distinct.select("fp", F.explode(F.array(*bands)).alias("t")).select("fp", "t.band", "t.head")
    large = dealt.groupBy("band", "head").count().filter(F.col("count") > tile_max).select("band", "head", F.ceil(F.col("count") / (tile_max // 2)).cast("int").alias("parts"))
    dealt = dealt.join(large, ["band", "head"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    meets = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: F.struct(F.least(p, F.col("part")).alias("i"), F.greatest(p, F.col("part")).alias("j")))
    dealt = dealt.select("fp", "band", "head", "part", F.explode(meets).alias("m")).select("fp", "band", "head", "part", "m.i", "m.j")
    return dealt.groupBy("band", "head", "i", "j").applyInArrow(_tile_edges(radius), _EDGES)


def spread(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable, for each node of an edge."""
    return component_labels(edges).select("node", F.col("component").alias("label"))


def _labelled(distinct: DataFrame, radius: int) -> DataFrame:
    """The rows of `distinct` (one a fingerprint) with the class label of each."""
    labels = spread(links(distinct.select("fp"), distinct.count(), radius))
    return distinct.join(labels, distinct.fp == labels.node, "left").withColumn("label", F.coalesce("label", "fp")).drop("node")


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id for every row of `docs`."""
    found = stash(fingerprints(docs, doc_id, text), "fingerprints")
    distinct = stash(found.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies")), "distinct")
    named = _labelled(distinct, radius)
    classes = named.groupBy("label").agg(F.min("first").alias("component_id"))
    member = salted_join(named, classes, "label", "fp").select("fp", "component_id", "copies")
    # A fingerprint of very many documents is dealt to several tasks; there are at most (documents / HOT) of them.
    hot = distinct.filter(F.col("copies") > HOT).select("fp", F.lit(SHARES).alias("shares"))
    dealt = found.join(F.broadcast(hot), "fp", "left").withColumn("share", F.pmod(F.xxhash64("doc_id"), F.coalesce("shares", F.lit(1))).cast("int"))
    member = member.withColumn("share", F.explode(F.sequence(F.lit(0), F.when(F.col("copies") > HOT, SHARES - 1).otherwise(0))))
    return dealt.join(member, ["fp", "share"]).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row of each class stays, with all its columns: that with the smallest doc_id (nulls last), then fingerprint and text digest.

    A row is known by its id and its text's digest, so neither null nor repeated ids join rows of different texts; of rows
    alike in both any one stays."""
    small_batches(docs.sparkSession)
    mark, kept, kept_digest = fresh("digest", docs), fresh("keep", docs), fresh("keep_digest", docs)
    digest = F.md5(text_bytes(text))
    found = stash(docs.select(F.col(doc_id).alias("doc_id"), _fingerprint(text_bytes(text)).alias("fp"), digest.alias("digest")), "fingerprints")
    distinct = stash(found.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "fp", "digest")).alias("first")), "distinct")
    survivors = _labelled(distinct, radius).groupBy("label").agg(F.min("first").alias("k")).select(F.col("k.doc_id").alias(kept), F.col("k.digest").alias(kept_digest))
    stay = docs.withColumn(mark, digest).join(survivors, F.col(doc_id).eqNullSafe(F.col(kept)) & (F.col(mark) == F.col(kept_digest)), "left_semi")
    repeated = not found.groupBy("doc_id", "digest").count().filter("count > 1").isEmpty()
    return (stay.dropDuplicates([doc_id, mark]) if repeated else stay).drop(mark)
