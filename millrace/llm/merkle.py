"""Merkle manifest of a table of documents: a digest for each row, a tree of runs of three for each source, a tree over the sources,
and for each row its proof and the root that its (perhaps altered) content folds to.

A tree is cut into superblocks of 3^height neighbouring nodes. Each is reduced by itself to one node; the few nodes that are left form a smaller tree,
which is cut in the same way. Then every superblock is cogrouped with the outer nodes that it needs, its siblings on the way up, and finishes in one go:
local reduction, proofs joined to the outer ones, and folding. So no task holds more than a superblock, however many rows a source has.

Defined cases: an empty table gives an empty result. Rows without a doc_id come first in their source and are never altered; rows of one doc_id are in the
order of their digests, and equal rows, whose digests are equal too, each have a place. Rows without a source form a source of their own, the first. Fields
that are null count as `-`, empty texts as `0:`; texts are hashed whole. Further columns are not read."""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stash
from millrace.operators.relational import placed, salted_join

#: Nodes that become one node of the next level.
RUN = 3
#: Levels of a superblock: 3^6 = 729 nodes.
HEIGHT = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODES = "tree string, pos long, n long, node string"
PROOFS = "tree string, pos long, root string, lefts array<string>, rights array<string>"


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def row_digest(fields: Sequence[Column]) -> Column:
    """sha256 of fields one after another, each `-` if null, else its bytes' number, `:` and itself."""
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")), F.lit("-")) for f in fields)), 256)


def levels_above(n: int) -> int:
    """How many levels a tree of n leaves has above them."""
    up = 0
    while RUN**up < n:
        up += 1
    return up


def climb(nodes: list[str], up: int) -> list[list[str]]:
    """Nodes and the `up` levels above them."""
    rows = [nodes]
    for _ in range(up):
        below = rows[-1]
        rows.append([digest("".join(below[k : k + RUN])) for k in range(0, len(below), RUN)])
    return rows


def sides(rows: list[list[str]]) -> list[list[tuple[str, str]]]:
    """For each node of each level but the last: its siblings to the left and to the right, joined."""
    return [[("".join(row[k - k % RUN : k]), "".join(row[k + 1 : k - k % RUN + RUN])) for k in range(len(row))] for row in rows[:-1]]


def fold(node: str, path: Sequence[tuple[str, str]]) -> str:
    """The root that a node and its siblings, level by level, lead to."""
    for left, right in path:
        node = digest(left + node + right)
    return node


def reduced(nodes: DataFrame, height: int) -> DataFrame:
    """(tree, pos, n, node): the top node of each superblock as a leaf of the smaller tree."""

    def top(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("pos")
        n = int(part["n"].iloc[0])
        rows = climb(part["node"].tolist(), min(height, levels_above(n)))
        return pd.DataFrame({"tree": [key[0]], "pos": [int(key[1])], "n": [-(-n // RUN**height)], "node": [rows[-1][0]]})

    return nodes.withColumn("block", F.floor(F.col("pos") / F.lit(RUN**height)).cast("long")).groupBy("tree", "block").applyInPandas(top, NODES)


def proofs(nodes: DataFrame, most: int, height: int = HEIGHT) -> DataFrame:
    """(tree, pos, root, lefts, rights): root and siblings of each node of trees of at most `most` leaves."""
    tops = stash(reduced(nodes, height), "tops")
    none = F.array().cast("array<string>")
    if most <= RUN**height:
        outer = tops.select("tree", "pos", F.col("node").alias("root"), none.alias("lefts"), none.alias("rights"))
    else:
        outer = proofs(tops, -(-most // RUN**height), height)

    def finish(inner: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        inner = inner.sort_values("pos")
        rows = climb(inner["node"].tolist(), min(height, levels_above(int(inner["n"].iloc[0]))))
        beside, far = sides(rows), above.iloc[0]
        paths = [[level[k // RUN**up] for up, level in enumerate(beside)] for k in range(len(inner))]
        return pd.DataFrame(
            {
                "tree": inner["tree"], "pos": inner["pos"], "root": far["root"],
                "lefts": [[left for left, _ in path] + list(far["lefts"]) for path in paths],
                "rights": [[right for _, right in path] + list(far["rights"]) for path in paths],
            }
        )

    blocks = nodes.withColumn("block", F.floor(F.col("pos") / F.lit(RUN**height)).cast("long"))
    return blocks.groupBy("tree", "block").cogroup(outer.withColumnRenamed("pos", "block").groupBy("tree", "block")).applyInPandas(finish, PROOFS)


def leaves(docs: DataFrame) -> DataFrame:
    """(id, tree, leaf, tampered): digests of rows as they are, and without the line feeds of their texts where those are taken out (else null)."""
    fields = [F.col(c) for c in FIELDS]
    altered = [*fields[:-1], F.translate("text", "\n", "")]
    hit = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0) & F.col("text").contains("\n")
    tree = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit(""))
    return docs.select(F.col("doc_id").alias("id"), tree.alias("tree"), row_digest(fields).alias("leaf"), F.when(hit, row_digest(altered)).alias("tampered"))


def manifest(docs: DataFrame, height: int = HEIGHT, ranges: int | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for each row."""
    id_type = docs.schema["doc_id"].dataType
    at = placed(stash(leaves(docs), "leaves"), ["tree"], ["id", "leaf"], ranges)
    nodes = stash(at.select("tree", "pos", "n", F.col("leaf").alias("node"), "tampered", F.col("id").cast("string").alias("id")), "placed")
    most = nodes.agg(F.max("n")).first()[0] or 0
    # Superblocks as leaves of smaller trees: their roots are the subroots, and their siblings the outer nodes.
    tops = stash(reduced(nodes, height), "superblocks")
    over = stash(proofs(tops, -(-most // RUN**height), height), "outer")
    # The sources in order are the leaves of the one tree above.
    roots = placed(over.filter("pos = 0").select(F.lit("").alias("all"), "tree", F.col("root").alias("subroot")), ["all"], ["tree"], ranges)
    roots = stash(roots, "sources")
    up = proofs(roots.select(F.lit("").alias("tree"), "pos", "n", F.col("subroot").alias("node")), roots.count(), height)
    sources = roots.join(up.drop("tree"), "pos").select("tree", "subroot", "root", F.col("lefts").alias("lefts_up"), F.col("rights").alias("rights_up"))
    outer = salted_join(over.drop("root"), sources, "tree", "pos").select(
        "tree", F.col("pos").alias("block"), "subroot", "root", F.concat("lefts", "lefts_up").alias("lefts"), F.concat("rights", "rights_up").alias("rights")
    )

    def finish(inner: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        inner = inner.sort_values("pos")
        own = inner["node"].tolist()
        beside = sides(climb(own, min(height, levels_above(int(inner["n"].iloc[0])))))
        far = above.iloc[0]
        outside = list(zip(far["lefts"], far["rights"]))
        rest = "".join(left + right for left, right in outside)
        shown, folded = [], []
        for k, (node, other) in enumerate(zip(own, inner["tampered"])):
            path = [level[k // RUN**up] for up, level in enumerate(beside)]
            shown.append(digest("".join(left + right for left, right in path) + rest))
            folded.append(fold(fold(node if other is None else other, path), outside))
        return pd.DataFrame({"id": inner["id"], "leaf": own, "subroot": far["subroot"], "root": far["root"], "proof_sha256": shown, "folded_root": folded})

    blocks = nodes.withColumn("block", F.floor(F.col("pos") / F.lit(RUN**height)).cast("long"))
    done = blocks.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block"))
    done = done.applyInPandas(finish, "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return done.select(F.col("id").cast(id_type).alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
