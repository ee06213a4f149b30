"""The Merkle manifest against trees built by hand."""

import hashlib
import zlib

import pytest
from millrace.llm import merkle


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(r, text):
    return digest("".join(map(field, (r.doc_id, r.source, r.lang, r.n_chars, text))))


def tree(nodes):
    rows = [nodes]
    while len(rows[-1]) > 1:
        rows.append([digest("".join(rows[-1][k : k + 3])) for k in range(0, len(rows[-1]), 3)])
    return rows


def proof(rows, i):
    for row in rows[:-1]:
        k = i // 3 * 3
        yield row[k:i], row[i + 1 : k + 3]
        i //= 3


def by_hand(rows):
    sources = {}
    for r in rows:
        sources.setdefault(r.source, []).append((r.doc_id is not None, r.doc_id or 0, leaf(r, r.text), r))
    trees = {s: tree([x[2] for x in sorted(g, key=lambda x: x[:3])]) for s, g in sources.items()}
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    top = tree([trees[s][-1][0] for s in names])
    root, out = top[-1][0], []
    for j, s in enumerate(names):
        for i, (_, _, own, r) in enumerate(sorted(sources[s], key=lambda x: x[:3])):
            path = [*proof(trees[s], i), *proof(top, j)]
            node = own
            if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and r.text is not None:
                node = leaf(r, r.text.replace("\n", ""))
            for left, right in path:
                node = digest("".join(left) + node + "".join(right))
            out.append((r.doc_id, own, trees[s][-1][0], root, digest("".join(x for sides in path for side in sides for x in side)), node, node == root))
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is not None, v) for v in r))


ODD = [(None, None, "x", "y", 1, 9), (1, None, None, None, None, 9), (1, None, None, None, None, 9), (2, "", "a\nb", "e", 3, 9), (2, "", "a", "e", 3, 9), (7, "é", "\n" * 50_000, "e", 3, 9), (3, "lone", "", "e", 0, 9)]


@pytest.mark.parametrize(("height", "copies", "ranges"), [(1, 200, 7), (6, 9, None)])
def test_odd_rows_and_a_hot_source(spark, height, copies, ranges):
    rows = ODD + [(5, "hot", "a\nb" * 9, "e", 3, 9)] * copies + [(k, "hot", f"{k}\n", "e", 3, 9) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, lang string, n_chars long, leaf int")
    assert ordered(merkle.manifest(docs, height, ranges).collect()) == ordered(by_hand(docs.collect()))


def test_given_documents_and_no_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = merkle.manifest(docs).collect()
    assert ordered(got) == ordered(by_hand(docs.collect())) and 0 < sum(r.verified for r in got) < len(got)
    none = merkle.manifest(docs.limit(0))
    assert none.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"] and none.count() == 0


def test_lone_rows_and_large_ids(spark):
    docs = spark.createDataFrame([(2**60 + 1, "a", "t\n", None, 1), (None, "a", "t", None, 1)], "doc_id long, source string, text string, lang string, n_chars long")
    assert ordered(merkle.manifest(docs).collect()) == ordered(by_hand(docs.collect()))
    (only,) = merkle.manifest(docs.limit(1)).collect()
    assert only.leaf == only.subroot == only.root and only.proof_sha256 == digest("")
