"""Language-model scoring with a weighted backoff automaton.

The model smooths n-grams of up to `ORDER` tokens: P(w | h) = (count(h, w) + prior * P(w | shorter h)) / (count(h) + prior), with one prior for each
length, down to add-one unigrams. It is held as an automaton: a state for each history seen, an arc for each n-gram seen from its history, and
from each state a failure arc to the state of the history without its first word, whose weight is the mass left over; failure arcs chain down to the root,
which has an arc for every word. A text is read once from left to right, carrying the state, and the weights met are added up.

The model grows with the corpus, so no task holds all of it. Texts are dealt to blocks of about `BLOCK_BYTES`: consecutive rows of a partition, packed and
written once, so equal rows, whatever their number, fill as many blocks as they need. Each block
sends its distinct n-grams with their counts, packed by hash bucket; a bucket adds up the counts of all blocks and answers
each block in the same order; a block then builds the automaton of its own n-grams and reads its texts. Every n-gram of
every training document counts. No bucket or block grows with the corpus, and a frequent n-gram costs one entry a block. Buckets are as many as their memory
asks for (one for `BUCKET_BYTES` of texts). A block sends one row for each bucket it has something for, so rows grow with blocks times buckets at first and
never beyond one for each distinct n-gram of a block.

Words are known by 63-bit hashes, and longer n-grams by 40 bits within their bucket, sent as differences of ascending keys, so their counts are exact but for collisions,
whose chance for one n-gram is the number of a bucket's divided by 2**40, some millionths at every size of the corpus. Defined cases: null and empty texts are one end
token; without training tokens every probability is 1; repeated rows count and score as rows of their own; null ids are training rows; an empty table gives an empty
result; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from millrace.llm.common import portions, remainder, stash, text_bytes, word_hashes

MODULUS, HELD_OUT = 7, 2
#: Weight of the shorter history's probabilities, for histories of one word, of two words and so on; one more than their number is the order.
PRIORS = (300.0, 100.0)
BLOCK_BYTES = 4 << 20
#: Bytes of texts whose n-grams one bucket adds up, and the least number of buckets.
BUCKET_BYTES, LEAST_BUCKETS = 16 << 20, 16
#: Bits by which a bucket knows an n-gram of several words, and what a row counts for in a block beside its text.
KEY_BITS, ROW_BYTES = 40, 64
_END, _BEGIN = np.uint64(3), np.uint64(5)


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens (each text's words and an end), and where each text's tokens begin (one more entry)."""
    parts, counts = [], []
    for part in portions(texts):
        hashes, first = word_hashes(part)
        parts.append(np.insert(hashes, first[1:], _END))
        counts.append(np.diff(first) + 1)
    return np.concatenate(parts), np.concatenate([[0], np.cumsum(np.concatenate(counts))])


class _Block:
    """Distinct n-grams of a block of texts, for each length: `grams[k]` their hashes in ascending order and `at[k]` the number of the
    n-gram that ends at each token (-1: the text has no such n-gram there, as it would begin before the text's begin mark)."""

    def __init__(self, texts: list[bytes], order: int):
        tokens, self.first = _tokens(texts)
        place = np.arange(len(tokens)) - np.repeat(self.first[:-1], np.diff(self.first))
        self.grams, self.at = [], []
        gram = tokens
        for k in range(order):
            if k:
                # The n-gram one shorter that ends at the token before, and this token.
                before = np.concatenate([[_BEGIN], gram[:-1]])
                if k == 1:
                    before[self.first[:-1]] = _BEGIN
                gram = (before * np.uint64(0x9E3779B97F4A7C15)) ^ (tokens * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(0x165667B19E3779F9 + k))
                gram ^= gram >> np.uint64(31)
                gram = (gram * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(8)
            there = place >= k - 1
            distinct, at = np.unique(gram[there], return_inverse=True)
            number = np.full(len(tokens), -1, np.int32)
            number[there] = at
            self.grams.append(distinct)
            self.at.append(number)

    def places(self, buckets: int) -> list[tuple[int, list[np.ndarray]]]:
        """Bucket, and the places of its n-grams of each length in a fixed order; only buckets that have some."""
        split, used = [], []
        for k, hashes in enumerate(self.grams):
            # A word's hash is odd.
            of = ((hashes if k else hashes >> np.uint64(1)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(of, kind="stable")
            names, begins = np.unique(of[order], return_index=True)
            split.append(dict(zip(names.tolist(), np.split(order, begins[1:]) if len(order) else [], strict=True)))
            used.append(names)
        none = np.zeros(0, np.int64)
        return [(b, [part.get(b, none) for part in split]) for b in np.unique(np.concatenate(used)).tolist()]


def _packed(numbers: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(numbers, "<u8").view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    """Numbers are packed by byte planes: most counts are small, so most planes are empty."""
    return np.ascontiguousarray(np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1).T).reshape(-1).view("<u8")


def _keys(grams: np.ndarray, k: int, buckets: int) -> np.ndarray:
    """What a bucket knows ascending n-grams of k + 1 words by, ascending as well."""
    if k == 0:
        return grams
    return (grams // np.uint64(buckets)) >> np.uint64(max(0, (2**56 // buckets).bit_length() - KEY_BITS))


def _deal(block_bytes: int, kind: pa.DataType):
    """Consecutive rows as packed blocks: block, their ids, marks and text lengths, the texts, and the texts' size."""

    def packed(block: int, rows: list[tuple], size: int) -> pa.RecordBatch:
        ids, held_out, texts = zip(*rows, strict=True)
        values = [[block], [list(ids)], [list(held_out)], [[len(t) for t in texts]], [zstandard.ZstdCompressor(level=3).compress(b"".join(texts))], [size]]
        types = [pa.int64(), pa.list_(kind), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], ["block", "ids", "held_out", "lengths", "texts", "size"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rows, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for row in zip(batch["doc_id"].to_pylist(), batch["held_out"].to_pylist(), (t.as_py() for t in batch["text"]), strict=True):
                cost = len(row[2]) + ROW_BYTES
                if rows and size + cost > block_bytes:
                    yield packed(block, rows, size)
                    block, rows, size = block + 1, [], 0
                rows.append(row)
                size += cost
        if rows:
            yield packed(block, rows, size)

    return run


def _texts(packed: bytes, lengths: list[int]) -> list[bytes]:
    whole = zstandard.ZstdDecompressor().decompress(packed)
    cuts = np.cumsum([0, *lengths]).tolist()
    return [whole[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _send(buckets: int, order: int):
    names, types = ["bucket", "block", "keys", "counts"], [pa.int32(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.binary())]

    def messages(row: dict) -> list[tuple]:
        own = _Block(_texts(row["texts"], row["lengths"]), order)
        learnt = np.repeat(1.0 - np.array(row["held_out"]), np.diff(own.first))
        counts = [np.bincount(at[at >= 0], learnt[at >= 0], len(grams)).astype("<u8") for grams, at in zip(own.grams, own.at, strict=True)]
        keys = [_keys(grams, k, buckets) for k, grams in enumerate(own.grams)]
        sent = []
        for b, places in own.places(buckets):
            steps = [_packed(np.diff(keys[k][p], prepend=np.uint64(0))) for k, p in enumerate(places)]
            sent.append((b, row["block"], steps, [_packed(counts[k][p]) for k, p in enumerate(places)]))
        return sent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                sent = messages(batch.slice(i, 1).to_pylist()[0])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*sent, strict=True), types, strict=True)], names)

    return run


def _answer(sent: pa.Table) -> pa.Table:
    """Totals of each sender's n-grams in the order it sent them; with the first, tokens and distinct words in training."""
    keys, counts = sent["keys"].to_pylist(), sent["counts"].to_pylist()
    totals: list[list[bytes]] = [[] for _ in keys]
    for k in range(len(keys[0])):
        # One length at a time is unpacked.
        mine = [np.cumsum(_unpacked(part[k]), dtype=np.uint64) for part in keys]
        cuts = np.cumsum([len(m) for m in mine])[:-1]
        distinct, at = np.unique(np.concatenate(mine), return_inverse=True)
        del mine
        total = np.bincount(at, np.concatenate([_unpacked(part[k]) for part in counts]), len(distinct)).astype("<u8")
        for out, places in zip(totals, np.split(at, cuts), strict=True):
            out.append(_packed(total[places]))
        if k == 0:
            tokens, types = int(total.sum()), int((total > 0).sum())
    rest = np.zeros(len(keys) - 1, np.int64)
    return pa.table({
        "block": sent["block"], "bucket": sent["bucket"], "totals": pa.array(totals, pa.list_(pa.binary())),
        "tokens": np.concatenate([[tokens], rest]), "types": np.concatenate([[types], rest]),
    })


class Automaton:
    """Backoff automaton in arrays, for each length k of an n-gram: arcs[k] the log10 weight of each n-gram's arc from its history (nan: no such
    arc), fail[k] that of the failure arc of each history of k words (0 where there is no such state). The root's arcs are arcs[0]."""

    def __init__(self, arcs: Sequence[np.ndarray], fail: Sequence[np.ndarray]):
        self.arcs, self.fail = arcs, fail

    def read(self, at: Sequence[np.ndarray], history: Sequence[np.ndarray], first: np.ndarray) -> np.ndarray:
        """Log10 probability of each text. at[k]: the n-gram of k + 1 words that ends at each token; history[k]: the number of the history of k
        words before it (-1: none). A token is looked for from the longest history's state on, down the chain of failure arcs."""
        weight = np.zeros(len(at[0]))
        looking = np.arange(len(at[0]))
        for k in range(len(at) - 1, -1, -1):
            here = looking[at[k][looking] >= 0]
            arc = self.arcs[k][at[k][here]]
            seen = ~np.isnan(arc)
            weight[here[seen]] += arc[seen]
            missed = here[~seen]
            weight[missed] += self.fail[k][history[k][missed]]
            looking = np.union1d(looking[at[k][looking] < 0], missed)
        return np.add.reduceat(weight, first[:-1])


def _score(tokens_seen: int, types_seen: int, buckets: int, id_type: pa.DataType, priors: tuple[float, ...]):
    order = len(priors) + 1

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        ids, held_out = block["ids"].combine_chunks().flatten(), block["held_out"].combine_chunks().flatten()
        own = _Block(_texts(block["texts"][0].as_py(), block["lengths"][0].as_py()), order)
        got = dict(zip(answers["bucket"].to_pylist(), answers["totals"].to_pylist(), strict=True))
        count = [np.zeros(len(g)) for g in own.grams]
        for b, places in own.places(buckets):
            for k, part in enumerate(got[b]):
                count[k][places[k]] = _unpacked(part)
        unigram = (count[0] + 1) / (tokens_seen + types_seen + 1)
        begin, end = len(count[0]), int(np.searchsorted(own.grams[0], _END))
        arcs, fail, history = [np.log10(unigram)], [np.zeros(0)], [np.zeros(0, np.int64)]
        shorter = unigram[own.at[0]]  # probability of each token given the shorter history
        for k in range(1, order):
            # The history of a token's n-gram is the n-gram one shorter that ends at the token before; a begin mark is as frequent as an end.
            before = np.concatenate([[-1], own.at[k - 1][:-1]])
            seen = count[k - 1]
            if k == 1:
                before[own.first[:-1]] = begin
                seen = np.append(seen, seen[end])
            there = np.flatnonzero(own.at[k] >= 0)
            mine, past = own.at[k][there], seen[before[there]]
            smooth = (count[k][mine] + priors[k - 1] * shorter[there]) / (past + priors[k - 1])
            arc = np.full(len(count[k]), np.nan)
            arc[mine] = np.where(count[k][mine] > 0, np.log10(smooth), np.nan)
            arcs.append(arc)
            fail.append(np.where(seen > 0, np.log10(priors[k - 1] / (seen + priors[k - 1])), 0.0))
            history.append(before)
            shorter[there] = smooth
        base, known = np.log10(unigram)[own.at[0]], (count[0] > 0)[own.at[0]]
        cut = own.first[:-1]
        return pa.table({
            "doc_id": ids.cast(id_type), "held_out": held_out,
            "n_tokens": np.diff(own.first), "n_known": np.add.reduceat(known.astype(np.int64), cut),
            "train_tokens": np.full(len(cut), tokens_seen, np.int64), "base_score": np.add.reduceat(base, cut),
            "score": Automaton(arcs, fail).read(own.at, history, own.first),
        })

    return run


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", prior: float | None = None, block_bytes: int = BLOCK_BYTES, priors: tuple[float, ...] = PRIORS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score (unigrams) and score (the automaton) of every row.

    `priors` sets the smoothing and with it the order; `prior` is short for that of a bigram model."""
    priors = priors if prior is None else (prior,)
    order = len(priors) + 1
    kind = docs.schema[doc_id].dataType
    held_out = F.coalesce(remainder(doc_id, MODULUS) == HELD_OUT, F.lit(False))
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_bytes(text).alias("text"), held_out.alias("held_out"))
    layout = T.StructType([T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(kind)), T.StructField("held_out", T.ArrayType(T.BooleanType())), T.StructField("lengths", T.ArrayType(T.IntegerType())), T.StructField("texts", T.BinaryType()), T.StructField("size", T.LongType())])
    blocks = stash(rows.mapInArrow(_deal(block_bytes, to_arrow_type(kind)), layout).repartition("block"), "blocks")
    size = blocks.agg(F.sum("size").alias("n")).first().n or 0
    buckets = max(LEAST_BUCKETS, math.ceil(size / BUCKET_BYTES))
    sent = blocks.drop("ids", "size").mapInArrow(_send(buckets, order), "bucket int, block long, keys array<binary>, counts array<binary>")
    answers = stash(sent.groupBy("bucket").applyInArrow(_answer, "block long, bucket int, totals array<binary>, tokens long, types long"), "ngrams")
    seen = answers.agg(F.sum("tokens").alias("tokens"), F.sum("types").alias("types")).first()
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("held_out", T.BooleanType()), *(T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")), T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])
    run = _score(seen.tokens or 0, seen.types or 0, buckets, to_arrow_type(kind), priors)
    return blocks.drop("size").groupBy("block").cogroup(answers.select("block", "bucket", "totals").groupBy("block")).applyInArrow(run, schema)
