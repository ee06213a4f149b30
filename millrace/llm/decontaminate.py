"""Benchmark decontamination: passages within a small edit distance of benchmark items.

A random-walk embedding (CGK) reads a window of words: at each step it writes the word under its pointer and moves on or
stays, as a random bit of that word and step says, which turns edit distance into Hamming distance. A hash table keeps a few
places of that embedding, one sampled from each equal part of it. A copy with a fifth of its words edited has no long stretch left as it was,
so the window of an item is read by short walks begun at each of its words, and a text by the same walks begun at each of its own. Items
fall in size classes (`CLASSES`: least words, steps of a walk, places sampled). Each class has as many tables, with walks of their
own, as bring the recall measured on simulated copies with the most edits allowed to `TARGET`. Hits near one diagonal are one candidate; it must
share enough words with the item, and is then verified by exact word edit distance, at most one fifth of the item's words.

A text is searched by itself, so its verdict is the same in every batch and every attempt. Words are compared without case (A-Z) and ASCII punctuation. Items are
taken in blocks of at most `ITEMS` items and `ITEM_BYTES` bytes of text (one pass over the texts each), so what is broadcast has a bound;
an item longer than that is a block of its own. Defined cases: null and empty texts and items match nothing; items that are equal as
words are each reported; repeated rows report alike; an empty table gives an empty result; further columns are not read
by `matches` and kept as they are by `keep_unleaked`, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from millrace.llm.common import SPACES_AND_MARKS, fresh, portions, ragged, small_batches, text_bytes, word_hashes

EDITS, TARGET = 0.2, 0.98
#: Size classes of items: (least words, steps of a walk, places sampled). A walk of s steps reads at most s words.
CLASSES = ((1, 1, 1), (2, 2, 2), (4, 4, 2), (8, 6, 3), (16, 8, 4))
MOST_TABLES, TRIALS = 16, 600
ITEMS, ITEM_BYTES = 20_000, 8 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
_GAP = CLASSES[-1][1]


class _Walk:
    """One table's walk over words that are given as 64-bit hashes."""

    def __init__(self, size: int, repetition: int):
        rng = np.random.default_rng([size, repetition])
        _, self.steps, bits = CLASSES[size]
        edges = np.linspace(0, self.steps, bits + 1).astype(int)
        self.sampled = {int(rng.integers(a, b)) for a, b in zip(edges[:-1], edges[1:], strict=True)}
        self.salt = np.uint64(rng.integers(1, 2**63) | 1)

    def keys(self, words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Key of the walk begun at each start, and the last word it read; `words` ends in at least `_GAP` blanks (0)."""
        mixed = words * self.salt
        mixed ^= mixed >> np.uint64(29)
        at, key = starts.astype(np.int64), np.zeros(len(starts), np.uint64)
        last = max(self.sampled)
        for step in range(last + 1):
            word = mixed[at]
            if step in self.sampled:
                key = (key ^ word) * _MIX
                key ^= key >> np.uint64(32)
            if step < last:
                at += ((word >> np.uint64(step)) & np.uint64(1)).astype(np.int64)
        return key, at


def size_class(n_words: int) -> int:
    return max(k for k, (least, _, _) in enumerate(CLASSES) if n_words >= least)


def edited(words: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    """A copy with so many edits at places of their own: words replaced, left out or put in."""
    out: list[np.ndarray] = []
    at = 0
    for place in sorted(rng.choice(len(words), edits, replace=False).tolist()):
        kind, new = rng.choice(3, p=(0.7, 0.15, 0.15)), rng.integers(1, 2**63, 1).astype(np.uint64) | np.uint64(1)
        out += [words[at:place], *([] if kind == 1 else [new]), *([words[place : place + 1]] if kind == 2 else [])]
        at = place + 1
    return np.concatenate([*out, words[at:]])


@lru_cache(maxsize=None)
def walks(size: int, target: float = TARGET) -> tuple[_Walk, ...]:
    """The tables of a size class: as many as it takes for the share `target` of simulated copies with the most edits to be met, for
    each of several lengths in the class. Copies of items without a permitted edit are always met."""
    least = CLASSES[size][0]
    rng = np.random.default_rng(size)
    pairs, lengths = [], [n for n in range(least, 2 * least) if int(EDITS * n)]
    for n in lengths:
        for _ in range(TRIALS // len(lengths) + 1):
            item = rng.integers(1, 2**63, n).astype(np.uint64) | np.uint64(1)
            pairs.append((n, item, edited(item, int(EDITS * n), rng)))
    length, met = np.array([n for n, *_ in pairs]), np.zeros(len(pairs), bool)
    out: list[_Walk] = []
    while not out or (lengths and len(out) < MOST_TABLES and min(met[length == n].mean() for n in lengths) < target):
        out.append(_Walk(size, len(out)))
        for k in np.flatnonzero(~met):
            own = [_starts(out[-1], w)[0] for w in pairs[k][1:]]
            met[k] = bool(np.isin(own[0], own[1]).any())
    return tuple(out)


def _starts(walk: _Walk, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and starts of the walks that stay within `words`."""
    starts = np.arange(len(words))
    key, last = walk.keys(np.concatenate([words, np.zeros(_GAP, np.uint64)]), starts)
    return key[last < len(words)], starts[last < len(words)]


def edit_distance(item: np.ndarray, words: np.ndarray) -> tuple[int, int]:
    """Least edit distance from `item` to any stretch of `words`, and where the first such stretch ends."""
    row = np.zeros(len(words) + 1, np.int64)
    place = np.arange(len(words) + 1)
    for k, x in enumerate(item, 1):
        new = np.concatenate([[k], np.minimum(row[:-1] + (words != x), row[1:] + 1)])
        row = np.minimum.accumulate(new - place) + place
    end = int(row.argmin())
    return int(row[end]), end


class _Table(NamedTuple):
    walk: _Walk
    key: np.ndarray
    owner: np.ndarray
    offset: np.ndarray
    present: np.ndarray  # whether some key has these leading bits


class Index:
    """Hash tables of a block of items. items: (id, text)."""

    def __init__(self, items: list[tuple[object, bytes]]):
        alike: dict[bytes, list[object]] = {}
        for item, text in items:
            if len(words := word_hashes([text], SPACES_AND_MARKS)[0]):
                alike.setdefault(words.tobytes(), []).append(item)
        self.ids = list(alike.values())
        self.words = [np.frombuffer(words, np.uint64) for words in alike]
        self.length = np.array([len(w) for w in self.words], np.int64)
        self.room = (EDITS * self.length).astype(np.int64)
        # Each item's distinct words with their numbers, for the bound on shared words.
        own = [np.unique(w, return_counts=True) for w in self.words]
        pair = np.concatenate([self._pair(np.full(len(w), k, np.uint64), w) for k, (w, _) in enumerate(own)] or [np.zeros(0, np.uint64)])
        order = np.argsort(pair, kind="stable")
        self.pair, self.times = pair[order], np.concatenate([n for _, n in own] or [np.zeros(0, np.int64)])[order]
        self.pair_present = _presence(self.pair)
        self.tables: list[_Table] = []
        for size in sorted({size_class(int(n)) for n in self.length}):
            mine = [k for k in range(len(self.words)) if size_class(int(self.length[k])) == size]
            for walk in walks(size):
                parts = [(*_starts(walk, self.words[k]), k) for k in mine]
                key = np.concatenate([x for x, _, _ in parts])
                order = np.argsort(key, kind="stable")
                key = key[order]
                owner = np.concatenate([np.full(len(x), k, np.int32) for x, _, k in parts])[order]
                self.tables.append(_Table(walk, key, owner, np.concatenate([x for _, x, _ in parts])[order].astype(np.int32), _presence(key)))

    @staticmethod
    def _pair(item: np.ndarray, word: np.ndarray) -> np.ndarray:
        return (word ^ (item + np.uint64(1)) * _MIX) * _MIX

    def search(self, texts: list[bytes]) -> list[list[tuple]]:
        """For each text: (item id, first word, words, distance) of its best stretch for each item found."""
        found, first = word_hashes(texts, SPACES_AND_MARKS)
        n = np.diff(first)
        # Blanks between texts, so that no walk reads on into the next one.
        begin = first[:-1] + _GAP * np.arange(len(texts))
        words = np.zeros(len(found) + _GAP * len(texts), np.uint64)
        doc_of = np.repeat(np.arange(len(texts)), n)
        starts = np.arange(len(found)) + _GAP * doc_of
        words[starts] = found
        out: list[list[tuple]] = [[] for _ in texts]
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for doc, k, low, high in self._candidates(words, starts, doc_of, begin, begin + n):
            item, stretch = self.words[k], words[low:high]
            distance, end = edit_distance(item, stretch)
            if distance <= self.room[k]:
                back = edit_distance(item[::-1], stretch[:end][::-1])[1]
                one = (distance, low + end - back, back)
                best[doc, k] = min(best.get((doc, k), one), one)
        for (doc, k), (distance, start, length) in sorted(best.items()):
            out[doc] += [(item, int(start - begin[doc]), int(length), int(distance)) for item in self.ids[k]]
        return out

    def _candidates(self, words: np.ndarray, starts: np.ndarray, doc_of: np.ndarray, begin: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, low, high): stretches that hold every copy met, with enough of the item's words."""
        owners, diagonals, docs = [], [], []
        for table in self.tables:
            key, _ = table.walk.keys(words, starts)
            maybe = np.flatnonzero(_maybe(table.present, key))
            low, high = np.searchsorted(table.key, key[maybe], "left"), np.searchsorted(table.key, key[maybe], "right")
            each = ragged(np.arange(len(table.key)), low, high - low)
            at = np.repeat(maybe, high - low)
            owners.append(table.owner[each].astype(np.int64))
            diagonals.append(starts[at] - table.offset[each])
            docs.append(doc_of[at])
        if not owners:
            return
        owner, diagonal, doc = np.concatenate(owners), np.concatenate(diagonals), np.concatenate(docs)
        order = np.lexsort((diagonal, owner, doc))
        owner, diagonal, doc = owner[order], diagonal[order], doc[order]
        if not len(order):
            return
        # Diagonals of one text and item that lie no further apart than edits can shift them are one candidate.
        new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (owner[1:] != owner[:-1]) | (diagonal[1:] - diagonal[:-1] > self.room[owner[1:]] + 1)])
        at = np.flatnonzero(new)
        owner, doc, lowest, highest = owner[at], doc[at], diagonal[at], np.maximum.reduceat(diagonal, at)
        low = np.maximum(begin[doc], lowest - self.room[owner])
        high = np.minimum(end[doc], highest + self.length[owner] + self.room[owner])
        for some in _pieces(high - low):
            shared = self._shared(words, owner[some], low[some], high[some])
            likely = some[shared >= (self.length - self.room)[owner[some]]]
            yield from zip(doc[likely].tolist(), owner[likely].tolist(), low[likely].tolist(), high[likely].tolist(), strict=True)

    def _shared(self, words: np.ndarray, owner: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """How many of the item's words (repeats counted) each stretch has: at least the length less the distance."""
        length = high - low
        which = np.repeat(np.arange(len(owner)), length)
        pair = self._pair(owner[which].astype(np.uint64), ragged(words, low, length))
        maybe = np.flatnonzero(_maybe(self.pair_present, pair))
        which, pair = which[maybe], pair[maybe]
        place = np.minimum(np.searchsorted(self.pair, pair), len(self.pair) - 1)
        hit = np.flatnonzero(self.pair[place] == pair)
        each, n = np.unique(which[hit] * len(self.pair) + place[hit], return_counts=True)
        return np.bincount(each // len(self.pair), np.minimum(n, self.times[each % len(self.pair)]), len(owner))


def _presence(keys: np.ndarray) -> np.ndarray:
    """For each value of the leading bits, whether some key has it: most lookups end here."""
    bits = min(24, max(16, len(keys).bit_length() + 4))
    present = np.zeros(1 << bits, bool)
    present[keys >> np.uint64(64 - bits)] = True
    return present


def _maybe(present: np.ndarray, keys: np.ndarray) -> np.ndarray:
    return present[keys >> np.uint64(65 - len(present).bit_length())]


def _pieces(sizes: np.ndarray, most: int = 1 << 20) -> Iterator[np.ndarray]:
    """Consecutive places whose sizes make up about `most` together."""
    cut = np.cumsum(sizes) // most
    yield from np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(cut)) + 1)


def _blocks(benchmark: DataFrame, item_id: str, text: str, items: int) -> Iterator[list[tuple[object, bytes]]]:
    block: list[tuple[object, bytes]] = []
    size = 0
    for r in benchmark.select(F.col(item_id).alias("item"), text_bytes(text).alias("text")).toLocalIterator():
        if block and (len(block) >= items or size + len(r.text) > ITEM_BYTES):
            yield block
            block, size = [], 0
        block.append((r.item, bytes(r.text)))
        size += len(r.text)
    if block:
        yield block


def _finder(docs: DataFrame, block: list[tuple[object, bytes]], kind: T.DataType):
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(Index(block))
    found = T.StructType([T.StructField("item_id", kind), *(T.StructField(c, T.IntegerType()) for c in ("start_word", "n_words", "distance"))])

    @pandas_udf(T.ArrayType(found))
    def find(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            out: list = []
            for texts_now in portions(part.tolist()):
                out += [[dict(zip(found.names, x, strict=True)) for x in got] for got in shared.value.search(texts_now)]
            yield pd.Series(out, dtype=object)

    return find.asNondeterministic()


def matches(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", items: int = ITEMS) -> DataFrame:
    """doc_id, item_id, start_word, n_words, distance: the best stretch of each document for each item it contains."""
    kind = benchmark.schema[item_id].dataType
    out = docs.sparkSession.createDataFrame([], T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("item_id", kind), *(T.StructField(c, T.IntegerType()) for c in ("start_word", "n_words", "distance"))]))
    for block in _blocks(benchmark, item_id, item_text, items):
        found = docs.select(F.col(doc_id).alias("doc_id"), _finder(docs, block, kind)(text_bytes(text)).alias("found"))
        out = out.unionByName(found.select("doc_id", F.inline("found")))
    return out


def keep_unleaked(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", items: int = ITEMS) -> DataFrame:
    """The rows of `docs` that contain no item, with all their columns."""
    kind = benchmark.schema[item_id].dataType
    for block in _blocks(benchmark, item_id, item_text, items):
        found: Column = _finder(docs, block, kind)(text_bytes(text))
        leaks = fresh("leaks", docs)
        docs = docs.withColumn(leaks, found).filter(F.size(leaks) == 0).drop(leaks)
    return docs
