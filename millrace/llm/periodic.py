"""Runs of periodically repeated words, found by recompression.

The words of some texts, a separator between texts, are compressed in turns: blocks (a maximal stretch of one symbol becomes a symbol) and pairs (symbols are
split into two halves by a hash, and a symbol of the first half joins a following one of the second). Equal stretches are cut alike but at their edges, so the
longest common extension of two places is found by going up the levels while symbols agree and down again to the first difference: a few steps a level, for
all questions at once, without suffix arrays. A run of period p that is 4 p long holds both x and x + p for a multiple x of 2 p: these places, some n log n of
them, are the candidates. Those whose periods plainly differ go at once; of the rest, grammars of the words and of the words backwards give the exact ends.

Defined cases: null and empty texts, and texts of white space alone, have no words and no runs. Texts are taken whole, however long; memory grows with the
longest text. Words are compared by 64-bit hashes; every run is then held against its words, and a text where two words share a hash is done again with
numbers of its own. Rows without a doc_id keep their words as they are. Repeated rows give repeated results; an empty table gives an empty one. Further columns
are not read."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import WHITE, portions, ragged, small_batches, text_bytes, word_hashes

#: A run has at least so many periods, and at least so many words.
PERIODS, LEAST = 4, 6
#: Bytes of text that share a grammar, and candidates looked at together.
PORTION, CANDIDATES = 1 << 20, 1 << 20
#: Turns white space into blanks and leaves letters as they are.
_BLANKS = bytes(0x20 if b in WHITE else b for b in range(256))
COLUMNS = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


class Level(NamedTuple):
    """Symbols of a level; for the step to the next one, whether it makes blocks, each symbol's place above, and each place's first symbol here."""

    symbols: np.ndarray
    blocks: bool
    up: np.ndarray
    first: np.ndarray


def _named(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


def grammar(symbols: np.ndarray) -> list[Level]:
    """The levels above a sequence of numbers, blocks and pairs in turns, up to a single symbol."""
    levels: list[Level] = []
    now = _named(symbols)
    while len(now) > 1:
        blocks = len(levels) % 2 == 0
        if blocks:
            starts = np.concatenate([[True], now[1:] != now[:-1]])
            first = np.flatnonzero(starts)
            size = np.diff(np.append(first, len(now)))
            above = _named(now[first] * (int(size.max()) + 1) + size)
        else:
            # The halves differ from level to level, so that a pair that stays apart here is joined later.
            half = ((now + 1 + len(levels)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15 + 2 * len(levels)) >> np.uint64(41)) & np.uint64(1)
            joined = (half[:-1] == 0) & (half[1:] == 1)
            starts = np.concatenate([[True], ~joined])
            first = np.flatnonzero(starts)
            second = np.append(joined, False)[first]
            partner = np.where(second, now[np.minimum(first + 1, len(now) - 1)] + 1, 0)
            above = _named(now[first] * (int(now.max()) + 2) + partner)
        levels.append(Level(now, blocks, np.cumsum(starts) - 1, np.append(first, len(now))))
        now = above
    return levels


def common_extension(levels: list[Level], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each pair of different places, how many symbols from there on agree. Each pair must meet a difference before the sequence ends."""
    a, b = i.astype(np.int64), j.astype(np.int64)
    stopped = np.full(len(a), -1)  # level of the first difference met on the way up
    going = np.arange(len(a))
    for k, level in enumerate(levels):
        if not len(going):
            break
        same = level.symbols[a[going]] == level.symbols[b[going]]
        stopped[going[~same]] = k
        going = going[same]
        x, y = a[going], b[going]
        if level.blocks:
            left_x, left_y = level.first[level.up[x] + 1] - x, level.first[level.up[y] + 1] - y
            whole = (level.first[level.up[x]] == x) & (level.first[level.up[y]] == y) & (left_x == left_y)
            step = np.where(whole, 0, np.minimum(left_x, left_y))
            ends = left_x != left_y
        else:
            step = ((level.first[level.up[x]] != x) | (level.first[level.up[y]] != y)).astype(np.int64)
            ends = np.zeros(len(x), bool)
        a[going], b[going] = x + step, y + step
        stopped[going[ends]] = k
        going = going[~ends]
        a[going], b[going] = level.up[a[going]], level.up[b[going]]
    for k in range(len(levels) - 2, -1, -1):
        level = levels[k]
        down = np.flatnonzero(stopped > k)
        x, y = level.first[a[down]], level.first[b[down]]
        same = level.symbols[x] == level.symbols[y]
        if level.blocks:
            step = np.where(same, np.minimum(level.first[level.up[x] + 1] - x, level.first[level.up[y] + 1] - y), 0)
        else:
            step = same.astype(np.int64)
        a[down], b[down] = x + step, y + step
    return a - i


def candidates(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places x (in `ids`) and periods p of each text, x a multiple of 2 p from its start, where four of the words that a run would repeat do agree.

    A run's first such place is at most 2 p - 1 words after its start, so the run goes on from there for the rest of its least length."""
    most = lengths // PERIODS
    text = np.repeat(np.arange(len(lengths)), most)
    period = np.arange(len(text)) - np.repeat(np.cumsum(most) - most, most) + 1
    rest = np.maximum(LEAST, PERIODS * period) - 2 * period + 1
    grid = np.maximum(lengths[text] - rest + 2 * period, 0) // (2 * period)
    ends = np.cumsum(grid)
    begin = 0
    while begin < len(text):
        end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + CANDIDATES)))
        times = grid[begin:end]
        p = np.repeat(period[begin:end], times)
        x = np.repeat(starts[text[begin:end]], times) + 2 * p * (np.arange(len(p)) - np.repeat(np.cumsum(times) - times, times))
        for part in (0, 1, 2, 3):
            at = x + (np.maximum(LEAST, PERIODS * p) - 3 * p) * part // 3
            keep = ids[at] == ids[at + p]
            x, p = x[keep], p[keep]
        yield x, p
        begin = end


def runs(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """(place, length, period) of all runs of some texts, in order. Text k is ids[starts[k] : starts[k] + lengths[k]]; an entry before and after each text is
    a separator that no text holds."""
    found = list(candidates(ids, starts, lengths))
    x, p = np.concatenate([f[0] for f in found] or [[]]).astype(np.int64), np.concatenate([f[1] for f in found] or [[]]).astype(np.int64)
    if not len(x):
        return np.zeros((0, 3), np.int64)
    # Grammars only of texts that have a candidate.
    text = np.unique(np.searchsorted(starts, x, side="right") - 1)
    kept_starts = np.concatenate([[0], np.cumsum(lengths[text] + 1)[:-1]]) + 1
    part = np.concatenate([ids[starts[text][0] - 1 : starts[text][0]], ragged(ids, starts[text], lengths[text] + 1)])
    shift = kept_starts - starts[text]
    by = shift[np.searchsorted(starts[text], x, side="right") - 1]
    y = x + by
    after = common_extension(grammar(part), y, y + p)
    long = after >= p
    x, p, by, y, after = x[long], p[long], by[long], y[long], after[long]
    last = len(part) - 1
    before = common_extension(grammar(part[::-1]), last - (y - 1), last - (y + p - 1))
    place, length = x - before, before + p + after
    good = length >= np.maximum(LEAST, PERIODS * p)
    table = np.unique(np.stack([place[good], length[good], p[good]], axis=1), axis=0)
    # One stretch with several periods: the smallest divides the others.
    first = np.ones(len(table), bool)
    first[1:] = (table[1:, :2] != table[:-1, :2]).any(axis=1)
    table = table[first]
    return table[np.lexsort((table[:, 2], table[:, 0]))]


def exact_runs(words: list[bytes]) -> np.ndarray:
    """(start, length, period) of the runs of one text, its words numbered."""
    known: dict[bytes, int] = {}
    ids = np.array([0, *(known.setdefault(w, len(known) + 1) for w in words), 0])
    return runs(ids, np.array([1]), np.array([len(words)])) - np.array([1, 0, 0])


def planted(n: int, doc_id: str | None) -> np.ndarray | None:
    """Which word stands at each place where a text is made periodic from some place on; null where it stays as it is."""
    h = crc32(doc_id.encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at < a, at, a + (at - a) % p)


def describe(texts: list[bytes], ids: list[str | None]) -> Iterator[tuple]:
    """The values of COLUMNS for each text."""
    hashes, at = word_hashes(texts, _BLANKS)
    order = [planted(n, doc_id) for n, doc_id in zip(np.diff(at).tolist(), ids)]
    numbers = [hashes[at[k] : at[k + 1]] if moved is None else hashes[at[k] : at[k + 1]][moved] for k, moved in enumerate(order)]
    none = np.zeros(1, np.uint64)
    lengths = np.array([len(w) for w in numbers], np.int64)
    starts = np.cumsum(lengths + 1) - lengths
    table = runs(np.concatenate([none, *(part for w in numbers for part in (w, none))]), starts, lengths)
    owner = np.searchsorted(starts, table[:, 0], side="right") - 1
    begin, end = np.searchsorted(owner, np.arange(len(texts))), np.searchsorted(owner, np.arange(len(texts)), side="right")
    for k, text in enumerate(texts):
        own = text.split()
        if order[k] is not None:
            own = [own[j] for j in order[k].tolist()]
        mine = table[begin[k] : end[k]] - np.array([starts[k], 0, 0])
        if any(own[s : s + n - p] != own[s + p : s + n] for s, n, p in mine.tolist()):
            mine = exact_runs(own)
        kept = own
        best: tuple = (None, None, None, None)
        if len(mine):
            # Words inside a run after its first period go: counted by differences at both ends.
            edges = np.zeros(len(own) + 1, np.int64)
            np.add.at(edges, mine[:, 0] + mine[:, 2], 1)
            np.add.at(edges, mine[:, 0] + mine[:, 1], -1)
            kept = [own[j] for j in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]
            start, length, period = (int(v) for v in mine[np.lexsort((mine[:, 2], mine[:, 0], -mine[:, 1]))[0]])
            best = (start, length, period, 1000 * length // period)
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in mine.tolist())
        yield len(mine), *best, sha256(listed.encode()).hexdigest(), sha256(b" ".join(kept)).hexdigest()


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, start, length, period and exponent_milli of the longest run (null without one), and digests of all runs and of the words kept."""
    small_batches(docs.sparkSession)
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {COLUMNS}"
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    types = [pa.int64()] * 5 + [pa.string()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = batch.column("text").to_pylist(), batch.column("id").to_pylist()
            rows, done = [], 0
            for part in portions(texts, PORTION):
                rows += describe(part, ids[done : done + len(part)])
                done += len(part)
            columns = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types))], ["doc_id", *names])

    return docs.select("doc_id", F.col("doc_id").cast("string").alias("id"), text_bytes().alias("text")).mapInArrow(run, schema)
