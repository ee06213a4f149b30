"""Sketches of texts for blocking and comparing near copies, worked out in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf

#: Characters of texts that are hashed at a time; a longer text stands alone.
_PORTION = 1 << 20


def _mixed(h: np.ndarray, seed: int) -> np.ndarray:
    """Another hash of 64-bit hashes for each seed."""
    h = (h ^ np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _portions(texts: list[str | None]) -> Iterator[list[str]]:
    part: list[str] = []
    size = 0
    for text in texts:
        text = text or ""
        if part and size + len(text) > _PORTION:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def runs_of_words(texts: list[str], run: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `run` words of some texts, without case, one for each word (the last runs of a text are shorter), and where each text's
    begin (one more entry). A text without words has one, that of the empty word."""
    words = [text.lower().split() or [""] for text in texts]
    first = np.cumsum([0, *map(len, words)])
    of_word = pd.util.hash_array(np.array([w for text in words for w in text], dtype=object), categorize=True)
    left = np.repeat(first[1:], np.diff(first)) - np.arange(first[-1])
    out = of_word
    for k in range(1, run):
        out = _mixed(out, k)
        there = np.flatnonzero(left > k)
        out[there] += of_word[there + k]
    return _mixed(out, run), first


def sketches(text: Column, run: int = 3, least: int = 8, size: int = 64) -> Column:
    """struct(sketch, least): the low 32 bits of the `size` smallest distinct hashes of a text's runs of words, and its smallest hash under each of `least`
    further hash functions. Null counts as empty; the whole text is read; repeated runs count once."""

    @arrow_udf("struct<sketch: array<int>, least: array<bigint>>")
    def run_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            kept: list[np.ndarray] = []
            smallest = [np.zeros((0, least), np.int64)]
            for part in _portions(batch.to_pylist()):
                hashes, first = runs_of_words(part, run)
                kept += [np.unique(hashes[a:b])[:size] for a, b in zip(first[:-1], first[1:], strict=True)]
                smallest.append(np.stack([np.minimum.reduceat(_mixed(hashes, 1000 + k), first[:-1]) for k in range(least)], 1).view(np.int64))
            flat = (np.concatenate(kept) if kept else np.zeros(0, np.uint64)).astype(np.uint32).view(np.int32)
            sketch = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, kept)]), pa.int32()), pa.array(flat))
            lows = np.concatenate(smallest)
            yield pa.StructArray.from_arrays([sketch, pa.ListArray.from_arrays(pa.array(np.arange(len(lows) + 1) * least, pa.int32()), pa.array(lows.reshape(-1)))], ["sketch", "least"])

    return run_batches(text)
