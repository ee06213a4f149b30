"""Shared helpers of the training-data operators: table access, shared scratch space, word splitting."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.shared import shared_folder

#: The six ASCII white-space characters that separate words; `bytes.split()` splits at exactly these.
WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/millrace-{name}-{uuid.uuid4().hex}"


def stash(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: its lineage ends there and outlives executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(name: str, *frames: DataFrame) -> str:
    """A column name that none of the tables has (names differ without regard to case)."""
    taken = {c.lower() for df in frames for c in df.columns}
    name = f"__{name}"
    while name.lower() in taken:
        name += "_"
    return name


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Has Spark hand texts to Python at most `rows` at a time, so that a worker holds few whole texts at once."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, str(rows))


def text_bytes(column: str = "text") -> Column:
    """A text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b"").cast("binary"))


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null ids have no remainder (null)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def words_of(text: bytes) -> list[bytes]:
    """Words of a text whose A-Z are lower-cased: maximal runs without ASCII white space."""
    return text.lower().split()


def _separators(marks: bytes) -> bytes:
    return bytes(0x20 if b in WHITE or b in marks else b + 32 if 65 <= b <= 90 else b for b in range(256))


#: Byte tables that lower-case A-Z and turn white space (and ASCII punctuation) into blanks.
SPACES = _separators(b"")
SPACES_AND_MARKS = _separators(bytes(b for b in range(33, 127) if not chr(b).isalnum()))
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def word_hashes(texts: list[bytes], table: bytes = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """Odd 64-bit hashes of all words of some texts, in order, and where each text's words begin (one more entry than texts).

    A word's hash is a polynomial in its bytes, taken as the difference of two running sums over all bytes."""
    data = np.frombuffer((b" ".join(texts) + b" ").translate(table), np.uint8)
    inside = np.concatenate([[False], data != 0x20])
    starts, ends = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
    if len(_powers[0]) < len(data):
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(len(data) * 5 // 4, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data + np.uint64(1)) * _powers[0][: len(data)], dtype=np.uint64)])
    h = (running[ends] - running[starts]) * _powers[1][starts]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return h | np.uint64(1), np.searchsorted(starts, offsets)


def ragged(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches pool[starts[k] : starts[k] + lengths[k]] one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


def portions(texts: Iterable[bytes], most: int = 1 << 19) -> Iterator[list[bytes]]:
    """Consecutive texts of about `most` bytes together, so that work arrays stay small; a longer text stands alone."""
    part: list[bytes] = []
    size = 0
    for text in texts:
        if part and size + len(text) > most:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part
