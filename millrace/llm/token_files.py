"""Token ids in binary files of shuffled planes.

A file holds chunks of CHUNK ids each (the last may be shorter). A chunk's 32-bit ids are transposed into four byte planes (or 32 bit
planes), and each plane is compressed with zstandard by itself; the high planes of small ids take next to no room. Layout:

    b"IDPLANE1" | chunks: planes one after another | document index (Arrow, zstd) | footer (JSON) | footer length (u32) | b"IDPLANE1"

The footer is the chunk index: for each chunk its offset, number of ids and plane lengths; and where the document index lies.
Documents are dealt to files by ranges of their id and written in ascending order, null ids first, texts of equal ids in
ascending order; a file holds a bounded number of ids but for its last document. A file is written under a new name by each task attempt, and the manifest, a table written after all files,
names those that count, so lost executors and repeated attempts do no harm.

Defined cases: null and empty texts have the end id alone; an empty table gives no files; repeated rows are all written;
further columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from millrace.llm.common import portions, ragged, small_batches, text_bytes

MAGIC, CHUNK, LEVEL = b"IDPLANE1", 1 << 16, 1
#: Stretches whose ids a Python worker remembers, and bytes of text it encodes at a time.
REMEMBERED, PORTION = 800_000, 1 << 20
#: Bytes of text that a task is given, and ids after which a file is closed.
PART_BYTES, FILE_IDS = 128 << 20, 1 << 25


def to_planes(ids: np.ndarray, bits: bool = False) -> list[bytes]:
    """Byte planes (4) or bit planes (32) of ids, least significant first."""
    rows = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if not bits:
        return [np.ascontiguousarray(rows[:, k]).tobytes() for k in range(4)]
    return [np.packbits(plane).tobytes() for plane in np.unpackbits(rows, axis=1, bitorder="little").T]


def from_planes(planes: list[bytes], count: int) -> np.ndarray:
    if len(planes) == 4:
        return np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1).reshape(-1).view("<u4")
    rows = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=count) for p in planes], axis=1)
    return np.packbits(rows, axis=1, bitorder="little").reshape(-1).view("<u4")


class Writer:
    def __init__(self, out, id_type: pa.DataType, bits: bool = False):
        self.out, self.id_type, self.bits = out, id_type, bits
        self.at, self.waiting, self.held = 0, [], 0
        self.chunks: list[dict] = []
        self.doc_ids: list = []
        self.lengths: list[int] = []
        self.total = 0
        self.packer = zstandard.ZstdCompressor(level=LEVEL)
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, doc_id, ids: bytes) -> None:
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids) // 4)
        self.total += len(ids) // 4
        self.waiting.append(ids)
        self.held += len(ids) // 4
        if self.held >= CHUNK:
            self._flush(CHUNK)

    def _flush(self, least: int) -> None:
        ids = np.frombuffer(b"".join(self.waiting), "<u4")
        while len(ids) >= least and len(ids):
            part, ids = ids[:CHUNK], ids[CHUNK:]
            planes = [self.packer.compress(p) for p in to_planes(part, self.bits)]
            self.chunks.append({"offset": self.at, "ids": len(part), "planes": [len(p) for p in planes]})
            for p in planes:
                self._put(p)
        self.waiting, self.held = [ids.tobytes()], len(ids)

    def close(self) -> None:
        self._flush(1)
        sink = pa.BufferOutputStream()
        index = pa.table({"doc_id": pa.array(self.doc_ids, self.id_type), "n": pa.array(self.lengths, pa.int64())})
        with pa.ipc.new_stream(sink, index.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
            stream.write_table(index)
        documents = {"offset": self.at, "length": len(data := sink.getvalue().to_pybytes())}
        self._put(data)
        footer = json.dumps({"chunks": self.chunks, "documents": documents}).encode()
        self._put(footer + struct.pack("<I", len(footer)) + MAGIC)


def read_documents(source) -> Iterator[tuple[object, np.ndarray]]:
    """(doc_id, ids) of every document of an open file, a chunk in memory at a time."""
    size = source.size()
    source.seek(size - 12)
    length, magic = struct.unpack("<I8s", source.read(12))
    if magic != MAGIC:
        raise ValueError("not a file of id planes")
    source.seek(size - 12 - length)
    footer = json.loads(source.read(length))
    source.seek(footer["documents"]["offset"])
    index = pa.ipc.open_stream(source.read(footer["documents"]["length"])).read_all()
    unpacker, held, chunks = zstandard.ZstdDecompressor(), np.zeros(0, "<u4"), iter(footer["chunks"])
    for doc_id, n in zip(index["doc_id"].to_pylist(), index["n"].to_pylist(), strict=True):
        parts = [held]
        have = len(held)
        while have < n:
            chunk = next(chunks)
            source.seek(chunk["offset"])
            planes = [unpacker.decompress(source.read(p)) for p in chunk["planes"]]
            parts.append(from_planes(planes, chunk["ids"]))
            have += chunk["ids"]
        whole = np.concatenate(parts) if len(parts) > 1 else held
        yield doc_id, whole[:n]
        held = whole[n:]


def _byte_level() -> dict[int, str]:
    """Byte-level BPE writes each byte as a printable character: itself where Latin-1 prints it, else the next free one from U+0100."""
    out, free = {}, 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 255 and b != 173:
            out[b] = chr(b)
        else:
            out[b] = chr(free)
            free += 1
    return out


def _certain_boundaries() -> np.ndarray:
    """For two neighbouring bytes (first * 256 + second), whether the pattern of a byte-level BPE parts them whatever stands around.

    White space after anything else always starts a token, and so do ASCII letters, digits and marks after another of the three, but
    for what follows an apostrophe. Bytes beyond ASCII and the information separators are left to the library."""
    white, letters, digits = b"\t\n\x0b\x0c\r ", bytes(range(65, 91)) + bytes(range(97, 123)), b"0123456789"
    marks = bytes(b for b in range(128) if b not in white + letters + digits and not 0x1C <= b <= 0x1F)
    kinds = [np.isin(np.arange(256), list(k)) for k in (letters, digits, marks)]
    parted = np.outer(kinds[0] | kinds[1] | kinds[2] | (np.arange(256) >= 128), np.isin(np.arange(256), list(white)))
    for k in range(3):
        parted |= np.outer(kinds[k], kinds[k - 1] | kinds[k - 2])
    parted[ord("'"), letters[0] : 128] = False
    return parted.reshape(-1)


class WordwiseEncoder:
    """Whole texts through a tokenizer with a byte-level BPE, many texts at a time.

    Texts are cut where the tokenizer's pattern is certain to start a new token. Of these stretches each distinct one is looked up among those
    the worker remembers, and the library gives the ids of the new ones. A text with the name of a special token goes through the library whole."""

    def __init__(self, path: str, special: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        self.names = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.tokenize = self.tokenizer.model.tokenize
        self.byte_level = _byte_level()
        self.blank = self.byte_level[32]
        self.parted = _certain_boundaries()
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.length, self.pool = np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def whole(self, text: bytes) -> bytes:
        return np.array(self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, words: list[bytes]) -> None:
        """Letters with or without a blank in front are one token of the pattern, so the model alone decides; all else goes through the library."""
        ids: list[list[int]] = []
        others: list[str] = []
        for word in words:
            text = word.decode("utf-8", "replace")
            if (text[1:] if text[0] == " " else text).isalpha() and (text.isascii() or max(text) < _LETTERS_END):
                raw = text.replace(" ", self.blank) if text.isascii() else word.decode("latin-1").translate(self.byte_level)
                ids.append([t.id for t in self.tokenize(raw)])
            else:
                others.append(text)
                ids.append([])
        rest = iter(self.tokenizer.encode_batch_fast(others, add_special_tokens=False))
        ids = [i or next(rest).ids for i in ids]
        for word in words:
            self.known[word] = len(self.known)
        self.length = np.concatenate([self.length, [len(i) for i in ids]])
        self.pool = np.concatenate([self.pool, np.fromiter((x for i in ids for x in i), np.uint32)])

    def many(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out = [self.whole(t) if any(name in t for name in self.names) else b"" for t in texts]
        plain = [k for k, t in enumerate(texts) if t and not out[k]]
        data = b"".join(texts[k] for k in plain)
        if not data:
            return out
        if len(self.known) > REMEMBERED:
            self._forget()
        raw, ends = np.frombuffer(data, np.uint8), np.cumsum([len(texts[k]) for k in plain])
        begins = np.concatenate([[True], self.parted[(raw[:-1].astype(np.uint16) << np.uint16(8)) | raw[1:], ], [True]])
        begins[[m.end() for m in _WIDE_WHITE.finditer(data)]] = False  # white space beyond ASCII belongs to the run that follows
        begins[ends] = True
        offsets = np.flatnonzero(begins).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        distinct = words.dictionary.to_pylist()
        self._learn([w for w in distinct if w not in self.known])
        which = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))[words.indices.to_numpy()]
        length = self.length[which]
        ids = ragged(self.pool, (np.cumsum(self.length) - self.length)[which], length)
        upto = np.concatenate([[0], np.cumsum(length)])[np.searchsorted(offsets, [0, *ends.tolist()])].tolist()
        for k, a, b in zip(plain, upto[:-1], upto[1:], strict=True):
            out[k] = ids[a:b].tobytes()
        return out


#: Letters before this character are letters in every Unicode version that a tokenizer's pattern may know.
_LETTERS_END = "\u0530"
#: White space beyond ASCII, as bytes.
_WIDE_WHITE = re.compile("|".join(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))).encode())
_encoders: dict[tuple[str, bool], WordwiseEncoder] = {}


class TokenizerEncode:
    """Ids of a text, or of many. With `special` the name of a special token in a text becomes its one id, as the library does by default.

    It is sent to the executors as its parameters; each worker reads the tokenizer's file itself."""

    def __init__(self, path: str, special: bool = False):
        self.key = path, special

    def many(self, texts: list[bytes]) -> list[bytes]:
        if self.key not in _encoders:
            _encoders[self.key] = WordwiseEncoder(*self.key)
        return _encoders[self.key].many(texts)

    def __call__(self, text: bytes) -> bytes:
        return self.many([text])[0]


def tokenizer_encode(path: str, special: bool = False) -> TokenizerEncode:
    return TokenizerEncode(path, special)


def _open(uri: str, mode: str):
    filesystem, path = pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)
    if mode == "r":
        return filesystem.open_input_file(path)
    filesystem.create_dir(path.rpartition("/")[0], recursive=True)
    return filesystem.open_output_stream(path)


def write_ids(docs: DataFrame, folder: str, encode: Callable[[bytes], bytes], end_id: int, doc_id: str = "doc_id", text: str = "text", bits: bool = False, file_ids: int = FILE_IDS) -> DataFrame:
    """Writes files and a manifest (part, file_no, file, n_docs, n_ids) to `folder`, a path that all executors share; returns the manifest.

    `encode` gives a text's ids; where it has a method `many`, that is given some texts at a time. A task gets about `PART_BYTES` of text, and a
    file is closed with the document that takes it to `file_ids` ids."""
    end = struct.pack("<I", end_id)
    many = getattr(encode, "many", None) or (lambda texts: [encode(t) for t in texts])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        out = writer = file = None

        def closed() -> pa.RecordBatch:
            writer.close()
            out.close()
            row = [[part], [number], [file], [len(writer.lengths)], [writer.total]]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()), strict=True)], _MANIFEST_COLUMNS)

        for batch in batches:
            doc_ids = iter(batch["doc_id"].to_pylist())
            for texts in portions((t.as_py() for t in batch["text"]), PORTION):
                for ids in many(texts):
                    if writer is None:
                        file = f"{folder}/part-{part:06d}-{number:04d}-{uuid.uuid4().hex}.idplanes"
                        out = _open(file, "w")
                        writer = Writer(out, batch["doc_id"].type, bits)
                    writer.add(next(doc_ids), ids + end)
                    if writer.total >= file_ids:
                        yield closed()
                        writer, number = None, number + 1
        if writer is not None:
            yield closed()

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_bytes(text).alias("text"))
    parts, repeated = _measure(rows)
    by = [F.asc_nulls_first("doc_id"), *([F.asc("text")] if repeated else [])]
    ordered = rows.repartitionByRange(parts, *by).sortWithinPartitions(F.asc_nulls_first("doc_id"), F.asc("text"))
    ordered.mapInArrow(run, _MANIFEST).write.parquet(f"{folder}/manifest")
    return read_manifest(docs.sparkSession, folder)


def _measure(rows: DataFrame) -> tuple[int, bool]:
    """Tasks for all texts, and whether one id has so many rows that ranges of ids alone would leave a task too much."""
    by_id = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    found = by_id.agg(F.max("n").alias("most"), F.sum("bytes").alias("bytes")).first()
    least = 4 * rows.sparkSession.sparkContext.defaultParallelism
    return max(least, -(-(found.bytes or 0) // PART_BYTES)), (found.most or 0) > 10_000


_MANIFEST_COLUMNS = ["part", "file_no", "file", "n_docs", "n_ids"]
_MANIFEST = "part int, file_no int, file string, n_docs long, n_ids long"


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")


def read_ids(spark: SparkSession, folder: str, id_type: T.DataType) -> DataFrame:
    """doc_id, start (ids of all documents before it) and ids (binary, four bytes each) of every document of a folder."""
    kind = to_arrow_type(id_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start in zip(batch["file"].to_pylist(), batch["start"].to_pylist(), strict=True):
                rows: tuple[list, list, list] = ([], [], [])
                held = 0
                with _open(file, "r") as source:
                    for doc_id, ids in read_documents(source):
                        for column, x in zip(rows, (doc_id, start, ids.tobytes()), strict=True):
                            column.append(x)
                        start += len(ids)
                        held += len(ids)
                        if held > 1 << 20:
                            yield _rows(rows)
                            rows, held = ([], [], []), 0
                if rows[0]:
                    yield _rows(rows)

    def _rows(rows: tuple[list, list, list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, (kind, pa.int64(), pa.binary()), strict=True)], ["doc_id", "start", "ids"])

    before = Window.orderBy("part", "file_no").rowsBetween(Window.unboundedPreceding, -1)
    files = read_manifest(spark, folder).withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("start", T.LongType()), T.StructField("ids", T.BinaryType())])
    return files.select("file", "start").repartition(max(1, read_manifest(spark, folder).count())).mapInArrow(run, schema)

