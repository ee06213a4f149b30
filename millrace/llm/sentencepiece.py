"""SentencePiece encoding and decoding by streaming Viterbi.

The vocabulary's pieces come from a model file; a piece's log-probability follows its rank in the model (-log(rank + 1)), and
a character in no piece is written as its bytes at a penalty. The encoder goes over a text once and keeps only a window: the
scores of the boundaries that pieces begun so far can reach (at most the longest piece ahead), and back-pointers since the last
commit. Whenever the paths of all these surviving boundaries meet in one boundary, the ids up to it are final and are put out.

Many streams are walked side by side. All paths meet between two characters that no piece joins, so a batch of texts is a sequence
of stretches between such boundaries; a stretch that occurs again in the batch has the same ids, so each distinct one is walked once,
a character at a time for all of them in numpy, with a ring of scores as long as the longest piece. Its paths have met at its end,
where its ids are committed. Stretches of more than `LANE` characters are walked alone, and their paths' meetings are looked for on the way.

Of segmentations with equal scores, each boundary's last piece is the longest one. Texts are read as UTF-8; blanks become U+2581 with one put in front, as the model's own encoder does; a U+2581 in the
text itself and bytes that are not UTF-8 are written as bytes, so decoding always gives back the text. Defined cases: null and empty
texts have no ids; repeated rows encode alike; an empty table gives an empty result; further columns are kept by `encoded` and
`decoded` and not read by `encoded_and_checked`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from millrace.llm.common import portions, ragged, small_batches, text_bytes

BLANK = "▁"
#: Stretches of at most so many characters are walked side by side.
LANE = 64
#: Bytes of text in one batch of streams.
BATCH = 1 << 20
NEVER = np.int64(-(1 << 62))
_MIX, _SLOT_BITS = np.uint64(0x9E3779B97F4A7C15), 18


class Codec:
    """Pieces with log-probabilities; `encode` gives ids as little-endian unsigned 32-bit integers, `decode` takes them."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int]):
        self.pieces, self.byte_ids = pieces, np.array(byte_ids, np.uint32)
        self.longest = max(map(len, pieces), default=1)
        self.unknown = min((s for _, s in pieces.values()), default=0.0) - 10
        self.spaced = {p.replace(BLANK, " "): (i, _units(s)) for p, (i, s) in pieces.items()}
        self._build_tree()
        self._build_boundaries()
        self._build_bytes()

    @classmethod
    def load(cls, path: str) -> Codec:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        usable = [i for i in every if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        return cls({model.id_to_piece(i): (i, -math.log(1 - model.get_score(i))) for i in usable}, [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])

    def _build_tree(self) -> None:
        """The prefixes of all pieces as numbered nodes (0: none), and a hash table of (node, letter) to node."""
        letters = sorted({c for p in self.spaced for c in p})
        self.letter = np.zeros(0x110000, np.int32)
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.width = len(letters) + 1
        self.nodes: dict[str, int] = {"": 0}
        for p in self.spaced:
            for k in range(1, len(p) + 1):
                self.nodes.setdefault(p[:k], len(self.nodes))
        self.score, self.id = np.full(len(self.nodes), NEVER), np.zeros(len(self.nodes), np.uint32)
        for p, (i, s) in self.spaced.items():
            self.score[self.nodes[p]], self.id[self.nodes[p]] = s, i
        self.first, self.inner = np.zeros(self.width, np.int32), np.zeros(len(self.nodes), bool)
        self.keys, self.values = np.full(1 << _SLOT_BITS, -1, np.int64), np.zeros(1 << _SLOT_BITS, np.int32)
        for prefix, node in self.nodes.items():
            if len(prefix) == 1:
                self.first[self.letter[ord(prefix)]] = node
            elif prefix:
                parent = self.nodes[prefix[:-1]]
                self.inner[parent] = True
                key = parent * self.width + int(self.letter[ord(prefix[-1])])
                slot = key * int(_MIX) % (1 << 64) >> 64 - _SLOT_BITS
                while self.keys[slot] >= 0:
                    slot = (slot + 1) % (1 << _SLOT_BITS)
                self.keys[slot], self.values[slot] = key, node

    def _build_boundaries(self) -> None:
        """Which two neighbours some piece joins; between all others every path has a boundary."""
        pairs = {p[k : k + 2] for p in self.spaced for k in range(len(p) - 1)}
        self.joined = np.array(sorted(int(self.letter[ord(a)]) * self.width + int(self.letter[ord(b)]) for a, b in pairs), np.int64)
        self.parted = np.zeros((256, 256), bool)
        self.parted[:128, :128] = True
        for a, b in pairs:
            if ord(a) < 128 and ord(b) < 128:
                self.parted[ord(a), ord(b)] = False
        self.parted = self.parted.reshape(-1)

    def _build_bytes(self) -> None:
        """The bytes that each id stands for, one after another."""
        of = {i: p.encode() for p, (i, _) in self.spaced.items()} | {int(i): bytes([b]) for b, i in enumerate(self.byte_ids)}
        self.bytes_of = [of.get(i, b"") for i in range(max(of, default=0) + 1)]
        self.byte_length = np.array([len(b) for b in self.bytes_of])
        self.byte_start = np.cumsum(self.byte_length) - self.byte_length
        self.byte_pool = np.frombuffer(b"".join(self.bytes_of), np.uint8)

    def viterbi(self, text: str) -> Iterator[list[int]]:
        """Streams the ids of the best segmentation of one stretch (blanks as U+2581), a committed part at a time."""
        return self._stream(text.replace(BLANK, " "))

    def _stream(self, text: str) -> Iterator[list[int]]:
        pieces, prefixes, size = self.spaced, self.nodes, len(text)
        unknown = _units(self.unknown)
        best: dict[int, int] = {0: 0}  # of the boundaries from the committed one on
        back: dict[int, int] = {}
        base = furthest = 0
        for start in range(size):
            if start > base and (furthest <= start or start - base >= 2 * self.longest):
                meet = start if furthest <= start else self._meeting(back, base, start, furthest)
                if meet > base:
                    yield self._ids(text, back, base, meet)
                    best = {k: v for k, v in best.items() if k >= start}
                    back = {k: v for k, v in back.items() if k > meet}
                    base = meet
            here = best[start]
            for end in range(start + 1, size + 1):
                piece = text[start:end]
                if piece not in prefixes:
                    break
                if piece in pieces:
                    score = here + pieces[piece][1]
                    if end not in best or score > best[end]:
                        best[end], back[end] = score, start
                        furthest = max(furthest, end)
            if start + 1 not in best:
                best[start + 1], back[start + 1] = here + unknown * len(self._bytes(text[start])), start
                furthest = max(furthest, start + 1)
        if size > base:
            yield self._ids(text, back, base, size)

    @staticmethod
    def _meeting(back: dict[int, int], base: int, start: int, furthest: int) -> int:
        """The boundary where the paths of all surviving boundaries, from `start` on, meet."""
        live = {k for k in back if start <= k <= furthest}
        while len(live) > 1:
            last = max(live)
            live.discard(last)
            live.add(back[last] if last > base else base)
        return live.pop()

    def _ids(self, text: str, back: dict[int, int], base: int, end: int) -> list[int]:
        out: list[int] = []
        while end > base:
            start = back[end]
            got = self.spaced.get(text[start:end])
            out += [got[0]] if got else [int(self.byte_ids[b]) for b in reversed(self._bytes(text[start:end]))]
            end = start
        return out[::-1]

    @staticmethod
    def _bytes(char: str) -> bytes:
        return char.encode("utf-8", "surrogateescape")

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text, all of one batch together."""
        data = b"".join(b" " + t for t in texts if t)
        if not data:
            return [b""] * len(texts)
        ends = np.cumsum([len(t) + 1 if t else 0 for t in texts])
        raw = np.frombuffer(data, np.uint8)
        begins = np.concatenate([[True], self.parted[(raw[:-1].astype(np.uint16) << np.uint16(8)) | raw[1:]]])
        begins[ends[ends < len(raw)]] = True
        starts = np.flatnonzero(begins)
        offsets = np.append(starts, len(raw)).astype(np.int32)
        stretches = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        try:
            counts, pool = self._walk_all(stretches.dictionary)
        except UnicodeDecodeError:
            if len(texts) > 1:
                return [self.encode(t) for t in texts]
            ids = [i for part in self._stream(data.decode("utf-8", "surrogateescape")) for i in part]
            return [np.array(ids, "<u4").tobytes()]
        which = stretches.indices.to_numpy()
        ids = ragged(pool, (np.cumsum(counts) - counts)[which], counts[which])
        upto = np.concatenate([[0], np.cumsum(counts[which])])[np.searchsorted(starts, ends)]
        return [ids[a:b].tobytes() for a, b in zip([0, *upto[:-1].tolist()], upto.tolist(), strict=True)]

    def encode(self, text: bytes) -> bytes:
        return self.encode_all([text])[0]

    def _walk_all(self, stretches: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each distinct stretch, and all their ids one after another."""
        offsets = np.frombuffer(stretches.buffers()[1], np.int32)[: len(stretches) + 1]
        raw = np.frombuffer(stretches.buffers()[2], np.uint8)[: offsets[-1]]
        chars = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), "<u4").astype(np.int64)
        begin = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[offsets]
        # Of a long stretch, boundaries that only characters beyond ASCII show.
        lengths = np.diff(begin)
        inside = ragged(np.arange(len(chars)), begin[:-1][lengths > LANE] + 1, lengths[lengths > LANE] - 1)
        pairs = self.letter[chars[inside - 1]].astype(np.int64) * self.width + self.letter[chars[inside]]
        lanes = np.union1d(begin[:-1], inside[~np.isin(pairs, self.joined)])
        lengths = np.diff(np.append(lanes, len(chars)))
        short = lengths <= LANE
        counts = np.zeros(len(lanes), np.int64)
        counts[short], pool = self._walk(chars, lanes[short], lengths[short])
        if not short.all():
            alone = []
            for a, n in zip(lanes[~short].tolist(), lengths[~short].tolist(), strict=True):
                text = chars[a : a + n].astype("<u4").tobytes().decode("utf-32-le")
                alone.append(np.array([i for part in self._stream(text) for i in part], np.uint32))
            counts[~short] = [len(ids) for ids in alone]
            where = np.zeros(len(lanes), np.int64)
            where[short] = np.cumsum(counts[short]) - counts[short]
            where[~short] = len(pool) + np.cumsum(counts[~short]) - counts[~short]
            pool = ragged(np.concatenate([pool, *alone]), where, counts)
        return np.add.reduceat(counts, np.searchsorted(lanes, begin[:-1])), pool

    def _next(self, node: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The node of each prefix with a letter added, 0 where no piece begins so."""
        key = node.astype(np.int64) * self.width + letter
        slot = ((key.view(np.uint64) * _MIX) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        got = self.keys[slot]
        out = np.where(got == key, self.values[slot], 0)
        rest = np.flatnonzero((got != key) & (got >= 0))
        while len(rest):
            slot[rest] = (slot[rest] + 1) % (1 << _SLOT_BITS)
            got = self.keys[slot[rest]]
            same = got == key[rest]
            out[rest[same]] = self.values[slot[rest[same]]]
            rest = rest[~same & (got >= 0)]
        return out

    def _walk(self, chars: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each lane, and all ids: one Viterbi step for all lanes at a time.

        Longer lanes come first and characters lie by place in their lane, so the lanes that reach a place are a prefix of its column."""
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, np.uint32)
        order = np.argsort(-lengths, kind="stable")
        lengths = lengths[order]
        longest, total = int(lengths[0]), int(lengths.sum())
        reach = np.searchsorted(-lengths, -np.arange(longest + 1), "left")  # lanes that have more than so many characters
        column = np.concatenate([[0], np.cumsum(reach)])
        place = np.arange(total) - np.repeat(column[:longest], reach[:longest])  # lane of each character
        step = np.repeat(np.arange(longest), reach[:longest])
        char = chars[starts[order][place] + step]
        letter = np.append(self.letter[char], np.int32(0))
        follow = np.where(step + 1 < lengths[place], column[step + 1] + place, total)
        # All pieces, by length: where they begin (in column order) and their nodes.
        fits: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        begin, at, node = np.arange(total), np.arange(total), self.first[letter[:total]]
        for size in range(1, self.longest + 1):
            whole = np.flatnonzero(self.score[node] > NEVER)
            if len(whole):
                fits.append((size, begin[whole], node[whole], np.searchsorted(begin[whole], column)))
            on = np.flatnonzero(self.inner[node])
            begin, at, node = begin[on], follow[at[on]], node[on]
            node = self._next(node, letter[at])
            on = np.flatnonzero(node)
            if not len(on):
                break
            begin, at, node = begin[on], at[on], node[on]
        window = np.full((self.longest + 1, len(lengths)), NEVER)  # ring of the scores of reachable boundaries
        window[0] = 0
        taken, piece = np.zeros(total, np.int8), np.zeros(total, np.int32)  # back-pointers, at a piece's last character
        for k in range(longest):
            here = window[k % len(window)]
            for size, begin, node, upto in fits:
                if upto[k] == upto[k + 1]:
                    continue
                lane, found = begin[upto[k] : upto[k + 1]] - column[k], node[upto[k] : upto[k + 1]]
                score, ahead = here[lane] + self.score[found], window[(k + size) % len(window)]
                better = np.flatnonzero(score > ahead[lane])
                lane = lane[better]
                ahead[lane] = score[better]
                taken[column[k + size - 1] + lane], piece[column[k + size - 1] + lane] = size, found[better]
            ahead = window[(k + 1) % len(window)]
            lost = np.flatnonzero(ahead[: reach[k]] == NEVER)
            if len(lost):
                ahead[lost] = here[lost] + _units(self.unknown) * _utf8_length(char[column[k] + lost])
                taken[column[k] + lost], piece[column[k] + lost] = 1, 0
            here[:] = NEVER
        # All paths of a lane have met at its end: its ids, last first.
        lane, end, ids_of = np.arange(len(lengths)), lengths.copy(), np.zeros(len(lengths), np.int64)
        steps = []
        while len(lane):
            last = column[end[lane] - 1] + lane
            steps.append((lane, last))
            ids_of[lane] += 1
            end[lane] -= taken[last]
            lane = lane[end[lane] > 0]
        place_in = np.empty(len(order), np.int64)  # the lanes in their own order again
        own = np.empty(len(order), np.int64)
        own[order] = ids_of
        place_in[:] = (np.cumsum(own) - own)[order] + ids_of - 1
        lasts = np.empty(int(ids_of.sum()), np.int64)
        for k, (lane, last) in enumerate(steps):
            lasts[place_in[lane] - k] = last
        node, char = piece[lasts], char[lasts]
        wide = np.where(node > 0, 1, _utf8_length(char))
        ids = np.repeat(self.id[node], wide)
        unknown = np.flatnonzero(np.repeat(node == 0, wide))
        if len(unknown):
            first = np.repeat(np.cumsum(wide) - wide, wide)[unknown]
            ids[unknown] = self.byte_ids[_utf8_byte(np.repeat(char, wide)[unknown], np.repeat(wide, wide)[unknown], unknown - first)]
        counts = np.add.reduceat(wide, np.cumsum(own) - own)
        return counts, ids

    def decode_all(self, ids: list[bytes]) -> list[bytes]:
        every = np.frombuffer(b"".join(ids), "<u4")
        length = self.byte_length[every]
        data = ragged(self.byte_pool, self.byte_start[every], length).tobytes()
        upto = np.concatenate([[0], np.cumsum(length)])[np.cumsum([0, *(len(x) // 4 for x in ids)])].tolist()
        return [data[a + 1 : b] for a, b in zip(upto[:-1], upto[1:], strict=True)]

    def decode(self, ids: bytes) -> bytes:
        return self.decode_all([ids])[0]


def _units(score: float) -> int:
    """Scores are added as whole numbers, so that ties are ties wherever a stretch stands."""
    return round(score * 2**32)


def _utf8_length(char: np.ndarray) -> np.ndarray:
    return 1 + (char >= 0x80) + (char >= 0x800) + (char >= 0x10000)


def _utf8_byte(char: np.ndarray, length: np.ndarray, k: np.ndarray) -> np.ndarray:
    """The k-th UTF-8 byte of each character that has `length` of them."""
    bits = char >> (6 * (length - 1 - k))
    lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[length]
    return np.where(k > 0, 0x80 | bits & 0x3F, lead | bits)


@lru_cache(maxsize=2)
def _codec(path: str) -> Codec:
    return Codec.load(path)


def encoder(path: str):
    """A column function from text bytes to ids. The model file is read on each worker from `path`."""

    @pandas_udf(T.BinaryType())
    def encode(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _codec(path)
        for part in texts:
            yield pd.Series([ids for some in portions(part.tolist(), BATCH) for ids in codec.encode_all(some)], dtype=object)

    return encode.asNondeterministic()


def decoder(path: str):
    @pandas_udf(T.BinaryType())
    def decode(ids: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _codec(path)
        for part in ids:
            yield pd.Series([text for some in portions(part.tolist(), BATCH) for text in codec.decode_all(some)], dtype=object)

    return decode.asNondeterministic()


def round_trip(path: str):
    """A column function from text bytes to (ids, exact): the ids, and whether decoding them gives back the text."""

    @pandas_udf(T.StructType([T.StructField("ids", T.BinaryType()), T.StructField("exact", T.BooleanType())]))
    def check(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = _codec(path)
        for part in texts:
            ids: list[bytes] = []
            exact: list[bool] = []
            for some in portions(part.tolist(), BATCH):
                ids += (now := codec.encode_all(some))
                exact += [back == t for back, t in zip(codec.decode_all(now), some, strict=True)]
            yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "exact": pd.Series(exact, dtype=bool)})

    return check.asNondeterministic()


def encoded_and_checked(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (binary, four bytes each), n_ids and round_trip of every row, in one pass through one worker."""
    small_batches(docs.sparkSession)
    both = docs.select(F.col(doc_id).alias("doc_id"), round_trip(path)(text_bytes(text)).alias("r"))
    return both.select("doc_id", F.col("r.ids").alias("ids"), (F.octet_length("r.ids") / 4).cast("long").alias("n_ids"), F.col("r.exact").alias("round_trip"))


def encoded(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """`docs` with a binary column of ids, four bytes each (in place of a column of that name)."""
    small_batches(docs.sparkSession)
    return docs.withColumn(ids, encoder(path)(text_bytes(text)))


def decoded(docs: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """`docs` with the text bytes that its ids stand for (in place of a column of that name)."""
    small_batches(docs.sparkSession)
    return docs.withColumn(text, decoder(path)(F.coalesce(F.col(ids), F.lit(b"").cast("binary"))))
