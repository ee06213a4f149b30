"""Toxicity: a support vector machine over a gapped-subsequence string kernel, with Nystroem landmarks.

Units are words, and runs of single letters taken together. The kernel compares two units by the subsequences of three
letters they share, each weighted by DECAY to the power of the characters it skips, so `i.d.i-o.t` and `i d i o t` stay
close to `idiot`; marks and digits take up room in a unit but never match, and a unit's start counts as a letter. Landmark units span the Nystroem feature space;
a hinge-loss model is fitted there. As a sum over landmarks of a kernel that is an inner product, the decision is also
one weight per letter triple (ALPHABET**3 of them, whatever the corpus), which is what tasks receive.

Only documents are labelled, so the unit of each toxic document that scores highest stands for it while fitting (three
rounds), against units of clean documents; a text's margin is its highest unit's. At most `MAX_ROWS` labelled documents
are used to fit.

Defined cases: null, empty and letter-less texts get the lowest margin; without labels of both classes every score is 0;
repeated rows get equal scores; an empty table gives an empty result; further columns are not read by `judge` and kept as
they are by `keep_clean`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from millrace.llm.common import fresh, remainder, small_batches, text_bytes, words_of
from millrace.llm.labelled import fit_once, sample
from millrace.llm.svm import calibrate, dual_coordinate_descent, probability

ALPHABET, OTHER, START = 64, 0, 63
DECAY, LONGEST_SPAN = 0.6, 6
#: Longer units are read in overlapping pieces of this many characters.
PIECE = 24
LANDMARKS, NEGATIVES, ROUNDS = 128, 6000, 3
MODULUS, HELD_OUT, THRESHOLD = 4, 2, 0.3
#: Labelled documents that fitting reads at most.
MAX_ROWS = 6000
#: Units whose margins a Python worker remembers, and texts it reads before it looks up their units.
REMEMBERED, TEXTS = 150_000, 200
_SPELT = re.compile(rb"(?<![^\s])(?:[a-z]\s){2,}[a-z](?![^\s])")
_GAPS = [(i, j) for i in range(1, LONGEST_SPAN - 1) for j in range(1, LONGEST_SPAN - i)]

Model = tuple[np.ndarray, float, float, float]


def units_of(text: bytes) -> set[bytes]:
    found = set(words_of(text))
    for run in _SPELT.findall(text.lower()):
        found.add(b".".join(run.split()))
    return found


def _letter_table() -> np.ndarray:
    """Codes 1..26 of a-z and 27..62 of letters from U+00C0 on (by remainder, so cases and accents stay apart); 0 of all else."""
    points = np.arange(0x110000)
    table = np.where(points >= 0xC0, 27 + points % 36, OTHER).astype(np.int32)
    table[0xD7] = table[0xF7] = OTHER
    table[97:123] = np.arange(1, 27)
    return table


_CODE = _letter_table()


def _matrix(units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of units as rows of letter codes, and each row's unit. A unit holds no line end, as it is a word."""
    joined = b"\n".join(units).decode("utf-8", "replace").lower() + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.flatnonzero(points == 10)
    begins = np.concatenate([[0], ends[:-1] + 1])
    pieces = np.maximum(1, -(-(ends - begins - PIECE) // (PIECE // 2)) + 1)
    owner = np.repeat(np.arange(len(units)), pieces)
    turn = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    at = begins[owner] + turn * (PIECE // 2)
    place = at[:, None] + np.arange(PIECE + LONGEST_SPAN)
    inside = (np.arange(PIECE + LONGEST_SPAN) < PIECE) & (place < ends[owner][:, None])
    codes = np.where(inside, _CODE[points[np.minimum(place, len(points) - 1)]], OTHER)
    start = np.where(turn == 0, START, OTHER).astype(codes.dtype)
    return np.concatenate([start[:, None], codes[:, :-1]], axis=1), owner


def _triples(codes: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """For each pattern of gaps: the triple at every place (0 where a place has none), and its weight."""
    codes = np.pad(codes, ((0, 0), (0, 1)))
    first = codes[:, : PIECE + 1]
    for i, j in _GAPS:
        second, third = codes[:, i : i + PIECE + 1], codes[:, i + j : i + j + PIECE + 1]
        whole = (first > 0) & (second > 0) & (third > 0)
        yield np.where(whole, (first * ALPHABET + second) * ALPHABET + third, 0), DECAY ** (i + j - 2)


def _maps(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normalised features of a few pieces over the triples that any of them has; and each triple's column (0: none of them)."""
    parts = [(index, weight) for index, weight in _triples(codes)]
    used = np.unique(np.concatenate([index.ravel() for index, _ in parts]))
    column = np.zeros(ALPHABET**3, np.int32)
    column[used[used > 0]] = np.arange(1, (used > 0).sum() + 1)
    out, norm = np.zeros((len(codes), int((used > 0).sum()) + 1)), np.zeros(len(codes))
    row = np.arange(len(codes))[:, None]
    for index, weight in parts:
        np.add.at(out, (np.broadcast_to(row, index.shape), column[index]), weight)
        norm += weight**2 * (index > 0).sum(axis=1)
    out[:, 0] = 0
    return out / np.sqrt(np.maximum(norm, 1e-9))[:, None], column


def _decide(codes: np.ndarray, weights: np.ndarray, column: np.ndarray | None = None) -> np.ndarray:
    """Inner products of each piece's normalised features with each row of `weights`, whose entries 0 are 0."""
    total, norm = np.zeros((len(codes), len(weights))), np.zeros(len(codes))
    for index, weight in _triples(codes):
        at = index if column is None else column[index]
        for k, w in enumerate(weights):
            total[:, k] += weight * w[at].sum(axis=1)
        norm += weight**2 * (index > 0).sum(axis=1)
    return total / np.sqrt(np.maximum(norm, 1e-9))[:, None]


def margins(units: list[bytes], weights: np.ndarray, bias: float) -> np.ndarray:
    """Decision values; a unit takes that of its best piece."""
    best = np.full(len(units), -np.inf)
    for at in range(0, len(units), 4096):
        codes, owner = _matrix(units[at : at + 4096])
        np.maximum.at(best, owner + at, _decide(codes, weights[None])[:, 0] + bias)
    return best


def _train(positive: list[bytes], negative: list[bytes], seed: int) -> tuple[np.ndarray, float]:
    """Nystroem features of units against landmarks of both kinds, a hinge-loss model on them, and its weights by triple."""
    rng = np.random.default_rng(seed)
    pick = lambda units: [units[i] for i in sorted(rng.choice(len(units), min(len(units), LANDMARKS // 2), replace=False))]
    landmarks, column = _maps(_matrix([u[:PIECE] for u in pick(positive) + pick(negative)])[0])
    values, vectors = np.linalg.eigh(landmarks @ landmarks.T)
    use = values > 1e-4 * values[-1]
    whiten = vectors[:, use] / np.sqrt(values[use])
    codes, owner = _matrix(positive + negative)
    y = np.where(owner < len(positive), 1, -1)
    z = _decide(codes, landmarks, column) @ whiten
    every = np.arange(z.shape[1])
    w, bias = dual_coordinate_descent([(every, row) for row in z], y, z.shape[1], cost=10.0)
    weights = (landmarks.T @ (whiten @ w)).astype(np.float32)[column]
    return weights, bias


def fit(texts: list[bytes], labels: list[int]) -> Model:
    """(weight by triple, bias, slope, shift)."""
    if len(set(labels)) < 2:
        return np.zeros(ALPHABET**3, np.float32), -1.0, 30.0, 0.0
    number: dict[bytes, int] = {}
    owned = [np.array(sorted({number.setdefault(u, len(number)) for u in units_of(t)}), np.int64) for t in texts]
    units, y = list(number), np.array(labels)
    n1, n0 = int(y.sum()), int((1 - y).sum())
    seen1, seen0 = (np.bincount(np.concatenate([o for o, x in zip(owned, labels, strict=True) if x == k]), minlength=len(units)) for k in (1, 0))
    lift = seen1 / n1 / ((seen0 + 0.5) / n0)
    strength = np.where((lift >= 4) & ((seen1 > 1) | (n1 < 20)), seen1 * lift, 0)
    # Units that could stand for a toxic document; documents without one teach nothing.
    toxic = [o[strength[o] > 0] for o, x in zip(owned, labels, strict=True) if x]
    toxic = [o for o in toxic if len(o)]
    chosen = {int(o[strength[o].argmax()]) for o in toxic}
    often = np.flatnonzero(seen0)[np.argsort(-seen0[seen0 > 0], kind="stable")]
    rng = np.random.default_rng(7)
    negative = {*often[: NEGATIVES // 4].tolist(), *rng.choice(often, min(len(often), NEGATIVES), replace=False).tolist()}
    weights, bias, of = np.zeros(ALPHABET**3, np.float32), -1.0, np.full(len(units), -1.0)
    for turn in range(ROUNDS):
        positive = sorted(chosen)
        if not positive or not negative:
            break
        weights, bias = _train([units[k] for k in positive], [units[k] for k in sorted(negative)], turn)
        of = margins(units, weights, bias)
        chosen = {int(o[of[o].argmax()]) for o in toxic}
        negative |= set(often[np.argsort(-of[often], kind="stable")][: NEGATIVES // 4].tolist())
    best = np.array([of[o].max() if len(o) else bias for o in owned])
    return (weights, bias, *calibrate(best, np.where(y > 0, 1, -1)))


def scorer(spark: SparkSession, model: Model):
    """A column function from text bytes to the score; the model's size is fixed, so it is broadcast."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights, bias, slope, shift = shared.value
        known: dict[bytes, float] = {}
        for part in texts:
            out = []
            for at in range(0, len(part), TEXTS):
                owned = [units_of(t) for t in part.iloc[at : at + TEXTS]]
                if len(known) > REMEMBERED:
                    known.clear()
                new = list({u for units in owned for u in units} - known.keys())
                known.update(zip(new, margins(new, weights, bias).tolist(), strict=True))
                out += [max(map(known.__getitem__, units), default=bias) for units in owned]
            yield pd.Series(probability(np.array(out, float), slope, shift))

    return score.asNondeterministic()


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text", max_rows: int = MAX_ROWS) -> Model:
    return fit_once(sample(docs, labels, label, held_out(doc_id), max_rows, doc_id, text), fit)


def held_out(doc_id: str) -> Column:
    return F.coalesce(remainder(doc_id, MODULUS) == HELD_OUT, F.lit(False))


def judge(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text", max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of `docs`; labels of held-out ids are never learnt from."""
    score = scorer(docs.sparkSession, train(docs, labels, label, doc_id, text, max_rows))
    scored = docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), score(text_bytes(text)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that score below the threshold, with all their columns."""
    score = scorer(docs.sparkSession, train(docs, labels, label, doc_id, text))
    mark = fresh("toxicity", docs)
    return docs.withColumn(mark, score(text_bytes(text))).filter(F.col(mark) < THRESHOLD).drop(mark)
