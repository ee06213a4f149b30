"""Quality classifier: naive Bayes support vectors.

Features are indicators of n-grams: hashed words and word pairs (a word equal to the one before it counts as one common
token), and four-grams of character kinds. Each is scaled by its smoothed log-count ratio between the classes, and a linear
hinge-loss model is fitted by dual coordinate descent on a sample of at most `MAX_ROWS` labelled documents.

Defined cases: null and empty texts have no feature and get the score of the bias; without labels of both classes every
score is 0.5; repeated rows get equal scores; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from millrace.llm.common import remainder, small_batches, text_bytes, words_of
from millrace.llm.labelled import MAX_ROWS, fit_once, sample
from millrace.llm.svm import calibrate, dual_coordinate_descent, probability

HASHED, KINDS = 1 << 18, 16
WIDTH = HASHED + KINDS**4
MODULUS, HELD_OUT, THRESHOLD = 3, 1, 0.5


def _kind_table() -> bytes:
    """Kinds of bytes: 0 lower-case, 1 upper-case, 2 digits, 3 blanks, 4 line ends, 5 bytes of other characters, and marks by themselves or together."""
    kinds = np.full(256, 15, np.uint8)
    for kind, chars in enumerate((range(97, 123), range(65, 91), range(48, 58), b" \t", b"\r\n\x0b\x0c", range(128, 256), b".", b",", b"!?", b"|", b"#*", b"$%&", b"<>", b"'\"", b"-_:;")):
        kinds[list(chars)] = kind
    return kinds.tobytes()


_KIND = _kind_table()


def features(text: bytes) -> np.ndarray:
    """Sorted distinct feature numbers of a text."""
    words, before, codes = words_of(text), b"", []
    for w in words:
        codes.append(1 if w == before else zlib.crc32(w) | 2)
        before = w
    one = np.array(codes, np.uint64)
    pair = (one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:] * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(46)
    kind = np.frombuffer(text.translate(_KIND), np.uint8).astype(np.uint16)  # four kinds fill 16 bits
    runs = ((kind[:-3] * KINDS + kind[1:-2]) * KINDS + kind[2:-1]) * KINDS + kind[3:] if len(kind) > 3 else kind[:0]
    found = np.zeros(WIDTH, bool)
    found[((one * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)).astype(np.int64)] = True
    found[pair.astype(np.int64)] = True
    found[HASHED:][runs] = True
    return np.flatnonzero(found)


def fit(texts: list[bytes], labels: list[int]) -> tuple[np.ndarray, float, float, float]:
    """(weights, bias, slope, shift). The curve is fitted to margins of two halves, each judged by the other half's model."""
    y = np.where(np.array(labels, int) > 0, 1, -1)
    if len(set(labels)) < 2:
        return np.zeros(WIDTH, np.float32), 0.0, 1.0, 0.0
    found = [features(t) for t in texts]

    def train(chosen: np.ndarray) -> tuple[np.ndarray, float]:
        count = np.ones((2, WIDTH))
        for i in chosen:
            count[int(y[i] > 0), found[i]] += 1
        ratio = np.log(count[1] / count[1].sum()) - np.log(count[0] / count[0].sum())
        scaled = [(found[i], ratio[found[i]] / np.sqrt(max(1, len(found[i])))) for i in chosen]
        w, bias = dual_coordinate_descent(scaled, y[chosen], WIDTH)
        return w * ratio, bias

    half = np.arange(len(y)) % 2 == 0
    margin = np.zeros(len(y))
    if all(len(set(y[h])) == 2 for h in (half, ~half)):
        for h in (half, ~half):
            w, bias = train(np.flatnonzero(~h))
            for i in np.flatnonzero(h):
                margin[i] = w[found[i]].sum() / np.sqrt(max(1, len(found[i]))) + bias
    w, bias = train(np.arange(len(y)))
    slope, shift = calibrate(margin, y) if margin.any() else (1.0, 0.0)
    return w.astype(np.float32), bias, slope, shift


def scorer(spark: SparkSession, model: tuple[np.ndarray, float, float, float]):
    """A column function from text bytes to the score; the model's size is fixed, so it is broadcast."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights, bias, slope, shift = shared.value
        for part in texts:
            margin = [float(weights[f].sum(dtype="float64")) / np.sqrt(max(1, len(f))) + bias for f in map(features, part)]
            yield pd.Series(probability(np.array(margin, float), slope, shift))

    return score


def judge(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text", max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of `docs`; labels of held-out ids are never learnt from."""
    held_out = F.coalesce(remainder(doc_id, MODULUS) == HELD_OUT, F.lit(False))
    model = fit_once(sample(docs, labels, label, held_out, max_rows, doc_id, text), fit)
    scored = docs.select(F.col(doc_id).alias("doc_id"), held_out.alias("held_out"), scorer(docs.sparkSession, model)(text_bytes(text)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
