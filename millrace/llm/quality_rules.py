"""Weak supervision of text quality.

Eleven rules look at cheap statistics of a text and vote good (2), bad (0) or abstain (1). How often each rule casts each of the three
votes on good and on bad texts, and how many texts are good, is estimated without labels by expectation-maximisation over the counts of
vote patterns (at most 3**11 of them, however many documents there are). All rates are free; the classes are told apart by where the
estimation starts (rules are right more often than not, most texts are good). A text is kept when its posterior probability of being good
is at least one half, so one bad vote of a rule that also errs on good texts decides nothing, and no rule is a veto.

Defined cases: null text is empty (no words, base_failed); every row gets its own verdict, so repeated rows agree;
an empty table gives an empty result; further columns of the input are neither read nor returned by `judge`, and kept
as they are by `keep_good`, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from millrace.llm.common import WHITE, fresh, small_batches, stash, text_bytes

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
MIN_WORDS, MAX_REPEAT_PCT = 20, 30
RULES = ("symbols", "marked", "lone", "runs", "dup_lines", "repeats", "variety", "capitals", "shouts", "stutter", "word_length")
_CONTINUATION = bytes(range(0x80, 0xC0))
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeat_words(ids: np.ndarray, width: int = WINDOW) -> int:
    """Words lying in windows of `width` words that occur at least twice. Windows get exact ids by doubling."""
    n = len(ids) - width + 1
    if n < 2:
        return 0
    code, span = ids.astype(np.int64), 1
    while span < width:
        step = min(span, width - span)
        low, high = code[: len(code) - step], code[step:]
        code = np.unique(low * (int(code.max()) + 1) + high, return_inverse=True)[1]
        span += step
    again = np.bincount(code)[code] > 1
    if not again.any():
        return 0
    edges = np.zeros(len(ids) + 1, np.int64)
    starts = np.flatnonzero(again)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + width, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def statistics(text: bytes) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, votes (base 3, first rule highest)."""
    words = text.split()
    n = len(words)
    solid = text.translate(None, WHITE)
    chars = len(solid.translate(None, _CONTINUATION))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip(WHITE)]
    dup_lines = len(lines) - len(set(lines))
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    repeated = repeat_words(ids)
    if not n:
        return 0, 0, symbols, 0, 0, _packed([1] * len(RULES))
    stutter = int((ids[1:] == ids[:-1]).sum())
    distinct = len(seen)
    lower, upper = (len(solid) - len(solid.translate(None, alphabet)) for alphabet in (_LOWER, _UPPER))
    shapes = text.translate(_SHAPES)
    kinds = Counter(shapes.split())
    votes = [
        _vote(symbols / n, 0.03, 0.15),
        _vote(sum(c for k, c in kinds.items() if b"#" in k) / n, 0.03, 0.1),
        _vote(sum(c for k, c in kinds.items() if b"a" not in k) / n, 0.05, 0.15),
        _vote(shapes.count(b"##") / n, 0.02, 0.1),
        1 if 0 < dup_lines < 3 else _vote(dup_lines / len(lines), 0.1, 0.3),
        _vote(repeated / n, 0.15, 0.3),
        1 if n < 40 else _vote(-distinct / min(n, 400), -0.45, -0.25),
        1 if lower + upper < 20 else _vote(upper / (lower + upper), 0.15, 0.4),
        _vote(text.count(b"!") / n, 0.05, 0.2),
        1 if n < 10 else _vote(stutter / n, 0.03, 0.1),
        0 if chars < 2 * n or chars > 14 * n else 2 if 3 * n <= chars <= 10 * n else 1,
    ]
    return n, chars, symbols, dup_lines, repeated, _packed(votes)


_LOWER, _UPPER = bytes(range(97, 123)), bytes(range(65, 91))
#: Symbols as #, letters, digits and bytes beyond ASCII as a, other marks as a stop; white space as it is.
_SHAPES = bytes(b if b in WHITE else 35 if b in SYMBOLS else 97 if b > 127 or chr(b).isalnum() else 46 for b in range(256))


def _vote(value: float, good_to: float, bad_from: float) -> int:
    return 2 if value <= good_to else 0 if value > bad_from else 1


def _packed(votes: list[int]) -> int:
    out = 0
    for v in votes:
        out = out * 3 + v
    return out


def _unpacked(pattern: np.ndarray) -> np.ndarray:
    places = 3 ** np.arange(len(RULES) - 1, -1, -1)
    return pattern[:, None] // places % 3


@pandas_udf(T.StructType([T.StructField(c, T.LongType()) for c in (*_COUNTS, "votes")]))
def _statistics(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for part in texts:
        yield pd.DataFrame([statistics(t) for t in part], columns=[*_COUNTS, "votes"], dtype="int64")


def features(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.col(doc_id).alias("doc_id"), _statistics(text_bytes(text)).alias("s")).select("doc_id", "s.*")


#: Where the estimation starts: the share of good texts, and rates of bad, abstaining and good votes on bad and on good texts.
FIRST_PRIOR, FIRST_RATES = 0.8, ((0.3, 0.2, 0.5), (0.05, 0.2, 0.75))


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 500) -> tuple[np.ndarray, float, np.ndarray]:
    """(probability of good for each vote pattern, share of good texts, rates[class, vote, rule] with class 0 bad and 1 good), by EM.

    Rules vote independently given the class. One text is added to each count, so no rate is 0 or 1. Should the classes have changed
    places (the "good" one gets the larger share of bad votes), they are named the other way round."""
    votes = _unpacked(patterns)
    cast = np.stack([votes == v for v in (0, 1, 2)]).astype(float)  # [vote, pattern, rule]
    prior, rates = FIRST_PRIOR, np.repeat(np.array(FIRST_RATES)[:, :, None], votes.shape[1], axis=2)
    good = np.zeros(len(counts))
    for _ in range(rounds):
        says = np.einsum("vpr,cvr->cp", cast, np.log(rates))
        new = 1 / (1 + np.exp(-np.clip(np.log(prior / (1 - prior)) + says[1] - says[0], -500, 500)))
        prior = (new @ counts + 1) / (counts.sum() + 2)
        rates = np.stack([np.einsum("vpr,p->vr", cast, share * counts) + 1 for share in (1 - new, new)])
        rates /= rates.sum(axis=1, keepdims=True)
        if np.abs(new - good).max(initial=0) < 1e-9:
            break
        good = new
    if rates[1, 0].sum() > rates[0, 0].sum():
        new, prior, rates = 1 - new, 1 - prior, rates[::-1]
    return new, float(prior), rates


def posterior(patterns: np.ndarray, counts: np.ndarray, rounds: int = 500) -> np.ndarray:
    return estimate(patterns, counts, rounds)[0]


def fit(votes: DataFrame) -> DataFrame:
    """(votes, p_good) for each vote pattern that occurs; at most 3**11 rows, so small enough to broadcast."""
    counts = votes.groupBy("votes").count().orderBy("votes").toPandas()
    p = posterior(counts["votes"].to_numpy("int64"), counts["count"].to_numpy("float64")) if len(counts) else np.zeros(0)
    rows = [(int(v), float(q)) for v, q in zip(counts["votes"], p, strict=True)]
    return votes.sparkSession.createDataFrame(rows, "votes long, p_good double")


def _base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the base counts, base_failed, p_good and kept for every row of `docs`."""
    found = stash(features(docs, doc_id, text), "quality")
    return (
        found.join(F.broadcast(fit(found)), "votes")
        .withColumn("base_failed", _base_failed())
        .select("doc_id", *_COUNTS, "base_failed", "p_good", (~F.col("base_failed") & (F.col("p_good") >= 0.5)).alias("kept"))
    )


def keep_good(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that `judge` keeps, with all their columns. Reads the texts twice and writes none of them."""
    model = fit(features(docs, doc_id, text).select("votes"))
    mark, votes = fresh("quality", docs), fresh("votes", docs)
    found = docs.withColumn(mark, _statistics(text_bytes(text)))
    n, repeated = (F.col(f"{mark}.{c}") for c in ("n_words", "n_repeat_words"))
    passed = found.filter((n >= MIN_WORDS) & (100 * repeated <= MAX_REPEAT_PCT * n)).withColumn(votes, F.col(f"{mark}.votes"))
    good = model.filter("p_good >= 0.5").select(F.col("votes").alias(votes))
    return passed.join(F.broadcast(good), votes, "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns))
