"""Bounded samples of labelled documents, and fitting a model on one in a task of its own."""

from __future__ import annotations

import pickle
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import text_bytes

#: Bound on the labelled rows that fitting reads (rows beyond it are not used to fit, and are scored as any other).
MAX_ROWS = 6000


def sample(docs: DataFrame, labels: DataFrame, label: str, held_out: Column, max_rows: int = MAX_ROWS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, y, text) of at most `max_rows` labelled documents that are not held out, the first by a hash of their id.

    A document with several labels counts as 1 if any says so; labels without a 0 or 1, and null ids, are not used. Further columns of either table are not read."""
    known = labels.filter(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull() & ~held_out).select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y"))
    chosen = known.groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(max_rows)
    texts = docs.select(F.col(doc_id).alias("id"), text_bytes(text).alias("text"))
    # Of an id's texts the least, so that repeated ids take up one row.
    return texts.join(F.broadcast(chosen), "id").groupBy("id").agg(F.first("y").alias("y"), F.min("text").alias("text"))


def fit_once(rows: DataFrame, fit: Callable[[list[bytes], list[int]], object]) -> object:
    """Runs `fit` on the bounded sample in one executor task and returns its (small) model."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("id", kind="stable")
        return pd.DataFrame({"model": [pickle.dumps(fit(part["text"].tolist(), part["y"].tolist()))]})

    got = rows.groupBy().applyInPandas(run, "model binary").collect()
    return pickle.loads(got[0].model) if got else fit([], [])
