"""Toxicity by cumulative-link ordinal regression over sparse text features.

A text's features are its distinct words and their prefixes of 4, 5 and 6 letters. Severity grades come from the
labels: 0 (not toxic), 1 (toxic) and 2 (toxic and of low quality as well); labels that give whole grades above 1 are
taken as they are, and there are as many thresholds as grades above 0 occur in the sample. One
weight vector serves all thresholds: P(grade > k) = sigmoid(w.x - b_k) with b_0 <= b_1 ...; the expected
severity is the sum over k. Quality has little to do with words that make a text toxic, so the step from 1 to 2 is
mostly the rate of low quality among toxic texts: a weak one, but one that the features had no part in making.

The model is fitted on the driver on a bounded sample of labelled rows (`max_labelled`, those with the
smallest hashes, so it is the same on every run). Scoring reads every whole text in one pass without a
shuffle; the model that travels holds at most `max_features` weights.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

_WORDS = re.compile(r"\w+")
#: Words that a worker remembers the features of; the memory is emptied when full, which changes no result.
_MEMORY = 200_000


def word_features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in (4, 5, 6) if len(word) >= n)]


def features(text: str) -> set[str]:
    return {f for word in set(_WORDS.findall(text.lower())) for f in word_features(word)}


@dataclass
class OrdinalModel:
    """weights by feature; bounds ascending, one fewer than grades."""

    weights: dict[str, float] = field(default_factory=dict)
    bounds: tuple[float, ...] = ()

    def chances(self, x: np.ndarray) -> np.ndarray:
        """P(grade > k) for each sum of weights x and each threshold k."""
        return 1 / (1 + np.exp(np.clip(np.asarray(self.bounds)[None, :] - x[:, None], -50, 50)))


def fit(texts: list[str], grades: list[int], max_features: int = 4000, min_docs: int = 3, steps: int = 300, ridge: float = 2e-4) -> OrdinalModel:
    """Fits by full-batch gradient steps (Adam) on the cumulative-link likelihood.

    Features are those whose presence tells toxic from other texts best (likelihood ratio), at most max_features.
    With only toxic or only other texts there is nothing to tell apart: the model is empty and rejects nothing.
    """
    steps_up = sorted({g for g in grades if g > 0})  # grades that don't occur give no threshold
    y = np.array([bisect_right(steps_up, g) for g in grades], dtype=int)
    if not (y > 0).any() or not (y == 0).any():
        return OrdinalModel()
    hot, cold = Counter(), Counter()
    for t, g in zip(texts, y, strict=True):  # the feature sets are made twice and never held together
        (hot if g else cold).update(features(t))
    n1, n0 = int((y > 0).sum()), int((y == 0).sum())

    def ratio(f: str) -> float:
        a, c = hot[f], cold[f]
        rate = (a + c) / (n1 + n0)
        terms = ((a, n1 * rate), (n1 - a, n1 * (1 - rate)), (c, n0 * rate), (n0 - c, n0 * (1 - rate)))
        return 2 * sum(o * np.log(o / e) for o, e in terms if o > 0 and e > 0)

    scored = sorted(((ratio(f), f) for f in hot.keys() | cold.keys() if hot[f] + cold[f] >= min_docs), key=lambda t: (-t[0], t[1]))
    kept = [f for score, f in scored[:max_features] if score >= 12]
    if not kept:
        return OrdinalModel()
    del hot, cold, scored
    index = {f: i for i, f in enumerate(kept)}
    sets = [features(t) & index.keys() for t in texts]
    top = int(y.max())
    lengths = [sorted(map(index.__getitem__, s)) for s in sets]
    rows = np.repeat(np.arange(len(sets)), [len(x) for x in lengths])
    cols = np.array([i for x in lengths for i in x], dtype=np.int64)
    w, bounds = np.zeros(len(kept)), np.linspace(1.0, 1.0 + top - 1, top)
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(bounds), np.zeros_like(bounds)]
    over = (y[:, None] > np.arange(top)[None, :]).astype(float)
    emphasis = np.where(np.arange(top) == 0, 4.0, 1.0)  # whether a text is toxic at all matters most
    for step in range(1, steps + 1):
        x = np.bincount(rows, weights=w[cols], minlength=len(y))
        error = emphasis * (over - 1 / (1 + np.exp(np.clip(bounds[None, :] - x[:, None], -50, 50)))) / len(y)
        grad_w = -np.bincount(cols, weights=error.sum(1)[rows], minlength=len(kept)) + ridge * w
        grad_b = error.sum(0)
        for value, grad, m, v in ((w, grad_w, state[0], state[1]), (bounds, grad_b, state[2], state[3])):
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            value -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        bounds[:] = np.maximum.accumulate(bounds)
    return OrdinalModel({f: float(w[i]) for f, i in index.items() if abs(w[i]) > 1e-4}, tuple(float(b) for b in bounds))


def sample(docs: DataFrame, labels: DataFrame, max_labelled: int) -> tuple[list[str], list[int]]:
    """Texts and grades of the labelled rows with the smallest hashes. Nulls in toxic, doc_id or text take no part; of two labels
    the higher grade counts; without a quality column, or where it is null, quality is high."""
    low = (F.col("quality") <= 0) if "quality" in labels.columns else F.lit(False)
    grade = F.when(F.col("toxic") > 1, F.col("toxic").cast("int")).when(F.col("toxic") > 0, F.when(F.coalesce(low, F.lit(False)), 2).otherwise(1)).otherwise(0)
    chosen = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(grade).alias("_grade"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    # at most max_labelled rows of two numbers: the bound that makes this broadcast safe
    rows = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "_grade").toPandas()
    rows = rows.sort_values(["doc_id", "text"]).drop_duplicates("doc_id")
    return rows["text"].tolist(), rows["_grade"].tolist()


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = 5000, **options) -> OrdinalModel:
    return fit(*sample(docs, labels, max_labelled), **options)


def _scorer(model: OrdinalModel):
    """Sum of weights of a text; a feature counts once, whichever of its words bring it."""
    memory: dict[str, tuple[str, ...]] = {}
    weights = model.weights

    def total(text: str | None) -> float:
        if not text or not weights:
            return 0.0
        if len(memory) > _MEMORY:
            memory.clear()
        found: set[str] = set()
        for word in set(_WORDS.findall(text.lower())):
            own = memory.get(word)
            if own is None:
                own = memory[word] = tuple(f for f in word_features(word) if f in weights)
            if own:
                found.update(own)
        return sum(map(weights.__getitem__, sorted(found)))

    return total


SCORED = pa.schema([("doc_id", pa.int64()), ("severity", pa.float64()), ("p_toxic", pa.float64()), ("grade", pa.int32()), ("toxic", pa.bool_())])


def _judged(model: OrdinalModel, texts: list, threshold: float):
    total = _scorer(model)
    if not model.bounds:
        zeros = np.zeros(len(texts))
        return zeros, zeros, zeros.astype(np.int32), zeros > 1
    p = model.chances(np.array([total(t) for t in texts], dtype=float))
    toxic = p[:, 0] >= threshold
    return p.sum(1), p[:, 0], np.where(toxic, np.maximum(1, (p >= threshold).sum(1)), 0).astype(np.int32), toxic


def score(docs: DataFrame, model: OrdinalModel, threshold: float = 0.15) -> DataFrame:
    """doc_id, severity (expected grade), p_toxic, grade and toxic (p_toxic >= threshold; a low one, since
    texts without telling words score some hundredths) of every whole text.

    Null or empty text has the severity of a text without features; null ids stay; each repeated row is
    scored alike; an empty table gives no rows; no other column is read.
    """

    def start():
        def f(batch):
            severity, p, grade, toxic = _judged(model, batch.column(1).to_pylist(), threshold)
            return [batch.column(0), severity, p, grade, toxic]

        return f

    return map_batches(docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text"), SCORED, start)


def reject_toxic(docs: DataFrame, model: OrdinalModel, threshold: float = 0.15) -> DataFrame:
    """docs without the rows judged toxic; columns as they were, whatever their names.

    Null and empty texts, and all rows if the model is empty, stay; each repeated row is judged alike; null ids stay; an
    empty table gives none.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    at = docs.columns.index("text")

    def start():
        def f(batch):
            toxic = _judged(model, batch.column(at).to_pylist(), threshold)[3]
            return batch.filter(pa.array(~toxic)).columns

        return f

    return map_batches(docs, to_arrow_schema(docs.schema), start)
