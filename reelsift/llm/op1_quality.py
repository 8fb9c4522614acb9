"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade <= k) = logistic(threshold_k - w.x): all grades share the weights w of hashed text features, the thresholds are
ordered. It gives each text an expected grade and the tail probability of the best grade, by which it is selected.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reelsift.llm.words import _RANDOM, BLANKS, PLAIN, as_bytes, in_batches, inside, mix, slices, tokens, unused, window_hashes

#: Hashed features; most labelled rows that the fit uses; texts a feature must be in to count; least tail probability.
FEATURES, MOST_ROWS, LEAST_TEXTS, LEAST_TAIL = 1 << 18, 16_000, 5, 0.5
_MARKS = np.where([not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 or b == 32 or 9 <= b <= 13) for b in range(256)], _RANDOM, np.uint64(0)).astype(np.uint64)
_UPPER = np.where([65 <= b <= 90 for b in range(256)], _RANDOM, np.uint64(0)).astype(np.uint64)


class Model(NamedTuple):
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one fewer than grades


def _by_text(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return np.bincount(np.repeat(np.arange(len(counts)), counts), values, minlength=len(counts))


def features(texts: list[bytes | None], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each text, as (text, feature) sorted by both: its words, its runs of marks, and classes of its proportions."""
    words, marks, upper, raw = (tokens(texts, t) for t in (PLAIN, _MARKS, _UPPER, BLANKS))
    n = np.maximum(words.counts, 1)
    pairs = window_hashes(words.ids, 3)[inside(words.counts, 3)] if len(words.ids) >= 3 else np.empty(0, np.uint64)
    of = np.repeat(np.arange(len(texts)), np.maximum(words.counts - 2, 0))
    order = np.lexsort([pairs, of])
    distinct = np.bincount(of[order][np.concatenate([[True], (np.diff(of[order]) != 0) | (np.diff(pairs[order]) != 0)])] if len(of) else of, minlength=len(texts))
    shares = [
        _by_text((words.ends - words.starts).astype(float), words.counts) / n / 12,
        _by_text((upper.ends - upper.starts).astype(float), upper.counts) / np.maximum(1, _by_text((words.ends - words.starts).astype(float), words.counts)),
        marks.counts / np.maximum(1, raw.counts),
        distinct / np.maximum(1, words.counts - 2),
        np.log2(n) / 16,
    ]
    rows, ids = [], []
    for lane, found in ((1, words), (2, marks)):
        rows.append(np.repeat(np.arange(len(texts)), found.counts))
        ids.append(mix(found.ids + np.uint64(lane)) % np.uint64(size))
    for lane, share in enumerate(shares):
        rows.append(np.arange(len(texts)))
        ids.append(mix(np.minimum(share * 12, 12).astype(np.uint64) + np.uint64(100 * (lane + 1))) % np.uint64(size))
    both = np.unique(np.concatenate(rows).astype(np.int64) * size + np.concatenate(ids).astype(np.int64))
    return both // size, both % size


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def probabilities(score: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade >= k) for k = 1 up to the best grade."""
    return 1 - _logistic(thresholds[None, :] - score[:, None])


def fit(rows: list[np.ndarray], grades: np.ndarray, n_grades: int, size: int, steps: int = 200, ridge: float = 1.0, rate: float = 0.1) -> Model:
    """Fits weights and thresholds by Adam on all rows; ``rows`` are the features of each text.

    Without rows the weights are 0 and every grade from the best down is likely, so nothing is rejected.
    """
    if not len(rows):
        return Model(np.zeros(size, np.float32), np.arange(n_grades - 1) - float(n_grades + 3))
    feature, text = np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(x) for x in rows])
    used = np.flatnonzero(np.bincount(feature, minlength=size) >= min(LEAST_TEXTS, len(rows)))
    place = np.full(size, -1)
    place[used] = np.arange(len(used))
    feature, text = place[feature][place[feature] >= 0], text[place[feature] >= 0]
    below = np.cumsum(np.bincount(grades, minlength=n_grades) + 1.0)[:-1] / (len(grades) + n_grades)
    start = np.log(below / (1 - below))
    # thresholds are the first and exponentials of the gaps, so they stay ordered
    x = np.concatenate([np.zeros(len(used)), start[:1], np.log(np.maximum(np.diff(start), 1e-3))])
    m, v = np.zeros_like(x), np.zeros_like(x)
    edges = np.arange(n_grades - 1)
    for step in range(1, steps + 1):
        w, theta = x[: len(used)], np.cumsum(np.concatenate([x[len(used) : len(used) + 1], np.exp(x[len(used) + 1 :])]))
        score = np.bincount(text, w[feature], minlength=len(rows))
        upto = np.concatenate([np.zeros((len(rows), 1)), _logistic(theta[None, :] - score[:, None]), np.ones((len(rows), 1))], axis=1)
        slope = upto * (1 - upto)
        p = np.maximum(upto[np.arange(len(rows)), grades + 1] - upto[np.arange(len(rows)), grades], 1e-9)
        high, low = slope[np.arange(len(rows)), grades + 1] / p, slope[np.arange(len(rows)), grades] / p
        to_theta = np.array([high[grades == k].sum() - low[grades == k + 1].sum() for k in edges])
        to_gap = np.cumsum(to_theta[::-1])[::-1]
        gap = np.concatenate([[1.0], np.exp(x[len(used) + 1 :])])
        grad = np.concatenate([ridge * w + np.bincount(feature, (high - low)[text], minlength=len(used)), -to_gap * gap])
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        x = x - rate * (1 - step / (steps + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    weights = np.zeros(size, np.float32)
    weights[used] = x[: len(used)]
    return Model(weights, np.cumsum(np.concatenate([x[len(used) : len(used) + 1], np.exp(x[len(used) + 1 :])])))


def _feature_batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = as_bytes(batch.column(0))
        for a, b in slices(texts):
            row, feature = features(texts[a:b], size)
            offsets = np.searchsorted(row, np.arange(b - a + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(feature.astype(np.int32)))
            yield pa.record_batch([batch.column(1).slice(a, b - a), lists], names=["grade", "features"])


def _score_batches(batches: Iterator[pa.RecordBatch], model, size: int, least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = batch.num_columns - 1
        texts = as_bytes(batch.column(n))
        for a, b in slices(texts):
            row, feature = features(texts[a:b], size)
            tail = probabilities(np.bincount(row, model.value.weights[feature], minlength=b - a), model.value.thresholds)
            part = batch.slice(a, b - a)
            made = [pa.array(tail.sum(axis=1)), pa.array(tail[:, -1]), pa.array(tail[:, -1] >= least)]
            yield pa.record_batch([*part.columns[:n], *made], names=[*part.schema.names[:n], "expected_grade", "tail_probability", "keep"])


def graded(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Ratings from ``labels``: 0 toxic, 1 poor, 2 good; one row for each key, its lowest. Rows without a quality are left out."""
    toxic: Column = F.coalesce(F.col("toxic"), F.lit(0)) > 0
    rating = F.when(toxic, 0).when(F.col("quality") > 0, 2).otherwise(1)
    rows = labels.where(F.col("quality").isNotNull() & F.col(key).isNotNull())
    return rows.groupBy(F.col(key).alias("rated")).agg(F.min(rating).cast("int").alias("grade"))


def train(docs: DataFrame, ratings: DataFrame, key: str = "doc_id", text: str = "text", n_grades: int = 3, size: int = FEATURES, most_rows: int = MOST_ROWS) -> Model:
    """Fits on the at most ``most_rows`` rated keys whose hashes are least; only their features come to the driver.

    ``ratings`` has rated (a key) and grade. Of rows that share a key one, the one of the least text, counts; keys that
    no row has and null keys don't. A null text has the features of a text of no words. Without rated rows nothing is
    rejected. ``docs`` may have any other columns.
    """
    some = F.broadcast(ratings.select("rated", "grade").orderBy(F.xxhash64("rated"), "rated").limit(most_rows))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(some, F.col("key") == F.col("rated"))
    rows = rows.groupBy("rated").agg(F.min("text").alias("text"), F.first("grade").alias("grade"))
    found = in_batches(rows.select("text", "grade"), lambda it: _feature_batches(it, size), "grade int, features array<int>").toArrow()
    lists = found["features"].combine_chunks()
    return fit([x.values.to_numpy() for x in lists], found["grade"].to_numpy(), n_grades, size)


def score(docs: DataFrame, model: Model, text: str = "text", least: float = LEAST_TAIL) -> DataFrame:
    """All rows and columns of ``docs`` and expected_grade, tail_probability (double), keep (boolean).

    ``keep`` says that the probability of the best grade is at least ``least``. Null and empty texts have the features of
    a text of no words. Repeated rows score alike. Columns with these names are replaced. An empty table gives an empty
    table.
    """
    docs = docs.drop("expected_grade", "tail_probability", "keep")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    size = len(model.weights)
    schema = StructType([*docs.schema.fields, *StructType.fromDDL("expected_grade double, tail_probability double, keep boolean").fields])
    return in_batches(docs.select("*", F.col(text).alias(unused(docs.columns, "_text")[0])), lambda it: _score_batches(it, sent, size, least), schema)
