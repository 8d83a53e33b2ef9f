"""Toxicity by cumulative-link ordinal regression over sparse text features.

A document has grade 0 (clean) to 3. The chance of a grade above k is sigmoid(s - t_k): the
score s has one weight per feature, shared by all thresholds t_0 <= t_1 <= t_2. The expected
severity is the sum of these chances, 0 to 3. A document is toxic if its chance of a grade
above 0 is a half or more.

Features are words (runs of letters, lower-cased) and their prefixes of 4 to 7 letters, hashed;
a feature counts with its share of the document's words. Labels only say toxic or not. The
grades of toxic documents to learn from are thirds of the score of a first fit with two grades.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotflow.llm.common import map_batches
from depotflow.llm.textarrays import code_points, labelled_sample, letter_runs, segment_hashes, slices

GRADES = 4
#: The model is fitted on at most so many labelled documents of each class.
SAMPLE_PER_CLASS = 1200
FEATURES = 8192
HASH_BITS = 20
#: Standard errors by which the classes must differ in a feature for it to count.
LEAST_Z = 5.0
PREFIXES = (4, 5, 6, 7)
SCALE = 100.0


def word_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features of all texts with the index of their text, and words per text."""
    flat, bounds = code_points(texts)
    starts, ends = letter_runs(flat)
    owner = np.searchsorted(bounds, starts, side="right") - 1
    counts = np.bincount(owner, minlength=len(texts))
    shift = np.uint64(64 - HASH_BITS)
    found, whose = [segment_hashes(flat, starts, ends) >> shift], [owner]
    for size in PREFIXES:
        long = ends - starts >= size
        at = starts[long]
        found.append((segment_hashes(flat, at, at + size) ^ np.uint64(size * 0x9E3779B97F4A7C15 & (2**64 - 1))) >> shift)
        whose.append(owner[long])
    return np.concatenate(found).astype(np.int64), np.concatenate(whose), counts


@dataclass
class OrdinalModel:
    """Weights by hashed feature, and ordered thresholds."""

    weights: np.ndarray
    thresholds: np.ndarray

    def scores(self, texts: list[str | None]) -> np.ndarray:
        features, owner, counts = word_features(texts)
        sums = np.bincount(owner, weights=self.weights[features], minlength=len(texts))
        return SCALE * sums / np.maximum(counts, 1)

    def chances(self, scores: np.ndarray) -> np.ndarray:
        """Chances of a grade above 0, 1, 2."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -60, 60)))


def _fit(index: np.ndarray, owner: np.ndarray, value: np.ndarray, grades: np.ndarray, per_doc: np.ndarray, width: int, classes: int, w: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Adaptive gradient ascent of the mean log-likelihood."""
    docs = len(grades)
    share = np.array([np.average(grades > k, weights=per_doc) for k in range(classes - 1)]).clip(1e-3, 1 - 1e-3)
    t = np.sort(np.log((1 - share) / share))
    seen_w, seen_t = np.full(width, 1e-8), np.full(classes - 1, 1e-8)
    for _ in range(rounds):
        s = np.bincount(owner, weights=w[index] * value, minlength=docs)
        cut = 1 / (1 + np.exp(np.clip(s[:, None] - t[None, :], -30, 30)))
        cut = np.concatenate((np.zeros((docs, 1)), cut, np.ones((docs, 1))), axis=1)
        upper, lower = cut[np.arange(docs), grades + 1], cut[np.arange(docs), grades]
        gap = np.maximum(upper - lower, 1e-6)
        slope = per_doc * (upper + lower - 1)  # of the log-likelihood in s
        grad = np.bincount(index, weights=slope[owner] * value, minlength=width) / docs - 2e-4 * w
        grad_t = np.zeros(classes - 1)
        for k in range(classes - 1):
            here, after = grades == k, grades == k + 1
            grad_t[k] = (per_doc * upper * (1 - upper) / gap)[here].sum() - (per_doc * lower * (1 - lower) / gap)[after].sum()
        grad_t /= docs
        seen_w += grad**2
        seen_t += grad_t**2
        w = w + 0.3 * grad / np.sqrt(seen_w)
        t = np.maximum.accumulate(t + 0.1 * grad_t / np.sqrt(seen_t))
    return w, t


def fit_ordinal(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, column: str = "toxic") -> OrdinalModel:
    """Fits on a bounded sample. Without documents of both classes nothing is toxic."""
    none = OrdinalModel(np.zeros(1 << HASH_BITS, np.float32), np.full(GRADES - 1, 30.0))

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            features, owner, counts = word_features(batch.column(0).to_pylist())
            keys, times = np.unique(owner << HASH_BITS | features, return_counts=True)
            parts = np.searchsorted(keys >> HASH_BITS, np.arange(batch.num_rows + 1))
            index = (keys & ((1 << HASH_BITS) - 1)).astype(np.int32)
            value = (times / np.maximum(counts, 1)[keys >> HASH_BITS] * SCALE).astype(np.float32)
            cut = list(zip(parts[:-1].tolist(), parts[1:].tolist(), strict=True))
            return pa.RecordBatch.from_arrays(
                [
                    batch.column(1),
                    pa.array([index[a:b].tobytes() for a, b in cut], pa.binary()),
                    pa.array([value[a:b].tobytes() for a, b in cut], pa.binary()),
                ],
                ["label", "features", "counts"],
            )

        return step

    sample = labelled_sample(docs, labels, column, per_class)
    rows = map_batches(sample, make, "label int, features binary, counts binary").toArrow()  # bounded by the sample
    target = np.array(rows.column(0).to_pylist(), np.int64)
    if len(np.unique(target)) < 2:
        return none
    features = [np.frombuffer(x, np.int32) for x in rows.column(1).to_pylist()]
    value = np.concatenate([np.frombuffer(x, np.float32) for x in rows.column(2).to_pylist()])
    owner = np.repeat(np.arange(len(target), dtype=np.int32), [len(f) for f in features])
    index = np.concatenate(features)
    del rows, features  # the driver holds the sample once
    chosen = _informative(index, owner, target)
    place = np.full(1 << HASH_BITS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    index = place[index]
    keep = index >= 0
    index, owner, value = index[keep], owner[keep], value[keep]
    # the sample has as many documents of either class as it can; they weigh what they stand for
    known = {int(r[0]): r[1] for r in labels.filter(F.col(column).isin(0, 1)).groupBy(F.col(column).cast("int")).count().collect()}
    stands = np.array([known.get(c, 1) / max(1, (target == c).sum()) for c in (0, 1)])
    per_doc = stands[target] / stands[target].mean()
    w, _ = _fit(index, owner, value, target, per_doc, len(chosen), 2, np.zeros(len(chosen)))
    scores = np.bincount(owner, weights=w[index] * value, minlength=len(target))
    toxic = target == 1
    cuts = np.quantile(scores[toxic], [1 / 3, 2 / 3])
    grades = np.where(toxic, 1 + np.searchsorted(cuts, scores, side="right"), 0)
    w, t = _fit(index, owner, value, grades, per_doc, len(chosen), GRADES, w)
    weights = np.zeros(1 << HASH_BITS, np.float32)
    weights[chosen] = w
    return OrdinalModel(weights, t)


def _informative(index: np.ndarray, owner: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The features whose shares of documents differ most between the classes."""
    sizes = np.bincount(target, minlength=2)
    held = [np.bincount(index[target[owner] == c], minlength=1 << HASH_BITS) for c in (0, 1)]
    total = held[0] + held[1]
    shares = [h / s for h, s in zip(held, sizes, strict=True)]
    pooled = total / sizes.sum()
    spread = np.sqrt(np.maximum(pooled * (1 - pooled), 1e-12) * (1 / sizes[0] + 1 / sizes[1]))
    z = np.where(total >= 5, np.abs(shares[1] - shares[0]) / spread, 0)
    best = np.argsort(-z, kind="stable")[:FEATURES]
    return np.sort(best[z[best] > LEAST_Z])


def severities(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """(doc_id, severity, grade, toxic): every row of the documents once, whole texts.

    A NULL or empty text, or one without letters, has the severity of no features.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 4 MB, whatever the data

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        fitted = shared.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(1).to_pylist()
            scores = np.zeros(len(texts))
            for part in slices([len(t or "") for t in texts], 1_000_000):
                scores[part] = fitted.scores([texts[i] for i in part])
            above = fitted.chances(scores)
            return pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(above.sum(axis=1)),
                    pa.array((above >= 0.5).sum(axis=1).astype(np.int32)),
                    pa.array(above[:, 0] >= 0.5),
                ],
                ["doc_id", "severity", "grade", "toxic"],
            )

        return step

    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    return map_batches(rows, make, "doc_id bigint, severity double, grade int, toxic boolean")


def drop_toxic(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """The documents that are not toxic, with their columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        fitted, at = shared.value, names.index("text")

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(at).to_pylist()
            scores = np.zeros(len(texts))
            for part in slices([len(t or "") for t in texts], 1_000_000):
                scores[part] = fitted.scores([texts[i] for i in part])
            return batch.filter(pa.array(fitted.chances(scores)[:, 0] < 0.5))

        return step

    return map_batches(docs, make, docs.schema)
