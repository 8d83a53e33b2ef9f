"""Text quality by supervised subword embeddings.

Words (between white space, as they are), pairs of neighbouring words and runs of 3 to 5 bytes are
hashed to learned vectors. Pairs are hashed by their difference, so that any word that stands
twice in a row is one and the same feature.
A document's vector is the mean over all its words and runs, and a linear layer with softmax
gives the chance of each class. Vectors and layer are trained together by stochastic gradient
descent in numpy, on a bounded sample of labelled documents.

Because a mean and a layer are both linear, a trained model gives every hash one number per
class; scoring adds these up without building document vectors.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotflow.llm.common import held_out, map_batches
from depotflow.llm.textarrays import labelled_sample, segment_hashes

HASH_BITS = 17
DIMENSIONS = 16
RUNS = (3, 4, 5)
#: The model is trained on at most so many labelled documents of each class.
SAMPLE_PER_CLASS = 1500
EPOCHS = 6
_SPACES = np.isin(np.arange(256), [32, *range(9, 14)])


def hashed_subwords(text: str | None) -> np.ndarray:
    """The hash of every word, pair and run of a text, repeats included."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    if not len(data):
        return np.empty(0, np.int64)
    shift = np.uint64(64 - HASH_BITS)
    edges = np.diff((~_SPACES[data]).astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    words = segment_hashes(data, starts, ends)
    pairs = (words[1:] - words[:-1]) * np.uint64(0xC2B2AE3D27D4EB4F)
    found = [(words >> shift).astype(np.int64), (pairs >> shift).astype(np.int64)]
    wide = data.astype(np.uint32)
    run = wide
    for size in range(2, RUNS[-1] + 1):
        if len(data) < size:
            break
        run = run[:-1] * np.uint32(0x01000193) ^ wide[size - 1 :]
        if size in RUNS:
            spread = (run + np.uint32(size)) * np.uint32(0x9E3779B1)
            found.append((spread >> np.uint32(32 - HASH_BITS)).astype(np.int64))
    return np.concatenate(found)


@dataclass
class SubwordModel:
    """The number that each hash adds to the log-odds of class 1, and the odds of no text."""

    logits: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        found = hashed_subwords(text)
        value = self.bias + (float(self.logits[found].mean()) if len(found) else 0.0)
        return float(1 / (1 + np.exp(-np.clip(value, -60, 60))))


def train(features: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, seed: int = 5) -> SubwordModel:
    """Stochastic gradient descent over documents as (hashes, shares)."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (1 << HASH_BITS, DIMENSIONS)).astype(np.float32)
    layer, bias = rng.normal(0, 0.1, (DIMENSIONS, 2)).astype(np.float32), np.zeros(2, np.float32)
    weight = len(target) / (2 * np.bincount(target, minlength=2).clip(1))
    steps, done = EPOCHS * len(target), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(target)):
            rate = 0.5 * (1 - done / steps)
            done += 1
            index, share = features[i]
            rows = vectors[index]
            mean = share @ rows
            raw = mean @ layer + bias
            chance = np.exp(raw - raw.max())
            chance /= chance.sum()
            chance[target[i]] -= 1
            error = (chance * min(weight[target[i]], 20.0)).astype(np.float32)
            back = layer @ error
            layer -= rate * np.outer(mean, error)
            bias -= rate * 0.1 * error
            # a document's hashes share one gradient; the scale keeps the step of short and long texts alike
            vectors[index] = rows - rate * 20.0 * np.outer(share / max(float(share.max()), 1e-9) * np.float32(0.05), back)
    out = vectors @ (layer[:, 1] - layer[:, 0])
    return SubwordModel(out.astype(np.float32), float(bias[1] - bias[0]))


def fit_quality(docs: DataFrame, labels: DataFrame, learnable: F.Column | None = None, per_class: int = SAMPLE_PER_CLASS, column: str = "quality") -> SubwordModel:
    """Trains on the sample; without labelled documents of both classes every score is a half."""

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            index, share = [], []
            for text in batch.column(0).to_pylist():
                hashes, times = np.unique(hashed_subwords(text), return_counts=True)
                index.append(hashes.astype(np.int32).tobytes())
                share.append((times / max(1, times.sum())).astype(np.float32).tobytes())
            return pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(index, pa.binary()), pa.array(share, pa.binary())], ["label", "hashes", "shares"]
            )

        return step

    sample = labelled_sample(docs, labels, column, per_class, learnable)
    rows = map_batches(sample, make, "label int, hashes binary, shares binary").toArrow()  # bounded by the sample
    target = np.array(rows.column(0).to_pylist(), np.int64)
    if len(np.unique(target)) < 2:
        return SubwordModel(np.zeros(1 << HASH_BITS, np.float32), 0.0)
    features = [
        (np.frombuffer(h.as_buffer(), np.int32), np.frombuffer(s.as_buffer(), np.float32))
        for h, s in zip(rows.column(1), rows.column(2), strict=True)
    ]
    order = np.lexsort(([len(f[0]) for f in features], [f[0][:8].tobytes() for f in features]))
    return train([features[i] for i in order], target[order])


def quality_scores(docs: DataFrame, model: SubwordModel) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; NULL and empty texts have the score of
    a text without words."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # half a megabyte, whatever the data

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        fitted = shared.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            scores = np.array([fitted.score(text) for text in batch.column(2).to_pylist()])
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

        return step

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").select("doc_id", held_out(3, 1).alias("held_out"), "text")
    return map_batches(rows, make, "doc_id bigint, held_out boolean, score double, predicted int")
