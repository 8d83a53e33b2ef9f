"""Texts as flat arrays, so that a batch of texts is worked on by a few array operations."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PRIME = 0x100000001B3


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)], bool)


def code_points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of all texts, each text followed by a line end, and where each
    text starts (with the total length at the end)."""
    lowered = [(text or "").lower() for text in texts]
    flat = np.frombuffer("".join(t + "\n" for t in lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    return flat, np.concatenate(([0], np.cumsum([len(t) + 1 for t in lowered]))).astype(np.int64)


def letter_runs(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of letters."""
    edges = np.diff(letter_table()[flat].astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def slices(sizes: list[int], most: int) -> Iterator[list[int]]:
    """Indices of texts, shortest first, in groups of at most ``most`` in total (or one text)."""
    group: list[int] = []
    total = 0
    for i in sorted(range(len(sizes)), key=sizes.__getitem__):
        if group and total + sizes[i] > most:
            yield group
            group, total = [], 0
        group.append(i)
        total += sizes[i]
    if group:
        yield group


def segment_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every segment of a sequence of small numbers."""
    powers, inverse = _powers(len(values) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers[: len(values)])))
    return (sums[ends] - sums[starts]) * inverse[starts] * np.uint64(0x9E3779B97F4A7C15)


_held: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    if len(_held[0]) < count:
        size = 1 << int(count).bit_length()
        for k, base in enumerate((_PRIME, pow(_PRIME, -1, 2**64))):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            _held[k] = np.cumprod(out)
    return _held[0][:count], _held[1][:count]


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, per_class: int, learnable: F.Column | None = None) -> DataFrame:
    """(text, label) of at most ``per_class`` labelled documents of each class, 0 and 1.

    The documents are those with the smallest hashes of their id, so the sample does not depend
    on how the data are laid out. Labels that are NULL or of no document do not count; a document
    labelled more than once has its largest label, and of rows that share an id the greatest text counts, so
    the sample is bounded however often a row is repeated. Rows come in the order of the hashes. The label side is bounded by the parameter, hence safe to broadcast.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(column).cast("int").alias("label")).filter(
        "doc_id IS NOT NULL AND label IN (0, 1)"
    )
    if learnable is not None:
        known = known.filter(learnable)
    chosen = None
    order = F.xxhash64("doc_id")
    for value in (0, 1):
        part = known.groupBy("doc_id").agg(F.max("label").alias("label")).filter(F.col("label") == value)
        part = part.orderBy(order, "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").filter("text IS NOT NULL")
    one = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.max("text").alias("text"), F.max("label").alias("label"))
    return one.orderBy(order, "doc_id").select("text", "label")
