"""Benchmark passages in documents, found by latent semantic retrieval.

Documents are cut into overlapping passages, for each power of two of the lengths of items anew,
so that every item of the benchmark lies wholly within a passage of at most about five times its
own length (or of 32 words), whatever the lengths of other items. Passages and items are TF-IDF vectors over the words of the items,
with document frequencies over all documents. A randomised SVD, fitted on how many passages of all
documents hold each two terms, and on the items themselves, gives a latent space. Every passage of
every document is projected and compared with every item by cosine; pairs above a low bound are
candidates. A candidate is a leak if a longest common subsequence of words covers most of the
item (so that inserted, dropped and replaced words do not hide it) and most of the item's
rarest words, its answer, are there as well.

The items are the stated query set: they come in blocks of bounded size, and each block meets
all documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotflow.llm.common import map_batches, merge_counters
from depotflow.llm.textarrays import slices

#: Items of one block; dimensions of the latent space.
BLOCK_ITEMS, DIMENSIONS, OVERSAMPLE = 256, 288, 16
#: Pairs of terms that a task holds at once, and rows of the probe it multiplies at once.
HELD_PAIRS, PROBE_ROWS = 4_000_000, 16_384
LEAST_COSINE, LEAST_SEQUENCE, LEAST_ANSWER = 0.2, 0.65, 0.6
#: Words from the start of a passage to the next, at least, and as a multiple of the longest item.
LEAST_STRIDE, SLACK = 16, 1.25
#: Words in more than this share of documents do not count as terms, unless an item has few others.
COMMON_SHARE, FEW_TERMS = 0.05, 4
#: ASCII signs part words, as white space does.
_SPACED = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Lower-cased words without signs."""
    return [] if text is None else text.lower().encode("utf-8", "surrogatepass").translate(_SPACED).split()


def _numbers(text: str | None, terms: dict[bytes, int]) -> np.ndarray:
    """The words of a text as numbers of terms; -1 for other words."""
    words = terms_of(text)
    return np.fromiter(map(terms.get, words, repeat(-1)), np.int64, len(words))


@dataclass
class Items:
    """A block of benchmark items and their terms."""

    ids: list[int]
    words: list[list[bytes]]
    terms: dict[bytes, int]

    @classmethod
    def of(cls, rows: list[tuple[int, list[bytes]]]) -> Items:
        terms: dict[bytes, int] = {}
        for _, words in rows:
            for word in words:
                terms.setdefault(word, len(terms))
        return cls([i for i, _ in rows], [w for _, w in rows], terms)

    @cached_property
    def classes(self) -> list[tuple[int, np.ndarray]]:
        """(stride, members) by powers of two of the length: passages start a stride apart and are
        two strides long, and a stride is a quarter longer than the longest item of its class."""
        sizes = np.array([len(w) for w in self.words])
        octave = np.array([max(int(n), LEAST_STRIDE // 2).bit_length() for n in sizes])
        groups = [np.flatnonzero(octave == o) for o in np.unique(octave)]
        return [(max(LEAST_STRIDE, int(np.ceil(SLACK * sizes[own].max()))), own) for own in groups]


@dataclass
class LatentIndex:
    """Everything a task needs to search a block of items."""

    items: Items
    projection: np.ndarray  # of a term to the latent space, with its weight; zero if too common
    vectors: np.ndarray  # of the items, of length one
    answers: list[frozenset[int]]


def _document_counts(docs: DataFrame, items: Items) -> tuple[np.ndarray, int]:
    """For every term the number of documents that have it, and the number of documents."""
    width = len(items.terms) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(width, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = np.zeros(width, bool)
                found[_numbers(text, items.terms)] = True  # -1 is the last place
                found[-1] = True
                totals += found
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([totals.tobytes()], pa.binary())], ["slot", "data"])

    parts = docs.select("text").mapInArrow(run, "slot bigint, data binary")
    totals = np.zeros(width, np.int64)
    for _, data in merge_counters(parts, width).collect():  # one row
        totals += np.frombuffer(data, np.int64)
    return totals[:-1], int(totals[-1])


def _passages_of(found: list[np.ndarray], weighted: np.ndarray, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """Each term that weighs something, of each passage of several texts once: (passage, term), sorted.

    Passages start a stride apart and are numbered through, every text with one of its own."""
    sizes = np.array([len(number) for number in found])
    base = np.cumsum(sizes // stride + 1) - (sizes // stride + 1)
    flat = np.concatenate(found)
    at = np.flatnonzero(weighted[flat])
    text = np.repeat(np.arange(len(found)), sizes)[at]
    place, term = (at - (np.cumsum(sizes) - sizes)[text]) // stride, flat[at]
    home, inner = place + base[text], place > 0
    codes = np.unique(np.concatenate((home, home[inner] - 1)) << 32 | np.concatenate((term, term[inner])))
    return codes >> 32, codes & (2**32 - 1)


def _grouped_sums(rows: np.ndarray, picked: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The sums of ``rows[picked]`` from each start to the next, by adding the first of each group, then
    the second, and so on."""
    counts = np.diff(np.append(starts, len(picked)))
    order = np.argsort(-counts, kind="stable")
    begin, left = starts[order], counts[order]
    sums = rows[picked[begin]]
    for k in range(1, int(left[0])):
        more = int(np.searchsorted(-left, -k, side="left"))  # groups of more than k
        sums[:more] += rows[picked[begin[:more] + k]]
    out = np.empty_like(sums)
    out[order] = sums
    return out


def _pairs(passage: np.ndarray, term: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Every two terms of a passage, and each with itself, as lesser * width + greater, from sorted
    (passage, term); some passages at a time."""
    if not len(passage):
        return
    starts = np.flatnonzero(np.diff(passage, prepend=-1))
    sizes = np.diff(np.append(starts, len(passage)))
    ends = np.append(starts, len(passage))
    part = np.cumsum(sizes * (sizes + 1) // 2) // HELD_PAIRS
    cuts = ends[np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(starts)]))]
    partners = np.repeat(ends[1:], sizes) - np.arange(len(term))  # from a term to the last of its passage
    for first, last in zip(cuts[:-1], cuts[1:], strict=True):
        many = partners[first:last]
        own = np.repeat(np.arange(first, last), many)
        ahead = np.arange(len(own)) - np.repeat(np.cumsum(many) - many, many)
        yield term[own] * width + term[own + ahead]


def _pair_counts(docs: DataFrame, items: Items, weighted: np.ndarray) -> DataFrame:
    """(pair, passages): how many passages of all documents hold each two weighted terms."""
    width = len(items.terms)

    def counted(held: list[np.ndarray]) -> pa.RecordBatch:
        codes, counts = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(codes, pa.int64()), pa.array(counts, pa.int64())], ["pair", "passages"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for part in slices([len(t or "") for t in texts], 2_000_000):
                found = [_numbers(texts[i], items.terms) for i in part]
                for stride, _ in items.classes:
                    for codes in _pairs(*_passages_of(found, weighted, stride), width):
                        held.append(codes)
                        size += len(codes)
                        if size >= HELD_PAIRS:
                            yield counted(held)
                            held, size = [], 0
        if held:
            yield counted(held)

    parts = docs.select("text").mapInArrow(run, "pair bigint, passages bigint")
    return parts.groupBy("pair").agg(F.sum("passages").alias("passages"))


def _add_pairs(total: np.ndarray, codes: np.ndarray, counts: np.ndarray, weights: np.ndarray, probe: np.ndarray) -> None:
    """Adds A'(A probe) for passages given as counts of pairs of terms."""
    low, high = np.divmod(codes, len(weights))
    value = counts * weights[low] * weights[high]
    apart = low != high
    low, high, value = np.append(low, high[apart]), np.append(high, low[apart]), np.append(value, value[apart])
    order = np.argsort(low, kind="stable")
    for first in range(0, len(order), PROBE_ROWS):
        own = order[first : first + PROBE_ROWS]
        starts = np.flatnonzero(np.diff(low[own], prepend=-1))
        total[low[own][starts]] += np.add.reduceat(value[own, None] * probe[high[own]], starts, axis=0)


def _fit_space(docs: DataFrame, items: Items, weights: np.ndarray, dimensions: int) -> np.ndarray:
    """Right singular vectors of the TF-IDF matrix of the passages of all documents and all items, one
    per column, by a randomised sketch: A'AX for a fixed random X.

    A'A are the counts of pairs of terms by their weights, so what follows the counting is bounded by the items.
    """
    width = min(len(weights), dimensions + OVERSAMPLE)
    probe = np.random.default_rng(11).standard_normal((len(weights), width)).astype(np.float32)
    weighted = np.append(weights > 0, False)  # -1, no term, is the last place

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(weights), width))
        for batch in batches:
            _add_pairs(total, batch.column(0).to_numpy(), batch.column(1).to_numpy(), weights, probe)
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["slot", "data"])

    pairs = _pair_counts(docs, items, weighted).coalesce(8)
    parts = pairs.mapInArrow(run, "slot bigint, data binary")
    sketch = np.zeros((len(weights), width))
    for _, data in merge_counters(parts, 1, "float64").collect():  # one row, terms x dimensions
        sketch += np.frombuffer(data, np.float64).reshape(sketch.shape)
    passage = np.repeat(np.arange(len(items.ids)), [len(set(w)) for w in items.words])
    term = np.concatenate([np.unique([items.terms[w] for w in words]) for words in items.words])
    own = np.zeros(sketch.shape)
    _add_outer(own, passage, term, weights, probe)
    scale = max(1.0, np.abs(sketch).sum() / max(np.abs(own).sum(), 1e-9))
    sketch += scale * own
    core = probe.T @ sketch
    core = (core + core.T) / 2
    values, vectors = np.linalg.eigh(core)
    keep = values > 1e-7 * max(values.max(), 1e-12)
    half = sketch @ (vectors[:, keep] / np.sqrt(values[keep]))
    left, _, _ = np.linalg.svd(half, full_matrices=False)
    return left[:, :dimensions].astype(np.float32)


def _add_outer(total: np.ndarray, passage: np.ndarray, term: np.ndarray, weights: np.ndarray, probe: np.ndarray) -> None:
    """Adds A'(A probe) for the sparse rows given as sorted (passage, term), some passages at a time
    and over the terms that occur in them."""
    row = np.cumsum(np.diff(passage, prepend=passage[0]) > 0)
    for first in range(0, int(row[-1]) + 1, 64):
        own = slice(*np.searchsorted(row, (first, first + 64)))
        known, column = np.unique(term[own], return_inverse=True)
        dense = np.zeros((64, len(known)))
        dense[row[own] - first, column] = weights[term[own]]
        total[known] += dense.T @ (dense @ probe[known])


def build_index(docs: DataFrame, items: Items) -> LatentIndex:
    counts, documents = _document_counts(docs, items)
    weights = np.log((documents + 1) / (counts + 1)) + 0.05
    rare = counts <= COMMON_SHARE * max(documents, 1)
    numbered = [np.unique([items.terms[w] for w in words]) for words in items.words]
    for own in numbered:
        if rare[own].sum() < FEW_TERMS:
            rare[own] = True
    used = np.where(rare, weights, 0.0)
    space = _fit_space(docs, items, used, min(DIMENSIONS, len(used)))
    projection = (used[:, None] * space).astype(np.float32)
    vectors = np.stack([projection[own].sum(axis=0) for own in numbered])
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    answers = [frozenset(own[weights[own] >= np.median(weights[own])].tolist()) for own in numbered]
    return LatentIndex(items, projection, vectors, answers)


def common_subsequence(item: list[int], passage: list[int]) -> int:
    """The length of the longest common subsequence, by bits of one large number."""
    places: dict[int, int] = {}
    for at, word in enumerate(item):
        places[word] = places.get(word, 0) | 1 << at
    full = (1 << len(item)) - 1
    row = full
    for word in passage:
        match = places.get(word)
        if match:
            hit = row & match
            row = (row + hit | row - hit) & full
    return len(item) - row.bit_count()


class _Search:
    def __init__(self, index: LatentIndex):
        self.index = index
        self.items = [[index.items.terms[w] for w in words] for words in index.items.words]
        self.rare = np.append(index.projection.any(axis=1), False)  # -1, no term, is the last place
        self.least = [max(1, int(np.ceil(LEAST_ANSWER * len(a)))) for a in index.answers]

    def leaks(self, texts: list[str | None]) -> dict[tuple[int, int], tuple[float, float]]:
        """(text, item) to (share of the item in sequence, cosine) of the texts."""
        found = [_numbers(t, self.index.items.terms) for t in texts]
        out: dict[tuple[int, int], tuple[float, float]] = {}
        for stride, members in self.index.items.classes:
            self._class_leaks(found, stride, members, out)
        return out

    def _class_leaks(self, found: list[np.ndarray], stride: int, members: np.ndarray, out: dict) -> None:
        """Adds the leaks of the items of one length class."""
        item_vectors = self.index.vectors[members].T
        sizes = np.array([len(number) // stride + 1 for number in found])
        base = np.concatenate(([0], np.cumsum(sizes)))
        # every text starts at a passage of its own, so one flat sequence holds them all
        flat = np.full(int(base[-1]) * stride, -1, np.int64)
        for number, at in zip(found, (base[:-1] * stride).tolist(), strict=True):
            flat[at : at + len(number)] = number
        at = np.flatnonzero(self.rare[flat])
        home, first = at // stride, np.zeros(int(base[-1]), bool)
        first[base[:-1]] = True
        before = ~first[home]
        codes = np.unique(np.concatenate((home, home[before] - 1)) << 32 | np.concatenate((flat[at], flat[at][before])))
        passage, term = codes >> 32, codes & (2**32 - 1)
        enough = np.bincount(passage, minlength=1)[passage] >= min(3, *(self.least[i] for i in members))
        passage, term = passage[enough], term[enough]
        if not len(passage):
            return
        starts = np.flatnonzero(np.diff(passage, prepend=-1))
        for a in range(0, len(starts), 4096):
            part = starts[a : a + 4096]
            last = starts[a + 4096] if a + 4096 < len(starts) else len(passage)
            vectors = _grouped_sums(self.index.projection, term[part[0] : last], part - part[0])
            vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
            cosines = vectors @ item_vectors
            for row, column in zip(*np.nonzero(cosines >= LEAST_COSINE), strict=True):
                self._verify(int(passage[part[row]]), int(members[column]), stride, float(cosines[row, column]), base, found, out)

    def _verify(
        self, passage: int, item: int, stride: int, cosine: float, base: np.ndarray, found: list[np.ndarray], out: dict
    ) -> None:
        text = int(np.searchsorted(base, passage, side="right")) - 1
        start = (passage - int(base[text])) * stride
        words = found[text][start : start + 2 * stride].tolist()
        answer = self.index.answers[item]
        if len(answer.intersection(words)) < LEAST_ANSWER * len(answer):
            return
        wanted = self.items[item]
        share = common_subsequence(wanted, words) / len(wanted)
        if share >= (LEAST_SEQUENCE if len(wanted) >= 5 else 1.0):
            before = out.get((text, item), (0.0, 0.0))
            out[text, item] = max(before, (share, cosine))


def _blocks(benchmark: DataFrame) -> Iterator[Items]:
    """Items with words, in blocks; a NULL id or a text without words is no item."""
    rows: list[tuple[int, list[bytes]]] = []
    for item_id, text in benchmark.select("item_id", "text").filter("item_id IS NOT NULL").toLocalIterator():
        words = terms_of(text)
        if words:
            rows.append((item_id, words))
        if len(rows) == BLOCK_ITEMS:
            yield Items.of(rows)
            rows = []
    if rows:
        yield Items.of(rows)


def benchmark_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, sequence_share, cosine) of every document and item that it contains.

    Whole texts are searched. NULL and empty texts have no leaks, and without items there are
    none. Repeated rows are found as often as they are there.
    """
    spark = docs.sparkSession
    schema = "doc_id bigint, item_id bigint, sequence_share double, cosine double"
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    result = None
    for items in _blocks(benchmark):
        shared = spark.sparkContext.broadcast(build_index(rows, items))  # bounded by the block of items

        def make(shared=shared) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
            search = _Search(shared.value)

            def step(batch: pa.RecordBatch) -> pa.RecordBatch:
                ids, texts, out = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
                for part in slices([len(t or "") for t in texts], 2_000_000):
                    for (text, item), (share, cosine) in search.leaks([texts[i] for i in part]).items():
                        out.append((ids[part[text]], search.index.items.ids[item], share, cosine))
                types = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
                columns = list(zip(*out, strict=True)) or [[]] * 4
                names = ["doc_id", "item_id", "sequence_share", "cosine"]
                return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

            return step

        found = map_batches(rows, make, schema)
        result = found if result is None else result.unionByName(found)
    return spark.createDataFrame([], schema) if result is None else result


def drop_leaking(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any leak, with their columns as they are; rows with a NULL id stay."""
    leaking = benchmark_leaks(docs, benchmark).select("doc_id").distinct()
    return docs.join(leaking, "doc_id", "left_anti").select(*[docs[c] for c in docs.columns])
