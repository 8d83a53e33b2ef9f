"""Scores of texts under a bigram model with deleted interpolation.

The model mixes maximum-likelihood estimates: of a token after the one before it, of a token
alone, and the uniform one. The weight of the bigram depends on how often its context was seen,
in buckets of powers of two. Weights are learned by expectation-maximisation on held-out counts:
each training document in turn is deleted from the counts and its tokens are predicted from the
rest.

Counts are of the whole corpus and spread over all tasks. Documents are dealt to blocks of a
bounded number of characters. A block sends each distinct word and bigram once, packed, to the
shard that its hash belongs to; the shard adds up the counts of all blocks and answers each
block with the totals of its own entries. So frequent bigrams cost one entry per block.
Words and bigrams are told apart by 64-bit hashes.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotflow.llm.common import lower_words, map_batches, mix, shared_folder

#: Characters of the documents of one block, about.
BLOCK_CHARS = 12_000_000
MOST_BUCKETS, F2_CELLS, C1_CELLS = 18, 64, 160
ROUNDS = 40
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_START, _END = b"\x00<", b"\x00>"  # no words: words come from texts as UTF-8 without white space
_START_ID, _END_ID = 0, 1


class _Block:
    """The tokens of a block's documents as numbers, and its distinct words and bigrams."""

    def __init__(self, texts: list[str | None], train: np.ndarray):
        vocabulary: dict[bytes, int] = {}
        place = vocabulary.setdefault
        parts, lengths = [], []
        for text in texts:
            words = lower_words(text)
            parts.append(np.fromiter((place(w, len(vocabulary) + 2) for w in words), np.int64, len(words)))
            lengths.append(len(words))
        self.lengths = np.array(lengths, np.int64) + 1  # with the end
        size = int(self.lengths.sum()) + len(texts)
        sequence = np.empty(size, np.int64)
        at = 0
        for part in parts:
            sequence[at] = _START_ID
            sequence[at + 1 : at + 1 + len(part)] = part
            at += len(part) + 2
            sequence[at - 1] = _END_ID
        digest = xxhash.xxh64_intdigest
        known = [digest(_START, 1), digest(_END, 1), *(digest(w, 7) for w in vocabulary)]
        self.words = np.array(known, np.uint64)
        self.sequence = sequence
        self.owner = np.repeat(np.arange(len(texts)), self.lengths + 1)
        self.token = sequence != _START_ID
        counted = train[self.owner]
        self.word_counts = np.bincount(sequence[counted], minlength=len(known))
        codes = sequence[:-1] * len(known) + sequence[1:]
        real = self.token[1:]
        distinct, first, inverse = np.unique(codes[real], return_index=True, return_inverse=True)
        self.pair_of = inverse
        self.pair_counts = np.bincount(inverse[counted[1:][real]], minlength=len(distinct))
        left, right = np.divmod(distinct, len(known))
        self.pairs = mix(self.words[left] * _FACTOR + self.words[right])
        self.context = sequence[:-1][real]
        self.word = sequence[1:][real]
        self.doc = self.owner[1:][real]

    def entries(self, shards: int) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """By kind (1 words, 2 bigrams): keys and counts in the order of their shards, that
        order, and the first entry of each shard."""
        out = []
        for kind, keys, counts in ((1, self.words, self.word_counts), (2, self.pairs, self.pair_counts)):
            order = np.argsort(keys)  # the same whatever the order of the documents
            shard = np.minimum((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32), np.uint64(shards - 1)).astype(np.int64)
            out.append((kind, keys[order], counts[order], order, np.searchsorted(shard[order], np.arange(shards + 1))))
        return out


def _read(table: pa.Table) -> tuple[list, list[str | None], np.ndarray]:
    return table.column("doc_id").to_pylist(), table.column("text").to_pylist(), table.column("held_out").to_numpy()


def _counted(dealt: DataFrame, shards: int) -> DataFrame:
    """One row per document with the counts of its tokens, rows of held-out counts, and rows of
    corpus totals; told apart by ``kind``."""

    def request(table: pa.Table) -> pa.Table:
        _, texts, held = _read(table)
        block = table.column("block")[0].as_py()
        rows: list[tuple] = []
        for kind, keys, counts, _, starts in _Block(texts, ~held).entries(shards):
            for shard in range(shards):
                a, b = starts[shard], starts[shard + 1]
                if b > a:
                    rows.append((shard, block, kind, _pack(np.diff(keys[a:b], prepend=np.uint64(0))), _pack(counts[a:b].astype(np.uint32))))
        types = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        names = ["shard", "block", "kind", "keys", "counts"]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    def answer(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        blocks, kinds, totals = [-1 - shard], [0], []
        stats = np.zeros(3, np.int64)
        kind_of = table.column("kind").to_numpy()
        for kind in (1, 2):
            mine = np.flatnonzero(kind_of == kind)
            if not len(mine):
                continue
            rows = table.take(pa.array(mine))
            keys = [np.cumsum(_unpack(x, np.uint64), dtype=np.uint64) for x in rows.column("keys").to_pylist()]
            counts = [_unpack(x, np.uint32) for x in rows.column("counts").to_pylist()]
            distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.bincount(inverse, weights=np.concatenate(counts)).astype(np.int64)
            if kind == 1:
                start = distinct == np.uint64(xxhash.xxh64_intdigest(_START, 1))
                stats = np.array([total[~start].sum(), (total[~start] > 0).sum(), total[start].sum()], np.int64)
            parts = np.split(total[inverse].astype(np.uint32), np.cumsum([len(k) for k in keys])[:-1])
            blocks += rows.column("block").to_pylist()
            kinds += [kind] * len(mine)
            totals += [_pack(p) for p in parts]
        return pa.table(
            [
                pa.array(blocks, pa.int32()),
                pa.array([shard] * len(blocks), pa.int32()),
                pa.array(kinds, pa.int32()),
                pa.array([stats.tobytes(), *totals], pa.binary()),
            ],
            names=["block", "shard", "kind", "totals"],
        )

    def place(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _rows([(0, None, None, None, None, None, None, t) for t in right.column("totals").to_pylist()])
        ids, texts, held = _read(left)
        block = _Block(texts, ~held)
        totals = []
        answers = right.sort_by([("kind", "ascending"), ("shard", "ascending")])
        kinds, packed = answers.column("kind").to_numpy(), answers.column("totals").to_pylist()
        for kind, keys, _, order, _ in block.entries(shards):
            found = np.concatenate([_unpack(packed[i], np.uint32) for i in np.flatnonzero(kinds == kind)] or [np.empty(0, np.uint32)])
            total = np.empty(len(keys), np.int64)
            total[order] = found
            totals.append(total)
        c1, c2, context = totals[0][block.word], totals[1][block.pair_of], totals[0][block.context]
        cuts = np.cumsum(block.lengths)[:-1]
        rows = [
            (1, i, bool(h), len(a), int((a > 0).sum()), float(np.log10(a + 0.1).sum()), _planes(b, c, a), None)
            for i, h, a, b, c in zip(ids, held.tolist(), np.split(c1, cuts), np.split(c2, cuts), np.split(context, cuts), strict=True)
        ]
        return _rows([*rows, (2, None, None, None, None, None, None, _held_out_cells(block, ~held, c1, c2, context).tobytes())])

    asked = dealt.groupBy("block").applyInArrow(request, "shard int, block int, kind int, keys binary, counts binary")
    answers = asked.groupBy("shard").applyInArrow(answer, "block int, shard int, kind int, totals binary")
    schema = "kind int, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, counts binary, extra binary"
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(place, schema)


def _rows(rows: list[tuple]) -> pa.Table:
    types = [pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.binary(), pa.binary()]
    names = ["kind", "doc_id", "held_out", "n_tokens", "n_known", "base", "counts", "extra"]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def _pack(values: np.ndarray) -> bytes:
    """Numbers by byte planes, which compress well: most high bytes are zero."""
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T
    return zlib.compress(planes.tobytes(), 1)


def _unpack(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(zlib.decompress(data), np.uint8).reshape(size, -1).T.copy().view(kind).reshape(-1)


def _planes(c2: np.ndarray, context: np.ndarray, c1: np.ndarray) -> bytes:
    """Counts by byte planes, which compress well. The context of the first token is the start;
    that of any other is the token before."""
    first = np.uint32(context[0])
    return first.tobytes() + np.stack((c1, c2)).astype("<u4").view(np.uint8).reshape(2, -1, 4).transpose(0, 2, 1).tobytes()


def _unplanes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    first = np.frombuffer(data, "<u4", 1)
    c1, c2 = np.frombuffer(data, np.uint8, offset=4).reshape(2, 4, -1).transpose(0, 2, 1).copy().view("<u4").reshape(2, -1)
    return c1, c2, np.concatenate((first, c1[:-1]))


def _bucket(count: np.ndarray) -> np.ndarray:
    """0 for unseen contexts, then by powers of two."""
    return np.minimum(np.frexp(count.astype(np.float64))[1], MOST_BUCKETS - 1)


def _held_out_cells(block: _Block, train: np.ndarray, c1: np.ndarray, c2: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Tokens of training documents by cells of (context bucket, bigram estimate, word count),
    with their own document deleted from all counts; as pairs of cell and number."""
    use = train[block.doc]

    def within(values: np.ndarray) -> np.ndarray:
        _, inverse, times = np.unique(block.doc[use] * (int(values.max(initial=0)) + 1) + values[use], return_inverse=True, return_counts=True)
        return times[inverse]

    own_word, own_pair, own_context = within(block.word), within(block.pair_of), within(block.context)
    rest1, rest2, rest_context = c1[use] - own_word, c2[use] - own_pair, context[use] - own_context
    bigram = np.where(rest2 > 0, 1 + np.minimum(-4 * np.log2(np.maximum(rest2, 1) / np.maximum(rest_context, 1)), F2_CELLS - 2), 0)
    word = np.where(rest1 > 0, 1 + np.minimum(4 * np.log2(np.maximum(rest1, 1)), C1_CELLS - 2), 0)
    cell = (_bucket(np.maximum(rest_context, 0)) * F2_CELLS + bigram.astype(np.int64)) * C1_CELLS + word.astype(np.int64)
    cells, times = np.unique(cell, return_counts=True)
    return np.stack((cells, times)).astype(np.int64)


def _learn(cells: np.ndarray, times: np.ndarray, total: int, distinct: int) -> tuple[np.ndarray, float]:
    """Weights of the bigram by context bucket, and of the word against the uniform estimate."""
    word, bigram, bucket = cells % C1_CELLS, cells // C1_CELLS % F2_CELLS, cells // C1_CELLS // F2_CELLS
    f1 = np.where(word > 0, 2.0 ** ((word - 0.5) / 4) / max(total, 1), 0.0)
    f2 = np.where(bigram > 0, 2.0 ** -((bigram - 0.5) / 4), 0.0)
    uniform, weights, alone = 1 / (distinct + 1), np.full(MOST_BUCKETS, 0.5), 0.9
    weights[0] = 0.0
    held = np.bincount(bucket, weights=times, minlength=MOST_BUCKETS)
    for _ in range(ROUNDS):
        lower = alone * f1 + (1 - alone) * uniform
        mixed = weights[bucket] * f2
        share = mixed / (mixed + (1 - weights[bucket]) * lower)
        by_word = alone * f1 / lower
        got = np.bincount(bucket, weights=times * share, minlength=MOST_BUCKETS)
        weights = np.where(held > 0, got / np.maximum(held, 1), weights)
        rest = times * (1 - share)
        alone = float(np.clip((rest * by_word).sum() / max(rest.sum(), 1e-9), 1e-6, 1 - 1e-6))
    weights = np.minimum(weights, 1 - 1e-6)
    weights[0] = 0.0
    return weights, alone


def language_model_scores(docs: DataFrame, held_out: Column) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    NULL and empty texts have one token, the end. ``held_out`` tells the documents that the
    counts leave out. Where nothing was learned, every token has the same chance.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    letters = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-letters // BLOCK_CHARS))
    dealt = rows.select("doc_id", "text", held_out.alias("held_out"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int").alias("block"))
    path = f"{shared_folder(spark)}/llm/token-counts-{uuid.uuid4().hex[:12]}"
    counted = _counted(dealt, int(blocks))
    counted.write.option("compression", "zstd").parquet(path)
    written = spark.read.schema(counted.schema).parquet(path)
    stats = written.filter("kind = 0").select("extra")
    whole = np.zeros(3, np.int64)
    for row in stats.toLocalIterator():  # three numbers per shard
        whole += np.frombuffer(row[0], np.int64)
    total, distinct, _ = (int(x) for x in whole)

    def unpack(batch: pa.RecordBatch) -> pa.RecordBatch:
        both = [np.frombuffer(x, np.int64).reshape(2, -1) for x in batch.column(0).to_pylist()]
        cells, times = np.concatenate(both, axis=1)
        return pa.RecordBatch.from_arrays([pa.array(cells), pa.array(times)], ["cell", "times"])

    held = map_batches(written.filter("kind = 2").select("extra"), lambda: unpack, "cell bigint, times bigint")
    table = held.groupBy("cell").agg(F.sum("times").alias("times")).toArrow()  # bounded by the number of cells
    cells = table.column(0).to_numpy().astype(np.int64)
    weights, alone = _learn(cells, table.column(1).to_numpy().astype(np.float64), total, distinct)

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        uniform, floor = 1 / (distinct + 1), np.log10(total + 0.1 * (distinct + 1))

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            scores = []
            for data in batch.column(5).to_pylist():
                c1, c2, context = _unplanes(data)
                weight = weights[_bucket(context)]
                lower = alone * c1 / max(total, 1) + (1 - alone) * uniform
                scores.append(float(np.log10(weight * c2 / np.maximum(context, 1) + (1 - weight) * lower).sum()))
            base = batch.column(4).to_numpy() - batch.column(2).to_numpy() * floor
            return pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(np.full(batch.num_rows, total, np.int64)), pa.array(base), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

        return step

    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    known = written.filter("kind = 1").select("doc_id", "held_out", "n_tokens", "n_known", "base", "counts")
    return map_batches(known, make, schema)
