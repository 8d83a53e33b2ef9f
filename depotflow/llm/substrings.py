"""Removal of passages that repeat anywhere in a collection, prefiltered by a count-min sketch.

A window is a fixed number of consecutive words. Every window is represented by its anchor:
the run of words with the smallest hash among the runs inside it. Equal windows have equal
anchors at equal offsets, so a window that repeats has an anchor that occurs at two places at
least. Anchors are about a tenth as many as windows.

1. Each task counts its anchors in count-min cells; the sketches of all tasks are merged. A cell
   only tells never, once, or more often, in two bits. A sketch overestimates, never under.
2. A second pass emits the windows whose anchor is estimated to repeat, and groups them exactly
   by 96-bit hashes. Windows of which there are two or more are repeated.
3. Each document's repeated windows come back to it, and the words they cover are removed.

The sketch is sized from the number of words, up to ``MAX_WIDTH_BITS``; beyond that it lets more
unique windows through to the exact pass, which changes the cost but not the result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotflow.llm.common import WordHashes, map_batches, mix, run_hashes, words_of

DEPTH = 3
MIN_WIDTH_BITS, MAX_WIDTH_BITS = 16, 27
#: Cells of one merged block; 2 bits a cell.
BLOCK_BITS = 16


class Windows:
    """The windows of a text: their anchors, and their hashes."""

    def __init__(self, length: int):
        self.length = length
        self.anchor = max(1, (length + 1) // 2)
        self.hashes = WordHashes()

    def anchors(self, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The hash of every window's anchor and where it stands; the leftmost of equal ones."""
        runs = run_hashes(hashed, self.anchor)
        least, where = runs, np.arange(len(runs))
        span, wanted = 1, self.length - self.anchor + 1
        while span < wanted:
            shift = min(span, wanted - span)
            left, right = least[:-shift], least[shift:]
            keep = left <= right
            least = np.where(keep, left, right)
            where = np.where(keep, where[:-shift], where[shift:])
            span += shift
        return least, where


def _cells(keys: np.ndarray, row: int, bits: int) -> np.ndarray:
    salt = np.uint64(0xA24BAED4963EE407 * (2 * row + 1) & (2**64 - 1))
    return mix(keys ^ salt) >> np.uint64(64 - bits)


def _sketch(docs: DataFrame, length: int, bits: int) -> list[np.ndarray]:
    """The merged sketch, one array of bytes with four cells each per row."""
    block = min(bits, BLOCK_BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(length)
        found: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words = words_of(text)
                if len(words) >= length:
                    keys, where = windows.anchors(windows.hashes(words))
                    first = np.concatenate(([True], where[1:] != where[:-1]))
                    found.append(keys[first])
                    size += int(first.sum())
            if size > 2_000_000:
                yield from _packed(np.concatenate(found), bits, block)
                found, size = [], 0
        if found:
            yield from _packed(np.concatenate(found), bits, block)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            for slot, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                entries = np.frombuffer(data.as_buffer(), np.uint32)
                cells = blocks.setdefault(slot, np.zeros(1 << block, np.uint8))
                at = entries >> np.uint32(1)
                cells[at] = np.minimum(cells[at] + 1 + (entries & np.uint32(1)).astype(np.uint8), 2)
        for slot, cells in blocks.items():
            four = cells.reshape(-1, 4)
            packed = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
            yield pa.RecordBatch.from_arrays(
                [pa.array([slot], pa.int64()), pa.array([packed.tobytes()], pa.binary())], ["slot", "data"]
            )

    schema = "slot bigint, data binary"
    merged = docs.select("text").mapInArrow(count, schema).repartition("slot").mapInArrow(merge, schema)
    rows = [np.zeros((1 << bits) // 4, np.uint8) for _ in range(DEPTH)]
    per_row, size = 1 << (bits - block), (1 << block) // 4
    for slot, data in merged.toLocalIterator():  # DEPTH * 2^bits / 4 bytes in all, 100 MB at most
        row, at = divmod(slot, per_row)
        rows[row][at * size : (at + 1) * size] = np.frombuffer(data, np.uint8)
    return rows


def _packed(keys: np.ndarray, bits: int, block: int) -> Iterator[pa.RecordBatch]:
    """Counted cells by block: the cell's place in it, and a bit for more than one."""
    for row in range(DEPTH):
        cells, counts = np.unique(_cells(keys, row, bits), return_counts=True)
        slots = (cells >> np.uint64(block)).astype(np.int64)
        inside = (cells & np.uint64((1 << block) - 1)).astype(np.uint32)
        entries = inside << np.uint32(1) | (counts > 1).astype(np.uint32)
        starts = np.flatnonzero(np.concatenate(([True], slots[1:] != slots[:-1])))
        data = [part.tobytes() for part in np.split(entries, starts[1:])]
        base = row << (bits - block)
        yield pa.RecordBatch.from_arrays(
            [pa.array(slots[starts] + base, pa.int64()), pa.array(data, pa.binary())], ["slot", "data"]
        )


def _maybe_repeated(rows: list[np.ndarray], bits: int, keys: np.ndarray) -> np.ndarray:
    out = np.ones(len(keys), bool)
    for row in range(DEPTH):
        cells = _cells(keys, row, bits)
        out &= (rows[row][cells >> np.uint64(2)] >> ((cells & np.uint64(3)) << np.uint64(1)).astype(np.uint8)) & 3 > 1
    return out


def repeated_windows(docs: DataFrame, length: int, width_bits: int | None = None) -> DataFrame:
    """(key, starts) of rows with repeated windows; ``key`` hashes the id and the text, so rows
    that share an id are told apart, and ``starts`` is a list of packed 32-bit places.

    Windows that occur twice within one batch of rows are known to repeat there and then; of
    each such window one row goes on, however often it occurs, so that a passage that a third
    of all rows share is met as often as there are batches and not as there are rows.
    """
    spark = docs.sparkSession
    named = docs.select(F.col("doc_id").cast("bigint"), "text")
    bits = width_bits
    if bits is None:
        letters = named.agg(F.sum(F.length("text"))).first()[0] or 0
        anchors = letters / 6 * 2 / (length - length // 2 + 1)
        bits = int(np.clip(np.ceil(np.log2(max(1.0, 2 * anchors))), MIN_WIDTH_BITS, MAX_WIDTH_BITS))
    sketch = spark.sparkContext.broadcast(_sketch(named, length, bits))
    schema = "h1 bigint, h2 int, key bigint, starts binary"

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        windows, rows = Windows(length), sketch.value

        def candidates(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
            words = words_of(text)
            if len(words) < length:
                return None
            hashed = windows.hashes(words)
            keys, where = windows.anchors(hashed)
            change = np.concatenate(([True], where[1:] != where[:-1]))
            at = np.flatnonzero(_maybe_repeated(rows, bits, keys[change])[np.cumsum(change) - 1])
            if not len(at):
                return None
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashed)))
            other = (mix(sums[at + length] - sums[at]) >> np.uint64(32)).astype(np.uint32).view(np.int32)
            return at.astype(np.int32), run_hashes(hashed, length)[at].view(np.int64), other

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            keys, found = [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                got = candidates(text)
                if got is not None:
                    keys.append(key)
                    found.append(got)
            if not found:
                return None
            doc = np.repeat(np.arange(len(found)), [len(at) for at, _, _ in found])
            start, h1, h2 = (np.concatenate(part) for part in zip(*found, strict=True))
            order = np.lexsort((h2, h1))
            doc, start, h1, h2 = doc[order], start[order], h1[order], h2[order]
            same = (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1])
            twice = np.concatenate(([False], same)) | np.concatenate((same, [False]))
            first = np.concatenate(([True], ~same))
            single, stands = ~twice, twice & first
            own = np.lexsort((start[twice], doc[twice]))
            own_doc, own_start = doc[twice][own], start[twice][own]
            edge = np.flatnonzero(np.diff(own_doc, prepend=-1))
            own_keys = [keys[d] for d in own_doc[edge].tolist()]
            own_packed = [part.tobytes() for part in np.split(own_start, edge[1:])] if len(edge) else []
            places = start[single].astype("<i4").tobytes()
            packed = [places[i : i + 4] for i in range(0, len(places), 4)]
            named_keys = np.array(keys, np.int64)[doc[single]]
            none = int(stands.sum())
            return pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([pa.array(h1[single]), pa.array(h1[stands]), pa.array(own_keys, pa.int64())]),
                    pa.concat_arrays([pa.array(h2[single]), pa.array(h2[stands]), pa.nulls(len(edge), pa.int32())]),
                    pa.concat_arrays([pa.array(named_keys), pa.nulls(none, pa.int64()), pa.array(own_keys, pa.int64())]),
                    pa.array([*packed, *[None] * none, *own_packed], pa.binary()),
                ],
                ["h1", "h2", "key", "starts"],
            )

        return step

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of windows that another row has as well, and rows that are known to repeat."""
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            yield from _met(rows.slice(0, rows.num_rows - 1), rows)
            # the last row waits for its successor, with its predecessor to compare with
            held = rows.slice(max(0, rows.num_rows - 2))
            if rows.num_rows > 1:
                held = held.set_column(2, "key", pa.chunked_array([pa.array([None, held.column(2)[1].as_py()], pa.int64())]))
        if held is not None:
            yield from _met(held, held)

    found = map_batches(named.select(F.xxhash64("doc_id", "text").alias("key"), "text"), make, schema)
    met = found.repartition("h1", "h2").sortWithinPartitions("h1", "h2").mapInArrow(meet, "key bigint, starts binary")
    return met.groupBy("key").agg(F.collect_list("starts").alias("starts"))


def _met(rows: pa.Table, within: pa.Table) -> Iterator[pa.RecordBatch]:
    """Of the first rows of a sorted table those that repeat; rows without a key only stand for
    a window that others have."""
    count = rows.num_rows
    h1 = within.column(0).to_numpy()
    known = within.column(1).is_null().to_numpy()
    h2 = within.column(1).fill_null(0).to_numpy()
    same = (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1]) & ~known[1:] & ~known[:-1]
    twice = np.concatenate(([False], same)) | np.concatenate((same, [False])) | known
    keep = twice[:count] & rows.column(2).is_valid().to_numpy()
    if keep.any():
        yield from rows.select([2, 3]).filter(pa.array(keep)).combine_chunks().to_batches()


def remove_repeats(docs: DataFrame, length: int, width_bits: int | None = None) -> DataFrame:
    """All columns of the documents with ``text`` replaced by its kept words, plus ``__words__`` and
    ``__removed__``, the numbers of words and of removed words.

    Every word covered by a window of ``length`` words whose word sequence also starts anywhere
    else goes, same document included. Kept words are joined by one space where something was
    removed; a text without repeats stays as it is. A NULL text has no words and stays NULL.
    """
    starts = repeated_windows(docs, length, width_bits).select(
        F.col("key").alias("__key__"), F.col("starts").alias("__starts__")
    )
    key = F.xxhash64(F.col("doc_id").cast("bigint"), "text")
    joined = docs.withColumn("__own__", key).join(starts, F.col("__own__") == F.col("__key__"), "left")
    joined = joined.select(*docs.columns, "__starts__")
    names = joined.columns
    out_names = [n for n in names if n != "__starts__"] + ["__words__", "__removed__"]

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        text_at, starts_at = names.index("text"), names.index("__starts__")

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            total, removed, texts = [], [], []
            for text, starts in zip(batch.column(text_at).to_pylist(), batch.column(starts_at), strict=True):
                words = words_of(text)
                total.append(len(words))
                if starts.as_py() is None:
                    removed.append(0)
                    texts.append(text)
                    continue
                edges = np.zeros(len(words) + 1, np.int64)
                at = np.frombuffer(b"".join(starts.as_py()), "<i4")
                np.add.at(edges, at, 1)
                np.add.at(edges, at + length, -1)
                keep = np.cumsum(edges[:-1]) == 0
                removed.append(int(len(words) - keep.sum()))
                texts.append(b" ".join([w for w, k in zip(words, keep.tolist(), strict=True) if k]).decode("utf-8", "surrogatepass"))
            columns = [batch.column(i) for i in range(len(names)) if i != starts_at]
            columns[text_at - (text_at > starts_at)] = pa.array(texts, pa.string())
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array(total, pa.int64()), pa.array(removed, pa.int64())], out_names
            )

        return step

    fields = [f for f in joined.schema.fields if f.name != "__starts__"]
    schema = type(joined.schema)(fields).add("__words__", "long").add("__removed__", "long")
    return map_batches(joined, make, schema)


def substring_digests(docs: DataFrame, length: int = 35) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document."""
    cleaned = remove_repeats(docs.select(F.col("doc_id").cast("bigint"), "text"), length)
    spaces = r"[\x20\x09-\x0D]+"
    kept = F.regexp_replace(F.regexp_replace(F.coalesce("text", F.lit("")), spaces, " "), "^ | $", "")
    counts = F.col("__words__").alias("n_words"), F.col("__removed__").alias("n_removed")
    return cleaned.select("doc_id", *counts, F.sha2(kept.cast("binary"), 256).alias("kept_sha256"))
