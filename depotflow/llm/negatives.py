"""Hard negatives: rows of another label that score almost as well as an anchor's nearest rows.

Every row keeps the angles between its vector and a few reference directions. Angles obey the
triangle inequality, so for an anchor a and a row x the angle between them is at least
|angle(a, r) - angle(x, r)| and at most angle(a, r) + angle(x, r), and at most what is left of a full
turn, for each reference r. The cosines of these ends, times both norms and widened by more than
any rounding, bound the score. Only rows whose bounds overlap a window that is asked for are
scored, in whole numbers; the result is the same as of scoring all pairs.

Rows lie in blocks, sorted by their nearest reference and the angle to it. The anchors of a block
are a batch; batches visit the blocks in turn (the anchors are a stated set of queries), a task
holds the blocks of its group and one batch, and what a batch found in the blocks is merged in one
stream per batch.

Handling of odd input: rows with a NULL label, a NULL vector or a component that is NULL or not
finite take no part, nor do vectors of a norm of 2^31 or more after scaling, whose scores would
not fit in 63 bits. Vectors of different lengths score as if the shorter ended in zeros. A repeated
row is a row like any other: it can be the positive of its twin, and an anchor of its own. Ties go
by the smaller id; a NULL id comes last and is never an anchor. Other columns are ignored. Empty
input gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotflow.llm.common import stash

#: Components are counted in steps of 1/256.
SCALE = 256
#: Rows of a bounded sample that reference directions are chosen from, and how many of these.
SAMPLE_ROWS = 2_000
REFERENCES = 8
#: Rows of a block at most, and bytes of its vectors.
BLOCK_ROWS, BLOCK_BYTES = 8_192, 16_000_000
#: Norms stay below this, so that every score fits in 63 bits.
MOST_NORM = float(1 << 31)
#: What angles, and scores relative to the product of norms, may be off by; far above rounding.
ANGLE_SLACK, SCORE_SLACK = 1e-6, 1e-9
_EXACT = float(1 << 53)
_NO_ID = np.iinfo(np.int64).max

_ROW_SQL = "vec_id bigint, label bigint, width int, vector binary, norm double, cell int, near double, angles binary"
_ROW_SCHEMA = pa.schema(
    [("vec_id", pa.int64()), ("label", pa.int64()), ("width", pa.int32()), ("vector", pa.binary()), ("norm", pa.float64()),
     ("cell", pa.int32()), ("near", pa.float64()), ("angles", pa.binary())]
)
_PACK_FIELDS = ("ids", "labels", "vectors", "norms", "angles", "windows", "found")
_PACK_SQL = "block bigint, batch bigint, kind int, width int, " + ", ".join(f"{name} binary" for name in _PACK_FIELDS)
_PACK_SCHEMA = pa.schema(
    [("block", pa.int64()), ("batch", pa.int64()), ("kind", pa.int32()), ("width", pa.int32())]
    + [(name, pa.binary()) for name in _PACK_FIELDS]
)
_FOUND_SQL = "batch bigint, found binary"
_FOUND = np.dtype([("anchor", "<i4"), ("window", "<i4"), ("score", "<i8"), ("id", "<i8")])
_OWN, _BATCH, _BLOCK = 0, 1, 2


def participants(embeddings: DataFrame, label: Column | None = None) -> DataFrame:
    """(vec_id, label, embedding) of the rows that take part."""
    value = F.col("label") if label is None else label
    sound = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        embeddings.select(
            F.col("vec_id").cast("bigint").alias("vec_id"),
            value.cast("bigint").alias("label"),
            F.col("embedding").cast("array<double>").alias("embedding"),
        )
        .filter("label IS NOT NULL AND embedding IS NOT NULL")
        .filter(sound)
    )


# --- the index -----------------------------------------------------------------------------------


def _scaled(vectors: list[list[float]], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, vector in enumerate(vectors):
        out[i, : len(vector)] = vector
    return np.floor(out * SCALE)


def _angles(units: np.ndarray, references: np.ndarray) -> np.ndarray:
    width = min(units.shape[1], references.shape[1])
    return np.arccos(np.clip(units[:, :width] @ references[:, :width].T, -1.0, 1.0))


def _units(vectors: np.ndarray, norms: np.ndarray) -> np.ndarray:
    return vectors / np.where(norms > 0, norms, 1.0)[:, None]


def fit_references(rows: DataFrame, references: int = REFERENCES, sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Directions far from each other, among a bounded sample of the rows with the smallest hashes."""
    sample = rows.filter("size(embedding) > 0").orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows)
    vectors = [row[0] for row in sample.select("embedding").collect()]
    if not vectors:
        return np.zeros((0, 1))
    scaled = _scaled(vectors, max(map(len, vectors)))
    norms = np.sqrt((scaled * scaled).sum(1))
    units = _units(scaled, norms)[(norms > 0) & np.isfinite(norms)]
    chosen: list[int] = []
    nearest = np.full(len(units), np.inf)
    while len(chosen) < min(references, len(units)):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _angles(units, units[chosen[-1:]])[:, 0])
    return units[chosen]


def indexed_rows(rows: DataFrame, references: np.ndarray) -> DataFrame:
    """Every row with its scaled vector, norm, angles and the reference it is nearest to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(2).to_pylist()
            by_width: dict[int, list[int]] = {}
            for i, vector in enumerate(vectors):
                by_width.setdefault(len(vector), []).append(i)
            for width, places in by_width.items():
                scaled = _scaled([vectors[i] for i in places], max(width, 1))
                with np.errstate(over="ignore"):
                    norms = np.sqrt((scaled * scaled).sum(1))
                fits = norms < MOST_NORM
                scaled, norms = scaled[fits], norms[fits]
                places = [i for i, fit in zip(places, fits) if fit]
                if not places:
                    continue
                angles = _angles(_units(scaled, norms), references)
                if not len(references):
                    angles = np.zeros((len(places), 1))
                cells = angles.argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(places)),
                        batch.column(1).take(pa.array(places)),
                        pa.array(np.full(len(places), max(width, 1), np.int32)),
                        pa.array([v.tobytes() for v in scaled.astype("<i4")], pa.binary()),
                        pa.array(norms),
                        pa.array(cells.astype(np.int32)),
                        pa.array(angles[np.arange(len(places)), cells]),
                        pa.array([a.tobytes() for a in angles], pa.binary()),
                    ],
                    schema=_ROW_SCHEMA,
                )

    return rows.select("vec_id", "label", "embedding").mapInArrow(run, _ROW_SQL)


@dataclass
class _Pack:
    """A block of rows, or a batch of anchors, as arrays."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    norms: np.ndarray
    angles: np.ndarray

    @classmethod
    def of(cls, row: dict) -> _Pack:
        ids = np.frombuffer(row["ids"], "<i8")
        return cls(
            ids,
            np.frombuffer(row["labels"], "<i8"),
            np.frombuffer(row["vectors"], "<i4").reshape(len(ids), row["width"]).astype(np.float64),
            np.frombuffer(row["norms"], "<f8"),
            np.frombuffer(row["angles"], "<f8").reshape(len(ids), -1),
        )

    def fields(self, rows: np.ndarray | slice) -> dict:
        return {
            "width": self.vectors.shape[1],
            "ids": self.ids[rows].tobytes(),
            "labels": self.labels[rows].tobytes(),
            "vectors": self.vectors[rows].astype("<i4").tobytes(),
            "norms": self.norms[rows].tobytes(),
            "angles": self.angles[rows].tobytes(),
        }

    def bounds(self, anchor: _Pack, i: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and most that the given rows may score with an anchor."""
        mine, other = anchor.angles[i], self.angles[rows]
        least = np.abs(other - mine).max(1) - ANGLE_SLACK
        sums = other + mine
        most = np.minimum(sums, 2 * np.pi - sums).min(1) + ANGLE_SLACK
        scale = anchor.norms[i] * self.norms[rows]
        slack = scale * SCORE_SLACK + 1e-3
        high = scale * np.cos(np.clip(least, 0.0, np.pi)) + slack
        low = scale * np.cos(np.clip(most, 0.0, np.pi)) - slack
        return low, high

    def scores(self, anchor: _Pack, i: int, rows: np.ndarray) -> np.ndarray:
        """Exact scores: sums of products stay within what a double holds in whole numbers."""
        width = min(self.vectors.shape[1], anchor.vectors.shape[1])
        left, right = self.vectors[rows, :width], anchor.vectors[i, :width]
        if anchor.norms[i] * (self.norms[rows].max() if len(rows) else 0.0) >= _EXACT:
            return left.astype(np.int64) @ right.astype(np.int64)
        return (left @ right).astype(np.int64)


def _first(scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the best: higher scores first, then smaller ids."""
    return np.lexsort((ids, -scores))[:most]


def _positives(block: _Pack, anchors: _Pack, most: int, floors: np.ndarray, own: np.ndarray | None = None) -> np.ndarray:
    """The best rows of an anchor's label in a block; ``own`` are the places of the anchors themselves."""
    out = []
    for i in range(len(anchors.ids)):
        rows = np.flatnonzero(block.labels == anchors.labels[i])
        if own is not None:
            rows = rows[rows != own[i]]
        if not len(rows):
            continue
        low, high = block.bounds(anchors, i, rows)
        floor = floors[i]
        if len(rows) > most:
            floor = max(floor, np.partition(low, -most)[-most])
        rows = rows[high >= floor]
        scores = block.scores(anchors, i, rows)
        best = _first(scores, block.ids[rows], most)
        out.append(_entries(i, 0, scores[best], block.ids[rows[best]]))
    return np.concatenate(out) if out else np.empty(0, _FOUND)


def _entries(anchor: int, window: int, scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
    out = np.empty(len(scores), _FOUND)
    out["anchor"], out["window"], out["score"], out["id"] = anchor, window, scores, ids
    return out


def _negatives(block: _Pack, anchors: _Pack, windows: np.ndarray, most: int, share: tuple[int, int]) -> np.ndarray:
    """The best rows of other labels within each window below a positive's score."""
    low_part, whole = share
    out = []
    by_anchor = {i: windows[windows["anchor"] == i] for i in np.unique(windows["anchor"])}
    for i, wanted in by_anchor.items():
        rows = np.flatnonzero(block.labels != anchors.labels[i])
        if not len(rows):
            continue
        low, high = block.bounds(anchors, i, rows)
        overlapping = []
        for window in wanted:
            top = int(window["score"])
            bottom = -(-low_part * top // whole)
            mask = (high >= bottom) & (low <= top)
            inside = low[(low >= bottom) & (high <= top)]
            if len(inside) > most:
                mask &= high >= np.partition(inside, -most)[-most]
            overlapping.append((window, bottom, top, mask))
        scored = np.flatnonzero(np.logical_or.reduce([mask for *_, mask in overlapping]))
        scores, ids = block.scores(anchors, i, rows[scored]), block.ids[rows[scored]]
        for window, bottom, top, _ in overlapping:
            within = np.flatnonzero((scores >= bottom) & (scores <= top))
            best = within[_first(scores[within], ids[within], most)]
            out.append(_entries(i, int(window["window"]), scores[best], ids[best]))
    return np.concatenate(out) if out else np.empty(0, _FOUND)


def _pack_rows(rows: list[tuple]) -> _Pack:
    width = max(row[2] for row in rows)
    vectors = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        vectors[i, : row[2]] = np.frombuffer(row[3], "<i4")
    return _Pack(
        np.array([_NO_ID if row[0] is None else row[0] for row in rows], np.int64),
        np.array([row[1] for row in rows], np.int64),
        vectors,
        np.array([row[4] for row in rows]),
        np.array([np.frombuffer(row[5], "<f8") for row in rows]),
    )


def _block_batches(anchor_step: int, positives: int, block_rows: int):
    """Packs sorted rows into blocks, and the anchors of each with what they find in their own."""

    def packed(block: int, rows: list[tuple]) -> pa.RecordBatch:
        pack = _pack_rows(rows)
        out = [{"block": block, "batch": block, "kind": _BLOCK, **pack.fields(slice(None))}]
        places = np.flatnonzero((pack.ids % anchor_step == 0) & (pack.ids != _NO_ID))
        if len(places):
            anchors = _Pack(*(getattr(pack, name)[places] for name in ("ids", "labels", "vectors", "norms", "angles")))
            found = _positives(pack, anchors, positives, np.full(len(places), -np.inf), places)
            out.append({"block": block, "batch": block, "kind": _BATCH, **pack.fields(places), "found": found.tobytes()})
        return pa.RecordBatch.from_pylist(out, _PACK_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if held and (len(held) == block_rows or (len(held) + 1) * max(size, row[2]) * 4 > BLOCK_BYTES):
                    yield packed(block, held)
                    held, size, block = [], 0, block + 1
                held.append(row)
                size = max(size, row[2])
        if held:
            yield packed(block, held)

    return run


# --- visits of batches to blocks ---------------------------------------------------------------------


def _visits(blocks: DataFrame, batches: DataFrame, groups: int, visit, result_sql: str = _FOUND_SQL) -> DataFrame:
    """``visit(block row, block, batch row, anchors)`` for every block and every batch.

    Blocks are dealt into groups by hash, about one each, and every batch is sent to every group: that is
    all anchors once per block of rows, and no row of the table is sent more than once.
    """
    own = blocks.withColumn("dealt", F.pmod(F.xxhash64("block"), F.lit(groups)))
    sent = batches.withColumn("dealt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint"))))
    order = F.when(F.col("kind") == _BLOCK, 0).otherwise(1)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []
        for batch in stream:
            for row in batch.to_pylist():
                if row["dealt"] != group:
                    group, held = row["dealt"], []
                if row["kind"] == _BLOCK:
                    held.append((row, _Pack.of(row)))
                    continue
                anchors = _Pack.of(row)
                for block_row, block in held:
                    found = visit(block_row, block, row, anchors)
                    if found is not None and len(found):
                        yield pa.RecordBatch.from_pylist([{"batch": row["batch"], "found": found.tobytes()}],
                                                         pa.schema([("batch", pa.int64()), ("found", pa.binary())]))

    return (
        own.unionByName(sent)
        .withColumn("order", order)
        .repartition("dealt")
        .sortWithinPartitions("dealt", "order", "batch")
        .select(*_PACK_SCHEMA.names, "dealt")
        .mapInArrow(run, result_sql)
    )


def _merged(found: list[np.ndarray], most: int) -> np.ndarray:
    """The best entries of every anchor and window."""
    every = np.concatenate(found) if found else np.empty(0, _FOUND)
    every = every[np.lexsort((every["id"], -every["score"], every["window"], every["anchor"]))]
    key = every["anchor"].astype(np.int64) << 32 | every["window"]
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(every) else np.empty(0, np.int64)
    rank = np.arange(len(every)) - np.repeat(starts, np.diff(np.r_[starts, len(every)]))
    return every[rank < most]


def _merge(batches: DataFrame, found: DataFrame, most: int, finish, schema: str) -> DataFrame:
    """What every batch found, merged as it streams in; ``finish(batch row, entries)`` gives the rows."""
    empty = [F.lit(None).cast("binary").alias(name) for name in _PACK_FIELDS if name != "found"]
    parts = found.select(
        F.lit(None).cast("bigint").alias("block"), "batch", F.lit(_OWN).alias("kind"), F.lit(0).alias("width"), *empty, "found"
    )

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict | None = None
        entries: list[np.ndarray] = []
        for batch in stream:
            for row in batch.to_pylist():
                if row["kind"] == _BATCH:
                    if held is not None:
                        yield finish(held, _merged(entries, most))
                    held, entries = row, []
                    if row["found"] is None:
                        continue
                entries.append(np.frombuffer(row["found"], _FOUND))
                if sum(map(len, entries)) > 1_000_000:
                    entries = [_merged(entries, most)]
        if held is not None:
            yield finish(held, _merged(entries, most))

    return (
        batches.select(*_PACK_SCHEMA.names)
        .unionByName(parts.select(*_PACK_SCHEMA.names))
        .repartition("batch")
        .sortWithinPartitions("batch", F.col("kind").desc())
        .mapInArrow(run, schema)
    )


def hard_negatives(
    rows: DataFrame,
    anchor_step: int = 100,
    positives: int = 5,
    negatives: int = 5,
    share: tuple[int, int] = (80, 100),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Hard negatives of every anchor and each of its positives.

    Anchors are rows (``participants``) whose id is divisible by ``anchor_step``. Positives are an anchor's
    best other rows of its label. Negatives are the best rows of other labels that score no more than
    the positive and at least ``share`` of it. Returns anchor_id, positive_id, rank, negative_id,
    positive_score and negative_score.
    """
    references = fit_references(rows)
    index = stash(indexed_rows(rows, references), "negative-rows")
    order = ["cell", "near", F.col("vec_id").asc_nulls_last(), F.col("salt")]
    sorted_rows = index.withColumn("salt", F.rand(7)).repartitionByRange(*order).sortWithinPartitions(*order)
    packed = stash(
        sorted_rows.select("vec_id", "label", "width", "vector", "norm", "angles").mapInArrow(
            _block_batches(anchor_step, positives, block_rows), _PACK_SQL
        ),
        "negative-blocks",
    )
    blocks, batches = packed.filter(F.col("kind") == _BLOCK), packed.filter(F.col("kind") == _BATCH)
    groups = max(1, blocks.count())

    def floors(row: dict, count: int) -> np.ndarray:
        found = np.frombuffer(row["found"], _FOUND)
        out = np.full(count, -np.inf)
        anchors, held = np.unique(found["anchor"], return_counts=True)
        for anchor in anchors[held >= positives]:
            out[anchor] = found["score"][found["anchor"] == anchor].min()
        return out

    def elsewhere(block_row: dict, block: _Pack, row: dict, anchors: _Pack) -> np.ndarray | None:
        if block_row["block"] == row["block"]:
            return None  # found when the block was packed
        return _positives(block, anchors, positives, floors(row, len(anchors.ids)))

    def with_windows(row: dict, entries: np.ndarray) -> pa.RecordBatch:
        windows = entries.copy()
        place = np.arange(len(windows))
        windows["window"] = place - np.searchsorted(windows["anchor"], windows["anchor"])
        return pa.RecordBatch.from_pylist([{**row, "windows": windows.tobytes(), "found": None}], _PACK_SCHEMA)

    anchored = stash(
        _merge(batches, _visits(blocks, batches, groups, elsewhere), positives, with_windows, _PACK_SQL), "negative-anchors"
    )

    def in_windows(block_row: dict, block: _Pack, row: dict, anchors: _Pack) -> np.ndarray:
        windows = np.frombuffer(row["windows"], _FOUND)
        return _negatives(block, anchors, windows[windows["score"] >= 0], negatives, share)

    def finished(row: dict, entries: np.ndarray) -> pa.RecordBatch:
        ids = np.frombuffer(row["ids"], "<i8")
        windows = np.frombuffer(row["windows"], _FOUND)
        key = windows["anchor"].astype(np.int64) << 32 | windows["window"]
        at = np.searchsorted(key, entries["anchor"].astype(np.int64) << 32 | entries["window"])
        rank = np.arange(len(entries)) - np.searchsorted(at, at) + 1

        def known(values: np.ndarray) -> pa.Array:
            return pa.array(values, pa.int64(), mask=values == _NO_ID)

        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids[entries["anchor"]], pa.int64()),
                known(windows["id"][at]),
                pa.array(rank.astype(np.int32)),
                known(entries["id"]),
                pa.array(windows["score"][at], pa.int64()),
                pa.array(entries["score"], pa.int64()),
            ],
            ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"],
        )

    return _merge(
        anchored, _visits(blocks, anchored, groups, in_windows), negatives, finished,
        "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint",
    )


def moved_labels(step: int = 7, classes: int = 10) -> Column:
    """Labels in which those of ids divisible by ``step`` move to the next class."""
    moved = (F.col("label") + 1) % classes
    return F.when(F.col("vec_id") % step == 0, moved).otherwise(F.col("label"))
