"""Documents packed into training sequences of several lengths, without padding.

Whole windows of the longest context size are cut from the front of a document. What is left, and every
shorter document, is routed to the smallest context size that holds it. The sizes are packed from the longest
on: the longest open piece starts a window of its size, the gap is filled with the longest pieces
of shorter sizes that fit, and when none fits the shortest open piece is cut at the end of the gap; its
rest is routed anew. Every window is thus exactly full. The pieces of the last window of a task are cut at powers
of two instead.

Sequences of one size are put into step groups of equally many tokens. Sequences differ in how
much attention they cost, the sum of squared lengths of their pieces; they are dealt to the groups
of a block in turns forwards and backwards in order of that cost, so that the groups are alike.

Each task packs the rows of its own partition in bounded blocks: nothing is shuffled, a task holds
some thousand open pieces, and a lost task is done again alone. Ids of sequences and groups
start with the number of the partition.

Handling of odd input: a NULL or empty text has the end mark alone; repeated rows are packed each,
with the same doc_id; a NULL doc_id stays NULL; other columns are ignored. Empty input gives no rows.
"""

from __future__ import annotations

import os
from bisect import bisect_right, insort
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotflow.llm.common import LOWER

#: Context sizes, longest first; powers of two.
SIZES = (2048, 1024, 512, 256, 128)
#: Tokens of a step group.
STEP_TOKENS = 16 * 2048
#: Open pieces, and their tokens, that are packed at once.
BLOCK_PIECES, BLOCK_TOKENS = 8_192, 4_000_000
END_ID = 1

_CACHED_WORDS, _CACHED_BYTES = 600_000, 48
_ID_BYTES = 4

PIECE_SQL = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint,"
    " sequence_id bigint, offset bigint, sequence_length int, step_id bigint"
)
_PIECE_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
     ("sequence_id", pa.int64()), ("offset", pa.int64()), ("sequence_length", pa.int32()), ("step_id", pa.int64())]
)


class WordIds:
    """Token ids of texts by a tokenizer whose tokens never span white space, as packed numbers.

    The tokenizer ignores case and white space, so a text's ids are those of its words one after the other.
    Short words are remembered in lower case, in two generations of bounded size: when the newer is full it
    becomes the older, and words that are met again move up, so that common words stay. Words that may
    hold one of the tokenizer's marks are left as they are.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.newer: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def of_texts(self, texts: Sequence[bytes | None]) -> Iterator[bytes]:
        """The packed ids of each text, with the end mark; their unknown words are encoded at once."""
        if len(self.newer) > _CACHED_WORDS:
            self.newer, self.older = {}, self.newer
        split = [_words(text) for text in texts]
        unseen = set().union(*split).difference(self.newer)
        new = []
        for word in unseen:
            known = self.older.get(word)
            if known is None:
                new.append(word)
            else:
                self.newer[word] = known
        encoded = self.tokenizer.encode_batch([word.decode() for word in new], add_special_tokens=False)
        for word, found in zip(new, encoded):
            self.newer[word] = np.array(found.ids, "<u4").tobytes()
        end = np.array([END_ID], "<u4").tobytes()
        for words in split:
            yield b"".join(map(self.newer.__getitem__, words)) + end
        for word in new:
            if len(word) > _CACHED_BYTES:
                del self.newer[word]


def _words(text: bytes | None) -> list[bytes]:
    if not text:
        return []
    if b"<|" not in text:
        return text.translate(LOWER).split()
    return [word if b"<|" in word else word.translate(LOWER) for word in text.split()]


_known: dict[str, WordIds] = {}


def _word_ids(path: str) -> WordIds:
    if path not in _known:
        _known[path] = WordIds(path)
    return _known[path]


@dataclass(order=True)
class _Piece:
    """A part of a document, ordered by its length."""

    length: int
    number: int
    start: int = field(compare=False)
    doc: tuple[int | None, bytes] = field(compare=False)


def size_of(length: int, sizes: Sequence[int] = SIZES) -> int:
    """The smallest context size that holds a piece."""
    return min(size for size in sizes if size >= length)


def packed_windows(open_pieces: list[_Piece], sizes: Sequence[int] = SIZES) -> tuple[list[list[_Piece]], list[_Piece]]:
    """Exactly full windows of the open pieces, and the pieces of a last window that stays open."""
    pool = sorted(open_pieces)
    windows = []
    while pool:
        window = [pool.pop()]
        size = size_of(window[0].length, sizes)
        gap = size - window[0].length
        while gap and pool:
            fitting = bisect_right(pool, gap, key=lambda piece: piece.length)
            if fitting:
                window.append(pool.pop(fitting - 1))
            else:
                longer = pool.pop(0)
                window.append(_Piece(gap, longer.number, longer.start, longer.doc))
                insort(pool, _Piece(longer.length - gap, longer.number, longer.start + gap, longer.doc))
            gap -= window[-1].length
        if gap:
            return windows, window
        windows.append(window)
    return windows, []


def cut_at_powers(pieces: list[_Piece]) -> list[list[_Piece]]:
    """Pieces one after the other, cut into windows of powers of two, longest first."""
    left = sum(piece.length for piece in pieces)
    windows: list[list[_Piece]] = []
    room = 0
    for piece in pieces:
        start, length = piece.start, piece.length
        while length:
            if not room:
                room = 1 << left.bit_length() - 1
                windows.append([])
            taken = min(room, length)
            windows[-1].append(_Piece(taken, piece.number, start, piece.doc))
            start, length, room, left = start + taken, length - taken, room - taken, left - taken
    return windows


def step_groups(windows: list[list[_Piece]], per_step: int) -> Iterator[list[list[_Piece]]]:
    """Windows dealt to groups of ``per_step`` (all must be full) of like cost."""
    groups: list[list[list[_Piece]]] = [[] for _ in range(len(windows) // per_step)]
    by_cost = sorted(windows, key=lambda window: -sum(piece.length**2 for piece in window))
    for round_no in range(per_step):
        dealt = by_cost[round_no * len(groups) : (round_no + 1) * len(groups)]
        for group, window in zip(groups if round_no % 2 == 0 else groups[::-1], dealt):
            group.append(window)
    yield from groups


class _Packer:
    """The open pieces and windows of one task."""

    def __init__(self, partition: int, sizes: Sequence[int], step_tokens: int):
        self.sizes, self.step_tokens = sizes, step_tokens
        self.sequence = self.step = partition << 32
        self.number = self.open_tokens = 0
        self.open: list[_Piece] = []
        self.waiting: dict[int, list[list[_Piece]]] = {}

    def add(self, doc_id: int | None, ids: bytes) -> None:
        longest, tokens = self.sizes[0], len(ids) // _ID_BYTES
        doc = (doc_id, ids)
        for start in range(0, tokens, longest):
            length = min(longest, tokens - start)
            self.number += 1
            piece = _Piece(length, self.number, start, doc)
            if length == longest:
                self.waiting.setdefault(longest, []).append([piece])
            else:
                self.open.append(piece)
            self.open_tokens += length

    @property
    def full(self) -> bool:
        return len(self.open) >= BLOCK_PIECES or self.open_tokens >= BLOCK_TOKENS

    def pack(self) -> Iterator[pa.RecordBatch]:
        windows, self.open = packed_windows(self.open, self.sizes)
        self._wait(windows)
        self.open_tokens = 0
        yield from self._groups()

    def close(self) -> Iterator[pa.RecordBatch]:
        yield from self.pack()
        self._wait(cut_at_powers(self.open))
        yield from self._groups()
        for windows in self.waiting.values():
            if windows:
                yield self._batch([windows])

    def _wait(self, windows: list[list[_Piece]]) -> None:
        for window in windows:
            self.waiting.setdefault(sum(piece.length for piece in window), []).append(window)

    def _groups(self) -> Iterator[pa.RecordBatch]:
        for size, windows in self.waiting.items():
            per_step = max(1, self.step_tokens // size)
            whole = len(windows) // per_step * per_step
            if whole:
                self.waiting[size] = windows[whole:]
                yield self._batch(step_groups(windows[:whole], per_step))

    def _batch(self, groups) -> pa.RecordBatch:
        rows = []
        for group in groups:
            for window in group:
                offset, length = 0, sum(piece.length for piece in window)
                for piece in window:
                    doc_id, ids = piece.doc
                    part = ids[piece.start * _ID_BYTES : (piece.start + piece.length) * _ID_BYTES]
                    rows.append(
                        (doc_id, piece.start, piece.length, part, len(ids) // _ID_BYTES, self.sequence, offset, length, self.step)
                    )
                    offset += piece.length
                self.sequence += 1
            self.step += 1
        return pa.RecordBatch.from_arrays(
            [pa.array(column, f.type) for column, f in zip(zip(*rows), _PIECE_SCHEMA)], schema=_PIECE_SCHEMA
        )


def pack_documents(
    docs: DataFrame, tokenizer_path: str, sizes: Sequence[int] = SIZES, step_tokens: int = STEP_TOKENS
) -> DataFrame:
    """The pieces of all documents in their sequences, one row each.

    ``start``, ``length`` and ``ids`` (numbers of 32 bits, low byte first) are the piece of the document,
    whose ids with the end mark are ``doc_tokens``; ``offset`` is its place in the sequence, ``sequence_length``
    the context size of that sequence, and ``step_id`` the group of sequences of one training step. The tokenizer is
    named by a path that executors can read; its tokens must not span white space nor depend on the case of A-Z.
    """
    if any(size & size - 1 for size in sizes) or list(sizes) != sorted(sizes, reverse=True):
        raise ValueError("Context sizes must be powers of two, longest first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(TaskContext.get().partitionId(), sizes, step_tokens)
        encode = _word_ids(tokenizer_path)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                rows = batch.slice(begin, 256)
                texts = rows.column(1).cast(pa.binary()).to_pylist()
                for doc_id, ids in zip(rows.column(0).to_pylist(), encode.of_texts(texts)):
                    packer.add(doc_id, ids)
                    if packer.full:
                        yield from packer.pack()
        yield from packer.close()

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, PIECE_SQL
    )
