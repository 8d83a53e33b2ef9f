"""Shared helpers: written intermediate tables, words and their hashes, merged counters."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR_KEY = "spark.checkpoint.dir"

#: Lower-cases A-Z only, whatever the language.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

#: Rows of texts in one Arrow batch at most; texts are long, so batches stay small.
_CACHED_WORDS = 1_000_000


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, as in tests on one machine, a fresh one is set.
    """
    folder = spark.conf.get(CHECKPOINT_DIR_KEY, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_DIR_KEY} must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set(CHECKPOINT_DIR_KEY, folder)
    return folder.rstrip("/")


def stash(frame: DataFrame, label: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: it cuts the lineage, and a lost
    executor costs no recomputation.

    What the plan behind it held (broadcasts, shuffle files, plans in the driver) is Spark's to clean once the
    driver collects its garbage, which is done here: else it waits until the driver's heap is full.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/llm/{label}-{uuid.uuid4().hex[:12]}"
    frame.write.parquet(path)
    spark._jvm.System.gc()
    return spark.read.schema(frame.schema).parquet(path)


def free_name(frame: DataFrame, wanted: str) -> str:
    """The wanted column name, with underscores behind it until no column has it."""
    taken = {name.lower() for name in frame.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def tokenizer_path(name: str) -> str:
    """The file of a public tokenizer on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(modulus: int, remainder: int) -> F.Column:
    """Whether a document is kept from learning; a NULL id never is."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus
    return F.coalesce(fold == remainder, F.lit(False))


def words_of(text: str | None) -> list[bytes]:
    """The words between white space (0x20, 0x09-0x0D), as UTF-8."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").split()


def lower_words(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(LOWER).split()


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound per worker."""

    def __init__(self, seed: int = 7):
        super().__init__()
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word, self.seed)
        return value

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self) > _CACHED_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values so that every bit depends on every bit."""
    x = values.copy()
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of ``length`` consecutive entries, by doubling shorter runs."""
    if len(hashes) < length:
        return np.empty(0, np.uint64)
    factor, shift = np.uint64(0x9E3779B97F4A7C15), 1
    spans = {1: hashes}
    while shift * 2 <= length:
        half = spans[shift]
        spans[shift * 2] = mix(half[:-shift] * factor + half[shift:])
        shift *= 2
    out, covered = spans[shift], shift
    while covered < length:
        shift = max(s for s in spans if s <= length - covered)
        right = spans[shift][covered:]
        out = mix(out[: len(right)] * factor + right)
        covered += shift
    return out[: len(hashes) - length + 1]


def map_batches(
    frame: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]], schema: str
) -> DataFrame:
    """Applies a function to each Arrow batch; ``make`` runs once per task and holds its caches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            out = step(batch)
            if out is not None and out.num_rows:
                yield out

    return frame.mapInArrow(run, schema)


def sorted_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str], columns: list[str]
) -> Iterator[tuple[tuple, list[np.ndarray]]]:
    """Runs of equal keys in sorted batches, each with the other columns as arrays."""
    held: tuple | None = None
    parts: list[list[np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch.schema.names
        key_cols = [batch.column(names.index(k)).to_numpy(zero_copy_only=False) for k in keys]
        cols = [batch.column(names.index(c)).to_numpy(zero_copy_only=False) for c in columns]
        changed = np.zeros(batch.num_rows, bool)
        changed[0] = True
        for col in key_cols:
            changed[1:] |= col[1:] != col[:-1]
        starts = np.flatnonzero(changed)
        for start, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            key = tuple(col[start] for col in key_cols)
            piece = [col[start:end] for col in cols]
            if key == held:
                parts.append(piece)
                continue
            if held is not None:
                yield held, _joined(parts)
            held, parts = key, [piece]
    if held is not None:
        yield held, _joined(parts)


def _joined(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    return parts[0] if len(parts) == 1 else [np.concatenate(col) for col in zip(*parts, strict=True)]


def merge_counters(parts: DataFrame, width: int, dtype: str = "int64") -> DataFrame:
    """Sums packed counters by key: rows (slot, data) with ``width`` counters in each ``data``.

    Rows are merged as they stream in, so a task holds one counter block per slot and not
    the blocks of all tasks that counted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for slot, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                values = np.frombuffer(data.as_buffer(), dtype=dtype)
                if slot in totals:
                    totals[slot] += values
                else:
                    totals[slot] = values.copy()
        for slot, values in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([slot], pa.int64()), pa.array([values.tobytes()], pa.binary())], ["slot", "data"]
            )

    assert width > 0
    return parts.select("slot", "data").repartition("slot").mapInArrow(run, "slot bigint, data binary")
