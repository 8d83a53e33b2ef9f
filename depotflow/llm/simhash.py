"""SimHash near-duplicates through a byte-position inverted index with count filtering.

A fingerprint has eight bytes, and each byte with its position is a token of the inverted
index. Fingerprints that differ in at most ``d`` bits share at least ``8 - d`` positional bytes.
The lists of single bytes hold 1/256 of all fingerprints each, so the index is kept on three
positional bytes at once: five shared bytes always hold one of the eight triples within bytes
0-3 or 4-7. Shared bytes are then tallied per pair, pairs below the guaranteed minimum are
dropped, and the rest are verified bit by bit.

Near-duplicates by similarity (0.8 of five-word shingles by default) use the same index and
tally, on positional bytes that agree with the probability of the similarity. The tally only
finds candidates; each link is verified by the Jaccard similarity of the shingle sets.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotflow.llm.common import WordHashes, free_name, lower_words, map_batches, mix, run_hashes, stash
from depotflow.llm.linking import bucket_links, components

SEED = 42
MAX_BITS = 3
#: Bytes of a similarity signature, and bytes that make one key of its index.
SIGNATURE_BYTES, KEY_BYTES, KEYS = 96, 4, 20
#: Standard deviations that the tally of a candidate may lie below the similarity.
DEVIATIONS = 4.5
#: Candidates of a group that one task compares at a time, with their shingles.
VERIFIED_BLOCK = 512


def simhash(words: list[bytes], shingle: int) -> int:
    """The signed 64-bit fingerprint of a word sequence; 0 for no words."""
    if not words:
        return 0
    if len(words) < shingle:
        values = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
        values = [digest(joined[s:e], SEED) for s, e in spans]
    bits = np.unpackbits(np.array(values, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
    majority = 2 * bits.sum(axis=0, dtype=np.int64) > len(values)
    return int.from_bytes(np.packbits(majority).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp) of every document; a NULL or empty text has fingerprint zero."""

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            values = [simhash(lower_words(text), shingle) for text in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.int64())], ["doc_id", "fp"])

        return step

    return map_batches(docs.select(F.col("doc_id").cast("bigint"), "text"), make, "doc_id bigint, fp bigint")


def _triples() -> list[int]:
    """Masks of the byte triples of which any five shared bytes hold one."""
    halves = (range(4), range(4, 8))
    return [sum(0xFF << (8 * byte) for byte in three) for half in halves for three in combinations(half, 3)]


def _hamming_near(max_bits: int) -> Callable:
    shared = 8 - max_bits

    def near_of(nodes: np.ndarray, sigs: np.ndarray) -> Callable[[int, np.ndarray], np.ndarray]:
        values = nodes.astype(np.int64).view(np.uint64)
        as_bytes = values.view(np.uint8).reshape(-1, 8)

        def near(at: int, others: np.ndarray) -> np.ndarray:
            tally = (as_bytes[others] == as_bytes[at]).sum(axis=1)
            hit = tally >= shared
            hit[hit] = np.bitwise_count(values[others[hit]] ^ values[at]) <= max_bits
            return hit

        return near

    return near_of


def linked_fingerprints(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(node, root) of fingerprints linked by chains of at most ``max_bits`` differing bits.

    ``distinct`` holds each fingerprint once, as ``fp``. The index is complete for up to three
    bits; fingerprints without a partner are not returned.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError("the byte index is complete for at most three differing bits")
    masks = F.array(*[F.lit(m if m < 2**63 else m - 2**64) for m in _triples()])
    rows = distinct.select(F.col("fp").alias("node"), F.posexplode(masks).alias("which", "mask")).select(
        F.xxhash64("which", F.col("node").bitwiseAND(F.col("mask"))).alias("bucket"), "node", F.lit(None).cast("binary").alias("sig")
    )
    return components(bucket_links(rows, _hamming_near(max_bits)))


def simhash_components(docs: DataFrame, shingle: int = 3, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document.

    Equal fingerprints are handled once, however many documents share them. Repeated rows come
    back as often as they went in. ``component_id`` is the smallest non-NULL doc_id reachable.
    """
    found = stash(fingerprints(docs, shingle), "fingerprints")
    smallest = found.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = linked_fingerprints(smallest.select("fp"), max_bits).withColumnRenamed("node", "fp")
    rooted = smallest.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    component = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(component, "root").select("fp", "component_id")
    return found.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


# --- by similarity ------------------------------------------------------------------------


def _shingle_set(words: np.ndarray, shingle: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles; a text of fewer words is one shingle."""
    return np.unique(run_hashes(words, min(shingle, len(words)))) if len(words) else np.empty(0, np.uint64)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")


def signatures(docs: DataFrame, shingle: int = 5) -> DataFrame:
    """(doc_id, text_key, node, sig): ``node`` is a hash of the set of shingles, ``sig`` has
    positional bytes, each equal in two texts with the probability of the Jaccard similarity of
    their sets (or by chance, one in 256)."""
    salts = mix(np.arange(1, SIGNATURE_BYTES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        hashes = WordHashes()

        def signature(text: str | None) -> tuple[int, bytes]:
            runs = _shingle_set(hashes(lower_words(text)), shingle)
            node = xxhash.xxh64_intdigest(runs.tobytes(), SEED)
            node -= node >> 63 << 64
            if not len(runs):
                return node, bytes(SIGNATURE_BYTES)
            least = [(runs * salt >> np.uint64(20)).min() for salt in salts]
            return node, (mix(np.array(least, np.uint64)) & np.uint64(0xFF)).astype(np.uint8).tobytes()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            nodes, values = zip(*map(signature, batch.column(2).to_pylist()), strict=True) if batch.num_rows else ((), ())
            arrays = [batch.column(0), batch.column(1), pa.array(nodes, pa.int64()), pa.array(values, pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", "text_key", "node", "sig"])

        return step

    return map_batches(_keyed(docs), make, "doc_id bigint, text_key bigint, node bigint, sig binary")


def _shared_near(minimum: int) -> Callable:
    def near_of(nodes: np.ndarray, sigs: np.ndarray) -> Callable[[int, np.ndarray], np.ndarray]:
        as_bytes = np.frombuffer(b"".join(sigs.tolist()), np.uint8).reshape(len(nodes), -1)
        return lambda at, others: (as_bytes[others] == as_bytes[at]).sum(axis=1) >= minimum

    return near_of


def _jaccard_near(minimum: int, similarity: float) -> Callable:
    """Near by the sets of shingles that follow each signature, if the tally makes it a candidate."""

    def near_of(nodes: np.ndarray, sigs: np.ndarray) -> Callable[[int, np.ndarray], np.ndarray]:
        tallied = _shared_near(minimum)(nodes, np.array([s[:SIGNATURE_BYTES] for s in sigs], object))
        sets = [np.frombuffer(s, np.uint64, offset=SIGNATURE_BYTES) if len(s) > SIGNATURE_BYTES else np.empty(0, np.uint64) for s in sigs]
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))

        def near(at: int, others: np.ndarray) -> np.ndarray:
            hit = tallied(at, others)
            hit &= np.minimum(sizes[others], sizes[at]) >= similarity * np.maximum(sizes[others], sizes[at]) - 1e-9
            for place in np.flatnonzero(hit):
                small, large = sorted((sets[at], sets[others[place]]), key=len)
                if not len(small):  # both are empty, or the sizes differ
                    continue
                found = np.searchsorted(large, small)
                common = int((large[np.minimum(found, len(large) - 1)] == small).sum())
                hit[place] = common >= similarity * (len(small) + len(large) - common) - 1e-9
            return hit

        return near

    return near_of


def candidate_minimum(similarity: float) -> int:
    """The tally that a pair of just this similarity reaches but for a few in a million."""
    equal = similarity + (1 - similarity) / 256
    return max(1, int(SIGNATURE_BYTES * equal - DEVIATIONS * np.sqrt(SIGNATURE_BYTES * equal * (1 - equal))))


def _verified_links(docs: DataFrame, candidates: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Links between nodes of similar sets; ``candidates`` has (node, sig, root, text_of), where
    ``root`` is the group of candidates and ``text_of`` names a row with the node's text.

    Members of a group meet with their sets, each once or, in large groups, as pairs of blocks.
    No pairs are listed: a group yields as many links as connect what is similar.
    """
    rows = _keyed(docs)
    same = rows["doc_id"].eqNullSafe(F.col("text_of.doc_id")) & (rows["text_key"] == F.col("text_of.text_key"))
    met = rows.join(candidates, same).select("node", "root", "sig", "text").dropDuplicates(["node"])

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        hashes = WordHashes()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            pairs = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            values = [sig + _shingle_set(hashes(lower_words(text)), shingle).tobytes() for sig, text in pairs]
            return pa.RecordBatch.from_arrays([batch.column(1), batch.column(0), pa.array(values, pa.binary())], ["bucket", "node", "sig"])

        return step

    sets = stash(map_batches(met, make, "bucket bigint, node bigint, sig binary"), "shingle-sets")
    return bucket_links(sets, _jaccard_near(candidate_minimum(similarity), similarity), VERIFIED_BLOCK)


def _grouped(docs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(doc_id, text_key, component_id, first_key) of every document; the smallest non-NULL doc_id of a
    group and, of its texts, the one with the smallest key name the document that stands for the group."""
    found = stash(signatures(docs, shingle), "signatures")
    named_row = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_key"))
    distinct = stash(
        found.groupBy("node").agg(
            F.min(named_row).alias("least"), F.first("sig").alias("sig"), F.max(F.struct("doc_id", "text_key")).alias("text_of")
        ),
        "shingle-nodes",
    )
    starts = [1 + KEY_BYTES * k for k in range(KEYS)]
    keys = F.array(*[F.substring("sig", at, KEY_BYTES) for at in starts])
    rows = distinct.select("node", "sig", F.posexplode(keys).alias("which", "key")).select(
        F.xxhash64("which", "key").alias("bucket"), "node", "sig"
    )
    groups = components(bucket_links(rows, _shared_near(candidate_minimum(similarity))))
    candidates = distinct.join(groups, "node").select("node", "sig", "root", "text_of")
    roots = components(_verified_links(docs, candidates, shingle, similarity))
    rooted = distinct.select("node", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    component = rooted.groupBy("root").agg(F.min("least").alias("first"))
    named = rooted.select("node", "root").join(component, "root").select("node", "first")
    return found.select("doc_id", "text_key", "node").join(named, "node").select(
        "doc_id", "text_key", F.col("first.doc_id").alias("component_id"), F.col("first.text_key").alias("first_key")
    )


def similar_components(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """(doc_id, component_id) of every document, linked by chains of similar texts.

    The similarity is the Jaccard similarity of shingle sets, counted on 64-bit hashes of the
    shingles. Equal bytes only find the candidates for that. Texts without words are equal.
    """
    return _grouped(docs, shingle, similarity).select("doc_id", "component_id")


def keep_first(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest doc_id.

    Documents are told apart by id and text: of rows that share an id, each text is judged by itself, and of
    several texts with the smallest id of a group one stays. Of repeated rows of that document one stays.
    Rows with a NULL doc_id cannot be named as copies of another and stay. Columns and their order
    stay as they are.
    """
    grouped = _grouped(docs, shingle, similarity).filter("doc_id IS NOT NULL")
    copies = grouped.filter((F.col("doc_id") != F.col("component_id")) | (F.col("text_key") != F.col("first_key")))
    dropped = copies.select(F.col("doc_id").alias("copy_id"), F.col("text_key").alias("copy_key")).distinct()
    own, alone = free_name(docs, "__text_key__"), free_name(docs, "__alone__")
    keyed = docs.withColumn(own, F.xxhash64("text"))
    is_copy = (keyed["doc_id"].cast("bigint") == dropped["copy_id"]) & (keyed[own] == dropped["copy_key"])
    kept = keyed.join(dropped, is_copy, "left_anti")
    kept = kept.withColumn(alone, F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()))
    return kept.dropDuplicates(["doc_id", own, alone]).select(*docs.columns)
