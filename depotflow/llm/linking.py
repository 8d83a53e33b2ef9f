"""Links inside buckets of an index, and connected components of links, at any group size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotflow.llm.common import sorted_groups, stash

#: Members of a bucket that one task compares at a time; larger buckets are split in blocks.
BLOCK = 2048
#: Links of a node that meet in one task, and how many nodes may have more: theirs is a list of bounded size.
COLD_LINKS, MOST_HOT = 256, 100_000


def _forest(count: int, near: Callable[[int, np.ndarray], np.ndarray]) -> tuple[list[int], list[int]]:
    """Links that connect whatever a full comparison of the members would connect."""
    left = np.arange(1, count)
    reached, seen_from, seen_to = [0], [], []
    while True:
        if not reached:
            if not len(left):
                break
            reached, left = [int(left[0])], left[1:]
        at = reached.pop()
        if not len(left):
            continue
        hit = near(at, left)
        if hit.any():
            found = left[hit].tolist()
            seen_from += [at] * len(found)
            seen_to += found
            reached += found
            left = left[~hit]
    return seen_from, seen_to


def bucket_links(
    rows: DataFrame, near_of: Callable[[np.ndarray, np.ndarray], Callable[[int, np.ndarray], np.ndarray]], block: int = BLOCK
) -> DataFrame:
    """Links (a, b) between nodes that share a bucket and are near.

    ``rows`` has ``bucket``, ``node`` and ``sig``, each node once in a bucket. Within a bucket
    only as many links are returned as connect its members. A bucket of more than ``block``
    members is dealt out as pairs of blocks, so that every two members meet in one of them.
    """
    hot = stash(
        rows.groupBy("bucket").count().filter(F.col("count") > block)
        .select("bucket", F.ceil(F.col("count") / block).alias("chunks")),
        "hot-buckets",
    )
    if hot.isEmpty():
        placed = rows.withColumn("lo", F.lit(0)).withColumn("hi", F.lit(0))
    else:
        split = rows.join(hot, "bucket", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
        placed = (
            split.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks").cast("int") - 1)))
            .withColumn("lo", F.least("mine", "other"))
            .withColumn("hi", F.greatest("mine", "other"))
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: list = []
        b: list = []
        for _, (nodes, sigs) in sorted_groups(batches, ["bucket", "lo", "hi"], ["node", "sig"]):
            if len(nodes) > 1:
                left, right = _forest(len(nodes), near_of(nodes, sigs))
                a += nodes[left].tolist()
                b += nodes[right].tolist()
            if len(a) > 50_000:
                yield _pairs(a, b)
                a, b = [], []
        if a:
            yield _pairs(a, b)

    found = (
        placed.select("bucket", "lo", "hi", "node", "sig")
        .repartition("bucket", "lo", "hi")
        .sortWithinPartitions("bucket", "lo", "hi")
        .mapInArrow(run, "a bigint, b bigint")
    )
    return found.distinct()


def _pairs(a: list, b: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every linked node; the root is the smallest node of its component.

    Alternating star contraction: each round points nodes at the smallest neighbour, using
    partially aggregated minima and joins only. Links of a node that has very many stay where they
    are: its minimum is sent to them.
    """
    edges = stash(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    before = _digest(edges)
    while True:
        cold = max(COLD_LINKS, -(-2 * before[0] // MOST_HOT))
        edges = stash(_large_star(edges, cold), "links")
        edges = stash(_small_star(edges, cold), "links")
        after = _digest(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _digest(edges: DataFrame) -> tuple:
    """Number of distinct edges and 128 bits over all of them, whatever their order: one row from
    one pass without a shuffle of edges."""
    total = F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), total).first())


def _with_least(links: DataFrame, cold: int) -> DataFrame:
    """(u, v, m): links with the smallest ``v`` of their ``u``; ``links`` is read more than once.

    The minima are written, so that a plan holds neither their making nor that of the links several times: plans
    of a whole round once had 50 scans, and planning them took the driver hundreds of MB. The minima of nodes with
    over ``cold`` links are broadcast, so that such a node is never one task's work. A round has at most twice as
    many rows as there were links before it, and ``cold`` is at least that over ``MOST_HOT``: the broadcast has at
    most that many rows of 16 bytes.
    """
    least = stash(links.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")), "least")
    hot = least.filter(F.col("n") > cold).select("u", F.col("m").alias("hot"))
    if hot.isEmpty():
        return links.select("u", "v").join(least.select("u", "m"), "u")
    marked = links.select("u", "v").join(F.broadcast(hot), "u", "left")
    few = least.filter(F.col("n") <= cold).select("u", "m")
    return (
        marked.filter("hot IS NULL").select("u", "v").join(few, "u").select("u", "v", "m")
        .unionByName(marked.filter("hot IS NOT NULL").select("u", "v", F.col("hot").alias("m")))
    )


def _large_star(edges: DataFrame, cold: int) -> DataFrame:
    turned = F.struct(F.col("v").alias("u"), F.col("u").alias("v"))
    both = edges.select(F.inline(F.array(F.struct("u", "v"), turned)))
    larger = _with_least(both, cold).filter("v > u")
    return larger.select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()


def _small_star(edges: DataFrame, cold: int) -> DataFrame:
    """Every smaller neighbour, and the node itself in place of the smallest, points at the smallest."""
    least = F.col("v") == F.col("m")
    return _with_least(edges, cold).select(F.when(least, F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct()
