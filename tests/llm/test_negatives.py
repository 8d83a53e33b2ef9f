"""Hard negatives against scoring all pairs, and the bounds of scores against the scores."""

from __future__ import annotations

import math

import numpy as np
import pytest

from depotflow.llm import negatives as N

ROWS = "vec_id bigint, embedding array<float>, label int, cell int, kind int, block bigint, norm string"


def expected(rows, step=100, positives=5, negatives=5):
    parts = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        scaled = [math.floor(256 * float(np.float32(x))) for x in vector]
        if math.sqrt(sum(x * x for x in scaled)) < N.MOST_NORM:
            parts.append((vec_id, label, scaled))
    out = []

    def ordered(found):
        return sorted(found, key=lambda f: (-f[0], f[1] is None, f[1] or 0))

    for i, (anchor, label, vector) in enumerate(parts):
        if anchor is None or anchor % step:
            continue
        scores = [(sum(x * y for x, y in zip(vector, v)), vec_id, other == label) for j, (vec_id, other, v) in enumerate(parts) if j != i]
        for top, positive in [s[:2] for s in ordered(s for s in scores if s[2])][:positives]:
            near = ordered(s for s in scores if not s[2] and 80 * top <= 100 * s[0] <= 100 * top)
            out += [(anchor, positive, rank, s[1], top, s[0]) for rank, s in enumerate(near[:negatives], 1)]
    return sorted(out, key=str)


def found(spark, rows, **options):
    table = spark.createDataFrame([(i, v, label, 1, 2, 3, "x") for i, v, label in rows], ROWS).repartition(5)
    out = N.hard_negatives(N.participants(table, N.moved_labels()), **options)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def some_rows(count, clusters, spread, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, 12))
    vectors = centres[rng.integers(clusters, size=count)] + spread * rng.normal(size=(count, 12))
    return [(i, [float(x) for x in v.astype(np.float32)], int(rng.integers(4))) for i, v in enumerate(vectors)]


@pytest.mark.parametrize(("clusters", "spread", "block_rows"), [(1, 1.0, 8192), (6, 0.05, 64), (40, 0.3, 100)])
def test_all_negatives_are_found(spark, clusters, spread, block_rows):
    rows = some_rows(600, clusters, spread)
    want = expected(rows, step=20)
    assert len(want) > 200
    assert found(spark, rows, anchor_step=20, block_rows=block_rows) == want


def test_odd_rows(spark):
    rows = some_rows(120, 3, 0.2, seed=4)
    rows += [(i, [0.5] * 12, i % 3) for i in range(100, 160)]  # ties
    rows += [(0, rows[0][1], rows[0][2])] * 3 + [(200, [0.5] * 12, 1)] * 2  # repeated anchors
    rows += [(None, [0.5] * 12, 1), (None, [0.4] * 12, 2), (300, None, 1), (301, [0.1], None), (302, [float("nan")] * 12, 1)]
    rows += [(303, [0.1, None], 2), (304, [float("inf")] * 3, 2), (305, [], 1), (400, [0.0] * 12, 2), (500, [0.9] * 5, 2)]
    rows += [(501, [0.5] * 20, 3), (600, [3e38] * 12, 1), (700, [4e5] * 12, 1), (701, [4e5] * 12, 2), (702, [3.9e5] * 12, 1)]
    assert found(spark, rows, block_rows=40) == expected(rows)


def test_few_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(0, [1.0], 1)]) == []
    assert found(spark, [(100, [1.0], 1), (101, [1.0], 1), (102, [0.9], 2)]) == [(100, 101, 1, 102, 65536, 58880)]


def test_bounds_hold_and_leave_rows_out():
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(8, 16))
    vectors = np.floor(256 * (centres[rng.integers(8, size=500)] + 0.05 * rng.normal(size=(500, 16))))
    norms = np.sqrt((vectors * vectors).sum(1))
    angles = N._angles(N._units(vectors, norms), N._units(centres, np.sqrt((centres * centres).sum(1))))
    pack = N._Pack(np.arange(500), np.zeros(500, np.int64), vectors, norms, angles)
    rows, kept = np.arange(500), 0
    for i in range(0, 500, 7):
        low, high = pack.bounds(pack, i, rows)
        scores = pack.scores(pack, i, rows)
        assert (low <= scores).all() and (scores <= high).all()
        kept += (high >= np.sort(scores)[-6]).sum()
    assert kept < 0.4 * 500 * len(range(0, 500, 7))
