"""The latent space of the benchmark search is fitted on all documents."""

from __future__ import annotations

import numpy as np

from depotflow.llm import latent


def test_pairs_of_terms_are_counted_over_all_documents(spark, monkeypatch):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(40)]
    items = latent.Items.of([(1, [w.encode() for w in words[:25]]), (2, [w.encode() for w in words[15:]])])
    texts = [" ".join(rng.choice([*words, *["other"] * 60], 150)) for _ in range(3500)]  # more than the 3,000 once sampled
    docs = spark.createDataFrame(list(enumerate([*texts, None, ""])), "doc_id bigint, text string").repartition(3)
    weighted = np.append(np.arange(40) % 9 > 0, False)
    found = {r["pair"]: r["passages"] for r in latent._pair_counts(docs, items, weighted).collect()}
    wanted: dict[int, int] = {}
    for text in texts:
        numbers = latent._numbers(text, items.terms)
        for stride, _ in items.classes:
            for start in range(0, len(numbers), stride):
                own = sorted({int(n) for n in numbers[start : start + 2 * stride] if n >= 0 and weighted[n]})
                for i, a in enumerate(own):
                    for b in own[i:]:
                        wanted[a * 40 + b] = wanted.get(a * 40 + b, 0) + 1
    assert found == wanted


def test_sums_over_pairs_are_those_over_passages(monkeypatch):
    rng = np.random.default_rng(6)
    weights, probe = rng.random(30) + 0.1, rng.standard_normal((30, 7))
    codes = np.unique(rng.integers(0, 90, 600) << 32 | rng.integers(0, 30, 600))
    passage, term = codes >> 32, codes & (2**32 - 1)
    wanted, found = np.zeros((30, 7)), np.zeros((30, 7))
    latent._add_outer(wanted, passage, term, weights, probe)
    monkeypatch.setattr(latent, "HELD_PAIRS", 50)
    monkeypatch.setattr(latent, "PROBE_ROWS", 64)
    parts = list(latent._pairs(passage, term, 30))
    assert len(parts) > 10
    latent._add_pairs(found, *np.unique(np.concatenate(parts), return_counts=True), weights, probe)
    assert np.allclose(found, wanted)
