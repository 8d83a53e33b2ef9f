"""Packing: every document can be put together again from its pieces, and sequences are full."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from depotflow.llm import packing as P
from depotflow.llm.common import tokenizer_path
from depotflow.llm.queries import llm_queries

ROWS = "doc_id bigint, text string, lang string, start int, length int, ids string, step_id int"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def checked(pieces, documents, longest=2048):
    """Sequences without gaps and of a power of two; documents whole. Returns the lengths of sequences."""
    sequences, parts = {}, {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append(p)
        parts.setdefault((p["doc_id"], p["doc_tokens"]), []).append(p)
    for pieces_of in sequences.values():
        end = 0
        for p in sorted(pieces_of, key=lambda p: p["offset"]):
            assert p["offset"] == end and p["length"] > 0
            end += p["length"]
        assert {p["sequence_length"] for p in pieces_of} == {end} and end <= longest and end & end - 1 == 0
    left = {}
    for doc_id, ids in documents:
        left.setdefault((doc_id, len(ids)), []).append(ids)
    assert left.keys() == parts.keys()
    for key, found in parts.items():
        texts = left[key]
        covered = np.zeros(key[1], int)
        for p in found:
            covered[p["start"] : p["start"] + p["length"]] += 1
            crcs = {zlib.crc32(np.array(t[p["start"] : p["start"] + p["length"]], "<u4").tobytes()) for t in texts}
            assert p["ids_crc32"] in crcs
        assert (covered == len(texts)).all()
    return [sum(p["length"] for p in s) for s in sequences.values()]


def test_whole_table(spark, tokenizer):
    docs = [(r["doc_id"], ids_of(tokenizer, r["text"])) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    pieces = llm_queries()["op12_packing"](spark, SMALL).collect()
    lengths = checked(pieces, docs)
    assert sum(lengths) == sum(len(ids) for _, ids in docs)
    assert sum(length < P.SIZES[-1] for length in lengths) < 8  # only where the task ends


def test_odd_rows(spark, tokenizer):
    texts = [None, "", " \t\n", "x", "A<|endoftext|>B <|ENDOFTEXT|> it's", "İstanbul ΣΊΣΥΦΟΣ é ́ a b c \x1c d", "日本語" * 50, "w" * 20_000,
             " ".join(f"Word{i}!" for i in range(30_000)), "same text", "same text", "same text"]
    rows = [(i if i != 3 else None, t, "en", 1, 2, "x", 3) for i, t in enumerate(texts)] + [(9, "same text", "en", 1, 2, "x", 3)] * 3
    for partitions in (1, 4):
        table = spark.createDataFrame(rows, ROWS).repartition(partitions)
        pieces = P.pack_documents(table, tokenizer_path("word_bpe_49k.json"))
        found = [{**r.asDict(), "ids_crc32": zlib.crc32(r["ids"])} for r in pieces.collect()]
        checked(found, [(row[0], ids_of(tokenizer, row[1])) for row in rows])
    assert P.pack_documents(spark.createDataFrame([], ROWS), tokenizer_path("word_bpe_49k.json")).collect() == []


def test_words_by_themselves_give_the_ids_of_the_text(tokenizer):
    rng = random.Random(3)
    signs = [*"aAzZ09 .,'<|>-_\t\n", "\r\n", "'S", "'ll", "É", "é", "İ", "İ", "ſ", "K", "Σ", "ς", " ", " ", "\x85", "‍", "क्षि", "한", "👩‍🔬", "<|endoftext|>", "ǅ", "ﬁ"]
    words = P.WordIds(tokenizer_path("word_bpe_49k.json"))
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    got = words.of_texts([t.encode() for t in texts])
    for text, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u4").tolist() == ids_of(tokenizer, text), repr(text)


def pieces(lengths):
    return [P._Piece(n, i, 0, (i, b"\0" * 4 * n)) for i, n in enumerate(lengths)]


def test_windows_are_full_and_cuts_few():
    rng = random.Random(1)
    lengths = [rng.randint(1, 2047) for _ in range(2000)]
    windows, rest = P.packed_windows(pieces(lengths))
    assert all(sum(p.length for p in w) in P.SIZES for w in windows)
    assert all(P.size_of(max(p.length for p in w)) == sum(p.length for p in w) for w in windows)
    assert sum(p.length for w in [*windows, rest] for p in w) == sum(lengths)
    assert sum(map(len, windows)) + len(rest) <= len(lengths) + len(windows)
    tail = P.cut_at_powers(pieces([5, 0, 9, 70]))
    assert [sum(p.length for p in w) for w in tail] == [64, 16, 4]
    assert P.packed_windows([]) == ([], [])


def test_step_groups_cost_alike():
    rng = random.Random(2)
    windows = [w for w in P.packed_windows(pieces([rng.randint(1, 2047) for _ in range(6000)]))[0] if sum(p.length for p in w) == 2048]
    groups = list(P.step_groups(windows[: len(windows) // 16 * 16], 16))
    costs = [sum(p.length**2 for w in g for p in w) for g in groups]
    assert {len(g) for g in groups} == {16} and max(costs) < 1.1 * min(costs)


def test_steps_hold_one_size(spark):
    rows = llm_queries()["op12_packing"](spark, SMALL).collect()
    steps = {}
    for r in rows:
        steps.setdefault(r["step_id"], {})[r["sequence_id"]] = r["sequence_length"]
    assert all(len(set(s.values())) == 1 and sum(s.values()) <= P.STEP_TOKENS for s in steps.values())
    with pytest.raises(ValueError, match="powers of two"):
        P.pack_documents(spark.createDataFrame([], ROWS), "x", sizes=(2000,))
