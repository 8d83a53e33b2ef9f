"""Repair of conversations against enumeration of all edits, whole and in pieces."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import cache

import duckdb
import pytest

from depotflow.llm import conversations as C
from depotflow.llm.queries import llm_oracles, llm_queries

SPACE = " \t\n\x0b\x0c\r"
ROWS = "conv_id bigint, turn bigint, role string, text string, place int, lines int, code string"


def cheapest(rows):
    """Least (cost, audit, lines) of rows (role, text, fault), over all edits from each state on."""

    @cache
    def best(i, state, inserted):
        found = [(0, "", ())] if i == len(rows) and state in ("", "a") else []

        def through(cost, letter, line, j, into, k):
            rest = best(j, into, k)
            if rest is not None:
                found.append((cost + rest[0], letter + rest[1], line + rest[2]))

        wanted = "a" if state == "u" else "u"
        role = {"u": "user", "a": "assistant"}[wanted]
        if inserted < 3:
            through(5, "I", ((role, ""),), i, wanted, inserted + 1)
        if i < len(rows):
            given, text, fault = rows[i]
            through(2, "D", (), i + 1, state, 0)
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                if given[:1] == wanted or (given[:1] == "s" and state == ""):
                    through(more, "K", ((given, text),), i + 1, given[:1], 0)
                through(more + 1, "R", ((role, text),), i + 1, wanted, 0)
        return min(found, key=lambda f: f[:2]) if found else None

    return best(0, "", 0)


def expected(rows):
    """The result row of each conversation, from the definition."""
    out = {}
    for conv in {row[0] for row in rows}:
        kept = []
        for _, turn, role, text in (row for row in rows if row[0] == conv):
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            kind = zlib.crc32(key.encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            if kind == 0:
                continue
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            kept += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, judged, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}
        for _, role, text in kept:
            end = text.rstrip(SPACE)
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "" if end[-1] in ".!?" else "truncated"
            seen.add((role, text))
            counts[fault] += 1
            judged.append((role, text, fault))
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        cost, audit, lines = cheapest(judged)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest)
    return out


def found(frame):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = frame.collect()
    assert len({row["conv_id"] for row in rows}) == len(rows)
    return {row["conv_id"]: tuple(row[n] for n in names) for row in rows}


def some_rows(seed=5):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(40)]:
        turn = rng.randint(-1, 3)
        for _ in range(rng.randint(1, 9)):
            turn += rng.choice([0, 1, 1, 1, 3])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No?", "cut", "a.b", "ab.", "", " \t", None, "Ünï!  ", f"Text {turn}."])
            rows.append((conv, None if rng.random() < 0.1 else turn, role, text))
    rows += [(90, t, "user", "Again.") for t in range(30)] + [(91, 7, "user", "Same.")] * 25
    rows += [(92, t, ("user", "assistant")[t % 2], f"Line {t}." if t % 5 else "open") for t in range(60)]
    return rows


@pytest.mark.parametrize("piece", [1, 2, 3])
def test_least_integer_is_the_cheapest_least_audit(piece):
    rng = random.Random(1)
    kinds = [(i, f) for i in ("system", "user", "assistant", "tool") for f in ("", "truncated", "blank", "duplicate")]
    for _ in range(300):
        rows = [(r, "x", f) for r, f in (rng.choice(kinds) for _ in range(rng.randint(0, 7)))]
        codes = bytes(
            4 * ["", "truncated", "blank", "duplicate"].index(f) + {"s": 1, "u": 2, "a": 3}.get(r[0], 0) for r, _, f in rows
        )
        cost, audit, lines = cheapest(tuple(rows))
        assert C.repair_codes(codes) == (cost, audit)
        assert tuple(C.applied([r[:2] for r in rows], audit)) == lines
        parts = [codes[i : i + piece] for i in range(0, len(codes), piece)]
        ways = [{s: C.piece_paths(part, s, last=False) for s in range(4)} for part in parts]
        total, steps = C.join_pieces([*ways, {s: C.piece_paths(b"", s, last=True) for s in range(4)}])
        assert (total, "".join(a for _, a in steps)) == (cost, audit)


@pytest.mark.parametrize("piece_rows", [2, 256])
def test_whole_table_against_enumeration(spark, piece_rows):
    rows = some_rows()
    table = spark.createDataFrame([(*row, 1, 2, "x") for row in rows], ROWS).repartition(6)
    repaired = C.repair_conversations(C.damaged(table), piece_rows)
    assert found(C.repair_digests(repaired)) == expected(rows)
    if piece_rows == 2:
        assert {row["pieces"] > 1 for row in repaired.collect()} == {True, False}


def test_sql_agrees_on_odd_rows(spark, tmp_path):
    rows = some_rows(8)
    spark.createDataFrame([(*row, 1, 2, "x") for row in rows], ROWS).repartition(4).write.parquet(f"{tmp_path}/conversations.parquet")
    got = found(llm_queries()["op11_conversations"](spark, str(tmp_path)))
    with duckdb.connect() as duck:
        duck.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
        names = "conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256"
        want = duck.execute(f"SELECT {names} FROM ({llm_oracles()['op11_conversations']})").fetchall()
    assert got == {row[0]: tuple(row[1:]) for row in want} == expected(rows)


def test_empty_table(spark):
    assert C.repair_digests(C.repair_conversations(C.damaged(spark.createDataFrame([], ROWS)))).collect() == []
