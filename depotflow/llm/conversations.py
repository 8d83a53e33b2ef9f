"""Repair of conversation structure by the cheapest edits.

A sound conversation is an optional system turn and then pairs of a user's and an assistant's
turn, or nothing at all. Rows are kept, given another role or deleted, and empty rows inserted,
at least cost; among edits of equal cost the audit, one letter per edit, is the least one.

Cost and audit are one integer. Its high digits are the cost, its low digits the letters of the
audit at fixed places, the first letter highest and zeros behind the last, so that the least
integer is the cheapest repair and, of several, the one with the least audit. A conversation is
then the shortest path through rows and the four states of what has been kept so far.

Rows are dealt out by range over (conversation, turn, role, text), so that a conversation of any
length is spread over many tasks. One that lies within a task and a piece of rows is solved there.
Others are solved piece by piece: every piece gives the integers from each state to each state;
the pieces of a conversation are then joined in order, where one more digit, the rank of what
came before, stands between cost and letters. Two audits that end with a row in different states
differ before either ends, so that rank decides what the letters of earlier pieces would.

Handling of odd input: a NULL id is a conversation of its own; a NULL role or text is one space;
turns that are NULL come first; rows of one turn go by role and text; rows that are equal in all
are repeats. Other columns are ignored. Empty input gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotflow.llm.common import stash

#: Rows that are solved at once; longer conversations are joined from pieces.
PIECE_ROWS = 256

# --- fixed values: the letters of edits as digits, and what edits cost ---------------------------

DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
LETTERS = " DIKR"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5

# --- states: nothing yet, after the system, after a user, after an assistant -----------------------

EMPTY, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_INITIAL = {"s": 1, "u": 2, "a": 3}

# A row's code: its initial (0 to 3) and four times its fault.
SOUND, TRUNCATED, BLANK, DUPLICATE = range(4)
_SPACE = " \t\n\x0b\x0c\r"

_DIGIT_BITS = 3
Path = tuple[int, int]  # the integer so far, and how many letters it holds


def _kept_state(state: int, initial: int) -> int | None:
    """Where keeping a row with this initial leads, if anywhere."""
    if state == EMPTY and initial == 1:
        return SYSTEM
    wanted = _NEXT[state]
    return wanted if initial == (2 if wanted == USER else 3) else None


class _Weights:
    """The integer of every edit at every place of an audit of at most ``places`` letters."""

    def __init__(self, places: int):
        self.places = places
        self.cost_shift = _DIGIT_BITS * places

    def after(self, path: Path, cost: int, letter: int) -> Path:
        value, length = path
        digit = letter << _DIGIT_BITS * (self.places - 1 - length)
        return value + (cost << self.cost_shift) + digit, length + 1


def _least(paths: dict[int, Path], state: int, path: Path) -> None:
    if state not in paths or path[0] < paths[state][0]:
        paths[state] = path


def _with_inserts(paths: dict[int, Path], weights: _Weights) -> dict[int, Path]:
    """Also what empty rows at this place reach; more than two never pay."""
    out = dict(paths)
    for state in (EMPTY, SYSTEM, ASSISTANT):
        if state in paths:
            _least(out, USER, weights.after(paths[state], INSERT_COST, INSERT))
    if USER in out:
        _least(out, ASSISTANT, weights.after(out[USER], INSERT_COST, INSERT))
    return out


def _over_row(paths: dict[int, Path], code: int, weights: _Weights) -> dict[int, Path]:
    fault, initial = divmod(code, 4)
    out: dict[int, Path] = {}
    for state, path in paths.items():
        _least(out, state, weights.after(path, DELETE_COST, DELETE))
        if fault >= BLANK:
            continue
        more = TRUNCATED_COST if fault == TRUNCATED else 0
        kept = _kept_state(state, initial)
        if kept is not None:
            _least(out, kept, weights.after(path, more, KEEP))
        _least(out, _NEXT[state], weights.after(path, more + REROLE_COST, REROLE))
    return out


def _audit(value: int, weights: _Weights) -> str:
    digits = value & ((1 << weights.cost_shift) - 1)
    letters = []
    for place in range(weights.places - 1, -1, -1):
        digit = digits >> _DIGIT_BITS * place & 7
        if not digit:
            break
        letters.append(LETTERS[digit])
    return "".join(letters)


def _least_paths(codes: bytes, start: int, last: bool) -> tuple[_Weights, dict[int, Path]]:
    weights = _Weights(3 * len(codes) + 2)
    paths: dict[int, Path] = {start: (0, 0)}
    for code in codes:
        paths = _over_row(_with_inserts(paths, weights), code, weights)
    return weights, _with_inserts(paths, weights) if last else paths


def piece_paths(codes: bytes, start: int, last: bool) -> dict[int, tuple[int, str]]:
    """For every state at the end of a piece, the cost and audit of the least path from ``start``."""
    weights, paths = _least_paths(codes, start, last)
    return {s: (value >> weights.cost_shift, _audit(value, weights)) for s, (value, _) in paths.items()}


def _as_number(audit: str, places: int) -> int:
    """The letters as digits again, with zeros behind the last."""
    value = 0
    for letter in audit:
        value = value << _DIGIT_BITS | LETTERS.index(letter)
    return value << _DIGIT_BITS * (places - len(audit))


@lru_cache(maxsize=100_000)
def repair_codes(codes: bytes) -> tuple[int, str]:
    """Cost and audit of one whole conversation."""
    weights, paths = _least_paths(codes, EMPTY, last=True)
    value = min(paths[state][0] for state in (EMPTY, ASSISTANT) if state in paths)
    return value >> weights.cost_shift, _audit(value, weights)


def join_pieces(pieces: list[dict[int, dict[int, tuple[int, str]]]]) -> tuple[int, list[tuple[int, str]]]:
    """Total cost, and for each piece the state it starts in and its audit."""
    reached: dict[int, tuple[int, int]] = {EMPTY: (0, 0)}  # state: cost, rank of the letters so far
    back: list[dict[int, tuple[int, str]]] = []
    for piece in pieces:
        places = max((len(audit) for ends in piece.values() for _, audit in ends.values()), default=0)
        rank_shift = _DIGIT_BITS * places
        found: dict[int, tuple[int, int, str]] = {}
        for start, (cost, rank) in reached.items():
            for end, (more, audit) in piece[start].items():
                tail = rank << rank_shift | _as_number(audit, places)
                whole = cost + more << rank_shift + _DIGIT_BITS | tail
                if end not in found or whole < found[end][0]:
                    found[end] = (whole, start, audit)
        low = (1 << rank_shift + _DIGIT_BITS) - 1
        order = sorted({whole & low for whole, _, _ in found.values()})
        reached = {
            end: (whole >> rank_shift + _DIGIT_BITS, order.index(whole & low)) for end, (whole, _, _) in found.items()
        }
        back.append({end: (start, audit) for end, (_, start, audit) in found.items()})
    state = min((s for s in (EMPTY, ASSISTANT) if s in reached), key=reached.__getitem__)
    total, steps = reached[state][0], []
    for pointers in reversed(back):
        start, audit = pointers[state]
        steps.append((start, audit))
        state = start
    return total, steps[::-1]


def applied(rows: list[tuple[str, str]], audit: str, state: int = EMPTY) -> list[tuple[str, str]]:
    """The rows (role, text) after the edits of an audit that begins in a state."""
    out, at = [], iter(rows)
    for letter in audit:
        if letter == "I":
            state = _NEXT[state]
            out.append((_ROLE[state], ""))
            continue
        role, text = next(at)
        if letter == "D":
            continue
        state = _NEXT[state] if letter == "R" else _kept_state(state, _INITIAL.get(role[:1], 0))
        out.append((_ROLE[state] if letter == "R" else role, text))
    return out


# --- rows ------------------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with the damage that a hash of conversation and turn deals out, for tests of repair.

    ``copies`` is how often a row is there: 0 for a dropped one, 2 for a repeated one.
    """
    space = F.lit(" ")
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space)
    )
    kind = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    return conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, F.lit(0)).when(kind == 3, F.lit(2)).otherwise(F.lit(1)).alias("copies"),
    )


def _code(role: str, text: str) -> int:
    """The code of a row by itself; whether it repeats another is not known yet."""
    end = text.rstrip(_SPACE)
    fault = BLANK if not end else SOUND if end[-1] in ".!?" else TRUNCATED
    return fault * 4 + _INITIAL.get(role[:1], 0)


def _illegal(initials: str) -> bool:
    return initials not in ("su", "ua", "au")


def _profile(turns: list[int | None], roles: list[str], codes: bytes) -> dict:
    """What is counted over rows in order, and what a neighbouring piece needs of the ends."""
    faults = [code >> 2 for code in codes]
    known = [t for t in turns if t is not None]
    return {
        "n": len(codes),
        "blank": faults.count(BLANK),
        "duplicate": faults.count(DUPLICATE),
        "truncated": faults.count(TRUNCATED),
        "illegal": sum(_illegal(a[:1] + b[:1]) for a, b in zip(roles, roles[1:])),
        "turns": len(set(known)),
        "low": known[0] if known else None,
        "high": known[-1] if known else None,
        "first": roles[0][:1] if roles else "",
        "last": roles[-1][:1] if roles else "",
    }


_COUNTS = ["blank", "duplicate", "truncated", "illegal"]
_LINES = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_WHOLE = pa.schema(
    [
        ("conv_id", pa.int64()), ("gaps", pa.int64()), *[(name, pa.int64()) for name in _COUNTS], ("cost", pa.int64()),
        ("piece", pa.int64()), ("pieces", pa.int64()), ("audit", pa.string()), ("lines", _LINES),
    ]
)
_LOOSE = pa.schema(
    [("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("code", pa.int32()), ("place", pa.int64())]
)
_WHOLE_SQL = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint,"
    " piece bigint, pieces bigint, audit string, lines array<struct<role:string,text:string>>"
)
_SOLVED_SQL = _WHOLE_SQL + ", turn bigint, role string, text string, code int, place bigint"
_GHOST = -1


def _gaps(profile: dict) -> int:
    return profile["high"] - profile["low"] + 1 - profile["turns"] if profile["turns"] else 0


def _solve_whole(conv: int | None, rows: list[tuple]) -> dict:
    """One conversation whose rows (turn, role, text, copies) are all at hand."""
    rows = [(turn, role, text) for turn, role, text, copies in rows for _ in range(copies)]
    seen: set[tuple[str, str]] = set()
    codes = bytearray()
    for _, role, text in rows:
        code = _code(role, text)
        if code >> 2 < BLANK and (role, text) in seen:
            code = DUPLICATE * 4 + code % 4
        seen.add((role, text))
        codes.append(code)
    profile = _profile([r[0] for r in rows], [r[1] for r in rows], bytes(codes))
    cost, audit = repair_codes(bytes(codes))
    lines = [{"role": r, "text": t} for r, t in applied([row[1:] for row in rows], audit)]
    return {
        "conv_id": conv, "gaps": _gaps(profile), **{name: profile[name] for name in _COUNTS},
        "cost": cost, "piece": 0, "pieces": 1, "audit": audit, "lines": lines,
    }


def _runs(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int | None, list[tuple], bool, bool]]:
    """Runs of rows of one conversation, at most ``most`` rows each, and whether a run is all
    that this task has of its conversation and neither its first nor its last one."""
    held: list[tuple] = []
    conv: int | None = None
    first, begun, at_start = True, False, True
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(5)]
        for row in zip(*columns):
            if not begun or row[0] != conv:
                if begun:
                    yield conv, held, not first and at_start, True
                    first = False
                held, conv, begun, at_start = [], row[0], True, True
            elif len(held) == most:
                yield conv, held, False, False
                held, at_start = [], False
            held.append(row[1:])
    if begun:
        yield conv, held, False, True


def _first_pass(most: int):
    """Solves the conversations that lie within a task, and passes on the rows of the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 40
        place, piece = 0, -1
        solved: list[dict] = []
        loose: list[dict] = []
        held_text = 0
        for conv, rows, whole, _ in _runs(batches, most):
            if whole:
                solved.append(_solve_whole(conv, rows))
            else:
                piece += 1
                for turn, role, text, copies in rows:
                    for copy in range(max(copies, 1)):
                        code = _code(role, text) if copies else _GHOST
                        loose.append(
                            {"conv_id": conv, "piece": part + piece, "turn": turn, "role": role, "text": text if copies else "",
                             "code": code, "place": part + place + copy}
                        )
                    place += max(copies, 1)
            held_text += sum(len(row[2]) for row in rows)
            if len(solved) + len(loose) >= 4096 or held_text > 4_000_000:
                yield _first_batch(solved, loose)
                solved, loose, held_text = [], [], 0
        if solved or loose:
            yield _first_batch(solved, loose)

    return run


_FIRST_SCHEMA = pa.schema([*_WHOLE, *_LOOSE])


def _first_batch(solved: list[dict], loose: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(solved + loose, _FIRST_SCHEMA)


# --- conversations in pieces -----------------------------------------------------------------------


def _piece_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least paths through each piece from every state, beside its profile."""
    for batch in batches:
        out = []
        for conv, piece, rows in zip(*(batch.column(i).to_pylist() for i in range(3))):
            rows = [row for row in rows if row["code"] != _GHOST]
            codes = bytes(row["code"] for row in rows)
            profile = _profile([r["turn"] for r in rows], [r["role"] for r in rows], codes)
            paths = [
                {"start": start, "end": end, "cost": cost, "audit": audit}
                for start in range(4)
                for end, (cost, audit) in piece_paths(codes, start, last=False).items()
            ]
            out.append({"conv_id": conv, "piece": piece, "paths": paths, **profile})
        yield pa.RecordBatch.from_pylist(out, _PIECE_SCHEMA)


_PIECE_SCHEMA = pa.schema(
    [
        ("conv_id", pa.int64()), ("piece", pa.int64()),
        ("paths", pa.list_(pa.struct([("start", pa.int8()), ("end", pa.int8()), ("cost", pa.int64()), ("audit", pa.string())]))),
        *[(name, pa.int64()) for name in ("n", *_COUNTS, "turns", "low", "high")], ("first", pa.string()), ("last", pa.string()),
    ]
)
_PIECE_SQL = (
    "conv_id bigint, piece bigint, paths array<struct<start:tinyint,end:tinyint,cost:bigint,audit:string>>,"
    " n bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint, low bigint, high bigint,"
    " first string, last string"
)
_EDIT_SCHEMA = pa.schema([*list(_WHOLE)[:7], ("piece", pa.int64()), ("number", pa.int64()), ("pieces", pa.int64()),
                          ("audit", pa.string()), ("state", pa.int8())])
_EDIT_SQL = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint,"
    " piece bigint, number bigint, pieces bigint, audit string, state tinyint"
)


def _joined_conversation(conv: int | None, found: list[dict]) -> list[dict]:
    """The edits of every piece of one conversation, and its totals."""
    total = {name: sum(piece[name] for piece in found) for name in (*_COUNTS, "turns")}
    rows = [piece for piece in found if piece["n"]]
    for left, right in zip(rows, rows[1:]):
        total["illegal"] += _illegal(left["last"] + right["first"])
    dated = [piece for piece in rows if piece["turns"]]
    total["turns"] -= sum(left["high"] == right["low"] for left, right in zip(dated, dated[1:]))
    total["low"], total["high"] = (dated[0]["low"], dated[-1]["high"]) if dated else (None, None)
    paths = []
    for piece in found:
        by_start: dict[int, dict[int, tuple[int, str]]] = {}
        for path in piece["paths"]:
            by_start.setdefault(path["start"], {})[path["end"]] = (path["cost"], path["audit"])
        paths.append(by_start)
    closing = {start: piece_paths(b"", start, last=True) for start in range(4)}
    cost, steps = join_pieces([*paths, closing])
    state_at_end, last_audit = steps.pop()
    out = []
    for number, (piece, (state, audit)) in enumerate(zip(found, steps)):
        out.append(
            {"conv_id": conv, "gaps": _gaps(total), **{name: total[name] for name in _COUNTS}, "cost": cost, "piece": piece["piece"],
             "number": number, "pieces": len(found), "audit": audit, "state": state}
        )
    out[-1]["audit"] += last_audit
    return out


def _edit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins the pieces of each conversation; they come sorted."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0]["conv_id"] != row["conv_id"]:
                yield pa.RecordBatch.from_pylist(_joined_conversation(held[0]["conv_id"], held), _EDIT_SCHEMA)
                held = []
            held.append(row)
    if held:
        yield pa.RecordBatch.from_pylist(_joined_conversation(held[0]["conv_id"], held), _EDIT_SCHEMA)


def _repair_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of each piece after its edits."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            rows = [(r["role"], r["text"]) for r in row.pop("rows") if r["code"] != _GHOST]
            row["lines"] = [{"role": r, "text": t} for r, t in applied(rows, row["audit"], row.pop("state"))]
            row["piece"] = row.pop("number")
            out.append(row)
        yield pa.RecordBatch.from_pylist(out, _WHOLE)


def _repaired_pieces(loose: DataFrame) -> DataFrame:
    """Conversations that were cut by the edge of a task or a piece."""
    loose = loose.select("conv_id", "piece", "turn", "role", "text", "code", "place")
    keyed = loose.withColumn("digest", F.md5("text"))
    firsts = (
        keyed.filter("code >= 0")
        .groupBy(F.col("conv_id").alias("of_conv"), F.col("role").alias("of_role"), F.col("digest").alias("of_digest"))
        .agg(F.min("place").alias("first_place"))
    )
    same = F.expr("conv_id <=> of_conv AND role = of_role AND digest = of_digest")
    fault, initial = F.shiftright("code", 2), F.col("code") % 4
    repeats = (F.col("code") >= 0) & (fault < BLANK) & (F.col("place") > F.col("first_place"))
    rows = keyed.join(firsts, same, "left").select(
        "conv_id", "piece", "turn", "role", "text", "place",
        F.when(repeats, initial + 4 * DUPLICATE).otherwise(F.col("code")).cast("int").alias("code"),
    )
    pieces = stash(
        rows.groupBy("conv_id", "piece").agg(
            F.sort_array(F.collect_list(F.struct("place", "turn", "code", "role", "text"))).alias("rows")
        ),
        "conversation-pieces",
    )
    brief = pieces.select(
        "conv_id", "piece", F.transform("rows", lambda r: F.struct(r["turn"].alias("turn"), r["code"].alias("code"),
                                                                  F.substring(r["role"], 1, 1).alias("role"))).alias("rows")
    )
    edits = (
        brief.mapInArrow(_piece_batches, _PIECE_SQL)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "piece")
        .mapInArrow(_edit_batches, _EDIT_SQL)
    )
    return (
        edits.join(pieces.select("piece", "rows"), "piece")
        .select(*[f.name for f in _WHOLE if f.name not in ("piece", "lines")], "number", "state", "rows")
        .mapInArrow(_repair_batches, _WHOLE_SQL)
    )


def repair_conversations(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Conversations after the cheapest repair, one row per conversation or piece of a long one.

    ``rows`` has conv_id, turn, role, text and copies (how often a row is there; 0 names a
    conversation without adding a row). Returned are ``lines`` (role and text after the repair) and
    ``audit`` of each piece in the order of ``piece``, of ``pieces``, and the totals of its
    conversation: ``gaps`` in turns, ``blank``, ``duplicate`` and ``truncated`` rows, ``illegal``
    neighbours before the repair, and ``cost``.
    """
    salt = F.rand(7)  # parts rows that are equal in all; their order does not matter
    dealt = rows.select("conv_id", "turn", "role", "text", "copies").withColumn("salt", salt)
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "salt"]
    sorted_rows = dealt.repartitionByRange(*order).sortWithinPartitions(*order).drop("salt")
    found = stash(sorted_rows.mapInArrow(_first_pass(piece_rows), _SOLVED_SQL), "conversations")
    whole = found.filter("place IS NULL").select(*_WHOLE.names)
    return whole.unionByName(_repaired_pieces(found.filter("place IS NOT NULL")))


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces as one row per conversation; its lines are read once and never held."""
    held: dict | None = None
    digest = hashlib.sha256()
    audits: list[str] = []

    def closed() -> pa.RecordBatch:
        row = {**held, "audit": "".join(audits), "repaired_sha256": digest.hexdigest()}
        return pa.RecordBatch.from_pylist([row], _DIGEST_SCHEMA)

    for batch in batches:
        for row in batch.to_pylist():
            if held is None or held["conv_id"] != row["conv_id"]:
                if held is not None:
                    yield closed()
                held, digest, audits, begun = row, hashlib.sha256(), [], False
            audits.append(row["audit"])
            for line in row["lines"]:
                digest.update(("\n" * begun + f"{line['role']}:{line['text']}").encode("utf-8", "surrogatepass"))
                begun = True
    if held is not None:
        yield closed()


_DIGEST_SCHEMA = pa.schema([*list(_WHOLE)[:7], ("audit", pa.string()), ("repaired_sha256", pa.string())])
_DIGEST_SQL = _WHOLE_SQL.split(" piece ")[0] + " audit string, repaired_sha256 string"


def repair_digests(repaired: DataFrame) -> DataFrame:
    """One row per conversation: its totals, whole audit and the SHA-256 of its repaired lines.

    The lines of a conversation in pieces pass through one task in order, as a hash needs them.
    """
    text = F.array_join(F.transform("lines", lambda line: F.concat(line["role"], F.lit(":"), line["text"])), "\n")
    names = [name for name in _DIGEST_SCHEMA.names if name != "repaired_sha256"]
    short = repaired.filter("pieces = 1").select(*names, F.sha2(text.cast("binary"), 256).alias("repaired_sha256"))
    long = (
        repaired.filter("pieces > 1")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "piece")
        .mapInArrow(_digest_batches, _DIGEST_SQL)
    )
    return short.unionByName(long)
