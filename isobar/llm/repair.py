"""Repair of conversation structure by depth-first branch-and-bound.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``. Rows can be
kept, given another role or deleted, and empty rows inserted, each at a cost. The search
keeps an explicit stack of prefixes, cuts those that a lower bound of the remaining rows
puts beyond the incumbent (cost, audit), and one table per node, a row and a state of the
pattern, rejects prefixes that are not better than one seen there. It ends when the stack is
empty, which proves the incumbent optimal. Spark deals out and orders the conversations; a
task reads them one after the other.
"""

from __future__ import annotations

import hashlib
import re
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.common import pick

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

_WORD = re.compile(r"[^\x20\x09-\x0D]")
_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
_LEGAL = {"su", "ua", "au"}
#: States of the pattern: nothing yet, after s, after u, after a; the first and last may end.
_START, _S, _U, _A = range(4)
_NEXT = {(_START, "s"): _S, (_START, "u"): _U, (_S, "u"): _U, (_U, "a"): _A, (_A, "u"): _U}
_ENDS = (_START, _A)
_ROLES = {"u": "user", "a": "assistant"}
_FAR = 1 << 60
_OUT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string, repaired array<struct<role: string, text: string>>"


def faults(rows: list[tuple[str, str]]) -> list[str]:
    """Per (role, text) its first fault: blank, duplicate, truncated or none ('')."""
    seen, out = set(), []
    for role, text in rows:
        key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
        if not _WORD.search(text):
            out.append("blank")
        elif key in seen:
            out.append("duplicate")
        else:
            out.append("" if text.rstrip(_SPACE)[-1] in ".!?" else "truncated")
        seen.add(key)
    return out


def _edits(initial: str, fault: str, state: int):
    """(letter, cost, next state) of what may happen to a row, in the letters' order."""
    late = TRUNCATED if fault == "truncated" else 0
    yield "D", DELETE, state
    if fault not in ("blank", "duplicate"):
        kept = _NEXT.get((state, initial)) if initial else state
        if kept is not None:
            yield "K", late, kept
        for to in "ua":
            if (state, to) in _NEXT:
                yield "R", REROLE + late, _NEXT[state, to]


def _inserts(state: int):
    return [_NEXT[state, to] for to in "ua" if (state, to) in _NEXT]


def bounds(rows: list[tuple[str, str]]) -> list[list[int]]:
    """Per node (row, state) a cost that no completion is below, from the last row back. The
    order of the letters, by which equal costs are decided, is left to the search."""
    out = [[_FAR] * 4 for _ in range(len(rows) + 1)]
    for state in _ENDS:
        out[-1][state] = 0
    for i in range(len(rows), -1, -1):
        here = out[i]
        if i < len(rows):
            for state in range(4):
                here[state] = min(cost + out[i + 1][to] for _, cost, to in _edits(*rows[i], state))
        for _ in range(2):  # two inserts lead from any state to any other that inserts reach
            for state in range(4):
                here[state] = min([here[state], *(INSERT + here[to] for to in _inserts(state))])
    return out


def cheapest(rows: list[tuple[str, str]]) -> tuple[int, str]:
    """Cost and audit of the best edits of rows (role initial, fault), ties ASCII-least.

    A prefix is known by its letters alone: they fix its cost, and at one node, where the
    same rows are used up, none is the beginning of another of equal cost. So the lesser
    (cost, letters) of two prefixes stays the lesser whatever follows. Prefixes are chains
    of (letter, chain before, length)."""
    least, n = bounds(rows), len(rows)
    best: tuple[int, str] | None = None
    table: dict[tuple[int, int], tuple[int, tuple | None]] = {}
    stack: list[tuple[int, int, int, tuple | None]] = [(0, _START, 0, None)]
    while stack:
        i, state, cost, chain = stack.pop()
        if best is not None and cost + least[i][state] > best[0]:
            continue
        known = table.get((i, state))
        if known is not None and (known[0] < cost or known[0] == cost and not _before(chain, known[1])):
            continue
        table[i, state] = (cost, chain)
        if i == n and state in _ENDS:
            found = (cost, _letters(chain))
            best = found if best is None or found < best else best
        steps = [("I", INSERT, to, i) for to in _inserts(state)]
        if i < n:
            steps += [(letter, more, to, i + 1) for letter, more, to in _edits(*rows[i], state)]
        if best is None:  # towards the incumbent first: the bound's promise, then the letter
            steps.sort(key=lambda s: (s[1] + least[s[3]][s[2]], s[0]), reverse=True)
        else:
            steps.sort(key=lambda s: s[0], reverse=True)
        for letter, more, to, at in steps:
            if least[at][to] < _FAR and (best is None or cost + more + least[at][to] <= best[0]):
                stack.append((at, to, cost + more, (letter, chain, chain[2] + 1 if chain else 1)))
    return best


def _letters(chain: tuple | None, stop: tuple | None = None) -> str:
    out = []
    while chain is not stop:
        out.append(chain[0])
        chain = chain[1]
    return "".join(reversed(out))


def _before(a: tuple | None, b: tuple | None) -> bool:
    """Whether the letters of ``a`` sort before those of ``b``: compared from where the two
    chains part, which is seldom far back."""
    x, y = a, b
    while x is not y:
        if y is None or (x is not None and x[2] > y[2]):
            x = x[1]
        elif x is None or y[2] > x[2]:
            y = y[1]
        else:
            x, y = x[1], y[1]
    return _letters(a, x) < _letters(b, x)


def repaired(rows: list[tuple[str, str]], audit: str) -> list[tuple[str, str]]:
    """The rows (role, text) after the edits; a letter's place says which role it gives."""
    n = len(audit) - audit.count("D")
    out, row = [], iter(rows)
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(row)
        if letter == "D":
            continue
        out.append((role if letter == "K" else _ROLES["ua"[(len(out) - n) % 2]], text))
    return out


def diagnose(turns: list[int | None], rows: list[tuple[str, str]]) -> dict:
    """All that is reported of one conversation, whose rows are in order."""
    found, known = faults(rows), {t for t in turns if t is not None}
    initials = [role[:1] for role, _ in rows]
    cost, audit = cheapest(list(zip(initials, found, strict=True)))
    after = repaired(rows, audit)
    return {
        "gaps": max(known) - min(known) + 1 - len(known) if known else 0,
        **{kind: found.count(kind) for kind in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:], strict=False)),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in after).encode()).hexdigest(),
        "repaired": [{"role": r, "text": t} for r, t in after],
    }


def _repair(schema: pa.Schema):
    def run(batches):
        """Rows ordered by conversation, those of one following each other."""
        out, size = [], 0
        conv, turns, rows, open_ = None, [], [], False

        def closed():
            out.append({"conv_id": conv} | diagnose(turns, rows))

        for batch in batches:
            for c, turn, role, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if open_ and c != conv:
                    closed()
                    turns, rows = [], []
                    if size > 1 << 20:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out, size = [], 0
                conv, open_ = c, True
                if role is not None:  # null: only says that the conversation is there
                    turns.append(turn)
                    rows.append((role, text))
                    size += len(text) + 64
        if open_:
            closed()
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` with the planned faults: by crc32 of ``conv_id:turn`` modulo 20 a row is
    dropped (0), emptied (1), robbed of its ``.!?`` (2), repeated (3) or said by the user
    (4). A dropped row stays with a null role, which says that its conversation exists."""
    turns = clean(turns)
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20
    role = F.when(kind == 0, F.lit(None)).when(kind == 4, F.lit("user")).otherwise(F.col("role"))
    text = F.when(kind == 0, F.lit(None)).when(kind == 1, F.lit("")).when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(kind == 3, F.lit(2)).otherwise(F.lit(1))
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), times)).alias("copy")).drop("copy")


def clean(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role and text; a null role or text is one space."""
    turns = pick(turns, conv_id="conv_id", turn="turn", role="role", text="text")
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )


def repair(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256 and repaired, its (role, text) after the edits.

    ``turns`` has conv_id, turn, role and text without null texts (see ``clean``); a row
    with a null role only says that its conversation exists. Rows go by turn (null first),
    then role and text. A row's first fault counts: blank, duplicate (role and text seen
    before) or truncated (its last character that isn't white space is none of ``.!?``). Keep
    costs 0, Rerole and Insert 3, Delete 4, which blank and duplicate rows need; truncated
    rows that stay add 3. A role that begins with neither s, u nor a can't be kept; an empty
    role has no initial and breaks no pattern. ``gaps`` counts turns missing between the
    first and the last, nulls ignored. A null conv_id is one conversation, an empty table
    has none, other columns are ignored, repeated rows are duplicates, texts may have any
    length. A conversation, one row of the result, has to fit a task."""
    struct = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    longs = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in longs], ("audit", pa.string()), ("repaired_sha256", pa.string()), ("repaired", struct)])
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(_repair(schema), _OUT)


def damage_and_repair(turns: DataFrame) -> DataFrame:
    return repair(damaged(turns)).drop("repaired")


def brute_force(rows: list[tuple[str, str]], inserts: int = 2) -> tuple[int, str]:
    """The best of all edit sequences with up to ``inserts`` inserts at each place, for
    tests over a few rows (role initial, fault)."""
    best = None
    choices = [[("D", None)] + ([("K", i), ("R", "u"), ("R", "a")] if f not in ("blank", "duplicate") else []) for i, f in rows]
    fills = [w for k in range(inserts + 1) for w in product("ua", repeat=k)]
    for done in product(*choices):
        base = sum({"D": DELETE, "K": 0, "R": REROLE}[c] + (TRUNCATED if f == "truncated" and c != "D" else 0) for (c, _), (_, f) in zip(done, rows, strict=True))
        for gaps in product(fills, repeat=len(rows) + 1):
            said, audit = "".join(gaps[0]), "I" * len(gaps[0])
            for (letter, to), gap in zip(done, gaps[1:], strict=True):
                said, audit = said + (to or "") + "".join(gap), audit + letter + "I" * len(gap)
            if re.fullmatch(r"(s?(ua)+)?", said):
                found = (base + INSERT * sum(map(len, gaps)), audit)
                best = found if best is None or found < best else best
    return best
