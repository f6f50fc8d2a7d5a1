"""Conversation structure repair: the cheapest edits that make a conversation well formed.

A well-formed conversation is empty, or turns of user and assistant in turn,
user first and assistant last, after at most one system turn. Roles count by
their first letter. The search sees one code letter per turn, never a text; the
texts pass by it as a stream, in order, so a conversation need not fit in memory.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What an edit costs, and white space.
KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 3, 4, 3, 3
SPACES = " \t\n\x0b\x0c\r"
LEGAL = ("su", "ua", "au")

# What stands last: nothing yet, a system, a user or an assistant turn.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
MAY_END = (True, False, False, True)
# The one state, and role, that an inserted or rewritten turn can lead to.
MADE = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
MUST_GO = "x"

REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
COUNTS = [field.split()[0] for field in REPORT.split(", ")]
LARGEST = 2**63 - 1
REMEMBERED = 64
ROWS_OUT = 2_000


def damage(turns: DataFrame) -> DataFrame:
    """Test damage: (conv_id, turn, role, text, present), by crc32 of ``conv_id:turn`` modulo 20.

    0 drops a row, 1 empties its text, 2 takes its ``.!?`` away, 3 repeats it and
    4 makes it the user's. Nulls, in the hashed text as well, are one space; a
    null turn stays null for the order. A dropped row stays with ``present``
    false, so that its conversation is still named.
    """
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    copies = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    marked = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind"))
    return marked.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind").isin(0, 1), F.lit(""))
        .when(F.col("kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        (F.col("kind") != 0).alias("present"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def _suffix_bounds(codes: str) -> list[tuple[int, int, int, int]]:
    """From each turn and state, the least that the rest can cost; which audit is least is left open."""

    def with_inserts(plain: list[int]) -> tuple[int, int, int, int]:
        user = min(plain[USER], INSERT + plain[ASSISTANT])
        assistant = min(plain[ASSISTANT], INSERT + plain[USER])
        by_user = INSERT + user
        return min(plain[NOTHING], by_user), min(plain[SYSTEM], by_user), user, assistant

    far = (len(codes) + 3) * (DELETE + UNFINISHED)
    bounds = [with_inserts([0 if end else far for end in MAY_END])]
    for code in reversed(codes):
        rest = bounds[-1]
        plain = [DELETE + r for r in rest]
        if code != MUST_GO:
            extra = UNFINISHED if code.isupper() else 0
            for state in range(4):
                kept = NEXT[state].get(code.lower())
                if kept is not None:
                    plain[state] = min(plain[state], KEEP + extra + rest[kept])
                plain[state] = min(plain[state], REROLE + extra + rest[MADE[state]])
        bounds.append(with_inserts(plain))
    return bounds[::-1]


# An audit is a chain of (what went before, letter, length); audits with the same start share it.
Audit = tuple["Audit", str, int] | None


def _compare(one: Audit, other: Audit) -> int:
    """-1, 0 or 1 as the first audit stands before the other; 0 where the shorter one begins the longer one."""
    while one is not None and (other is None or one[2] > other[2]):
        one = one[0]
    while other is not None and (one is None or other[2] > one[2]):
        other = other[0]
    order = 0
    while one is not other:
        if one[1] != other[1]:
            order = -1 if one[1] < other[1] else 1
        one, other = one[0], other[0]
    return order


def _spelled(audit: Audit) -> str:
    letters = []
    while audit is not None:
        letters.append(audit[1])
        audit = audit[0]
    return "".join(reversed(letters))


def cheapest_edits(codes: str) -> tuple[int, str]:
    """The least cost and, among the edits of that cost, the audit that is least by its letters.

    ``codes`` has a letter per turn: s, u or a for a role's first letter and o
    for any other, in capitals where the text is unfinished; x must go. An audit
    has a letter per edit in order: Keep, Rerole, Delete, Insert.

    Depth-first branch and bound. A node is how many turns are settled and what
    stands last. A prefix is cut off where its cost and the bound of the rest
    exceed the incumbent, where they equal it and its audit already stands behind
    the incumbent's, or where the node was reached with a better cost and audit.
    Prefixes that reach a node at the same cost settle the same turns with the
    same number of inserts, so none of them begins another. When the stack is
    empty, the incumbent is the best.
    """
    bounds = _suffix_bounds(codes)
    best: dict[tuple[int, int], tuple[int, Audit]] = {}
    incumbent: tuple[int, Audit] | None = None
    line: list[Audit] = []  # the incumbent's audit, cut after each letter
    stack: list[tuple[int, int, int, Audit]] = [(0, NOTHING, 0, None)]
    while stack:
        turn, state, cost, audit = stack.pop()
        if incumbent is not None:
            least = cost + bounds[turn][state]
            if least > incumbent[0]:
                continue
            if least == incumbent[0] and _compare(audit, line[min(audit[2], len(line) - 1)]) > 0:
                continue
        seen = best.get((turn, state))
        if seen is not None and (seen[0] < cost or (seen[0] == cost and _compare(seen[1], audit) <= 0)):
            continue
        best[turn, state] = (cost, audit)
        if turn == len(codes) and MAY_END[state]:
            if incumbent is None or cost < incumbent[0] or _compare(audit, incumbent[1]) < 0:
                incumbent, line = (cost, audit), [audit]
                while line[-1] is not None:
                    line.append(line[-1][0])
                line.reverse()
            continue
        steps = [(turn, MADE[state], INSERT, "I")]
        if turn < len(codes):
            steps.append((turn + 1, state, DELETE, "D"))
            if codes[turn] != MUST_GO:
                extra = UNFINISHED if codes[turn].isupper() else 0
                kept = NEXT[state].get(codes[turn].lower())
                if kept is not None:
                    steps.append((turn + 1, kept, KEEP + extra, "K"))
                steps.append((turn + 1, MADE[state], REROLE + extra, "R"))
        length = 1 if audit is None else audit[2] + 1
        # the most promising step comes last, as the stack gives it back first
        steps.sort(key=lambda s: (s[2] + bounds[s[0]][s[1]], s[3]), reverse=True)
        stack.extend((t, s, cost + price, (audit, letter, length)) for t, s, price, letter in steps)
    return incumbent[0], _spelled(incumbent[1])


_remembered_edits = functools.lru_cache(maxsize=50_000)(cheapest_edits)


def _in_order(turns: DataFrame) -> DataFrame:
    """Turns with what the search needs of them; every row of a conversation in one partition, in order."""
    trimmed = F.rtrim("text", F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))
    return turns.select(
        "conv_id",
        "turn",
        "role",
        "text",
        "present",
        F.when(F.col("present"), F.when(trimmed == "", MUST_GO).when(F.right(trimmed, F.lit(1)).isin(".", "!", "?"), known).otherwise(F.upper(known))).alias("code"),
        known.alias("initial"),
        F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)).alias("alike"),
    )


def _defaults(turns: DataFrame) -> DataFrame:
    present = F.coalesce("present", F.lit(False)) if "present" in turns.columns else F.lit(True)
    return turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), present.alias("present"))


class _Counts:
    """What is known of one conversation while its rows go by."""

    def __init__(self):
        self.codes, self.seen, self.initials, self.turn = bytearray(), set(), "", None
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = None

    def add(self, turn: int | None, code: str, initial: str, alike: bytes) -> None:
        if turn is not None and turn != self.turn:
            self.first = turn if self.first is None else self.first
            self.turn, self.turns = turn, self.turns + 1
        if self.codes:
            self.illegal += self.initials + initial not in LEGAL
        self.initials = initial
        if code == MUST_GO:
            self.blank += 1
        elif alike in self.seen:
            self.duplicate += 1
            code = MUST_GO
        else:
            self.truncated += code.isupper()
            self.seen.add(alike)
        self.codes += code.encode()

    def report(self) -> tuple:
        codes = self.codes.decode()
        cost, audit = (_remembered_edits if len(codes) <= REMEMBERED else cheapest_edits)(codes)
        gaps = 0 if self.first is None else min(self.turn - self.first + 1 - self.turns, LARGEST)
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def repair_report(turns: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation.

    ``turns`` has conv_id, turn, role, text and, if it likes, ``present``; rows
    where that is false or null only name their conversation, and other columns
    are ignored. A null role or text is one space, a null conv_id a conversation.
    Rows are taken by turn, nulls first, then by role and text. A row's first
    fault counts: blank, duplicate (role and text seen earlier), truncated (does
    not end in ``.!?``). ``gaps`` is the number of turn numbers missing between
    the least and the largest, and stops at 2**63 - 1.

    The rows of a conversation are read in order by one task, which holds a code
    and a digest of each, not the texts: the audit is one text by its nature. An
    empty table gives no rows, very long texts are read like any other.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    order = ["conv_id", "turn", "role", "text"]
    rows = _in_order(_defaults(turns)).repartition("conv_id").sortWithinPartitions(*order)

    def examine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, conversation, out, id_type = None, None, [], pa.null()

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out))
            types = [id_type, *[pa.int64()] * 6, pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["conv_id", *COUNTS])

        for part in batches:
            id_type = part.column(0).type
            for conv_id, turn, present, code, initial, alike in zip(*(c.to_pylist() for c in part.columns)):
                if counts is None or conv_id != conversation:
                    if counts is not None:
                        out.append((conversation, *counts.report()))
                    counts, conversation = _Counts(), conv_id
                if present:
                    counts.add(turn, code, initial, alike)
            if len(out) >= ROWS_OUT:
                yield batch()
                out = []
        if counts is not None:
            out.append((conversation, *counts.report()))
            yield batch()

    return rows.select("conv_id", "turn", "present", "code", "initial", "alike").mapInArrow(examine, f"conv_id {kind}, {REPORT}")


def _with_reports(turns: DataFrame, reports: DataFrame) -> DataFrame:
    """Each conversation's report, then its rows in order, in one partition."""
    rows = _defaults(turns).where("present").drop("present")
    empty = {c: F.lit(None).cast(reports.schema[c].dataType) for c in COUNTS}
    heads = reports.select("conv_id", *COUNTS).withColumns({"turn": F.lit(None).cast(rows.schema["turn"].dataType), "role": F.lit(None).cast("string"), "text": F.lit(None).cast("string"), "later": F.lit(False)})
    both = heads.unionByName(rows.withColumns({**empty, "later": F.lit(True)}))
    order = ["conv_id", "later", "turn", "role", "text"]
    return both.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "later", *COUNTS, "role", "text")


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Replays the audits: (row of the report, None) where a conversation begins, then (None, (edit, role, text)) per turn left."""
    audit, at, state = "", 0, NOTHING

    def inserts() -> Iterator[tuple]:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            state, at = MADE[state], at + 1
            yield None, ("I", ROLES[state], "")

    for batch in batches:
        for conv_id, later, *counts, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if not later:
                yield from inserts()
                audit, at, state = counts[-1], 0, NOTHING
                yield (conv_id, *counts), None
                continue
            yield from inserts()
            edit = audit[at]
            at += 1
            if edit == "K":
                state = NEXT[state][role[0]]
                yield None, (edit, role, text)
            elif edit == "R":
                state = MADE[state]
                yield None, (edit, ROLES[state], text)
    yield from inserts()


def repaired_turns(turns: DataFrame, reports: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): the turns that are left, rewritten or inserted, ``place`` from 0.

    ``reports`` is the ``repair_report`` of the same turns, stored or worked out
    again. Each conversation passes through a task as a stream.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size, conversation, place, id_type = [], 0, None, 0, pa.null()

        def typed(batches):
            nonlocal id_type
            for batch in batches:
                id_type = batch.column(0).type
                yield batch

        def batch() -> pa.RecordBatch:
            types = [id_type, pa.int64(), pa.string(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["conv_id", "place", "edit", "role", "text"])

        for head, turn in _repaired(typed(batches)):
            if head is not None:
                conversation, place = head[0], 0
                continue
            out.append((conversation, place, *turn))
            place, size = place + 1, size + len(turn[2])
            if len(out) >= ROWS_OUT or size > 2_000_000:
                yield batch()
                out, size = [], 0
        if out:
            yield batch()

    return _with_reports(turns, reports).mapInArrow(write, f"conv_id {kind}, place long, edit string, role string, text string")


def digest(turns: DataFrame, reports: DataFrame) -> DataFrame:
    """The reports with ``repaired_sha256``: of the repaired ``role:text``, joined by newlines."""
    kind = turns.schema["conv_id"].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, report, sha, first, id_type = [], None, None, True, pa.null()

        def typed(batches):
            nonlocal id_type
            for batch in batches:
                id_type = batch.column(0).type
                yield batch

        def batch() -> pa.RecordBatch:
            types = [id_type, *[pa.int64()] * 6, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["conv_id", *COUNTS, "repaired_sha256"])

        for head, turn in _repaired(typed(batches)):
            if head is not None:
                if report is not None:
                    out.append((*report, sha.hexdigest()))
                    if len(out) >= ROWS_OUT:
                        yield batch()
                        out = []
                report, sha, first = head, hashlib.sha256(), True
                continue
            sha.update(f"{'' if first else chr(10)}{turn[1]}:{turn[2]}".encode())
            first = False
        if report is not None:
            out.append((*report, sha.hexdigest()))
            yield batch()

    return _with_reports(turns, reports).mapInArrow(write, f"conv_id {kind}, {REPORT}, repaired_sha256 string")


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(repaired turns, reports) of ``turns``."""
    reports = repair_report(turns)
    return repaired_turns(turns, reports), reports
