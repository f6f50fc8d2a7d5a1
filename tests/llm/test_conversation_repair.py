import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from shelfmark.llm import conversation_repair as repair

SCHEMA = "conv_id long, turn long, role string, text string, place long, edit string, cost long, present boolean, later int"


@pytest.fixture
def turns(spark):
    """Turns with extra columns whose names the operator uses itself."""

    def make(rows):
        return spark.createDataFrame([(*r, 9, "K", 9, True, 9) for r in rows], SCHEMA)

    return make


def every_audit(codes, most):
    """All ways to edit with at most ``most`` inserts, as (cost, audit, roles)."""
    found = [(0, "", "")]
    for left in range(len(codes), -1, -1):
        for _ in range(2 if most else 0):
            found += [(c + 3, a + "I", r + new) for c, a, r in found if a.count("I") < most for new in "ua"]
        found = list(set(found))
        if not left:
            return found
        code = codes[len(codes) - left]
        grown = [(c + 4, a + "D", r) for c, a, r in found]
        if code != "x":
            extra = 3 if code.isupper() else 0
            grown += [(c + extra, a + "K", r + code.lower()) for c, a, r in found]
            grown += [(c + 3 + extra, a + "R", r + new) for c, a, r in found for new in "ua"]
        found = grown


def by_trying_all(codes):
    return min((c, a) for c, a, r in every_audit(codes, 4) if re.fullmatch("(s?(ua)+)?", r))


@pytest.mark.parametrize("size", [0, 1, 2, 3])
def test_all_short_conversations_get_the_cheapest_edits(size):
    letters = "suaoSUAOx" if size < 3 else "suaUx"
    for codes in product(letters, repeat=size):
        codes = "".join(codes)
        assert repair.cheapest_edits(codes) == by_trying_all(codes), codes


def by_table(codes):
    """Forward table over (state): the least (cost, audit), worked out without the operator."""
    def least(a, b):
        return b if a is None else a if b is None else min(a, b)

    def inserts(t):
        t = dict(t)
        for _ in range(3):
            for now, after in (("", "u"), ("s", "u"), ("a", "u"), ("u", "a")):
                if t.get(now):
                    t[after] = least(t.get(after), (t[now][0] + 3, t[now][1] + "I"))
        return t

    table = {"": (0, "")}
    for code in codes:
        table, new = inserts(table), {}
        extra = 3 if code.isupper() else 0
        for last, (cost, audit) in table.items():
            new[last] = least(new.get(last), (cost + 4, audit + "D"))
            if code == "x":
                continue
            made = "a" if last == "u" else "u"
            new[made] = least(new.get(made), (cost + 3 + extra, audit + "R"))
            if last + code.lower() in ("s", "u", "su", "ua", "au"):
                new[code.lower()] = least(new.get(code.lower()), (cost + extra, audit + "K"))
        table = new
    table = inserts(table)
    return min(table[k] for k in ("", "a") if k in table)


def test_long_conversations_get_the_cheapest_edits():
    rng = random.Random(3)
    for n in [5, 8, 13, 40, 200] * 20:
        codes = "".join(rng.choices("suaoSUAOx", [1, 6, 6, 1, 0, 2, 2, 0, 2], k=n))
        assert repair.cheapest_edits(codes) == by_table(codes), codes
    codes = "".join(rng.choices("uaUAx", k=30_000))
    cost, audit = repair.cheapest_edits(codes)
    assert (cost, audit) == by_table(codes)


def expected(rows):
    """The repaired conversations by plain Python: (counts, cost, audit, repaired turns)."""
    blank_of = lambda t: not re.search(r"[^\x20\x09-\x0D]", t)
    by_conversation = {}
    for conv_id, turn, role, text in rows:
        by_conversation.setdefault(conv_id, []).append((turn is not None, turn or 0, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv_id, found in by_conversation.items():
        codes, seen, n = "", set(), {"blank": 0, "duplicate": 0, "truncated": 0}
        found.sort(key=lambda r: (r[0], r[1], r[2].encode(), r[3].encode()))
        for _, _, role, text in found:
            initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
            if blank_of(text):
                n["blank"], initial = n["blank"] + 1, "x"
            elif (role, text) in seen:
                n["duplicate"], initial = n["duplicate"] + 1, "x"
            elif text.strip(" \t\n\x0b\x0c\r")[-1] not in ".!?":
                n["truncated"], initial = n["truncated"] + 1, initial.upper()
            seen.add((role, text))
            codes += initial
        numbers = [t for known, t, *_ in found if known]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(found, found[1:]))
        cost, audit = by_table(codes)
        rest, left, last = iter(found), [], ""
        for edit in audit:
            row = None if edit == "I" else next(rest)
            if edit != "D":
                role = row[2] if edit == "K" else "assistant" if last == "u" else "user"
                left.append((edit, role, row[3] if row else ""))
                last = role[0]
        out[conv_id] = (gaps, *n.values(), illegal, cost, audit, left)
    return out


def hostile_rows():
    rng = random.Random(5)
    texts = ["Hi.", "So?", "cut", "cut ", "done! \t\n", "", None, " \x0b\x0c", " ", "é\U0001f600.", "user:\nassistant:x.", "a" * 30_000 + "."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "User", "s"]
    rows = [
        (c if c else None, rng.choice([*range(8), None, -3]), rng.choice(roles), rng.choice(texts))
        for c in range(40)
        for _ in range(rng.randint(1, 14))
    ]
    rows += [(50, 0, "user", "Hi.")] * 30 + [(51, None, "user", " ")] * 3
    return [*rows, (52, -(2**63), "user", "Hi."), (52, 2**63 - 1, "assistant", "Ho.")]


def test_conversations_equal_plain_python_s(turns):
    rows = hostile_rows()
    table = turns(rows)
    left, reports = repair.repair(table)
    want = expected(rows)
    got = {r.conv_id: tuple(r)[1:] for r in reports.collect()}
    want_counts = {c: (min(w[0], 2**63 - 1), *w[1:7]) for c, w in want.items()}
    assert got == want_counts
    found = {}
    for r in left.orderBy("conv_id", "place").collect():
        found.setdefault(r.conv_id, []).append((r.place, r.edit, r.role, r.text))
    assert found == {c: [(i, *t) for i, t in enumerate(w[7])] for c, w in want.items() if w[7]}
    digests = {r.conv_id: r.repaired_sha256 for r in repair.digest(table, reports).collect()}
    assert digests == {c: hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in w[7]).encode()).hexdigest() for c, w in want.items()}


def test_damage_equals_plain_python_s(turns, rows):
    given = hostile_rows()
    want = []
    for conv_id, turn, role, text in given:
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind < 2 else re.sub("[.!?]", "", text) if kind == 2 else text
        want += [(conv_id, turn, "user" if kind == 4 else role, text, kind != 0)] * (2 if kind == 3 else 1)
    assert rows(repair.damage(turns(given))) == sorted(want, key=repr)


def test_rows_that_are_not_present_only_name_their_conversation(spark):
    gone = spark.createDataFrame([(1, 0, "user", "Hi.", False), (1, 4, "user", "", None)], "conv_id long, turn long, role string, text string, present boolean")
    (row,) = repair.digest(gone, repair.repair_report(gone)).collect()
    assert tuple(row) == (1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_an_empty_table_gives_no_rows(turns):
    left, reports = repair.repair(turns([]))
    assert left.collect() == [] and reports.collect() == []
    assert repair.digest(turns([]), reports).collect() == []
