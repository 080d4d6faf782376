"""Repairs of conversations against an enumeration of all edits and a full chart."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from ledgerloom.llm import conversations as c

SCHEMA = "conv_id long, turn long, role string, text string, conv string, copies int, present string, part int"
FORM = re.compile("(s?(ua)+)?")


def slow_rows(rows):
    """(turn, role, text, fault) in order."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    out, seen = [], set()
    for t, r, x in rows:
        body = x.strip(c.SPACES)
        fault = "blank" if not body else "duplicate" if (r, x) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((r, x))
        out.append((t, r, x, fault))
    return out


def every_repair(rows):
    """All (cost, audit, repaired) with at most two insertions at a place: row by row, without states."""
    found = [(0, "", (), "")]
    inserts = [x for n in range(3) for x in itertools.product(("user", "assistant"), repeat=n)]
    for step in [*rows, None]:
        more = []
        for cost, audit, done, initials in found:
            for put in inserts:
                start = (cost + 3 * len(put), audit + "I" * len(put), done + tuple(f"{p}:" for p in put), initials + "".join(p[0] for p in put))
                if step is None:
                    more.append(start)
                    continue
                _, role, text, fault = step
                k, a, d, i = start
                more.append((k + 4, a + "D", d, i))
                if fault not in ("blank", "duplicate"):
                    k += 3 * (fault == "truncated")
                    more.append((k, a + "K", d + (f"{role}:{text}",), i + (role[:1] or "?")))
                    more += [(k + 3, a + "R", d + (f"{new}:{text}",), i + new[0]) for new in ("user", "assistant")]
        found = [x for x in more if FORM.fullmatch(x[3]) or re.fullmatch("s?(ua)*u?", x[3])]
        best = {}
        for x in found:  # equal ends go on in the same ways
            key = (x[3][-1:], x[3][:1] == "s" and len(x[3]) == 1)
            if key not in best or x[:2] < best[key][:2]:
                best[key] = x
        found = list(best.values()) if step is not None and len(rows) > 4 else found
    return min(x for x in found if FORM.fullmatch(x[3]))


def slow_report(rows):
    rows = slow_rows(rows)
    turns = [r[0] for r in rows if r[0] is not None]
    initials = [r[1][:1] for r in rows]
    count = [sum(r[3] == f for r in rows) for f in ("blank", "duplicate", "truncated")]
    cost, audit, done, _ = every_repair(rows)
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return (gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(done).encode()).hexdigest())


def talk(rng, n):
    rows, role = [], rng.choice(["system", "user"])
    for i in range(n):
        rows.append((i + rng.choice([0, 0, 0, 1, 2**60]) if rng.random() > 0.1 else None, role if rng.random() > 0.1 else rng.choice(["tool", "", None, "system", "user"]),
                     rng.choice(["Well. ", "So be it!\n", "cut off", "", None, " \t", f"Number {rng.randint(0, 9)}?"])))
        role = {"system": "user", "user": "assistant", "assistant": "user"}[role]
    return rows + [r for r in rows if rng.random() < 0.15]


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(11)
    found = {i: talk(rng, rng.choice([0, 1, 1, 2, 3, 4, 6])) for i in range(150)}
    found[None] = talk(rng, 5)
    found[900] = talk(rng, 80) + [(3, "user", "again and again")] * 60 + [(4, "assistant", "")] * 20
    return {k: v for k, v in found.items() if v}


@pytest.mark.parametrize("long_rows, long_bytes", [(c.LONG_ROWS, c.LONG_BYTES), (3, 1 << 20)])
def test_equals_all_edits(spark, talks, long_rows, long_bytes):
    rows = [(i, *r, "x", 1, "p", 2) for i, found in talks.items() for r in found]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = {r.conv_id: tuple(r)[1:] for r in c.repair_report(df, long_rows, long_bytes).collect()}
    assert got == {i: slow_report(found) for i, found in talks.items()}
    turns = {}
    for r in c.repair(df, long_rows, long_bytes).collect():
        turns.setdefault(r.conv_id, []).append((r.position, r.role, r.text, r.edit))
    for i, found in talks.items():
        kept = sorted(turns.get(i, []))
        assert [x[0] for x in kept] == list(range(len(kept)))
        assert FORM.fullmatch("".join(x[1][0] for x in kept))
        assert hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t, _ in kept).encode()).hexdigest() == got[i][-1]
        assert "".join(x[3] for x in kept) == got[i][-2].replace("D", "")


def test_damage(spark, talks):
    rows = [(i, *r, "x", 1, "p", 2) for i, found in talks.items() for r in found]
    df = spark.createDataFrame(rows, SCHEMA)
    expected = {i: [] for i in talks}
    for i, turn, role, text, *_ in rows:
        case = zlib.crc32(f"{' ' if i is None else i}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        role, text = "user" if case == 4 else role, "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        expected[i] += [(turn, role, text)] * {0: 0, 3: 2}.get(case, 1)
    got = {r.conv_id: tuple(r)[1:] for r in c.repair_report(c.damage(df), present_col="present").collect()}
    assert got == {i: slow_report(found) for i, found in expected.items()}
    assert any(not found for found in expected.values())  # a conversation that lost all its rows


def test_every_split_of_a_span_gives_the_same_cell():
    rng = random.Random(5)
    for _ in range(60):
        kinds = [rng.randrange(len(c.CELLS)) for _ in range(rng.randint(1, 9))]
        n, chart = len(kinds), {}
        for size in range(1, n + 1):
            for i in range(n - size + 1):
                ways = [c.combine(chart[i, k], chart[k, i + size]) for k in range(i + 1, i + size)] or [c.CELLS[kinds[i]]]
                assert all(w == ways[0] for w in ways)
                chart[i, i + size] = ways[0]
        assert c.span(bytes(kinds)) == chart[0, n]
    gone = c.NUMBER["", "blank"]
    assert c.deletions(11) == c.span(bytes([gone] * 11)) and c.deletions(0) == c.EMPTY == c.combine(c.EMPTY, c.EMPTY)


def test_many_rows_are_fast():
    kinds = bytes(random.Random(0).randrange(len(c.CELLS)) for _ in range(20_000))
    cost, audit = c.best(c.span(kinds))
    assert len(audit) - audit.count("I") == 20_000 and cost > 0


def test_empty(spark):
    assert c.repair_report(spark.createDataFrame([], SCHEMA)).collect() == []
