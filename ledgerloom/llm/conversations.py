"""Repairs the turns of conversations by weighted interval parsing of a repair grammar.

A conversation is well formed if its roles read ``(s?(ua)+)?`` (an optional system turn, then user and assistant in
turns; s, u, a are the first letters of the roles). The states of that form are: nothing yet, after the system turn,
after a user turn, after an assistant turn. A nonterminal ``pq`` of the grammar covers the ways to edit a span of rows
that lead from state p to state q; in Chomsky normal form its rules are ``pq -> pr rq`` for every state r, and ``pq ->
row`` for the edits of one row (Keep, Rerole to user or assistant, Delete). Insertions need no row: their closure is
applied on both sides of every row. A cell holds for each nonterminal the least (cost, audit); audits are the letters of
the edits. Costs are those of the audit, so two audits of one cost are never one the start of the other, and the
least audit of a span stays the least inside a longer one.

Cells are combined bottom-up by span length 1, 2, 4, ... As the closure is part of every cell and a nonterminal names
both its states, every split of a span gives the same cell, so one split is enough and a conversation of n rows takes
n - 1 combinations. That also lets a conversation beyond ``LONG_ROWS`` or ``LONG_BYTES`` be parsed by many tasks: its rows
are sorted over ranges, each range makes one cell, and neighbouring cells are combined in rounds.

Defined cases. NULL roles and texts are one space; a NULL conversation id is a conversation of its own. Rows go by turn,
NULL first, then by role and text. Blank, duplicate (role and text seen in an earlier row) and truncated (the last
letter is no ``.!?``) are looked at in this order and the first one counts. Blank and duplicate rows must be deleted;
truncated ones cost 3 more unless they are. A conversation without rows needs no edit. An empty input gives no rows.
Further columns are not looked at.

The digest of a repaired conversation is one SHA-256, which cannot be computed in parts: the rows of one conversation
then pass through one task in their order, a batch at a time, with its audit as the only thing held.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.text import crc, source_key, stored
from ledgerloom.operators.skew import left_join, small_side, total_bytes

# Fixed values of the query contract.
SPACES = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
LEGAL = {"su", "ua", "au"}

LONG_ROWS, LONG_BYTES = 4096, 16 << 20
FAN = 64  # neighbouring cells that one task of a round combines
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STEPS = {"s": [(NOTHING, SYSTEM)], "u": [(NOTHING, USER), (SYSTEM, USER), (ASSISTANT, USER)], "a": [(USER, ASSISTANT)]}
PAIRS = [(0, 0), (0, 1), (0, 2), (0, 3), (1, 1), (1, 2), (1, 3), (2, 2), (2, 3), (3, 2), (3, 3)]  # states that reach each other
RULES = [[(PAIRS.index((p, r)), PAIRS.index((r, q))) for r in range(4) if (p, r) in PAIRS and (r, q) in PAIRS] for p, q in PAIRS]

Cell = tuple  # for each pair of states (cost, audit), or None


def combine(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans."""
    return tuple(
        min(((left[a][0] + right[b][0], left[a][1] + right[b][1]) for a, b in rules if left[a] and right[b]), default=None)
        for rules in RULES
    )


def _cell(ways: Iterable[tuple[int, int, int, str]]) -> Cell:
    """The cell of (from, to, cost, audit)."""
    ways = list(ways)
    return tuple(min(((c, audit) for p, q, c, audit in ways if (p, q) == pair), default=None) for pair in PAIRS)


def _closure() -> Cell:
    """The cell of no rows: insertions only."""
    still = [(p, p, 0, "") for p in range(4)]
    one = _cell(still + [(p, q, INSERT, "I") for p, q in STEPS["u"] + STEPS["a"]])
    return combine(one, one)


EMPTY = _closure()


def _row_cells(initial: str, fault: str) -> Cell:
    ways = [(p, p, DELETE, "D") for p in range(4)]
    if fault not in ("blank", "duplicate"):
        more = TRUNCATED if fault == "truncated" else 0
        ways += [(p, q, KEEP + more, "K") for p, q in STEPS.get(initial, [])]
        ways += [(p, q, REROLE + more, "R") for p, q in STEPS["u"] + STEPS["a"]]
    return combine(combine(EMPTY, _cell(ways)), EMPTY)


KINDS = [(i, f) for i in ("s", "u", "a", "") for f in ("", "truncated", "blank")]
CELLS = [_row_cells(i, f) for i, f in KINDS]
NUMBER = {kind: n for n, kind in enumerate(KINDS)}


def kind_of(role: str, fault: str) -> int:
    """The number of the row's cell: its initial and whether it may stay."""
    initial = role[:1] if role[:1] in STEPS else ""
    return NUMBER[initial, "blank" if fault == "duplicate" else fault]


_SPANS: dict[bytes, Cell] = {}


def _short_span(kinds: bytes) -> Cell:
    if len(kinds) == 1:
        return CELLS[kinds[0]]
    if kinds not in _SPANS:
        cell = combine(_short_span(kinds[:len(kinds) // 2]), _short_span(kinds[len(kinds) // 2:]))
        if len(_SPANS) > 100_000:
            _SPANS.clear()
        _SPANS[kinds] = cell
    return _SPANS[kinds]


def span(kinds: bytes) -> Cell:
    """The cell of rows given by the numbers of their cells; spans of 8 rows are kept and used again."""
    if not kinds:
        return EMPTY
    cells = [_short_span(kinds[i:i + 8]) for i in range(0, len(kinds), 8)]
    while len(cells) > 1:
        cells = [combine(cells[i], cells[i + 1]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0]


def deletions(n: int) -> Cell:
    """The cell of n rows that must go."""
    cell, power = EMPTY, CELLS[NUMBER["", "blank"]]
    while n:
        if n & 1:
            cell = combine(cell, power)
        power, n = combine(power, power), n >> 1
    return cell


def best(cell: Cell) -> tuple[int, str]:
    """Least (cost, audit) of a whole conversation: nothing is left, or it ends with an assistant turn."""
    return min(x for x in (cell[PAIRS.index((0, 0))], cell[PAIRS.index((0, 3))]) if x)


def fault_of(text: str, seen: bool) -> str:
    end = text.rstrip(SPACES)
    return "blank" if not end else "duplicate" if seen else "" if end[-1] in ".!?" else "truncated"


class Stats:
    """Counts of a stretch of rows in order, and what is needed to join it to the next one."""

    NAMES = ("blank", "duplicate", "truncated", "illegal", "low", "high", "turns", "first", "last")

    def __init__(self, values=None):
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.first = self.last = None  # turns, then initials
        for name, value in zip(self.NAMES, values or []):
            setattr(self, name, value)

    @staticmethod
    def of_row(turn: int | None, role: str, fault: str, copies: int = 1) -> Stats:
        one, initial = Stats(), role[:1]
        one.first = one.last = initial
        one.illegal = (copies - 1) * (initial * 2 not in LEGAL)
        if fault:
            setattr(one, fault, 1 if fault != "blank" else copies)
        if fault != "blank":  # the copies of a row are duplicates of it
            one.duplicate += copies - 1
        if turn is not None:
            one.low, one.high, one.turns = turn, turn, 1
        return one

    def add(self, other: Stats) -> None:
        if other.first is None:
            return
        if self.first is not None:
            self.illegal += (self.last + other.first) not in LEGAL
        self.first, self.last = other.first if self.first is None else self.first, other.last
        for n in ("blank", "duplicate", "truncated", "illegal"):
            setattr(self, n, getattr(self, n) + getattr(other, n))
        if other.low is not None:
            self.turns += other.turns - (self.high == other.low)
            self.low, self.high = other.low if self.low is None else self.low, other.high

    def report(self) -> tuple[int, int, int, int, int]:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal


class Editor:
    """Applies an audit to the rows of a conversation as they come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.out = audit, 0, 0
        self.odd = (len(audit) - audit.count("D")) % 2  # an odd number of turns begins with the system

    def _role(self) -> str:
        return ("user", "assistant")[(self.out - self.odd) % 2]

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            yield self._role(), "", "I"
            self.at, self.out = self.at + 1, self.out + 1

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            yield (role if edit == "K" else self._role()), text, edit
            self.out += 1


def damage(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The rows with one fault in each of five of twenty cases of a checksum; ``present`` is false for a row that is dropped."""
    names = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (id_col, turn_col)]
    case = crc(F.concat_ws(":", *names)) % 20
    role, text = F.coalesce(role_col, F.lit(" ")), F.coalesce(text_col, F.lit(" "))
    return rows.select(
        F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"), (case != 0).alias("present"),
        F.when(case == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(case == 1, F.lit("")).when(case == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(case == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def _number(x) -> int | None:
    """Whole numbers that may be missing travel as text, since pandas would make them floating."""
    return int(x) if isinstance(x, str) else None


def _conversations(batches) -> Iterator[tuple[str, list]]:
    """(conv, rows) of rows sorted by conversation, across batches."""
    conv, rows = None, []
    for batch in batches:
        for row in zip(*[batch[c] for c in ("conv", "turn", "role", "text", "present")]):
            if row[0] != conv and conv is not None:
                yield conv, rows
                rows = []
            conv = row[0]
            if row[4]:
                rows.append((_number(row[1]), row[2], row[3]))
    if conv is not None:
        yield conv, rows


def _parsed(rows: list) -> tuple[Stats, Cell]:
    stats, kinds, seen = Stats(), bytearray(), set()
    for turn, role, text in rows:
        fault = fault_of(text, (role, text) in seen)
        seen.add((role, text))
        stats.add(Stats.of_row(turn, role, fault))
        kinds.append(kind_of(role, fault))
    return stats, span(bytes(kinds))


def _short(rows: DataFrame, turns: bool) -> DataFrame:
    """Whole conversations, one after the other."""

    columns = TURN_COLUMNS if turns else REPORT_COLUMNS

    def run(batches):
        out = []
        for conv, found in _conversations(batches):
            stats, cell = _parsed(found)
            cost, audit = best(cell)
            editor = Editor(audit)
            kept = [x for _, role, text in found for x in editor.row(role, text)] + list(editor.inserted())
            if turns:
                out.extend((conv, i, *x) for i, x in enumerate(kept))
            else:
                digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t, _ in kept).encode("utf-8", "surrogatepass")).hexdigest()
                out.append((conv, *stats.report(), cost, audit, digest))
            if len(out) > LONG_ROWS:
                yield pd.DataFrame(out, columns=columns)
                out = []
        yield pd.DataFrame(out, columns=columns)

    ordered = rows.repartition("conv").sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "text")
    return _as_text(ordered).mapInPandas(run, TURNS if turns else REPORT)


def _as_text(rows: DataFrame) -> DataFrame:
    return rows.withColumn("turn", F.col("turn").cast("string"))


TURN_COLUMNS = ["conv", "position", "role", "text", "edit"]
TURNS = "conv string, position long, role string, text string, edit string"
REPORT_COLUMNS = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
REPORT = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
SEGMENT = "conv string, part long, low string, high string, turns long, blank long, duplicate long, truncated long, illegal long, first string, last string, costs array<long>, audits array<string>"
SEGMENT_COLUMNS = [c.split()[0] for c in SEGMENT.split(", ")]


def _segment(conv: str, part: int, stats: Stats, cell: Cell) -> tuple:
    own = {n: getattr(stats, n) for n in Stats.NAMES}
    own |= {n: None if own[n] is None else str(own[n]) for n in ("low", "high")}
    own |= {"conv": conv, "part": part, "costs": [x[0] if x else None for x in cell], "audits": [x[1] if x else None for x in cell]}
    return tuple(own[c] for c in SEGMENT_COLUMNS)


def _frame(segments: list) -> pd.DataFrame:
    return pd.DataFrame(segments, columns=SEGMENT_COLUMNS)


def _merged(rows: pd.DataFrame) -> tuple[Stats, Cell]:
    stats, cell = Stats(), EMPTY
    for row in rows.sort_values("part").itertuples(index=False):
        own = {n: getattr(row, n) for n in Stats.NAMES}
        own |= {n: _number(own[n]) for n in ("low", "high")} | {n: own[n] if isinstance(own[n], str) else None for n in ("first", "last")}
        stats.add(Stats(own.values()))
        cell = combine(cell, tuple((int(c), a) if isinstance(a, str) else None for c, a in zip(row.costs, row.audits)))
    return stats, cell


def _long_rows(rows: DataFrame) -> DataFrame:
    """Equal rows as one with their number, and whether the role and text stand in an earlier turn."""
    rows = rows.groupBy("conv", "turn", "role", "text", "present").agg(F.count("*").alias("copies"))
    lengths = [F.length(c).cast("string") for c in ("conv", "role")]
    same = F.unhex(F.md5(F.concat_ws(":", *lengths, "conv", "role", "text").cast("binary")))
    rows = stored(rows.withColumn("same", F.when(F.col("present"), same)), "conversation-rows")
    order = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    earliest = rows.where("present").groupBy("same").agg(F.min(order).alias("e")).select("same", F.col("e")["turn"].alias("earliest"))
    joined = left_join(rows, earliest, "same", unique_right=True)
    return joined.withColumn("seen", F.col("present") & ~F.col("turn").eqNullSafe(F.col("earliest"))).drop("same", "earliest")


def _long_audits(rows: DataFrame) -> DataFrame:
    """One segment for each conversation: its counts and its cell."""

    def run(batches):
        part, conv, stats, cell, kinds = TaskContext.get().partitionId(), None, Stats(), EMPTY, bytearray()
        for batch in batches:
            done = []
            columns = ("turn", "conv", "role", "text", "present", "copies", "seen")
            for turn, name, role, text, present, copies, seen in zip(*[batch[c] for c in columns]):
                if name != conv:
                    if conv is not None:
                        done.append(_segment(conv, part, stats, combine(cell, span(bytes(kinds)))))
                    conv, stats, cell, kinds = name, Stats(), EMPTY, bytearray()
                if not present:
                    continue
                fault = fault_of(text, seen)
                stats.add(Stats.of_row(_number(turn), role, fault, copies))
                kinds.append(kind_of(role, fault))
                if copies > 1 or len(kinds) >= LONG_ROWS:
                    cell = combine(combine(cell, span(bytes(kinds))), deletions(copies - 1))
                    kinds = bytearray()
            if done:
                yield _frame(done)
        if conv is not None:
            yield _frame([_segment(conv, part, stats, combine(cell, span(bytes(kinds))))])

    order = ["conv", F.asc_nulls_first("turn"), "role", "text"]
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    segments = stored(_as_text(ranges).mapInPandas(run, SEGMENT), "conversation-cells")

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        stats, cell = _merged(group)
        return _frame([_segment(group["conv"].iat[0], int(group["part"].iat[0]) // FAN, stats, cell)])

    while not segments.groupBy("conv").count().where("count > 1").isEmpty():
        near = F.floor(F.col("part") / FAN).alias("near")
        segments = stored(segments.groupBy("conv", near).applyInPandas(merge, SEGMENT), "conversation-cells")
    return segments


def _long(rows: DataFrame, turns: bool) -> DataFrame:
    """Conversations of many rows: cells of ranges, combined in rounds, then one pass in order with the audit."""
    rows = stored(_long_rows(rows), "conversation-rows")

    def finish(batches):
        for batch in batches:
            out = []
            for _, row in batch.iterrows():
                stats, cell = _merged(pd.DataFrame([row]))
                out.append((row["conv"], *stats.report(), *best(cell)))
            yield pd.DataFrame(out, columns=REPORT_COLUMNS[:-1])

    audits = stored(_long_audits(rows).mapInPandas(finish, REPORT.rsplit(",", 1)[0]), "conversation-audits")
    heads = audits.select(
        "conv", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(0).cast("long").alias("copies")
    )
    body = rows.where("present").select("conv", F.lit(1).alias("kind"), "turn", "role", "text", "copies")

    def run(batches):
        conv, editor, digest, at = None, None, None, 0

        def take(found):
            nonlocal at
            for role, text, edit in found:
                if not turns:
                    digest.update((("\n" if at else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
                at += 1
                yield conv, at - 1, role, text, edit

        for batch in batches:
            out = []
            for name, kind, role, text, copies in zip(*[batch[c] for c in ("conv", "kind", "role", "text", "copies")]):
                if kind == 0:
                    if conv is not None:
                        out.extend(x if turns else () for x in take(editor.inserted()))
                        if not turns:
                            out.append((conv, digest.hexdigest()))
                    conv, editor, digest, at = name, Editor(text), hashlib.sha256(), 0
                else:
                    for _ in range(copies):
                        out.extend(take(editor.row(role, text)))
            yield pd.DataFrame([x for x in out if len(x) == len(columns)], columns=columns)
        if conv is not None:
            out = list(take(editor.inserted()))
            yield pd.DataFrame(out if turns else [(conv, digest.hexdigest())], columns=columns)

    columns = TURN_COLUMNS if turns else ["conv", "repaired_sha256"]
    ordered = heads.unionByName(body).repartition("conv").sortWithinPartitions("conv", "kind", F.asc_nulls_first("turn"), "role", "text")
    passed = _as_text(ordered).mapInPandas(run, TURNS if turns else "conv string, repaired_sha256 string")
    return passed if turns else audits.join(passed, "conv").select(*REPORT_COLUMNS)


def _repaired(
    rows: DataFrame, turns: bool, long_rows: int, long_bytes: int, id_col: str, turn_col: str, role_col: str, text_col: str, present_col: str | None
) -> DataFrame:
    kind = rows.schema[id_col].dataType
    there = F.lit(True) if present_col is None else F.coalesce(F.col(present_col), F.lit(False))
    own = [F.when(there, F.coalesce(F.col(c).cast("string"), F.lit(" "))) for c in (role_col, text_col)]
    rows = rows.select(
        source_key(id_col).alias("conv"), F.when(there, F.col(turn_col).cast("long")).alias("turn"), own[0].alias("role"), own[1].alias("text"), there.alias("present")
    )
    sizes = rows.groupBy("conv").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b"))
    many = stored(sizes.where((F.col("n") > long_rows) | (F.col("b") > long_bytes)).select("conv"), "long-conversations")
    if many.isEmpty():
        done = _short(rows, turns)
    else:
        listed = small_side(many, total_bytes(many))
        done = _short(rows.join(listed, "conv", "left_anti"), turns).unionByName(_long(rows.join(listed, "conv", "left_semi"), turns))
    conv = F.when(F.col("conv").startswith("0"), F.substr("conv", F.lit(2)).cast(kind)).alias("conv_id")
    return done.select(conv, *[c for c in done.columns if c != "conv"])


def repair_report(
    rows: DataFrame, long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES, id_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text", present_col: str | None = None,
) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    A row whose ``present_col`` is not true only tells that its conversation exists.
    """
    return _repaired(rows, False, long_rows, long_bytes, id_col, turn_col, role_col, text_col, present_col)


def repair(
    rows: DataFrame, long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES, id_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text", present_col: str | None = None,
) -> DataFrame:
    """The repaired turns: conv_id, position, role, text, and the edit (K, R or I) that put them there."""
    return _repaired(rows, True, long_rows, long_bytes, id_col, turn_col, role_col, text_col, present_col)
