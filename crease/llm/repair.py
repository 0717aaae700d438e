"""Conversation structure repair by Wagner-Fischer target alignment.

A well-formed conversation's role initials are empty or ``s?(ua)+``.  Turns are
aligned with the grammar's string of every feasible length: keep a turn (0), give it the
role user or assistant (2), delete it (3; blank and repeated turns must go), insert an empty
turn (2); a truncated turn that stays costs 1.  Lengths are tried from the nearest on;
the cheapest alignment so far (the incumbent) bounds the band of diagonals of the
next (Ukkonen, 1985) and ends the search when a length alone costs more.  Of the cheapest
alignments the audit, the edits' initials in order, that is ASCII-least is kept.

A conversation of any length is cut into runs of turns (``RUN``), by a range shuffle of turns
without their texts.  What stands before a run matters only by its last role, so a
run is aligned for each of four states (nothing yet, after s, u or a) with strings that
follow it, and keeps the cheapest alignment for each state it can end in.  Inserts
stand before a turn, so no audit of a run begins another; choosing run by run the
least audit on a cheapest way through all runs thus gives the least audit of all.
"""

from __future__ import annotations

import functools
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crease.llm.text import forget_in_worker
from crease.session import materialize, splittable

RUN = 16                   # turns of a run that may stay; its alignment takes the cube of that
RELABEL, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
EMPTY, SYSTEM, USER, ASSISTANT = range(4)          # what stands last
ROLES = {"s": "system", "u": "user", "a": "assistant"}
_AFTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
_NEXT = {EMPTY: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
#: What it costs to end a conversation in each state, and how
_CLOSE = {EMPTY: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
_FAR = 1 << 60


# ---- alignment of a run -----------------------------------------------------

def _apart(d: int) -> int:
    """Least cost of being ``d`` symbols of the target ahead (or behind)."""
    return INSERT * d if d > 0 else -DELETE * d


def target(state: int, length: int, system: bool = False) -> str:
    """The grammar's string of a length that follows a state; ``system``: one that begins with s."""
    tail = "au" if state == USER else "ua"
    return ("s" + "ua" * length)[:length] if system else (tail * length)[:length]


def wagner_fischer(turns: str, goal: str, budget: int) -> tuple[int, list[str]] | None:
    """Cheapest alignment of turns with a target string: its cost, and for each turn the
    inserts before it and its own edit, ASCII-least; None if it costs more than ``budget``.

    ``turns`` has a letter for each turn, its role's initial or ``?``; in capitals
    (or ``!``) if it is truncated.  Inserts stand before a turn, never after the last.
    """
    m, n = len(turns), len(goal)
    shift = n - m
    lo = hi = None                                # the band: diagonals that the budget allows
    for d in range(-m, n + 1):
        if _apart(d) + _apart(shift - d) <= budget:
            lo, hi = d if lo is None else lo, d
    if lo is None:
        return None
    width = hi - lo + 1
    # cost[i][k]: from turn i and symbol j = i + lo + k on to the end
    cost = [[_FAR] * (width + 1) for _ in range(m + 1)]
    cost[m][shift - lo] = 0
    for i in range(m - 1, -1, -1):
        here, below = cost[i], cost[i + 1]
        letter = turns[i].lower()
        late = TRUNCATED if turns[i].isupper() or letter == "!" else 0
        for k in range(min(width - 1, n - i - lo), max(-1, -1 - i - lo), -1):
            j = i + lo + k
            best = below[k - 1] + DELETE if k else _FAR
            if j < n and letter == goal[j]:
                best = min(best, below[k] + late)
            if j < n and goal[j] != "s":          # an s can't be made
                best = min(best, here[k + 1] + INSERT, below[k] + RELABEL + late)
            here[k] = best
    if not 0 <= -lo < width or cost[0][-lo] > budget:
        return None
    edits, k = [], -lo
    for i in range(m):
        here, below, before = cost[i], cost[i + 1], ""
        letter = turns[i].lower()
        while True:                               # D before I before K before R
            j = i + lo + k
            if k and below[k - 1] + DELETE == here[k]:
                edits.append(before + "D")
                k -= 1
                break
            if j < n and goal[j] != "s" and here[k + 1] + INSERT == here[k]:
                before, k = before + "I", k + 1
                continue
            edits.append(before + ("K" if letter == goal[j] else "R"))
            break
    return cost[0][-lo], edits


@functools.lru_cache(maxsize=1 << 14)
def alignments(turns: str, state: int) -> dict[int, tuple[int, tuple[str, ...]]]:
    """End state -> cost and edits of the cheapest alignment (ASCII-least) of turns that
    follow a state, over targets of every feasible length."""
    m = len(turns)
    if not m:
        return {state: (0, ())}
    late = sum(c.isupper() or c == "!" for c in turns)
    best: dict[int, tuple[int, tuple[str, ...]]] = {}
    # nothing shown yet: relabelling every turn bounds the cost of a length, deleting all but one the cost of ending after s
    bound = {s: _FAR for s in range(4)}
    length = lambda d: m + d
    for d in sorted(range(-m, 2 * m + 3), key=lambda d: (_apart(d), d)):
        goals = [target(state, length(d))]
        if state == EMPTY and length(d):
            goals.append(target(state, length(d), system=True))
        for goal in goals:
            end = _AFTER[goal[-1]] if goal else state
            known = min(bound[end], best[end][0] if end in best else _FAR)
            if not goal.startswith("s"):
                known = min(known, RELABEL * m + late + _apart(d))
            elif known == _FAR:
                known = DELETE * m + RELABEL * m + late + INSERT * len(goal)
            if _apart(d) > known:
                continue
            got = wagner_fischer(turns, goal, known)
            if got is not None and (end not in best or (got[0], tuple(got[1])) < best[end]):
                best[end] = (got[0], tuple(got[1]))
    return best


# ---- damage (of the query), rows and runs -----------------------------------

def damaged(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """Rows with faults put in by the CRC-32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its
    text, 2 removes ``.!?`` from it, 3 repeats the row, 4 makes it the user's.  A null counts as one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    k = F.crc32(F.concat(space(conv_col), F.lit(":"), space(turn_col)).cast("binary")) % 20
    text = F.when(k == 1, "").when(k == 2, F.translate(space(text_col), ".!?", "")).otherwise(space(text_col))
    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                        F.when(k == 4, "user").otherwise(space(role_col)).alias("role"), text.alias("text"), k.alias("k"))
    copies = F.explode(F.when(F.col("k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.where("k <> 0").withColumn("copy", copies).select("conv_id", "turn", "role", "text")


_BLANK = r"[^\x20\x09-\x0D]"
_WHOLE = r"[.!?][\x20\x09-\x0D]*\z"
_ORDER = ["nil", "conv", "turn", "role", "text_md5"]


def _rows(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows under fixed names; a null role or text is one space, a null conversation is told by ``nil``."""
    said = F.coalesce(F.col(text), F.lit(" "))
    return turns.select(F.col(conv).isNull().alias("nil"), F.coalesce(F.col(conv).cast("long"), F.lit(0)).alias("conv"),
                        F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
                        F.md5(said.cast("binary")).alias("text_md5"), said.alias("text"))


def _kinds(rows: DataFrame) -> DataFrame:
    """Distinct rows without their texts: how often each stands there, and whether it is
    ``blank``, ``whole`` (not truncated) and the ``first`` with its role and text."""
    kinds = (rows.withColumn("blank", ~F.col("text").rlike(_BLANK)).withColumn("whole", F.col("text").rlike(_WHOLE))
             .groupBy(*_ORDER).agg(F.count("*").alias("n"), F.first("blank").alias("blank"), F.first("whole").alias("whole")))
    said = ["nil", "conv", "role", "text_md5"]
    at = F.struct(F.col("turn").isNotNull().alias("given"), "turn")
    kinds = materialize(kinds, "turns")
    firsts = kinds.groupBy(*said).agg(F.min(at).alias("least"))
    # a text that very many turns of a conversation repeat is a hot key of this join
    return kinds.join(splittable(firsts, *said), said).withColumn("first", F.col("least").eqNullSafe(at)).drop("least")


_RUN_SCHEMA = ("nil boolean, conv long, turn long, role string, text_md5 string, last_turn long, first_initial string, "
               "last_initial string, rows long, blank long, duplicate long, truncated long, illegal long, turns long, "
               "low long, high long, start array<int>, end array<int>, cost array<long>, audit array<string>")


class _Run:
    """Turns of one conversation in order, as they are read."""

    def __init__(self, key: tuple, begins: bool):
        self.key, self.begins = key, begins        # begins: known to be the conversation's first run
        self.turns, self.gone, self.pending, self.kinds = [], [], 0, 0
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.low = self.high = self.turn = None
        self.first = self.last = ""

    def add(self, turn, role: str, n: int, blank: bool, whole: bool, first: bool) -> None:
        initial = role[:1]
        self.illegal += (n - 1) + (self.rows > 0 and self.last + initial not in ("su", "ua", "au"))
        if not self.rows:
            self.first = initial
        if turn is not None and turn != self.turn:
            self.distinct += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        self.turn, self.last = turn, initial
        self.rows += n
        self.kinds += 1
        if blank:
            self.blank += n
            self.pending += n
            return
        self.duplicate += n - first
        if not first:
            self.pending += n
            return
        self.truncated += not whole
        letter = initial if initial in ROLES else "?"
        self.turns.append(letter if whole else "!" if letter == "?" else letter.upper())
        self.gone.append(self.pending)             # turns that must go before this one
        self.pending = n - 1

    def row(self) -> tuple:
        ways = []
        for state in (EMPTY,) if self.begins else range(4):
            for end, (cost, edits) in alignments("".join(self.turns), state).items():
                audit = "".join("D" * g + e for g, e in zip(self.gone, edits, strict=True)) + "D" * self.pending
                ways.append((state, end, cost + DELETE * (sum(self.gone) + self.pending), audit))
        return (*self.key, self.turn, self.first, self.last, self.rows, self.blank, self.duplicate, self.truncated,
                self.illegal, self.distinct, self.low, self.high, *map(list, zip(*ways, strict=True)))


def _shape(schema: str) -> pa.Schema:
    """The Arrow form of a schema (made on the driver)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def _arrow(rows: list[tuple], shape: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), shape, strict=True)], schema=shape)


def runs(kinds: DataFrame, size: int = RUN) -> DataFrame:
    """Runs of at most ``size`` turns that may stay (and ``4 * size`` distinct ones in all), each with its
    key (its first turn's place), counts and alignments."""
    shape = _shape(_RUN_SCHEMA)

    def cut(batches):
        forget_in_worker()
        run, seen, out = None, None, []
        for b in batches:
            for nil, conv, turn, role, md5, n, blank, whole, first in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if run is None or (nil, conv) != seen or len(run.turns) >= size or run.kinds >= 4 * size:
                    if run is not None:
                        out.append(run.row())
                    # the first run of a task may go on with a conversation of the task before
                    run = _Run((nil, conv, turn, role, md5), begins=seen is not None and (nil, conv) != seen)
                    seen = (nil, conv)
                run.add(turn, role, n, blank, whole, first)
            if out:
                yield _arrow(out, shape)
                out = []
        if run is not None:
            yield _arrow([run.row()], shape)

    placed = materialize(kinds.select(*_ORDER, "n", "blank", "whole", "first"), "turn-kinds")
    placed = placed.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
    return materialize(placed.mapInArrow(cut, _RUN_SCHEMA), "runs")


def _ahead(table: DataFrame) -> DataFrame:
    """Every run with ``ahead``: the least cost of all that follows it, for each state it may end in.

    A conversation's runs are read from the last to the first as a sorted stream;
    four numbers are kept.
    """
    schema = _RUN_SCHEMA + ", ahead array<long>"

    def back(batches):
        seen, then = None, None
        for b in batches:
            ahead = []
            for nil, conv, starts, ends, costs in zip(*[b.column(i).to_pylist() for i in (0, 1, 16, 17, 18)], strict=True):
                if (nil, conv) != seen:
                    seen, then = (nil, conv), [INSERT * len(_CLOSE[s]) for s in range(4)]
                ahead.append(then)
                best = [_FAR] * 4
                for s, e, c in zip(starts, ends, costs, strict=True):
                    best[s] = min(best[s], c + then[e])
                then = best
            yield b.append_column("ahead", pa.array(ahead, pa.list_(pa.int64())))

    down = [F.col("nil"), F.col("conv"), F.col("turn").desc_nulls_last(), F.col("role").desc(), F.col("text_md5").desc()]
    return table.repartition("nil", "conv").sortWithinPartitions(*down).mapInArrow(back, schema)


_OUT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
        "repaired_sha256 string")


class _Repair:
    """One conversation, as its runs and texts are read in order."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.state, self.cost, self.audit, self.edits, self.at = EMPTY, 0, [], "", 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.turn = None
        self.last, self.begun, self.hash, self.lines = None, False, hashlib.sha256(), 0

    def run(self, r: dict) -> None:
        cost, audit, _ = min((c + r["ahead"][e], a, e) for s, e, c, a in
                             zip(r["start"], r["end"], r["cost"], r["audit"], strict=True) if s == self.state)
        self.audit.append(audit)
        self.edits, self.at = audit, 0
        self.blank += r["blank"]
        self.duplicate += r["duplicate"]
        self.truncated += r["truncated"]
        self.illegal += r["illegal"] + (self.last is not None and self.last + r["first_initial"] not in ("su", "ua", "au"))
        if r["turns"]:
            self.turns += r["turns"] - (r["turn"] is not None and r["turn"] == self.turn)
            self.low, self.high = r["low"] if self.low is None else self.low, r["high"]
        self.turn, self.last = r["last_turn"], r["last_initial"]

    def line(self, role: str, text: str) -> None:
        self.hash.update(("\n" * (self.lines > 0) + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.lines += 1

    def insert(self) -> None:
        letter = _NEXT[self.state]
        self.line(ROLES[letter], "")
        self.state, self.cost = _AFTER[letter], self.cost + INSERT

    def text(self, role: str, text: str, whole: bool) -> None:
        while self.edits[self.at] == "I":
            self.insert()
            self.at += 1
        edit = self.edits[self.at]
        self.at += 1
        if edit == "D":
            self.cost += DELETE
            return
        letter = role[:1] if edit == "K" else _NEXT[self.state]
        self.line(role if edit == "K" else ROLES[letter], text)
        self.state, self.cost = _AFTER[letter], self.cost + RELABEL * (edit == "R") + TRUNCATED * (not whole)

    def row(self) -> tuple:
        self.audit.append(_CLOSE[self.state])
        for _ in self.audit[-1]:
            self.insert()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.audit),
                self.hash.hexdigest())


def repair(turns: DataFrame, size: int = RUN, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    Turns follow each other by ``turn`` (nulls first), ties by role, then by the text's
    MD5.  A null role or text is one space (so such a text is blank, and such a role must be given up);
    null ids are a conversation of their own.  Repeated rows are duplicates of the first.  ``gaps`` counts
    turn numbers that are missing between the least and the greatest; ``illegal`` neighbours
    whose initials are not su, ua or au.  No rows: no rows.

    Texts are shuffled once, by conversation: the digest of the repaired text is one
    chain, so a conversation's texts pass one task, as a sorted stream of which a
    run's edits and the audit so far are held.
    """
    rows = _rows(turns, conv_col, turn_col, role_col, text_col)
    table = _ahead(runs(_kinds(rows), size))
    texts = rows.withColumn("whole", F.col("text").rlike(_WHOLE))
    run = F.struct("last_turn", "first_initial", "last_initial", "blank", "duplicate", "truncated", "illegal", "turns", "low",
                   "high", "turn", "start", "end", "cost", "audit", "ahead")
    none = F.lit(None)
    both = table.select(*_ORDER, F.lit(0).alias("kind"), none.cast("string").alias("text"), none.cast("boolean").alias("whole"),
                        run.alias("run")).unionByName(
        texts.select(*_ORDER, F.lit(1).alias("kind"), "text", "whole"), allowMissingColumns=True)
    # a run stands before its first turn
    ordered = both.repartition("nil", "conv").sortWithinPartitions(*_ORDER, "kind")

    shape = _shape(_OUT)

    def mend(batches):
        state, out = None, []
        for b in batches:
            for nil, conv, _, role, _, kind, text, whole, r in zip(*[c.to_pylist() for c in b.columns], strict=True):
                conv = None if nil else conv
                if state is None or conv != state.conv_id:
                    if state is not None:
                        out.append(state.row())
                    state = _Repair(conv)
                if kind == 0:
                    state.run(r)
                else:
                    state.text(role, text, whole)
            if out:
                yield _arrow(out, shape)
                out = []
        if state is not None:
            yield _arrow([state.row()], shape)

    return ordered.mapInArrow(mend, _OUT)


def with_all(repaired: DataFrame, turns: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Every conversation of ``turns``; one of which nothing is left has zeros, an empty audit and the digest of nothing."""
    ids = turns.select(F.col(conv_col).cast("long").alias("_id")).distinct()
    got: dict[str, Column] = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return ids.join(repaired, F.col("_id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("_id").alias("conv_id"), *[v.alias(c) for c, v in got.items()], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
