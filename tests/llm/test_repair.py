"""Conversation repair against a plain shortest-path search over the grammar's states."""

import collections
import hashlib
import random
import re
import zlib

import pytest
from conftest import SF01, SF001

from crease.llm import queries, repair

NEXT, AFTER = {"E": "u", "S": "u", "U": "a", "A": "u"}, {"s": "S", "u": "U", "a": "A"}
TURNS = "conv_id long, turn long, role string, text string"


def relax(best):
    """Inserts before the next turn."""
    for _ in range(3):
        for state, (cost, audit) in list(best.items()):
            to, new = AFTER[NEXT[state]], (cost + 2, audit + "I")
            if to not in best or new < best[to]:
                best[to] = new
    return best


def least(turns, state="E", close=True):
    """(cost, audit) of (initial, must go, truncated) turns; without ``close`` one for each state at the end."""
    best = {state: (0, "")}
    for initial, gone, late in turns:
        before, best = relax(dict(best)), {}
        for s, (cost, audit) in before.items():
            ways = [(s, cost + 3, "D")]
            if not gone:
                if initial == NEXT[s] or (initial == "s" and s == "E"):
                    ways.append((AFTER[initial], cost + late, "K"))
                ways.append((AFTER[NEXT[s]], cost + 2 + late, "R"))
            for to, c, edit in ways:
                best[to] = min(best.get(to, (1 << 30, "")), (c, audit + edit))
    if not close:
        return best
    best = relax(best)
    return min(best[s] for s in "EA" if s in best)


def plain(rows):
    """conv_id -> result row."""
    by, out = collections.defaultdict(list), {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        by[conv].append((turn is not None, turn or 0, role, hashlib.md5(text.encode()).hexdigest(), text))
    for conv, said in by.items():
        said.sort()
        seen, turns, blanks, copies, lates = set(), [], 0, 0, 0
        for _, _, role, _, text in said:
            blank, copy = not re.search(r"[^\x20\x09-\x0D]", text), (role, text) in seen
            seen.add((role, text))
            late = not blank and not copy and re.sub(r"[\x20\x09-\x0D]+\Z", "", text)[-1] not in ".!?"
            blanks, copies, lates = blanks + blank, copies + (copy and not blank), lates + late
            turns.append((role[:1], blank or copy, late))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        given = [x[1] for x in said if x[0]]
        cost, audit = least(turns)
        state, lines, i = "E", [], 0
        for edit in audit:
            if edit != "I":
                role, text, i = said[i][2], said[i][4], i + 1
            if edit == "D":
                continue
            initial = role[0] if edit == "K" else NEXT[state]
            name = role if edit == "K" else {"u": "user", "a": "assistant"}[initial]
            lines.append(f"{name}:{'' if edit == 'I' else text}")
            state = AFTER[initial]
        out[conv] = (conv, max(given) - min(given) + 1 - len(set(given)) if given else 0, blanks, copies, lates, illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def damage(rows):
    for conv, turn, role, text in rows:
        space = lambda x: " " if x is None else x
        k, role, text = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20, space(role), space(text)
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        for _ in range((0, 1, 1, 2)[k] if k < 4 else 1):
            yield conv, turn, "user" if k == 4 else role, text


@pytest.mark.parametrize("folder", [SF001, SF01])
def test_repair_of_damaged_conversations(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    want = plain(list(damage(rows)))
    for conv in {r[0] for r in rows}:
        want.setdefault(conv, (conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()))
    got = queries.op12_turn_repair(spark, folder).collect()
    assert len(got) == len(want) and {r.conv_id: tuple(r) for r in got} == want


def test_alignments_are_the_least_for_every_state():
    r = random.Random(1)
    for _ in range(1500):
        turns = [(r.choice("suau?"), False, r.random() < 0.2) for _ in range(r.randrange(9))]
        letters = "".join("!" if late and c == "?" else c.upper() if late else c for c, _, late in turns)
        for number, state in enumerate("ESUA"):
            got = {"ESUA"[end]: (cost, "".join(edits)) for end, (cost, edits) in repair.alignments(letters, number).items()}
            assert got == least(turns, state, close=False)


def test_bands_lose_nothing():
    """A budget below the cost gives nothing; one at the cost gives the same as none."""
    r = random.Random(4)
    for _ in range(300):
        letters = "".join(r.choice("suaUA?") for _ in range(r.randrange(1, 12)))
        goal = repair.target(repair.EMPTY, r.randrange(0, 14), system=r.random() < 0.3)
        wide = repair.wagner_fischer(letters, goal, 1 << 40)
        if wide is not None and wide[0] < 1 << 50:
            assert repair.wagner_fischer(letters, goal, wide[0]) == wide
            assert repair.wagner_fischer(letters, goal, wide[0] - 1) is None


@pytest.mark.parametrize("size", [1, 3, 16])
def test_odd_turns_in_runs_of_any_size(spark, size):
    """Nulls, ties, repeats, a conversation of hundreds of turns in many runs, null ids."""
    r = random.Random(7)
    texts = ["a.", "b", "c!", "", "  ", "d?", "long text.\n", "é. ", None]
    rows = [(c, r.choice([None, t, t, t + 3]), r.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""]),
             r.choice([*texts, f"t{t}.", f"t{t}.", f"u{t}"])) for c in [*range(30), None] for t in range(300 if c == 7 else r.randrange(1, 25))]
    rows += [(50, 1, "user", "again.")] * 40 + [(51, None, None, None)] * 3
    df = spark.createDataFrame([(*x, "c", 1) for x in rows], TURNS + ", audit string, kind int").repartition(5)
    assert {x.conv_id: tuple(x) for x in repair.repair(df, size).collect()} == plain(rows)


def test_no_turns_and_lost_conversations(spark):
    none = spark.createDataFrame([], TURNS)
    assert repair.repair(none).count() == 0 and repair.with_all(repair.repair(none), none).count() == 0
    one = spark.createDataFrame([(3, 0, "user", "x."), (None, 0, "user", "y")], TURNS)
    rows = {r.conv_id: r for r in repair.with_all(repair.repair(one.where("conv_id = 3")), one).collect()}
    assert rows[3].audit == "KI" and rows[None].audit == "" and rows[None].repaired_sha256 == hashlib.sha256().hexdigest()
    long = spark.createDataFrame([(1, 0, "user", "x" * 500_000 + "."), (1, 1, "assistant", "." * 500_000)], TURNS)
    assert repair.repair(long).first().audit == "KK"
