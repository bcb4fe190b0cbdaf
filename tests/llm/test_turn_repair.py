"""Operator 11 against a search over all edits and a plain reading of the contract."""

import hashlib
import itertools
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from shoplens.llm import registry, turn_repair
from shoplens.llm.turn_plan import GONE, SOUND, START, TRUNCATED, TurnPlan, apply_edits, walk_back
from tests.conftest import SF_SMALL

GOOD = re.compile(r"(s?(ua)+)?")


def cheapest(rows):
    """(cost, edits, repaired) by trying everything; rows of (role, text, kind)."""
    inserts = [i for n in range(3) for i in itertools.product(("user", "assistant"), repeat=n)]
    best = None
    for letters in itertools.product("KRD", repeat=len(rows)):
        if any(k == GONE and e != "D" for e, (_, _, k) in zip(letters, rows)):
            continue
        for roles in itertools.product(*[("user", "assistant") if e == "R" else (r,) for e, (r, _, _) in zip(letters, rows)]):
            for places in itertools.product(inserts, repeat=len(rows) + 1):
                out, edits, cost = [], "", 0
                for place, e, role, (_, text, kind) in zip(places, letters, roles, rows):
                    out += [(r, "") for r in place] + ([(role, text)] if e != "D" else [])
                    edits += "I" * len(place) + e
                    cost += 5 * len(place) + {"K": 0, "R": 1, "D": 2}[e] + 5 * (kind == TRUNCATED and e != "D")
                out += [(r, "") for r in places[-1]]
                edits += "I" * len(places[-1])
                cost += 5 * len(places[-1])
                if GOOD.fullmatch("".join(r[:1] or "?" for r, _ in out)):
                    best = min(best or (cost, edits, out), (cost, edits, out))
    return best


def planned(rows):
    plan, table, cost, back = TurnPlan(), START, 0, b""
    for role, _, kind in rows:
        table, grown, pointers = plan.step(table, role[:1], kind)
        cost, back = cost + grown, back + pointers
    more, state, tail = plan.close(table)
    edits = walk_back(back, state)[0] + "I" * tail
    return cost + more, edits, apply_edits(edits, [r[:2] for r in rows], 0)


def test_plan_is_the_cheapest_and_least():
    rng = np.random.default_rng(3)
    roles = ["user", "assistant", "system", "tool", ""]
    cases = [[]] + [[(r, "t", k)] for r in roles for k in (SOUND, GONE, TRUNCATED)]
    cases += [[(roles[i], f"t{j}", int(k)) for j, (i, k) in enumerate(zip(rng.choice(5, n, p=[.35, .35, .15, .1, .05]),
                                                                         rng.choice(3, n, p=[.5, .2, .3])))]
              for n in [2] * 40 + [3] * 5]
    for rows in cases:
        assert planned(rows) == cheapest(rows), rows


def reference(rows):
    """The contract's row of one conversation, rows damaged and in order."""
    seen, faults, kinds = set(), [0, 0, 0], []
    for _, role, text in rows:
        bare = re.findall("[^\x20\x09-\x0d]", text)
        fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else 3
        seen.add((role, text))
        if fault < 3:
            faults[fault] += 1
        kinds.append((GONE, GONE, TRUNCATED, SOUND)[fault])
    turns = {t for t, _, _ in rows if t is not None}
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, edits, out = planned([(r, t, k) for (_, r, t), k in zip(rows, kinds)])
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *faults, illegal, cost, edits,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())


def damaged(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(name.encode()) % 20
        group = out[conv]
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            group += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())
    return {c: sorted(g, key=key) for c, g in out.items()}


def table_rows():
    rng = np.random.default_rng(8)
    say = ["Yes.", "Well?", "no end", "", " \t", "Long " * 3000 + "end!", "　", "Fine. \n", None]
    roles = ["user", "assistant", "system", None, "", "tool"]
    rows = [(c, t, ("user", "assistant")[t % 2], f"Text {c} {t}.") for c in range(30) for t in range(c)]
    rows += [(int(c), None if t == 9 else int(t), roles[r], say[s]) for c, t, r, s in zip(
        rng.integers(40, 60, 400), rng.integers(-3, 10, 400), rng.choice(6, 400, p=[.4, .3, .1, .1, .05, .05]), rng.integers(0, 9, 400))]
    rows += [(None, 1, "user", "Hi."), (None, None, None, None), (70, 2**63 - 1, "user", "A."), (70, 0, "user", "A."),
             (70, 0, "user", "A.")]
    return rows + [(int(c), 3, "user", "Same.") for c in range(80, 140)]


def result(df):
    cols = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r.conv_id: tuple(r[c] for c in cols) for r in df.collect()}


@pytest.mark.parametrize("part_rows", [1, 3, turn_repair.PART_ROWS])
def test_repair_equals_the_contract(spark, part_rows):
    rows = table_rows()
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], "conv_id long, turn long, role string, text string, conv long, copy string")
    done = turn_repair.repair(turn_repair.damage(df), absent="absent", part_rows=part_rows)
    want = {c: reference(g) for c, g in damaged(rows).items()}
    assert any(not g for g in damaged(rows).values())
    got = done.filter("repaired_sha256 IS NOT NULL")
    assert got.count() == len(want) and result(got) == want
    texts = defaultdict(list)
    for r in sorted(done.collect(), key=lambda r: (r.conv_id is not None, r.conv_id or 0, r.part)):
        texts[r.conv_id] += [f"{t.role}:{t.text}" for t in r.turns]
    assert {c: hashlib.sha256("\n".join(t).encode()).hexdigest() for c, t in texts.items()} == {c: w[-1] for c, w in want.items()}


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert turn_repair.repair(turn_repair.damage(df), absent="absent").count() == 0


def test_registered_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    got = registry.op11_turn_repair(spark, SF_SMALL)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert result(got) == {c: reference(g) for c, g in damaged(rows).items()}
