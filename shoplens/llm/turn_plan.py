"""Cheapest repair of a turn sequence, one row at a time (no Spark in here).

A repaired conversation's role initials read ``(s?(ua)+)?``: state 0 is the
start, 1 after ``s``, 2 after ``u``, 3 after ``a``; 0 and 3 may end. A row
may be kept (K, cost 0), given the role that is due (R, 1) or deleted (D, 2);
before it and at the end empty rows of the role due may be inserted (I, 5
each). Rows that must go can only be deleted; a truncated row that stays
costs 5 more.

Per state the table keeps the cheapest way there and, of equally cheap ones,
the ASCII-least string of edits. Two states' strings never begin with one
another (a string fixes its state and its cost), so their order is settled
once and for all: four ranks stand for four strings, and a row's step only
depends on the costs' differences, the ranks and the kind of row. Steps are
computed once per such combination. What a row leaves behind is four bytes,
one per state: the state before, the inserts and the letter.
"""

from __future__ import annotations

#: Fixed costs of the edits.
REROLE, DELETE, INSERT, CUT = 1, 2, 5, 5
#: Kinds of rows: sound, to be deleted, truncated.
SOUND, GONE, TRUNCATED = 0, 1, 2
_NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_DUE = ("user", "user", "assistant", "user")
_TAIL = (0, 2, 1, 0)
_LETTERS = "DKR"

#: (cost of each state less the least or None, rank of each state's string)
Table = tuple[tuple, tuple]
START: Table = ((0, None, None, None), (0, 0, 0, 0))


def due(state: int) -> str:
    """The role that a row given a role, or inserted, gets in ``state``."""
    return _DUE[state]


def after(state: int, initial: str) -> int | None:
    return _NEXT[state].get(initial)


class TurnPlan:
    def __init__(self) -> None:
        self._steps: dict[tuple[Table, str, int], tuple[Table, int, bytes]] = {}

    def step(self, table: Table, initial: str, kind: int) -> tuple[Table, int, bytes]:
        """(table after the row, what the least cost grew by, the row's four back pointers)."""
        key = (table, initial if initial in ("s", "u", "a") else "", kind)
        if key not in self._steps:
            self._steps[key] = self._compute(*key)
        return self._steps[key]

    @staticmethod
    def _compute(table: Table, initial: str, kind: int) -> tuple[Table, int, bytes]:
        costs, ranks = table
        ways: list[list[tuple]] = [[], [], [], []]
        for p in range(4):
            if costs[p] is None:
                continue
            at = p
            for k in range(3):
                if k:
                    at = after(at, due(at)[0])
                c = costs[p] + k * INSERT
                ways[at].append((c + DELETE, ranks[p], "I" * k + "D", p, k, 0))
                if kind == GONE:
                    continue
                c += CUT * (kind == TRUNCATED)
                if initial and (q := after(at, initial)) is not None:
                    ways[q].append((c, ranks[p], "I" * k + "K", p, k, 1))
                ways[after(at, due(at)[0])].append((c + REROLE, ranks[p], "I" * k + "R", p, k, 2))
        best = [min(w, default=None) for w in ways]
        least = min(b[0] for b in best if b)
        order = {q: i for i, q in enumerate(sorted((q for q in range(4) if best[q]), key=lambda q: best[q][1:3]))}
        table = (tuple(b and b[0] - least for b in best), tuple(order.get(q, 0) for q in range(4)))
        return table, least, bytes(b[3] | b[4] << 2 | b[5] << 4 if b else 0 for b in best)

    @staticmethod
    def close(table: Table) -> tuple[int, int, int]:
        """(cost over the table's least, state, inserts at the end) of the best way to end."""
        costs, ranks = table
        c, _, p = min((costs[p] + _TAIL[p] * INSERT, ranks[p], p) for p in range(4) if costs[p] is not None)
        return c, p, _TAIL[p]


def walk_back(pointers: bytes, state: int) -> tuple[str, int]:
    """Edits of a run of rows that ends in ``state``, and the state before them."""
    out = []
    for i in range(len(pointers) - 4, -1, -4):
        b = pointers[i + state]
        out.append(_LETTERS[b >> 4])
        out.append("I" * (b >> 2 & 3))
        state = b & 3
    return "".join(out)[::-1], state


def apply_edits(edits: str, rows: list[tuple[str, str]], state: int) -> list[tuple[str, str]]:
    """(role, text) after the edits, from ``state`` on; an insert adds a row with an empty text."""
    out, source = [], iter(rows)
    for e in edits:
        role, text = ("", "") if e == "I" else next(source)
        if e == "D":
            continue
        if e != "K":
            role = due(state)
        out.append((role, text))
        state = after(state, role[:1])
    return out
