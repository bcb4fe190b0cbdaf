"""Minimum-bin-slack plan over a histogram of lengths (no Spark in here).

``plan_windows`` fills one window shape at a time: the longest remaining
length seeds it, and a subset-sum table held as one integer bitset per
step finds the multiset of remaining lengths whose sum is closest to the
room left. Walking the steps back gives how often each length is used.
The shape is then repeated as often as the counts allow, so the work
depends on the number of distinct lengths, not on the number of rows.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections import deque
from typing import NamedTuple


class Slot(NamedTuple):
    """Where the rows ``lo <= rank < hi`` of one original length go.

    Item ``i = i0 + rank - lo`` is the piece ``[cut, cut + size)`` of its
    row; it lies in sequence ``first_seq + i // per_window`` at offset
    ``base + (i % per_window) * size``.
    """

    length: int
    lo: int
    hi: int
    cut: int
    size: int
    i0: int
    per_window: int
    first_seq: int
    base: int


def closest_fill(lengths: list[int], counts: dict[int, int], room: int) -> dict[int, int]:
    """Uses per length of the multiset with the largest sum <= ``room``.

    ``lengths`` ascend. Long ones enter the table first, so the walk back
    prefers few long pieces; the table stops once the room is filled exactly.
    """
    if room <= 0:
        return {}
    mask, bits, steps = (1 << (room + 1)) - 1, 1, []
    for k in range(bisect_right(lengths, room) - 1, -1, -1):
        size = lengths[k]
        left, step = min(counts[size], room // size), 1
        while left > 0 and not bits >> room & 1:
            step = min(step, left)
            steps.append((size, step, bits))
            bits |= bits << (step * size) & mask
            left -= step
            step *= 2
        if bits >> room & 1:
            break
    at, uses = bits.bit_length() - 1, {}
    for size, step, before in reversed(steps):
        if not before >> at & 1:
            uses[size] = uses.get(size, 0) + step
            at -= size * step
    return uses


def plan_windows(histogram: dict[int, int], capacity: int) -> tuple[list[Slot], int]:
    """Slots for every row of every length, and the number of sequences.

    Where the best fill leaves slack, one remaining row per window is cut:
    its head fills the slack and its tail goes back as a shorter length, so
    every window is full. What is left at the end (under one capacity) goes
    into sequences of falling powers of two, which need no padding.
    """
    counts = {size: n for size, n in histogram.items() if size > 0 and n > 0}
    lots = {size: deque([(size, 0, n, 0)]) for size, n in counts.items()}
    lengths = sorted(counts)
    total = sum(size * n for size, n in counts.items())
    slots: list[Slot] = []
    seq = 0

    def spend(size: int, n: int) -> list[tuple[int, int, int, int]]:
        counts[size] -= n
        if not counts[size]:
            lengths.pop(bisect_right(lengths, size) - 1)
        out = []
        while n:
            length, lo, hi, cut = lots[size].popleft()
            take = min(n, hi - lo)
            out.append((length, lo, lo + take, cut))
            if lo + take < hi:
                lots[size].appendleft((length, lo + take, hi, cut))
            n -= take
        return out

    def give_back(size: int, length: int, lo: int, hi: int, cut: int) -> None:
        if not counts.get(size):
            insort(lengths, size)
        counts[size] = counts.get(size, 0) + hi - lo
        lots.setdefault(size, deque()).append((length, lo, hi, cut))

    while total:
        window = capacity if total >= capacity else 1 << (total.bit_length() - 1)
        uses: dict[int, int] = {}
        k = bisect_right(lengths, window) - 1
        if k >= 0:
            seed = lengths[k]
            counts[seed] -= 1
            uses = closest_fill(lengths, counts, window - seed)
            counts[seed] += 1
            uses[seed] = uses.get(seed, 0) + 1
        slack = window - sum(size * n for size, n in uses.items())
        times = min([counts[size] // n for size, n in uses.items()], default=total)
        donor = 0
        if slack:
            donor = max((size for size in lengths if size > slack and counts[size] > uses.get(size, 0)),
                        key=lambda size: (counts[size] // (uses.get(size, 0) + 1), size))
            times = min(times, counts[donor] // (uses.get(donor, 0) + 1))
        if window < capacity:
            times = 1
        base = 0
        for size, n in sorted(uses.items(), reverse=True):
            done = 0
            for length, lo, hi, cut in spend(size, n * times):
                slots.append(Slot(length, lo, hi, cut, size, done, n, seq, base))
                done += hi - lo
            base += size * n
        if donor:
            done = 0
            for length, lo, hi, cut in spend(donor, times):
                slots.append(Slot(length, lo, hi, cut, slack, done, 1, seq, base))
                give_back(donor - slack, length, lo, hi, cut + slack)
                done += hi - lo
        seq += times
        total -= window * times
    return slots, seq
