"""Comparison of the sets in one long index list (NumPy, no Spark in here)."""

from __future__ import annotations

import numpy as np


def parity_bits(hashes: np.ndarray) -> bytes:
    """Bit k: parity of the hashes that fall on k; as many bits as a power of two >= twice the set, 64 at least."""
    n = max(64, 1 << (2 * len(hashes) - 1).bit_length())
    counts = np.bincount((hashes & np.uint64(n - 1)).astype(np.int64), minlength=n)
    return np.packbits(counts.astype(np.uint8) & 1, bitorder="little").tobytes()


def fold(bits: np.ndarray, words: int) -> np.ndarray:
    """Parity maps (rows of 64-bit words) folded to ``words`` words: the map with that many bits."""
    return np.bitwise_xor.reduce(bits.reshape(bits.shape[0], -1, words), axis=1)


def parity_distance(a: bytes, b: bytes) -> int:
    """A lower bound of the symmetric difference of two sets."""
    x, y = (np.frombuffer(p, np.uint64).reshape(1, -1) for p in (a, b))
    words = min(x.shape[1], y.shape[1])
    return int(np.bitwise_count(fold(x, words) ^ fold(y, words)).sum())


def most_apart(a: np.ndarray, b: np.ndarray | int, num: int, den: int) -> np.ndarray:
    """Largest symmetric difference of linked sets of sizes ``a`` and ``b``."""
    both = a + b
    return both - 2 * -(-both * num // (num + den))


def near_pairs(node: np.ndarray, n: np.ndarray, pos: np.ndarray, label: np.ndarray, anchor: np.ndarray,
               dist: np.ndarray, parity: list[bytes], side: np.ndarray, split: bool,
               num: int, den: int) -> list[tuple[int, int]]:
    """Pairs of nodes of one list (or of two of its parts) that may link.

    Skipped without a look at the sets: pairs of one label (connected
    already), sizes or positions that rule a link out, and pairs whose
    known distances to the same anchor differ by too much. ``split``: only
    pairs of one row of either ``side``.
    """
    order = np.lexsort((node, n))
    node, n, pos, label, anchor, dist, side = (x[order] for x in (node, n, pos, label, anchor, dist, side))
    words = np.array([len(parity[k]) // 8 for k in order])
    maps = {w: np.frombuffer(b"".join(parity[order[k]] for k in np.flatnonzero(words == w)), np.uint64).reshape(-1, w)
            for w in np.unique(words).tolist()}
    place = np.zeros(len(n), np.int64)
    for w in maps:
        place[words == w] = np.arange(len(maps[w]))
    folded = {w: fold(m, w // 2) for w, m in maps.items() if w > 1}
    last = np.searchsorted(n, n * den // num, side="right")
    out = []
    for i in range(len(n) - 1):
        j = np.arange(i + 1, last[i])
        if not len(j):
            continue
        most = most_apart(n[j], n[i], num, den)
        ok = (label[j] != label[i]) & (pos[j] + pos[i] <= most)
        ok &= (anchor[j] != anchor[i]) | (np.abs(dist[j] - dist[i]) <= most)
        if split:
            ok &= side[j] != side[i]
        j, most = j[ok], most[ok]
        if not len(j):
            continue
        own = maps[words[i]][place[i]]
        for w, table in ((words[i], maps.get(words[i])), (2 * words[i], folded.get(2 * words[i]))):
            same = words[j] == w
            if same.any():
                low = np.bitwise_count(table[place[j[same]]] ^ own).sum(axis=1, dtype=np.int64)
                out.extend((int(node[i]), int(node[x])) for x in j[same][low <= most[same]])
    return out
