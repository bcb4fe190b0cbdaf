"""Character windows of texts as hashes, and a hash table of scores (NumPy, no Spark in here)."""

from __future__ import annotations

import numpy as np

from shoplens.llm.shingles import mix

#: Fixed odd multipliers, one per place in a window.
_PLACE = np.random.default_rng(411).integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Stands in front of a text so that every character ends one window.
PAD = "\x02"


class Windows:
    """The ``order``-character windows of several texts, one per character."""

    def __init__(self, texts: list[str], order: int):
        pad = PAD * (order - 1)
        joined = "".join(pad + t for t in texts)
        self.chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.array([len(t) for t in texts], np.int64)
        self.text = np.repeat(np.arange(len(texts)), sizes)
        starts = np.cumsum(sizes + order - 1) - sizes - order + 1
        self.at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)
        self.order = order
        wide = self.chars.astype(np.uint64)
        sums = np.zeros(max(len(wide) - order + 1, 0), np.uint64)
        for j in range(order):
            sums += wide[j:len(wide) - order + 1 + j] * _PLACE[j]
        self.keys = mix(sums)[self.at] | np.uint64(1)      # 0 marks a free slot of a table

    def grams(self, at: np.ndarray) -> list[str]:
        """The windows that begin at the given places, as strings."""
        found = self.chars[at[:, None] + np.arange(self.order)].tobytes().decode("utf-32-le", "surrogatepass")
        return [found[k:k + self.order] for k in range(0, len(found), self.order)]


class ScoreTable:
    """Open addressing from window hashes to scores; built and read in whole arrays."""

    def __init__(self, keys: np.ndarray, scores: np.ndarray):
        size = 1 << max(4, (4 * len(keys) - 1).bit_length())
        self.mask = np.uint64(size - 1)
        self.keys, self.scores = np.zeros(size, np.uint64), np.zeros(size, np.float32)
        rest, slot = np.arange(len(keys)), keys & self.mask
        while len(rest):
            free = self.keys[slot[rest]] == 0
            first = rest[free][np.unique(slot[rest][free], return_index=True)[1]]
            self.keys[slot[first]], self.scores[slot[first]] = keys[first], scores[first]
            rest = rest[self.keys[slot[rest]] != keys[rest]]
            slot[rest] = (slot[rest] + np.uint64(1)) & self.mask

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(scores, found) of window hashes."""
        slot = keys & self.mask
        held = self.keys[slot]
        open_ = np.flatnonzero((held != keys) & (held != 0))
        while len(open_):
            slot[open_] = (slot[open_] + np.uint64(1)) & self.mask
            held[open_] = self.keys[slot[open_]]
            open_ = open_[(held[open_] != keys[open_]) & (held[open_] != 0)]
        return self.scores[slot], held == keys
