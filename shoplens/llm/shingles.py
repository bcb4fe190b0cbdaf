"""Word-shingle sets as sorted arrays of 128-bit hashes in two halves (NumPy, no Spark in here).

A word's hash is its BLAKE2b digest, kept for the words seen last; a
shingle's halves each combine one half of its words' digests by place. The
first half orders and indexes a set; both halves together tell shingles
apart where sets are compared.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

_U = np.uint64
_RNG = np.random.default_rng(90210)
#: Fixed odd multipliers, one per word place, for either half.
_PLACE = _RNG.integers(1, 1 << 63, (8, 2), dtype=np.uint64) * _U(2) + _U(1)
#: Words whose digests a process keeps (about 150 bytes each).
KEPT_WORDS = 100_000


class _Digests(dict):
    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= KEPT_WORDS:
            self.clear()
        found = self[word] = blake2b(word, digest_size=16).digest()
        return found


_DIGESTS = _Digests()


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of 64-bit hashes."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def word_digests(text: str) -> np.ndarray:
    """Two 64-bit halves per word, A-Z lower-cased; words end at the six ASCII white-space characters."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return np.frombuffer(b"".join(map(_DIGESTS.__getitem__, words)), "<u8").reshape(-1, 2)


def _hashes(words: np.ndarray, width: int, half: int) -> np.ndarray:
    n = len(words)
    k = min(n, width)
    h = np.zeros(n - k + 1, np.uint64)
    for j in range(k):
        h += words[j:n - k + 1 + j, half] * _PLACE[j, half]
    return mix(h + _U(k))


def shingle_set(text: str, width: int) -> np.ndarray:
    """Sorted distinct first halves of the ``width``-word shingles; of the whole sequence if shorter."""
    words = word_digests(text)
    if not len(words):
        return np.zeros(0, np.uint64)
    h = _hashes(words, width, 0)
    h.sort()
    return h[np.concatenate(([True], h[1:] != h[:-1]))]


def shingle_halves(text: str, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Both halves of the distinct shingles, sorted."""
    words = word_digests(text)
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    first, second = _hashes(words, width, 0), _hashes(words, width, 1)
    order = np.argsort(first)
    a, b = first[order], second[order]
    if ((a[1:] == a[:-1]) & (b[1:] != b[:-1])).any():
        order = np.lexsort((second, first))
        a, b = first[order], second[order]
    own = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    return a[own], b[own]


def in_common(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> int:
    """Shingles of both sets, given by their halves."""
    if not len(x[0]) or not len(y[0]):
        return 0
    at = np.searchsorted(y[0], x[0])
    at[at == len(y[0])] = 0
    return int(((y[0][at] == x[0]) & (y[1][at] == x[1])).sum())
