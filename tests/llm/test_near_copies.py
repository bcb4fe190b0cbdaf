"""The pipeline's near-duplicate stage against brute force at its own limit."""

import numpy as np

import corpus_pipeline
from shoplens.llm import set_join, shingles
from shoplens.llm.shingles import in_common, shingle_halves, shingle_set
from tests.llm.test_operators import _words


def _survivors(texts, width, limit):
    """Smallest id of every component of texts alike by at least ``limit`` hundredths."""
    sets = [frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))) for w in map(_words, texts)]
    name = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= limit * len(a | sets[j]):
                old, new = max(name[i], name[j]), min(name[i], name[j])
                name = [new if x == old else x for x in name]
    return set(name)


def test_stage_drops_what_is_alike_by_four_fifths(spark):
    rng = np.random.default_rng(8)
    texts = []
    for _ in range(6):
        words = [f"w{k}" for k in rng.integers(0, 10**6, 200)]
        texts.append(" ".join(words))
        for changed in (1, 3, 4, 5, 8, 12):               # each changed word costs five shingles a side
            copy = list(words)
            for k in range(changed):
                copy[10 + k * 15] = f"new{rng.integers(0, 10**6)}"
            texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.jaccard_join(spark, docs, "").collect()}
    assert kept == _survivors(texts, 5, 80)
    assert kept != _survivors(texts, 4, 85)


def _opposite_words(n):
    """Words of ``n`` letters that equal any polynomial hash modulo 2 ** 64: a sequence of signs and its negation."""
    signs = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[s] for s in signs), "".join("ba"[s] for s in signs)


def test_words_of_equal_polynomial_hash_do_not_link(spark):
    a, b = _opposite_words(1024)
    texts = [f"x y z {a}", f"x y z {b}", f"X y z {a}", f"{a} {b} " * 40, f"{b} {a} " * 40]
    docs = set_join.keyed(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), ["doc_id", "text"])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in set_join.set_components(docs).collect()}
    assert got == {0: (1, 0), 1: (1, 1), 2: (1, 0), 3: (2, 3), 4: (2, 3)}
    assert not np.isin(shingle_set(texts[0], 4), shingle_set(texts[1], 4)).any()


def test_halves_tell_shingles_apart(monkeypatch):
    monkeypatch.setattr(shingles, "_hashes", lambda words, width, half: np.array([5, 5, 5, 7] if half == 0 else [1, 2, 1, 3], np.uint64))
    x = shingle_halves("a", 4)
    assert [h.tolist() for h in x] == [[5, 5, 7], [1, 2, 3]]
    assert in_common((np.array([5, 7], np.uint64), np.array([9, 3], np.uint64)), (np.array([5, 7], np.uint64), np.array([1, 3], np.uint64))) == 1
