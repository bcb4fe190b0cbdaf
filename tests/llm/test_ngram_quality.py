"""Operator 6's probabilities against the formulas of its docstring."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from shoplens.llm import ngram_quality
from shoplens.llm.char_windows import PAD, Windows


def brute(texts, trusted, order):
    """Perplexity of every text by interpolated modified Kneser-Ney over plain dictionaries."""
    grams = lambda t: [(PAD * (order - 1) + t)[i:i + order] for i in range(len(t))]
    levels = {order: Counter(g for t, ok in zip(texts, trusted) if ok for g in grams(t))}
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    uniform = 1 / max(1, len({c for t in texts for c in t}))
    discounts, context = {}, {}
    for k, counts in levels.items():
        n = Counter(counts.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
        discounts[k] = [min(float(i), max(0.0, i - (i + 1) * y * n[i + 1] / n[i])) if n[i] else 0.0 for i in (1, 2, 3)]
        context[k] = defaultdict(list)
        for g, c in counts.items():
            context[k][g[:-1]].append(c)

    def p(g):
        if not g:
            return uniform
        k, below = len(g), p(g[1:])
        seen = context[k].get(g[:-1])
        if not seen:
            return max(below, uniform * 1e-6)
        d = discounts[k]
        c = levels[k][g]
        spare = sum(d[min(x, 3) - 1] for x in seen)
        own = max(c - d[min(c, 3) - 1], 0) if c else 0
        return max((own + spare * below) / sum(seen), uniform * 1e-6)

    return [math.exp(-sum(math.log(p(g)) for g in grams(t)) / len(t)) if t else None for t in texts]


@pytest.mark.parametrize("order, shard_rows", [(1, 10**6), (3, 10**6), (5, 40)])
def test_perplexities_equal_the_formulas(spark, order, shard_rows):
    rng = np.random.default_rng(1)
    words = "the of and in to river stone light over é中 \U0001f600".split()
    texts = [None, "", "a"] + [" ".join(rng.choice(words, n)) for n in rng.integers(1, 30, 40)] + ["zzz qqq xxx", "the the"]
    rows = [(i, t, "en" if i % 2 else None, "x") for i, t in enumerate(texts)] + [(7, texts[7], "en", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n string")
    ids = [i for i in range(len(texts)) if i % 3 == 0] + [7]
    held = {r[0] for r in spark.range(len(texts)).selectExpr("id", f"pmod(xxhash64(id), {ngram_quality.HELD_OUT}) AS h").filter("h = 0").collect()}
    trusted = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    want = brute([r[1] or "" for r in rows], [r[0] in ids and r[0] not in held for r in rows], order)
    got = ngram_quality.perplexities(docs, trusted, order, shard_rows=shard_rows).collect()
    assert len(got) == len(rows)
    by_id = dict(zip((r[0] for r in rows), want))
    for r in got:
        assert (r.perplexity is None) == (by_id[r.doc_id] is None) and r.n_windows == len(texts[r.doc_id] or "")
        assert r.perplexity is None or abs(r.perplexity / by_id[r.doc_id] - 1) < 1e-4
    good = sorted(by_id[i] for i in ids if i in held and by_id[i] is not None)
    assert not good or all(r.kept == (r.perplexity is not None and r.perplexity <= r.threshold) for r in got)


def test_empty_tables_and_no_trusted_texts(spark):
    docs = spark.createDataFrame([(1, "abc", "en"), (2, None, None)], "doc_id long, text string, lang string")
    none = spark.createDataFrame([], "doc_id long")
    got = {r.doc_id: r for r in ngram_quality.perplexities(docs, none).collect()}
    assert got[1].kept and abs(got[1].perplexity - 3) < 1e-4 and not got[2].kept
    assert ngram_quality.perplexities(docs.limit(0), none).count() == 0


def test_very_long_text():
    w = Windows(["x" * 2_000_000, ""], 5)
    assert len(w.keys) == 2_000_000 and len(set(w.keys[10:1000].tolist())) == 1
