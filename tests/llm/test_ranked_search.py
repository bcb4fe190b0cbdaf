"""Operator 13 against scoring every document for every query."""

import math
import re
import string
from collections import Counter

import numpy as np
import pytest

from shoplens.llm import ranked_search, registry
from shoplens.llm.ranked_search import Shard, terms_of
from tests.conftest import SF_SMALL

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text):
    return TERM.findall((text or "").translate(LOW))


def brute(docs, items, k=10):
    bags = [(d, Counter(w), len(w)) for d, w in ((d, words(t)) for d, t in docs) if w]
    n_docs, n_terms = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    out = []
    for item, text in items:
        found = []
        for d, bag, n in bags:
            m = 100 - 75 + 75 * n * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (10**9 * bag[t] // (1000 * bag[t] + 8 * m)) for t in words(text) if t in bag)
            if score:
                found.append((-score, d is None, d or 0))
        out += [(item, i + 1, None if null else d, -s) for i, (s, null, d) in enumerate(sorted(found)[:k])]
    return out


def corpus():
    rng = np.random.default_rng(4)
    vocabulary = np.array([f"w{i}" for i in range(300)])
    p = 1 / np.arange(1, 301)
    say = lambda n: " ".join(rng.choice(vocabulary, n, p=p / p.sum()))
    docs = [(i, say(int(n))) for i, n in enumerate(rng.integers(1, 60, 300))]
    docs += [(400 + i, docs[3][1]) for i in range(40)] + [(500, None), (501, " ,;"), (502, say(30_000)), (None, docs[3][1]),
                                                          (3, docs[3][1]), (503, "Éß W1 İ中文 w2_w3\x00w4\x7fw5")]
    items = [(i, say(int(n))) for i, n in enumerate(rng.integers(1, 30, 25))]
    return docs, items + [(0, "w1 W1 w1"), (30, None), (31, ""), (32, "unseen"), (33, docs[3][1]), (34, "é Éß 中文")]


def test_terms():
    for text in ["Aé1_b C d\x00x Éİ ~中文;z\x7fq", "", "\ud800a", "ẞ İ"]:
        assert [t.decode("utf-8", "surrogatepass") for t in terms_of(text)] == words(text)


@pytest.mark.parametrize("block_bytes, parts", [(ranked_search.BLOCK_BYTES, 1), (200, 5)])
def test_search_equals_scoring_everything(spark, block_bytes, parts):
    docs, items = corpus()
    table = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, rank string").repartition(parts)
    asked = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, score int")
    got = ranked_search.search(table, asked, block_bytes=block_bytes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(docs, items), key=key)


def test_creation_stops_and_survivors_stay_exact():
    docs, _ = corpus()
    rng = np.random.default_rng(6)
    vocabulary = {f"w{i}".encode(): i for i in range(300)}
    bags = [(d, Counter(terms_of(t))) for d, t in docs if d is not None and terms_of(t or "")]
    postings = [[(vocabulary[t], n) for t, n in bag.items() if t in vocabulary] for _, bag in bags]
    n_terms = sum(sum(b.values()) for _, b in bags)
    df = np.bincount([t for p in postings for t, _ in p], minlength=300)
    weight = ranked_search.weights(len(bags), df)
    shard = Shard([d for d, _ in bags], [sum(b.values()) for _, b in bags], postings, weight, len(bags), n_terms)
    fewer = 0
    for _ in range(100):
        terms = sorted(((int(t), int(n)) for t, n in zip(rng.choice(300, 12, replace=False), rng.integers(1, 3, 12))),
                       key=lambda x: -weight[x[0]])
        total = np.zeros(len(bags), np.int64)
        for t, times in terms:
            p = shard.place.get(t)
            if p is not None:
                at = slice(shard.first[p], shard.first[p + 1])
                total[shard.doc[at]] += shard.score[at] * times
        for k, floor in ((1, 0), (10, 0), (10, int(np.sort(total)[-3]))):
            live, scores = shard.search(terms, k, floor)
            limit = max(int(np.sort(total)[-k]), floor, 1)
            assert set(np.flatnonzero(total >= limit)) <= set(live)
            assert (scores == total[live]).all()
            fewer += len(live) < (total > 0).sum()
    assert fewer > 200


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert ranked_search.search(none, items).count() == 0
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert ranked_search.search(docs, items.limit(0)).count() == 0
    assert ranked_search.search(docs, items.withColumn("text", items.text.substr(1, 0))).count() == 0


def test_registered_query(spark, duck):
    got = registry.op13_ranked_search(spark, SF_SMALL)
    assert sorted(map(tuple, got.collect())) == sorted(duck.execute(registry.OP13_SQL).fetchall())
