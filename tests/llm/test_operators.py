"""Training-data operators against brute force on a small, awkward table."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from shoplens.config import store
from shoplens.llm import (chunk_dedup, host_rules, line_dedup, ngram_quality, packing, pii_votes, registry, set_join,
                          token_counts, url_templates)
from shoplens.llm.list_compare import near_pairs, parity_bits, parity_distance
from shoplens.llm.piece_bpe import PieceEncoder
from shoplens.llm.shingles import shingle_set
from shoplens.llm.window_plan import closest_fill, plan_windows
from tests.conftest import SF_SMALL

WORDS = "the of and in to river stone light over under green paper small ocean never again winter".split()
SPACE = "[^\x20\x09-\x0d]+"


def _texts():
    rng = np.random.default_rng(5)
    say = lambda n: " ".join(WORDS[i] + str(rng.integers(0, 40)) for i in rng.integers(0, len(WORDS), n))
    base, line = say(200), say(30)
    out = [None, "", " \n\t ", "one", "One", "a b c", base, base, base.upper(), base + " tail", base.replace("the", "a", 1),
           "Mail Bob@mail.example.com or +1 (521) 555-6210, card 4111 1111 1111 1111, ip 10.0.0.255 999.1.1.1 "
           "a@b.com_x@y.org 1.2.3.4.5.6.7.8", "É\u00df\u0130 caf\u00e9 na\u00efve \u4e2d\u6587 \U0001f600 <s> <|endoftext|> \u2581x  y",
           f"intro\n{line}\nend", f"{line.upper()}\nother", ("x y z " * 50).strip(), "same line here\n" * 6, say(6000)]
    return out + [say(int(n)) for n in rng.integers(5, 120, 40)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 3 else None, None if i == 9 else f"s{i % 4}", -1, True, "x") for i, t in enumerate(_texts())]
    rows.append((7, _texts()[7], "en", "s1", -1, False, None))          # a repeated doc_id
    return store(spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, kept boolean, row string"), "fixture")


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]


def test_plan_places_every_token_once():
    rng = np.random.default_rng(1)
    for _ in range(30):
        cap = int(rng.choice([8, 64, 100]))
        hist = {int(k): int(rng.integers(1, 50)) for k in rng.integers(1, cap, 6)}
        slots, n = plan_windows(hist, cap)
        fill, pieces = defaultdict(list), defaultdict(list)
        for s in slots:
            for rank in range(s.lo, s.hi):
                i = s.i0 + rank - s.lo
                fill[s.first_seq + i // s.per_window].append((s.base + i % s.per_window * s.size, s.size))
                pieces[s.length, rank].append((s.cut, s.size))
        assert set(fill) == set(range(n)) and len(pieces) == sum(hist.values())
        for k, (length, _rank) in zip(pieces.values(), pieces):
            at = 0
            for cut, size in sorted(k):
                assert cut == at
                at += size
            assert at == length
        for f in fill.values():
            at = 0
            for off, size in sorted(f):
                assert off == at
                at += size
            assert at == cap or at & (at - 1) == 0


def test_closest_fill_is_optimal():
    counts = {3: 2, 5: 1, 9: 4}
    sums = {3 * a + 5 * b + 9 * c for a in range(3) for b in range(2) for c in range(5)}
    for room in range(1, 40):
        uses = closest_fill(sorted(counts), counts, room)
        assert sum(k * n for k, n in uses.items()) == max(s for s in sums if s <= room)
        assert all(n <= counts[k] for k, n in uses.items())


def test_packing(docs, rows):
    from tokenizers import Tokenizer

    path = registry.tokenizer_file("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    out = packing.pack(docs, path, salts=3).collect()
    fill, by_doc = defaultdict(list), defaultdict(list)
    for r in out:
        assert len(r.ids) == 4 * r.length
        fill[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    for d, t in rows:
        if d != 7:
            ids = b"".join(r.ids for r in sorted(by_doc[d], key=lambda r: r.start))
            assert ids == np.array(lib.encode(t, add_special_tokens=False).ids + [2], "<u4").tobytes()
    for f in fill.values():
        at = 0
        for off, size in sorted(f):
            assert off == at
            at += size
        assert at <= 4096 and (at == 4096 or at & (at - 1) == 0)


def test_sentencepiece_equals_library():
    import sentencepiece

    path = registry.tokenizer_file("piece_bpe_32k.model")
    lib, own = sentencepiece.SentencePieceProcessor(model_file=path), PieceEncoder(path, cache_chunks=20)
    texts = [t or "" for t in _texts()]
    for batch in (texts[:20], texts[20:], texts):
        ids = own.encode(batch)
        want = [lib.encode(t, add_bos=True, add_eos=True) for t in batch]
        assert [np.frombuffer(x, "<u4").tolist() for x in ids] == want
        assert own.decode(ids) == [lib.decode(x) for x in want]


@pytest.mark.parametrize("bits", [64, 2])
def test_exact_duplicates_even_when_digests_collide(docs, rows, bits):
    table, decisions, names = chunk_dedup.exact_duplicates(docs, digest_bits=bits, sizes=(16, 64, 256))
    key = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)
    groups = defaultdict(list)
    for d, t in rows:
        groups[key(t)].append(d)
    got = table.join(decisions, table[names["row"]] == decisions["row"]).select(
        "doc_id", "text", "keep_id", "group_size", decisions["kept"].alias("stays")).collect()
    for r in got:
        g = groups[key(r.text or "")]
        assert (r.keep_id, r.group_size) == (max(g), len(g))
    assert sum(r.stays for r in got) == len(groups) and all(r.doc_id == r.keep_id for r in got if r.stays)


def test_base_spans(docs, rows):
    found, name = pii_votes.find_spans(docs.drop("kept"), carry=["doc_id", "text"])
    for r in found.collect():
        assert {(s.start, s.kind, s.end) for s in r[name] if s.base} == set(_base_spans(r.text or ""))
    text = {r.doc_id: r.text for r in pii_votes.redact(docs).collect()}
    assert "<EMAIL>" in text[11] and "<PHONE>" in text[11] and "4111" not in text[11] and text[0] is None


def _base_spans(text):
    patterns = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]
    for k, p in enumerate(patterns):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(v - 9 * (v > 9) for v in (int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))))
            if (k == 0 or k == 1 and all(int(x) <= 255 for x in m[0].split("."))
                    or k == 2 and 14 <= len(digits) <= 19 and luhn % 10 == 0 or k == 3 and 10 <= len(digits) <= 15):
                yield m.start(), k, m.end()


def test_votes_agree_with_certain_spans():
    sure, no = (1, 1, 1), (-1, -1, 0)
    p = pii_votes.estimate([(0, sure, 50), (0, no, 40), (0, (1, 1, 0), 30)])
    assert p[0, sure] > 0.9 and p[0, no] < 0.1 and p[0, (1, 1, 0)] > 0.5


def test_quality_metrics(docs, rows):
    judged, names = host_rules.judge(docs)
    for r in judged.collect():
        t, m = r.text or "", r[names["metrics"]]
        w = re.findall(SPACE, t)
        at = defaultdict(list)
        for i in range(len(w) - 4):
            at[tuple(w[i:i + 5])].append(i)
        cover = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(5)}
        lines = [x for x in t.split("\n") if re.search(SPACE, x)]
        assert (m.n_words, m.word_chars, m.n_repeat_words, m.n_dup_lines, m.n_symbols) == (
            len(w), sum(map(len, w)), len(cover), len(lines) - len(set(lines)), len(re.findall("[#*$%&|<>]", t)))
        assert r[names["base_failed"]] == (len(w) < 10 or 100 * len(cover) > 20 * len(w))


def _components(sets):
    up = list(range(len(sets)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 85 * len(a | sets[j]):
                up[max(top(i), top(j))] = min(top(i), top(j))
    return [top(i) for i in range(len(sets))]


def _words(text):
    return re.findall(SPACE, re.sub("[A-Z]", lambda m: m[0].lower(), text))


@pytest.mark.parametrize("common", [8, 1])
def test_set_components(spark, docs, rows, common):
    found = set_join.set_components(set_join.keyed(docs.drop("row"), ["doc_id", "text"]), common=common).collect()
    sets = [frozenset(tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))) if w else frozenset()
            for w in (_words(t) for _, t in rows)]
    names = _components(sets)
    least = defaultdict(lambda: 1 << 60)
    for (d, _), c in zip(rows, names):
        least[c] = min(least[c], d)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == Counter(
        (d, len(s), least[c]) for (d, _), s, c in zip(rows, sets, names))


def test_parity_bounds_the_distance():
    a, b = shingle_set(_texts()[6], 4), shingle_set(_texts()[9], 4)
    assert parity_distance(parity_bits(a), parity_bits(b)) <= len(np.setxor1d(a, b)) == 1
    n = np.array([len(a), len(b)])
    args = dict(n=n, pos=np.zeros(2, int), anchor=np.array([1, 2]), dist=np.zeros(2, int),
                parity=[parity_bits(a), parity_bits(b)], side=np.zeros(2, int), split=False, num=85, den=100)
    assert near_pairs(np.array([1, 2]), label=np.array([1, 2]), **args)
    assert not near_pairs(np.array([1, 2]), label=np.array([1, 1]), **args)


def test_length_histogram(docs, rows):
    import public_tokenizers

    path = registry.tokenizer_file("byte_bpe_50k.tiktoken")
    enc = token_counts.rank_encoding(path, public_tokenizers.PATTERN)
    lens = defaultdict(list)
    for r in docs.collect():
        lens[r.lang].append(len(enc.encode_ordinary(r.text or "")))
    for r in token_counts.length_histogram(docs, path, public_tokenizers.PATTERN).collect():
        v = lens[r.grp]
        assert (r.n_docs, r.docs_ge, r.tokens_ge, r.truncated_tokens, r.rank_hi) == (
            v.count(r.length), sum(x >= r.length for x in v), sum(x for x in v if x >= r.length),
            sum(min(x, r.length) for x in v), sum(x <= r.length for x in v))


def test_url_rules(spark):
    pages = spark.createDataFrame([(1, "http://WWW.Example.com/en/5?x"), (2, "https://a.example.com/en/1"), (3, None),
                                   (4, "nothing"), (5, "ftp://x.net/es/"), (6, "http://y.com"), (7, "http://z.net#/fr/")],
                                  "page_id long, url string")
    labels = spark.createDataFrame([(7, 1)] * 2, "page_id long, bad int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict)
           for r in url_templates.judge_urls(pages, labels, registry.URL_RULES).collect()}
    assert got[1] == ("www.example.com", "/en/5", "www.example.com/en/", "allow")
    assert got[2] == ("a.example.com", "/en/1", "example.com/en/", "block") and got[3][:3] == ("", "", None) == got[4][:3]
    assert got[5][2:] == ("net/es/", "block") and got[6][:3] == ("y.com", "", None) and got[7][:3] == ("z.net", "", None)


def test_ngram_quality_separates(spark):
    rng = np.random.default_rng(3)
    clean = [(i, " ".join(rng.choice(WORDS, 60)), "en") for i in range(120)]
    junk = [(1000 + i, "".join(chr(c) for c in rng.integers(33, 90, 200)), "en") for i in range(10)]
    docs = spark.createDataFrame(clean + junk + [(2000, None, None)], "doc_id long, text string, lang string")
    trusted = spark.createDataFrame([(i,) for i in range(100)], "doc_id long")
    one, many = ({r.doc_id: r for r in ngram_quality.perplexities(docs, trusted, shard_rows=k).collect()} for k in (10**6, 150))
    # The limit is the largest of about 20 held-out texts, so some texts of the same kind lie above it.
    assert sum(one[i].kept for i in range(120)) >= 100 and not any(one[1000 + i].kept for i in range(10))
    assert one[2000].perplexity is None and not one[2000].kept
    assert all(abs(one[i].perplexity - many[i].perplexity) < 1e-3 for i in range(120))


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, none, "")
        assert out.count() == 0, name
        assert name == "pack_windows" or out.columns == docs.columns
    assert line_dedup.repeated_units(none).count() == 0


def test_pipeline_stages(spark, docs):
    out = docs
    for name, stage in corpus_pipeline.STAGES:
        out = store(stage(spark, out, ""), "test_stage")
        assert name == "pack_windows" or out.columns == docs.columns
    assert out.groupBy("doc_id").count().count() > 20


def test_runs_do_not_touch_each_other(spark):
    first = corpus_pipeline.run(spark, SF_SMALL)
    rows = sorted(map(tuple, first.collect()))
    second = corpus_pipeline.run(spark, SF_SMALL)
    assert sorted(map(tuple, first.collect())) == rows == sorted(map(tuple, second.collect()))
