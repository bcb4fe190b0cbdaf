"""Texts that libraries or patterns choke on: long runs, many labels, every code point of a range."""

import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoplens.llm import pii_votes, registry, token_counts
from shoplens.llm.word_ids import WordEncoder


def test_every_code_point_of_the_safe_range():
    from tokenizers import Tokenizer

    path = registry.tokenizer_file("word_bpe_49k.json")
    lib, own = Tokenizer.from_file(path), WordEncoder(path)
    around = ["{0}", "a{0}b", "A {0}{0} B", "1{0}2", "!{0}?", "é{0}ß{0}", "'{0}s"]
    texts = [a.format(chr(c)) for c in range(0x280) if unicodedata.category(chr(c)) != "Cs" for a in around]
    want = [np.array(e.ids, "<u4").tobytes() for e in lib.encode_batch(texts, add_special_tokens=False)]
    assert own.encode(texts) == want


def test_long_runs_of_white_space():
    import public_tokenizers as P

    path = registry.tokenizer_file("byte_bpe_50k.tiktoken")
    encoding = token_counts.rank_encoding(path, P.PATTERN)
    rng = np.random.default_rng(1)
    white = list(" \t\n\r\x0b\x0c\x85\xa0　 ")
    short = token_counts.length_counter(path, P.PATTERN, 3)          # the same cut, where the library can follow
    for _ in range(300):
        parts = [str(rng.choice(["a", "b1", "'s", "!", "é", "\x1c", "​", "7"])) if rng.random() < .4
                 else "".join(rng.choice(white, rng.integers(1, 12))) for _ in range(rng.integers(1, 9))]
        text = "".join(parts)
        assert short(text) == len(encoding.encode_ordinary(text)), repr(text)
    count = token_counts.length_counter(path, P.PATTERN)
    for text in (" " * 20_000, "a" + " \n" * 8_000 + "b", " " * 5_000 + "x" + "\t" * 5_000):
        assert count(text) == len(encoding.encode_ordinary(text))
    assert count(" " * 1_000_000) > 0 and count("x" + " \n" * 500_000 + "y") > 0
    for c in "a1!é":
        assert count(c * 1_000_000) > 0


@pytest.mark.parametrize("text, kind, n", [
    ("a@" + "b." * 100_000 + "c", "email", 1), ("x [at] y" + " [dot] z" * 30_000, "email", 0), ("1." * 40_000 + "1", "ip", 10_000),
    ("4 " * 100_000, "card", 0), ("+1" + " (2" * 100_000, "phone", 0), ("ab:" * 100_000, "ip", 0), ("a@b.c " * 10_000, "email", 10_000)])
def test_personal_data_in_very_long_matches(spark, text, kind, n):
    docs = spark.createDataFrame([(1, text), (2, "no")], "doc_id long, text string")
    found, spans = pii_votes.find_spans(docs, carry=["doc_id"])
    got = {r.doc_id: r.n for r in found.select("doc_id", F.size(F.filter(spans, lambda s: s["base"] & (
        s["kind"] == pii_votes.KINDS.index(kind)))).alias("n")).collect()}
    assert got[2] == 0 and (n is None or got[1] == n)
