"""Repeated passages against a plain reading of the docstring."""

import re
import time
from collections import defaultdict

import numpy as np
import pytest

from shoplens.config import store
from shoplens.llm import line_dedup, registry

WORDS = [f"w{i}" for i in range(500)]


def _say(rng, n):
    """Words with clauses, sentences and lines."""
    out = []
    for w in rng.choice(WORDS, n):
        out.append(w + str(rng.choice(["", "", "", "", ",", ".", ";"])))
    return "".join(w + str(rng.choice([" ", " ", " ", " ", "\n", "  "])) for w in out)


def _texts():
    rng = np.random.default_rng(2)
    passage = _say(rng, 70)
    wrapped = re.sub(r"\s+", " ", passage)
    out = [None, "", "\n \n", "one", "intro\nshort line\nend", "Short  LINE\n\nnew", "short line", "}\n{\n}", ". . .",
           "É \U0001f600\r\né \U0001f600", passage, f"Before it. {wrapped} After it.", f"{_say(rng, 40)}\n{passage.upper()}\n{_say(rng, 40)}",
           "\n".join(wrapped.split(" ")), ("Same line here, again.\n" * 12), "a b\nc d\n\na b c d", "a b c d", "a b\n\nc d",
           "word " * 200, "word " * 200]
    return out + [_say(rng, int(n)) for n in rng.integers(1, 90, 20)]


def _units(text):
    """[(start, end, words)], {(first, last piece): normalised}: read line by line, paragraph by paragraph."""
    spans, units, at, paragraph = [], {}, 0, []
    lines = text.split("\n")
    for i, line in enumerate(lines):
        pos, found = 0, []
        for m in [*re.finditer(r"(?<=[.!?,;:])[^\S\n]+", line), None]:
            end = m.start() if m else len(line)
            norm = " ".join(line[pos:end].lower().split())
            if norm:
                found.append((at + pos, at + end, norm))
            pos = m.end() if m else end
        at += len(line) + 1
        for f in found:
            units[len(spans), len(spans)] = f[2]
            paragraph.append(len(spans))
            spans.append(f)
        if not found or i == len(lines) - 1:
            clause = []
            for k in paragraph:
                clause.append(k)
                if spans[k][2][-1] in ".!?,;:" or k == paragraph[-1]:
                    units[clause[0], clause[-1]] = " ".join(spans[x][2] for x in clause)
                    clause = []
            paragraph = []
    return [(a, b, len(n.split())) for a, b, n in spans], units


def _expected(rows, run_words):
    earliest, per = {}, []
    for k, (d, t) in sorted(enumerate(rows), key=lambda r: (r[1][0], r[0])):
        spans, units = _units(t)
        held, seen = [False] * len(spans), set()
        for (lo, hi), norm in sorted(units.items()):
            first = earliest.setdefault(norm, k)
            if first != k or norm in seen:
                held[lo:hi + 1] = [True] * (hi + 1 - lo)
            seen.add(norm)
        runs, cut = [[]], []
        for i, h in enumerate(held):
            runs[-1].append(i) if h else runs.append([])
        for r in runs:
            if sum(spans[i][2] for i in r) >= run_words:
                cut += [spans[i][:2] for i in r]
        per.append((d, len(spans), len(cut), cut, [spans[i][:2] for i, h in enumerate(held) if h]))
    return sorted(per)


@pytest.mark.parametrize("run_words", [1, line_dedup.RUN_WORDS])
def test_equals_brute_force(spark, run_words):
    rows = list(enumerate(_texts()))
    docs = store(spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, row string, at int").coalesce(1),
                 "unit_texts")
    got = sorted((r.doc_id, r.n_pieces, r.n_removed, [tuple(s) for s in r.removed], [tuple(s) for s in r.repeated])
                 for r in line_dedup.repeated_units(docs, run_words).collect())
    assert got == _expected([(d, t or "") for d, t in rows], run_words)
    if run_words > 1:
        removed = {g[0]: g[2] for g in got}
        assert removed[10] == 0 and all(removed[d] > 0 for d in (11, 12, 13, 14, 19)) and removed[6] == 0
        assert {g[0]: g[4] for g in got}[6] == [(0, 10)]           # a short repeat is told, not removed


def test_repeated_rows_and_null_ids(spark):
    text = "Some words that fill a line, and more words of the same passage; it goes on and on and on until it is long enough to count."
    docs = spark.createDataFrame([(5, text), (5, text), (None, text), (1, "other")], "doc_id long, text string")
    got = defaultdict(list)
    for r in line_dedup.repeated_units(docs, 10).collect():
        got[r.doc_id].append(r.n_removed)
    assert got == {None: [0], 1: [0], 5: [3, 3]}


def test_very_long_texts_take_linear_time(spark):
    texts = ["\n".join(f"line {i} of the log" for i in range(300_000)), "x" * 2_000_000, " " * 1_000_000, "a. " * 300_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    start = time.time()
    got = {r.doc_id: (r.n_pieces, r.n_removed) for r in line_dedup.repeated_units(docs).collect()}
    assert got == {0: (300_000, 0), 1: (1, 0), 2: (0, 0), 3: (300_000, 299_999)} and time.time() - start < 90


def test_registered_query(spark, tmp_path):
    long = ", ".join(f"clause {i} of it" for i in range(9))
    spark.createDataFrame([(1, f"Keep.\n{long}"), (2, f"New. {long}. Keep.")], "doc_id long, text string").write.parquet(
        str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.n_pieces, r.n_removed, r.removed, r.repeated) for r in registry.op4_line_dedup(spark, str(tmp_path)).collect()}
    assert got[1] == (10, 0, "", "")
    assert got[2][:2] == (11, 8) and got[2][3] == got[2][2] + f",{len(long) + 7}:{len(long) + 12}"
