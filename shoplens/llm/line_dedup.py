"""Operator 4: passages that repeat across the corpus, by hashed lines and clauses.

Units.     Lines are cut further after ``.!?,;:`` and white space; the pieces
           with a word are the units, so a passage inside a longer line has
           units of its own. Where a line break falls inside a clause, the
           clause across the lines of its paragraph is a unit as well, so a
           passage broken into other lines is found too. A line or paragraph
           repeats when all its pieces do.
Digests.   Units are normalised (lower case, white space collapsed) and
           hashed to 128 bits. In its own text a unit's first occurrence
           stands for the others; those first ones are grouped globally with
           map-side combining, and the earliest by (doc_id, row) stays.
Removal.   Adjacent repeated pieces of a text form a run; a run of at least
           ``run_words`` words is removed, with the offsets of its pieces in
           the original text. Passages of over 50 words lose at most a clause
           at either end. Every repeated piece, in a run or not, is returned
           with its offsets too, so no link is lost to that limit.

Only digests and piece numbers are shuffled. A digest that a third of all
texts share is one row of each task in the grouping; its occurrences meet it
in a join of stored tables, which the adaptive skew join can split.

Defined results: null or empty text has no pieces and nothing to remove;
repeated rows lose all their long runs but the first row's; null doc_ids
rank first; texts of any length are read whole, in linear time; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.config import store
from shoplens.llm.common import row_slices, texts_of, with_row_key

#: Words of adjacent repeated pieces from which they are removed.
RUN_WORDS = 30

_CUT = re.compile(r"(?<=[.!?,;:])[^\S\n]+|\n")
_ENDS = (".", "!", "?", ",", ";", ":")

_PIECES = ("doc_id long, starts array<int>, ends array<int>, words array<int>, own_at array<int>, own_n array<int>, "
           "at array<int>, n array<int>, h1 array<long>, h2 array<long>")
_RUNS = ("row long, doc_id long, n_pieces long, n_removed long, removed array<struct<start: int, end: int>>, "
         "repeated array<struct<start: int, end: int>>")


def pieces_of(text: str) -> Iterator[tuple[int, int, str, bool]]:
    """(start, end, normalised text, last of its line) of every piece, also of those without a word."""
    at = 0
    for m in _CUT.finditer(text):
        yield at, m.start(), " ".join(text[at:m.start()].lower().split()), m.group()[-1] == "\n"
        at = m.end()
    yield at, len(text), " ".join(text[at:].lower().split()), True


def units_of(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, str]]]:
    """Pieces with a word as (start, end, words); units as (first piece, pieces, normalised text) in order."""
    spans, units, joined, bare = [], [], [], True
    for start, end, norm, breaks in pieces_of(text):
        if norm:
            bare = False
            units.append((len(spans), 1, norm))
            joined.append(norm)
            spans.append((start, end, norm.count(" ") + 1))
        blank = breaks and bare                                    # a line without a word ends its paragraph
        if joined and (blank or joined[-1].endswith(_ENDS)):
            if len(joined) > 1:
                units.append((len(spans) - len(joined), len(joined), " ".join(joined)))
            joined = []
        bare = breaks or bare
    if len(joined) > 1:
        units.append((len(spans) - len(joined), len(joined), " ".join(joined)))
    return spans, sorted(units)


def _lists(rows: list[list], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array([x for r in rows for x in r], kind))


def _hash_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = texts_of(batch.column(1))
        for lo, hi in row_slices([len(t) for t in texts]):
            out: list[list[list]] = [[] for _ in range(9)]
            for text in texts[lo:hi]:
                spans, units = units_of(text)
                seen: set[bytes] = set()
                own, new, digests = [], [], []
                for at, n, norm in units:
                    h = blake2b(norm.encode("utf-8", "surrogatepass"), digest_size=16).digest()
                    if h in seen:
                        own.append((at, n))
                    else:
                        seen.add(h)
                        new.append((at, n))
                        digests.append(h)
                pairs = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                for k, x in enumerate((*([s[i] for s in spans] for i in range(3)), *([u[i] for u in own] for i in range(2)),
                                       *([u[i] for u in new] for i in range(2)), pairs[:, 0], pairs[:, 1])):
                    out[k].append(x)
            kinds = [pa.int32()] * 7 + [pa.int64()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), *(_lists(x, k) for x, k in zip(out, kinds))],
                ["doc_id", "starts", "ends", "words", "own_at", "own_n", "at", "n", "h1", "h2"])


def long_runs(words: list[int], repeated: list[tuple[int, int]], run_words: int) -> tuple[list[int], list[int]]:
    """(pieces in runs to remove, all repeated pieces); ``repeated`` are units as (first piece, pieces)."""
    step = np.zeros(len(words) + 1, np.int64)
    for at, n in repeated:
        step[at] += 1
        step[at + n] -= 1
    held = np.cumsum(step[:-1]) > 0
    edge = np.flatnonzero(np.diff(np.concatenate(([False], held, [False])).astype(np.int8)))
    total = np.concatenate(([0], np.cumsum(words)))
    cut: list[int] = []
    for lo, hi in zip(edge[::2], edge[1::2]):
        if total[hi] - total[lo] >= run_words:
            cut.extend(range(lo, hi))
    return cut, np.flatnonzero(held).tolist()


def _merge_runs(run_words: int):
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_pieces", pa.int64()), ("n_removed", pa.int64()),
                        ("removed", spans), ("repeated", spans)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, doc_id, starts, ends, words, own_at, own_n, found in zip(*[c.to_pylist() for c in batch.columns]):
                units = [*zip(own_at, own_n), *((u["at"], u["n"]) for u in found or ())]
                cut, held = long_runs(words, units, run_words)
                place = lambda ks: [{"start": starts[k], "end": ends[k]} for k in ks]
                out.append((row, doc_id, len(starts), len(cut), place(cut), place(held)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)],
                                             schema=schema)

    return run


def repeated_units(docs: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """One row per document: row, doc_id, n_pieces, n_removed, removed and repeated (arrays of start and end)."""
    hashed = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_hash_units, _PIECES)
    table = store(with_row_key(hashed, "row"), "text_pieces")
    each = table.select("row", "doc_id", F.explode(F.arrays_zip("at", "n", "h1", "h2")).alias("u")).select(
        "row", "doc_id", "u.*")
    firsts = store(each.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("held"), F.min(F.struct("doc_id", "row")).alias("first"))
                   .filter("held > 1").select("h1", "h2", F.col("first.row").alias("first_row")), "repeated_digests")
    again = each.drop("doc_id").join(firsts, ["h1", "h2"]).filter("row <> first_row")
    found = again.groupBy("row").agg(F.collect_list(F.struct("at", "n")).alias("found"))
    return (table.select("row", "doc_id", "starts", "ends", "words", "own_at", "own_n").join(found, "row", "left")
            .mapInArrow(_merge_runs(run_words), _RUNS))
