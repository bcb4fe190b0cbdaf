"""Operator 8: SentencePiece encoding and decoding for merge-type vocabularies.

``PieceEncoder`` merges adjacent symbols from a score-ordered agenda: a
heap of adjacent pairs whose concatenation is a vocabulary piece, best
score first, leftmost on ties; entries made stale by an earlier merge are
skipped. Symbols left outside the vocabulary fall back to byte pieces.

No piece of such a vocabulary mixes letters with other characters, and the
space mark only stands in front, so merges never cross those borders: a
text is cut there and the agenda runs once per distinct chunk, behind a
bounded cache. The loader checks that property and otherwise encodes texts
whole. In every Arrow batch each newly encoded chunk, and one whole text,
are compared with the sentencepiece library; a difference raises.

Defined results: null or empty text has the begin and end ids only and
decodes to the empty string; repeated rows are encoded each for itself;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import row_slices, texts_of

SPACE = "▁"
#: Chunks per generation of the cache; two are kept (about 200 bytes a chunk).
CACHE_CHUNKS = 400_000
#: Numerals that the regular expressions' word class counts among the letters.
_NUMERAL = "²³¹¼-¾⁰-ₙ⅐-↉①-⓿❶-➓"
_CHUNK = re.compile(rf"{SPACE}*[^\W\d_{_NUMERAL}]+|{SPACE}*(?:[\d_{_NUMERAL}]|[^\w{SPACE}])+|{SPACE}+")


class PieceEncoder:
    """Encodes and decodes texts with one SentencePiece model file."""

    def __init__(self, model_file: str, cache_chunks: int = CACHE_CHUNKS):
        import sentencepiece

        self._library = sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self._begin, self._end, self._limit = sp.bos_id(), sp.eos_id(), cache_chunks
        self._id: dict[str, int] = {}
        self._byte: list[int] = [sp.unk_id()] * 256
        scores: dict[str, float] = {}
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self._byte[int(piece[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i)):
                self._id[piece] = i
                scores[piece] = sp.get_score(i)
        order = {s: k for k, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self._rank = {piece: order[s] for piece, s in scores.items()}
        # A piece may begin with space marks; the rest must be one chunk for texts to be cut.
        self._cut = all(_CHUNK.fullmatch(piece) for piece in self._id)
        self._cache: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._probe = len(sp.encode("\n"))           # ids of the space mark and of a line feed

    def merge(self, chunk: str) -> list[int]:
        """Ids of one chunk by the agenda."""
        symbols = list(chunk)
        n, rank = len(symbols), self._rank
        after = list(range(1, n + 1))
        ahead = list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            pair = symbols[i] + symbols[i + 1]
            if pair in rank:
                agenda.append((rank[pair], i, pair))
        heapify(agenda)
        while agenda:
            _, i, pair = heappop(agenda)
            j = after[i]
            if j >= n or not symbols[i] or symbols[i] + symbols[j] != pair:
                continue                               # an earlier merge took one of the two
            symbols[i], symbols[j] = pair, ""
            j = after[i] = after[j]
            if j < n:
                ahead[j] = i
                longer = pair + symbols[j]
                if longer in rank:
                    heappush(agenda, (rank[longer], i, longer))
            h = ahead[i]
            if h >= 0:
                longer = symbols[h] + pair
                if longer in rank:
                    heappush(agenda, (rank[longer], h, longer))
        out = []
        for s in symbols:
            if s in self._id:
                out.append(self._id[s])
            elif s:
                out.extend(self._byte[b] for b in s.encode())
        return out

    def _learn(self, chunks: set[str]) -> None:
        """Encode new chunks and compare each with the library."""
        if len(self._cache) > self._limit:
            self._older, self._cache = self._cache, {}
        known = {c: self._older[c] for c in chunks if c in self._older}
        self._cache.update(known)
        new = list(chunks.difference(known))
        # A line feed in front keeps the library's own space mark away from the chunk.
        theirs = self._library.encode(["\n" + c.replace(SPACE, " ") for c in new], num_threads=1)
        for chunk, found in zip(new, theirs):
            ids = self.merge(chunk)
            if ids != found[self._probe:]:
                raise ValueError(f"agenda and library differ on {chunk!r}: {ids} and {found[self._probe:]}")
            self._cache[chunk] = array("I", ids).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids between the begin and end ids, as little-endian unsigned 32-bit bytes."""
        lists, gaps, unseen = [], [], set()
        find = self._cache.get
        for i, text in enumerate(texts):
            marked = SPACE + text.replace(" ", SPACE) if text else ""
            chunks = _CHUNK.findall(marked) if self._cut else [marked] * bool(marked)
            ids = list(map(find, chunks))
            if None in ids:
                new = {k: chunks[k] for k, x in enumerate(ids) if x is None}
                unseen.update(new.values())
                gaps.append((i, new))
            lists.append(ids)
        if gaps:
            self._learn(unseen)
            for i, new in gaps:
                ids = lists[i]
                for k, chunk in new.items():
                    ids[k] = self._cache[chunk]
        begin, end = (array("I", [x]).tobytes() for x in (self._begin, self._end))
        out = [begin + b"".join(ids) + end for ids in lists]
        if texts:
            whole = self._library.encode(texts[0], add_bos=True, add_eos=True)
            if array("I", whole).tobytes() != out[0]:
                raise ValueError("agenda and library differ on a whole text")
        return out

    def decode(self, ids: list[bytes]) -> list[str]:
        """The library's decoding of each id sequence."""
        return self._library.decode([np.frombuffer(x, dtype="<u4").tolist() for x in ids], num_threads=1)


@lru_cache(maxsize=2)
def piece_encoder(model_file: str) -> PieceEncoder:
    """One encoder per Python worker: tasks that follow find its cache filled."""
    return PieceEncoder(model_file)


def encode_decode(docs: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, ids, decoded) of every text; ids are 4-byte little-endian."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(model_file)
        for batch in batches:
            texts = texts_of(batch.column(1))
            for lo, hi in row_slices([4 * len(t) for t in texts]):
                ids = encoder.encode(texts[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(ids, pa.binary()),
                     pa.array(encoder.decode(ids), pa.string())], ["doc_id", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        run, "doc_id long, ids binary, decoded string")
