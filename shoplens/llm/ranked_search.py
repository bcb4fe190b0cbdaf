"""Operator 13: ranked lexical search by accumulator-limited term-at-a-time.

The corpus is dealt by document: every task holds a shard of documents at a
time (``SHARD_POSTINGS`` bounds it), indexes the shard's postings of query
terms, and answers every query of the block term at a time:

1. terms go rarest first (largest weight first); each posting creates or
   feeds its document's accumulator;
2. before the next term, the largest scores that the remaining terms can
   still give in this shard are summed. Once that sum is below the kth
   partial score (of this shard or of the task's earlier shards), a document
   without an accumulator can no longer reach the top k, not even as a tie:
   no accumulator is created any more;
3. the survivors, accumulators that with the rest can still reach the kth
   partial score, are updated exactly with the remaining terms, by look-up
   in each term's sorted postings.

The task carries each query's k best from shard to shard and hands them on
at its end; a partial top k per query merges the tasks. Only ``k`` rows per
(task, query) leave a task, whatever a term's document frequency is.

Scores are integers throughout (the weight's logarithm apart): with N
documents holding a term at all, L their terms, n a document's terms, df a
term's documents and tf its count, ``w = floor(1000 ln((2N+2)/(2df+1)))``,
``m = 25 + 75nN div L`` and a term gives ``w * (10^9 tf div (1000tf + 8m))``,
once for each time that it is in the query.

Queries are taken in blocks of ``BLOCK_BYTES`` of text: a block's vocabulary,
weights and queries are what every task is sent, so what is broadcast is
bounded however many queries there are. Each block costs two passes over the
texts (document frequencies; scores); nothing of the corpus is stored.

Defined results: terms are runs of ASCII letters, digits and non-ASCII
characters, only A-Z lower-cased; null or empty texts (document or query)
have no terms and never appear; texts of any length are read whole; every
row is a document or a query of its own, also where ids repeat; equal scores
rank by ascending doc_id, a null doc_id last; an empty table on either side
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.config import store
from shoplens.llm.common import free_name, texts_of

#: Query text of one block, in bytes (at least one query).
BLOCK_BYTES = 8 << 20
#: Postings that a task indexes at a time.
SHARD_POSTINGS = 4_000_000

_TERM = bytes(b if chr(b).isalnum() and b < 128 or b >= 128 else 32 for b in range(256)).lower()


def terms_of(text: str) -> list[bytes]:
    """The terms of a text in order, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_TERM).split()


@dataclass(frozen=True)
class QueryBlock:
    """Queries of a block; ``terms[i]`` are (term id, times) of query ``i``."""

    ids: list
    vocabulary: dict[bytes, int]
    terms: list[list[tuple[int, int]]]


def query_block(rows: list[tuple[object, str]]) -> QueryBlock:
    vocabulary: dict[bytes, int] = {}
    terms = [[(vocabulary.setdefault(t, len(vocabulary)), n) for t, n in Counter(terms_of(text)).items()]
             for _, text in rows]
    return QueryBlock([i for i, _ in rows], vocabulary, terms)


def query_blocks(queries: DataFrame, id_col: str, text_col: str, limit: int) -> Iterator[QueryBlock]:
    """The queries in blocks of bounded text, read partition by partition."""
    block, size = [], 0
    for row in queries.select(id_col, text_col).toLocalIterator():
        text = row[1] or ""
        if block and size + len(text) > limit:
            yield query_block(block)
            block, size = [], 0
        block.append((row[0], text))
        size += len(text)
    if block:
        yield query_block(block)


def corpus_counts(docs: DataFrame, shared) -> tuple[int, int, np.ndarray]:
    """N, L and the document frequency of every term id of the block (``shared``: the broadcast block)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value.vocabulary
        df, n_docs, n_terms = np.zeros(len(vocabulary), np.int64), 0, 0
        for batch in batches:
            for text in texts_of(batch.column(0)):
                found = terms_of(text)
                n_docs += bool(found)
                n_terms += len(found)
                hits = [vocabulary[t] for t in set(found) if t in vocabulary]
                df[hits] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(([-2, -1], at)), pa.int64()),
             pa.array(np.concatenate(([n_terms, n_docs], df[at])), pa.int64())], ["term", "n"])

    counts = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    df, total = np.zeros(len(shared.value.vocabulary), np.int64), {-2: 0, -1: 0}
    for term, n in counts.collect():                     # a row per term of the block
        if term < 0:
            total[term] = n
        else:
            df[term] = n
    return total[-1], total[-2], df


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


class Shard:
    """Postings of query terms of some documents, by term; documents ascend inside a term."""

    def __init__(self, ids: list, lengths: list[int], postings: list[list[tuple[int, int]]], weight: np.ndarray,
                 n_docs: int, n_terms: int) -> None:
        self.ids = ids
        m = np.array([25 + 75 * n * n_docs // n_terms for n in lengths], np.int64)
        sizes = [len(p) for p in postings]
        flat = np.array([x for p in postings for x in p], np.int64).reshape(-1, 2)
        doc = np.repeat(np.arange(len(ids)), sizes)
        order = np.argsort(flat[:, 0], kind="stable")
        self.term_ids, first = np.unique(flat[order, 0], return_index=True)
        self.first = np.append(first, len(order))
        self.doc = doc[order]
        term, tf = flat[order, 0], flat[order, 1]
        self.score = weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[self.doc]))
        self.best = np.maximum.reduceat(self.score, first) if len(order) else self.score
        self.place = {int(t): i for i, t in enumerate(self.term_ids)}

    def search(self, terms: list[tuple[int, int]], k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of this shard that may be among the k best, with their scores.

        ``terms`` come rarest first; ``floor`` is a score that k earlier documents reached.
        """
        held = [(self.place[t], times) for t, times in terms if t in self.place]
        rest = np.append(np.cumsum([int(self.best[p]) * n for p, n in held][::-1])[::-1], 0)
        total = np.zeros(len(self.ids), np.int64)
        live = np.zeros(0, np.int64)
        limit, at = floor, 0
        while at < len(held) and not rest[at] < limit:              # create accumulators
            p, times = held[at]
            lo, hi = self.first[p], self.first[p + 1]
            total[self.doc[lo:hi]] += self.score[lo:hi] * times
            at += 1
            live = np.flatnonzero(total)
            if len(live) >= k:
                limit = max(floor, int(np.partition(total[live], len(live) - k)[len(live) - k]))
        for i in range(at, len(held)):                              # update survivors exactly
            live = live[total[live] + rest[i] >= limit]
            if not len(live):
                break
            p, times = held[i]
            lo, hi = self.first[p], self.first[p + 1]
            seek = np.searchsorted(self.doc[lo:hi], live)
            seek[seek == hi - lo] = 0
            hit = self.doc[lo + seek] == live
            total[live[hit]] += self.score[lo + seek[hit]] * times
            if len(live) >= k:
                limit = max(limit, int(np.partition(total[live], len(live) - k)[len(live) - k]))
        live = live[(total[live] >= limit) & (total[live] > 0)]
        return live, total[live]


def _order(hit: tuple[int, object]) -> tuple:
    """Higher scores first, then ascending ids, a null id last."""
    return -hit[0], hit[1] is None, 0 if hit[1] is None else hit[1]


def best_of_tasks(docs: DataFrame, shared, n_docs: int, n_terms: int, weight: np.ndarray, k: int) -> DataFrame:
    """(query, doc_id, score): each task's k best documents per query of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        ranked = [sorted(q, key=lambda x: (-int(weight[x[0]]), x[0])) for q in block.terms]
        best: list[list[tuple[int, object]]] = [[] for _ in ranked]

        def answer(ids: list, lengths: list[int], postings: list[list[tuple[int, int]]]) -> None:
            shard = Shard(ids, lengths, postings, weight, n_docs, n_terms)
            for q, terms in enumerate(ranked):
                floor = best[q][k - 1][0] if len(best[q]) >= k else 0
                found, scores = shard.search(terms, k, floor)
                if len(found):
                    best[q] = sorted(best[q] + [(int(s), ids[d]) for d, s in zip(found, scores)], key=_order)[:k]

        ids, lengths, postings, size = [], [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                found = terms_of(text)
                hits = [(block.vocabulary[t], n) for t, n in Counter(found).items() if t in block.vocabulary]
                if hits:
                    ids.append(doc_id), lengths.append(len(found)), postings.append(hits)
                    size += len(hits)
                if size >= SHARD_POSTINGS:
                    answer(ids, lengths, postings)
                    ids, lengths, postings, size = [], [], [], 0
        if ids:
            answer(ids, lengths, postings)
        flat = [(q, doc_id, score) for q, hits in enumerate(best) for score, doc_id in hits]
        yield pa.RecordBatch.from_pylist([dict(zip(("query", "doc_id", "score"), r)) for r in flat],
                                         schema=pa.schema([("query", pa.int64()), ("doc_id", pa.int64()),
                                                           ("score", pa.int64())]))

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "query long, doc_id long, score long")


def search(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text",
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(query id, rank, doc_id, score): the ``k`` highest-scoring documents of every query, scores above 0."""
    spark, out = docs.sparkSession, None
    rank = free_name([id_col, "doc_id", "score"], "rank")
    id_type = queries.schema[id_col].dataType
    for number, block in enumerate(query_blocks(queries, id_col, text_col, block_bytes)):
        if not block.vocabulary:
            continue
        shared = spark.sparkContext.broadcast(block)
        n_docs, n_terms, df = corpus_counts(docs, shared)
        if not n_docs:
            continue
        hits = best_of_tasks(docs, shared, n_docs, n_terms, weights(n_docs, df), k)
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        top = hits.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= k)
        names = spark.createDataFrame(list(enumerate(block.ids)), f"query long, id {id_type.simpleString()}")
        done = top.join(names, "query").select(F.col("id").alias(id_col), rank, "doc_id", "score")
        done = store(done, f"search_{number}")
        out = done if out is None else out.unionByName(done)
    if out is None:
        return queries.select(id_col, F.lit(0).alias(rank), F.lit(0).cast("bigint").alias("doc_id"),
                              F.lit(0).cast("bigint").alias("score")).limit(0)
    return out
