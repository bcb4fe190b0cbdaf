"""Page single-hop conversion (W3-W5, D16, D17) by mergeable chunks.

Actions are dealt into chunks that are contiguous in (session, time, id)
order: Spark samples the order's bounds and range-partitions by them, so a
session, a session-minute or a single instant that holds a third of all
rows is cut across tasks like any other rows. A chunk is summed up in one
pass over its sorted rows:

    (first row, last row, counts of the flow's pairs and start views)

Such summaries merge in chunk order: counts add up, and where the last row
of a chunk and the first row of the next belong to one session, they make
one more pair. The fold reads one row per chunk. Nothing else is shuffled
after the range partitioning, whose partitions are the chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoplens.config import store
from shoplens.functions.scalar import pair_label
from shoplens.operators.joins import bounded_broadcast

_ORDER = ("session_id", "action_time", "action_id")
#: A chunk's first and last row.
_EDGES = "chunk int, first_session string, first_page long, last_session string, last_page long"


def flow_pairs(flow: str) -> list[tuple[int, int, int]]:
    """``'1,2,3'`` -> ``[(1, 1, 2), (2, 2, 3)]`` (position, from, to)."""
    pages = [int(p) for p in flow.split(",") if p.strip() != ""]
    return [(i + 1, a, b) for i, (a, b) in enumerate(zip(pages, pages[1:]))]


def flow_table(spark: SparkSession, flow: str) -> DataFrame:
    """W5 as a table (its size is the length of the flow parameter)."""
    return spark.createDataFrame(flow_pairs(flow) or [], "pos int, from_page bigint, to_page bigint")


def ordered_chunks(actions: DataFrame, chunks: int | None = None) -> DataFrame:
    """(session_id, page_id) in (session, time, id) order, partition by partition.

    ``chunks`` fixes the number of partitions; by default it is the session's
    number of shuffle partitions, small neighbours merged by AQE.
    """
    a = actions.select(F.col("session_id").cast("string").alias("session_id"), F.col("page_id").cast("bigint").alias("page_id"),
                       "action_time", "action_id")
    dealt = a.repartitionByRange(chunks, *_ORDER) if chunks else a.repartitionByRange(*_ORDER)
    return dealt.sortWithinPartitions(*_ORDER).select("session_id", "page_id")


class _Chunk:
    """First and last row of the chunk being read; hands out each batch's consecutive rows."""

    def __init__(self) -> None:
        self.first = self.last = None

    def pairs(self, batch: pa.RecordBatch) -> pa.Table:
        """(session_id, page_id, next_page_id) of rows and their successors within a session."""
        rows = pa.Table.from_batches([batch])
        if self.last is not None:
            rows = pa.concat_tables([self.last, rows]).combine_chunks()
        self.first = rows.slice(0, 1) if self.first is None else self.first
        self.last = rows.slice(len(rows) - 1)
        before, after = rows.slice(0, len(rows) - 1), rows.slice(1)
        a, b = before["session_id"], after["session_id"]
        same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
        return pa.table({"session_id": a, "page_id": before["page_id"], "next_page_id": after["page_id"]}).filter(same)

    def edges(self) -> list:
        """Values of ``_EDGES``; none for an empty chunk."""
        ends = [t[c][0].as_py() for t in (self.first, self.last) for c in ("session_id", "page_id")]
        return [TaskContext.get().partitionId(), *ends]


def _next_chunk() -> tuple[Column, Column]:
    """Whether the next chunk begins in the session that this one ends in, and its first page.

    The window is over one row per chunk.
    """
    w = Window.partitionBy().orderBy("chunk")
    same = F.lead("first_session").over(w).eqNullSafe(F.col("last_session")) & F.lead("chunk").over(w).isNotNull()
    return same.alias("same"), F.lead("first_page").over(w).alias("next_first_page")


def page_pairs(actions: DataFrame, chunks: int | None = None) -> DataFrame:
    """(session_id, page_id, next_page_id) for consecutive actions.

    Pairs inside chunks and the chunks' edges come out of one pass, written
    once (the sampled bounds may differ from run to run): the pairs, and one
    row per chunk from which the pairs across chunks are made.
    """
    schema = "session_id string, page_id long, next_page_id long, " + _EDGES
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = _Chunk()
        for batch in batches:
            if batch.num_rows:
                found = chunk.pairs(batch).combine_chunks()
                blank = [pa.nulls(len(found), k) for k in kinds[3:]]
                yield from pa.table([*found.columns, *blank], names=names).to_batches()
        if chunk.first is not None:
            row = [None, None, None, *chunk.edges()]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

    rows = store(ordered_chunks(actions, chunks).mapInArrow(run, schema), "page_pairs")
    inner = rows.filter(F.col("chunk").isNull()).select("session_id", "page_id", "next_page_id")
    across = (rows.filter(F.col("chunk").isNotNull()).select("last_session", "last_page", *_next_chunk()).filter("same")
              .select(F.col("last_session").alias("session_id"), F.col("last_page").alias("page_id"),
                      F.col("next_first_page").alias("next_page_id")))
    return inner.unionByName(across)


def chunk_summaries(actions: DataFrame, flow: str, chunks: int | None = None) -> DataFrame:
    """One row per chunk: its edges, ``starts`` views of the flow's first page, ``counts`` of the flow's pairs."""
    steps, start = flow_pairs(flow), int(flow.split(",")[0])
    schema = _EDGES + ", starts long, counts array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, starts, counts = _Chunk(), 0, np.zeros(len(steps), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            starts += pc.sum(pc.equal(batch["page_id"], start)).as_py() or 0
            found = chunk.pairs(batch)
            for k, (_, a, b) in enumerate(steps):
                hit = pc.and_(pc.equal(found["page_id"], a), pc.equal(found["next_page_id"], b))
                counts[k] += pc.sum(hit).as_py() or 0
        if chunk.first is not None:
            row = [*chunk.edges(), starts, counts.tolist()]
            kinds = [pa.int32(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)],
                                             [c.split()[0] for c in schema.split(", ")])

    return ordered_chunks(actions, chunks).mapInArrow(run, schema)


def flow_counts(actions: DataFrame, flow: str, chunks: int | None = None) -> DataFrame:
    """D16 + D17 in one pass: (pos, page_pair, pair_count), position 0 = start-page views.

    The chunks' summaries are folded in order, the pairs across chunks added;
    the flow parameter becomes literals, so no join is needed.
    """
    steps = flow_pairs(flow)
    x = chunk_summaries(actions, flow, chunks).select("starts", "counts", "last_page", *_next_chunk())
    sums = [F.coalesce(F.sum("starts"), F.lit(0)).alias("c0")]
    for p, a, b in steps:
        across = F.when(F.col("same") & (F.col("last_page") == a) & (F.col("next_first_page") == b), 1).otherwise(0)
        sums.append(F.coalesce(F.sum(F.get("counts", F.lit(p - 1)) + across), F.lit(0)).alias(f"c{p}"))
    items = [F.struct(F.lit(0).alias("pos"), F.lit(None).cast("string").alias("page_pair"),
                      F.col("c0").cast("bigint").alias("pair_count"))]
    items += [F.struct(F.lit(p).alias("pos"), F.lit(f"{a}_{b}").alias("page_pair"),
                       F.col(f"c{p}").cast("bigint").alias("pair_count")) for p, a, b in steps]
    return x.agg(*sums).select(F.explode(F.array(*items)).alias("r")).select("r.*")


def page_pair_count(pairs: DataFrame, flow: DataFrame) -> DataFrame:
    """Occurrences of each target pair, by flow position; unseen pairs count 0."""
    f = bounded_broadcast(flow)   # one row per step of the flow parameter
    hits = (pairs.join(f, (pairs.page_id == f.from_page) & (pairs.next_page_id == f.to_page), "inner")
            .groupBy("pos").agg(F.count(F.lit(1)).alias("pair_count")))
    return (flow.join(bounded_broadcast(hits), "pos", "left")   # one row per flow step at most
            .select("pos", pair_label("from_page", "to_page").alias("page_pair"),
                    F.coalesce("pair_count", F.lit(0)).alias("pair_count")))


def start_page_count(actions: DataFrame, first_page: int) -> DataFrame:
    """Views of the first page of the flow (one row, 0 when none)."""
    return actions.filter(F.col("page_id") == first_page).agg(
        F.count(F.lit(1)).alias("start_count"))


def ratios_from_counts(counts: DataFrame) -> DataFrame:
    """W4 over a flow-sized (pos, page_pair, pair_count) table with position 0 = start views."""
    w = Window.partitionBy().orderBy("pos")
    prev = F.lag("pair_count").over(w)
    return (counts.withColumn("ratio", F.try_divide(F.col("pair_count").cast("double"), prev))
            .filter(F.col("pos") > 0))


def render_ratios(ratios: DataFrame) -> DataFrame:
    """The stored one-string form ``1_2=r|2_3=r`` in flow order (one row)."""
    item = F.struct("pos", F.concat_ws("=", "page_pair", F.col("ratio").cast("string")).alias("s"))
    return ratios.agg(F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["s"]), "|")
                      .alias("convert_ratio"))
