"""Operator 5: exact duplicates by content-defined chunk recipes.

1. Each normalised text is cut where a rolling hash of its bytes says so;
   a row keeps its ordered list of chunk digests, the recipe. Rows are
   stored with their recipes.
2. Chunks are de-duplicated on (digest, bytes): every distinct chunk body
   crosses one shuffle, once. A digest with two bodies is a collision; its
   bodies are numbered, and occurrences of that digest take the number of
   the body they equal. So an identifier (digest, number) stands for one
   body, verified, never for a hash alone.
3. Rows with equal identifier lists are the duplicates. Only short lists
   are grouped and compared; long texts do not move again.

Equality is that of the text with A-Z lower-cased (all else as is). Of
equal texts the row with the largest ``doc_id`` stays; among equal doc_ids
one of the rows. Null text counts as empty, and empty texts are equal.
Null doc_ids sort first. An empty table gives no rows. Extra columns are
carried by ``recipes`` whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.config import store
from shoplens.llm.common import free_name, let, lower_ascii, row_slices, with_row_key

#: Chunk size in bytes: smallest, mean (a power of two), largest.
CHUNK = (512, 2048, 16384)
#: Fixed multiplier table of the rolling hash.
_GEAR = np.random.default_rng(20240229).integers(0, 1 << 32, 256, dtype=np.uint32)


def cut_points(data: bytes, sizes: tuple[int, int, int] = CHUNK) -> list[int]:
    """Ends of the content-defined chunks of ``data`` (empty for no bytes).

    The hash of the last 32 bytes decides, by doubling: a window of 2k bytes
    is a window of k plus the shifted window k before. Cuts closer than the
    smallest size to the last one are passed over; a stretch without any is
    cut at the largest size.
    """
    smallest, mean, largest = sizes
    n = len(data)
    if n <= smallest:
        return [n] if n else []
    h = _GEAR[np.frombuffer(data, np.uint8)]
    for width in (1, 2, 4, 8, 16):
        h[width:] = h[width:] + (h[:-width] << np.uint32(width))
    ends, last = [], 0
    for at in (np.flatnonzero((h >> np.uint32(32 - mean.bit_length() + 1)) == 0) + 1).tolist() + [n]:
        while at - last > largest:
            last += largest
            ends.append(last)
        if at - last >= smallest or at == n:
            ends.append(at)
            last = at
    return ends


def recipes(docs: DataFrame, names: dict[str, str], text_col: str = "text", digest_bits: int = 64,
            sizes: tuple[int, int, int] = CHUNK) -> DataFrame:
    """``docs`` plus a row key, the recipe's digests and the chunks' byte ends."""
    digests, ends, key, norm = (names[k] for k in ("digests", "ends", "row", "norm"))
    keep, columns_out = (1 << digest_bits) - 1, [*docs.columns, digests, ends]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(norm)
            size = pc.binary_length(batch.column(at).cast(pa.binary())).to_pylist()
            for lo, hi in row_slices(size):
                part = batch.slice(lo, hi - lo)
                cuts, found, offsets = [], [], [0]
                for text in part.column(at).cast(pa.binary()).to_pylist():
                    start = 0
                    for end in cut_points(text, sizes):
                        found.append(xxhash.xxh3_64_intdigest(text[start:end]) & keep)
                        cuts.append(end)
                        start = end
                    offsets.append(len(cuts))
                lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(v, pa.int64()))
                         for v in (np.asarray(found, np.uint64).astype(np.int64), cuts)]
                columns = [c for i, c in enumerate(part.columns) if i != at]
                yield pa.RecordBatch.from_arrays(columns + lists, columns_out)

    longs = T.ArrayType(T.LongType(), False)
    schema = T.StructType([*docs.schema.fields, T.StructField(digests, longs), T.StructField(ends, longs)])
    out = docs.withColumn(norm, lower_ascii(F.col(text_col))).mapInArrow(run, schema)
    return with_row_key(out, key)


def column_names(docs: DataFrame) -> dict[str, str]:
    """Internal column names that no column of ``docs`` has."""
    return {k: free_name(docs.columns, k) for k in ("row", "digests", "ends", "norm")}


def chunk_bodies(table: DataFrame, names: dict[str, str], text_col: str = "text") -> DataFrame:
    """(row, pos, digest, body) of every chunk occurrence."""
    ends = F.col(names["ends"])

    def chunks(data: Column) -> Column:
        def one(end: Column, i: Column) -> Column:
            start = F.when(i == 0, F.lit(0).cast("bigint")).otherwise(F.get(ends, i - 1))
            return F.struct(F.get(names["digests"], i).alias("digest"),
                            F.substring(data, (start + 1).cast("int"), (end - start).cast("int")).alias("body"))
        return F.transform(ends, one)

    data = F.encode(lower_ascii(F.col(text_col)), "UTF-8")
    return (table.select(F.col(names["row"]).alias("row"), F.posexplode(let(data, chunks)).alias("pos", "c"))
            .select("row", "pos", "c.digest", "c.body"))


def identifier_lists(table: DataFrame, names: dict[str, str], id_col: str, text_col: str = "text") -> DataFrame:
    """(row, id, ids): ordered verified identifiers; two texts are equal iff their lists are.

    An identifier is a struct (digest, number); the number is 0 where the
    digest has one body.
    """
    plain = table.select(F.col(names["row"]).alias("row"), F.col(id_col).alias("id"),
                         F.col(names["digests"]).alias("digests"))
    occurrences = chunk_bodies(table, names, text_col)
    bodies = occurrences.select("digest", "body").distinct()
    clashing = store(bodies.groupBy("digest").agg(F.count(F.lit(1)).alias("bodies"))
                     .filter("bodies > 1").select("digest"), "chunk_collisions")
    ids = F.transform("digests", lambda d: F.struct(d.alias("digest"), F.lit(0).alias("number")))
    if clashing.isEmpty():
        return plain.select("row", "id", ids.alias("ids"))
    numbered = store(bodies.join(clashing, "digest", "left_semi").select(
        "digest", "body", F.row_number().over(Window.partitionBy("digest").orderBy("body")).alias("number")),
        "chunk_numbers")
    fixes = (occurrences.join(numbered, ["digest", "body"]).groupBy("row")
             .agg(F.map_from_entries(F.collect_list(F.struct("pos", "number"))).alias("fix")))
    numbers = F.transform("digests", lambda d, i: F.struct(
        d.alias("digest"), F.coalesce(F.try_element_at("fix", i), F.lit(0)).alias("number")))
    return plain.join(fixes, "row", "left").select(
        "row", "id", F.when(F.col("fix").isNull(), ids).otherwise(numbers).alias("ids"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_bits: int = 64,
                     sizes: tuple[int, int, int] = CHUNK) -> tuple[DataFrame, DataFrame, dict[str, str]]:
    """(table, decisions, names).

    ``table`` is ``docs`` stored with its row key; ``decisions`` has, per row
    key, ``keep_id``, ``group_size`` and ``kept``.
    """
    names = column_names(docs)
    table = store(recipes(docs, names, text_col, digest_bits, sizes), "recipes")
    rows = store(identifier_lists(table, names, id_col, text_col), "identifier_lists")
    groups = store(rows.groupBy("ids").agg(F.max(F.struct("id", "row")).alias("last"),
                                           F.count(F.lit(1)).alias("group_size"))
                   .filter("group_size > 1"), "copy_groups")
    # Both sides are stored, so a hot list's rows can be split by the adaptive skew join.
    decisions = rows.join(groups, "ids", "left").select(
        "row", F.coalesce(F.col("last.id"), F.col("id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        (F.coalesce(F.col("last.row"), F.col("row")) == F.col("row")).alias("kept"))
    return table, decisions, names


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that an equal text with a larger doc_id replaces."""
    table, decisions, names = exact_duplicates(docs)
    key = names["row"]
    kept = decisions.filter("kept").select(F.col("row").alias(key))
    return table.join(kept, key, "left_semi").select(*docs.columns)
