"""Operator 3: packing token sequences with minimum bin slack.

1. Encode every text once (Arrow batches) and store ``(row, doc_id, ids)``.
2. A row's ids are cut at multiples of the capacity; only the remainder's
   length matters for packing. The histogram of remainders has fewer
   entries than the capacity, whatever the corpus size, and is all that
   reaches the driver.
3. ``plan_windows`` turns the histogram into slots: for rank ranges of a
   remainder length, in which sequence and at which offset they lie.
4. Ranks within a length come from per-(length, salt) windows plus salt
   offsets, so a length that a third of all rows share is split.
5. Rows meet their slots on (length, rank range) and their ids on the row
   key; the pieces' ids are byte ranges of the stored ids.

Defined results: null or empty text is the closing id alone (one piece of
length 1); repeated rows and repeated doc_ids are packed as separate
documents; a null doc_id is carried along; an empty table gives no rows;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.config import store
from shoplens.llm.common import row_slices, texts_of, with_row_key
from shoplens.llm.window_plan import plan_windows
from shoplens.llm.word_ids import word_encoder

CAPACITY = 4096
#: Salts that split the ranking of one remainder length.
SALTS = 1024


def encode_documents(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """(doc_id, n_tokens, ids): each text's ids and ``end_id``, as 4-byte little-endian."""
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer_path)
        for batch in batches:
            texts = texts_of(batch.column(1))
            for lo, hi in row_slices([4 * len(t) for t in texts]):
                ids = [x + end for x in encoder.encode(texts[lo:hi])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids binary")


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = CAPACITY,
         salts: int = SALTS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (binary), doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    tokens = store(with_row_key(encode_documents(docs, tokenizer_path, end_id), "row"), "pack_ids")

    lens = tokens.select(
        "row", "doc_id", "n_tokens",
        F.expr(f"n_tokens div {capacity}").alias("full"),
        (F.col("n_tokens") % capacity).alias("rest"),
        F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int").alias("salt"))
    groups = lens.groupBy("rest", "salt").agg(F.count(F.lit(1)).alias("n"), F.sum("full").alias("n_full"))
    groups = store(groups, "pack_groups")            # at most capacity x salts rows

    histogram = {r["rest"]: r["n"] for r in groups.groupBy("rest").agg(F.sum("n").alias("n")).collect()}
    slots, n_sequences = plan_windows(histogram, capacity)
    plan = spark.createDataFrame(
        [tuple(s) for s in slots],
        "p_length long, p_lo long, p_hi long, p_cut long, p_size long, p_i0 long, p_per long, p_seq long, p_base long")

    before = Window.partitionBy("rest").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    salt_full = groups.groupBy("salt").agg(F.sum("n_full").alias("n_full"))      # `salts` rows at most
    first_full = salt_full.select("salt", F.coalesce(
        F.sum("n_full").over(Window.orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("first_full"))
    bases = (groups.select("rest", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_rank"))
             .join(F.broadcast(first_full), "salt"))
    ranked = (lens.join(bases, ["rest", "salt"]).select(
        "row", "full", "rest",
        (F.col("first_rank") + F.row_number().over(Window.partitionBy("rest", "salt").orderBy("row")) - 1).alias("rank"),
        (F.col("first_full") + F.coalesce(F.sum("full").over(
            Window.partitionBy("salt").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0))).alias("full_before")))
    ranked = store(ranked, "pack_ranks")

    # The plan has a few slots per distinct length: bounded by the capacity, not by the rows.
    rests = ranked.join(
        F.broadcast(plan), (F.col("rest") == F.col("p_length")) & (F.col("rank") >= F.col("p_lo"))
        & (F.col("rank") < F.col("p_hi"))).select(
        "row", (F.col("full") * capacity + F.col("p_cut")).alias("start"), F.col("p_size").alias("length"),
        F.expr("p_seq + (p_i0 + rank - p_lo) div p_per").alias("sequence_id"),
        F.expr("p_base + (p_i0 + rank - p_lo) % p_per * p_size").alias("offset"))
    whole = ranked.filter("full > 0").select(
        "row", "full_before", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("full") - 1)).alias("k")).select(
        "row", (F.col("k") * capacity).alias("start"), F.lit(capacity).cast("bigint").alias("length"),
        (F.col("full_before") + F.col("k") + n_sequences).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"))
    pieces = rests.unionByName(whole)
    return tokens.join(pieces, "row").select(
        "doc_id", "start", "length",
        F.expr("substring(ids, CAST(start * 4 + 1 AS INT), CAST(length * 4 AS INT))").alias("ids"),
        F.col("n_tokens").alias("doc_tokens"), "sequence_id", "offset")
