"""Operator 6: quality by an interpolated modified Kneser-Ney model.

The model predicts characters from the four before. Counts come from all
trusted texts; every distinct window of the corpus (map-side distinct) is
scored once, by joins of the windows with the count tables of each order;
both sides of these joins are distinct windows, far fewer than characters.
The scored windows are written in shards of bounded size to the shared
folder. Stage by stage, tasks read one shard, once per Python worker, and add
its windows' share to every text's sum; the sums so far are stored between
shards. So texts are never shuffled, what a task holds is bounded by the
shard, and nothing of the model passes through the driver.

Characters, not words: the distinct word n-grams of a corpus are nearly as
many as its words, so that scoring them by joins moves several times the
corpus. The price is that words in a wrong order look as good as text; what
stands out is text whose words are not the trusted ones'.

A text's perplexity is compared with a quantile of its language's trusted
texts that were held out of the counts (one in ``HELD_OUT``, by a hash of
the id). Languages without any take the quantile of all.

Modified Kneser-Ney, order k: p(w|h) = (max(c - D(c), 0) + g(h) p(w|h')) / c(h),
g(h) = D1 N1(h) + D2 N2(h) + D3 N3+(h), D from the counts of counts; below
the highest order c counts distinct characters in front. Order 1
interpolates with the uniform distribution; an unseen h passes p(w|h').

Defined results: null or empty text has no windows, perplexity null and is
not kept; repeated rows are scored alike and count each; a null language is
a language; without trusted texts nothing can be judged: scores are those
of the uniform distribution and all non-empty texts stay; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyarrow.dataset import dataset
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.config import scratch_path, store
from shoplens.llm.char_windows import ScoreTable, Windows
from shoplens.llm.common import row_slices, texts_of

ORDER = 5
#: Windows per shard (a table of 4 to 8 slots of 12 bytes each a window).
SHARD_ROWS = 2_000_000
#: Trusted ids up to which they are broadcast; beyond it the texts are joined by a shuffle.
BROADCAST_IDS = 2_000_000
QUANTILE = 0.995
#: One trusted text in so many is left out of the counts and sets the limits
#: instead: a text scores better under counts it took part in.
HELD_OUT = 5


def window_counts(docs: DataFrame, order: int) -> DataFrame:
    """(gram, c): every distinct window of ``text`` and its count in rows with ``trusted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, trusted = texts_of(batch.column(0)), np.array(batch.column(1).to_pylist(), bool)
            for lo, hi in row_slices([4 * len(t) for t in texts]):
                w = Windows(texts[lo:hi], order)
                if not len(w.keys):
                    continue
                _, first, inverse = np.unique(w.keys, return_index=True, return_inverse=True)
                counts = np.bincount(inverse, weights=trusted[lo:hi][w.text], minlength=len(first))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w.grams(w.at[first]), pa.string()), pa.array(counts.astype(np.int64))], ["gram", "c"])

    return docs.select("text", "trusted").mapInArrow(run, "gram string, c long").groupBy("gram").agg(F.sum("c").alias("c"))


def _discounts(n: dict[int, int]) -> list[float]:
    """D1, D2, D3+ from the numbers of windows counted once to four times."""
    y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.0
    return [min(float(k), max(0.0, k - (k + 1) * y * n[k + 1] / n[k])) if n[k] else 0.0 for k in (1, 2, 3)]


def kneser_ney(windows: DataFrame, order: int) -> DataFrame:
    """(gram, lp): natural log probability of the last character of every window."""
    levels = {order: windows.filter("c > 0").select("gram", "c")}
    for k in range(order - 1, 0, -1):
        levels[k] = store(levels[k + 1].groupBy(F.substring("gram", 2, k).alias("gram"))
                          .agg(F.count(F.lit(1)).alias("c")), "continuations")
    asked = {order: windows.select("gram")}
    for k in range(order - 1, 0, -1):
        asked[k] = store(asked[k + 1].select(F.substring("gram", 2, k).alias("gram")).distinct(), "asked")
    known = asked[1].count()
    uniform = 1.0 / max(known, 1)
    lower = None
    for k in range(1, order + 1):
        n = levels[k].agg(*[F.sum((F.col("c") == i).cast("long")).alias(str(i)) for i in range(1, 5)]).first()
        d = _discounts({i: n[str(i)] or 0 for i in range(1, 5)})
        context = levels[k].groupBy(F.substring("gram", 1, k - 1).alias("h")).agg(
            F.sum("c").alias("total"), *[F.sum((F.col("c") == i).cast("long")).alias(f"n{i}") for i in (1, 2)],
            F.sum((F.col("c") >= 3).cast("long")).alias("n3"))
        discount = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        rows = asked[k].join(levels[k], "gram", "left").withColumn("h", F.substring("gram", 1, k - 1))
        if lower is None:
            rows = rows.withColumn("p0", F.lit(uniform))
        else:
            rows = rows.withColumn("suffix", F.substring("gram", 2, k - 1)).join(lower, "suffix")
        rows = rows.join(context, "h", "left")
        own = F.coalesce(F.greatest(F.col("c") - discount, F.lit(0.0)), F.lit(0.0))
        p = F.when(F.col("total").isNull(), F.col("p0")).otherwise(
            (own + (d[0] * F.col("n1") + d[1] * F.col("n2") + d[2] * F.col("n3")) * F.col("p0")) / F.col("total"))
        # A discount of 0 leaves unseen characters nothing; the uniform floor keeps logarithms finite.
        p = store(rows.select("gram", F.greatest(p, F.lit(uniform * 1e-6)).alias("p")), "probabilities")
        lower = p.select(F.col("gram").alias("suffix"), F.col("p").alias("p0"))
    return p.select("gram", F.log("p").alias("lp"))


def add_scores(docs: DataFrame, scored: DataFrame, order: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``docs`` (doc_id, text, lang, trusted) with ``n`` windows and the sum of their ``lp``."""
    shards = max(1, math.ceil(scored.count() / shard_rows))
    path = scratch_path(docs.sparkSession, "score_shards")
    scored.withColumn("shard", F.pmod(F.xxhash64("gram"), F.lit(shards))).write.partitionBy("shard").parquet(path)
    out = docs.select("doc_id", "text", "lang", "trusted", F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("lp"))
    schema = out.schema
    for k in range(shards):
        out = out.mapInArrow(_adder(f"{path}/shard={k}", order), schema)
        if k < shards - 1:
            out = store(out, "partial_scores")         # the next stage's tasks hold the next shard only
    return out


@lru_cache(maxsize=1)
def shard_table(path: str, order: int) -> ScoreTable:
    """A shard's scores, read once per Python worker; an empty shard has no folder."""
    files, root = fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)
    if files.get_file_info(root).type == fs.FileType.NotFound:
        return ScoreTable(np.zeros(0, np.uint64), np.zeros(0, np.float32))
    part = dataset(root, filesystem=files, format="parquet").to_table(columns=["gram", "lp"])
    grams = part["gram"].to_pylist()
    keys = np.empty(len(grams), np.uint64)
    for lo in range(0, len(grams), 100_000):
        keys[lo:lo + 100_000] = _keys_of(grams[lo:lo + 100_000], order)
    return ScoreTable(keys, part["lp"].to_numpy().astype(np.float32))


def _keys_of(grams: list[str], order: int) -> np.ndarray:
    """Hashes of whole windows: each gram's last window, padding aside."""
    w = Windows(grams, order)
    return w.keys[order - 1::order]


def _adder(path: str, order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shard_table(path, order)
        for batch in batches:
            texts = texts_of(batch.column(1))
            for lo, hi in row_slices([4 * len(t) for t in texts]):
                w = Windows(texts[lo:hi], order)
                score, found = table.find(w.keys)
                n = np.bincount(w.text, weights=found, minlength=hi - lo).astype(np.int64)
                lp = np.bincount(w.text, weights=np.where(found, score, 0).astype(np.float64), minlength=hi - lo)
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:4], pa.array(n + part.column(4).to_numpy()), pa.array(lp + part.column(5).to_numpy())],
                    batch.schema.names)

    return run


def perplexities(docs: DataFrame, trusted_ids: DataFrame, order: int = ORDER, quantile: float = QUANTILE,
                 shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(doc_id, lang, n_windows, perplexity, threshold, kept) of every document."""
    ids = store(trusted_ids.select(F.col("doc_id").alias("trusted_id")).distinct(), "trusted_ids")
    side = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    flagged = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang").join(
        side, F.col("doc_id") == F.col("trusted_id"), "left").select(
        "doc_id", "text", "lang", F.col("trusted_id").isNotNull().alias("trusted"))
    held_out = F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0
    windows = store(window_counts(flagged.withColumn("trusted", F.col("trusted") & ~held_out), order), "windows")
    scored = store(kneser_ney(windows, order), "window_scores")
    perplexity: Column = F.when(F.col("n") > 0, F.exp(-F.col("lp") / F.col("n")))
    rows = store(add_scores(flagged, scored, order, shard_rows).select(
        "doc_id", "lang", "trusted", F.col("n").alias("n_windows"), perplexity.alias("perplexity")), "perplexities")
    cut = F.percentile_approx("perplexity", quantile, 10000)
    good = rows.filter(F.col("trusted") & held_out & F.col("perplexity").isNotNull())
    overall = good.agg(cut.alias("t")).first()["t"]
    by_lang = store(good.groupBy(F.col("lang").alias("t_lang")).agg(cut.alias("t")), "language_limits")
    limit = F.coalesce("t", F.lit(overall).cast("double"), F.lit(float("inf")))
    return rows.join(by_lang, F.col("lang").eqNullSafe(F.col("t_lang")), "left").select(
        "doc_id", "lang", "n_windows", "perplexity", limit.alias("threshold"),
        F.coalesce(F.col("perplexity") <= limit, F.lit(False)).alias("kept"))
