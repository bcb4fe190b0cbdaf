"""Operator 2: exact length histogram and its suffix sums.

Documents are encoded (Arrow batches) and only ``(group, length)`` leaves a
task; the histogram is an aggregate with map-side sums. Sums over longer
lengths come from two levels, within blocks of lengths and over the blocks,
so no task sees the whole histogram. One row per (group, distinct length L)
then answers any question about a context limit of L:

* ``docs_ge``, ``tokens_ge``: documents of at least L ids, and their ids;
* ``truncated_tokens``: ids left when every document is cut to L ids;
* ``rank_hi``: documents of at most L ids, so the q-quantile is the first
  row with ``rank_hi >= q * total_docs``;
* ``total_docs``, ``total_tokens`` of the group.

Between two lengths the truncated total is linear: at a limit C it is the
row of the next smaller L plus ``(C - L)`` times that row's longer documents.

Defined results: null or empty text has length 0; repeated rows count each;
a null group is a group; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.config import store
from shoplens.llm.common import texts_of

#: Lengths per block of the two-level suffix sums.
BLOCK = 1024


@lru_cache(maxsize=2)
def rank_encoding(ranks_path: str, pattern: str):
    """The encoding of a rank-file vocabulary, loaded once per Python worker."""
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


#: The end of patterns that give a run of white space, all but its last character if something
#: follows, as one piece; Unicode's White_Space, and the length from which a run is cut out beforehand.
_RUN_END = r"|\s+(?!\S)|\s+"
_WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_RUN = 4096


def length_counter(ranks_path: str, pattern: str, long_run: int = LONG_RUN) -> Callable[[str], int]:
    """Encoded length of a text.

    The library matches a run of white space by recursion and gives up on
    very long ones. Where the pattern says what becomes of a run, long runs
    are cut out at the piece's own bounds and encoded whole.
    """
    encoding = rank_encoding(ranks_path, pattern)
    if not pattern.endswith(_RUN_END):
        return lambda text: len(encoding.encode_ordinary(text))
    whole = rank_encoding(ranks_path, r"[\s\S]+")
    runs = re.compile(f"[{_WHITE}]{{{long_run},}}")

    def count(text: str) -> int:
        at = n = 0
        for run in runs.finditer(text):
            end = run.end() - (run.end() < len(text))
            n += len(encoding.encode_ordinary(text[at:run.start()])) + len(whole.encode_ordinary(text[run.start():end]))
            at = end
        return n + len(encoding.encode_ordinary(text[at:]))

    return count


def document_lengths(docs: DataFrame, ranks_path: str, pattern: str, group: str) -> DataFrame:
    """(grp, length): encoded length of every text under a rank-file vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = length_counter(ranks_path, pattern)
        for batch in batches:
            lengths = [count(t) for t in texts_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64())], ["grp", "length"])

    return docs.select(F.col(group).cast("string"), "text").mapInArrow(run, "grp string, length long")


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """The answers above from (grp, length, n_docs)."""
    h = store(histogram.withColumn("block", F.expr(f"length div {BLOCK}")), "length_histogram")
    tokens = F.col("length") * F.col("n_docs")
    blocks = h.groupBy("grp", "block").agg(F.sum("n_docs").alias("b_docs"), F.sum(tokens).alias("b_tokens"))
    later = Window.partitionBy("grp").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy("grp")
    blocks = blocks.select(
        F.col("grp").alias("b_grp"), F.col("block").alias("b_block"),
        F.coalesce(F.sum("b_docs").over(later), F.lit(0)).alias("later_docs"),
        F.coalesce(F.sum("b_tokens").over(later), F.lit(0)).alias("later_tokens"),
        F.sum("b_docs").over(everything).alias("total_docs"),
        F.sum("b_tokens").over(everything).alias("total_tokens"))
    within = Window.partitionBy("grp", "block").orderBy(F.desc("length")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (h.select("grp", "block", "length", "n_docs", F.sum("n_docs").over(within).alias("w_docs"),
                     F.sum(tokens).over(within).alias("w_tokens"))
            .join(blocks, F.col("grp").eqNullSafe(F.col("b_grp")) & (F.col("block") == F.col("b_block")))
            .withColumn("docs_ge", F.col("w_docs") + F.col("later_docs"))
            .withColumn("tokens_ge", F.col("w_tokens") + F.col("later_tokens"))
            .select("grp", "length", "n_docs", "docs_ge", "tokens_ge",
                    (F.col("total_tokens") - F.col("tokens_ge") + F.col("docs_ge") * F.col("length"))
                    .alias("truncated_tokens"),
                    (F.col("total_docs") - F.col("docs_ge") + F.col("n_docs")).alias("rank_hi"),
                    "total_docs", "total_tokens"))


def length_histogram(docs: DataFrame, ranks_path: str, pattern: str, group: str = "lang") -> DataFrame:
    """Suffix sums of the exact length histogram, per ``group``."""
    lengths = document_lengths(docs, ranks_path, pattern, group)
    return suffix_sums(lengths.groupBy("grp", "length").agg(F.count(F.lit(1)).alias("n_docs")))
