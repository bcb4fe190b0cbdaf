"""Corpus pipeline: quality rules, exact and near duplicates, personal data, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes it as Parquet under the shared folder and rereads it as the next
stage's ``docs``. All but the last return the columns of ``documents``.
``run`` also writes what the last stage returns: its result reads that table
alone, which is the caller's to keep, and all that the stages stored on the
way is deleted. Stages called one by one, as ``STAGES`` has them, are to be
written by the caller before the next is called, which deletes what the one
before stored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.config import release, store, tracked_scratch
from shoplens.llm import chunk_dedup, host_rules, packing, pii_votes, set_join
from shoplens.llm.registry import tokenizer_file
from shoplens.sources.tables import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or their host's verdict reject go."""
    return host_rules.keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return chunk_dedup.drop_copies(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked near copies (0.8 of the 5-word shingles) the row with the smallest doc_id stays."""
    return set_join.drop_near_copies(docs, width=5, num=80, den=100)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans are replaced by their kind; ``n_chars`` follows the text."""
    out = pii_votes.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else out


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the encoded texts, packed into sequences."""
    pieces = packing.pack(docs, tokenizer_file("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


_STEPS = (quality_rules, exact_dedup, jaccard_join, personal_data, pack_windows)

#: Scratch folders of the stage of ``STAGES`` that was called last.
_LAST: list[str] = []


def _tidy(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, _LAST)
        with tracked_scratch() as paths:
            out = stage(spark, docs, sf_dir)
        _LAST.extend(paths)
        return out

    return run_stage


STAGES = [(f.__name__, _tidy(f)) for f in _STEPS]

#: SQL can express neither the shingle components, the span classifier nor the packing;
#: tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``; runs know nothing of each other."""
    docs, before = table(spark, sf_dir, "documents"), []
    for stage in _STEPS:
        with tracked_scratch() as own:
            out = stage(spark, docs, sf_dir)
        with tracked_scratch() as kept:
            docs = store(out, f"stage_{stage.__name__}")
        release(spark, own + before)                   # all that the table just written was made from
        before = kept
    return docs
