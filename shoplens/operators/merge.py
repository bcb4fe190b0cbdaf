"""Table-merge operators (M1-M4): ``(target, batch) -> new target``.

Pure DataFrame functions; the stream wires them to storage. Each is one
set-based plan (union + aggregate, or anti join + union), never a
per-key lookup.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.operators.joins import shuffled


def merge_add(target: DataFrame, batch: DataFrame, keys: Sequence[str],
              measure: str = "click_count") -> DataFrame:
    """M1: insert new keys, add ``measure`` to existing ones."""
    cols = [*keys, measure]
    return (target.select(*cols).unionByName(batch.select(*cols))
            .groupBy(*keys).agg(F.sum(measure).cast("bigint").alias(measure)))


def merge_overwrite(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """M2: insert new keys, replace the row of existing keys with the batch row."""
    kept = target.join(shuffled(batch.select(*keys).distinct()), list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(batch.select(*target.columns))


def replace_groups(target: DataFrame, batch: DataFrame, group_keys: Sequence[str]) -> DataFrame:
    """M3: drop every target row of a group present in the batch, then add the batch."""
    return merge_overwrite(target, batch, group_keys)


def append_distinct(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """M4: append batch rows whose key is not yet in the target (each key once)."""
    new = batch.dropDuplicates(list(keys)).join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(new.select(*target.columns))
