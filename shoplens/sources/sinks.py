"""Report sinks.

Reports are DataFrames; these helpers only attach the run id and hand
them to Spark's writers.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def new_task_id() -> str:
    """One id per report run (generated once on the driver)."""
    return str(uuid.uuid4())


def with_task_id(df: DataFrame, task_id: str, col: str = "task_id") -> DataFrame:
    """Tag every row of a report with the run id (first column)."""
    return df.select(F.lit(task_id).alias(col), *df.columns)


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
                batch_size: int = 1000, num_partitions: int | None = None) -> None:
    """A8 + M5: append a report to a JDBC table.

    Spark's JDBC writer opens one connection per task and sends inserts in
    batches of ``batch_size`` (the per-partition batched statement of the
    original job); ``num_partitions`` caps concurrent connections.
    """
    w = df.write.format("jdbc").mode("append").option("url", url).option("dbtable", table) \
        .option("batchsize", str(batch_size))
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def replace_table(df: DataFrame, target: str, partition_by: list[str] | None = None,
                  fmt: str = "parquet") -> None:
    """Drop-and-recreate a table: a catalog name (``saveAsTable``) or a path."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if "/" in target:
        w.save(target)
    else:
        w.saveAsTable(target)
