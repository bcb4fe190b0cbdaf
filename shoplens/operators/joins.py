"""Join helpers and the broadcast policy.

Broadcast is decided by size, never by hope:

* sides whose size is bounded by construction (a top-n list, a parameter
  table) get an explicit ``broadcast()`` hint;
* every other side (dimensions, state tables) is joined plainly: Spark
  broadcasts it only when its estimated size is under
  ``spark.sql.autoBroadcastJoinThreshold``, AQE re-checks with the sizes
  measured at runtime (and can switch a sort-merge join to a broadcast
  join or split skewed partitions), and above the threshold the join
  stays a shuffle join;
* sides that grow with the input and are joined batch after batch, or whose
  files are so much smaller than their rows that Spark's estimate is no bound
  (users), are shuffled (``shuffled``): nothing of them passes the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_broadcast(small: DataFrame) -> DataFrame:
    """Hint for a side whose row count is bounded by construction (top-n, parameters)."""
    return F.broadcast(small)


def shuffled(side: DataFrame) -> DataFrame:
    """Hint for a side that grows with the input: joined by shuffle and sort, never collected for a broadcast."""
    return side.hint("merge")


def dimension_join(fact: DataFrame, dim: DataFrame, on, how: str = "inner") -> DataFrame:
    """Fact-to-dimension join; Spark's size checks pick broadcast or shuffle."""
    return fact.join(dim, on, how)
