"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of an Arrow column after which a Python task hands a batch back to the JVM.
BATCH_BYTES = 8 << 20

#: ASCII letters folded by the contracts that compare "after lower-casing A-Z only".
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: White space of the word contracts: space, tab, LF, VT, FF, CR.
SPACE_CLASS = "\\x20\\x09-\\x0D"


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z (and nothing else) lower-cased; null becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A lambda variable is evaluated once; naming the value in a projection
    instead lets the optimizer inline it into every use.
    """
    return F.transform(F.array(value), body)[0]


def free_name(taken: list[str], name: str) -> str:
    """``name`` with underscores in front until no input column clashes with it."""
    while name.lower() in {t.lower() for t in taken}:
        name = "_" + name
    return name


def row_slices(sizes: list[int], limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges whose sizes sum to about ``limit`` at most."""
    lo = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield lo, i
            lo, total = i, 0
        total += n
    if lo < len(sizes):
        yield lo, len(sizes)


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """The strings of an Arrow column; null becomes empty."""
    return ["" if t is None else t for t in column.to_pylist()]


def with_row_key(df: DataFrame, name: str) -> DataFrame:
    """Add a long that tells rows apart; stable once the result is stored."""
    return df.withColumn(name, F.monotonically_increasing_id())
