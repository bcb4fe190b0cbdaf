"""Predicates of the session filter (B1-B6) as column expressions.

An absent parameter never filters; a missing data value never passes.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from shoplens.functions.scalar import _c, csv_tokens, json_field


def filter_values(values) -> list[str]:
    """A parameter's values as texts: a list, or a comma list; none when absent."""
    if values is None:
        return []
    if isinstance(values, str):
        values = values.split(",")
    return [str(v) for v in values if str(v) != ""]


def between_or_all(col, lo, hi) -> Column:
    """B1: ``lo <= col <= hi``; no filter unless both bounds are given."""
    if lo is None or hi is None:
        return F.lit(True)
    return F.coalesce(_c(col).between(int(lo), int(hi)), F.lit(False))


def any_in(col, values) -> Column:
    """B2: any comma-separated value of ``col`` equals any of ``values``.

    Empty or absent ``values`` keeps every row; NULL, '' and '-1' data never pass.
    """
    vals = filter_values(values)
    if not vals:
        return F.lit(True)
    c = _c(col).cast("string")
    hit = F.arrays_overlap(csv_tokens(c), F.array(*[F.lit(v) for v in vals]))
    return F.coalesce(hit & (c != "-1"), F.lit(False))


def equal_or_all(col, value) -> Column:
    """``col == value``; absent value keeps every row."""
    if value is None or value == "":
        return F.lit(True)
    return F.coalesce(_c(col).cast("string") == F.lit(str(value)), F.lit(False))


@dataclass(frozen=True)
class SessionFilter:
    """Task parameters of the session reports (all optional)."""

    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] | str | None = None
    cities: tuple[str, ...] | str | None = None
    sex: str | None = None
    keywords: tuple[str, ...] | str | None = None
    category_ids: tuple[int, ...] | str | None = None


def session_predicate(p: SessionFilter) -> Column:
    """Conjunction over a session summary joined with user columns."""
    return (between_or_all("age", p.start_age, p.end_age)
            & any_in("professional", p.professionals)
            & any_in("city", p.cities)
            & any_in("sex", p.sex)
            & any_in("search_keywords", p.keywords)
            & any_in("click_category_ids", p.category_ids))


def filter_sessions(df, p: SessionFilter):
    """Keep the sessions that satisfy every given parameter."""
    return df.filter(session_predicate(p))


# The area grading of the regional report (level -> areas).
# Default grading of the original Chinese area names; anything else is 'D'.
AREA_LEVELS_CN = {
    "A": ("华北", "华东"),
    "B": ("华南", "华中"),
    "C": ("西北", "西南"),
}
# The same grading over the TPC-H region names of the test tables.
AREA_LEVELS_REGIONS = {
    "A": ("AMERICA", "EUROPE"),
    "B": ("ASIA",),
    "C": ("AFRICA",),
}


def area_level(col, mapping: Mapping[str, Iterable[str]] = AREA_LEVELS_REGIONS,
               default: str = "D") -> Column:
    """Grade an area; unknown and NULL areas get ``default``."""
    expr = None
    for level, areas in mapping.items():
        cond = _c(col).isin(list(areas))
        expr = F.when(cond, level) if expr is None else expr.when(cond, level)
    return F.lit(default) if expr is None else expr.otherwise(default)


def product_status(col) -> Column:
    """JSON ``product_status`` '0' is 'Self', anything else 'Third Party'."""
    return F.when(json_field(col, "product_status") == "0", "Self").otherwise("Third Party")
