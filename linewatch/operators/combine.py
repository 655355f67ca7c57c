"""Source-priority union."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def union_by_priority(
    preferred: DataFrame, fallback: DataFrame, day: str, covering: DataFrame | None = None,
) -> DataFrame:
    """All preferred rows, plus fallback rows of days the preferred source does not cover.

    NOT IN semantics: a preferred row without a day hides every fallback row,
    and a fallback row without a day is dropped unless the preferred side is
    empty. Spark plans it as a null-aware anti join and broadcasts the inner
    side whatever its size. Here that side is the distinct values of a date
    column: at most one per calendar day, so some thousands for decades of
    data, however many rows there are. The column must therefore be a date.
    covering is a cheaper frame with the same days as preferred, if there is one.
    """
    if dict(preferred.dtypes)[day] != "date":
        raise TypeError(f"{day} must be a date, it bounds what is broadcast")
    covered = (preferred if covering is None else covering).select(day).distinct()
    return preferred.unionByName(fallback.where(~F.col(day).isin(covered)))
