"""Calendar arithmetic, written out so that the first day of the week is never left to a default."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from linewatch.functions.columns import as_column


def sunday_week_start(day: Column | str) -> Column:
    d = as_column(day)
    return F.date_sub(d, F.dayofweek(d) - 1)


def month_start(day: Column | str) -> Column:
    return F.trunc(as_column(day), "MM")


def truncated_period(day: Column | str, grain: str) -> Column:
    """First day of the period: weeks start on Sunday."""
    return {"week": sunday_week_start, "month": month_start}[grain](day)


def sunday_week_end(day: Column | str) -> Column:
    d = as_column(day)
    return F.date_add(d, (8 - F.dayofweek(d)) % 7)


def closing_period(day: Column | str, grain: str) -> Column:
    """Last day of the period: "W" ends on Sunday, "M" on the last of the month."""
    return {"W": sunday_week_end, "M": lambda d: F.last_day(as_column(d))}[grain](day)


def month_label(day: Column | str) -> Column:
    return F.date_format(as_column(day), "yyyy-MM")


def season(month: Column | str) -> Column:
    m = as_column(month)
    return (
        F.when(m.between(3, 5), "spring")
        .when(m.between(6, 8), "summer")
        .when(m.between(9, 11), "autumn")
        .otherwise("winter")
    )


def date_spine(spark: SparkSession, first: dt.date | str, last: dt.date | str) -> DataFrame:
    """One row per day from first to last, both included."""
    days = F.sequence(F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date"))
    return spark.range(1).select(F.explode(days).alias("date_day"))


def recent_days(df: DataFrame, day: str, as_of: str | None, days: int = 30) -> DataFrame:
    """Development scope: rows of the last days before as_of, and later ones. None is no scope."""
    if as_of is None:
        return df
    return df.where(F.col(day).cast("date") >= F.date_sub(F.lit(as_of).cast("date"), days))
