"""Additive daily rollup of departures, the input of the facts and of the operator reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ROLLUP_KEYS = ["station_code", "operator_name", "service_date"]


def departure_rollup(departures: DataFrame) -> DataFrame:
    """Counts and sums per station, operator and day.

    All measures add up (or are maxima), and the keys are what the reports count distinctly, so
    everything built on this table is exact. It is written once per refresh: facts
    and reports then read a few rows per station-day instead of all departures.
    """
    delay = F.col("delay_minutes")
    return departures.groupBy(*ROLLUP_KEYS).agg(
        F.count(F.lit(1)).alias("departures"),
        F.count(delay).alias("with_delay"),
        F.sum(delay).alias("delay_sum"),
        F.max(delay).alias("delay_max"),
        F.count_if(delay <= 0).alias("at_most_0"),
        F.count_if(delay <= 1).alias("at_most_1"),
        F.count_if(delay > 0).alias("over_0"),
        F.count_if(delay > 5).alias("over_5"),
        F.count_if(delay > 15).alias("over_15"),
        F.sum(F.when(delay > 0, delay).when(delay.isNotNull(), 0)).alias("late_sum"),
    )


def total(measure: str) -> Column:
    return F.sum(measure)


def mean_delay() -> Column:
    """Mean over the departures whose delay is known; NULL when there are none."""
    return F.try_divide(F.sum("delay_sum"), F.sum("with_delay"))


def share(measure: str) -> Column:
    """A counted measure as a fraction of all departures."""
    return F.sum(measure) / F.sum("departures")
