"""System and operators: network scale, operator reliability, disruption history.

Reports on departures read the daily departure rollup (operators/rollup.py).
On these reports a departure is on time when its delay is at most 0 minutes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from linewatch.functions import calendar
from linewatch.functions.columns import stable_round
from linewatch.operators import rollup
from linewatch.plans.network import in_range

MIN_DEPARTURES = 1000
LONG_DISRUPTION_MINUTES = 120


def _departures() -> Column:
    return rollup.total("departures").alias("departures")


def _mean_delay() -> Column:
    return stable_round(rollup.mean_delay(), 2).alias("avg_delay_min")


def _pct(measure: str, name: str) -> Column:
    return stable_round(rollup.share(measure) * 100.0, 1).alias(name)


def system_figures(departure_rollup: DataFrame, first: str, last: str) -> DataFrame:
    """One row: departures, stations, operators, days, mean delay, share delayed."""
    return in_range(departure_rollup, first, last).agg(
        rollup.total("departures").alias("total_departures"),
        F.countDistinct("station_code").alias("active_stations"),
        F.countDistinct("operator_name").alias("operators"),
        F.countDistinct("service_date").alias("service_days"),
        _mean_delay(),
        _pct("over_0", "pct_delayed"),
    )


def operator_profiles(
    departure_rollup: DataFrame, dim_operators: DataFrame, first: str, last: str,
) -> DataFrame:
    """Operator cards with their figures; operators without departures are left out."""
    figures = in_range(departure_rollup, first, last).groupBy("operator_name").agg(
        _departures(), _mean_delay(), _pct("at_most_0", "pct_on_time"))
    return dim_operators.join(figures, "operator_name").orderBy(
        F.desc("departures"), "operator_name")


def monthly_departures(
    departure_rollup: DataFrame, first: str, last: str,
    selected: Sequence[str] | None = None, top: int = 8,
) -> DataFrame:
    """Departures per month of the largest operators, the others taken together."""
    monthly = (
        in_range(departure_rollup, first, last).where(F.col("operator_name").isNotNull())
        .groupBy(calendar.month_label("service_date").alias("month"), "operator_name")
        .agg(_departures())
    )
    if selected:
        monthly = monthly.where(F.col("operator_name").isin(list(selected)))
    largest = (
        monthly.groupBy("operator_name").agg(F.sum("departures").alias("_total"))
        .orderBy(F.desc("_total"), "operator_name").limit(top)
        .select("operator_name", F.col("operator_name").alias("_shown"))
    )
    return (
        monthly.join(largest, "operator_name", "left")
        .groupBy("month", F.coalesce("_shown", F.lit("Other")).alias("operator"))
        .agg(_departures())
        .orderBy("month", "operator")
    )


def operator_ranking(
    departure_rollup: DataFrame, first: str, last: str, min_departures: int = MIN_DEPARTURES,
) -> DataFrame:
    return (
        in_range(departure_rollup, first, last).where(F.col("operator_name").isNotNull())
        .groupBy("operator_name")
        .agg(_departures(), _mean_delay(), _pct("at_most_0", "pct_on_time"),
             _pct("over_5", "pct_over_5min"), _pct("over_15", "pct_over_15min"))
        .where(F.col("departures") >= min_departures)
        .orderBy(F.desc("departures"), "operator_name")
    )


def station_names(stg_rdt_services: DataFrame, keep_empty: bool = False) -> DataFrame:
    """One name per archived station: the first in order, so that it never varies."""
    named = stg_rdt_services.where(F.col("station_name").isNotNull())
    if not keep_empty:
        named = named.where(F.col("station_name") != "")
    return named.groupBy("station_code").agg(F.min("station_name").alias("station_name"))


def busiest_stations(
    departure_rollup: DataFrame, names: DataFrame, first: str, last: str, n: int = 25,
) -> DataFrame:
    """Stations with the most departures. Aggregated first, named afterwards."""
    per_station = in_range(departure_rollup, first, last).groupBy("station_code").agg(
        _departures(),
        F.countDistinct("operator_name").alias("operators"),
        _mean_delay(),
        _pct("at_most_0", "pct_on_time"),
    )
    top = per_station.orderBy(F.desc("departures"), "station_code").limit(n)
    return top.join(names, "station_code", "left").select(
        "station_code", F.coalesce("station_name", "station_code").alias("station_name"),
        "departures", "operators", "avg_delay_min", "pct_on_time",
    ).orderBy(F.desc("departures"), "station_code")


def network_scale(
    departure_rollup: DataFrame, first: str, last: str, stations: Sequence[str] | None = None,
) -> DataFrame:
    """Active stations, operators, departures and mean delay per month."""
    rows = in_range(departure_rollup, first, last)
    if stations:
        rows = rows.where(F.col("station_code").isin(list(stations)))
    return rows.groupBy(calendar.month_label("service_date").alias("month")).agg(
        F.countDistinct("station_code").alias("active_stations"),
        F.countDistinct("operator_name").alias("active_operators"),
        _departures(), _mean_delay(),
    ).orderBy("month")


def _year() -> Column:
    return F.year("service_date").cast("bigint").alias("year")


def disruptions_by_year(stg_rdt_disruptions: DataFrame) -> DataFrame:
    minutes = F.col("duration_minutes")
    return stg_rdt_disruptions.groupBy(_year()).agg(
        F.count(F.lit(1)).alias("total_disruptions"),
        stable_round(F.avg(minutes), 0).alias("avg_duration_min"),
        F.count_if(minutes > LONG_DISRUPTION_MINUTES).alias("long_disruptions"),
    ).orderBy("year")


def disruption_causes_by_year(stg_rdt_disruptions: DataFrame) -> DataFrame:
    return (
        stg_rdt_disruptions.where(F.col("cause_group") != "")
        .groupBy(_year(), "cause_group")
        .agg(F.count(F.lit(1)).alias("disruptions"))
        .orderBy("year", F.desc("disruptions"), "cause_group")
    )


def cause_totals(causes_by_year: DataFrame) -> DataFrame:
    return causes_by_year.groupBy("cause_group").agg(
        F.sum("disruptions").alias("disruptions")).orderBy(F.desc("disruptions"), "cause_group")


def delay_attribution(
    departure_rollup: DataFrame, first: str, last: str, min_departures: int = MIN_DEPARTURES,
) -> DataFrame:
    """Delay minutes per operator (early departures count 0) and mean delay of late ones."""
    return (
        in_range(departure_rollup, first, last).where(F.col("operator_name").isNotNull())
        .groupBy("operator_name")
        .agg(
            _departures(),
            F.sum("late_sum").alias("total_delay_min"),
            stable_round(F.try_divide(F.sum("late_sum"), F.sum("over_0")), 2)
            .alias("avg_delay_when_late"),
        )
        .where(F.col("departures") >= min_departures)
        .orderBy(F.col("total_delay_min").desc_nulls_last(), "operator_name")
    )


def attribution_shares(attribution: DataFrame, n: int = 10) -> DataFrame:
    """The operators that cause most delay minutes."""
    return attribution.orderBy(
        F.col("total_delay_min").desc_nulls_last(), "operator_name").limit(n)
