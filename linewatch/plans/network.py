"""Network overview: cross-corridor reliability, volume and disruption causes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from linewatch.functions import calendar

OVERVIEW_COLUMNS = [
    "corridor_id", "corridor_name", "service_date", "pct_on_time", "avg_delay_min",
    "total_departures", "disruption_count", "severe_delay_share", "avg_road_speed_kmh",
    "total_congestion_minutes", "avg_temp_c", "precipitation_mm", "avg_wind_speed_kmh",
    "max_wind_gust_kmh", "is_stormy", "is_heavy_rain",
]
CALENDAR_METRICS = ["pct_on_time", "avg_delay_min", "severe_delay_share", "disruption_count"]


def in_range(df: DataFrame, first: str, last: str) -> DataFrame:
    """Rows of the days from first to last, a partition filter on the day-partitioned tables."""
    return df.where(F.col("service_date").between(
        F.lit(first).cast("date"), F.lit(last).cast("date")))


def network_days(mart: DataFrame, first: str, last: str) -> DataFrame:
    """The days of all corridors, the base of the overview reports.

    Left in no order: a sort below an aggregation of doubles would be kept.
    """
    return in_range(mart, first, last).select(*OVERVIEW_COLUMNS)


def daily_series(days: DataFrame) -> DataFrame:
    """Corridor-days in the order in which they are shown."""
    return days.orderBy("service_date", "corridor_name")


def headline_figures(days: DataFrame) -> DataFrame:
    """One row: departures, mean punctuality, mean delay, disruptions and the days covered."""
    return days.agg(
        F.sum("total_departures").alias("total_departures"),
        F.avg("pct_on_time").alias("avg_on_time"),
        F.avg("avg_delay_min").alias("avg_delay"),
        F.sum("disruption_count").alias("total_disruptions"),
        F.min("service_date").alias("first_day"),
        F.max("service_date").alias("last_day"),
    )


def service_volume(days: DataFrame, grain: str = "W") -> DataFrame:
    """Departures and disruptions per corridor and week ("W") or month ("M").

    The period is labelled with its last day, although the column says start.
    Periods without rows of a corridor do not appear.
    """
    return (
        days.where(F.col("corridor_name").isNotNull())
        .groupBy(calendar.closing_period("service_date", grain).alias("period_start"),
                 "corridor_name")
        .agg(F.sum("total_departures").alias("total_departures"),
             F.sum("disruption_count").alias("disruption_count"))
        .orderBy("period_start", "corridor_name")
    )


def station_stress(days: DataFrame, dim_stations: DataFrame) -> DataFrame:
    """Stations with the figures of their corridor on the latest day there is."""
    latest = days.where(F.col("service_date") == days.agg(F.max("service_date")).scalar())
    stations = dim_stations.select(
        "station_code", "station_name", "corridor_id", "corridor_name", "lat", "lon").distinct()
    return stations.join(
        latest.select("corridor_id", "avg_delay_min", "severe_delay_share"), "corridor_id", "left")


def reliability_calendar(days: DataFrame, metric: str = "pct_on_time") -> DataFrame:
    """Mean of a metric per corridor and day, one row each."""
    if metric not in CALENDAR_METRICS:
        raise ValueError(f"metric must be one of {CALENDAR_METRICS}")
    return days.groupBy("corridor_name", "service_date").agg(F.avg(metric).alias("value"))


def reliability_calendar_grid(
    days: DataFrame, listed_days: Sequence[str], metric: str = "pct_on_time",
) -> DataFrame:
    """The calendar as a grid: a row per corridor, a column per listed day."""
    return (
        days.withColumn("_day", F.date_format("service_date", "yyyy-MM-dd"))
        .groupBy("corridor_name").pivot("_day", list(listed_days)).agg(F.avg(metric))
        .orderBy("corridor_name")
    )


def archive_cause() -> Column:
    """The most general cause known; an empty text counts as known."""
    return F.coalesce("cause_group", "statistical_cause", "cause", F.lit("Unknown"))


def live_cause() -> Column:
    return F.coalesce("cause", "disruption_type", F.lit("Unknown"))


def disruption_causes(
    stg_rdt_disruptions: DataFrame, stg_ns_disruptions: DataFrame, first: str, last: str,
    grain: str = "week",
) -> DataFrame:
    """Disruptions per cause and week (from Sunday) or month, archive and live together."""
    archive = in_range(stg_rdt_disruptions, first, last).select(
        "service_date", archive_cause().alias("cause_family"))
    live = in_range(stg_ns_disruptions, first, last).select(
        "service_date", live_cause().alias("cause_family"))
    return (
        archive.unionByName(live)
        .groupBy(calendar.truncated_period("service_date", grain).alias("period_start"),
                 "cause_family")
        .agg(F.count(F.lit(1)).alias("disruption_count"))
        .orderBy("period_start", F.desc("disruption_count"), "cause_family")
    )


def worst_corridor_days(days: DataFrame, n: int = 12) -> DataFrame:
    """The days with the highest mean delay; equal ones by day and corridor."""
    return (
        days.orderBy(F.col("avg_delay_min").desc_nulls_last(), "service_date", "corridor_name")
        .limit(n)
        .select("service_date", "corridor_name", "avg_delay_min", "severe_delay_share",
                "disruption_count", "total_departures", "avg_wind_speed_kmh",
                "precipitation_mm")
    )
