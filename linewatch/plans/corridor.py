"""Corridor explorer: one corridor's stations, operators, causes and trend."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from linewatch.functions import calendar
from linewatch.operators import rollup
from linewatch.plans.network import archive_cause, in_range, live_cause


def corridors(mart: DataFrame) -> DataFrame:
    return mart.select("corridor_id", "corridor_name").distinct().orderBy("corridor_name")


def corridor_days(mart: DataFrame, corridor_id: int, first: str, last: str) -> DataFrame:
    """The days of one corridor, all mart columns, in no order."""
    return in_range(mart, first, last).where(F.col("corridor_id") == corridor_id)


def volume_and_delay_trend(days: DataFrame, grain: str = "W") -> DataFrame:
    """Sums and means per period, with a row for every period in between.

    Periods carry the label of their last day. One without rows has sums of 0
    and no means. Each period fills the gap up to the next one itself, so the
    days are aggregated once; the window runs over the periods only.
    """
    period = F.col("period_start")
    per_period = days.groupBy(
        calendar.closing_period("service_date", grain).alias("period_start")
    ).agg(
        F.sum("total_departures").alias("total_departures"),
        F.avg("avg_delay_min").alias("avg_delay_min"),
        F.sum("disruption_count").alias("disruption_count"),
        F.avg("severe_delay_share").alias("severe_delay_share"),
    )
    next_period = F.lead("period_start").over(Window.orderBy("period_start"))
    following = F.coalesce("_next", F.date_add(period, 1))
    if grain == "W":
        steps = F.sequence(period, F.date_sub(following, 1), F.expr("interval 7 days"))
    else:
        steps = F.transform(
            F.sequence(F.trunc(period, "MM"), F.date_sub(F.trunc(following, "MM"), 1),
                       F.expr("interval 1 month")),
            lambda d: F.last_day(d))
    filled = per_period.where(period.isNotNull()).withColumn("_next", next_period).select(
        "*", F.posexplode(steps).alias("_nth", "_period"))
    has_rows = F.col("_nth") == 0

    def amount(name: str) -> Column:
        known = F.when(has_rows, F.col(name))
        return F.coalesce(known, F.lit(0)).cast("bigint").alias(name)

    def mean(name: str) -> Column:
        return F.when(has_rows, F.col(name)).alias(name)

    return filled.select(
        F.col("_period").alias("period_start"), amount("total_departures"),
        mean("avg_delay_min"), amount("disruption_count"), mean("severe_delay_share"),
    ).orderBy("period_start")


def station_performance(
    fct_train_performance: DataFrame, dim_stations: DataFrame, corridor_id: int,
    first: str, last: str, dedupe_dim: bool = False,
) -> DataFrame:
    """Figures per station of a corridor.

    The dimension has a row per corridor of a station, so the sums of a station
    on three corridors count three times. dedupe_dim=True counts them once.
    """
    names = dim_stations.select("station_code", "station_name")
    if dedupe_dim:
        names = names.distinct()
    facts = in_range(fct_train_performance, first, last).where(F.col("corridor_id") == corridor_id)
    return (
        facts.join(names, "station_code")
        .groupBy("station_code", "station_name")
        .agg(
            F.avg("avg_delay_min").alias("avg_delay_min"),
            F.avg("severe_delay_share").alias("avg_severe_delay_share"),
            F.avg("pct_on_time").alias("avg_pct_on_time"),
            F.sum("total_departures").alias("total_departures"),
            F.sum("disruption_count").alias("total_disruptions"),
        )
        .orderBy(F.col("avg_delay_min").desc_nulls_last(), "station_code")
    )


def _stations_of(dim_stations: DataFrame, corridor_id: int) -> DataFrame:
    return dim_stations.where(F.col("corridor_id") == corridor_id).select("station_code")


def operator_mix(
    departure_rollup: DataFrame, dim_stations: DataFrame, corridor_id: int, first: str, last: str,
) -> DataFrame:
    """Departures and mean delay per operator at the stations of a corridor."""
    return (
        in_range(departure_rollup, first, last)
        .join(_stations_of(dim_stations, corridor_id), "station_code")
        .groupBy(F.coalesce("operator_name", F.lit("Unknown")).alias("operator_name"))
        .agg(rollup.total("departures").alias("departures"),
             rollup.mean_delay().alias("avg_delay_min"))
        .where(F.col("departures") > 0)
        .orderBy(F.desc("departures"), "operator_name")
    )


def top_causes(
    stg_rdt_disruptions: DataFrame, stg_ns_disruptions: DataFrame, dim_stations: DataFrame,
    corridor_id: int, first: str, last: str, n: int = 12,
) -> DataFrame:
    """The most frequent causes in a corridor; a disruption counts once per station it names."""
    def named_stations(disruptions: DataFrame, cause: Column) -> DataFrame:
        return in_range(disruptions, first, last).select(
            cause.alias("cause_family"),
            F.explode_outer("affected_station_codes").alias("station_code"))

    both = named_stations(stg_rdt_disruptions, archive_cause()).unionByName(
        named_stations(stg_ns_disruptions, live_cause()))
    return (
        both.join(_stations_of(dim_stations, corridor_id), "station_code")
        .groupBy("cause_family")
        .agg(F.count(F.lit(1)).alias("disruption_count"))
        .orderBy(F.desc("disruption_count"), "cause_family")
        .limit(n)
    )


def worst_days(days: DataFrame, n: int = 10) -> DataFrame:
    """The corridor's days with the highest mean delay; equal ones by day."""
    return (
        days.orderBy(F.col("avg_delay_min").desc_nulls_last(), "service_date")
        .limit(n)
        .select("service_date", "avg_delay_min", "severe_delay_share", "disruption_count",
                "total_departures")
    )
