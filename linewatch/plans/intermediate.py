"""Intermediate models: combined departures and the daily statistics built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from linewatch.functions.columns import share_pct, stable_round
from linewatch.operators import rollup
from linewatch.operators.combine import union_by_priority
from linewatch.operators.quantile import counted_quantile, grouped_quantile
from linewatch.operators.skew import join_per_key

DEPARTURE_COLUMNS = [
    "departure_id", "station_code", "service_date", "direction", "planned_departure_ts",
    "actual_departure_ts", "delay_minutes", "is_cancelled", "train_number", "train_category",
    "operator_name", "data_source",
]
CONGESTED_BELOW = 0.5
FREE_FLOW_QUANTILE = 0.85
READING_MINUTES = 15


def archive_departures(stg_rdt_services: DataFrame) -> DataFrame:
    """Archived stops a train departs from, in the shape of live departures.

    Cancelled ones are kept. The flag for the whole train decides when it is
    known, even if it is false and the departure itself was cancelled.
    """
    planned = F.col("departure_ts")
    late = F.coalesce(F.col("departure_delay_min"), F.lit(0)).cast("int")
    return stg_rdt_services.where(planned.isNotNull()).select(
        "departure_id", "station_code", "service_date",
        F.lit(None).cast("string").alias("direction"),
        planned.alias("planned_departure_ts"),
        F.timestamp_add("MINUTE", late, planned).alias("actual_departure_ts"),
        F.col("departure_delay_minutes").alias("delay_minutes"),
        F.coalesce("completely_cancelled", "departure_cancelled").alias("is_cancelled"),
        "train_number",
        F.col("service_type").alias("train_category"),
        F.col("company").alias("operator_name"),
        "data_source",
    )


def int_departures_combined(
    stg_ns_departures: DataFrame, stg_rdt_services: DataFrame | None,
) -> DataFrame:
    """Archive first; live departures only for days the archive does not cover."""
    live = stg_ns_departures.select(*DEPARTURE_COLUMNS)
    if stg_rdt_services is None:
        return live
    return union_by_priority(archive_departures(stg_rdt_services), live, "service_date")


def rollup_by_priority(
    stg_ns_departures: DataFrame, stg_rdt_services: DataFrame | None,
) -> DataFrame:
    """The rollup of the combined departures, each source rolled up on its own.

    The sources never share a day in the combined departures, so the two
    rollups have no key in common. The archive need not wait for its days to be
    known, and the anti join sees station-days instead of departures.
    """
    live = rollup.departure_rollup(stg_ns_departures)
    if stg_rdt_services is None:
        return live
    archive = archive_departures(stg_rdt_services)
    return union_by_priority(
        rollup.departure_rollup(archive), live, "service_date", covering=archive)


def disruptions_per_station_day(
    *disruptions: DataFrame, days: DataFrame | None = None,
) -> DataFrame:
    """Distinct disruptions that name a station, per day; of the days in service_date of `days` only,
    if given. These are told apart before a list is taken apart or counted.

    explode_outer with a filter behind it: for a plain explode the optimizer
    adds a size test below, which would parse the JSON of the list twice.
    """
    columns = ["disruption_id", "service_date", "affected_station_codes"]
    both = disruptions[0].select(*columns)
    for other in disruptions[1:]:
        both = both.unionByName(other.select(*columns))
    if days is not None:
        both = both.join(days.select("service_date").distinct(), "service_date", "left_semi")
    return (
        both.select("disruption_id", "service_date",
                    F.explode_outer("affected_station_codes").alias("station_code"))
        .where(F.col("station_code").isNotNull())
        .groupBy("station_code", "service_date")
        .agg(F.countDistinct("disruption_id").alias("disruption_count"))
    )


def int_train_delays_daily(
    departure_rollup: DataFrame, stg_ns_disruptions: DataFrame, stg_rdt_disruptions: DataFrame,
    days: DataFrame | None = None,
) -> DataFrame:
    """Delay statistics per station and day; a missing delay counts in the base of the shares.

    Both sides are aggregated before they meet, and both are then partitioned
    by the join keys already. days, such as the written rollup, has every service_date of
    departures and is cheap to read: disruptions of other days, which the archive has for many
    years, are then left out before they are counted.
    """
    return delays_with_counts(departure_rollup, disruptions_per_station_day(
        stg_ns_disruptions, stg_rdt_disruptions, days=days))


def delays_with_counts(departure_rollup: DataFrame, counts: DataFrame) -> DataFrame:
    """int_train_delays_daily out of the rollup and the disruptions per station and day."""
    departures = rollup.total("departures")
    stats = departure_rollup.groupBy("station_code", "service_date").agg(
        departures.alias("total_departures"),
        stable_round(rollup.mean_delay(), 2).alias("avg_delay_min"),
        stable_round(F.max("delay_max"), 2).alias("max_delay_min"),
        share_pct(rollup.total("at_most_1"), departures, 2).alias("pct_on_time"),
        share_pct(rollup.total("over_15"), departures, 2).alias("severe_delay_share"),
    )
    return stats.join(counts, ["station_code", "service_date"], "left").withColumn(
        "disruption_count", F.coalesce("disruption_count", F.lit(0)).cast("bigint"))


def free_flow_speed(stg_ndw_traffic_flow: DataFrame) -> DataFrame:
    """85th percentile of speed per road point."""
    return grouped_quantile(
        stg_ndw_traffic_flow, "location_id", "avg_speed_kmh", FREE_FLOW_QUANTILE,
        "free_flow_speed_kmh")


def road_counts(stg_ndw_traffic_flow: DataFrame) -> DataFrame:
    """Readings and vehicles per road point, day and speed: all that the road models need."""
    return stg_ndw_traffic_flow.groupBy("location_id", "service_date", "avg_speed_kmh").agg(
        F.count(F.lit(1)).alias("readings"), F.sum("vehicle_count").alias("vehicles"))


def counted_free_flow_speed(counts: DataFrame) -> DataFrame:
    """free_flow_speed out of counts of readings by road point and speed."""
    return counted_quantile(counts, "location_id", "avg_speed_kmh", "readings",
                            FREE_FLOW_QUANTILE, "free_flow_speed_kmh")


def counted_traffic_daily(road_counts: DataFrame, free_flow: DataFrame) -> DataFrame:
    """int_ndw_traffic_daily out of road_counts and the written free-flow speeds."""
    speed, n = F.col("avg_speed_kmh"), F.col("readings")
    slow = speed < F.col("free_flow_speed_kmh") * CONGESTED_BELOW
    known = F.when(speed.isNotNull(), n)
    return road_counts.join(free_flow, "location_id", "left").groupBy(
        "location_id", "service_date").agg(
        stable_round(F.try_divide(F.sum(speed * n), F.sum(known)), 2).alias("avg_speed_kmh"),
        F.sum("vehicles").alias("total_vehicle_count"),
        (F.coalesce(F.sum(F.when(slow, n)), F.lit(0)) * READING_MINUTES).alias("congestion_minutes"),
    )


def int_ndw_traffic_daily(
    stg_ndw_traffic_flow: DataFrame, free_flow: DataFrame | None = None,
) -> DataFrame:
    """Speed, volume and congested minutes per road point and day.

    free_flow is the written table of free-flow speeds: its size is known, so
    Spark broadcasts it if it is small. Without it the speeds are part of this
    plan, and road points with many readings are spread over tasks.
    """
    speed = F.col("avg_speed_kmh")
    slow = speed < F.col("free_flow_speed_kmh") * CONGESTED_BELOW
    if free_flow is None:
        readings = join_per_key(
            stg_ndw_traffic_flow, free_flow_speed(stg_ndw_traffic_flow), "location_id", "left",
            spread_by=["service_date", "avg_speed_kmh"])
    else:
        readings = stg_ndw_traffic_flow.join(free_flow, "location_id", "left")
    return readings.groupBy("location_id", "service_date").agg(
        stable_round(F.avg(speed), 2).alias("avg_speed_kmh"),
        F.sum("vehicle_count").alias("total_vehicle_count"),
        (F.count_if(slow) * READING_MINUTES).alias("congestion_minutes"),
    )
