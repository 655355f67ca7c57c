"""What disruptions do to the roads near their stations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from linewatch.functions.columns import stable_round

#: Hours looked at before a disruption and after it.
AROUND_HOURS = 2
#: Length of the bins of time in which disruptions and readings meet.
BIN_SECONDS = 3600
PHASES = ["before", "during", "after"]


def _bin(at: Column) -> Column:
    return F.floor(at.cast("long") / BIN_SECONDS).cast("bigint")


def disruption_windows(disruptions: DataFrame, dim_ndw_locations: DataFrame,
                       around_hours: int = AROUND_HOURS) -> DataFrame:
    """disruption_id, location_id, start_ts, end_ts, bin: the bins from some hours before to some
    hours after each disruption, for the road points whose nearest station it names.

    A disruption without an end, or that ends before it starts, has no time of its own: it ends when
    it starts. One without a start has no window.
    """
    start = F.col("start_ts")
    end = F.greatest(start, F.coalesce("end_ts", start))
    margin = F.make_dt_interval(hours=F.lit(around_hours))
    near = dim_ndw_locations.select("location_id", F.col("nearest_station_code").alias("station_code"))
    # explode_outer with a filter behind it: see intermediate.disruptions_per_station_day
    named = disruptions.where(start.isNotNull()).select(
        "disruption_id", start.alias("start_ts"), end.alias("end_ts"),
        F.explode_outer(F.array_distinct("affected_station_codes")).alias("station_code"),
    ).where(F.col("station_code").isNotNull())
    return named.join(near, "station_code").select(
        "disruption_id", "location_id", "start_ts", "end_ts").distinct().select(
        "*", F.explode(F.sequence(_bin(F.col("start_ts") - margin),
                                  _bin(F.col("end_ts") + margin))).alias("bin"))


def disruption_road_impact(
    stg_ndw_traffic_flow: DataFrame, disruptions: DataFrame, dim_ndw_locations: DataFrame,
    around_hours: int = AROUND_HOURS,
) -> DataFrame:
    """A row for each disruption with readings around it: mean speed, vehicles and readings in the
    hours before it, from its start up to its end, and in the hours from its end on.

    An interval join without a nested loop: both sides know the bins of time they lie in, so they
    meet by road point and bin, and the exact times decide then. Readings are summed up by point
    and quarter of an hour first.
    """
    at = F.col("measurement_ts")
    readings = stg_ndw_traffic_flow.where(at.isNotNull()).groupBy("location_id", at).agg(
        F.sum("avg_speed_kmh").alias("speed"), F.count("avg_speed_kmh").alias("speeds"),
        F.sum("vehicle_count").alias("vehicles"), F.count(F.lit(1)).alias("readings")
    ).withColumn("bin", _bin(at))
    margin = F.make_dt_interval(hours=F.lit(around_hours))
    phase = (
        F.when((at >= F.col("start_ts") - margin) & (at < F.col("start_ts")), "before")
        .when((at >= F.col("start_ts")) & (at < F.col("end_ts")), "during")
        .when((at >= F.col("end_ts")) & (at < F.col("end_ts") + margin), "after"))
    met = readings.join(
        disruption_windows(disruptions, dim_ndw_locations, around_hours), ["location_id", "bin"]
    ).withColumn("phase", phase).where(F.col("phase").isNotNull())

    def of(phase_: str, measure: str) -> Column:
        return F.sum(F.when(F.col("phase") == phase_, F.col(measure)))

    figures = []
    for p in PHASES:
        figures += [
            stable_round(F.try_divide(of(p, "speed"), of(p, "speeds")), 2).alias(f"avg_speed_{p}"),
            of(p, "vehicles").alias(f"vehicles_{p}"),
            F.coalesce(of(p, "readings"), F.lit(0)).alias(f"readings_{p}")]
    return met.groupBy("disruption_id", "start_ts", "end_ts").agg(*figures).withColumn(
        "speed_change_kmh", stable_round(F.col("avg_speed_during") - F.col("avg_speed_before"), 2))
