"""Dimensions, facts and the corridor-day mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from linewatch.functions import calendar
from linewatch.functions.columns import stable_round
from linewatch.schemas import ROAD_MART_COLUMNS, WEATHER_MART_COLUMNS

# Bounds of the date dimension.
DIM_DATE_FIRST, DIM_DATE_LAST = "2026-01-01", "2027-12-31"


def dim_stations(station_corridor_mapping: DataFrame) -> DataFrame:
    """Stations with corridor; a station on several corridors has one row for each."""
    return station_corridor_mapping.select(
        "station_code", "station_name", "corridor_id", "corridor_name",
        F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"),
    ).distinct()


def dim_date(
    spark: SparkSession, nl_holidays: DataFrame,
    first: str = DIM_DATE_FIRST, last: str = DIM_DATE_LAST,
) -> DataFrame:
    """Calendar attributes per day; day 1 of the week is Sunday, weeks are numbered by ISO."""
    d = F.col("date_day")
    weekday = F.dayofweek(d)
    holidays = nl_holidays.select(F.col("date").cast("date").alias("date_day"), "holiday_name")
    days = calendar.date_spine(spark, first, last).join(holidays, "date_day", "left")
    return days.select(
        d.alias("date"),
        weekday.cast("bigint").alias("day_of_week"),
        F.weekofyear(d).cast("bigint").alias("week_number"),
        F.month(d).cast("bigint").alias("month"),
        calendar.season(F.month(d)).alias("season"),
        F.col("holiday_name").isNotNull().alias("is_holiday"),
        weekday.isin(1, 7).alias("is_weekend"),
        "holiday_name",
    )


def dim_ndw_locations(
    station_ndw_mapping: DataFrame, station_corridor_mapping: DataFrame,
) -> DataFrame:
    """Road points with their nearest station and that station's first corridor."""
    corridors = station_corridor_mapping.select("station_code", "corridor_id").distinct()
    nearest = Window.partitionBy("ndw_location_id").orderBy(
        F.col("distance_km").asc_nulls_first(), F.col("station_code").asc_nulls_first(),
        F.col("corridor_id").asc_nulls_first())
    return (
        station_ndw_mapping.join(corridors, "station_code", "left")
        .withColumn("_nth", F.row_number().over(nearest))
        .where(F.col("_nth") == 1)
        .select(
            F.col("ndw_location_id").alias("location_id"), "road_name",
            F.col("ndw_lat").cast("double").alias("lat"),
            F.col("ndw_lon").cast("double").alias("lon"),
            F.col("station_code").alias("nearest_station_code"), "corridor_id",
            F.col("distance_km").cast("double").alias("distance_km"),
        )
    )


def fct_train_performance(
    int_train_delays_daily: DataFrame, dim_stations: DataFrame,
    as_of: str | None = None, lookback_days: int = 3,
) -> DataFrame:
    """Station-day facts per corridor; with as_of only the days an incremental run recomputes."""
    daily = int_train_delays_daily
    if as_of is not None:
        daily = daily.where(
            F.col("service_date") >= F.date_sub(F.lit(as_of).cast("date"), lookback_days))
    corridors = dim_stations.select("station_code", "corridor_id", "corridor_name").distinct()
    return daily.join(corridors, "station_code", "left").select(
        "station_code", "service_date", "corridor_id", "corridor_name", "total_departures",
        "avg_delay_min", "max_delay_min", "pct_on_time", "severe_delay_share", "disruption_count")


def fct_road_traffic(int_ndw_traffic_daily: DataFrame, dim_ndw_locations: DataFrame) -> DataFrame:
    """Road-point-day facts relative to the road point's own mean speed.

    The mean is a window over the daily rows, so the readings below are
    aggregated once; a road point has as many rows here as there are days.
    """
    baseline = F.avg("avg_speed_kmh").over(Window.partitionBy("location_id"))
    relative = F.try_divide(F.col("avg_speed_kmh"), F.col("_baseline")) * 100.0
    return (
        int_ndw_traffic_daily.withColumn("_baseline", baseline)
        .join(dim_ndw_locations.select("location_id", "corridor_id"), "location_id", "left")
        .select("location_id", "service_date", "corridor_id", "avg_speed_kmh",
                "total_vehicle_count", "congestion_minutes",
                F.when(F.col("location_id").isNotNull(), stable_round(relative, 2))
                .alias("speed_vs_baseline_pct"))
    )


def corridor_weather(stg_knmi_weather: DataFrame, knmi_corridor_mapping: DataFrame) -> DataFrame:
    """Weather per corridor and day over the stations mapped to the corridor."""
    mapping = knmi_corridor_mapping.select(
        F.col("knmi_station_code").cast("string").alias("knmi_station_code"), "corridor_id")
    averaged = [c for c in WEATHER_MART_COLUMNS if c.startswith(("avg_", "min_", "max_temp", "prec"))]

    def any_true(flag: str) -> Column:
        # false, not NULL, when no station has a reading
        return (F.max(F.when(F.col(flag), 1).otherwise(0)) == 1).alias(flag)

    return (
        stg_knmi_weather.join(mapping, "knmi_station_code")
        .groupBy("corridor_id", "service_date")
        .agg(
            *[stable_round(F.avg(c), 1).alias(c) for c in averaged],
            stable_round(F.max("max_wind_gust_kmh"), 1).alias("max_wind_gust_kmh"),
            any_true("is_stormy"), any_true("is_heavy_rain"),
        )
    )


def corridor_road(fct_road_traffic: DataFrame) -> DataFrame:
    """Road figures per corridor and day."""
    return fct_road_traffic.groupBy("corridor_id", "service_date").agg(
        stable_round(F.avg("avg_speed_kmh"), 2).alias("avg_road_speed_kmh"),
        F.sum("total_vehicle_count").alias("total_vehicle_count"),
        F.sum("congestion_minutes").alias("total_congestion_minutes"),
        stable_round(F.avg("speed_vs_baseline_pct"), 2).alias("road_speed_vs_baseline_pct"),
    )


def corridor_train(fct_train_performance: DataFrame) -> DataFrame:
    """Train figures per corridor and day; stations weigh the same whatever their traffic."""
    return (
        fct_train_performance.where(F.col("corridor_id").isNotNull())
        .groupBy("corridor_id", "corridor_name", "service_date")
        .agg(
            stable_round(F.avg("pct_on_time"), 2).alias("pct_on_time"),
            stable_round(F.avg("avg_delay_min"), 2).alias("avg_delay_min"),
            F.sum("total_departures").alias("total_departures"),
            F.sum("disruption_count").alias("disruption_count"),
            stable_round(F.avg("severe_delay_share"), 2).alias("severe_delay_share"),
        )
    )


def dm_multimodal_daily(
    fct_train_performance: DataFrame, dim_date: DataFrame,
    fct_road_traffic: DataFrame | None = None, stg_knmi_weather: DataFrame | None = None,
    knmi_corridor_mapping: DataFrame | None = None,
) -> DataFrame:
    """The corridor-day mart. Without roads or weather their columns are there but NULL."""
    mart = corridor_train(fct_train_performance)
    keys = ["corridor_id", "service_date"]

    def attach(side: DataFrame | None, columns: dict[str, str]) -> DataFrame:
        if side is not None:
            return mart.join(side, keys, "left")
        return mart.withColumns({c: F.lit(None).cast(t) for c, t in columns.items()})

    mart = attach(
        None if fct_road_traffic is None else corridor_road(fct_road_traffic), ROAD_MART_COLUMNS)
    mart = attach(
        None if stg_knmi_weather is None
        else corridor_weather(stg_knmi_weather, knmi_corridor_mapping), WEATHER_MART_COLUMNS)
    calendar_columns = ["day_of_week", "week_number", "month", "season", "is_holiday", "is_weekend"]
    days = dim_date.select(F.col("date").alias("service_date"), *calendar_columns)
    return mart.join(days, "service_date", "left").select(
        "corridor_id", "corridor_name", "service_date", *calendar_columns,
        "pct_on_time", "avg_delay_min", "total_departures", "disruption_count",
        "severe_delay_share", *ROAD_MART_COLUMNS, *WEATHER_MART_COLUMNS)
