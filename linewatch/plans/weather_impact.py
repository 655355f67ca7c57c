"""Weather impact: how conditions relate to punctuality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from linewatch.functions import columns as C
from linewatch.plans.network import in_range

WEATHER_DAY_COLUMNS = [
    "corridor_id", "corridor_name", "service_date", "pct_on_time", "avg_delay_min",
    "total_departures", "disruption_count", "severe_delay_share", "avg_temp_c", "min_temp_c",
    "max_temp_c", "precipitation_mm", "precipitation_duration_h", "avg_wind_speed_kmh",
    "max_wind_gust_kmh", "is_stormy", "is_heavy_rain", "is_weekend", "is_holiday", "season",
]
# Reading against outcome, as plotted per corridor.
SCATTER_PAIRS = {
    "wind": ("avg_wind_speed_kmh", "pct_on_time"),
    "gust": ("max_wind_gust_kmh", "avg_delay_min"),
    "rain": ("precipitation_mm", "avg_delay_min"),
    "temperature": ("avg_temp_c", "pct_on_time"),
}
WINDY_ABOVE_KMH = 30


def weather_days(mart: DataFrame, first: str, last: str) -> DataFrame:
    """Corridor-days with a wind reading, the base of all reports here, in no order."""
    return in_range(mart, first, last).where(F.col("avg_wind_speed_kmh").isNotNull()).select(
        *WEATHER_DAY_COLUMNS)


def _days() -> Column:
    return F.countDistinct("service_date").alias("days")


def _on_time() -> Column:
    return F.avg("pct_on_time").alias("avg_on_time")


def _delay() -> Column:
    return F.avg("avg_delay_min").alias("avg_delay")


def condition_summary(days: DataFrame) -> DataFrame:
    """Punctuality per weather condition, mildest first."""
    condition = C.weather_condition(
        "is_stormy", "is_heavy_rain", "avg_wind_speed_kmh", "precipitation_mm")
    return (
        days.groupBy(condition.alias("weather_condition"))
        .agg(_days(), _on_time(), _delay(),
             F.avg("severe_delay_share").alias("avg_severe"),
             F.avg("disruption_count").alias("avg_disruptions"))
        .orderBy(C.ordinal_of("weather_condition", C.WEATHER_CONDITIONS))
    )


def _by_bin(
    days: DataFrame, reading: str, edges: list, labels: list[str], name: str, *measures: Column,
) -> DataFrame:
    return (
        days.groupBy(C.right_closed_bin(reading, edges, labels).alias(name))
        .agg(*measures)
        .where(F.col(name).isNotNull())
        .orderBy(C.ordinal_of(name, labels))
    )


def wind_bins(days: DataFrame) -> DataFrame:
    return _by_bin(days, "avg_wind_speed_kmh", C.WIND_EDGES, C.WIND_LABELS, "wind_bin",
                   _days(), _on_time(), _delay())


def rain_bins(days: DataFrame) -> DataFrame:
    return _by_bin(days, "precipitation_mm", C.RAIN_EDGES, C.RAIN_LABELS, "rain_bin",
                   _days(), _on_time())


def temperature_bins(days: DataFrame) -> DataFrame:
    return _by_bin(days, "avg_temp_c", C.TEMPERATURE_EDGES, C.TEMPERATURE_LABELS, "temp_bin",
                   _days(), _on_time())


def seasonal_summary(days: DataFrame) -> DataFrame:
    """Means per season, winter first; a season without days is a row of NULLs."""
    seasons = days.sparkSession.range(1).select(
        F.posexplode(F.array(*[F.lit(s) for s in C.SEASONS])).alias("_nth", "season"))
    means = days.where(F.col("season").isNotNull()).groupBy("season").agg(
        _on_time(), _delay(),
        F.avg("avg_wind_speed_kmh").alias("avg_wind"),
        F.avg("precipitation_mm").alias("avg_rain"),
        F.avg("avg_temp_c").alias("avg_temp"),
    )
    return seasons.join(means, "season", "left").orderBy("_nth").drop("_nth")


def wind_sensitivity(days: DataFrame) -> DataFrame:
    """Punctuality per corridor on windy and on calm days."""
    windy = F.coalesce(F.col("avg_wind_speed_kmh") > WINDY_ABOVE_KMH, F.lit(False))
    return (
        days.where(F.col("corridor_name").isNotNull())
        .groupBy("corridor_name", windy.alias("is_windy"))
        .agg(_on_time(), _days())
        .withColumn("condition", F.when(F.col("is_windy"), "Windy (>30 km/h)")
                    .otherwise("Calm (<30 km/h)"))
        .orderBy("corridor_name", "is_windy")
    )


def scatter(days: DataFrame, pair: str) -> DataFrame:
    """A reading against an outcome for every corridor-day."""
    reading, outcome = SCATTER_PAIRS[pair]
    return days.select("corridor_name", "service_date", reading, outcome)
