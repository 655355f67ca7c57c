"""Reader of the daily weather feed, whose values come in tenths of a unit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from linewatch import schemas

WEATHER_SOURCE = "knmi"

# Weather station code -> region.
STATION_REGIONS = {
    "240": "amsterdam",
    "344": "rotterdam",
    "260": "utrecht",
    "215": "den_haag",
    "370": "eindhoven",
}


def _region(station_code: Column) -> Column:
    mapping = F.create_map(*[F.lit(x) for pair in STATION_REGIONS.items() for x in pair])
    return F.coalesce(F.try_element_at(mapping, station_code), F.lit("unknown"))


def _tenths(name: str) -> Column:
    return F.col(name) / F.lit(10.0)


def scaled_readings(readings: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Unit values from raw readings. Trace rain (-1) is 0, missing stays NULL."""
    station = F.col("station_code").cast("string")
    return readings.select(
        station.alias("station_code"),
        _region(station).alias("station_region"),
        F.substring("date", 1, 10).alias("service_date"),
        _tenths("TG").alias("avg_temp_c"),
        _tenths("TN").alias("min_temp_c"),
        _tenths("TX").alias("max_temp_c"),
        F.when(F.col("RH").isNotNull(), F.greatest(F.col("RH"), F.lit(0)) / F.lit(10.0))
        .alias("precipitation_mm"),
        _tenths("DR").alias("precipitation_duration_h"),
        _tenths("FG").alias("avg_wind_speed_ms"),
        _tenths("FHX").alias("max_wind_gust_ms"),
        F.col("DDVEC").alias("wind_direction_deg"),
        F.lit(WEATHER_SOURCE).alias("_source"),
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("_ingested_at"),
    )


def read_weather(
    spark: SparkSession, paths: str | list[str], ingested_at: Column | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Readings of files that hold a list of them, or one on each line with multi_line=False."""
    raw = spark.read.schema(schemas.WEATHER_FILE).json(paths, multiLine=multi_line)
    return scaled_readings(raw, ingested_at)
