"""Reader of 15-minute road readings and the filter to the mapped locations."""

from __future__ import annotations

from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from linewatch.functions.columns import restore_empty
from linewatch.schemas import TRAFFIC_FLOW

# Output column -> accepted header names, first match wins.
HEADER_NAMES = {
    "location_id": ["measurementSiteId", "location_id"],
    "measurement_ts": ["timestamp", "measurement_ts"],
    "avg_speed_kmh": ["averageSpeed", "avg_speed_kmh"],
    "vehicle_count": ["vehicleCount", "vehicle_count"],
}


def read_traffic_csv(
    spark: SparkSession, paths: str | list[str], service_date: Column | str,
) -> DataFrame:
    """Road readings. A column whose header is absent gets '' or 0.

    Each given path, a file or a folder, has a header of its own; paths of equal headers are one
    scan. Files inside a folder must share their header: another one ends the job with an error.
    """
    options = {"header": True, "quote": '"', "escape": '"', "enforceSchema": False}
    by_header: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for path in [paths] if isinstance(paths, str) else paths:
        by_header[tuple(spark.read.csv(path, **options).columns)].append(path)
    return reduce(DataFrame.unionByName, [
        _readings(spark.read.csv(same, **options), service_date) for same in by_header.values()])


def _readings(raw: DataFrame, service_date: Column | str) -> DataFrame:
    def pick(name: str, default: str | int) -> Column:
        header = next((h for h in HEADER_NAMES[name] if h in raw.columns), None)
        return F.lit(default) if header is None else F.col(f"`{header}`")

    day = service_date if isinstance(service_date, Column) else F.lit(service_date)
    return raw.select(
        restore_empty(pick("location_id", "")).alias("location_id"),
        restore_empty(pick("measurement_ts", "")).alias("measurement_ts"),
        day.alias("service_date"),
        pick("avg_speed_kmh", 0).cast("double").alias("avg_speed_kmh"),
        pick("vehicle_count", 0).cast("bigint").alias("vehicle_count"),
    )


def keep_mapped(traffic: DataFrame, station_ndw_mapping: DataFrame) -> DataFrame:
    """Readings of locations that the mapping names."""
    wanted = station_ndw_mapping.select(F.col("ndw_location_id").alias("location_id")).distinct()
    return traffic.join(wanted, "location_id", "left_semi")


def empty_traffic(spark: SparkSession) -> DataFrame:
    """What staging yields while the road feed has never been loaded."""
    return spark.createDataFrame([], TRAFFIC_FLOW)
