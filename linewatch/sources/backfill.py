"""Historical loads. All periods of a request are read and written by one Spark job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from linewatch.sources import archive, evolving, sinks
from linewatch.sources.weather import read_weather


def previous_month(as_of: str) -> str:
    """The month before the given day, as a period token."""
    year, month = int(as_of[:4]), int(as_of[5:7])
    return f"{year - (month == 1)}-{(month - 2) % 12 + 1:02d}"


def service_files(folder: str, tokens: list[str]) -> list[str]:
    return [f"{folder.rstrip('/')}/services-{t}.csv.gz" for t in tokens]


def disruption_files(folder: str, years: list[str]) -> list[str]:
    return [f"{folder.rstrip('/')}/disruptions-{y}.csv" for y in years]


def backfill_services(
    spark: SparkSession, folder: str, periods: str, target: str, ingested_at: Column | None = None,
) -> list[str]:
    """Load the months or years named in a comma-separated list and return those used.

    A reload, or a month after its year, replaces the months concerned instead
    of adding the same stops again.
    """
    tokens = archive.without_covered_months(archive.period_tokens(periods))
    if tokens:
        stops = archive.read_services(spark, service_files(folder, tokens), ingested_at=ingested_at)
        stops = stops.withColumn("load_month", archive.load_month("_year_month", "service_date"))
        sinks.overwrite_periods(stops, target, ["load_month"])
    return tokens


def backfill_disruptions(
    spark: SparkSession, folder: str, years: str, target: str, ingested_at: Column | None = None,
) -> list[str]:
    """Load the years named in a comma-separated list, each replaced as a whole."""
    tokens = list(dict.fromkeys(archive.year_tokens(years)))
    if tokens:
        events = archive.read_disruptions(
            spark, disruption_files(folder, tokens), ingested_at=ingested_at)
        sinks.overwrite_periods(events, target, ["_year"])
    return tokens


def backfill_weather(
    spark: SparkSession, paths: str | list[str], target: str, first: str, last: str,
    ingested_at: Column | None = None, multi_line: bool = True,
) -> DataFrame:
    """Load the days of a range, each day replaced as a whole, and return the gaps.

    A day of the range that the files have no reading for keeps what it has: the feed publishes
    late, so nothing new is no reason to forget. See weather_gaps for the rows returned.
    """
    readings = read_weather(spark, paths, ingested_at, multi_line)
    sinks.overwrite_partitions(
        readings.where(F.col("service_date").between(first, last)), target, ["service_date"])
    spark.catalog.refreshByPath(target)
    return weather_gaps(spark.read.parquet(target), first, last)


def weather_gaps(readings: DataFrame, first: str, last: str) -> DataFrame:
    """station_code, gap_start, gap_end, days: runs of days of the range without a reading, for
    each station that has any. Stations times days rows meet, readings are reduced to those first."""
    day = F.col("service_date").cast("date")
    present = readings.where(day.between(first, last)).select(
        F.col("station_code").cast("string").alias("station_code"), day.alias("date_day")).distinct()
    stations = readings.select(F.col("station_code").cast("string").alias("station_code")).where(
        F.col("station_code").isNotNull()).distinct()
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    missing = stations.select("station_code", F.explode(days).alias("date_day")).join(
        present, ["station_code", "date_day"], "left_anti")
    # days of one run have the same distance to their number
    number = F.row_number().over(Window.partitionBy("station_code").orderBy("date_day"))
    return missing.withColumn("_run", F.date_sub("date_day", number)).groupBy(
        "station_code", "_run").agg(
        F.min("date_day").alias("gap_start"), F.max("date_day").alias("gap_end"),
        F.count(F.lit(1)).alias("days")).drop("_run")


def load_departure_polls(polls: DataFrame, target: str) -> None:
    """Add the departures of a poll; earlier polls of the day stay and are deduplicated later. A
    poll may have fields that earlier ones had not; evolving.read_evolving reads them all."""
    evolving.append_evolving(polls, target, ["_service_date"])
