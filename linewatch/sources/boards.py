"""Readers of the live JSON feeds: departure boards and disruptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from linewatch import schemas

BOARD_SOURCE = "ns_api_v2"
FEED_SOURCE = "ns_api_v3"


def _literal(value: Column | str) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _stamp(ingested_at: Column | None) -> Column:
    return (F.current_timestamp() if ingested_at is None else ingested_at).alias("_ingested_at")


def departures_of(
    responses: DataFrame, station_code: Column | str, service_date: Column | str,
    ingested_at: Column | None = None,
) -> DataFrame:
    """One row per departure of the board responses (column payload), batch or stream."""
    return (
        responses.select(
            _literal(station_code).alias("_station_code"),
            _literal(service_date).cast("string").alias("_service_date"),
            _stamp(ingested_at),
            F.explode("payload.departures").alias("d"),
        )
        .select("d.*", "_station_code", "_service_date",
                F.lit(BOARD_SOURCE).alias("_source"), "_ingested_at")
    )


def read_departures(
    spark: SparkSession, paths: str | list[str], station_code: Column | str,
    service_date: Column | str, ingested_at: Column | None = None,
    schema: T.StructType = schemas.BOARD_FILE, multi_line: bool = True,
) -> DataFrame:
    """Departure-board polls. Station and day are values or columns of the directory layout.

    A file holds one response, or one per line with multi_line=False. Nested
    values arrive as JSON text. Pass a wider schema to take in new fields.
    """
    responses = spark.read.schema(schema).json(paths, multiLine=multi_line)
    return departures_of(responses, station_code, service_date, ingested_at)


def read_disruption_feed(
    spark: SparkSession, paths: str | list[str], service_date: Column | str,
    ingested_at: Column | None = None, schema: T.StructType = schemas.FEED_DISRUPTION,
) -> DataFrame:
    """Disruption polls, one response per file: a bare list or an object with a payload list."""
    response = F.col("value")
    items = F.when(F.ltrim(response).startswith("["), response).otherwise(
        F.get_json_object(response, "$.payload")
    )
    return (
        spark.read.text(paths, wholetext=True)
        .select(F.explode(F.from_json(items, T.ArrayType(schema))).alias("d"))
        .select("d.*", _literal(service_date).cast("string").alias("_service_date"),
                F.lit(FEED_SOURCE).alias("_source"), _stamp(ingested_at))
    )
