"""Incremental load of departure-board polls as they land."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from linewatch.schemas import BOARD_FILE
from linewatch.sources.boards import departures_of


def board_stream(
    spark: SparkSession, landing: str, station_code: Column | str, service_date: Column | str,
    ingested_at: Column | None = None, max_files_per_trigger: int = 10_000,
    multi_line: bool = True,
) -> DataFrame:
    """Departures of the poll files in a folder, each file read once.

    A file holds one response, or one per line with multi_line=False.
    """
    responses = (
        spark.readStream.schema(BOARD_FILE)
        .options(multiLine=multi_line, maxFilesPerTrigger=max_files_per_trigger)
        .json(landing)
    )
    return departures_of(responses, station_code, service_date, ingested_at)


def append_polls(departures: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append what has landed since the last run to the raw table, then stop.

    Files already loaded are known from the checkpoint, so a restart after a
    failure neither loses nor repeats a poll.
    """
    return (
        departures.writeStream.outputMode("append").format("parquet")
        .option("path", target).option("checkpointLocation", checkpoint)
        .partitionBy("_service_date").trigger(availableNow=True).start()
    )


def file_part(pattern: str, group: int = 1) -> Column:
    """A value taken from the path of the file a row comes from."""
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, group)
