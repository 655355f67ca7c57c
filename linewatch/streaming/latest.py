"""The latest poll of each departure, kept as state while polls land."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from linewatch.operators import merge
from linewatch.plans import staging
from linewatch.sources import sinks

#: A departure's state goes when polls of a day so much later have landed.
KEEP = "3 days"
_KEY = ["service_date", "departure_id"]


def latest_of_stream(polls: DataFrame, keep: str = KEEP) -> DataFrame:
    """The latest poll so far of each departure of a stream of raw polls, a row whenever polls of it
    land.

    State is one row a departure and day. It expires with the watermark, which follows the service
    day: polls may come in any order and up to `keep` after the newest day seen; later ones are
    dropped and counted (late_rows). Rows without a day are left out. The order of polls is the one
    of the batch staging, NULLs last.
    """
    live = staging.live_departures(polls).where(F.col("service_date").isNotNull())
    order = [*[c for c in staging.LATEST_POLL if c != "service_date"], "is_cancelled"]
    return (
        live.withColumn("_day", F.col("service_date").cast("timestamp")).withWatermark("_day", keep)
        .groupBy("_day", "departure_id")
        .agg(F.max(F.struct(*order)).alias("x"))
        .select("departure_id", F.col("_day").cast("date").alias("service_date"), "x.*")
    )


def upsert_latest(
    latest: DataFrame, target: str, checkpoint: str, available_now: bool = True,
) -> StreamingQuery:
    """Keep the table at target up to date with a stream of latest polls.

    Every batch replaces the departures it has rows for, in the days that these lie in. A batch that
    runs again after a failure gives the same table.
    """
    def upsert(rows: DataFrame, batch: int) -> None:
        merge.incremental_merge(rows.sparkSession, target, rows, _KEY, cluster_by=["station_code"])

    writer = latest.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(upsert)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def latest_departures(spark: SparkSession, target: str) -> DataFrame:
    """The staged departures out of the table: departures without a key are one row of all days."""
    kept = sinks.read_if_present(spark, target)
    if kept is None:
        raise ValueError(f"{target} holds no table")
    kept = kept.withColumn("service_date", F.col("service_date").cast("date"))
    keyed = F.col("departure_id").isNotNull()
    return staging.with_delay(kept.where(keyed).unionByName(
        staging.latest_polls(kept.where(~keyed), ["departure_id"])))


def late_rows(query: StreamingQuery) -> int:
    """Departures that came after their state had gone, by the progress of a query."""
    return sum(operator.get("numRowsDroppedByWatermark", 0)
               for progress in query.recentProgress for operator in progress["stateOperators"])
