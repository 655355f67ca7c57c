"""Delay per route over sliding windows of time, and cascades of delay, on streams and batches."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from linewatch.functions.columns import stable_round, whole_minutes_between
from linewatch.operators import merge
from linewatch.plans import staging

WIDTH, SLIDE = "15 minutes", "5 minutes"
#: How much later than the newest planned departure a poll may come.
KEEP = "2 days"
_ROUTE = ["station_code", "direction"]
#: Stations of a cascade, at least.
CASCADE = 3
_CASCADE = ("service_rdt_id string, service_date date, train_number string, first_station string, "
            "last_station string, stations bigint, first_delay bigint, last_delay bigint")


# Rolling windows ------------------------------------------------------------------------------

def rolling_delay(polls: DataFrame, keep: str | None = None, width: str = WIDTH,
                  slide: str = SLIDE) -> DataFrame:
    """window_start, service_date, station_code, direction, polls, avg_delay_min, max_delay_min: raw
    polls by the windows their planned departure lies in.

    The same for a batch, and for a stream with `keep`: then a window is state until the watermark
    has passed it, and polls that come later are dropped and counted (latest.late_rows). Every poll
    counts; polls without a planned departure are left out. Sums combine before the shuffle, so a
    busy route is a row for each task and window.
    """
    planned = "planned_departure_ts"
    live = staging.live_departures(polls).where(F.col(planned).isNotNull()).withColumn(
        "delay", whole_minutes_between(planned, "actual_departure_ts"))
    if keep is not None:
        live = live.withWatermark(planned, keep)
    return live.groupBy(F.window(planned, width, slide).alias("w"), *_ROUTE).agg(
        F.count(F.lit(1)).alias("polls"), stable_round(F.avg("delay"), 2).alias("avg_delay_min"),
        F.max("delay").alias("max_delay_min"),
    ).select(F.col("w.start").alias("window_start"),
             F.col("w.start").cast("date").alias("service_date"), *_ROUTE, "polls",
             "avg_delay_min", "max_delay_min")


def upsert_windows(windows: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Keep a table of windows, by day, up to date with what has landed, then stop."""
    def upsert(rows: DataFrame, batch: int) -> None:
        merge.incremental_merge(rows.sparkSession, target, rows, ["window_start", *_ROUTE])

    return (
        windows.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
        .foreachBatch(upsert).trigger(availableNow=True).start()
    )


# Cascades -------------------------------------------------------------------------------------

_ORDER = ["at", "departure_id", "delay", "station_code"]


def _stops(stg_rdt_services: DataFrame) -> DataFrame:
    """The stops of known train runs with their time and delay."""
    return stg_rdt_services.where(
        F.col("service_rdt_id").isNotNull() & F.col("service_date").isNotNull()).select(
        "service_rdt_id", "service_date", "train_number", "station_code", "departure_id",
        F.coalesce("departure_ts", "arrival_ts").alias("at"),
        F.coalesce("departure_delay_min", "arrival_delay_min").alias("delay"),
    ).where(F.col("at").isNotNull())


def cascading_delays(stg_rdt_services: DataFrame, least: int = CASCADE) -> DataFrame:
    """Runs of at least `least` consecutive stops of a train on a day, each with more delay than the
    one before.

    Stops are in the order of their time, then of their id; ids repeat, so delay and station
    follow, NULLs first. A stop whose delay is not known
    ends a run and begins none. Runs are islands: a stop that does not rise begins a new one. A train
    has some dozens of stops a day; a window streams over them and holds none.
    """
    run = ["service_rdt_id", "service_date"]
    order = Window.partitionBy(*run).orderBy(*_ORDER)
    rising = F.coalesce(F.col("delay") > F.lag("delay").over(order), F.lit(False))
    islands = _stops(stg_rdt_services).withColumn("_rises", rising).withColumn(
        "_island", F.sum((~F.col("_rises")).cast("int")).over(
            order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    place = F.struct(*_ORDER)
    return islands.groupBy(*run, "_island").agg(
        F.max("train_number").alias("train_number"),
        F.min_by("station_code", place).alias("first_station"),
        F.max_by("station_code", place).alias("last_station"),
        F.count(F.lit(1)).alias("stations"), F.min_by("delay", place).alias("first_delay"),
        F.max_by("delay", place).alias("last_delay"),
    ).where(F.col("stations") >= least).drop("_island")


def _runs(key: tuple, stops: list[list], least: int) -> list[tuple]:
    """The cascades among the stops (at, id, station, delay, train) of one train."""
    found, island = [], []
    def order(s: list) -> tuple:
        return s[0], s[1] is not None, s[1] or "", s[3] is not None, s[3] or 0, s[2] or ""

    for stop in [*sorted(stops, key=order), None]:
        rises = stop is not None and island and None not in (stop[3], island[-1][3]) \
            and stop[3] > island[-1][3]
        if not rises:
            if len(island) >= least:
                trains = [s[4] for s in island if s[4] is not None]
                found.append((*key, max(trains, default=None), island[0][2], island[-1][2],
                              len(island), island[0][3], island[-1][3]))
            island = []
        island.append(stop)
    return found


def cascades_of_stream(stg_rdt_services: DataFrame, keep_hours: int = 48,
                       least: int = CASCADE) -> DataFrame:
    """cascading_delays on a stream of staged stops. The stops of a train are kept as state, in any
    order of arrival, until the watermark, `keep_hours` behind the newest stop, has passed the day
    after its own; then its runs come. Stops behind the watermark are dropped and counted."""
    def collect(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState
                ) -> Iterator[pd.DataFrame]:
        stops = json.loads(state.get[0]) if state.exists else []
        if state.hasTimedOut:
            state.remove()
            rows = _runs(key, stops, least)
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _CASCADE.split(", ")]).astype(
                {"first_delay": "Int64", "last_delay": "Int64"})
            return
        for frame in frames:
            stops += [[int(r.ms), r.departure_id, r.station_code,
                       None if pd.isna(r.delay) else int(r.delay), r.train_number]
                      for r in frame.itertuples()]
        state.update((json.dumps(stops),))
        over = int(pd.Timestamp(key[1]).timestamp() + 2 * 86_400) * 1000
        state.setTimeoutTimestamp(max(over, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(columns=[c.split()[0] for c in _CASCADE.split(", ")])

    stops = _stops(stg_rdt_services).withWatermark("at", f"{keep_hours} hours").select(
        "*", F.unix_millis("at").alias("ms"))
    return stops.groupBy("service_rdt_id", "service_date").applyInPandasWithState(
        collect, _CASCADE, "stops string", "append", GroupStateTimeout.EventTimeTimeout)
