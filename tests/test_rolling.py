"""Sliding windows and cascades: batch against hand-made cases, stream against batch."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from linewatch import session
from linewatch.plans import staging
from linewatch.sources import stand_in
from linewatch.streaming import latest, rolling
from tests.conftest import SMALL
from tests.test_changes import POLL, poll

at = dt.datetime.fromisoformat


def content(df):
    return sorted(map(str, df.collect()))


def test_windows_of_a_batch(spark, rows):
    polls = [poll("2026-03-01", "2026-03-01T08:00:00", actual=f"2026-03-01T10:0{m}:00+0100")
             for m in (2, 5)] + [poll("2026-03-01", "2026-03-01T08:00:00", actual=None),
                                 poll("2026-03-01", "2026-03-01T08:00:00", cancelled=True)]
    odd = list(poll("2026-03-01", "2026-03-01T08:00:00"))
    odd[2] = None  # no planned departure
    got = rows(rolling.rolling_delay(spark.createDataFrame([*polls, tuple(odd)], POLL)).drop("service_date"))
    start = at("2026-03-01T08:50:00")
    assert got == [(start + dt.timedelta(minutes=m), "UT", "Utrecht", 3, 3.5, 5) for m in (0, 5, 10)]


def test_windows_of_a_stream_equal_those_of_a_batch(spark, tmp_path):
    raw = stand_in.ns_departures(spark, SMALL).limit(300)
    fields = [f.name for f in raw.schema if f.name != "routeStations"]
    landing, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    late = 0
    for part in range(3):
        raw.select(*fields).where(F.pmod(F.xxhash64("name", "_ingested_at"), F.lit(3)) == part).coalesce(
            1).write.mode("append").json(landing)
        stream = spark.readStream.schema(raw.select(*fields).schema).json(landing)
        query = rolling.upsert_windows(rolling.rolling_delay(stream, "400 days"), target, check)
        query.awaitTermination()
        late += latest.late_rows(query)
    want = rolling.rolling_delay(spark.read.schema(raw.select(*fields).schema).json(landing))
    got = spark.read.parquet(target).withColumn("service_date", F.col("service_date").cast("date"))
    assert late == 0 and content(got.select(*want.columns)) == content(want)


STOPS = ("service_rdt_id string, service_date date, train_number string, station_code string, "
         "departure_id string, departure_ts timestamp, arrival_ts timestamp, "
         "departure_delay_min bigint, arrival_delay_min bigint")


def stops_of(train, delays, day="2026-03-01"):
    return [(train, dt.date.fromisoformat(day), "7", f"S{i}", f"{train}-{i}",
             at(f"{day}T10:{10 + i}:00") if i < len(delays) - 1 else None,
             at(f"{day}T10:{10 + i}:00"), d, None) for i, d in enumerate(delays)]


def test_cascades_of_a_batch(spark, rows):
    data = [*stops_of("a", [0, 1, 5, 5, 6, 7, 9]), *stops_of("b", [3, 2, 1]), *stops_of("c", [1, 2]),
            *stops_of("d", [1, 2, None, 3, 4]), *stops_of("e", [-2, -1, 0]),
            (None, dt.date(2026, 3, 1), "7", "S", "x", at("2026-03-01T10:00:00"), None, 1, 1)]
    got = rows(rolling.cascading_delays(spark.createDataFrame(data, STOPS)).drop("service_date"))
    assert got == [("a", "7", "S0", "S2", 3, 0, 5), ("a", "7", "S3", "S6", 4, 5, 9),
                   ("e", "7", "S0", "S2", 3, -2, 0)]
    assert rolling.cascading_delays(spark.createDataFrame([], STOPS)).count() == 0


def test_cascades_of_a_stream_equal_those_of_a_batch(spark, tmp_path):
    staged = staging.stg_rdt_services(stand_in.rdt_services(spark, SMALL)).where(
        "service_date < '2026-01-08'").select(*[c.split()[0] for c in STOPS.split(", ")])
    landing, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    parts = F.pmod(F.xxhash64("departure_id"), F.lit(2))
    flush = spark.createDataFrame(stops_of("flush", [1], "2030-01-01"), STOPS)
    for rows in (staged.where(parts == 0), staged.where(parts == 1), flush):
        rows.coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(staged.schema).parquet(landing)
        rolling.cascades_of_stream(stream, 24 * 30).writeStream.outputMode("append").format("parquet").option(
            "path", target).option("checkpointLocation", check).trigger(availableNow=True).start(
        ).awaitTermination()
    want = rolling.cascading_delays(staged)
    got = spark.read.schema(want.schema).parquet(target)
    assert content(got.select(*want.columns)) == content(want) and want.count() > 5


def test_scratch_goes_with_its_scope(spark):
    with session.scratch_scope(spark):
        path = session.scratch_path(spark, "scoped")
        spark.range(3).write.parquet(path)
        with session.scratch_scope(spark):
            inner = session.scratch_path(spark, "inner")
            spark.range(3).write.parquet(inner)
        assert not os.path.exists(inner.removeprefix("file:")) and os.path.exists(path.removeprefix("file:"))
    assert not os.path.exists(path.removeprefix("file:"))
