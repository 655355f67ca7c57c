"""Loads and maintenance jobs run end to end on the given tables, result read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from linewatch.operators import merge, snapshot
from linewatch.plans import alerts, staging
from linewatch.plans.models import FEEDS, Models
from linewatch.plans.refresh import Refresh
from linewatch.session import scratch_path
from linewatch.sources import archive, backfill, boards, lookups, roads, sinks, stand_in
from linewatch.schemas import ARCHIVE_DISRUPTION_FIELDS, ARCHIVE_SERVICE_FIELDS
from linewatch.streaming import polls

def _loaded_at():
    return F.lit("2026-04-02 06:00:00").cast("timestamp")



def _as_csv_text(df: DataFrame, fields: list[str]) -> DataFrame:
    """The text a CSV file holds: nothing for NULL, true and false in lower case."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in fields])


def services_csv_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive stops written as gzipped CSV, read by the archive reader."""
    folder = scratch_path(spark, "services-csv")
    stops = stand_in.rdt_services(spark, sf_dir)
    sinks.archive_csv(_as_csv_text(stops, ARCHIVE_SERVICE_FIELDS), folder, "gzip")
    read = archive.read_services(spark, folder, "2026-03", _loaded_at())
    return read.select(*ARCHIVE_SERVICE_FIELDS, "_source", "_year_month")


def disruptions_csv_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archived disruptions through CSV and the archive reader."""
    folder = scratch_path(spark, "disruptions-csv")
    events = stand_in.rdt_disruptions(spark, sf_dir)
    sinks.archive_csv(_as_csv_text(events, ARCHIVE_DISRUPTION_FIELDS), folder)
    read = archive.read_disruptions(spark, folder, "2026", _loaded_at())
    return staging.stg_rdt_disruptions(read).drop("data_source")


def weather_ndjson_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather landed as NDJSON in day folders, small files, read back and staged."""
    folder = scratch_path(spark, "weather-ndjson")
    sinks.archive_ndjson(
        stand_in.knmi_weather(spark, sf_dir).drop("_ingested_at"), folder, "service_date")
    return staging.stg_knmi_weather(spark.read.json(folder).drop("dt"))


def partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Road readings loaded by day, then the days from April loaded again with other counts."""
    target = scratch_path(spark, "traffic")
    readings = stand_in.ndw_traffic_flow(spark, sf_dir)
    sinks.overwrite_partitions(readings, target, ["service_date"], ["location_id"])
    later = readings.where(F.col("service_date") >= "2026-04-01").withColumn(
        "vehicle_count", F.col("vehicle_count") + 1000)
    for _ in range(2):
        sinks.overwrite_partitions(later, target, ["service_date"], ["location_id"])
    day = F.col("service_date").cast("date").alias("service_date")
    return spark.read.parquet(target).groupBy(day).agg(
        F.count(F.lit(1)).alias("readings"), F.sum("vehicle_count").alias("vehicles"))


def poll_appends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Departures of the day's polls appended one poll after the other, then deduplicated."""
    target = scratch_path(spark, "polls")
    departures = stand_in.ns_departures(spark, sf_dir)
    is_morning = F.hour("_ingested_at") < 12
    for poll in (is_morning, ~is_morning):
        backfill.load_departure_polls(departures.where(poll), target)
    return _staged_departures(spark.read.parquet(target))


def _staged_departures(raw: DataFrame) -> DataFrame:
    return staging.stg_ns_departures(raw).select(
        "departure_id", "station_code", "service_date", "train_number", "delay_minutes")


def poll_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Board responses landed as files and taken in by the file stream, then deduplicated."""
    landing, target = scratch_path(spark, "landing"), scratch_path(spark, "stream")
    departures = stand_in.ns_departures(spark, sf_dir)
    fields = ["direction", "name", "plannedDateTime", "actualDateTime", "trainCategory",
              "cancelled", "departureStatus", "plannedTrack", "actualTrack", "product"]
    response = F.to_json(F.struct(F.struct(F.array(F.struct(*fields)).alias("departures"))
                                  .alias("payload"))).alias("value")
    (
        departures.select(response, F.col("_station_code").alias("station"),
                          F.date_format("_ingested_at", "HH").alias("poll"))
        .hint("rebalance", "station", "poll")
        .write.partitionBy("station", "poll").text(landing)
    )
    stream = polls.board_stream(
        spark, landing, polls.file_part(r"station=([^/]+)/"),
        F.substring(F.get("payload.departures", F.lit(0))["plannedDateTime"], 1, 10),
        polls.file_part(r"poll=(\d+)/").cast("int").cast("timestamp"), multi_line=False)
    polls.append_polls(stream, target, scratch_path(spark, "stream-checkpoint")).awaitTermination()
    return spark.read.parquet(target).groupBy("_service_date", "_station_code").agg(
        F.count(F.lit(1)).alias("polled"),
        F.count_if(F.col("cancelled")).alias("cancelled"),
        F.countDistinct("direction").alias("directions"))


def incremental_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train facts, then an upsert of the last three days before April with other counts."""
    path = scratch_path(spark, "fct-train")
    models = Models.on_given_tables(spark, sf_dir)
    sinks.write_table(models.fct_train_performance, path, ["service_date"], ["station_code"])
    facts = spark.read.parquet(path)
    delta = facts.where(F.col("service_date").between("2026-03-29", "2026-03-31")).where(
        F.col("station_code") != "UT").withColumn(
        "total_departures", F.col("total_departures") + 1)
    staged = scratch_path(spark, "delta")
    delta.write.parquet(staged)
    for _ in range(2):
        merge.incremental_merge(
            spark, path, spark.read.parquet(staged),
            ["station_code", "corridor_id", "service_date"], cluster_by=["station_code"])
    return spark.read.parquet(path).select(
        "station_code", "corridor_id", "service_date", "total_departures", "pct_on_time")


def snapshot_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers snapshot on three days: segments change on the second, nothing on the third."""
    path = scratch_path(spark, "snapshot")
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        "c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    moved = customers.withColumn(
        "c_mktsegment", F.when(F.col("c_acctbal") < 1000, F.lit(None)).otherwise(
            F.col("c_mktsegment")))
    first = customers.where(F.col("c_nationkey") != 7)
    checked = ["c_mktsegment"]
    for day, rows in (("2026-01-01", first), ("2026-02-01", moved), ("2026-03-01", moved),
                      ("2026-03-01", moved)):
        snapshot.update_snapshot(spark, path, rows, ["c_custkey"], checked, day)
    return spark.read.parquet(path).select(
        "c_custkey", "c_nationkey", "c_mktsegment", "valid_from", "valid_to")


def alert_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of every day recorded twice; the second time adds nothing."""
    path = scratch_path(spark, "alert-history")
    mart_path = scratch_path(spark, "mart")
    models = Models.on_given_tables(spark, sf_dir)
    sinks.write_table(models.dm_multimodal_daily, mart_path, ["service_date"], ["corridor_id"])
    fired = alerts.reliability_alerts_all_days(spark.read.parquet(mart_path), 40.0, 0.5)
    for _ in range(2):
        alerts.append_alert_history(
            spark, path, alerts.alert_records(fired, F.col("service_date"), 40.0))
    return spark.read.parquet(path).select(
        "alert_id", "service_date", "alert_type", "corridor", "metric_value", "recent_mean",
        "threshold", "fired")


def services_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two months, then their year, then February again with fewer stops. Periods come from names.

    Each period is a folder of gzipped files named after it.
    """
    source, target = scratch_path(spark, "periods"), scratch_path(spark, "services")
    stops = stand_in.rdt_services(spark, sf_dir)

    def land(period: str, rows: DataFrame) -> None:
        sinks.archive_csv(_as_csv_text(rows, ARCHIVE_SERVICE_FIELDS),
                          f"{source}/services-{period}.csv.gz", "gzip")

    for month in ("2026-01", "2026-02"):
        land(month, stops.where(F.substring("service_date", 1, 7) == month))
    backfill.backfill_services(spark, source, "2026-01, 2026-02, unknown", target, _loaded_at())
    land("2026", stops)
    backfill.backfill_services(spark, source, "2026-02,2026", target, _loaded_at())
    land("2026-02", stops.where(
        (F.substring("service_date", 1, 7) == "2026-02") & ~F.col("platform_change")))
    backfill.backfill_services(spark, source, "2026-02", target, _loaded_at())
    return spark.read.parquet(target).groupBy(
        F.substring("service_date", 1, 7).alias("month"), F.col("_year_month").alias("period")).agg(
        F.count(F.lit(1)).alias("stops"), F.sum("max_delay").alias("delay"),
        F.countDistinct("station_code").alias("stations"))


def disruption_feed_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Disruption polls as response files, even ones a bare list, odd ones with a payload.

    A file holds the disruptions of 4,000 consecutive order keys, so its size has a bound.
    """
    landing = scratch_path(spark, "feed")
    polled = stand_in.ns_disruptions(spark, sf_dir)
    fields = ["id", "type", "title", "isActive", "local", "start", "end", "registrationTime"]
    nested = [F.try_parse_json(c).alias(c) for c in ("impact", "publicationSections", "timespans")]
    responses = polled.select(
        F.floor(F.substring("id", 2, 20).cast("bigint") / 4000).alias("file"),
        F.struct(*fields, *nested).alias("item"), "isActive",
    ).groupBy("file", "isActive").agg(F.collect_list("item").alias("payload"))
    text = F.when(F.col("file") % 2 == 0, F.to_json("payload")).otherwise(
        F.to_json(F.struct("payload")))
    responses.select(text.alias("value"), "file", F.col("isActive").alias("first")).write.partitionBy(
        "file", "first").text(landing)
    read = boards.read_disruption_feed(
        spark, landing, F.substring("d.start", 1, 10),
        F.to_timestamp(F.concat(F.substring("d.start", 1, 10),
                                F.when(F.col("d.isActive"), " 05:00:00").otherwise(" 10:00:00"))))
    return staging.stg_ns_disruptions(read)


def road_csv_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Road readings of two exports with other headers and column orders, read in one call."""
    old, new = scratch_path(spark, "roads-old"), scratch_path(spark, "roads-new")
    readings = stand_in.ndw_readings(spark, sf_dir)
    early = F.col("service_date") < "2026-04-01"
    sinks.archive_csv(readings.where(early).select(
        F.col("vehicle_count").alias("vehicleCount"), F.col("location_id").alias("measurementSiteId"),
        F.col("avg_speed_kmh").alias("averageSpeed"), F.col("measurement_ts").alias("timestamp")), old)
    sinks.archive_csv(readings.where(~early).select(
        "location_id", "measurement_ts", "avg_speed_kmh", "vehicle_count"), new)
    read = roads.read_traffic_csv(spark, [old, new], F.substring("measurement_ts", 1, 10))
    mapped = roads.keep_mapped(read, lookups.lookup(spark, "station_ndw_mapping"))
    return staging.stg_ndw_traffic_flow(mapped, spark)


def csv_table_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV load that sets the schema, then one of other column order with a new field and
    without speeds: the table keeps its columns and types, the speeds of those days are NULL."""
    first, second = scratch_path(spark, "csv"), scratch_path(spark, "csv-later")
    target = scratch_path(spark, "csv-table")
    readings = stand_in.ndw_readings(spark, sf_dir)
    sinks.archive_csv(readings, first)
    sinks.load_csv(spark, first, target)
    sinks.archive_csv(readings.where(F.col("service_date") >= "2026-04-01").select(
        F.lit("b").alias("lane"), "vehicle_count", "service_date", "measurement_ts", "location_id"),
        second)
    for _ in range(2):
        sinks.load_csv(spark, second, target)
    table = spark.read.parquet(target)
    return table.groupBy("service_date").agg(
        F.count(F.lit(1)).alias("readings"), F.count("avg_speed_kmh").alias("speeds"),
        F.sum("vehicle_count").cast("bigint").alias("vehicles"),
        F.lit(len(table.columns)).cast("bigint").alias("fields"))


def daily_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The refresh of all history, then the incremental one of the next day; the mart after it."""
    feeds = Models.on_given_tables(spark, sf_dir).feeds
    root = scratch_path(spark, "refresh")
    Refresh(spark, {f: feeds[f] for f in FEEDS}, root, "2026-04-12").build_models(full_refresh=True)
    run = Refresh(spark, {f: feeds[f] for f in FEEDS}, root, "2026-04-13")
    run.build_models()
    return run.table("dm_multimodal_daily")


JOBS = [
    services_backfill, disruption_feed_reload, road_csv_load, csv_table_load, daily_refresh,
    services_csv_reload, disruptions_csv_reload, weather_ndjson_archive, partition_overwrite,
    poll_appends, poll_stream, incremental_upsert, snapshot_history, alert_history,
]
