"""Jobs that keep tables up to date as loads arrive, run on the given tables, result read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from linewatch.operators import bitmaps
from linewatch.operators.changes import of_days
from linewatch.plans import impact
from linewatch.plans.bucketed import BucketedTables
from linewatch.plans.day_refresh import DAY_OF, DayRefresh
from linewatch.plans.models import Models
from linewatch.schemas import ARCHIVE_SERVICE_FIELDS
from linewatch.session import scratch_path
from linewatch.sources import archive, backfill, buckets, evolving, quarantine, sinks, stand_in
from linewatch.streaming import latest, rolling

#: The first loads end before these days; later ones bring the rest.
CUT = {"rdt_services": "2026-03-01", "ns_departures": "2026-04-01", "rdt_disruptions": "2020-01-01",
       "ns_disruptions": "2026-04-01", "knmi_weather": "2026-03-15", "ndw_traffic_flow": "2026-04-01"}
LAST_DAY = "2026-12-31"
ORDER_DAY = "2026-04-12"
ORDER_NOW = "2026-04-13 08:00:00"


def _loaded_in_parts(spark: SparkSession, sf_dir: str, root: str) -> DayRefresh:
    """All feeds in two loads with a refresh after each. Of February the first load brings other
    delays, which a reload of the month then replaces; March comes to the archive when
    live polls of it are there already."""
    feeds = Models.on_given_tables(spark, sf_dir).feeds
    run = DayRefresh(spark, root, ORDER_DAY)
    day = {f: F.col(c).cast("date") for f, c in DAY_OF.items()}
    february = F.substring("service_date", 1, 7) == "2026-02"
    for feed in DAY_OF:
        early = feeds[feed].where(day[feed] < CUT[feed])
        if feed == "rdt_services":
            early = early.withColumn("departure_delay", F.when(
                february, F.col("departure_delay") + 9).otherwise(F.col("departure_delay")))
        run.load(feed, early)
    run.refresh()
    for feed in DAY_OF:
        late = feeds[feed].where(day[feed] >= CUT[feed])
        if feed in ("ns_departures", "ns_disruptions"):
            run.load(feed, late, replace=False)
        else:
            run.load(feed, late, days=(CUT[feed], LAST_DAY))
    run.load("rdt_services", feeds["rdt_services"], days=("2026-02-01", "2026-02-28"))
    return run


def refresh_by_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart after two loads and a reload, each refreshed for the days that it touched."""
    run = _loaded_in_parts(spark, sf_dir, scratch_path(spark, "day-refresh"))
    run.refresh()
    return run.table("dm_multimodal_daily")


def road_facts_by_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Road facts, whose free-flow speeds and baselines reach over all days, after two loads of the
    road feed alone."""
    readings = Models.on_given_tables(spark, sf_dir).feeds["ndw_traffic_flow"]
    run = DayRefresh(spark, scratch_path(spark, "road-refresh"), ORDER_DAY)
    early = F.col("service_date").cast("date") < CUT["ndw_traffic_flow"]
    for rows in (readings.where(early), readings.where(~early)):
        run.load("ndw_traffic_flow", rows)
        run.refresh()
    return run.table("fct_road_traffic")


def daily_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole order of a day over loaded feeds: models, history, checks, freshness, alerts."""
    root = scratch_path(spark, "daily-order")
    feeds = Models.on_given_tables(spark, sf_dir).feeds
    run = DayRefresh(spark, root, ORDER_DAY)
    for feed in DAY_OF:
        run.load(feed, feeds[feed])
    result = run.run(now=ORDER_NOW)
    recorded = run.recorded_alerts()
    return result["quality"].select(
        F.lit("check").alias("step"),
        F.concat_ws(" ", "check", "table", "column").alias("item"),
        F.col("failures").cast("double").alias("figure"),
    ).unionByName(result["freshness"].select(
        F.lit("freshness").alias("step"), F.concat_ws(" ", "feed", "status").alias("item"),
        F.col("age_hours").alias("figure"))
    ).unionByName(recorded.select(
        F.lit("alert").alias("step"), F.col("corridor").alias("item"),
        F.col("metric_value").alias("figure"))
    ).unionByName(run.table("snap_dim_stations").where(F.col("valid_to").isNull()).select(
        F.lit("history").alias("step"), F.concat_ws(" ", "station_code", "corridor_id").alias("item"),
        F.lit(1.0).alias("figure")))


def free_flow_by_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free-flow speeds after two loads and a reload of some days; readings are read once a load."""
    readings = Models.on_given_tables(spark, sf_dir).feeds["ndw_traffic_flow"]
    run = DayRefresh(spark, scratch_path(spark, "free-flow-loads"), ORDER_DAY)
    day = F.col("service_date").cast("date")
    wrong = F.col("service_date").between("2026-03-20", "2026-03-22")
    run.load("ndw_traffic_flow", readings.where(day < "2026-04-01").withColumn(
        "avg_speed_kmh", F.when(wrong, F.col("avg_speed_kmh") * 3).otherwise(F.col("avg_speed_kmh"))))
    run.refresh()
    run.load("ndw_traffic_flow", readings.where(day >= "2026-04-01"))
    run.load("ndw_traffic_flow", readings, days=("2026-03-20", "2026-03-22"))
    run.refresh()
    return run.table("free_flow_speed")


#: One stop in so many has a field too many, and one in so many lacks some.
_LONG, _SHORT = 97, 89


def archive_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive stops as gzipped files, some with a field too many or without their last ones: what
    the load accepted by month, what it put into quarantine by reason, and its counts."""
    folder, target, rejected = (scratch_path(spark, x) for x in ("lines", "stops", "rejects"))
    stops = stand_in.rdt_services(spark, sf_dir)
    part = F.substring_index("stop_rdt_id", "-", -1).cast("bigint")
    order = F.substring_index("stop_rdt_id", "-", 1).cast("bigint")
    fields = [F.col(f).cast("string").alias(f) for f in ARCHIVE_SERVICE_FIELDS]
    line = F.to_csv(F.struct(*fields), {"quote": '"', "escape": '"', "quoteAll": "true"})
    few = F.to_csv(F.struct(*fields[:-2]), {"quote": '"', "escape": '"', "quoteAll": "true"})
    odd = F.when(part % _LONG == 0, F.concat(line, F.lit(',"a, b"'))).when(
        part % _SHORT == 0, few).otherwise(line)
    # a file holds the stops of some orders, header first
    lines = stops.select(F.floor(order / 50_000).alias("file"), F.lit(1).alias("at"), odd.alias("value"))
    heads = lines.select("file").distinct().select(
        "file", F.lit(0).alias("at"), F.lit(",".join(ARCHIVE_SERVICE_FIELDS)).alias("value"))
    (
        lines.unionByName(heads).repartition("file").sortWithinPartitions("file", "at")
        .select("file", "value").write.partitionBy("file").option("compression", "gzip")
        .text(folder)
    )
    scanned = archive.read_services(
        spark, folder, "2026", F.lit("2026-04-02 06:00:00").cast("timestamp"), keep_rejected=True)
    counts = quarantine.load(
        scanned.withColumn("load_month", archive.load_month("_year_month", "service_date")),
        "rdt_services", len(ARCHIVE_SERVICE_FIELDS), target, rejected, ["load_month"])
    accepted = spark.read.parquet(target)
    return accepted.groupBy(F.lit("accepted").alias("outcome"),
                            F.substring("service_date", 1, 7).alias("item")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("max_delay").alias("figure")).unionByName(
        spark.read.parquet(rejected).groupBy(
            F.lit("rejected").alias("outcome"), F.col("reason").alias("item")).agg(
            F.count(F.lit(1)).alias("rows"), F.sum("fields").alias("figure"))).unionByName(
        spark.createDataFrame([("load", "accepted and rejected", counts.accepted, counts.rejected)],
                              "outcome string, item string, rows bigint, figure bigint"))


def evolving_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads of polls: as they are; with a new field and a narrow one that is wider now; and
    without the new field. One table, by day."""
    target = scratch_path(spark, "evolving")
    raw = stand_in.ns_departures(spark, sf_dir)
    hour = F.hour("_ingested_at")
    seconds = F.minute("_ingested_at") * 60
    backfill.load_departure_polls(
        raw.where(hour < 8).withColumn("age_seconds", seconds.cast("int")), target)
    backfill.load_departure_polls(
        raw.where((hour >= 8) & (hour < 16)).withColumn("crowding", F.col("trainCategory")).withColumn(
            "age_seconds", seconds.cast("bigint") + 5_000_000_000), target)
    backfill.load_departure_polls(raw.where(hour >= 16), target)
    table = evolving.read_evolving(spark, target)
    return table.groupBy("_service_date").agg(
        F.count(F.lit(1)).alias("polls"), F.count("crowding").alias("with_crowding"),
        F.count("age_seconds").alias("with_age"), F.sum("age_seconds").alias("age_seconds"),
        F.lit(len(table.columns)).cast("bigint").alias("fields"))


def weather_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather loaded for a range, then for one that overlaps it, with later days missing for two
    stations: readings by station, and the gaps that the second load reports."""
    first, second, target = (scratch_path(spark, x) for x in ("w-first", "w-second", "weather"))
    raw = stand_in.weather_readings(spark, sf_dir)
    day = F.substring("date", 1, 10)
    sinks.archive_ndjson(raw.withColumn("TG", F.col("TG") + 100), first, day)
    sinks.archive_ndjson(raw.where(~(F.col("station_code").isin("240", "344") & day.between(
        "2026-03-01", "2026-03-04"))), second, day)
    ingested = F.lit("2026-05-02 07:00:00").cast("timestamp")
    backfill.backfill_weather(spark, first, target, "2026-01-01", "2026-02-20", ingested, False)
    gaps = backfill.backfill_weather(spark, second, target, "2026-02-10", "2026-04-30", ingested, False)
    table = spark.read.parquet(target)
    return table.groupBy(F.lit("readings").alias("item"), "station_code").agg(
        F.min(F.col("service_date").cast("date")).alias("first_day"),
        F.max(F.col("service_date").cast("date")).alias("last_day"),
        F.count(F.lit(1)).alias("n"), F.sum("avg_temp_c").alias("figure")).unionByName(
        gaps.select(F.lit("gap").alias("item"), "station_code", F.col("gap_start").alias("first_day"),
                    F.col("gap_end").alias("last_day"), F.col("days").alias("n"),
                    F.lit(None).cast("double").alias("figure")))


def _written(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed_train_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train facts over tables bucketed by station."""
    tables = BucketedTables(Models.on_given_tables(spark, sf_dir), scratch_path(spark, "buckets"))
    with buckets.co_partitioned(spark):
        return _written(spark, tables.train_facts(), "bucketed-trains")


def bucketed_road_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Road facts over tables bucketed by road point."""
    tables = BucketedTables(Models.on_given_tables(spark, sf_dir), scratch_path(spark, "buckets"))
    with buckets.co_partitioned(spark):
        return _written(spark, tables.road_facts(), "bucketed-roads")


DISTINCT_RANGES = {"january": ("2026-01-01", "2026-01-31"), "around April": ("2026-03-20", "2026-04-05"),
                   "all": ("2011-01-01", "2026-12-31")}


def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different stations, operators, trains and disruptions of three ranges, out of day bitmaps that
    two loads and a reload have filled; no departure is read for a range."""
    models = Models.on_given_tables(spark, sf_dir)
    rows = _written(spark, bitmaps.departure_values(models.int_departures_combined).unionByName(
        bitmaps.disruption_values(models.stg_ns_disruptions, models.stg_rdt_disruptions)
    ).distinct(), "values")
    days = {r[0] for r in rows.select(F.col("service_date").cast("string")).distinct().collect()}
    early = {d for d in days if d is not None and d < "2026-02-01"}
    redone = {d for d in early if d >= "2026-01-10"}
    kept = bitmaps.DistinctDays(spark, scratch_path(spark, "distinct"))
    kept.replace(of_days(rows, "service_date", early).unionByName(
        of_days(rows, "service_date", redone).withColumn("value", F.concat(F.lit("x"), "value"))), early)
    kept.replace(of_days(rows, "service_date", days - early), days - early)
    kept.replace(of_days(rows, "service_date", redone), redone)
    out = None
    for name, (first, last) in DISTINCT_RANGES.items():
        found = kept.between(first, last).select(F.lit(name).alias("range"), "kind", "distinct_count")
        out = found if out is None else out.unionByName(found)
    return out


def _poll_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of the raw polls, landed by day and quarter of it and taken in some batches."""
    landing = scratch_path(spark, "landing")
    departures = stand_in.ns_departures(spark, sf_dir)
    fields = ["direction", "name", "plannedDateTime", "actualDateTime", "trainCategory",
              "cancelled", "departureStatus", "plannedTrack", "actualTrack", "product"]
    (
        departures.select(
            F.to_json(F.struct(*fields, "_station_code", "_service_date", "_source",
                               F.col("_ingested_at").cast("string").alias("_ingested_at"))
                      ).alias("value"),
            F.col("_service_date").alias("day"), F.floor(F.hour("_ingested_at") / 6).alias("quarter"))
        .hint("rebalance", "day", "quarter").write.partitionBy("day", "quarter").text(landing)
    )
    kinds = {f: "string" for f in [*fields, "_station_code", "_service_date", "_source"]}
    schema = ", ".join(f"{f} {t}" for f, t in {**kinds, "cancelled": "boolean",
                                               "_ingested_at": "timestamp"}.items())
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 60).json(landing)


def poll_stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polls taken in by the file stream in several batches, the latest of each departure kept as
    state; then staged."""
    target = scratch_path(spark, "latest")
    found = latest.latest_of_stream(_poll_files(spark, sf_dir), "400 days")
    latest.upsert_latest(found, target, scratch_path(spark, "latest-checkpoint")).awaitTermination()
    return latest.latest_departures(spark, target).select(
        "departure_id", "station_code", "service_date", "train_number", "delay_minutes")


def rolling_delay_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delay per route in sliding quarters of an hour, out of the same stream."""
    target = scratch_path(spark, "windows")
    windows = rolling.rolling_delay(_poll_files(spark, sf_dir), "400 days")
    rolling.upsert_windows(windows, target, scratch_path(spark, "windows-checkpoint")).awaitTermination()
    return spark.read.parquet(target).withColumn("service_date", F.col("service_date").cast("date"))


def cascading_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of three and more stops of a train at which its delay grows."""
    return rolling.cascading_delays(Models.on_given_tables(spark, sf_dir).stg_rdt_services)


def disruption_road_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speeds and vehicles near disrupted stations before, during and after each disruption."""
    m = Models.on_given_tables(spark, sf_dir)
    columns = ["disruption_id", "start_ts", "end_ts", "affected_station_codes"]
    both = m.stg_ns_disruptions.select(*columns).unionByName(m.stg_rdt_disruptions.select(*columns))
    return impact.disruption_road_impact(m.stg_ndw_traffic_flow, both, m.dim_ndw_locations)


JOBS = [
    refresh_by_days, road_facts_by_days, daily_order, free_flow_by_loads, archive_rejects,
    evolving_polls, weather_backfill, bucketed_train_facts, bucketed_road_facts, distinct_values,
    poll_stream_latest, disruption_road_impact, rolling_delay_stream, cascading_delays,
]
