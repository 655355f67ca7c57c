"""The refresh of what loads have touched: days travel through the models, other days keep their
files."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from linewatch.functions.calendar import date_spine, recent_days
from linewatch.operators.changes import (
    ChangeLog, Days, days_that_differ, of_days, put_days, replace_days, stage_days, stored_days,
    union_of,
)
from linewatch.operators.combine import union_by_priority
from linewatch.operators.rollup import departure_rollup
from linewatch.plans import core, intermediate, staging
from linewatch.plans.refresh import Refresh
from linewatch.session import exists, remove_path, scratch_path
from linewatch.sources import sinks

#: The day of a raw row.
DAY_OF = {
    "rdt_services": "service_date", "ns_departures": "_service_date",
    "rdt_disruptions": "start_time", "ns_disruptions": "_service_date",
    "knmi_weather": "service_date", "ndw_traffic_flow": "service_date",
}
LOAD_DAY = "load_day"
#: Feeds with few rows a day are kept by year.
GRAIN = {"rdt_disruptions": "yyyy"}


class DayRefresh(Refresh):
    """A refresh over raw feeds that it keeps itself, by day, below its root folder.

    `load` puts rows of a feed in place and notes the days; `refresh` rewrites every model for the
    days that follow from them:

    * Departures of a day come from the archive, or else from live polls. Loading either
      touches that day. The one departure without a key, the latest of all polls, moves between
      days; the latest one of every day is kept, so it is found without reading other polls.
    * A free-flow speed is a quantile over all days of a road point. Readings are kept as counts
      by day and by month, the quantile reads the months, and a day is written anew only if one
      of its rows differs: readings loaded once are not read again.
    * The baseline of a road point is a mean over its days; those daily rows are read, and again
      only days with a difference are written.
    * The mart follows the union of the days of its sides.

    A feed that was never loaded is empty. Rows without a day are one more day, and an archived
    departure without one hides all live departures. The result equals a full rebuild over
    all raw rows.
    """

    def __init__(self, spark, root: str, as_of: str, **options):
        super().__init__(spark, {}, root, as_of, **options)
        self.log = ChangeLog(spark, f"{self.root}/_changes")
        self.written: dict[str, Days] = {}
        self._raw_schemas: dict[str, T.StructType] = {}

    def _read(self, path: str, schema: T.StructType | None) -> DataFrame | None:
        """The table at path, None if it was never written. Files need not be opened where this run
        knows the schema."""
        if schema is None:
            return sinks.read_if_present(self.spark, path)
        return self.spark.read.schema(schema).parquet(path) if exists(self.spark, path) else None

    # Loads ------------------------------------------------------------------------------------

    def _raw_path(self, feed: str) -> str:
        return f"{self.root}/raw/{feed}"

    def load(self, feed: str, rows: DataFrame, replace: bool = True,
             days: tuple[str, str] | None = None) -> Days:
        """Rows of a feed, in place of the days they hold or added to them; returns the days.

        days: a range that the rows stand for as a whole. Its days without a row are emptied, and
        rows outside it are left out.
        """
        day = F.col(DAY_OF[feed]).cast("date")
        dated = rows.withColumn(LOAD_DAY, day)
        if days is not None:
            dated = dated.where(F.col(LOAD_DAY).between(*[F.lit(d).cast("date") for d in days]))
        if not replace and feed in GRAIN:
            raise ValueError(f"{feed} is kept by {GRAIN[feed]} and cannot be added to")
        path, grain = self._raw_path(feed), GRAIN.get(feed)
        staged, held = stage_days(dated, path, LOAD_DAY, grain)
        touched = held if days is None else held | {
            r[0] for r in date_spine(self.spark, *days).select(
                F.col("date_day").cast("string")).collect()}
        self.log.note(feed, touched)
        fields = dated.schema
        self._raw_schemas[feed] = fields if grain is None else T.StructType(
            [*fields, T.StructField("period", T.StringType())])
        put_days(self.spark, staged, fields, path, touched, LOAD_DAY, grain, replace)
        return touched

    def raw(self, feed: str, days: Days | None = None) -> DataFrame | None:
        """The raw rows of a feed, of some days; None if it was never loaded."""
        df = self._read(self._raw_path(feed), self._raw_schemas.get(feed))
        if df is None:
            return None
        if days is not None:
            if feed in GRAIN:
                n = len(GRAIN[feed])
                periods = {None if d is None else d[:n] for d in days}
                held = F.col("period").cast("string")
                df = df.where(held.isin([x for x in periods if x is not None]) | (
                    held.isNull() if None in periods else F.lit(False)))
            df = of_days(df, LOAD_DAY, days)
        live = DAY_OF[feed] if feed in ("ns_departures", "ns_disruptions", "ndw_traffic_flow") else None
        df = df.drop(LOAD_DAY, "period")
        return df if live is None else recent_days(df, live, self.recent_as_of)

    def raw_days(self, feed: str) -> Days:
        return stored_days(self.spark, self._raw_path(feed), LOAD_DAY)

    # Tables -----------------------------------------------------------------------------------

    def stored(self, name: str) -> DataFrame | None:
        df = self._read(self.path(name), self._schemas.get(name))
        if df is None or "service_date" not in df.columns:
            return df
        return df.withColumn("service_date", F.col("service_date").cast("date"))

    def table(self, name: str) -> DataFrame:
        df = self.stored(name)
        if df is None:
            return self.spark.createDataFrame([], self._schemas[name])
        schema = self._schemas.get(name)
        return df if schema is None else sinks.with_existing_schema(df, schema)

    def _of(self, name: str, days: Days) -> DataFrame:
        return of_days(self.table(name), "service_date", days)

    def _replace(self, name: str, df: DataFrame, days: Days, cluster: str | None = None) -> None:
        self._schemas[name] = df.schema
        self.written[name] = days
        if days or not exists(self.spark, self.path(name)):
            replace_days(df, self.path(name), days, cluster_by=[cluster] if cluster else None)

    def _replace_differing(self, name: str, df: DataFrame, scope: Days | None,
                           cluster: str | None = None) -> Days:
        """Replace the days of df, out of scope (None: all), whose rows are not those stored."""
        staged = scratch_path(self.spark, name)
        df.write.parquet(staged)
        new = self.spark.read.schema(df.schema).parquet(staged)
        old = self.stored(name)
        if old is not None and scope is not None:
            old = of_days(old, "service_date", scope)
        days = days_that_differ(new, old)
        self._replace(name, of_days(new, "service_date", days), days, cluster)
        remove_path(self.spark, staged)
        return days

    # Models -----------------------------------------------------------------------------------

    def _unkeyed(self, live_days: Days) -> tuple[DataFrame | None, Days]:
        """(the departure without a key or nothing, the days it comes to or goes from)."""
        def survivor() -> DataFrame | None:
            kept = self.stored("unkeyed_departures")
            return None if kept is None else staging.latest_polls(kept, ["departure_id"])

        def rows(df: DataFrame | None) -> list:
            return [] if df is None else df.collect()  # one row

        before = rows(survivor())
        raw = self.raw("ns_departures", live_days)
        if raw is None:
            return None, set()
        live = staging.live_departures(raw).where(F.col("departure_id").isNull())
        self._replace("unkeyed_departures", staging.latest_polls(live, ["service_date"]), live_days)
        found = survivor()
        after = rows(found)
        moved = [] if before == after else [*before, *after]
        return found, {None if r.service_date is None else str(r.service_date) for r in moved}

    def _departures(self, changed: dict[str, Days]) -> Days:
        """Combined departures, their rollup and the station names; returns the days written."""
        archive_days = changed.get("rdt_services", set())
        live_days = changed.get("ns_departures", set())
        unkeyed, moved = self._unkeyed(live_days)
        days = union_of(archive_days, live_days, moved)
        if None in archive_days:
            days = union_of(days, self.raw_days("ns_departures"), self.raw_days("rdt_services"))
        elif archive_days and None in self.raw_days("ns_departures"):
            days = days | {None}

        live = None
        raw_live = self.raw("ns_departures", days)
        if raw_live is not None:
            keyed = staging.live_departures(raw_live).where(F.col("departure_id").isNotNull())
            live = staging.latest_polls(keyed, ["departure_id"])
            if unkeyed is not None:
                live = live.unionByName(of_days(unkeyed, "service_date", days).select(*live.columns))
            live = staging.with_delay(live).select(*intermediate.DEPARTURE_COLUMNS)
        raw_archive = self.raw("rdt_services", days | {None})
        if raw_archive is None and live is None:
            return days
        if raw_archive is None:
            combined = live
        else:
            covering = intermediate.archive_departures(staging.stg_rdt_services(raw_archive))
            archive = of_days(covering, "service_date", days)
            if None in days and live is not None and not intermediate.archive_departures(
                    staging.stg_rdt_services(self.raw("rdt_services"))).isEmpty():
                live = live.where(F.col("service_date").isNotNull())
            combined = archive if live is None else union_by_priority(
                archive, live, "service_date", covering=covering)
        self._replace("int_departures_combined", combined, days, "station_code")
        rollup = departure_rollup(self._of("int_departures_combined", days))
        self._replace("departure_rollup", rollup, days, "operator_name")
        if archive_days:
            stops = staging.stg_rdt_services(self.raw("rdt_services", archive_days))
            names = stops.where(F.col("station_name").isNotNull()).groupBy(
                "service_date", "station_code").agg(F.min("station_name").alias("station_name"))
            self._replace("station_names_daily", names, archive_days)
            self._write("station_names", self.table("station_names_daily").groupBy(
                "station_code").agg(F.min("station_name").alias("station_name")), day=False)
        return days

    def _trains(self, departures: Days, changed: dict[str, Days], stations: DataFrame) -> Days:
        if not self.has("departure_rollup"):
            return set()
        # a disruption of a day without departures changes nothing
        days = union_of(departures, changed.get("ns_disruptions", ()), changed.get("rdt_disruptions", ())
                        ) & union_of(departures, *(stored_days(self.spark, self.path(t), "service_date")
                                                   for t in ("departure_rollup", "int_train_delays_daily")))
        named = [stage(raw) for feed, stage in (
            ("ns_disruptions", staging.stg_ns_disruptions),
            ("rdt_disruptions", staging.stg_rdt_disruptions))
            if (raw := self.raw(feed, days)) is not None]
        none = self.spark.createDataFrame(
            [], "disruption_id string, service_date date, affected_station_codes array<string>")
        named += [none] * (2 - len(named))
        delays = intermediate.int_train_delays_daily(self._of("departure_rollup", days), *named)
        self._replace("int_train_delays_daily", delays, days, "station_code")
        fact = core.fct_train_performance(self._of("int_train_delays_daily", days), stations)
        self._replace("fct_train_performance", fact, days, "station_code")
        return days

    def _roads(self, changed: Days, locations: DataFrame) -> Days:
        raw = self.raw("ndw_traffic_flow", changed)
        if not changed or raw is None:
            return set()
        counts = intermediate.road_counts(staging.stg_ndw_traffic_flow(raw, self.spark))
        self._replace("road_counts", counts, changed, "location_id")
        # whole months out of their days, so a second run gives the same counts
        months = {None if d is None else d[:7] for d in changed}
        of_month = {d for d in stored_days(self.spark, self.path("road_counts"), "service_date")
                    if (None if d is None else d[:7]) in months}
        monthly = self._of("road_counts", of_month).groupBy(
            F.trunc("service_date", "MM").alias("service_date"), "location_id", "avg_speed_kmh"
        ).agg(F.sum("readings").alias("readings"))
        self._replace("road_counts_monthly", monthly,
                      {None if m is None else f"{m}-01" for m in months}, "location_id")
        before = self.stored("free_flow_speed")
        kept = None
        if before is not None:  # read before the table is replaced
            kept = scratch_path(self.spark, "free-flow")
            before.write.parquet(kept)
            before = self.spark.read.schema(before.schema).parquet(kept)
        speeds = self._write("free_flow_speed", intermediate.counted_free_flow_speed(
            self.table("road_counts_monthly")), day=False)
        scope = set(changed)
        if before is None:
            scope |= stored_days(self.spark, self.path("road_counts"), "service_date")
        else:
            moved = speeds.exceptAll(before).select("location_id").unionByName(
                before.exceptAll(speeds).select("location_id")).distinct()
            at = self.table("road_counts").join(moved, "location_id", "left_semi")
            scope |= {r[0] for r in at.select(F.col("service_date").cast("string")).distinct().collect()}
            remove_path(self.spark, kept)
        daily = intermediate.counted_traffic_daily(self._of("road_counts", scope), speeds)
        self._replace_differing("int_ndw_traffic_daily", daily, scope, "location_id")
        fact = core.fct_road_traffic(self.table("int_ndw_traffic_daily"), locations)
        return self._replace_differing("fct_road_traffic", fact, None, "location_id")

    def refresh(self) -> dict[str, Days]:
        """Bring all tables up to date with the loads since the last refresh; returns the days
        written, by table."""
        loads, changed = self.log.pending()
        self.written = {}
        stations = self._write("dim_stations", core.dim_stations(
            self.lookup("station_corridor_mapping")), day=False)
        dates = self._write("dim_date", core.dim_date(
            self.spark, self.lookup("nl_holidays"), *self.dates), day=False)
        locations = self._write("dim_ndw_locations", core.dim_ndw_locations(
            self.lookup("station_ndw_mapping"), self.lookup("station_corridor_mapping")), day=False)
        departures = self._departures(changed)
        trains = self._trains(departures, changed, stations)
        roads = self._roads(changed.get("ndw_traffic_flow", set()), locations)
        days = union_of(trains, roads, changed.get("knmi_weather", ()))
        if self.has("fct_train_performance"):
            weather = self.raw("knmi_weather", days)
            has_roads = self.stored("fct_road_traffic") is not None
            mart = core.dm_multimodal_daily(
                self._of("fct_train_performance", days), dates,
                self._of("fct_road_traffic", days) if has_roads else None,
                None if weather is None else staging.stg_knmi_weather(weather),
                self.lookup("knmi_corridor_mapping"))
            self._replace("dm_multimodal_daily", mart, days, "corridor_id")
        self.log.seen(loads)
        return self.written

    def has(self, name: str) -> bool:
        return name in self._schemas or self.stored(name) is not None

    def staging(self) -> dict[str, DataFrame]:
        """Staging over all raw rows of the feeds that were loaded, for the checks."""
        self.feeds = {f: raw for f in DAY_OF if (raw := self.raw(f)) is not None}
        return {f"stg_{feed}": staging.stg_ndw_traffic_flow(raw, self.spark)
                if feed == "ndw_traffic_flow" else getattr(staging, f"stg_{feed}")(raw)
                for feed, raw in self.feeds.items()}

    def build_models(self, full_refresh: bool = False) -> dict[str, DataFrame]:
        """For run(): the refresh, or all days of all feeds, then the staging frames for checks."""
        if full_refresh:
            for feed in DAY_OF:
                self.log.note(feed, self.raw_days(feed))
        self.refresh()
        return self.staging()
