"""The daily refresh: models, history, checks, freshness and alerts, in that order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from linewatch.functions.calendar import recent_days
from linewatch.operators import merge, quality, snapshot
from linewatch.operators.rollup import departure_rollup
from linewatch.plans import alerts, core, intermediate, staging, system
from linewatch.session import exists
from linewatch.sources import lookups, sinks

FACT_KEY = ["station_code", "corridor_id", "service_date"]


class Refresh:
    """Builds the tables below a root folder from the raw feeds.

    feeds maps rdt_services, ns_departures, rdt_disruptions, ns_disruptions,
    knmi_weather and ndw_traffic_flow to DataFrames. rdt_services, knmi_weather
    and ndw_traffic_flow may be absent. recent_only limits the live feeds to the
    last 30 days, for development. dates are the first and last day of dim_date. Staging stays lazy; every model from
    the combined departures on is written once and read back, so later models
    and reports scan columnar files of known size instead of repeating the
    work, and lost executors cost no more than the running stage.
    """

    def __init__(
        self, spark: SparkSession, feeds: dict[str, DataFrame | None], root: str, as_of: str,
        lookup_folder: str | None = None, recent_only: bool = False,
        dates: tuple[str, str] = (core.DIM_DATE_FIRST, core.DIM_DATE_LAST),
    ):
        self.spark, self.feeds, self.root, self.as_of = spark, feeds, root.rstrip("/"), as_of
        self.lookup_folder, self.dates = lookup_folder, dates
        self.recent_as_of = as_of if recent_only else None
        self._schemas: dict[str, StructType] = {}

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def table(self, name: str) -> DataFrame:
        """A written table. The schema is known for those of this run, also without any row."""
        reader = self.spark.read
        if name in self._schemas:
            reader = reader.schema(self._schemas[name])
        return reader.parquet(self.path(name))

    def has(self, name: str) -> bool:
        return name in self._schemas

    def alert_path(self) -> str:
        return self.path("alert_history")

    def lookup(self, name: str) -> DataFrame:
        return lookups.lookup(self.spark, name, self.lookup_folder)

    def staging(self) -> dict[str, DataFrame]:
        feeds = self.feeds

        def recent(feed: str, day: str) -> DataFrame | None:
            df = feeds.get(feed)
            return None if df is None else recent_days(df, day, self.recent_as_of)

        staged = {
            "stg_ns_departures": staging.stg_ns_departures(
                recent("ns_departures", "_service_date")),
            "stg_ns_disruptions": staging.stg_ns_disruptions(
                recent("ns_disruptions", "_service_date")),
            "stg_rdt_disruptions": staging.stg_rdt_disruptions(feeds["rdt_disruptions"]),
            "stg_ndw_traffic_flow": staging.stg_ndw_traffic_flow(
                recent("ndw_traffic_flow", "service_date"), self.spark),
        }
        if feeds.get("rdt_services") is not None:
            staged["stg_rdt_services"] = staging.stg_rdt_services(feeds["rdt_services"])
        if feeds.get("knmi_weather") is not None:
            staged["stg_knmi_weather"] = staging.stg_knmi_weather(feeds["knmi_weather"])
        return staged

    def create_views(self) -> None:
        """Temporary views of the tables of this run, for queries written in SQL."""
        for name in self._schemas:
            self.table(name).createOrReplaceTempView(name)

    def _write(self, name: str, df: DataFrame, day: bool = True, cluster: str | None = None):
        self._schemas[name] = df.schema
        sinks.write_table(df, self.path(name), ["service_date"] if day else None,
                          [cluster] if cluster else None)
        return self.table(name)

    def build_models(self, full_refresh: bool = False) -> dict[str, DataFrame]:
        """Write intermediate and core tables; the train fact is upserted unless refreshed fully."""
        st = self.staging()
        stations = self._write("dim_stations", core.dim_stations(
            self.lookup("station_corridor_mapping")), day=False)
        dates = self._write("dim_date", core.dim_date(
            self.spark, self.lookup("nl_holidays"), *self.dates), day=False)
        locations = self._write("dim_ndw_locations", core.dim_ndw_locations(
            self.lookup("station_ndw_mapping"), self.lookup("station_corridor_mapping")), day=False)

        departures = self._write("int_departures_combined", intermediate.int_departures_combined(
            st["stg_ns_departures"], st.get("stg_rdt_services")), cluster="station_code")
        rollup = self._write("departure_rollup", departure_rollup(departures),
                             cluster="operator_name")
        if "stg_rdt_services" in st:
            self._write("station_names", system.station_names(
                st["stg_rdt_services"], keep_empty=True), day=False)
        delays = self._write("int_train_delays_daily", intermediate.int_train_delays_daily(
            rollup, st["stg_ns_disruptions"], st["stg_rdt_disruptions"], days=rollup),
            cluster="station_code")
        free_flow = self._write("free_flow_speed", intermediate.free_flow_speed(
            st["stg_ndw_traffic_flow"]), day=False)
        roads = self._write("int_ndw_traffic_daily", intermediate.int_ndw_traffic_daily(
            st["stg_ndw_traffic_flow"], free_flow), cluster="location_id")

        fact = core.fct_train_performance(
            delays, stations, as_of=None if full_refresh else self.as_of)
        fact_path = self.path("fct_train_performance")
        if full_refresh or sinks.read_if_present(self.spark, fact_path) is None:
            self._write("fct_train_performance", core.fct_train_performance(delays, stations),
                        cluster="station_code")
        else:
            self._schemas["fct_train_performance"] = fact.schema
            merge.incremental_merge(
                self.spark, fact_path, fact, FACT_KEY, cluster_by=["station_code"])
        road_fact = self._write("fct_road_traffic", core.fct_road_traffic(roads, locations),
                                cluster="location_id")
        self._write("dm_multimodal_daily", core.dm_multimodal_daily(
            self.table("fct_train_performance"), dates, road_fact,
            st.get("stg_knmi_weather"), self.lookup("knmi_corridor_mapping")),
            cluster="corridor_id")
        return st

    def update_history(self) -> None:
        stations = self.table("dim_stations")
        snapshot.update_snapshot(
            self.spark, self.path("snap_dim_stations"), stations, ["station_code", "corridor_id"],
            ["station_name", "corridor_id", "corridor_name", "lat", "lon"], self.as_of)

    def checks(self, staged: dict[str, DataFrame]) -> DataFrame:
        written = ["int_train_delays_daily", "int_ndw_traffic_daily", "dim_stations", "dim_date",
                   "dim_ndw_locations", "fct_train_performance", "fct_road_traffic",
                   "dm_multimodal_daily"]
        raw = {k: v for k, v in self.feeds.items() if v is not None}
        return quality.quality_report({
            **raw, **staged, **{t: self.table(t) for t in written if self.has(t)}})

    def freshness(self, now: str) -> DataFrame:
        feeds = [f for f in ("ns_departures", "ns_disruptions", "ndw_traffic_flow")
                 if self.feeds.get(f) is not None and "_ingested_at" in self.feeds[f].columns]
        return reduce(DataFrame.unionByName, [
            quality.freshness(self.feeds[f], f, "_ingested_at", now) for f in feeds])

    def raise_alerts(self) -> DataFrame:
        """Record the alerts of the day and return the ones that fired."""
        fired = alerts.reliability_alerts(self.table("dm_multimodal_daily"), self.as_of)
        alerts.append_alert_history(
            self.spark, self.alert_path(), alerts.alert_records(fired, self.as_of))
        return fired

    def recorded_alerts(self) -> DataFrame:
        """The alert history. There is no table, and so no row, before a first alert has fired."""
        records = alerts.alert_records(
            alerts.reliability_alerts(self.table("dm_multimodal_daily"), self.as_of), self.as_of)
        if not exists(self.spark, self.alert_path()):
            return self.spark.createDataFrame([], records.schema)
        return self.spark.read.schema(records.schema).parquet(self.alert_path())

    def run(self, full_refresh: bool = False, now: str | None = None) -> dict[str, DataFrame]:
        staged = self.build_models(full_refresh)
        self.update_history()
        return {
            "quality": self.checks(staged),
            "freshness": self.freshness(now or f"{self.as_of} 08:00:00"),
            "alerts": self.raise_alerts(),
        }
