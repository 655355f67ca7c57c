"""All models over a set of raw feeds, built lazily and at most once."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession

from linewatch.functions.calendar import recent_days
from linewatch.plans import core, intermediate, staging, system
from linewatch.schemas import LOOKUPS
from linewatch.sources import lookups, stand_in

FEEDS = ["rdt_services", "ns_departures", "rdt_disruptions", "ns_disruptions", "knmi_weather",
         "ndw_traffic_flow"]
MODELS = [
    "stg_rdt_services", "stg_rdt_disruptions", "stg_ns_departures", "stg_ns_disruptions",
    "stg_knmi_weather", "stg_ndw_traffic_flow", "int_departures_combined", "departure_rollup",
    "int_train_delays_daily", "int_ndw_traffic_daily", "dim_stations", "dim_date",
    "dim_ndw_locations", "fct_train_performance", "fct_road_traffic", "dm_multimodal_daily",
]


class LazyFeeds(Mapping):
    """Feeds that are put together when first asked for."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders, self._built = builders, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


class Models:
    """Names every model; asking for one puts its plan together, nothing runs."""

    def __init__(self, spark: SparkSession, feeds: Mapping[str, DataFrame],
                 lookup_folder: str | None = None, recent_as_of: str | None = None,
                 dates: tuple[str, str] = (core.DIM_DATE_FIRST, core.DIM_DATE_LAST)):
        self.spark, self.feeds, self.lookup_folder = spark, feeds, lookup_folder
        self.recent_as_of, self.dates = recent_as_of, dates

    @classmethod
    def on_given_tables(cls, spark: SparkSession, sf_dir: str, **options) -> Models:
        return cls(spark, LazyFeeds(
            {f: partial(getattr(stand_in, f), spark, sf_dir) for f in FEEDS}), **options)

    def _recent(self, feed: str, day: str) -> DataFrame:
        return recent_days(self.feeds[feed], day, self.recent_as_of)

    def create_views(self) -> None:
        """Temporary views of all models and lookup tables, for queries written in SQL."""
        for name in MODELS:
            getattr(self, name).createOrReplaceTempView(name)
        for name in LOOKUPS:
            self.lookup(name).createOrReplaceTempView(name)

    def lookup(self, name: str) -> DataFrame:
        return lookups.lookup(self.spark, name, self.lookup_folder)

    @cached_property
    def stg_rdt_services(self) -> DataFrame:
        return staging.stg_rdt_services(self.feeds["rdt_services"])

    @cached_property
    def stg_rdt_disruptions(self) -> DataFrame:
        return staging.stg_rdt_disruptions(self.feeds["rdt_disruptions"])

    @cached_property
    def stg_ns_departures(self) -> DataFrame:
        return staging.stg_ns_departures(self._recent("ns_departures", "_service_date"))

    @cached_property
    def stg_ns_disruptions(self) -> DataFrame:
        return staging.stg_ns_disruptions(self._recent("ns_disruptions", "_service_date"))

    @cached_property
    def stg_knmi_weather(self) -> DataFrame:
        return staging.stg_knmi_weather(self.feeds["knmi_weather"])

    @cached_property
    def stg_ndw_traffic_flow(self) -> DataFrame:
        return staging.stg_ndw_traffic_flow(
            self._recent("ndw_traffic_flow", "service_date"), self.spark)

    @cached_property
    def int_departures_combined(self) -> DataFrame:
        return intermediate.int_departures_combined(self.stg_ns_departures, self.stg_rdt_services)

    @cached_property
    def departure_rollup(self) -> DataFrame:
        return intermediate.rollup_by_priority(self.stg_ns_departures, self.stg_rdt_services)

    @cached_property
    def int_train_delays_daily(self) -> DataFrame:
        return intermediate.int_train_delays_daily(
            self.departure_rollup, self.stg_ns_disruptions, self.stg_rdt_disruptions)

    @cached_property
    def int_ndw_traffic_daily(self) -> DataFrame:
        return intermediate.int_ndw_traffic_daily(self.stg_ndw_traffic_flow)

    @cached_property
    def dim_stations(self) -> DataFrame:
        return core.dim_stations(self.lookup("station_corridor_mapping"))

    @cached_property
    def dim_date(self) -> DataFrame:
        return core.dim_date(self.spark, self.lookup("nl_holidays"), *self.dates)

    @cached_property
    def dim_ndw_locations(self) -> DataFrame:
        return core.dim_ndw_locations(
            self.lookup("station_ndw_mapping"), self.lookup("station_corridor_mapping"))

    @cached_property
    def dim_operators(self) -> DataFrame:
        return self.lookup("dim_operators")

    @cached_property
    def fct_train_performance(self) -> DataFrame:
        return core.fct_train_performance(self.int_train_delays_daily, self.dim_stations)

    @cached_property
    def fct_road_traffic(self) -> DataFrame:
        return core.fct_road_traffic(self.int_ndw_traffic_daily, self.dim_ndw_locations)

    @cached_property
    def dm_multimodal_daily(self) -> DataFrame:
        return core.dm_multimodal_daily(
            self.fct_train_performance, self.dim_date, self.fct_road_traffic,
            self.stg_knmi_weather, self.lookup("knmi_corridor_mapping"))

    @cached_property
    def station_names(self) -> DataFrame:
        return system.station_names(self.stg_rdt_services, keep_empty=True)
