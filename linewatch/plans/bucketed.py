"""Facts over tables that are bucketed by station and by road point: no row moves for the joins."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from linewatch.plans import core, intermediate
from linewatch.plans.models import Models
from linewatch.sources import buckets


class BucketedTables:
    """Writes the inputs of the facts bucketed below a folder and puts the facts together."""

    def __init__(self, models: Models, root: str, n: int = buckets.BUCKETS, prefix: str | None = None):
        self.models, self.root, self.n = models, root.rstrip("/"), n
        self.prefix = prefix or f"linewatch_{uuid.uuid4().hex[:12]}"

    def _write(self, name: str, df: DataFrame, key: str, sort_by: list[str]) -> DataFrame:
        return buckets.write_bucketed(
            df, f"{self.prefix}_{name}", f"{self.root}/{name}", key, self.n, sort_by)

    def train_facts(self) -> DataFrame:
        m = self.models
        rollup = self._write("departure_rollup", m.departure_rollup, "station_code", ["service_date"])
        counts = self._write("station_disruptions", intermediate.disruptions_per_station_day(
            m.stg_ns_disruptions, m.stg_rdt_disruptions), "station_code", ["service_date"])
        stations = self._write("dim_stations", m.dim_stations, "station_code", ["corridor_id"])
        return train_facts(rollup, counts, stations)

    def road_facts(self) -> DataFrame:
        m = self.models
        counts = self._write("road_counts", intermediate.road_counts(m.stg_ndw_traffic_flow),
                             "location_id", ["service_date"])
        speeds = self._write("free_flow_speed", intermediate.counted_free_flow_speed(counts),
                             "location_id", [])
        locations = self._write("dim_ndw_locations", m.dim_ndw_locations, "location_id", [])
        return road_facts(counts, speeds, locations)


def train_facts(rollup: DataFrame, station_disruptions: DataFrame, stations: DataFrame) -> DataFrame:
    return core.fct_train_performance(
        intermediate.delays_with_counts(rollup, station_disruptions), stations)


def road_facts(road_counts: DataFrame, free_flow: DataFrame, locations: DataFrame) -> DataFrame:
    return core.fct_road_traffic(
        intermediate.counted_traffic_daily(road_counts, free_flow), locations)
