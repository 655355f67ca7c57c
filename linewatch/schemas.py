"""Column contracts of the raw feeds, the lookup tables and the outputs that may be absent."""

from pyspark.sql import types as T


def _struct(ddl_by_name: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in ddl_by_name.items()])


_S, _L, _D, _B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()
_DATE, _TS = T.DateType(), T.TimestampType()

# Positional column names of the two archive files.
ARCHIVE_SERVICE_FIELDS = [
    "service_rdt_id", "service_date", "service_type", "company", "train_number",
    "completely_cancelled", "partly_cancelled", "max_delay",
    "stop_rdt_id", "station_code", "station_name",
    "arrival_time", "arrival_delay", "arrival_cancelled",
    "departure_time", "departure_delay", "departure_cancelled",
    "platform_change", "planned_platform", "actual_platform",
]
ARCHIVE_DISRUPTION_FIELDS = [
    "rdt_id", "ns_lines", "rdt_lines", "rdt_lines_id", "rdt_station_names", "rdt_station_codes",
    "cause_nl", "cause_en", "statistical_cause_nl", "statistical_cause_en",
    "cause_group", "start_time", "end_time", "duration_minutes",
]

# One departure of a board poll. Nested values are declared as text: the JSON
# source then hands over their JSON rendering untouched.
BOARD_DEPARTURE = _struct({
    "direction": _S, "name": _S, "plannedDateTime": _S, "actualDateTime": _S,
    "trainCategory": _S, "cancelled": _B, "departureStatus": _S,
    "plannedTrack": _S, "actualTrack": _S,
    "product": _S, "routeStations": _S, "messages": _S,
})
BOARD_FILE = T.StructType([
    T.StructField("payload", T.StructType([
        T.StructField("departures", T.ArrayType(BOARD_DEPARTURE)),
    ])),
])

# One disruption of a feed poll, nested values again as JSON text.
FEED_DISRUPTION = _struct({
    "id": _S, "type": _S, "title": _S, "isActive": _B, "local": _B,
    "start": _S, "end": _S, "registrationTime": _S,
    "impact": _S, "publicationSections": _S, "timespans": _S,
})

# Nested shapes read out of the JSON text in staging.
PUBLICATION_SECTIONS = "array<struct<section:struct<stations:array<struct<stationCode:string>>>>>"
TIMESPANS = "array<struct<cause:struct<label:string>>>"

WEATHER_FILE = _struct({
    "station_code": _S, "date": _S,
    "TG": _L, "TN": _L, "TX": _L, "RH": _L, "DR": _L, "FG": _L, "FHX": _L, "DDVEC": _L,
})

TRAFFIC_FLOW = _struct({
    "location_id": _S, "measurement_ts": _TS, "service_date": _DATE,
    "avg_speed_kmh": _D, "vehicle_count": _L,
})

LOOKUPS = {
    "station_corridor_mapping": _struct({
        "station_code": _S, "station_name": _S, "corridor_id": _L, "corridor_name": _S,
        "lat": _D, "lon": _D}),
    "station_ndw_mapping": _struct({
        "station_code": _S, "station_name": _S, "ndw_location_id": _S, "road_name": _S,
        "ndw_lat": _D, "ndw_lon": _D, "distance_km": _D}),
    "knmi_corridor_mapping": _struct({
        "knmi_station_code": _L, "knmi_station_name": _S, "corridor_id": _L, "corridor_name": _S}),
    "nl_holidays": _struct({"date": _DATE, "holiday_name": _S}),
    "dim_operators": _struct({
        "operator_name": _S, "full_name": _S, "country": _S, "operator_type": _S,
        "description": _S}),
}

# Columns a mart row carries even when the optional feed behind them is absent.
ROAD_MART_COLUMNS = {
    "avg_road_speed_kmh": "double", "total_vehicle_count": "bigint",
    "total_congestion_minutes": "bigint", "road_speed_vs_baseline_pct": "double",
}
WEATHER_MART_COLUMNS = {
    "avg_temp_c": "double", "min_temp_c": "double", "max_temp_c": "double",
    "precipitation_mm": "double", "precipitation_duration_h": "double",
    "avg_wind_speed_kmh": "double", "max_wind_gust_kmh": "double",
    "is_stormy": "boolean", "is_heavy_rain": "boolean",
}
