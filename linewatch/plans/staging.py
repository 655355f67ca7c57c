"""Staging models: raw feeds to typed, named and deduplicated rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from linewatch import schemas
from linewatch.functions.columns import stable_round, whole_minutes_between
from linewatch.operators.latest import latest_per_key
from linewatch.sources import roads


def _typed(renames: dict[str, tuple[str, str]]) -> list[Column]:
    """Casts from a table of output name -> (input name, type)."""
    return [F.col(f"`{src}`").cast(dtype).alias(out) for out, (src, dtype) in renames.items()]


def stg_rdt_services(rdt_services: DataFrame) -> DataFrame:
    """Archived stops with a station. Stop ids repeat in the archive and are not deduplicated."""
    columns = {
        **{c: (c, "string") for c in ("service_rdt_id", "service_type", "company", "train_number",
                                      "stop_rdt_id", "station_code", "station_name",
                                      "planned_platform", "actual_platform")},
        **{c: (c, "boolean") for c in ("completely_cancelled", "partly_cancelled",
                                       "arrival_cancelled", "departure_cancelled",
                                       "platform_change")},
        "service_date": ("service_date", "date"),
        "max_delay": ("max_delay", "bigint"),
        "arrival_ts": ("arrival_time", "timestamp"),
        "departure_ts": ("departure_time", "timestamp"),
        "arrival_delay_min": ("arrival_delay", "bigint"),
        "departure_delay_min": ("departure_delay", "bigint"),
        "arrival_delay_minutes": ("arrival_delay", "bigint"),
        "departure_delay_minutes": ("departure_delay", "bigint"),
        "data_source": ("_source", "string"),
        "departure_id": ("stop_rdt_id", "string"),
    }
    return rdt_services.where(F.col("station_code") != "").select(*_typed(columns))


def stg_rdt_disruptions(rdt_disruptions: DataFrame, trim_codes: bool = False) -> DataFrame:
    """Archived disruptions with their station list.

    The list is split at commas only, so "A, B" yields "A" and " B", and the
    second never matches a station. trim_codes=True strips the parts.
    """
    codes = F.split(F.trim("rdt_station_codes"), ",")
    if trim_codes:
        codes = F.transform(codes, lambda c: F.trim(c))
    columns = {
        "disruption_id": ("rdt_id", "string"), "ns_lines": ("ns_lines", "string"),
        "rdt_lines": ("rdt_lines", "string"), "station_names": ("rdt_station_names", "string"),
        "station_codes_raw": ("rdt_station_codes", "string"), "cause_nl": ("cause_nl", "string"),
        "cause": ("cause_en", "string"), "statistical_cause": ("statistical_cause_en", "string"),
        "cause_group": ("cause_group", "string"), "start_ts": ("start_time", "timestamp"),
        "end_ts": ("end_time", "timestamp"), "duration_minutes": ("duration_minutes", "bigint"),
        "service_date": ("start_time", "date"), "data_source": ("_source", "string"),
    }
    return rdt_disruptions.where(F.col("rdt_id").isNotNull()).select(
        *_typed(columns),
        codes.alias("affected_station_codes"),
        # size(NULL) is -1 when ANSI mode is off
        F.when(codes.isNotNull(), F.size(codes)).cast("bigint").alias("stations_affected_count"),
    )


#: Order of the polls of a departure, latest first; the other columns only make it total.
LATEST_POLL = ("_ingested_at", "actual_departure_ts", "planned_departure_ts", "train_number",
               "station_code", "service_date", "operator_name", "train_name", "train_category",
               "category_long_name", "departure_status", "planned_track", "actual_track",
               "data_source", "direction")


def live_departures(ns_departures: DataFrame) -> DataFrame:
    """Departures of all polls that are not cancelled, with their key and the time of the poll.

    The key is NULL when any part is.
    """
    product = {"train_number": "$.number", "operator_name": "$.operatorName",
               "category_long_name": "$.longCategoryName"}
    columns = {
        "station_code": ("_station_code", "string"), "service_date": ("_service_date", "date"),
        "data_source": ("_source", "string"), "direction": ("direction", "string"),
        "train_name": ("name", "string"),
        "planned_departure_ts": ("plannedDateTime", "timestamp"),
        "actual_departure_ts": ("actualDateTime", "timestamp"),
        "train_category": ("trainCategory", "string"), "is_cancelled": ("cancelled", "boolean"),
        "departure_status": ("departureStatus", "string"),
        "planned_track": ("plannedTrack", "string"), "actual_track": ("actualTrack", "string"),
    }
    key_parts = [F.col(c).cast("string")
                 for c in ("_station_code", "_service_date", "plannedDateTime", "direction")]
    joined_key = key_parts[0]
    for part in key_parts[1:]:
        joined_key = F.concat(joined_key, F.lit("_"), part)
    live = ns_departures.where(~F.coalesce(F.col("cancelled").cast("boolean"), F.lit(False)))
    return live.select(
        *_typed(columns),
        *[F.get_json_object("product", path).alias(out) for out, path in product.items()],
        joined_key.alias("departure_id"),
        "_ingested_at",
    )


def latest_polls(live: DataFrame, keys: list[str]) -> DataFrame:
    """The latest poll for each value of the keys."""
    return latest_per_key(live, keys, [F.col(c).desc_nulls_last() for c in LATEST_POLL])


def with_delay(latest: DataFrame) -> DataFrame:
    return latest.drop("_ingested_at").withColumn(
        "delay_minutes", whole_minutes_between("planned_departure_ts", "actual_departure_ts"))


def stg_ns_departures(ns_departures: DataFrame) -> DataFrame:
    """Live departures that are not cancelled, each in its latest poll.

    All departures without a key, such as those without a direction, collapse into one row.
    """
    return with_delay(latest_polls(live_departures(ns_departures), ["departure_id"]))


def _distinct_station_codes(sections_json: Column) -> Column:
    sections = F.from_json(sections_json, schemas.PUBLICATION_SECTIONS)
    codes = F.flatten(F.transform(
        sections,
        lambda s: F.coalesce(
            F.transform(s["section"]["stations"], lambda st: st["stationCode"]),
            F.array().cast("array<string>"))))
    known = F.filter(codes, lambda c: c.isNotNull())
    return F.coalesce(F.sort_array(F.array_distinct(known)), F.array().cast("array<string>"))


def _first_cause(timespans_json: Column) -> Column:
    labels = F.transform(
        F.from_json(timespans_json, schemas.TIMESPANS), lambda t: t["cause"]["label"])
    return F.get(F.filter(labels, lambda label: label.isNotNull()), F.lit(0))


def stg_ns_disruptions(ns_disruptions: DataFrame) -> DataFrame:
    """Live disruptions, one row per disruption and day from the latest poll.

    Stations and cause are read out of the row's own JSON after the
    deduplication, so only surviving rows are parsed and nothing is joined.
    Polls repeat the registration time; the poll time breaks that tie.
    """
    keyed = ns_disruptions.withColumn("_registered", F.col("registrationTime").cast("timestamp"))
    latest = latest_per_key(
        keyed, ["id", "_service_date"],
        [F.col(c).desc_nulls_last() for c in ("_registered", "_ingested_at", *sorted(
            f.name for f in ns_disruptions.schema
            if f.dataType.simpleString() == "string"))])
    columns = {
        "disruption_id": ("id", "string"), "service_date": ("_service_date", "date"),
        "data_source": ("_source", "string"), "disruption_type": ("type", "string"),
        "title": ("title", "string"), "is_active": ("isActive", "boolean"),
        "is_local": ("local", "boolean"), "start_ts": ("start", "timestamp"),
        "end_ts": ("end", "timestamp"), "registration_ts": ("_registered", "timestamp"),
    }
    codes = _distinct_station_codes(F.col("publicationSections"))
    return latest.select(
        *_typed(columns),
        F.get_json_object("impact", "$.value").cast("bigint").alias("impact_score"),
        _first_cause(F.col("timespans")).alias("cause"),
        codes.alias("affected_station_codes"),
        F.size(codes).cast("bigint").alias("stations_affected_count"),
        whole_minutes_between(F.col("start").cast("timestamp"), F.col("end").cast("timestamp"))
        .alias("duration_minutes"),
    )


def stg_knmi_weather(knmi_weather: DataFrame) -> DataFrame:
    """Daily weather with wind in km/h and severity flags (NULL where the reading is missing)."""
    measures = ["avg_temp_c", "min_temp_c", "max_temp_c", "precipitation_mm",
                "precipitation_duration_h", "avg_wind_speed_ms", "max_wind_gust_ms"]
    columns = {
        "knmi_station_code": ("station_code", "string"),
        "station_region": ("station_region", "string"),
        "service_date": ("service_date", "date"),
        **{m: (m, "double") for m in measures},
        "wind_direction_deg": ("wind_direction_deg", "bigint"),
        "data_source": ("_source", "string"),
    }
    wind, gust = F.col("avg_wind_speed_ms"), F.col("max_wind_gust_ms")
    typed = knmi_weather.where(F.col("station_code").isNotNull()).select(*_typed(columns))
    return typed.select(
        "*",
        stable_round(wind * 3.6, 1).alias("avg_wind_speed_kmh"),
        stable_round(gust * 3.6, 1).alias("max_wind_gust_kmh"),
        (wind > 20.8).alias("is_stormy"),
        (F.col("precipitation_mm") > 10.0).alias("is_heavy_rain"),
        (F.col("max_temp_c") > 35.0).alias("is_extreme_heat"),
        (F.col("min_temp_c") < -5.0).alias("is_freezing"),
    )


def stg_ndw_traffic_flow(ndw_traffic_flow: DataFrame | None, spark: SparkSession) -> DataFrame:
    """Road readings, or no rows with the full schema while the feed was never loaded."""
    if ndw_traffic_flow is None:
        return roads.empty_traffic(spark)
    return ndw_traffic_flow.select(*[
        F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.TRAFFIC_FLOW])
