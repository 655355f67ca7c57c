"""Every model, report and job as a query over a folder with the given tables.

The queries cover the whole tables; date ranges span all data unless the range
is the point of the report. Results are rendered for comparison: days and times
as ISO text, lists joined by "|", doubles rounded to six digits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from linewatch.functions.columns import delay_category, stable_round
from linewatch.operators import quality
from linewatch.plans import alerts, change_jobs, core, corridor, intermediate, jobs, network, staging, system
from linewatch.plans import weather_impact
from linewatch.plans.models import Models

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

FIRST, LAST = "2026-01-01", "2026-04-30"
HISTORY_FIRST, HISTORY_LAST = "2011-01-01", "2026-12-31"
CORRIDOR = 4
SELECTED_OPERATORS = ["NS", "Arriva", "DB", "Keolis"]
SELECTED_STATIONS = ["UT", "ASD", "RTD"]
GRID_DAYS = [f"2026-{m:02d}-{d:02d}" for m, n in ((1, 31), (2, 28), (3, 31), (4, 30))
             for d in range(1, n + 1)]
ALERT_DAY = "2026-03-10"
ALERT_ON_TIME, ALERT_DEVIATION = 40.0, 0.5
FRESHNESS_NOW = "2024-02-01 08:00:00"
RECENT_AS_OF = "2026-05-01"


def rendered(df: DataFrame) -> DataFrame:
    def column(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DoubleType):
            c = stable_round(c, 6)
        elif isinstance(field.dataType, T.ArrayType):
            c = F.array_join(c, "|")
        return c.alias(field.name)

    return df.select(*[column(f) for f in df.schema])


def over_models(name: str):
    """Registers a function of the models."""
    def register(build: Callable[[Models], DataFrame]):
        REGISTRY[name] = lambda spark, sf_dir: rendered(
            build(Models.on_given_tables(spark, sf_dir)))
        return build
    return register


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return REGISTRY["dm_multimodal_daily"](spark, sf_dir)


# Models ---------------------------------------------------------------------------------------

for _model in (
    "stg_rdt_services", "stg_rdt_disruptions", "stg_ns_departures", "stg_ns_disruptions",
    "stg_knmi_weather", "stg_ndw_traffic_flow", "int_departures_combined",
    "int_train_delays_daily", "int_ndw_traffic_daily", "fct_train_performance",
    "fct_road_traffic", "dm_multimodal_daily", "departure_rollup",
):
    over_models(_model)(lambda m, _model=_model: getattr(m, _model))


@over_models("stg_rdt_disruptions_trimmed")
def _(m: Models) -> DataFrame:
    return staging.stg_rdt_disruptions(m.feeds["rdt_disruptions"], trim_codes=True).select(
        "disruption_id", "affected_station_codes", "stations_affected_count")


@over_models("dim_stations_in_use")
def _(m: Models) -> DataFrame:
    used = m.departure_rollup.groupBy("station_code").agg(F.sum("departures").alias("departures"))
    return used.join(m.dim_stations, "station_code", "left")


@over_models("dim_date_in_use")
def _(m: Models) -> DataFrame:
    used = m.departure_rollup.groupBy(F.col("service_date").alias("date")).agg(
        F.sum("departures").alias("departures"))
    return used.join(m.dim_date, "date", "left")


@over_models("dim_ndw_locations_in_use")
def _(m: Models) -> DataFrame:
    used = m.stg_ndw_traffic_flow.groupBy("location_id").agg(
        F.count(F.lit(1)).alias("readings"))
    return used.join(m.dim_ndw_locations, "location_id", "left")


@over_models("mapped_road_readings")
def _(m: Models) -> DataFrame:
    return m.feeds["ndw_traffic_flow"].groupBy("location_id", "service_date").agg(
        F.count(F.lit(1)).alias("readings"), F.sum("vehicle_count").alias("vehicles"))


@over_models("free_flow_speed")
def _(m: Models) -> DataFrame:
    return intermediate.free_flow_speed(m.stg_ndw_traffic_flow)


@over_models("departures_without_archive")
def _(m: Models) -> DataFrame:
    return intermediate.int_departures_combined(m.stg_ns_departures, None).select(
        "departure_id", "station_code", "service_date", "delay_minutes", "data_source")


def _recent_departures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Development scope: the live departures of the last thirty days."""
    return rendered(Models.on_given_tables(
        spark, sf_dir, recent_as_of=RECENT_AS_OF).stg_ns_departures)


REGISTRY["recent_departures"] = _recent_departures


@over_models("delay_categories")
def _(m: Models) -> DataFrame:
    return m.int_departures_combined.groupBy(
        delay_category("delay_minutes").alias("category")).agg(
        F.count(F.lit(1)).alias("departures"))


@over_models("dm_train_only")
def _(m: Models) -> DataFrame:
    return core.dm_multimodal_daily(m.fct_train_performance, m.dim_date)


# Network overview -----------------------------------------------------------------------------

def _network_days(m: Models) -> DataFrame:
    return network.network_days(m.dm_multimodal_daily, FIRST, LAST)


over_models("network_days")(lambda m: network.daily_series(_network_days(m)))
over_models("network_headline")(lambda m: network.headline_figures(_network_days(m)))
over_models("service_volume_weekly")(lambda m: network.service_volume(_network_days(m), "W"))
over_models("service_volume_monthly")(lambda m: network.service_volume(_network_days(m), "M"))
over_models("station_stress")(
    lambda m: network.station_stress(_network_days(m), m.dim_stations))
for _metric in network.CALENDAR_METRICS:
    over_models(f"reliability_calendar_{_metric}")(
        lambda m, _metric=_metric: network.reliability_calendar(_network_days(m), _metric))
over_models("reliability_calendar_grid")(
    lambda m: network.reliability_calendar_grid(_network_days(m), GRID_DAYS))
for _grain in ("week", "month"):
    over_models(f"disruption_causes_by_{_grain}")(
        lambda m, _grain=_grain: network.disruption_causes(
            m.stg_rdt_disruptions, m.stg_ns_disruptions, HISTORY_FIRST, HISTORY_LAST, _grain))
over_models("worst_corridor_days")(lambda m: network.worst_corridor_days(_network_days(m)))


# Corridor explorer ----------------------------------------------------------------------------

def _corridor_days(m: Models) -> DataFrame:
    return corridor.corridor_days(m.dm_multimodal_daily, CORRIDOR, FIRST, LAST)


over_models("corridors")(lambda m: corridor.corridors(m.dm_multimodal_daily))
over_models("corridor_days")(lambda m: network.daily_series(_corridor_days(m)))
over_models("corridor_headline")(lambda m: network.headline_figures(_corridor_days(m)))
over_models("corridor_trend_weekly")(
    lambda m: corridor.volume_and_delay_trend(_corridor_days(m), "W"))
over_models("corridor_trend_monthly")(
    lambda m: corridor.volume_and_delay_trend(_corridor_days(m), "M"))
over_models("station_performance")(lambda m: corridor.station_performance(
    m.fct_train_performance, m.dim_stations, CORRIDOR, FIRST, LAST))
over_models("station_performance_once")(lambda m: corridor.station_performance(
    m.fct_train_performance, m.dim_stations, CORRIDOR, FIRST, LAST, dedupe_dim=True))
over_models("operator_mix")(lambda m: corridor.operator_mix(
    m.departure_rollup, m.dim_stations, CORRIDOR, FIRST, LAST))
over_models("corridor_top_causes")(lambda m: corridor.top_causes(
    m.stg_rdt_disruptions, m.stg_ns_disruptions, m.dim_stations, CORRIDOR,
    HISTORY_FIRST, HISTORY_LAST))
over_models("corridor_worst_days")(lambda m: corridor.worst_days(_corridor_days(m)))


# Weather impact -------------------------------------------------------------------------------

def _weather_days(m: Models) -> DataFrame:
    return weather_impact.weather_days(m.dm_multimodal_daily, FIRST, LAST)


over_models("weather_days")(lambda m: network.daily_series(_weather_days(m)))
for _report in ("condition_summary", "wind_bins", "rain_bins", "temperature_bins",
                "seasonal_summary", "wind_sensitivity"):
    over_models(f"weather_{_report}")(
        lambda m, _report=_report: getattr(weather_impact, _report)(_weather_days(m)))
for _pair in weather_impact.SCATTER_PAIRS:
    over_models(f"weather_scatter_{_pair}")(
        lambda m, _pair=_pair: weather_impact.scatter(_weather_days(m), _pair))


# System and operators -------------------------------------------------------------------------

over_models("system_figures")(lambda m: system.system_figures(m.departure_rollup, FIRST, LAST))
over_models("operator_profiles")(lambda m: system.operator_profiles(
    m.departure_rollup, m.dim_operators, FIRST, LAST))
over_models("monthly_departures")(lambda m: system.monthly_departures(
    m.departure_rollup, FIRST, LAST))
over_models("monthly_departures_selected")(lambda m: system.monthly_departures(
    m.departure_rollup, FIRST, LAST, SELECTED_OPERATORS, top=3))
over_models("operator_ranking")(lambda m: system.operator_ranking(
    m.departure_rollup, FIRST, LAST))
over_models("busiest_stations")(lambda m: system.busiest_stations(
    m.departure_rollup, m.station_names, FIRST, LAST))
over_models("station_names")(lambda m: system.station_names(m.stg_rdt_services))
over_models("network_scale")(lambda m: system.network_scale(m.departure_rollup, FIRST, LAST))
over_models("network_scale_selected")(lambda m: system.network_scale(
    m.departure_rollup, FIRST, LAST, SELECTED_STATIONS))
over_models("disruptions_by_year")(lambda m: system.disruptions_by_year(m.stg_rdt_disruptions))
over_models("disruption_causes_by_year")(
    lambda m: system.disruption_causes_by_year(m.stg_rdt_disruptions))
over_models("disruption_cause_totals")(
    lambda m: system.cause_totals(system.disruption_causes_by_year(m.stg_rdt_disruptions)))
over_models("delay_attribution")(lambda m: system.delay_attribution(
    m.departure_rollup, FIRST, LAST))
over_models("delay_attribution_shares")(lambda m: system.attribution_shares(
    system.delay_attribution(m.departure_rollup, FIRST, LAST)))


# Alerts and checks ----------------------------------------------------------------------------

over_models("reliability_alerts")(lambda m: alerts.reliability_alerts(
    m.dm_multimodal_daily, ALERT_DAY, ALERT_ON_TIME, ALERT_DEVIATION))
over_models("reliability_alerts_all_days")(lambda m: alerts.reliability_alerts_all_days(
    m.dm_multimodal_daily, ALERT_ON_TIME, ALERT_DEVIATION))
over_models("alert_records")(lambda m: alerts.alert_records(
    alerts.reliability_alerts_all_days(m.dm_multimodal_daily, ALERT_ON_TIME, ALERT_DEVIATION),
    F.col("service_date"), ALERT_ON_TIME, F.lit("2026-05-01 08:00:00").cast("timestamp")))
over_models("quality_report")(lambda m: quality.quality_report({
    **m.feeds,
    **{t: getattr(m, t) for t in (
        "stg_ns_disruptions", "stg_ns_departures", "stg_rdt_services", "stg_rdt_disruptions",
        "stg_ndw_traffic_flow", "int_train_delays_daily", "int_ndw_traffic_daily",
        "dim_stations", "dim_date", "dim_ndw_locations", "fct_train_performance",
        "fct_road_traffic", "dm_multimodal_daily")},
}))
over_models("pct_on_time_violations")(
    lambda m: quality.pct_on_time_violations(m.fct_train_performance))
over_models("feed_freshness")(lambda m: quality.freshness(
    m.feeds["ns_departures"], "ns_departures", "_ingested_at", FRESHNESS_NOW).unionByName(
    quality.freshness(m.feeds["ns_disruptions"], "ns_disruptions", "_ingested_at",
                      "2026-05-02 08:00:00")).unionByName(
    # the stand-in readings have no load time of their own
    quality.freshness(m.feeds["ndw_traffic_flow"], "ndw_traffic_flow", "measurement_ts",
                      "2026-04-16 08:00:00")))


# Loads and maintenance: written to the shared scratch folder and read back ---------------------

for _job in [*jobs.JOBS, *change_jobs.JOBS]:
    REGISTRY[_job.__name__] = lambda spark, sf_dir, _job=_job: rendered(_job(spark, sf_dir))
