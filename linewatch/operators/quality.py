"""Data checks. Each check is a row of a report; a table is scanned once for all of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Columns that must not be NULL, columns that must be unique, and value ranges,
# per table.
NOT_NULL = {
    "ns_disruptions": ["id", "_service_date"],
    "ns_departures": ["_service_date", "_station_code"],
    "rdt_services": ["service_date", "station_code"],
    "rdt_disruptions": ["rdt_id", "start_time"],
    "ndw_traffic_flow": ["location_id", "service_date"],
    "knmi_weather": ["service_date", "station_code"],
    "stg_ns_disruptions": ["disruption_id", "service_date"],
    "stg_ns_departures": ["departure_id"],
    "stg_rdt_services": ["departure_id", "service_date", "station_code"],
    "stg_rdt_disruptions": ["disruption_id", "service_date"],
    "stg_ndw_traffic_flow": ["location_id", "measurement_ts"],
    "int_train_delays_daily": ["station_code", "service_date"],
    "int_ndw_traffic_daily": ["location_id", "service_date"],
    "dim_stations": ["station_code"],
    "dim_ndw_locations": ["location_id"],
    "dim_date": ["date"],
    "fct_train_performance": ["station_code", "service_date"],
    "fct_road_traffic": ["location_id", "service_date"],
    "dm_multimodal_daily": ["corridor_id", "service_date"],
}
UNIQUE = {
    "stg_ns_departures": ["departure_id"],
    "dim_ndw_locations": ["location_id"],
    "dim_date": ["date"],
}
RANGES = {"fct_train_performance": {"pct_on_time": (0, 100)}}
# Age of the newest row at which a feed is late, or too late.
WARN_AFTER_HOURS, ERROR_AFTER_HOURS = 36, 48


def outside_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """The rows whose value lies outside low..high; NULL is not outside."""
    value = F.col(column)
    return df.where((value < low) | (value > high))


def pct_on_time_violations(fct_train_performance: DataFrame) -> DataFrame:
    return outside_range(fct_train_performance, "pct_on_time", 0, 100).select(
        "station_code", "service_date", "pct_on_time")


def table_checks(
    df: DataFrame, table: str, not_null: list[str], unique: str | None = None,
    ranges: dict[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """A row for each check, from one aggregation. NULLs are neither equal nor outside a range.

    With a unique column rows are first counted by its values, combined before the shuffle.
    """
    counts = {("not_null", c): F.col(f"`{c}`").isNull() for c in not_null}
    for c, (low, high) in (ranges or {}).items():
        counts["range", c] = (F.col(f"`{c}`") < low) | (F.col(f"`{c}`") > high)
    names = {check: f"_{i}" for i, check in enumerate(counts)}
    measures = [F.count_if(counts[check]).alias(name) for check, name in names.items()]
    if unique is None:
        figures = df.agg(*measures)
    else:
        repeated = F.col("_key").isNotNull() & (F.col("_times") > 1)
        names["unique", unique] = "_repeated"
        figures = df.groupBy(F.col(f"`{unique}`").alias("_key")).agg(
            F.count(F.lit(1)).alias("_times"), *measures).agg(
            *[F.coalesce(F.sum(name), F.lit(0)).alias(name)
              for name in names.values() if name != "_repeated"],
            F.count_if(repeated).alias("_repeated"))
    entries = F.array(*[F.struct(
        F.lit(check).alias("check"), F.lit(table).alias("table"), F.lit(column).alias("column"),
        F.col(name).alias("failures")) for (check, column), name in names.items()])
    return figures.select(F.inline(entries))


def check_not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    return table_checks(df, table, columns)


def check_unique(df: DataFrame, table: str, column: str) -> DataFrame:
    return table_checks(df, table, [], column)


def quality_report(tables: dict[str, DataFrame]) -> DataFrame:
    """All checks that apply to the given tables, one row each.

    A table is evaluated once, and once more for each unique column after its first.
    """
    reports = []
    for name, df in tables.items():
        if name in NOT_NULL:
            first, *others = UNIQUE.get(name, [None])
            reports.append(table_checks(df, name, NOT_NULL[name], first, RANGES.get(name)))
            reports += [check_unique(df, name, column) for column in others]
    return reduce(DataFrame.unionByName, reports).withColumn("passed", F.col("failures") == 0)


def freshness(df: DataFrame, feed: str, loaded_at: Column | str, as_of: str) -> DataFrame:
    """One row: newest load of a feed, its age in hours and pass / warn / error."""
    loaded = F.col(loaded_at) if isinstance(loaded_at, str) else loaded_at
    newest = df.agg(F.max(loaded.cast("timestamp")).alias("newest"))
    hours = F.timestamp_diff("SECOND", F.col("newest"), F.lit(as_of).cast("timestamp")) / 3600.0
    status = (
        F.when(F.col("age_hours") <= WARN_AFTER_HOURS, "pass")
        .when(F.col("age_hours") <= ERROR_AFTER_HOURS, "warn")
        .otherwise("error")
    )
    return newest.select(
        F.lit(feed).alias("feed"), "newest", hours.alias("age_hours"),
    ).withColumn("status", status)
