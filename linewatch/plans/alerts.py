"""Reliability alerts on the corridor-day mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from linewatch.session import remove_path, scratch_path
from linewatch.sources import sinks

# Alert thresholds and the days looked back, the day itself on top.
ON_TIME_THRESHOLD = 80.0
DEVIATION_THRESHOLD = 10.0
LOOKBACK_DAYS = 7


def _fires(mean: Column, on_time_threshold: float, deviation_threshold: float) -> Column:
    day = F.col("pct_on_time")
    return (day < on_time_threshold) & ((mean - day) > deviation_threshold)


def reliability_alerts(
    mart: DataFrame, service_date: str, on_time_threshold: float = ON_TIME_THRESHOLD,
    deviation_threshold: float = DEVIATION_THRESHOLD,
) -> DataFrame:
    """Corridors that are below the threshold and well below their recent mean on a day.

    The mean covers the day and the seven before it; a corridor has eight rows
    in the window at most.
    """
    day = F.lit(service_date).cast("date")
    recent = mart.where(F.col("service_date").between(F.date_sub(day, LOOKBACK_DAYS), day))
    mean = F.avg("pct_on_time").over(Window.partitionBy("corridor_id"))
    return (
        recent.withColumn("avg_7d_pct_on_time", mean)
        .where(F.col("service_date") == day)
        .select("corridor_id", "corridor_name", "pct_on_time", "avg_7d_pct_on_time")
        .where(_fires(F.col("avg_7d_pct_on_time"), on_time_threshold, deviation_threshold))
    )


def reliability_alerts_all_days(
    mart: DataFrame, on_time_threshold: float = ON_TIME_THRESHOLD,
    deviation_threshold: float = DEVIATION_THRESHOLD,
) -> DataFrame:
    """The same test for every day of the mart in one pass, for backfills."""
    day_number = F.datediff("service_date", F.lit("1970-01-01").cast("date"))
    recent = Window.partitionBy("corridor_id").orderBy(day_number).rangeBetween(
        -LOOKBACK_DAYS, Window.currentRow)
    return (
        mart.select("corridor_id", "corridor_name", "service_date", "pct_on_time")
        .withColumn("avg_7d_pct_on_time", F.avg("pct_on_time").over(recent))
        .where(_fires(F.col("avg_7d_pct_on_time"), on_time_threshold, deviation_threshold))
    )


def alert_records(
    alerts: DataFrame, service_date: Column | str, on_time_threshold: float = ON_TIME_THRESHOLD,
    checked_at: Column | None = None,
) -> DataFrame:
    """Rows for the alert history. The id follows from day, type and corridor."""
    day = (service_date if isinstance(service_date, Column) else F.lit(service_date)).cast("date")
    kind = F.lit("reliability")
    return alerts.select(
        F.sha2(F.concat_ws("|", day.cast("string"), kind, "corridor_name"), 256).alias("alert_id"),
        (F.current_timestamp() if checked_at is None else checked_at).alias("check_ts"),
        day.alias("service_date"),
        kind.alias("alert_type"),
        F.col("corridor_name").alias("corridor"),
        F.col("pct_on_time").alias("metric_value"),
        F.col("avg_7d_pct_on_time").alias("recent_mean"),
        F.lit(float(on_time_threshold)).alias("threshold"),
        F.lit(True).alias("fired"),
    )


def append_alert_history(spark: SparkSession, path: str, records: DataFrame) -> None:
    """Add the alerts that are not recorded yet, evaluated once; none of them, no write."""
    known = sinks.read_if_present(spark, path)
    if known is not None:
        records = records.join(known.select("alert_id"), "alert_id", "left_anti")
    staged = scratch_path(spark, "alerts")
    records.write.parquet(staged)
    new = spark.read.schema(records.schema).parquet(staged)
    if not new.isEmpty():
        new.write.mode("append").parquet(path)
    remove_path(spark, staged)
