"""Registered queries against their SQL counterparts on the smallest tables.

tools/compare.py does the same for all of them at any scale.
"""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from linewatch.registry import REGISTRY
from oracle.reports import ORACLE
from tests.conftest import SMALL
from tools.compare import TABLES, rows_of

CHECKED = [
    "stg_rdt_disruptions", "stg_ns_departures", "stg_ns_disruptions", "int_departures_combined",
    "int_ndw_traffic_daily", "dm_multimodal_daily", "dim_date_in_use", "disruption_causes_by_week",
    "corridor_trend_weekly", "station_performance", "corridor_top_causes",
    "weather_condition_summary", "weather_seasonal_summary", "system_figures",
    "monthly_departures", "delay_attribution", "reliability_alerts_all_days", "quality_report",
    "services_csv_reload", "incremental_upsert", "snapshot_history", "refresh_by_days",
    "daily_order", "free_flow_by_loads", "archive_rejects", "evolving_polls", "weather_backfill",
    "bucketed_train_facts", "distinct_values", "poll_stream_latest", "disruption_road_impact",
]


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    return connection


def test_every_query_has_a_counterpart():
    assert set(REGISTRY) == set(ORACLE)
    assert set(REGISTRY) <= set(queries()) and set(ORACLE) <= set(oracle_sql())
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    result = entry(spark)
    assert result.columns[:3] == ["corridor_id", "corridor_name", "service_date"]
    assert result.count() > 0


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, db, name):
    df = queries()[name](spark, SMALL)
    result = db.execute(oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())
