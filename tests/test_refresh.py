from __future__ import annotations

import datetime as dt

import pytest

from linewatch.plans.models import FEEDS, Models
from linewatch.plans.refresh import Refresh
from linewatch.sources import stand_in
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def feeds(spark):
    return {f: getattr(stand_in, f)(spark, SMALL) for f in FEEDS}


def content(df):
    return sorted(map(str, df.collect()))


def test_refresh_equals_the_lazy_models_and_repeats(spark, feeds, tmp_path):
    refresh = Refresh(spark, feeds, str(tmp_path / "core"), "2026-03-26")
    report = refresh.run(full_refresh=True)
    models = Models(spark, feeds)
    for table in ("departure_rollup", "int_train_delays_daily", "fct_train_performance",
                  "fct_road_traffic", "dm_multimodal_daily"):
        lazy = getattr(models, table)
        assert content(refresh.table(table).select(*lazy.columns)) == content(lazy), table
    failed = {(r.check, r.table, r.column) for r in report["quality"].where("not passed").collect()}
    assert failed == {("not_null", "stg_ns_departures", "departure_id")}
    assert {r.feed: r.status for r in report["freshness"].collect()} == {
        "ns_departures": "error", "ns_disruptions": "pass"}
    assert refresh.table("snap_dim_stations").count() == 18

    before = content(refresh.table("fct_train_performance"))
    refresh.run()  # the incremental path
    assert content(refresh.table("fct_train_performance")) == before
    assert refresh.table("snap_dim_stations").count() == 18


def test_refresh_without_optional_feeds(spark, feeds, tmp_path):
    few = {f: feeds[f] for f in ("ns_departures", "ns_disruptions", "rdt_disruptions")}
    refresh = Refresh(spark, few, str(tmp_path / "core"), "2026-03-26")
    refresh.build_models()
    mart = refresh.table("dm_multimodal_daily")
    assert mart.count() > 0
    assert mart.where("avg_road_speed_kmh is not null or avg_temp_c is not null").count() == 0


def test_history_of_a_quiet_day_is_empty(spark, tmp_path):
    run = Refresh(spark, {}, str(tmp_path / "core"), "2026-03-26")
    days = [dt.date(2026, 3, d) for d in range(19, 27)]

    def mart(last: float):
        run._write("dm_multimodal_daily", spark.createDataFrame(
            [(1, "A-R", d, 90.0 if d.day < 26 else last) for d in days],
            "corridor_id bigint, corridor_name string, service_date date, pct_on_time double"))

    mart(90.0)
    assert run.raise_alerts().isEmpty() and run.recorded_alerts().collect() == []
    mart(62.0)
    run.raise_alerts()
    assert [(r.corridor, r.metric_value) for r in run.recorded_alerts().collect()] == [("A-R", 62.0)]
