"""What the plans must look like for the jobs to hold at scale."""

from __future__ import annotations

import re

import pytest

from linewatch.operators import merge
from linewatch.operators.combine import union_by_priority
from linewatch.operators.latest import latest_per_key
from linewatch.plans import core, intermediate, network, staging
from linewatch.plans.models import Models
from linewatch.registry import REGISTRY
from linewatch.sources import lookups, sinks
from tests.conftest import SMALL


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def models(spark):
    return Models.on_given_tables(spark, SMALL)


@pytest.mark.parametrize("name", [
    "dm_multimodal_daily", "station_stress", "corridor_trend_weekly", "weather_seasonal_summary",
    "monthly_departures", "corridor_top_causes", "reliability_alerts_all_days", "system_figures",
    "free_flow_speed", "dim_date_in_use"])
def test_no_query_pairs_all_rows(spark, name):
    plan = physical(REGISTRY[name](spark, SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("model", ["stg_ns_departures", "stg_ns_disruptions"])
def test_deduplication_keeps_one_row_per_key_before_the_shuffle(models, model):
    plan = physical(getattr(models, model))
    partial, exchange, final = (plan.find(t) for t in (
        "row_number(), 1, Partial", "Exchange hashpartitioning", "row_number(), 1, Final"))
    assert 0 < final < exchange < partial, plan


def test_live_days_are_excluded_by_a_null_aware_broadcast_join(spark, models):
    plan = physical(models.int_departures_combined)
    assert re.search(r"BroadcastHashJoin .*LeftAnti, BuildRight, true", plan), plan
    # what is broadcast has been reduced to distinct days
    broadcast = plan[plan.index("BroadcastExchange"):]
    assert re.search(r"HashAggregate\(keys=\[service_date#\d+\], functions=\[\]", broadcast)


def test_no_python_in_any_plan(spark, models):
    for name in ("dm_multimodal_daily", "int_departures_combined", "stg_ns_disruptions"):
        assert "Python" not in physical(getattr(models, name))


def test_reports_prune_days_and_columns(spark, models, tmp_path):
    path = str(tmp_path / "mart")
    sinks.write_table(models.dm_multimodal_daily, path, ["service_date"], ["corridor_id"])
    plan = physical(network.service_volume(
        network.in_range(spark.read.parquet(path), "2026-03-01", "2026-03-07")))
    assert re.search(r"PartitionFilters: \[.*service_date#\d+ >= 2026-03-01", plan)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "corridor_name", "total_departures", "disruption_count"}


def test_aggregated_reports_sort_only_their_result(spark):
    plan = physical(REGISTRY["weather_condition_summary"](spark, SMALL))
    assert plan.count("rangepartitioning") == 1


def test_priority_is_by_date_only(spark):
    df = spark.createDataFrame([("a",)], "day string")
    with pytest.raises(TypeError):
        union_by_priority(df, df, "day")


def test_lookups_are_broadcast_without_hints(spark, models):
    rollup = models.departure_rollup
    stats = intermediate.int_train_delays_daily(
        rollup, models.stg_ns_disruptions, models.stg_rdt_disruptions)
    plan = physical(core.fct_train_performance(stats, models.dim_stations))
    assert "BroadcastHashJoin [station_code" in plan
    assert "LocalTableScan" in physical(lookups.lookup(spark, "nl_holidays"))


@pytest.fixture
def large_tables(spark):
    """Plans as for tables that are too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_road_points_are_salted(spark, large_tables):
    plan = physical(Models.on_given_tables(spark, SMALL).int_ndw_traffic_daily)
    # two sides each of the two rounds and the last step of the quantile, and of the day's join
    assert len(re.findall(r"hashpartitioning\(location_id#\d+, _salt#\d+", plan)) == 8


def test_station_days_join_without_another_shuffle(spark, large_tables):
    plan = physical(Models.on_given_tables(spark, SMALL).int_train_delays_daily)
    join_to_aggregates = plan[plan.index("SortMergeJoin"):plan.index("HashAggregate")]
    assert "Exchange" not in join_to_aggregates


def test_merge_reads_only_the_range_of_the_delta(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(60).selectExpr(
        "id", "date_add(date'2026-03-01', cast(id % 30 as int)) as service_date")
    sinks.write_table(rows, path, ["service_date"])
    delta = rows.where("service_date >= '2026-03-29'")
    plan = physical(merge.touched_partitions(spark.read.parquet(path), delta, "service_date"))
    assert re.search(r"PartitionFilters: \[.*2026-03-29", plan), plan


def test_parsing_follows_deduplication(models):
    """JSON is read from surviving rows only."""
    plan = physical(models.stg_ns_disruptions)
    assert plan.index("from_json") < plan.index("row_number(), 1, Final")


def test_priority_union_pushes_its_filter_to_both_sides(spark, tmp_path):
    for name in ("a", "b"):
        spark.range(10).selectExpr("id", "date'2026-03-01' as day").write.parquet(
            str(tmp_path / name))
    a, b = (spark.read.parquet(str(tmp_path / n)) for n in ("a", "b"))
    plan = physical(union_by_priority(a, b, "day").where("id = 3"))
    assert plan.count("PushedFilters: [IsNotNull(id), EqualTo(id,3)]") == 2


def test_latest_per_key_orders_completely(spark, rows):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (None, 1, "c"), (None, 5, "d")],
                               "k int, o int, v string")
    from pyspark.sql import functions as F
    assert rows(latest_per_key(df, ["k"], [F.desc("o")])) == [(1, 2, "b"), (None, 5, "d")]


def test_staging_of_the_archive_is_one_stage(models):
    assert "Exchange" not in physical(staging.stg_rdt_services(models.feeds["rdt_services"]))


def test_partitioned_writes_are_rebalanced(spark):
    df = spark.range(10).selectExpr("id", "date'2026-03-01' as day")
    assert "REBALANCE_PARTITIONS_BY_COL" in physical(sinks._rebalanced(df, ["day"]))
