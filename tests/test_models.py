from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from linewatch.functions.calendar import recent_days
from linewatch.operators.quantile import grouped_quantile
from linewatch.operators.rollup import departure_rollup
from linewatch.operators.skew import join_per_key
from linewatch.plans import core, intermediate, staging
from linewatch.schemas import ROAD_MART_COLUMNS, WEATHER_MART_COLUMNS
from linewatch.sources import lookups

D = dt.date
BOARD = ("direction string, name string, plannedDateTime string, actualDateTime string, "
         "trainCategory string, cancelled boolean, departureStatus string, plannedTrack string, "
         "actualTrack string, product string, _station_code string, _service_date string, "
         "_source string, _ingested_at timestamp")


def poll(direction="X", planned="2026-03-26T08:00:00+0100", actual="2026-03-26T08:05:00+0100",
         cancelled=False, at=6, day="2026-03-26", station="UT"):
    return (direction, "NS 1", planned, actual, "IC", cancelled, "INCOMING", "1", "2",
            '{"number": "1", "operatorName": "NS"}', station, day, "ns_api_v2",
            dt.datetime(2026, 3, 26, at))


def staged(spark, *polls):
    return staging.stg_ns_departures(spark.createDataFrame(list(polls), BOARD))


def test_latest_poll_wins(spark):
    got = staged(spark, poll(at=6), poll(at=12, actual="2026-03-26T08:09:00+0100"),
                 poll(at=9, actual="2026-03-26T08:07:00+0100")).collect()
    assert [r.delay_minutes for r in got] == [9]
    assert "_ingested_at" not in got[0].asDict()


def test_cancelled_departures_are_dropped_unknown_ones_kept(spark):
    got = staged(spark, poll("A", cancelled=True), poll("B", cancelled=None), poll("C"))
    assert sorted(r.direction for r in got.collect()) == ["B", "C"]


def test_departures_without_direction_collapse(spark):
    got = staged(spark, poll(None, at=6), poll(None, at=7, station="ASD"), poll("A")).collect()
    assert sorted(str(r.departure_id) for r in got) == [
        "None", "UT_2026-03-26_2026-03-26T08:00:00+0100_A"]
    assert [r.station_code for r in got if r.departure_id is None] == ["ASD"]


def test_missing_actual_time_and_early_departure(spark):
    got = staged(spark, poll("A", actual=None), poll("B", actual="2026-03-26T07:58:40+0100"))
    assert {r.direction: r.delay_minutes for r in got.collect()} == {"A": None, "B": -1}


FEED = ("id string, type string, title string, isActive boolean, local boolean, start string, "
        "end string, registrationTime string, impact string, publicationSections string, "
        "timespans string, _service_date string, _source string, _ingested_at timestamp")


def test_disruption_keeps_the_last_poll(spark):
    def item(hour, active, sections):
        return ("D1", "DISRUPTION", "t", active, None, None, None, "2026-04-01T07:55:00+0200",
                '{"value":2}', sections, None, "2026-04-01", "ns_api_v3",
                dt.datetime(2026, 4, 1, hour))
    feed = spark.createDataFrame([
        item(8, True, '[{"section":{"stations":[{"stationCode":"UT"}]}}]'), item(20, False, None),
    ], FEED)
    got = staging.stg_ns_disruptions(feed).collect()
    assert len(got) == 1 and got[0].is_active is False and got[0].affected_station_codes == []
    assert got[0].cause is None and got[0].duration_minutes is None


DEPARTURE = ("departure_id string, station_code string, service_date date, direction string, "
             "planned_departure_ts timestamp, actual_departure_ts timestamp, delay_minutes bigint, "
             "is_cancelled boolean, train_number string, train_category string, "
             "operator_name string, data_source string")
STOP = ("departure_id string, station_code string, service_date date, departure_ts timestamp, "
        "departure_delay_min bigint, departure_delay_minutes bigint, completely_cancelled boolean, "
        "departure_cancelled boolean, train_number string, service_type string, company string, "
        "data_source string")


def live(n, day):
    return (n, "UT", day, "X", None, None, 0, False, "1", "IC", "NS", "ns_api_v2")


def stop(n, day, delay=0, whole=False, own=False, ts=dt.datetime(2026, 3, 1, 8)):
    return (n, "UT", day, ts, delay, delay, whole, own, "1", "IC", "NS", "rdt_archive")


def combined(spark, lives, stops):
    return intermediate.int_departures_combined(
        spark.createDataFrame(lives, DEPARTURE),
        None if stops is None else spark.createDataFrame(stops, STOP))


def test_archive_days_hide_live_days(spark):
    lives = [live("l1", D(2026, 3, 1)), live("l2", D(2026, 3, 2)), live("l3", None)]

    def ids(stops):
        return sorted(r.departure_id for r in combined(spark, lives, stops).collect())

    assert ids(None) == ["l1", "l2", "l3"]
    assert ids([]) == ["l1", "l2", "l3"]
    assert ids([stop("a", D(2026, 3, 1))]) == ["a", "l2"]
    assert ids([stop("a", D(2026, 3, 1)), stop("b", None)]) == ["a", "b"]
    # a stop nobody departs from covers no day
    assert ids([stop("a", D(2026, 3, 1), ts=None)]) == ["l1", "l2", "l3"]


@pytest.mark.parametrize("stops", [
    None, [], [stop("a", D(2026, 3, 1), delay=3), stop("b", D(2026, 3, 1), delay=None)],
    [stop("a", D(2026, 3, 1)), stop("b", None)], [stop("a", D(2026, 3, 1), ts=None)]])
def test_rollup_of_sources_equals_rollup_of_departures(spark, rows, stops):
    lives = spark.createDataFrame(
        [live("l1", D(2026, 3, 1)), live("l2", D(2026, 3, 2)), live("l3", None)], DEPARTURE)
    archive = None if stops is None else spark.createDataFrame(stops, STOP)
    by_source = intermediate.rollup_by_priority(lives, archive)
    combined_first = departure_rollup(intermediate.int_departures_combined(lives, archive))
    assert rows(by_source) == rows(combined_first)


def test_archive_flags_and_times(spark):
    rows = combined(spark, [], [
        stop("a", D(2026, 3, 1), delay=7, whole=False, own=True),
        stop("b", D(2026, 3, 1), delay=None, whole=None, own=True)]).collect()
    got = {r.departure_id: r for r in rows}
    assert got["a"].is_cancelled is False and got["b"].is_cancelled is True
    assert got["a"].actual_departure_ts == dt.datetime(2026, 3, 1, 8, 7)
    assert got["b"].actual_departure_ts == dt.datetime(2026, 3, 1, 8)
    assert got["b"].delay_minutes is None and got["b"].direction is None


def test_station_days(spark):
    departures = combined(spark, [], [
        stop(str(i), D(2026, 3, 1), delay=d) for i, d in enumerate([0, 1, 2, 16, None])])
    disruptions = "disruption_id string, service_date date, affected_station_codes array<string>"
    ns = spark.createDataFrame([("D1", D(2026, 3, 1), ["UT", "UT"])], disruptions)
    rdt = spark.createDataFrame([
        ("R1", D(2026, 3, 1), ["ASD", " UT"]), ("R2", D(2026, 3, 1), ["UT"]),
        ("R3", D(2026, 3, 2), ["UT"]), ("R4", D(2026, 3, 1), None)], disruptions)
    rows = intermediate.int_train_delays_daily(departure_rollup(departures), ns, rdt).collect()
    assert [tuple(r) for r in rows] == [
        ("UT", D(2026, 3, 1), 5, 4.75, 16.0, 40.0, 20.0, 2)]


# Quantiles and skew ---------------------------------------------------------------------------

def quantiles(spark, pairs, **options):
    df = spark.createDataFrame(pairs, "k string, v double")
    return {r.k: r.q for r in grouped_quantile(df, "k", "v", 0.85, "q", **options).collect()}


def expected(pairs):
    groups = {}
    for k, v in pairs:
        if v is not None and k is not None:
            groups.setdefault(k, []).append(v)
    return {k: pytest.approx(float(np.quantile(v, 0.85)), abs=1e-9) for k, v in groups.items()}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]),
                          st.one_of(st.none(), st.floats(-1e3, 1e3))), min_size=1, max_size=40))
def test_quantile_of_small_groups(spark, pairs):
    assert quantiles(spark, pairs) == expected(pairs)


@pytest.mark.parametrize("shape", ["normal", "few values", "one value", "skewed"])
def test_quantile_of_a_hot_key(spark, shape):
    rng = np.random.default_rng(5)
    n = 30_000
    hot = {"normal": rng.normal(80, 20, n), "few values": rng.integers(0, 4, n) * 1.0,
           "one value": np.full(n, 7.0), "skewed": rng.exponential(3, n) ** 3}[shape]
    pairs = [("hot", float(v)) for v in hot] + [("cold", float(v)) for v in range(50)]
    assert quantiles(spark, pairs, intervals=4, rounds=2) == expected(pairs)


def test_salted_join_equals_the_plain_join(spark):
    rows = spark.range(2000).selectExpr(
        "if(id % 3 = 0, 'hot', cast(id % 7 as string)) as k", "id as v")
    rows = rows.unionByName(spark.createDataFrame([(None, -1)], "k string, v bigint"))
    per_key = spark.createDataFrame([("hot", 1), ("1", 2), (None, 3)], "k string, x int")
    got = join_per_key(rows, per_key, "k", "left", ["v"], salts=8)
    want = rows.join(per_key, "k", "left")
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_road_days(spark):
    readings = [("p", D(2026, 3, 1), float(s), 2) for s in (100, 100, 100, 100, 49, 40)]
    readings += [("q", D(2026, 3, 1), None, None)]
    traffic = spark.createDataFrame(
        readings, "location_id string, service_date date, avg_speed_kmh double, "
                  "vehicle_count bigint")
    want = [("p", D(2026, 3, 1), 81.5, 12, 30), ("q", D(2026, 3, 1), None, None, 0)]
    lazy = intermediate.int_ndw_traffic_daily(traffic)
    given_speeds = intermediate.int_ndw_traffic_daily(
        traffic, intermediate.free_flow_speed(traffic))
    for got in (lazy, given_speeds):
        assert sorted(map(tuple, got.collect())) == want


# Dimensions, facts and mart -------------------------------------------------------------------

def test_dim_date(spark):
    dates = core.dim_date(spark, lookups.lookup(spark, "nl_holidays"))
    got = {r.date: r for r in dates.collect()}
    assert len(got) == 730 and min(got) == D(2026, 1, 1) and max(got) == D(2027, 12, 31)
    new_year, sunday, monday = got[D(2026, 1, 1)], got[D(2026, 3, 1)], got[D(2027, 1, 4)]
    assert (new_year.day_of_week, new_year.week_number, new_year.season, new_year.is_holiday) == (
        5, 1, "winter", True)
    assert sunday.day_of_week == 1 and sunday.is_weekend and sunday.season == "spring"
    assert monday.week_number == 1 and not monday.is_weekend and monday.holiday_name is None
    assert got[D(2027, 1, 1)].week_number == 53 and got[D(2027, 1, 1)].is_holiday is False
    assert {m: got[D(2026, m, 1)].season for m in (6, 9, 12)} == {
        6: "summer", 9: "autumn", 12: "winter"}


def test_dimensions(spark):
    corridors = lookups.lookup(spark, "station_corridor_mapping")
    assert core.dim_stations(corridors.union(corridors)).count() == 18
    roads = core.dim_ndw_locations(lookups.lookup(spark, "station_ndw_mapping"), corridors)
    got = {r.location_id: r for r in roads.collect()}
    assert len(got) == 42
    assert got["RWS09_401"].nearest_station_code == "UT" and got["RWS09_401"].corridor_id == 2


TRAIN_DAY = ("station_code string, service_date date, total_departures bigint, "
             "avg_delay_min double, max_delay_min double, pct_on_time double, "
             "severe_delay_share double, disruption_count bigint")


def train_days(spark, *extra):
    return spark.createDataFrame([
        ("UT", D(2026, 3, 1), 10, 2.0, 9.0, 80.0, 10.0, 1),
        ("ASA", D(2026, 3, 1), 30, 4.0, 9.0, 60.0, 0.0, 2),
        ("XX", D(2026, 3, 1), 5, 4.0, 9.0, 60.0, 0.0, 2), *extra], TRAIN_DAY)


def test_station_on_three_corridors_fans_out(spark):
    stations = core.dim_stations(lookups.lookup(spark, "station_corridor_mapping"))
    fact = core.fct_train_performance(train_days(spark), stations)
    got = sorted((r.station_code, r.corridor_id) for r in fact.collect() if r.corridor_id)
    assert got == [("ASA", 2), ("UT", 2), ("UT", 4), ("UT", 5)]
    assert fact.where("corridor_id is null").first().station_code == "XX"
    late = core.fct_train_performance(
        train_days(spark, ("UT", D(2026, 3, 8), 1, 1.0, 1.0, 1.0, 1.0, 0)), stations, "2026-03-10")
    assert {r.service_date for r in late.collect()} == {D(2026, 3, 8)}


def test_mart_weighs_stations_equally_and_fills_absent_feeds(spark):
    stations = core.dim_stations(lookups.lookup(spark, "station_corridor_mapping"))
    dates = core.dim_date(spark, lookups.lookup(spark, "nl_holidays"))
    fact = core.fct_train_performance(train_days(spark), stations)
    mart = core.dm_multimodal_daily(fact, dates)
    row = mart.where("corridor_id = 2").first()
    assert (row.pct_on_time, row.avg_delay_min, row.total_departures, row.disruption_count) == (
        70.0, 3.0, 40, 3)
    assert row.season == "spring" and row.is_weekend is True
    types = dict(mart.dtypes)
    for name, dtype in {**ROAD_MART_COLUMNS, **WEATHER_MART_COLUMNS}.items():
        assert row[name] is None and types[name] == dtype
    assert mart.where("corridor_id is null").count() == 0


def test_weather_flags_are_false_without_readings(spark):
    weather = staging.stg_knmi_weather(spark.createDataFrame(
        [("240", "amsterdam", "2026-03-01", 10.0, 5.0, 15.0, None, 0.0, None, 12.0, 10, "knmi"),
         ("344", "rotterdam", "2026-03-01", 11.1, 5.0, 15.0, None, 0.0, None, 14.0, 10, "knmi")],
        "station_code string, station_region string, service_date string, avg_temp_c double, "
        "min_temp_c double, max_temp_c double, precipitation_mm double, "
        "precipitation_duration_h double, avg_wind_speed_ms double, max_wind_gust_ms double, "
        "wind_direction_deg bigint, _source string"))
    mapping = lookups.lookup(spark, "knmi_corridor_mapping")
    got = {r.corridor_id: r for r in core.corridor_weather(weather, mapping).collect()}
    assert sorted(got) == [1, 2, 3]
    assert got[1].avg_temp_c == 10.6 and got[1].max_wind_gust_kmh == 50.4
    assert got[1].is_stormy is False and got[1].is_heavy_rain is False
    assert got[1].avg_wind_speed_kmh is None


def test_mart_types_do_not_depend_on_the_feeds(spark):
    """Adding roads and weather must not change a column's type."""
    from linewatch.plans.models import Models
    models = Models.on_given_tables(spark, "/root/testdata/sf0.001")
    bare = core.dm_multimodal_daily(models.fct_train_performance, models.dim_date)
    assert bare.dtypes == models.dm_multimodal_daily.dtypes


def test_recent_days(spark):
    days = spark.createDataFrame([("2026-03-01",), ("2026-03-02",)], "d string")
    assert recent_days(days, "d", "2026-04-01").count() == 1
    assert recent_days(days, "d", None).count() == 2


def test_development_scope_of_the_models(spark):
    from linewatch.plans.models import Models
    whole = Models.on_given_tables(spark, "/root/testdata/sf0.001")
    recent = Models(spark, whole.feeds, recent_as_of="2026-05-10")
    for model in ("stg_ns_departures", "stg_ns_disruptions", "stg_ndw_traffic_flow"):
        first = getattr(recent, model).agg(F.min("service_date")).first()[0]
        assert first >= D(2026, 4, 10), model
    assert recent.stg_rdt_services.count() == whole.stg_rdt_services.count()


def test_disruptions_of_days_without_departures_are_not_counted(spark):
    named = spark.sql("""select * from values
        ('a', date'2026-03-01', array('UT', 'ASD')), ('b', date'2026-03-01', array('UT')),
        ('a', date'2011-03-01', array('UT')), ('c', cast(null as date), array('UT'))
        t(disruption_id, service_date, affected_station_codes)""")
    days = spark.sql("select * from values (date'2026-03-01'), (date'2026-03-01'), (null) t(service_date)")
    counts = intermediate.disruptions_per_station_day(named, named, days=days)
    assert sorted((r.station_code, str(r.service_date), r.disruption_count)
                  for r in counts.collect()) == [("ASD", "2026-03-01", 1), ("UT", "2026-03-01", 2)]
    assert intermediate.disruptions_per_station_day(named, named).count() == 4
