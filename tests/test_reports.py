from __future__ import annotations

import datetime as dt

import pytest

from linewatch.operators.rollup import departure_rollup
from linewatch.plans import core, corridor, network, system, weather_impact
from linewatch.sources import lookups

D = dt.date
DAY = ("corridor_id bigint, corridor_name string, service_date date, pct_on_time double, "
       "avg_delay_min double, total_departures bigint, disruption_count bigint, "
       "severe_delay_share double")


def days(spark, *rows):
    return spark.createDataFrame(list(rows), DAY)


def row(day, on_time=80.0, delay=2.0, departures=10, disruptions=1, name="A", cid=1):
    return (cid, name, day, on_time, delay, departures, disruptions, 1.0)


def test_headline(spark):
    got = network.headline_figures(days(
        spark, row(D(2026, 3, 1)), row(D(2026, 3, 5), on_time=None, delay=4.0))).first()
    assert tuple(got) == (20, 80.0, 3.0, 2, D(2026, 3, 1), D(2026, 3, 5))


def test_volume_labels_the_end_of_the_period_and_skips_gaps(spark, rows):
    frame = days(spark, row(D(2026, 3, 2)), row(D(2026, 3, 8)), row(D(2026, 3, 23)),
                 row(D(2026, 3, 9), name="B"), row(D(2026, 3, 9), name=None))
    assert rows(network.service_volume(frame, "W")) == [
        (D(2026, 3, 8), "A", 20, 2), (D(2026, 3, 15), "B", 10, 1), (D(2026, 3, 29), "A", 10, 1)]
    assert rows(network.service_volume(frame, "M")) == [
        (D(2026, 3, 31), "A", 30, 3), (D(2026, 3, 31), "B", 10, 1)]


def test_trend_fills_gaps(spark, rows):
    frame = days(spark, row(D(2026, 1, 5), delay=1.0), row(D(2026, 1, 6), delay=2.0),
                 row(D(2026, 3, 2), delay=None))
    weekly = rows(corridor.volume_and_delay_trend(frame, "W"))
    assert len(weekly) == 9
    assert weekly[0] == (D(2026, 1, 11), 20, 1.5, 2, 1.0)
    assert weekly[1] == (D(2026, 1, 18), 0, None, 0, None)
    assert weekly[-1] == (D(2026, 3, 8), 10, None, 1, 1.0)
    assert rows(corridor.volume_and_delay_trend(frame, "M"), "period_start", "total_departures") == [
        (D(2026, 1, 31), 20), (D(2026, 2, 28), 0), (D(2026, 3, 31), 10)]


def test_station_stress_uses_the_latest_day(spark, rows):
    stations = core.dim_stations(lookups.lookup(spark, "station_corridor_mapping"))
    frame = days(spark, row(D(2026, 3, 1), delay=1.0), row(D(2026, 3, 2), delay=5.0),
                 row(D(2026, 3, 1), delay=9.0, cid=3))
    got = network.station_stress(frame, stations)
    assert got.count() == 18
    assert rows(got.where("corridor_id = 1"), "avg_delay_min") == [(5.0,)] * 5
    assert rows(got.where("corridor_id = 3"), "avg_delay_min") == [(None,)] * 2


def test_calendar(spark, rows):
    frame = days(spark, row(D(2026, 3, 1), on_time=70.0), row(D(2026, 3, 1), on_time=90.0),
                 row(D(2026, 3, 2), name="B"))
    assert rows(network.reliability_calendar(frame)) == [
        ("A", D(2026, 3, 1), 80.0), ("B", D(2026, 3, 2), 80.0)]
    grid = network.reliability_calendar_grid(frame, ["2026-03-01", "2026-03-02"])
    assert rows(grid) == [("A", 80.0, None), ("B", None, 80.0)]
    with pytest.raises(ValueError):
        network.reliability_calendar(frame, "total_departures")


def test_causes(spark, rows):
    rdt = spark.createDataFrame([
        (D(2026, 3, 7), "infra", "s", "c", ["UT", " ASD"]), (D(2026, 3, 8), None, "s", "c", ["UT"]),
        (D(2026, 3, 8), "", "s", "c", None), (D(2026, 3, 8), None, None, None, ["XX"])],
        "service_date date, cause_group string, statistical_cause string, cause string, "
        "affected_station_codes array<string>")
    ns = spark.createDataFrame(
        [(D(2026, 3, 8), None, "MAINTENANCE", ["UT", "EHV"])],
        "service_date date, cause string, disruption_type string, "
        "affected_station_codes array<string>")
    weekly = network.disruption_causes(rdt, ns, "2026-01-01", "2026-12-31", "week")
    assert rows(weekly) == [
        (D(2026, 3, 1), "infra", 1), (D(2026, 3, 8), "", 1), (D(2026, 3, 8), "MAINTENANCE", 1),
        (D(2026, 3, 8), "Unknown", 1), (D(2026, 3, 8), "s", 1)]
    stations = core.dim_stations(lookups.lookup(spark, "station_corridor_mapping"))
    top = corridor.top_causes(rdt, ns, stations, 4, "2026-01-01", "2026-12-31")
    assert [tuple(r) for r in top.collect()] == [("MAINTENANCE", 2), ("infra", 1), ("s", 1)]


def test_station_performance_counts_per_corridor_unless_deduplicated(spark):
    stations = core.dim_stations(lookups.lookup(spark, "station_corridor_mapping"))
    facts = spark.createDataFrame(
        [("UT", 4, D(2026, 3, 1), 2.0, 1.0, 80.0, 10, 1)],
        "station_code string, corridor_id bigint, service_date date, avg_delay_min double, "
        "severe_delay_share double, pct_on_time double, total_departures bigint, "
        "disruption_count bigint")
    args = (facts, stations, 4, "2026-01-01", "2026-12-31")
    assert corridor.station_performance(*args).first().total_departures == 30
    assert corridor.station_performance(*args, dedupe_dim=True).first().total_departures == 10


def departures(spark, *rows_):
    return departure_rollup(spark.createDataFrame(
        list(rows_), "station_code string, operator_name string, service_date date, "
                     "delay_minutes bigint"))


def test_operator_reports(spark, rows):
    day = D(2026, 3, 1)
    roll = departures(spark, ("UT", "NS", day, -2), ("UT", "NS", day, 6), ("UT", "NS", day, None),
                      ("EHV", "DB", day, 20), ("XX", None, day, 0), ("UT", None, D(2026, 4, 1), 1))
    span = ("2026-01-01", "2026-12-31")
    assert tuple(system.system_figures(roll, *span).first()) == (6, 3, 2, 2, 5.0, 50.0)
    assert rows(corridor.operator_mix(
        roll, core.dim_stations(lookups.lookup(spark, "station_corridor_mapping")), 4, *span)) == [
        ("DB", 1, 20.0), ("NS", 3, 2.0), ("Unknown", 1, 1.0)]
    assert rows(system.operator_ranking(roll, *span, min_departures=3)) == [
        ("NS", 3, 2.0, 33.3, 33.3, 0.0)]
    # early departures count 0, unknown delays count nowhere
    assert rows(system.delay_attribution(roll, *span, min_departures=1)) == [
        ("DB", 1, 20, 20.0), ("NS", 3, 6, 6.0)]
    assert rows(system.network_scale(roll, *span)) == [
        ("2026-03", 3, 2, 5, 6.0), ("2026-04", 1, 0, 1, 1.0)]
    assert rows(system.network_scale(roll, *span, ["EHV"])) == [("2026-03", 1, 1, 1, 20.0)]
    profiles = system.operator_profiles(roll, lookups.lookup(spark, "dim_operators"), *span)
    assert rows(profiles, "operator_name", "country", "departures") == [
        ("DB", "DE", 1), ("NS", "NL", 3)]
    names = spark.createDataFrame([("UT", "Utrecht")], "station_code string, station_name string")
    busiest = system.busiest_stations(roll, names, *span, n=2).collect()
    assert [tuple(r)[:4] for r in busiest] == [("UT", "Utrecht", 4, 1), ("EHV", "EHV", 1, 1)]


def test_unknown_delays_only(spark, rows):
    roll = departures(spark, ("UT", "NS", D(2026, 3, 1), None))
    assert rows(system.delay_attribution(roll, "2026-01-01", "2026-12-31", 1)) == [
        ("NS", 1, None, None)]


def test_small_operators_become_other(spark, rows):
    day = D(2026, 3, 1)
    roll = departures(spark, *[("UT", op, day, 0) for op in ("a", "a", "b", "c", None)])
    span = ("2026-01-01", "2026-12-31")
    assert rows(system.monthly_departures(roll, *span, top=1)) == [
        ("2026-03", "Other", 2), ("2026-03", "a", 2)]
    assert rows(system.monthly_departures(roll, *span, selected=["b", "c"], top=1)) == [
        ("2026-03", "Other", 1), ("2026-03", "b", 1)]


def test_disruption_history(spark, rows):
    rdt = spark.createDataFrame(
        [(D(2011, 1, 1), 121, "x"), (D(2011, 5, 1), 120, ""), (D(2012, 1, 1), None, "x"),
         (D(2012, 1, 1), None, None)], "service_date date, duration_minutes bigint, cause_group string")
    assert rows(system.disruptions_by_year(rdt)) == [(2011, 2, 121.0, 1), (2012, 2, None, 0)]
    by_year = system.disruption_causes_by_year(rdt)
    assert rows(by_year) == [(2011, "x", 1), (2012, "x", 1)]
    assert rows(system.cause_totals(by_year)) == [("x", 2)]


def test_station_names(spark, rows):
    stops = spark.createDataFrame(
        [("UT", "b"), ("UT", "a"), ("UT", ""), ("ED", ""), ("XX", None)],
        "station_code string, station_name string")
    assert rows(system.station_names(stops)) == [("UT", "a")]
    assert rows(system.station_names(stops, keep_empty=True)) == [("ED", ""), ("UT", "")]


WEATHER = ("corridor_name string, service_date date, pct_on_time double, avg_delay_min double, "
           "severe_delay_share double, disruption_count bigint, avg_temp_c double, "
           "precipitation_mm double, avg_wind_speed_kmh double, is_stormy boolean, "
           "is_heavy_rain boolean, season string")


def test_weather_reports(spark, rows):
    def w(name, day, on_time, wind, rain=0.0, temp=3.0, season="winter", storm=False):
        return (name, D(2026, 3, day), on_time, 1.0, 0.0, 0, temp, rain, wind, storm, False, season)
    frame = spark.createDataFrame(
        [w("A", 1, 90.0, 0.0), w("B", 1, 70.0, 31.0), w("A", 2, 50.0, 80.0, storm=True),
         w("A", 3, 60.0, 30.0, rain=6.0, season=None)], WEATHER)
    conditions = weather_impact.condition_summary(frame).collect()
    assert [(r.weather_condition, r.days, r.avg_on_time) for r in conditions] == [
        ("Normal", 1, 80.0), ("Rainy (>5mm)", 1, 60.0), ("Storm (>75 km/h)", 1, 50.0)]
    assert [tuple(r)[:3] for r in weather_impact.wind_bins(frame).collect()] == [
        ("15-30", 1, 60.0), ("30-45", 1, 70.0), ("60+", 1, 50.0)]
    assert [r.rain_bin for r in weather_impact.rain_bins(frame).collect()] == [
        "Dry", "Heavy (5-10mm)"]
    assert [r.temp_bin for r in weather_impact.temperature_bins(frame).collect()] == ["0-5"]
    seasons = weather_impact.seasonal_summary(frame).collect()
    assert [(r.season, r.avg_on_time) for r in seasons] == [
        ("winter", 70.0), ("spring", None), ("summer", None), ("autumn", None)]
    assert rows(weather_impact.wind_sensitivity(frame), "corridor_name", "is_windy", "days") == [
        ("A", False, 2), ("A", True, 1), ("B", True, 1)]
