from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from linewatch.functions import calendar, columns as C

D = dt.date


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("text, expected", [
    ("true", True), ("TRUE", True), ("False", False), ("t", None), ("1", None), ("", None),
    (None, None)])
def test_strict_bool(spark, text, expected):
    assert one(spark, C.strict_bool(F.lit(text).cast("string"))) is expected


def test_strict_long_fails_on_text_that_is_no_number(spark):
    assert one(spark, C.strict_long(F.lit(" 60 "))) == 60
    assert one(spark, C.strict_long(F.lit("  "))) is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, C.strict_long(F.lit("late")))


@pytest.mark.parametrize("seconds, minutes", [(80, 1), (-80, -1), (59, 0), (-59, 0), (120, 2)])
def test_minutes_are_cut_toward_zero(spark, seconds, minutes):
    start = F.lit("2026-03-26 08:00:00").cast("timestamp")
    end = F.timestamp_add("SECOND", F.lit(seconds), start)
    assert one(spark, C.whole_minutes_between(start, end)) == minutes


@pytest.mark.parametrize("delay, label", [
    (-3, "on_time"), (1, "on_time"), (2, "minor"), (5, "minor"), (15, "moderate"),
    (16, "severe"), (None, "severe")])
def test_delay_category(spark, delay, label):
    assert one(spark, C.delay_category(F.lit(delay).cast("bigint"))) == label


@pytest.mark.parametrize("value, label", [
    (0.0, None), (0.1, "0-15"), (15.0, "0-15"), (15.1, "15-30"), (200.0, "60+"), (200.1, None),
    (None, None)])
def test_bins_are_closed_on_the_right(spark, value, label):
    binned = C.right_closed_bin(F.lit(value).cast("double"), C.WIND_EDGES, C.WIND_LABELS)
    assert one(spark, binned) == label


def test_dry_days_have_a_bin_of_their_own(spark):
    def rain(mm):
        return one(spark, C.right_closed_bin(F.lit(mm), C.RAIN_EDGES, C.RAIN_LABELS))
    assert [rain(0.0), rain(0.1), rain(10.0), rain(10.1)] == [
        "Dry", "Light (0-2mm)", "Heavy (5-10mm)", "Very heavy (10+mm)"]


def test_weather_condition_takes_the_most_severe(spark):
    def label(storm, heavy, wind, rain):
        return one(spark, C.weather_condition(
            F.lit(storm).cast("boolean"), F.lit(heavy).cast("boolean"),
            F.lit(wind).cast("double"), F.lit(rain).cast("double")))
    assert label(True, True, 50, 20) == "Storm (>75 km/h)"
    assert label(None, True, 50, 20) == "Heavy Rain (>10mm)"
    assert label(False, None, 40.1, 6) == "Windy (>40 km/h)"
    assert label(False, False, 40, 5.1) == "Rainy (>5mm)"
    assert label(None, None, None, None) == "Normal"


@pytest.mark.parametrize("day, start, end", [
    (D(2026, 3, 1), D(2026, 3, 1), D(2026, 3, 1)),    # a Sunday
    (D(2026, 3, 2), D(2026, 3, 1), D(2026, 3, 8)),
    (D(2026, 3, 7), D(2026, 3, 1), D(2026, 3, 8))])
def test_weeks_turn_on_sunday(spark, day, start, end):
    assert one(spark, calendar.truncated_period(F.lit(day), "week")) == start
    assert one(spark, calendar.closing_period(F.lit(day), "W")) == end


def test_months(spark):
    assert one(spark, calendar.truncated_period(F.lit(D(2026, 2, 14)), "month")) == D(2026, 2, 1)
    assert one(spark, calendar.closing_period(F.lit(D(2024, 2, 14)), "M")) == D(2024, 2, 29)
    assert one(spark, calendar.month_label(F.lit(D(2024, 2, 14)))) == "2024-02"


def test_date_spine_includes_both_ends(spark):
    days = [r[0] for r in calendar.date_spine(spark, "2026-02-27", "2026-03-02").collect()]
    assert days == [D(2026, 2, 27), D(2026, 2, 28), D(2026, 3, 1), D(2026, 3, 2)]


def test_stable_round_ignores_the_noise_of_a_sum(spark):
    assert one(spark, C.stable_round(F.lit(9.3499999999999), 1)) == 9.4
    assert one(spark, C.stable_round(F.lit(1.005), 2)) == 1.01
    assert one(spark, C.stable_round(F.lit(-2.5), 0)) == -3.0


@settings(max_examples=15, deadline=None)
@given(st.dates(D(2020, 1, 1), D(2030, 12, 31)))
def test_week_bounds_hold_for_any_day(spark, day):
    start = one(spark, calendar.sunday_week_start(F.lit(day)))
    end = one(spark, calendar.sunday_week_end(F.lit(day)))
    assert start.isoweekday() == 7 and end.isoweekday() == 7
    assert 0 <= (day - start).days <= 6 and 0 <= (end - day).days <= 6
