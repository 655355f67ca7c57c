"""Column helpers: parsing, bucketing and labels. Everything stays in JVM expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_bool(text: Column | str) -> Column:
    """true/false in any case; every other text, '' included, is NULL."""
    lowered = F.lower(as_column(text))
    return F.when(lowered == "true", F.lit(True)).when(lowered == "false", F.lit(False))


def blank_to_null(text: Column | str) -> Column:
    c = as_column(text)
    return F.when(c != "", c)


def strict_long(text: Column | str) -> Column:
    """Whole number; blank text is NULL and anything else that is no number fails the job."""
    trimmed = F.trim(as_column(text))
    return F.when(trimmed != "", trimmed).cast("bigint")


def restore_empty(text: Column | str) -> Column:
    """The CSV source turns an empty field into NULL; text columns keep it as ''."""
    return F.coalesce(as_column(text), F.lit(""))


def whole_minutes_between(start: Column | str, end: Column | str) -> Column:
    """Minutes from start to end, cut toward zero (80 s is 1, -80 s is -1)."""
    return F.timestamp_diff("MINUTE", as_column(start), as_column(end))


def stable_round(value: Column | str, digits: int) -> Column:
    """Round half away from zero, the same on every run.

    The order in which a shuffle delivers doubles changes the last bits of a
    sum. Those bits are cut off first, so that a mean that is exactly halfway
    always goes the same way.
    """
    return F.round(F.round(as_column(value).cast("double"), 8), digits)


def share_pct(matching: Column, total: Column, digits: int | None = None) -> Column:
    """matching as a percentage of total."""
    pct = matching / total * F.lit(100.0)
    return pct if digits is None else stable_round(pct, digits)


def delay_category(delay_minutes: Column | str) -> Column:
    """on_time / minor / moderate / severe; a missing delay counts as severe."""
    d = as_column(delay_minutes)
    return (
        F.when(d <= 1, "on_time")
        .when(d <= 5, "minor")
        .when(d <= 15, "moderate")
        .otherwise("severe")
    )


def right_closed_bin(value: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the interval (edge, next edge] the value lies in; NULL outside all of them."""
    if len(edges) != len(labels) + 1:
        raise ValueError("a bin needs one more edge than labels")
    v = as_column(value)
    chain = None
    for low, high, label in zip(edges, edges[1:], labels):
        inside = (v > F.lit(float(low))) & (v <= F.lit(float(high)))
        chain = F.when(inside, label) if chain is None else chain.when(inside, label)
    return chain


def ordinal_of(value: Column | str, ordered: Sequence[str]) -> Column:
    """Position of the value in a fixed list of categories, for sorting."""
    return F.array_position(F.array(*[F.lit(x) for x in ordered]), as_column(value))


# Labels in order of display.
WEATHER_CONDITIONS = [
    "Normal", "Rainy (>5mm)", "Windy (>40 km/h)", "Heavy Rain (>10mm)", "Storm (>75 km/h)",
]
WIND_EDGES = [0, 15, 30, 45, 60, 200]
WIND_LABELS = ["0-15", "15-30", "30-45", "45-60", "60+"]
RAIN_EDGES = [-1, 0, 2, 5, 10, 100]
RAIN_LABELS = [
    "Dry", "Light (0-2mm)", "Moderate (2-5mm)", "Heavy (5-10mm)", "Very heavy (10+mm)",
]
TEMPERATURE_EDGES = [-20, 0, 5, 10, 15, 20, 25, 40]
TEMPERATURE_LABELS = ["<0", "0-5", "5-10", "10-15", "15-20", "20-25", "25+"]
SEASONS = ["winter", "spring", "summer", "autumn"]


def weather_condition(
    stormy: Column | str, heavy_rain: Column | str, wind_kmh: Column | str, rain_mm: Column | str,
) -> Column:
    """The most severe label that applies; missing readings never trigger one."""
    normal, rainy, windy, heavy, storm = WEATHER_CONDITIONS
    return (
        F.when(as_column(stormy), storm)
        .when(as_column(heavy_rain), heavy)
        .when(as_column(wind_kmh) > 40, windy)
        .when(as_column(rain_mm) > 5, rainy)
        .otherwise(normal)
    )
