"""Readers of the train archive: stop records (CSV, usually gzipped) and disruptions (CSV)."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from linewatch import schemas
from linewatch.functions.columns import blank_to_null, restore_empty, strict_bool, strict_long

ARCHIVE_SOURCE = "rdt_archive"
#: The period in the name of a file, or of the folder that holds a period's files.
_PERIOD_IN_PATH = r"(?:services|disruptions)-(\d{4}(?:-\d{2})?)[^/]*(?:/[^/]*)?$"

_SERVICE_BOOLEANS = {
    "completely_cancelled", "partly_cancelled", "arrival_cancelled", "departure_cancelled",
    "platform_change",
}
_SERVICE_NUMBERS = {"max_delay", "arrival_delay", "departure_delay"}
_SERVICE_BLANKABLE = {"arrival_time", "departure_time", "planned_platform", "actual_platform"}
_DISRUPTION_BLANKABLE = {"start_time", "end_time"}


#: The text of a row with another number of fields, in the scans that keep such rows.
REJECTED = "_rejected_row"


def _scan_positional(
    spark: SparkSession, paths: str | list[str], fields: list[str], multi_line: bool,
    keep_rejected: bool = False,
) -> DataFrame:
    """Text columns by position. Rows with too few or too many fields are dropped, or kept with
    their text (see quarantine.py, which counts and stores them).

    A gzip file is one task whatever its size, so the layout gives the
    parallelism: one file per month. Everything after the scan is a narrow
    projection, and the writers cap the rows per file, so the next job splits
    freely again.
    """
    columns = fields + [REJECTED] * keep_rejected
    return (
        spark.read.schema(T.StructType([T.StructField(f, T.StringType()) for f in columns]))
        .options(header=True, quote='"', escape='"', multiLine=multi_line,
                 mode="PERMISSIVE" if keep_rejected else "DROPMALFORMED",
                 columnNameOfCorruptRecord=REJECTED)
        .csv(paths)
    )


def _kept(keep_rejected: bool) -> list[Column]:
    return [F.col(REJECTED), F.col("_metadata.file_path").alias("_file")] if keep_rejected else []


def _period(period: str | None) -> Column:
    if period is not None:
        return F.lit(period)
    return F.regexp_extract(F.col("_metadata.file_path"), _PERIOD_IN_PATH, 1)


def _columns(
    fields: list[str], booleans: set[str], numbers: set[str], blankable: set[str],
    keep_rejected: bool,
) -> list[Column]:
    """The typed fields; NULL in a rejected row, whose fields are not where they belong."""
    parsed = [_parsed(f, booleans, numbers, blankable) for f in fields]
    if not keep_rejected:
        return parsed
    return [F.when(F.col(REJECTED).isNull(), c).alias(f) for c, f in zip(parsed, fields, strict=True)]


def _parsed(name: str, booleans: set[str], numbers: set[str], blankable: set[str]) -> Column:
    if name in booleans:
        return strict_bool(name).alias(name)
    if name in numbers:
        return strict_long(name).alias(name)
    if name in blankable:
        return blank_to_null(name).alias(name)
    return restore_empty(name).alias(name)


def read_services(
    spark: SparkSession,
    paths: str | list[str],
    period: str | None = None,
    ingested_at: Column | None = None,
    multi_line: bool = True,
    keep_rejected: bool = False,
) -> DataFrame:
    """Stop records. Without a period it is taken from each file's name, services-2026-03 or
    services-2026 with any ending, or from the name of its folder."""
    raw = _scan_positional(
        spark, paths, schemas.ARCHIVE_SERVICE_FIELDS, multi_line, keep_rejected)
    columns = _columns(schemas.ARCHIVE_SERVICE_FIELDS, _SERVICE_BOOLEANS, _SERVICE_NUMBERS,
                       _SERVICE_BLANKABLE, keep_rejected)
    return raw.select(
        *columns,
        F.lit(ARCHIVE_SOURCE).alias("_source"),
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("_ingested_at"),
        _period(period).alias("_year_month"),
        *_kept(keep_rejected),
    )


def read_disruptions(
    spark: SparkSession,
    paths: str | list[str],
    year: str | None = None,
    ingested_at: Column | None = None,
    multi_line: bool = True,
    keep_rejected: bool = False,
) -> DataFrame:
    """Archived disruptions. Without a year it is taken from the name of each file or its
    folder, disruptions-2025 with any ending."""
    raw = _scan_positional(
        spark, paths, schemas.ARCHIVE_DISRUPTION_FIELDS, multi_line, keep_rejected)
    columns = _columns(schemas.ARCHIVE_DISRUPTION_FIELDS, set(), {"duration_minutes"},
                       _DISRUPTION_BLANKABLE, keep_rejected)
    return raw.select(
        *columns,
        F.lit(ARCHIVE_SOURCE).alias("_source"),
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("_ingested_at"),
        _period(year).alias("_year"),
        *_kept(keep_rejected),
    )


def period_tokens(text: str) -> list[str]:
    """The valid periods of a comma-separated list: YYYY or YYYY-MM, others are skipped."""
    tokens = (t.strip() for t in (text or "").split(","))
    return [t for t in tokens if re.fullmatch(r"\d{4}(-\d{2})?", t)]


def year_tokens(text: str) -> list[str]:
    return [t for t in period_tokens(text) if len(t) == 4]


def without_covered_months(tokens: Iterable[str]) -> list[str]:
    """Drop a month when its whole year is in the list too, so no stop is read twice."""
    unique = list(dict.fromkeys(tokens))
    years = {t for t in unique if len(t) == 4}
    return [t for t in unique if len(t) == 4 or t[:4] not in years]


def load_month(period: Column | str, service_date: Column | str) -> Column:
    """Storage month of a stop record.

    A month file owns exactly its own month, also for trains that run past
    midnight. A year file is spread over the months of that year, strays at its
    edges going to January or December. Reloading a month, from either kind of
    file, therefore replaces that month and touches no other.
    """
    p = F.col(period) if isinstance(period, str) else period
    d = (F.col(service_date) if isinstance(service_date, str) else service_date).cast("date")
    year = F.substring(p, 1, 4)
    month = F.least(
        F.greatest(F.date_format(d, "yyyy-MM"), F.concat(year, F.lit("-01"))),
        F.concat(year, F.lit("-12")),
    )
    return F.when(F.length(p) == 7, p).otherwise(month)
