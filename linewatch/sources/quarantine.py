"""Archive loads that keep what they reject: rows with another number of fields go to a table of
their own, with file and reason, and both kinds are counted while the files are read."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from linewatch import schemas
from linewatch.session import remove_path, scratch_path
from linewatch.sources import archive, backfill, sinks

#: Text of a row the reader could not take; NULL in rows it took.
REJECTED = archive.REJECTED
TOO_FEW, TOO_MANY, NOT_CSV = "too few fields", "too many fields", "quotes do not close"


@dataclass(frozen=True)
class LoadCounts:
    """Rows of a load: their sum is the number of records in its files, without headers."""

    accepted: int
    rejected: int


def fields_in(row: Column) -> Column:
    """The number of fields of a CSV record: commas outside quotes, and one."""
    unquoted = F.regexp_replace(row, r'"(?:[^"]|"")*+"', "")
    return F.regexp_count(unquoted, F.lit(",")) + 1


def rejects(scanned: DataFrame, feed: str, expected: int) -> DataFrame:
    """The rejected rows of scanned with file, reason and number of fields."""
    n = fields_in(F.col(REJECTED))
    return scanned.where(F.col(REJECTED).isNotNull()).select(
        F.lit(feed).alias("feed"), F.col("_file").alias("file"), F.col(REJECTED).alias("row"),
        n.alias("fields"), F.lit(expected).alias("expected"),
        F.when(n < expected, TOO_FEW).when(n > expected, TOO_MANY).otherwise(NOT_CSV).alias("reason"),
        F.col("_ingested_at").alias("loaded_at"))


def load(
    scanned: DataFrame, feed: str, expected: int, target: str, quarantine: str,
    partition_by: list[str],
) -> LoadCounts:
    """Accepted rows into target, replacing their partitions; rejected ones appended to quarantine.

    The files, which are gzipped and so one task each, are read once: what was parsed is written to
    scratch and counted on the way, and both tables are filled from there.
    """
    spark = scanned.sparkSession
    counts = Observation(f"load-{uuid.uuid4().hex}")
    good = F.col(REJECTED).isNull()
    staged = scratch_path(spark, f"scan-{feed}")
    scanned.observe(counts, F.count_if(good).alias("accepted"),
                    F.count_if(~good).alias("rejected")).write.parquet(staged)
    found = counts.get
    rows = spark.read.schema(scanned.schema).parquet(staged)
    if found["accepted"]:
        sinks.overwrite_periods(
            rows.where(good).drop(REJECTED, "_file"), target, partition_by)
    if found["rejected"]:
        sinks.append_partitions(rejects(rows, feed, expected), quarantine, ["feed"])
    remove_path(spark, staged)
    return LoadCounts(found["accepted"], found["rejected"])


def load_services(
    spark: SparkSession, folder: str, periods: str, target: str, quarantine: str,
    ingested_at: Column | None = None, multi_line: bool = True,
) -> LoadCounts:
    """backfill.backfill_services with a quarantine. Nothing to load counts no row."""
    tokens = archive.without_covered_months(archive.period_tokens(periods))
    if not tokens:
        return LoadCounts(0, 0)
    scanned = archive.read_services(
        spark, backfill.service_files(folder, tokens), ingested_at=ingested_at,
        multi_line=multi_line, keep_rejected=True)
    scanned = scanned.withColumn("load_month", archive.load_month("_year_month", "service_date"))
    return load(scanned, "rdt_services", len(schemas.ARCHIVE_SERVICE_FIELDS), target, quarantine,
                ["load_month"])


def load_disruptions(
    spark: SparkSession, folder: str, years: str, target: str, quarantine: str,
    ingested_at: Column | None = None, multi_line: bool = True,
) -> LoadCounts:
    """backfill.backfill_disruptions with a quarantine."""
    tokens = list(dict.fromkeys(archive.year_tokens(years)))
    if not tokens:
        return LoadCounts(0, 0)
    scanned = archive.read_disruptions(
        spark, backfill.disruption_files(folder, tokens), ingested_at=ingested_at,
        multi_line=multi_line, keep_rejected=True)
    return load(scanned, "rdt_disruptions", len(schemas.ARCHIVE_DISRUPTION_FIELDS), target,
                quarantine, ["_year"])
