"""Days as units of change: which ones a load touched, and tables rewritten for those alone.

A set of days has at most one member per calendar day, whatever the size of the data, and None for
rows without a day. It may come to the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from linewatch.session import make_folder, move_files, remove_path
from linewatch.sources import sinks

NO_DAY = "__HIVE_DEFAULT_PARTITION__"
Days = set[str | None]


def of_days(df: DataFrame, column: str, days: Iterable[str | None]) -> DataFrame:
    """The rows of the given days. On a partition column only their folders are read."""
    return df.where(of_day(column, days))


def of_day(column: str, days: Iterable[str | None]) -> Column:
    """Whether the column is one of the days."""
    days = set(days)
    known = ", ".join(f"date'{d}'" for d in sorted(d for d in days if d is not None))
    wanted = F.expr(f"cast(`{column}` as date) in ({known})") if known else F.lit(False)
    return wanted | F.col(column).cast("date").isNull() if None in days else wanted


def _folders(spark: SparkSession, path: str, partition_by: str) -> dict[str | None, str]:
    """The folder of each day of a partitioned table."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(conf)
    if not files.exists(root):
        return {}
    names = [s.getPath().getName() for s in files.listStatus(root)]
    values = [n.split("=", 1)[1] for n in names if n.startswith(f"{partition_by}=")]
    return {None if v == NO_DAY else v: f"{path}/{partition_by}={v}" for v in values}


def stored_days(spark: SparkSession, path: str, partition_by: str) -> Days:
    """The days a partitioned table has a folder for; no row is read."""
    return set(_folders(spark, path, partition_by))


def stored_files(spark: SparkSession, folder: str) -> frozenset[str]:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(folder)
    return frozenset(s.getPath().getName() for s in at.getFileSystem(conf).listStatus(at))


def _folders_of(days: Days, grain: str | None) -> Days:
    """The names of the folders that hold the days."""
    return set(days) if grain is None else {None if d is None else d[: len(grain)] for d in days}


def stage_days(
    df: DataFrame, path: str, partition_by: str, grain: str | None = None,
) -> tuple[str, Days]:
    """Write df beside the table at path, partitioned as that table is; returns the folder and the
    days that df has rows for. df is evaluated once, and put_days moves the files.

    The days are the names of the folders written; with a grain they are read from their column.
    """
    staged = f"{path.rstrip('/').rpartition('/')[0]}/_staged-{uuid.uuid4().hex}"
    if grain is None:
        sinks.write_table(df, staged, [partition_by])
        return staged, stored_days(df.sparkSession, staged, partition_by)
    dated = df.withColumn("period", F.date_format(F.col(partition_by).cast("date"), grain))
    sinks.write_table(dated, staged, ["period"])
    days = df.sparkSession.read.schema(dated.schema).parquet(staged).select(
        F.col(partition_by).cast("date").cast("string")).distinct()
    return staged, {r[0] for r in days.collect()}


def put_days(
    spark: SparkSession, staged: str, schema: T.StructType, path: str, days: Days,
    partition_by: str, grain: str | None = None, replace: bool = True,
) -> None:
    """Move what stage_days wrote, of the given schema, into the table at path, in place of what the
    days hold there or added to it. Days that got no row are emptied if replaced.

    Rows are not read or written again, but for those that share a folder of a coarser grain with
    the days without being of them.
    """
    folder_of, touched = partition_by if grain is None else "period", _folders_of(days, grain)
    if replace and grain is not None and touched & stored_days(spark, path, "period"):
        kept = spark.read.parquet(path)
        held = F.col("period").cast("string")
        kept = kept.where(held.isin([f for f in touched if f is not None]) | (
            held.isNull() if None in touched else F.lit(False)))
        kept = kept.where(~F.coalesce(of_day(partition_by, days), F.lit(False)))
        fields = T.StructType([f for f in schema if f.name != "period"]).add("period", "string")
        sinks.append_partitions(sinks.with_existing_schema(kept, fields), staged, ["period"])
    before, ready = _folders(spark, path, folder_of), _folders(spark, staged, folder_of)
    if replace:
        make_folder(spark, path)
        for day in touched & before.keys():
            remove_path(spark, before[day])
    for day in ready.keys() & touched:
        move_files(spark, ready[day], f"{path.rstrip('/')}/{folder_of}={NO_DAY if day is None else day}")
    remove_path(spark, staged)
    spark.catalog.refreshByPath(path)


def replace_days(
    df: DataFrame, path: str, days: Days, partition_by: str = "service_date",
    cluster_by: list[str] | None = None, grain: str | None = None,
) -> None:
    """Make df, which has rows of the given days only, the content of those days.

    Other days keep their files. Every write names its files anew, so a folder of the given days
    that still has its old ones got no row, and is removed. Running it again changes nothing. df is
    evaluated once and must not read from the same path.

    grain: a date pattern such as `yyyy`, for tables with few rows a day: a folder holds the days of
    equal pattern in a column `period`, and the rows of its other days are written again.
    """
    spark = df.sparkSession
    if grain is not None:
        staged, _ = stage_days(df, path, partition_by, grain)
        put_days(spark, staged, df.schema, path, days, partition_by, grain)
        return
    before = {d: stored_files(spark, folder) for d, folder in _folders(
        spark, path, partition_by).items() if d in days}
    sinks.overwrite_partitions(df, path, [partition_by], cluster_by)
    for d, folder in _folders(spark, path, partition_by).items():
        if d in before and stored_files(spark, folder) == before[d]:
            remove_path(spark, folder)
    spark.catalog.refreshByPath(path)


def _digest(df: DataFrame, day: str) -> dict[str | None, tuple]:
    """A digest of the rows of each day, whatever their order."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)])
    other = F.xxhash64(F.lit("row"), *[F.col(f"`{c}`") for c in sorted(df.columns)])
    figures = df.groupBy(F.col(day).cast("string").alias("day")).agg(
        F.count(F.lit(1)), F.sum(row.cast("decimal(38,0)")), F.sum(other.cast("decimal(38,0)")))
    return {r[0]: tuple(r)[1:] for r in figures.collect()}  # a row for each day


def days_that_differ(new: DataFrame, stored: DataFrame | None, day: str = "service_date") -> Days:
    """The days on which two versions of a table do not have the same rows."""
    ours = _digest(new, day)
    theirs = {} if stored is None else _digest(stored.select(*[
        F.col(f.name).cast(f.dataType).alias(f.name) for f in new.schema]), day)
    return {d for d in ours.keys() | theirs.keys() if ours.get(d) != theirs.get(d)}


class ChangeLog:
    """What loads have touched and a refresh has not seen yet.

    A load notes its days before it writes, so a load that dies half way leaves a note too many and
    never one too few; a refresh notes what it has seen after its last write. Both may run again.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def note(self, feed: str, days: Days) -> None:
        load = uuid.uuid4().hex
        rows = [(load, feed, d) for d in sorted(days, key=str)]
        if rows:
            self.spark.createDataFrame(rows, "load string, feed string, day string").coalesce(
                1).write.mode("append").parquet(f"{self.path}/loads")

    def pending(self) -> tuple[list[str], dict[str, Days]]:
        """(the loads not seen yet, the days they touched by feed)."""
        loads = sinks.read_if_present(self.spark, f"{self.path}/loads")
        if loads is None:
            return [], {}
        seen = sinks.read_if_present(self.spark, f"{self.path}/seen")
        if seen is not None:
            loads = loads.join(seen, "load", "left_anti")
        rows = loads.collect()  # feeds times days
        by_feed: dict[str, Days] = {}
        for r in rows:
            by_feed.setdefault(r.feed, set()).add(r.day)
        return sorted({r.load for r in rows}), by_feed

    def seen(self, loads: list[str]) -> None:
        if loads:
            self.spark.createDataFrame([(x,) for x in loads], "load string").coalesce(
                1).write.mode("append").parquet(f"{self.path}/seen")


def union_of(*sets: Iterable[str | None]) -> Days:
    return reduce(lambda a, b: a | set(b), sets, set())
