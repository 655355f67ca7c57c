"""Exact distinct counts that merge: numbered values as bitmaps by day.

Distinct counts of days do not add up, so a report over a range has to see all rows of it. Here each
value gets a number once, and a day keeps a bitmap of the numbers that occur on it. The
union of the bitmaps of any days has as many bits as those days have different values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from linewatch.operators.changes import Days, replace_days
from linewatch.session import remove_path, scratch_path
from linewatch.sources import sinks

#: Values of one kind get numbers of their own; a kind is a column that reports count.
NUMBERS = "kind string, value string, number bigint"


def numbers(spark: SparkSession, path: str) -> DataFrame:
    """The dictionary: the number of each value of each kind, from 1 without gaps."""
    known = sinks.read_if_present(spark, path)
    if known is None:
        return spark.range(0).selectExpr(
            "'' as kind", "'' as value", "id as number")
    return spark.read.schema(NUMBERS).parquet(path)


def add_numbers(spark: SparkSession, path: str, values: DataFrame) -> None:
    """Give each new (kind, value) the next number of its kind. NULL is no value.

    Known numbers never change. New values are sorted by range and numbered inside each part; only
    the sizes of the parts, parts times kinds rows, meet in one place. With a service_date, values
    are numbered by their first day: those that are new on a day are neighbours, so the values of
    a day lie in few buckets, and there are about as many bitmaps as days and buckets, not their product.
    """
    known = numbers(spark, path)
    day = F.col("service_date") if "service_date" in values.columns else F.lit(None)
    fresh = values.select("kind", F.col("value").cast("string").alias("value"),
                          day.cast("date").alias("_first")).where(
        F.col("kind").isNotNull() & F.col("value").isNotNull()).groupBy("kind", "value").agg(
        F.min("_first").alias("_first")).join(known, ["kind", "value"], "left_anti")
    ranged = scratch_path(spark, "new-values")
    fresh.repartitionByRange("kind", "_first", "value").withColumn("_part", F.spark_partition_id()).write.parquet(
        ranged)
    rows = spark.read.schema("kind string, value string, _first date, _part int").parquet(ranged)
    sizes = rows.groupBy("kind", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("kind").orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1))
    top = known.groupBy("kind").agg(F.max("number").alias("_top"))
    starts = sizes.withColumn("_before", before).join(top, "kind", "left").select(
        "kind", "_part",
        (F.coalesce("_before", F.lit(0)) + F.coalesce("_top", F.lit(0))).alias("_start"))
    place = F.row_number().over(Window.partitionBy("kind", "_part").orderBy("_first", "value"))
    added = scratch_path(spark, "new-numbers")
    rows.withColumn("_place", place).join(starts, ["kind", "_part"]).select(
        "kind", "value", (F.col("_start") + F.col("_place")).cast("bigint").alias("number")
    ).write.parquet(added)
    new = spark.read.schema(NUMBERS).parquet(added)
    if not new.isEmpty():
        new.write.mode("append").parquet(path)
    remove_path(spark, ranged)
    remove_path(spark, added)


def day_bitmaps(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    """service_date, kind, bucket, bits: the numbers of the values of rows (service_date, kind,
    value) by day. Rows are reduced to the different ones before the shuffle; a bucket covers
    32,768 numbers in 4 KB, however often they occur. Numbers meet by day and bucket first, so only
    whole bitmaps are built and none travels in parts."""
    number = F.col("number")
    values = rows.select("service_date", "kind", F.col("value").cast("string").alias("value")).distinct()
    placed = values.join(dictionary, ["kind", "value"]).select(
        "service_date", "kind", F.bitmap_bucket_number(number).alias("bucket"),
        F.bitmap_bit_position(number).alias("_bit"))
    return placed.repartition("service_date", "kind", "bucket").groupBy(
        "service_date", "kind", "bucket").agg(F.bitmap_construct_agg("_bit").alias("bits"))


def distinct_counts(bitmaps: DataFrame, *by: Column | str) -> DataFrame:
    """kind and distinct_count of the days of bitmaps, for each value of further columns."""
    merged = bitmaps.groupBy(*by, "kind", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*by, "kind").agg(
        F.sum(F.bitmap_count("bits")).cast("bigint").alias("distinct_count"))


class DistinctDays:
    """The dictionary and the day bitmaps below a folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def replace(self, rows: DataFrame, days: Days) -> None:
        """Make rows (service_date, kind, value) all that is known of the given days."""
        add_numbers(self.spark, f"{self.root}/numbers", rows.select("service_date", "kind", "value"))
        bitmaps = day_bitmaps(rows, numbers(self.spark, f"{self.root}/numbers"))
        replace_days(bitmaps, f"{self.root}/days", days, grain="yyyy-MM")

    def table(self) -> DataFrame:
        days = self.spark.read.parquet(f"{self.root}/days")
        return days.drop("period")

    def between(self, first: str, last: str) -> DataFrame:
        """kind, distinct_count over the days of a range; only their bitmaps are read."""
        days = self.spark.read.parquet(f"{self.root}/days")
        month = F.col("period").cast("string").between(first[:7], last[:7])
        return distinct_counts(days.where(month & F.col("service_date").between(
            F.lit(first).cast("date"), F.lit(last).cast("date"))))


def departure_values(departures: DataFrame) -> DataFrame:
    """(service_date, kind, value): the stations, operators and trains of departures."""
    kinds = {"station": "station_code", "operator": "operator_name", "train": "train_number"}
    return departures.select("service_date", F.explode(F.array(*[
        F.struct(F.lit(k).alias("kind"), F.col(c).cast("string").alias("value"))
        for k, c in kinds.items()])).alias("x")).select("service_date", "x.kind", "x.value")


def disruption_values(*disruptions: DataFrame) -> DataFrame:
    """(service_date, kind, value): the disruptions of staged disruption feeds."""
    parts = [d.select("service_date", F.lit("disruption").alias("kind"),
                      F.col("disruption_id").alias("value")) for d in disruptions]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
