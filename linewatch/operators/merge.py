"""Keyed upsert into a day-partitioned parquet table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from linewatch.session import remove_path, scratch_path
from linewatch.sources import sinks


def same_key(left: str, right: str, keys: list[str]) -> Column:
    """Equality on all keys in which NULL equals NULL."""
    return reduce(lambda a, b: a & b, [
        F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def merged_rows(target: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """All delta rows, plus the target rows whose key the delta does not hold."""
    kept = target.alias("t").join(
        delta.select(*keys).distinct().alias("d"), same_key("t", "d", keys), "left_anti")
    return kept.unionByName(delta, allowMissingColumns=True)


def aligned(target: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """delta with the measures that only the target has: a row of a known key keeps the
    target's value, a new one has NULL."""
    missing = [c for c in target.columns if c not in delta.columns]
    if not missing:
        return delta
    return delta.alias("d").join(
        target.select(*keys, *missing).alias("t"), same_key("d", "t", keys), "left",
    ).select("d.*", *[F.col(f"t.{c}") for c in missing])


def touched_partitions(
    target: DataFrame, new_rows: DataFrame, partition_by: str,
) -> DataFrame | None:
    """Target rows in partitions that new_rows has rows for; None when there are no new rows.

    The range of the new rows, one row that comes to the driver, prunes the
    partitions to list and read; the semi join then keeps the exact ones.
    """
    value = F.col(partition_by)
    low, high, count = new_rows.agg(F.min(value), F.max(value), F.count(F.lit(1))).first()
    if count == 0:
        return None
    nearby = target.where(value.isNull() | value.between(F.lit(low), F.lit(high)))
    touched = new_rows.select(partition_by).distinct()
    return nearby.alias("t").join(
        touched.alias("d"), same_key("t", "d", [partition_by]), "left_semi")


def incremental_merge(
    spark: SparkSession, path: str, delta: DataFrame, keys: list[str],
    partition_by: str = "service_date", cluster_by: list[str] | None = None,
) -> None:
    """Upsert delta into the table at path, rewriting only the partitions delta touches.

    delta is written to scratch first: it is computed once, its size is known
    to the joins below, and the new partitions never depend on files that are
    about to be replaced. Columns that only the target has are kept. The staged
    copies go after the commit.
    """
    if sinks.read_if_present(spark, path) is None:
        sinks.write_table(delta, path, [partition_by], cluster_by)
        return
    delta_path = scratch_path(spark, "merge-delta")
    delta.write.parquet(delta_path)
    new_rows = spark.read.parquet(delta_path)
    stored = spark.read.parquet(path)
    # a column that only the delta has is NULL in the rows that stay
    stored = stored.withColumns({
        f.name: F.lit(None).cast(f.dataType) for f in new_rows.schema
        if f.name not in stored.columns})
    # folder names give partition columns a type of their own
    stored = stored.withColumn(
        partition_by, F.col(partition_by).cast(new_rows.schema[partition_by].dataType))
    target = touched_partitions(stored, new_rows, partition_by)
    if target is None:
        remove_path(spark, delta_path)
        return
    new_rows = aligned(target, new_rows, keys)
    merged_path = scratch_path(spark, "merge-result")
    merged_rows(target, new_rows, keys).write.parquet(merged_path)
    sinks.overwrite_partitions(
        spark.read.parquet(merged_path), path, [partition_by], cluster_by)
    spark.catalog.refreshByPath(path)
    remove_path(spark, delta_path)
    remove_path(spark, merged_path)
