"""History of a dimension: a new version whenever one of the checked columns changes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from linewatch.operators.merge import same_key
from linewatch.session import remove_path, scratch_path
from linewatch.sources import sinks

VERSION_COLUMNS = ["version_id", "valid_from", "valid_to"]


def _version_id(source: str, columns: list[str], as_of: Column) -> Column:
    """Equal values on the same day give the same id, so a repeated run gives the same rows."""
    parts = [F.coalesce(F.col(f"{source}.{c}").cast("string"), F.lit("\0")) for c in columns]
    return F.sha2(F.concat_ws("|", *parts, as_of.cast("string")), 256)


def _first_versions(current: DataFrame, identified_by: list[str], as_of: Column) -> DataFrame:
    return current.alias("c").select(
        *[F.col(f"c.{c}") for c in current.columns],
        _version_id("c", identified_by, as_of).alias("version_id"),
        as_of.alias("valid_from"), F.lit(None).cast("date").alias("valid_to"))


def next_versions(
    history: DataFrame | None, current: DataFrame, keys: list[str], check: list[str], as_of: str,
) -> DataFrame:
    """All versions after comparing the current rows with the open ones.

    A changed row closes its version on as_of and opens another one. Rows that
    vanished stay open. The keys must be unique in current.
    """
    day = F.lit(as_of).cast("date")
    identified_by = keys + [c for c in check if c not in keys]
    if history is None:
        return _first_versions(current, identified_by, day)
    columns = current.columns
    is_open = F.col("valid_to").isNull()
    both = history.where(is_open).alias("h").join(
        current.withColumn("_present", F.lit(True)).alias("c"), same_key("h", "c", keys),
        "full_outer")

    def version(source: str, version_id: Column, valid_from: Column, valid_to: Column) -> Column:
        return F.struct(
            *[F.col(f"{source}.{c}").alias(c) for c in columns],
            version_id.alias("version_id"), valid_from.alias("valid_from"),
            valid_to.alias("valid_to"))

    nothing = F.lit(None).cast("date")
    in_history = F.col("h.version_id").isNotNull()
    in_current = F.col("c._present").isNotNull()
    changed = in_history & in_current & ~reduce(
        lambda a, b: a & b, [F.col(f"h.{c}").eqNullSafe(F.col(f"c.{c}")) for c in check])
    old = F.when(in_history, version(
        "h", F.col("h.version_id"), F.col("h.valid_from"), F.when(changed, day)))
    new = F.when(changed | ~in_history, version("c", _version_id("c", identified_by, day), day, nothing))
    versions = F.filter(F.array(old, new), lambda v: v.isNotNull())
    stepped = both.select(F.explode(versions).alias("v")).select("v.*")
    return history.where(~is_open).select(*stepped.columns).unionByName(stepped)


def update_snapshot(
    spark: SparkSession, path: str, current: DataFrame, keys: list[str], check: list[str],
    as_of: str,
) -> None:
    """Bring the history table at path up to date.

    The table is partitioned by the closing day: a run rewrites the open rows
    and the rows closed on that day in one commit, and leaves older history
    alone. Running it twice for a day changes nothing. The staged copy goes after the commit.
    """
    def partitioned(df: DataFrame) -> DataFrame:
        return df.withColumn("closed_on", F.col("valid_to"))

    existing = sinks.read_if_present(spark, path)
    if existing is None:
        sinks.write_table(partitioned(next_versions(None, current, keys, check, as_of)), path,
                          ["closed_on"])
        return
    day = F.lit(as_of).cast("date")
    in_play = existing.where(F.col("closed_on").isNull() | (F.col("closed_on").cast("date") == day))
    staged = scratch_path(spark, "snapshot")
    next_versions(in_play.drop("closed_on"), current, keys, check, as_of).write.parquet(staged)
    sinks.overwrite_partitions(partitioned(spark.read.parquet(staged)), path, ["closed_on"])
    spark.catalog.refreshByPath(path)
    remove_path(spark, staged)
