"""What several operators share: staging, gapless numbering and connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from linewatch.session import remove_path, scratch_path

#: Rows of one Arrow batch: 2,000 documents of some kilobytes are a few megabytes in a worker.
BATCH_ROWS = 2_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches for this session, so that a worker never holds many long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


#: Removes the shuffle files of a write when it ends; else they wait for the driver's garbage collector.
_FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, label: str) -> DataFrame:
    """df written to the shared scratch folder and read again: lineage ends there, and a lost
    executor costs no more than its unfinished tasks. Shuffle files go when the write ends."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(_FILE_CLEANUP)
    spark.conf.set(_FILE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_FILE_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*frames: DataFrame) -> None:
    """Deletes the folders of frames that staged() returned, once nothing reads them any more."""
    for df in frames:
        remove_path(df.sparkSession, df._scratch)


#: Rows of a few numbers that may be broadcast: some 16 MB.
BROADCAST_ROWS = 300_000


def hinted(df: DataFrame) -> DataFrame:
    """A staged df of a few numbers a row, to be broadcast if it is proven small enough; beyond
    that, joins shuffle."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def numbered(
    df: DataFrame, keys: list[str], order: list[Column], name: str, spread: Column,
    buckets: int = 256,
) -> DataFrame:
    """df with a gapless number from 0 among the rows of equal keys.

    Rows of one key lie in `buckets` buckets (`spread`, a whole number, modulo that), so a key
    with a third of all rows is many tasks. Numbers follow the bucket, then `order`. Only the
    bucket counts, keys times buckets rows, meet in one place.
    """
    rows = df.withColumn("_bucket", F.pmod(spread, F.lit(buckets)).cast("int"))
    counts = rows.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = counts.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    ranked = rows.withColumn("_within", F.row_number().over(within) - 1)
    same = F.col("_bucket") == F.col("_b")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return ranked.join(starts, same).select(
        *df.columns, (F.col("_start") + F.col("_within")).cast("long").alias(name))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component): for each id of edges (a, b) the smallest id reachable from it.

    Alternates large-star and small-star steps; every step is an aggregation that combines before
    its shuffle and a join, and is staged. Ends when no edge changes; ids without an edge have no
    row. Null ends are no edges.
    """
    now = staged(
        edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    state = None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # large star: neighbours above an id move to the smallest of its neighbourhood
        large = both.where(F.col("b") > F.col("a")).join(least, "a").select(
            F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where(F.col("a") != F.col("b")).distinct()
        # small star: the id and its neighbours below it move to the smallest of them
        below = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(below, "a").select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
            F.col("m").alias("b"))
        last, now = now, staged(small.where(F.col("a") != F.col("b")).distinct(), "cc")
        discard(last)
        seen = now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("id"), F.col("b").alias("component"))).distinct()
