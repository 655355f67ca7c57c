"""Exact interpolated quantile per group that holds no group in memory."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from linewatch.operators.skew import join_per_key

# Each round splits the interval that holds a rank into so many; two rounds leave a millionth.
INTERVALS = 1024
ROUNDS = 2


def grouped_quantile(
    df: DataFrame, key: str, value: str, quantile: float, name: str,
    intervals: int = INTERVALS, rounds: int = ROUNDS,
) -> DataFrame:
    """One row per key: the interpolated quantile of the non-NULL values.

    Keys without any value, and rows without a key, give no row.

    The built-in `percentile` keeps every distinct value of a group in one
    aggregation buffer, which a road point with a large share of all readings
    would overflow. Here rows are first counted by key and value, combined
    before the shuffle. The two ranks around the quantile are then looked for:
    the range of a key's values is cut into intervals, rows are counted for
    each, and the interval with the rank is cut again, a fixed number of times.
    Only what is left of a key is ranked value by value. Ranks are counts, so
    the result is exact at any size.
    """
    return counted_quantile(
        df.withColumn("_times", F.lit(1)), key, value, "_times", quantile, name, intervals, rounds)


def counted_quantile(
    counted: DataFrame, key: str, value: str, times: str, quantile: float, name: str,
    intervals: int = INTERVALS, rounds: int = ROUNDS,
) -> DataFrame:
    """The same for rows that stand for `times` equal ones; a key and value may occur again."""
    counts = counted.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(
        F.col(key), F.col(value).alias("_v")).agg(F.sum(times).alias("_n"))
    position = (F.col("_size") - 1) * F.lit(float(quantile))
    wanted = counts.groupBy(key).agg(
        F.sum("_n").alias("_size"), F.min("_v").alias("_low"), F.max("_v").alias("_high"),
    ).select(
        key, position.alias("_position"),
        F.explode(F.array_distinct(F.array(
            F.floor(position), F.ceil(position)))).alias("_rank"),
        "_low", "_high", F.lit(0).cast("long").alias("_before"))

    def inside(targets: DataFrame) -> DataFrame:
        # a key has one or two ranks; as one row a key, the hot key can be spread over tasks
        by_key = targets.groupBy(key).agg(F.collect_list(F.struct(
            "_position", "_rank", "_low", "_high", "_before")).alias("_t"))
        joined = join_per_key(counts, by_key, key, "inner", spread_by=["_v"])
        return joined.select(key, "_v", "_n", F.explode("_t").alias("_t")).select(
            key, "_v", "_n", "_t.*").where(F.col("_v").between(F.col("_low"), F.col("_high")))

    rank = [key, "_position", "_rank"]
    up_to = Window.partitionBy(key, "_rank").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    for _ in range(rounds):
        width = F.col("_high") - F.col("_low")
        interval = F.when(width > 0, F.least(
            F.lit(intervals - 1), F.floor((F.col("_v") - F.col("_low")) / width * intervals))
        ).otherwise(0)
        rows = inside(wanted).withColumn("_interval", interval).groupBy(
            *rank, "_before", "_interval").agg(
            F.sum("_n").alias("_rows"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
        through = F.col("_before") + F.sum("_rows").over(up_to.orderBy("_interval"))
        wanted = rows.withColumn("_through", through).where(
            (F.col("_through") > F.col("_rank"))
            & (F.col("_through") - F.col("_rows") <= F.col("_rank"))).select(
            *rank, "_low", "_high", (F.col("_through") - F.col("_rows")).alias("_before"))
    through = F.col("_before") + F.sum("_n").over(up_to.orderBy("_v"))
    found = inside(wanted).withColumn("_through", through).where(
        F.col("_through") > F.col("_rank")).groupBy(*rank).agg(F.min("_v").alias("_value"))
    lower, upper = F.min_by("_value", "_rank"), F.max_by("_value", "_rank")
    part = F.max("_position") - F.floor(F.max("_position"))
    return found.groupBy(key).agg((lower + (upper - lower) * part).alias(name))
