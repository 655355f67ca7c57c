"""Joins that keep a key with a large share of the rows from ending up in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

SALTS = 256


def join_per_key(
    rows: DataFrame, per_key: DataFrame, key: str, how: str, spread_by: list[str],
    salts: int = SALTS,
) -> DataFrame:
    """Join rows with a table that has one row per key, every key spread over many tasks.

    AQE would leave a hot key whole here: when an aggregation by the key and
    more columns follows, it reuses the partitioning by the key, and splitting
    the key would cost another shuffle. So the key is salted: a hash of other
    columns of the row picks one of the copies of the per-key table. It is the
    same on every attempt of a task. A per-key table that turns out small is
    still broadcast by AQE. Rows without a key match nothing.
    """
    salted = rows.withColumn(
        "_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    copies = per_key.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [key, "_salt"], how).drop("_salt")
