"""Tables bucketed and sorted by the key of later joins, with the record that makes them usable.

Spark plans a join of tables with the same buckets without moving rows, but only if the catalog knows
the buckets. The files alone do not say; a session catalog forgets. So the specification lies beside
the rows, and any session can register the table from it.

A bucket is a task of the join. Tables are bucketed after rows were reduced to a few per key and
day (rollups, counts), so that a key with a third of all raw rows is no large bucket.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, types as T

RECORD = "_buckets"
BUCKETS = 16


def write_bucketed(
    df: DataFrame, name: str, path: str, key: str, buckets: int = BUCKETS,
    sort_by: list[str] | None = None,
) -> DataFrame:
    """Replace the table at path by df in buckets of key, one file each, and register it as name."""
    spark = df.sparkSession
    order = [key, *(sort_by or [])]
    spark.sql(f"drop table if exists {name}")
    # rows lie in their bucket before the write, or else every task would write every bucket
    df.repartition(buckets, key).sortWithinPartitions(*order).write.mode("overwrite").bucketBy(
        buckets, key).sortBy(*order).option("path", path).format("parquet").saveAsTable(name)
    record = json.dumps({"schema": df.schema.json(), "key": key, "buckets": buckets, "sort": order})
    spark.createDataFrame([(record,)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{path.rstrip('/')}/{RECORD}")
    return spark.table(name)


def register_bucketed(spark: SparkSession, name: str, path: str) -> DataFrame:
    """The bucketed table at path, known to the catalog of this session under name."""
    text = spark.read.text(f"{path.rstrip('/')}/{RECORD}", wholetext=True).first()[0]
    record = json.loads(text)
    fields = T.StructType.fromJson(json.loads(record["schema"]))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    order = ", ".join(f"`{c}`" for c in record["sort"])
    spark.sql(f"drop table if exists {name}")
    spark.sql(f"create table {name} ({columns}) using parquet clustered by (`{record['key']}`) "
              f"sorted by ({order}) into {record['buckets']} buckets location '{path}'")
    return spark.table(name)


@contextmanager
def co_partitioned(spark: SparkSession) -> Iterator[None]:
    """Plans made and run inside may join tables bucketed by one of several join keys where they
    lie. The setting of the session is put back afterwards."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)
