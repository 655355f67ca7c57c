"""Writers: landing archive, partition-scoped loads, appends and table materialisation.

Every write partitioned by day asks Spark to REBALANCE by the partition columns. That
groups a partition's rows into few files and, unlike a repartition by the same
columns, lets AQE split a day that holds a large share of the rows over many
tasks and merge the small ones.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

RECORDS_PER_FILE = 200_000
TABLE_ROWS_PER_FILE = 5_000_000
#: Folders that a task of overwrite_periods writes to side by side, with so many bytes held for each.
OPEN_PERIODS, HELD_BYTES = 24, 32 << 20


def _rebalanced(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.hint("rebalance", *columns) if columns else df


def archive_ndjson(
    df: DataFrame, path: str, day: Column | str | None = None,
    records_per_file: int = RECORDS_PER_FILE, mode: str = "overwrite",
) -> None:
    """Newline-delimited JSON, `dt=<day>` folders when a day is given, files of limited length."""
    writer_options = {"maxRecordsPerFile": records_per_file}
    if day is None:
        df.write.mode(mode).options(**writer_options).json(path)
        return
    dated = df.withColumn("dt", F.col(day) if isinstance(day, str) else day)
    (
        _rebalanced(dated, ["dt"]).write.mode(mode)
        .options(partitionOverwriteMode="dynamic", **writer_options)
        .partitionBy("dt").json(path)
    )


def archive_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    writer = df.write.mode("overwrite").options(header=True, quote='"', escape='"')
    if compression:
        writer = writer.option("compression", compression)
    writer.csv(path)


def _partitioned_write(
    df: DataFrame, path: str, partition_by: list[str], cluster_by: list[str], mode: str,
    dynamic: bool,
) -> None:
    prepared = _rebalanced(df, partition_by)
    if cluster_by:
        prepared = prepared.sortWithinPartitions(*partition_by, *cluster_by)
    (
        prepared.write.mode(mode)
        .option("maxRecordsPerFile", TABLE_ROWS_PER_FILE)
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def overwrite_partitions(
    df: DataFrame, path: str, partition_by: list[str], cluster_by: list[str] | None = None,
) -> None:
    """Replace exactly the partitions that occur in df. Running it again changes nothing.

    df must not read from the same path.
    """
    _partitioned_write(df, path, partition_by, cluster_by or [], "overwrite", dynamic=True)


def overwrite_periods(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """overwrite_partitions for months or years, of which a task has rows of a few.

    Rows go straight to their files, so nothing is shuffled or sorted; a period has one file for
    each task with rows of it. Beyond OPEN_PERIODS folders in one task, Spark sorts the rest of it.
    """
    spark, setting = df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting)
    spark.conf.set(setting, OPEN_PERIODS)
    try:
        (
            df.write.mode("overwrite")
            .options(**{"maxRecordsPerFile": TABLE_ROWS_PER_FILE, "partitionOverwriteMode": "dynamic",
                        "parquet.block.size": HELD_BYTES})
            .partitionBy(*partition_by).parquet(path)
        )
    finally:
        spark.conf.set(setting, before)


def append_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Add rows without deleting: the load for days that are polled several times."""
    _partitioned_write(df, path, partition_by, [], "append", dynamic=False)


def write_table(
    df: DataFrame, path: str, partition_by: list[str] | None = None,
    cluster_by: list[str] | None = None,
) -> None:
    """Replace a whole table, optionally partitioned and clustered inside each file."""
    if partition_by:
        _partitioned_write(df, path, partition_by, cluster_by or [], "overwrite", dynamic=False)
        return
    prepared = df.sortWithinPartitions(*cluster_by) if cluster_by else df
    prepared.write.mode("overwrite").option("maxRecordsPerFile", TABLE_ROWS_PER_FILE).parquet(path)


def with_existing_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns and types of an existing table; new fields are left out, missing ones are NULL. Names
    are found without regard to case, as Spark does."""
    held = {c.lower() for c in df.columns}
    return df.select(*[
        (F.col(f"`{f.name}`") if f.name.lower() in held else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema
    ])


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """A table whose later loads may have added fields."""
    return spark.read.option("mergeSchema", True).parquet(path)


def load_csv(
    spark: SparkSession, paths: str | list[str], target: str, schema: T.StructType | None = None,
    partition_field: str = "service_date",
) -> None:
    """CSV with a header into a day-partitioned table, replacing the days it holds.

    The first load takes the given schema or infers one. Later loads take columns by name and
    types from the table, so its days never disagree; new columns are left out, missing ones are
    NULL, and a value that does not fit its type ends the load.
    """
    reader = spark.read.options(header=True, quote='"', escape='"', enforceSchema=False)
    existing = read_if_present(spark, target)
    if existing is not None:
        rows = with_existing_schema(reader.csv(paths), existing.schema)
    elif schema is not None:
        rows = reader.schema(schema).csv(paths)
    else:
        rows = reader.option("inferSchema", True).csv(paths)
    overwrite_partitions(rows, target, [partition_field])


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at path, or None where nothing has been written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}:
            return None
        raise
