"""Tables whose loads may bring new fields: a schema record beside the rows says what they hold.

The record is a small text file in a folder of the table that readers of rows pass over. Every
version of it is a folder of its own and the highest complete one counts, so a load that dies
leaves the one before in force.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T

from linewatch.sources import sinks

RECORD = "_schema_record"
#: What a type may become. The Parquet reader takes files with the old type as the new one.
WIDER = {
    "byte": ["short", "integer", "long", "double"], "short": ["integer", "long", "double"],
    "integer": ["long", "double"], "float": ["double"], "date": ["timestamp_ntz"],
}


class IncompatibleField(ValueError):
    """A field came with a type that neither widens to the recorded one nor the other way."""


def widened(known: T.StructType | None, new: T.StructType) -> T.StructType:
    """The known fields in their order, each in the wider of both types, then the new fields.

    A field of which only NULLs are known yet takes any type. All fields may be NULL. Names are
    compared without regard to case, as Spark does.
    """
    arriving = {f.name.lower(): f for f in new}
    fields = []
    for f in known or []:
        other = arriving.pop(f.name.lower(), f)
        old, came = f.dataType.typeName(), other.dataType.typeName()
        if f.dataType == other.dataType or came == "void" or old in WIDER.get(came, ()):
            kind = f.dataType
        elif old == "void" or came in WIDER.get(old, ()):
            kind = other.dataType
        else:
            raise IncompatibleField(
                f"{f.name}: {f.dataType.simpleString()} cannot take {other.dataType.simpleString()}")
        fields.append(T.StructField(f.name, kind))
    fields += [T.StructField(f.name, f.dataType) for f in new if f.name.lower() in arriving]
    return T.StructType(fields)


def _versions(spark: SparkSession, path: str) -> list[int]:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{RECORD}")
    files = folder.getFileSystem(conf)
    if not files.exists(folder):
        return []
    names = [s.getPath() for s in files.listStatus(folder)]
    done = [n.getName() for n in names if files.exists(jvm.org.apache.hadoop.fs.Path(n, "_SUCCESS"))]
    return sorted(int(n) for n in done if n.isdigit())


def recorded_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema of a table by its record; by its files where loads kept no record yet."""
    versions = _versions(spark, path)
    if versions:
        text = spark.read.text(f"{path}/{RECORD}/{versions[-1]}", wholetext=True).first()[0]
        return T.StructType.fromJson(json.loads(text))
    try:
        existing = spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as error:
        if error.getCondition() in {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}:
            return None
        raise
    return existing.schema


def record_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    versions = _versions(spark, path)
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode(
        "overwrite").text(f"{path}/{RECORD}/{(versions or [0])[-1] + 1}")


def append_evolving(df: DataFrame, path: str, partition_by: list[str]) -> T.StructType:
    """Append rows that may have new, missing or narrower fields; returns the schema from then on.

    The record is written before the rows: a load that dies in between has announced a field that no
    row has yet, which reads as NULL. An incompatible field ends the load before anything is written.
    """
    spark = df.sparkSession
    known = recorded_schema(spark, path)
    schema = widened(known, df.schema)
    if schema != known or not _versions(spark, path):
        record_schema(spark, path, schema)
    rows = sinks.with_existing_schema(df, schema)
    # Parquet has no column of a type that is not known yet
    unknown = [f.name for f in schema if f.dataType.typeName() == "void"]
    sinks.append_partitions(rows.drop(*unknown), path, partition_by)
    return schema


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the table under its recorded schema: a field that a file does not have is NULL, a
    narrower value is widened. Files are not opened to find the schema."""
    schema = recorded_schema(spark, path)
    if schema is None:
        raise ValueError(f"{path} holds no table")
    typed = T.StructType([f for f in schema if f.dataType.typeName() != "void"])
    return sinks.with_existing_schema(spark.read.schema(typed).parquet(path), schema)
