"""Small lookup tables: bundled, or read from CSV files the user supplies."""

from __future__ import annotations

import csv
import datetime as dt
import io

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T

from linewatch import schemas
from linewatch.sources import lookup_values

_PARSERS = {T.LongType: int, T.DoubleType: float, T.DateType: dt.date.fromisoformat}
_ARROW = {T.LongType: pa.int64(), T.DoubleType: pa.float64(), T.DateType: pa.date32()}


def bundled_rows(name: str) -> list[dict]:
    text = getattr(lookup_values, name.upper())
    parse = {f.name: _PARSERS.get(type(f.dataType), str) for f in schemas.LOOKUPS[name]}
    return [
        {k: parse[k](v) for k, v in record.items()}
        for record in csv.DictReader(io.StringIO(text))
    ]


def lookup(spark: SparkSession, name: str, folder: str | None = None) -> DataFrame:
    """One lookup table by name.

    With a folder, `<folder>/<name>.csv` is scanned and the file size tells
    Spark whether it may be broadcast. The bundled rows (109 over all five
    tables) become a local relation whose exact size the optimizer knows, so no
    broadcast hint is needed in either case.
    """
    schema = schemas.LOOKUPS[name]
    if folder is not None:
        return spark.read.csv(f"{folder.rstrip('/')}/{name}.csv", schema=schema, header=True)
    rows = bundled_rows(name)
    arrow_schema = pa.schema([(f.name, _ARROW.get(type(f.dataType), pa.string())) for f in schema])
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=arrow_schema))


def station_codes() -> list[str]:
    """The distinct bundled station codes in order."""
    return sorted({r["station_code"] for r in bundled_rows("station_corridor_mapping")})


def operator_names() -> list[str]:
    return [r["operator_name"] for r in bundled_rows("dim_operators")]


def road_locations() -> list[str]:
    return [r["ndw_location_id"] for r in bundled_rows("station_ndw_mapping")]
