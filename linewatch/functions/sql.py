"""The two reusable expressions as SQL functions, for queries written in SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession


def register(spark: SparkSession) -> None:
    """Temporary functions delay_category(minutes) and date_spine(first, last)."""
    spark.sql("""
        create or replace temporary function delay_category(minutes double) returns string
        return case when minutes <= 1 then 'on_time' when minutes <= 5 then 'minor'
            when minutes <= 15 then 'moderate' else 'severe' end
    """)
    spark.sql("""
        create or replace temporary function date_spine(first_day date, last_day date)
        returns table (date_day date)
        return select explode(sequence(first_day, last_day))
    """)
