from __future__ import annotations

import datetime as dt

from linewatch.functions import sql
from linewatch.plans.models import Models
from tests.conftest import SMALL


def test_functions(spark):
    sql.register(spark)
    labels = spark.sql("select delay_category(1), delay_category(16), delay_category(null)").first()
    assert tuple(labels) == ("on_time", "severe", "severe")
    days = spark.sql("select * from date_spine(date'2026-02-28', date'2026-03-01')").collect()
    assert [r.date_day for r in days] == [dt.date(2026, 2, 28), dt.date(2026, 3, 1)]


def test_models_as_views(spark):
    Models.on_given_tables(spark, SMALL).create_views()
    got = spark.sql("""
        select s.corridor_name, count(*) as departures, round(avg(delay_minutes), 2) as delay
        from int_departures_combined d join dim_stations s using (station_code)
        where service_date between '2026-01-01' and '2026-03-31' group by 1""")
    assert got.count() == 5
    assert spark.sql("select count(*) from dm_multimodal_daily").first()[0] > 0
