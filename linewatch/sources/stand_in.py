"""Raw-shaped feeds derived from the given tables.

The test tables hold no rail data, so these rules turn each row of lineitem,
events, orders and customer into a record of a raw feed. They use integer
arithmetic and text building only, cover every row, and yield what the readers
yield: the models run on them unchanged. SQL text keeps each rule on one line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from linewatch.sources import lookups, roads, weather


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(values: list[str], index: str) -> str:
    """values[index], NULL past the end. The split of the constant text is folded by Spark."""
    joined = "|".join(values).replace("'", "\\'")
    return f"try_element_at(split('{joined}', '[|]'), cast({index} + 1 as int))"


def _day(first: str, offset: str) -> str:
    return f"date_add(date'{first}', cast({offset} as int))"


def _clock(minutes: str) -> str:
    """hh:mm:00 of a minute of the day."""
    m = f"({minutes})"
    return f"concat(lpad(string({m} div 60), 2, '0'), ':', lpad(string({m} % 60), 2, '0'), ':00')"


def rdt_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item is one stop of a train (its order) in January to March 2026."""
    stations = lookups.station_codes()
    names = {r["station_code"]: r["station_name"]
             for r in lookups.bundled_rows("station_corridor_mapping")}
    rows = _table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "l_returnflag",
        f"string({_day('2026-01-01', 'l_orderkey % 90')}) as d",
        _clock("(l_orderkey * 7 + l_linenumber * 13) % 1020 + 300") + " as clock",
        "if(l_partkey % 29 <> 0, floor(l_quantity) % 23 - 3, null) as late",
    )
    return rows.selectExpr(
        "string(l_orderkey) as service_rdt_id",
        "d as service_date",
        "case l_returnflag when 'A' then 'Intercity' when 'N' then 'Sprinter' else 'Nachttrein' end"
        " as service_type",
        _pick(lookups.operator_names(), "l_partkey % 27") + " as company",
        "string(l_orderkey % 10000) as train_number",
        "if(l_partkey % 41 <> 0, l_partkey % 37 = 0, null) as completely_cancelled",
        "l_partkey % 11 = 0 as partly_cancelled",
        "greatest(0L, coalesce(late, 0L)) as max_delay",
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey) as stop_rdt_id",
        f"if(l_partkey % 53 = 0, '', {_pick(stations, 'l_suppkey % 14')}) as station_code",
        _pick([names[s] for s in stations], "l_suppkey % 14") + " as station_name",
        "if(l_linenumber > 1, concat(d, 'T', clock, '+01:00'), null) as arrival_time",
        "if(l_linenumber > 1, late, null) as arrival_delay",
        "l_partkey % 43 = 0 as arrival_cancelled",
        "if(l_linenumber < 7, concat(d, 'T', clock, '+01:00'), null) as departure_time",
        "late as departure_delay",
        "l_partkey % 31 = 0 as departure_cancelled",
        "l_partkey % 5 = 0 as platform_change",
        "string(l_orderkey % 12 + 1) as planned_platform",
        "if(l_partkey % 7 <> 0, string((l_orderkey + l_partkey % 5) % 12 + 1), null)"
        " as actual_platform",
        "'rdt_archive' as _source",
        "timestamp'2026-04-02 06:00:00' as _ingested_at",
        "substring(d, 1, 7) as _year_month",
    )


# The event days of January 2024 become the days from 15 March 2026 on.
_MOVED_DAY = _day("2026-03-15", "datediff(ts, date'2024-01-01')")


def ns_departures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is one departure seen in one poll."""
    rows = _table(spark, sf_dir, "events").selectExpr(
        "*", f"{_MOVED_DAY} as d", "hour(ts) - hour(ts) % 6 as planned_hour",
        "floor(value) as v")
    return rows.selectExpr(
        "if(user_id % 50 <> 3, event_type, null) as direction",
        "concat('NS ', user_id) as name",
        "concat(d, 'T', lpad(string(planned_hour), 2, '0'), ':00:00+0100') as plannedDateTime",
        """if(user_id % 43 <> 0, concat(date_format(timestampadd(SECOND,
            cast(v % 40 * 60 - 80 + planned_hour * 3600 as int), cast(d as timestamp_ntz)),
            "yyyy-MM-dd'T'HH:mm:ss"), '+0100'), null) as actualDateTime""",
        "if(user_id % 2 = 0, 'IC', 'SPR') as trainCategory",
        "case event_type when 'error' then true when 'signup' then null else false end"
        " as cancelled",
        "if(user_id % 3 = 0, 'DEPARTED', 'INCOMING') as departureStatus",
        "string(user_id % 12 + 1) as plannedTrack",
        "string((user_id + v) % 12 + 1) as actualTrack",
        f"""concat('{{"number": "', user_id, '", "operatorName": "',
            {_pick(lookups.operator_names(), 'user_id % 26')}, '", "longCategoryName": "',
            if(user_id % 2 = 0, 'Intercity', 'Sprinter'), '"}}') as product""",
        "'[]' as routeStations",
        _pick(lookups.station_codes(), "user_id % 14") + " as _station_code",
        "string(d) as _service_date",
        "'ns_api_v2' as _source",
        "cast(ts as timestamp) as _ingested_at",
    )


CAUSES = ["signal failure", "defective train", "collision", "staff shortage",
          "broken overhead line", "level crossing fault", ""]
CAUSE_GROUPS = {"1-URGENT": "accidents", "2-HIGH": "infrastructure", "3-MEDIUM": "rolling stock",
                "4-NOT SPECIFIED": "", "5-LOW": "weather"}


def rdt_disruptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order is one archived disruption between 2011 and 2026 at one to three stations."""
    stations = lookups.station_codes()
    groups = " ".join(f"when '{p}' then '{g}'" for p, g in CAUSE_GROUPS.items())
    begin = f"concat(d, ' ', {_clock('k % 1440')})"
    rows = _table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as k", "o_custkey as c", "o_orderpriority",
        f"string({_day('2011-01-01', 'o_orderkey * 37 % 5600')}) as d",
        f"""slice(array({_pick(stations, 'o_orderkey % 14')},
            {_pick(stations, '(o_orderkey div 14) % 14')},
            {_pick(stations, '(o_orderkey + o_custkey) % 14')}), 1, cast(o_orderkey % 3 + 1 as int))
            as listed""",
    )
    return rows.selectExpr(
        "string(k) as rdt_id",
        "concat('Line ', k % 9) as ns_lines",
        "concat('Track ', k % 9) as rdt_lines",
        "string(k % 9) as rdt_lines_id",
        "'' as rdt_station_names",
        """case when k % 101 = 0 then null when k % 103 = 0 then ''
            else array_join(listed, if(k % 2 = 0, ',', ', ')) end as rdt_station_codes""",
        "'' as cause_nl",
        _pick(CAUSES, "c % 7") + " as cause_en",
        "'' as statistical_cause_nl",
        f"if(c % 5 <> 0, {_pick(CAUSES, 'c % 6')}, null) as statistical_cause_en",
        f"if(c % 13 <> 0, case o_orderpriority {groups} end, null) as cause_group",
        f"{begin} as start_time",
        f"date_format(timestampadd(MINUTE, cast(k * 7 % 240 as int), "
        f"cast({begin} as timestamp_ntz)), 'yyyy-MM-dd HH:mm:ss') as end_time",
        "if(k % 17 <> 0, k * 7 % 240, null) as duration_minutes",
        "'rdt_archive' as _source",
        "timestamp'2026-04-02 06:00:00' as _ingested_at",
        "substring(d, 1, 4) as _year",
    )


def ns_disruptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order is one live disruption, seen in two polls of the same day."""
    stations = lookups.station_codes()

    def section(*indexes: str) -> str:
        members = ", ".join(
            f"""concat('{{"stationCode":"', {_pick(stations, i)}, '","name":"x"}}')"""
            for i in indexes)
        return f"""concat('{{"section":{{"stations":[', concat_ws(',', {members}), ']}}}}')"""

    cause = f"""concat('{{"cause":{{"label":"', {_pick(CAUSES[:6], 'k % 6')}, '"}}}}')"""
    rows = _table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as k", f"string({_day('2026-01-01', 'o_orderkey % 120')}) as d",
        "explode(array(1, 2)) as poll")
    return rows.selectExpr(
        "concat('D', k) as id",
        "if(k % 3 = 0, 'MAINTENANCE', 'DISRUPTION') as type",
        "concat('Disruption ', k) as title",
        "poll = 1 as isActive",
        "if(k % 4 <> 0, k % 4 = 1, null) as local",
        "concat(d, 'T08:00:00+0100') as start",
        f"concat(d, 'T', {_clock('k % 600 + 480 + poll')}, '+0100') as end",
        "if(k % 11 <> 0, concat(d, 'T07:55:00+0100'), null) as registrationTime",
        """concat('{"value":', k % 5 + 1, '}') as impact""",
        f"""if(k % 19 <> 0, concat('[', {section('k % 14', '(k + 3) % 14')},
            if(poll = 2, concat(',', {section('k % 14', '(k + 5) % 14')}), ''), ']'), null)
            as publicationSections""",
        f"""case k % 7 when 0 then '[{{"period":"all day"}}]'
            when 1 then concat('[{{"period":"morning"}},', {cause}, ']')
            else concat('[', {cause}, ']') end as timespans""",
        "d as _service_date",
        "'ns_api_v3' as _source",
        f"cast(concat(d, ' ', {_clock('poll * 300')}) as timestamp) as _ingested_at",
    )


def weather_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer is one reading in tenths of a unit, at five stations over 120 days."""
    rows = _table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as k", "c_custkey * 7 % 350 - 50 as TG", "c_custkey * 11 % 260 as FG")
    return rows.selectExpr(
        _pick(list(weather.STATION_REGIONS), "k % 5") + " as station_code",
        f"concat({_day('2026-01-01', '(k div 5) % 120')}, 'T00:00:00.000Z') as date",
        "TG", "TG - 30 - k % 20 as TN", "TG + 30 + k % 40 as TX",
        "if(k % 23 <> 0, k % 150 - 1, null) as RH",
        "k % 120 as DR", "FG", "FG + 40 + k % 60 as FHX", "k * 13 % 360 as DDVEC",
    )


def knmi_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather.scaled_readings(
        weather_readings(spark, sf_dir), F.lit("2026-05-02 07:00:00").cast("timestamp"))


def ndw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is one road reading, some of them at locations nobody mapped."""
    return _table(spark, sf_dir, "events").selectExpr(
        f"coalesce({_pick(lookups.road_locations(), 'user_id % 45')}, 'UNMAPPED-1')"
        " as location_id",
        f"""date_format(timestampadd(MINUTE, hour(ts) * 60 + minute(ts) - minute(ts) % 15,
            cast({_MOVED_DAY} as timestamp_ntz)), 'yyyy-MM-dd HH:mm:ss') as measurement_ts""",
        f"string({_MOVED_DAY}) as service_date",
        "value + 20 as avg_speed_kmh",
        "event_id % 50 as vehicle_count",
    )


def ndw_traffic_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = lookups.lookup(spark, "station_ndw_mapping")
    return roads.keep_mapped(ndw_readings(spark, sf_dir), mapping)
