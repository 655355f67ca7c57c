"""The DuckDB query for each registered query, with the same column names and rendering."""

from __future__ import annotations

from linewatch import registry as reg
from linewatch.functions import columns as C
from linewatch.operators import quality
from linewatch.plans import change_jobs, network, weather_impact
from oracle.build import assemble, day, rnd, stamp
from oracle.models import CTES

ORACLE: dict[str, str] = {}


def add(name: str, final: str, **more: str) -> None:
    ORACLE[name] = assemble({**CTES, **more}, final)


def days(*columns: str) -> str:
    return ", ".join(f"{day(c)} as {c.split('.')[-1]}" for c in columns)


def r6(*columns: str) -> str:
    return ", ".join(f"{rnd(c, 6)} as {c.split('.')[-1]}" for c in columns)


def between(first: str, last: str) -> str:
    return f"service_date between date '{first}' and date '{last}'"


def share(condition: str, digits: int = 1) -> str:
    return rnd(f"100 * (count(*) filter ({condition}))::double / count(*)", digits)


# Staging --------------------------------------------------------------------------------------

_SERVICE_TEXT = """service_rdt_id, service_type, company, train_number, stop_rdt_id, station_code,
    station_name, planned_platform, actual_platform, completely_cancelled, partly_cancelled,
    arrival_cancelled, departure_cancelled, platform_change, max_delay"""
add("stg_rdt_services", f"""
    select {_SERVICE_TEXT}, {days('service_date')}, {stamp('arrival_ts')} as arrival_ts,
        {stamp('departure_ts')} as departure_ts, arrival_delay as arrival_delay_min,
        departure_delay as departure_delay_min, arrival_delay as arrival_delay_minutes,
        departure_delay as departure_delay_minutes, 'rdt_archive' as data_source,
        stop_rdt_id as departure_id
    from stg_services""")

_ARCHIVE_DISRUPTION = f"""disruption_id, 'Line ' || k % 9 as ns_lines, 'Track ' || k % 9 as rdt_lines,
    '' as station_names, '' as cause_nl, array_to_string(codes, ',') as station_codes_raw,
    cause, statistical_cause, cause_group, {stamp('start_ts')} as start_ts,
    {stamp('end_ts')} as end_ts, duration_minutes, {days('service_date')},
    array_to_string(codes, '|') as affected_station_codes, len(codes) as stations_affected_count"""
add("stg_rdt_disruptions",
    f"select {_ARCHIVE_DISRUPTION}, 'rdt_archive' as data_source from stg_archive_disruptions")
add("disruptions_csv_reload",
    f"select * replace (coalesce(cause, '') as cause,"
    f" coalesce(statistical_cause, '') as statistical_cause,"
    f" coalesce(cause_group, '') as cause_group,"
    f" coalesce(station_codes_raw, '') as station_codes_raw,"
    f" coalesce(affected_station_codes, '') as affected_station_codes,"
    f" coalesce(stations_affected_count, 1) as stations_affected_count)"
    f" from (select {_ARCHIVE_DISRUPTION} from stg_archive_disruptions)")
add("stg_rdt_disruptions_trimmed", """
    select disruption_id,
        array_to_string(list_transform(codes, lambda x: trim(x)), '|') as affected_station_codes,
        len(codes) as stations_affected_count
    from stg_archive_disruptions""")
ORACLE_STG_LIVE = f"""
    select station_code, {days('service_date')}, 'ns_api_v2' as data_source, direction, train_name,
        {stamp('planned_ts')} as planned_departure_ts, {stamp('actual_ts')} as actual_departure_ts,
        train_category, is_cancelled, departure_status, planned_track, actual_track, train_number,
        operator_name, category_long_name, delay_minutes, departure_id
    from stg_live"""
add("stg_ns_departures", ORACLE_STG_LIVE)
add("stg_ns_disruptions", f"""
    select disruption_id, {days('service_date')}, 'ns_api_v3' as data_source, disruption_type,
        'Disruption ' || k as title, false as is_active,
        case when k % 4 <> 0 then k % 4 = 1 end as is_local,
        {stamp('service_date + to_hours(7)')} as start_ts,
        {stamp('service_date + to_minutes(k % 600 + 480 + 2 - 60)')} as end_ts,
        case when k % 11 <> 0 then {stamp('service_date + to_minutes(415)')} end as registration_ts,
        k % 5 + 1 as impact_score, cause, array_to_string(codes, '|') as affected_station_codes,
        len(codes) as stations_affected_count, k % 600 + 2 as duration_minutes
    from stg_live_disruptions""")
ORACLE["disruption_feed_reload"] = ORACLE["stg_ns_disruptions"]
add("recent_departures", ORACLE_STG_LIVE, live_polls=CTES["live_polls"]
    + " and service_date >= date '2026-04-01'")
_WEATHER_MEASURES = ["avg_temp_c", "min_temp_c", "max_temp_c", "precipitation_mm",
                     "precipitation_duration_h", "avg_wind_speed_ms", "max_wind_gust_ms",
                     "avg_wind_speed_kmh", "max_wind_gust_kmh"]
for _name in ("stg_knmi_weather", "weather_ndjson_archive"):
    add(_name, f"""
        select knmi_station_code, station_region, {days('service_date')}, {r6(*_WEATHER_MEASURES)},
            wind_direction_deg, 'knmi' as data_source, is_stormy, is_heavy_rain, is_extreme_heat,
            is_freezing
        from stg_weather""")
add("stg_ndw_traffic_flow", f"""
    select location_id, {stamp('service_date + to_minutes(quarter)')} as measurement_ts,
        {days('service_date')}, {r6('avg_speed_kmh')}, vehicle_count
    from stg_roads""")
add("mapped_road_readings", f"""
    select location_id, {days('service_date')}, count(*) as readings,
        sum(vehicle_count)::bigint as vehicles
    from stg_roads group by location_id, stg_roads.service_date""")

# Intermediate and core ------------------------------------------------------------------------

add("int_departures_combined", f"""
    select departure_id, station_code, {days('service_date')}, direction,
        {stamp('planned_ts')} as planned_departure_ts, {stamp('actual_ts')} as actual_departure_ts,
        delay_minutes, is_cancelled, train_number, train_category, operator_name, data_source
    from departures""")
add("departures_without_archive", f"""
    select departure_id, station_code, {days('service_date')}, delay_minutes,
        'ns_api_v2' as data_source
    from stg_live""")
add("departure_rollup", f"""
    select station_code, operator_name, {days('service_date')}, count(*) as departures,
        count(delay_minutes) as with_delay, sum(delay_minutes)::bigint as delay_sum,
        max(delay_minutes) as delay_max,
        count(*) filter (delay_minutes <= 0) as at_most_0,
        count(*) filter (delay_minutes <= 1) as at_most_1,
        count(*) filter (delay_minutes > 0) as over_0,
        count(*) filter (delay_minutes > 5) as over_5,
        count(*) filter (delay_minutes > 15) as over_15,
        sum(case when delay_minutes < 0 then 0 else delay_minutes end)::bigint as late_sum
    from departures group by station_code, operator_name, departures.service_date""")
add("delay_categories", """
    select case when delay_minutes > 15 or delay_minutes is null then 'severe'
            when delay_minutes > 5 then 'moderate' when delay_minutes > 1 then 'minor'
            else 'on_time' end as category, count(*) as departures
    from departures group by 1""")
_TRAIN_FIGURES = """total_departures, avg_delay_min, max_delay_min, pct_on_time,
    severe_delay_share, disruption_count"""
add("int_train_delays_daily",
    f"select station_code, {days('service_date')}, {_TRAIN_FIGURES} from train_days")
add("int_ndw_traffic_daily", f"""
    select location_id, {days('service_date')}, avg_speed_kmh, total_vehicle_count,
        congestion_minutes
    from road_days""")
add("free_flow_speed", f"""
    select location_id, {rnd('quantile_cont(avg_speed_kmh, 0.85)', 6)} as free_flow_speed_kmh
    from stg_roads group by location_id""")
add("fct_train_performance", f"""
    select station_code, {days('service_date')}, corridor_id, corridor_name, {_TRAIN_FIGURES}
    from f_train""")
add("fct_road_traffic", f"""
    select location_id, {days('service_date')}, corridor_id, avg_speed_kmh, total_vehicle_count,
        congestion_minutes, speed_vs_baseline_pct
    from f_road""")
_CALENDAR = "day_of_week, week_number, month, season, is_holiday, is_weekend"
_TRAIN_MART = "pct_on_time, avg_delay_min, total_departures, disruption_count, severe_delay_share"
_ROAD_MART = """avg_road_speed_kmh, total_vehicle_count, total_congestion_minutes,
    road_speed_vs_baseline_pct"""
_WEATHER_MART = """avg_temp_c, min_temp_c, max_temp_c, precipitation_mm, precipitation_duration_h,
    avg_wind_speed_kmh, max_wind_gust_kmh, is_stormy, is_heavy_rain"""
_MART = f"""corridor_id, corridor_name, {days('service_date')}, {_CALENDAR}, {_TRAIN_MART},
    {_ROAD_MART}, {_WEATHER_MART}"""
add("dm_multimodal_daily", f"select {_MART} from mart")
add("dm_train_only", f"""
    select corridor_id, corridor_name, {days('service_date')}, {_CALENDAR}, {_TRAIN_MART},
        {', '.join(f'null as {c}' for c in (
            *reg.core.ROAD_MART_COLUMNS, *reg.core.WEATHER_MART_COLUMNS))}
    from mart""")
add("dim_stations_in_use", """
    select u.station_code, u.departures, c.station_name, c.corridor_id, c.corridor_name, c.lat,
        c.lon
    from (select station_code, count(*) as departures from departures group by all) u
    left join lk_corridors c using (station_code)""")
add("dim_date_in_use", f"""
    select {day('u.service_date')} as date, u.departures, d.day_of_week, d.week_number, d.month,
        d.season, d.is_holiday, d.is_weekend, d.holiday_name
    from (select service_date, count(*) as departures from departures group by all) u
    left join d_dates d using (service_date)""")
add("dim_ndw_locations_in_use", f"""
    select location_id, u.readings, l.road_name, {r6('l.lat', 'l.lon')}, l.nearest_station_code,
        l.corridor_id, {r6('l.distance_km')}
    from (select location_id, count(*) as readings from stg_roads group by all) u
    left join d_roads l using (location_id)""")

# Network overview -----------------------------------------------------------------------------

_OVERVIEW = ", ".join(
    days(c) if c == "service_date" else c for c in network.OVERVIEW_COLUMNS)
add("network_days", f"select {_OVERVIEW} from mart where {between(reg.FIRST, reg.LAST)}")


def headline(where: str) -> str:
    return f"""
        select sum(total_departures)::bigint as total_departures,
            {rnd('avg(pct_on_time)', 6)} as avg_on_time, {rnd('avg(avg_delay_min)', 6)} as avg_delay,
            sum(disruption_count)::bigint as total_disruptions,
            {day('min(service_date)')} as first_day, {day('max(service_date)')} as last_day
        from mart where {where}"""


add("network_headline", headline(between(reg.FIRST, reg.LAST)))
_WEEK_END = "service_date + cast((7 - dayofweek(service_date)) % 7 as integer)"
for _name, _end in (("weekly", _WEEK_END), ("monthly", "last_day(service_date)")):
    add(f"service_volume_{_name}", f"""
        select {day(_end)} as period_start, corridor_name,
            sum(total_departures)::bigint as total_departures,
            sum(disruption_count)::bigint as disruption_count
        from mart group by 1, 2""")
add("station_stress", """
    select c.station_code, c.station_name, c.corridor_id, c.corridor_name, c.lat, c.lon,
        x.avg_delay_min, x.severe_delay_share
    from lk_corridors c left join (
        from mart where service_date = (select max(service_date) from mart)) x using (corridor_id)
    """)
for _metric in network.CALENDAR_METRICS:
    add(f"reliability_calendar_{_metric}", f"""
        select corridor_name, {days('service_date')}, {rnd(f'avg({_metric})', 6)} as value
        from mart group by corridor_name, mart.service_date""")
add("reliability_calendar_grid", "select corridor_name, " + ", ".join(
    f"{rnd(f'''avg(pct_on_time) filter (service_date = '{d}')''', 6)} as \"{d}\""
    for d in reg.GRID_DAYS) + " from mart group by corridor_name")
_CAUSE_ROWS = {"cause_rows": """
    select service_date, codes, coalesce(cause_group, statistical_cause, cause, 'Unknown')
        as cause_family from stg_archive_disruptions
    union all
    select service_date, codes, coalesce(cause, disruption_type, 'Unknown')
    from stg_live_disruptions"""}
for _name, _start in (("week", "service_date - cast(dayofweek(service_date) as integer)"),
                      ("month", "date_trunc('month', service_date)")):
    add(f"disruption_causes_by_{_name}", f"""
        select {day(_start)} as period_start, cause_family, count(*) as disruption_count
        from cause_rows where {between(reg.HISTORY_FIRST, reg.HISTORY_LAST)} group by 1, 2""",
        **_CAUSE_ROWS)
add("worst_corridor_days", f"""
    select {days('m.service_date')}, corridor_name, avg_delay_min, severe_delay_share,
        disruption_count, total_departures, avg_wind_speed_kmh, precipitation_mm
    from mart m order by avg_delay_min desc nulls last, m.service_date, corridor_name limit 12""")

# Corridor explorer ----------------------------------------------------------------------------

_IN_CORRIDOR = f"corridor_id = {reg.CORRIDOR}"
add("corridors", "select distinct corridor_id, corridor_name from mart")
add("corridor_days", f"select {_MART} from mart where {_IN_CORRIDOR}")
add("corridor_headline", headline(_IN_CORRIDOR))
for _name, _end, _series in (
    ("weekly", _WEEK_END, "generate_series(min(p), max(p), interval 7 days)"),
    ("monthly", "last_day(service_date)",
     "list_transform(generate_series(date_trunc('month', min(p)), max(p), interval 1 month),"
     " lambda x: last_day(x))"),
):
    add(f"corridor_trend_{_name}", f"""
        select {day('s.p')} as period_start,
            coalesce(sum(total_departures), 0)::bigint as total_departures,
            {rnd('avg(avg_delay_min)', 6)} as avg_delay_min,
            coalesce(sum(disruption_count), 0)::bigint as disruption_count,
            {rnd('avg(severe_delay_share)', 6)} as severe_delay_share
        from (select cast(unnest({_series}) as date) as p from one_corridor) s
        left join one_corridor c on c.p = s.p group by s.p""",
        one_corridor=f"select *, {_end} as p from mart where {_IN_CORRIDOR}")
for _name, _dim in (("station_performance", "from lk_corridors"),
                    ("station_performance_once", "select distinct station_code, station_name "
                                                 "from lk_corridors")):
    add(_name, f"""
        select f.station_code, s.station_name, {rnd('avg(avg_delay_min)', 6)} as avg_delay_min,
            {rnd('avg(severe_delay_share)', 6)} as avg_severe_delay_share,
            {rnd('avg(pct_on_time)', 6)} as avg_pct_on_time,
            sum(total_departures)::bigint as total_departures,
            sum(disruption_count)::bigint as total_disruptions
        from f_train f join ({_dim}) s using (station_code)
        where f.{_IN_CORRIDOR} group by all""")
add("operator_mix", f"""
    select coalesce(operator_name, 'Unknown') as operator_name, count(*) as departures,
        {rnd('avg(delay_minutes)', 6)} as avg_delay_min
    from departures where station_code in (
        select station_code from lk_corridors where {_IN_CORRIDOR}) group by 1""")
add("corridor_top_causes", f"""
    select cause_family, count(*) as disruption_count
    from (select cause_family, unnest(codes) as station_code from cause_rows) x
    join lk_corridors c using (station_code) where {_IN_CORRIDOR}
    group by 1 order by 2 desc, 1 limit 12""", **_CAUSE_ROWS)
add("corridor_worst_days", f"""
    select {days('m.service_date')}, avg_delay_min, severe_delay_share, disruption_count,
        total_departures
    from mart m where {_IN_CORRIDOR}
    order by avg_delay_min desc nulls last, m.service_date limit 10""")

# Weather impact -------------------------------------------------------------------------------

add("weather_days", "select " + ", ".join(
    days(c) if c == "service_date" else c for c in weather_impact.WEATHER_DAY_COLUMNS)
    + " from weather_days")
_DAYS = "count(distinct service_date) as days"
_ON_TIME = f"{rnd('avg(pct_on_time)', 6)} as avg_on_time"
_DELAY = f"{rnd('avg(avg_delay_min)', 6)} as avg_delay"
_normal, _rainy, _windy, _heavy, _storm = C.WEATHER_CONDITIONS
add("weather_condition_summary", f"""
    select if(is_stormy, '{_storm}', if(is_heavy_rain, '{_heavy}',
            if(avg_wind_speed_kmh > 40, '{_windy}', if(precipitation_mm > 5, '{_rainy}',
            '{_normal}')))) as weather_condition,
        {_DAYS}, {_ON_TIME}, {_DELAY}, {rnd('avg(severe_delay_share)', 6)} as avg_severe,
        {rnd('avg(disruption_count)', 6)} as avg_disruptions
    from weather_days group by 1""")


def bins(name: str, reading: str, edges: list, labels: list[str], measures: str) -> str:
    rows = ", ".join(
        f"({low}, {high}, '{label}')" for low, high, label in zip(edges, edges[1:], labels))
    return f"""
        select label as {name}, {measures}
        from weather_days join (values {rows}) b(low, high, label)
            on {reading} > low and {reading} <= high
        group by 1"""


add("weather_wind_bins", bins("wind_bin", "avg_wind_speed_kmh", C.WIND_EDGES, C.WIND_LABELS,
                              f"{_DAYS}, {_ON_TIME}, {_DELAY}"))
add("weather_rain_bins", bins("rain_bin", "precipitation_mm", C.RAIN_EDGES, C.RAIN_LABELS,
                              f"{_DAYS}, {_ON_TIME}"))
add("weather_temperature_bins", bins("temp_bin", "avg_temp_c", C.TEMPERATURE_EDGES,
                                     C.TEMPERATURE_LABELS, f"{_DAYS}, {_ON_TIME}"))
add("weather_seasonal_summary", f"""
    select s.season, {_ON_TIME}, {_DELAY}, {rnd('avg(avg_wind_speed_kmh)', 6)} as avg_wind,
        {rnd('avg(precipitation_mm)', 6)} as avg_rain, {rnd('avg(avg_temp_c)', 6)} as avg_temp
    from (select unnest(['winter', 'spring', 'summer', 'autumn']) as season) s
    left join weather_days w using (season) group by 1""")
add("weather_wind_sensitivity", f"""
    select corridor_name, avg_wind_speed_kmh > 30 as is_windy, {_ON_TIME}, {_DAYS},
        if(avg_wind_speed_kmh > 30, 'Windy (>30 km/h)', 'Calm (<30 km/h)') as condition
    from weather_days group by 1, 2, 5""")
for _pair, (_reading, _outcome) in weather_impact.SCATTER_PAIRS.items():
    add(f"weather_scatter_{_pair}",
        f"select corridor_name, {days('service_date')}, {_reading}, {_outcome} from weather_days")

# System and operators -------------------------------------------------------------------------

_MEAN = f"{rnd('avg(delay_minutes)', 2)} as avg_delay_min"
_COUNT = "count(*) as departures"
_PUNCTUAL = f"{share('delay_minutes <= 0')} as pct_on_time"
_MONTH = "strftime(service_date, '%Y-%m') as month"
add("system_figures", f"""
    select count(*) as total_departures, count(distinct station_code) as active_stations,
        count(distinct operator_name) as operators, count(distinct service_date) as service_days,
        {_MEAN}, {share('delay_minutes > 0')} as pct_delayed
    from departures where {between(reg.FIRST, reg.LAST)}""")
add("operator_profiles", f"""
    select o.*, x.* exclude (operator_name) from lk_operators o join (
        select operator_name, {_COUNT}, {_MEAN}, {_PUNCTUAL} from departures group by 1) x
        using (operator_name)""")
for _name, _top, _where in (
    ("monthly_departures", 8, "operator_name is not null"),
    ("monthly_departures_selected", 3, "operator_name in ("
     + ", ".join(f"'{o}'" for o in reg.SELECTED_OPERATORS) + ")"),
):
    add(_name, f"""
        select {_MONTH}, if(operator_name in (
                select operator_name from departures where {_where} group by 1
                order by count(*) desc, 1 limit {_top}), operator_name, 'Other') as operator,
            {_COUNT}
        from departures where {_where} group by 1, 2""")
add("operator_ranking", f"""
    select operator_name, {_COUNT}, {_MEAN}, {_PUNCTUAL},
        {share('delay_minutes > 5')} as pct_over_5min,
        {share('delay_minutes > 15')} as pct_over_15min
    from departures where operator_name is not null group by 1 having count(*) >= 1000""")
add("busiest_stations", f"""
    select station_code, coalesce(min(n.station_name), station_code) as station_name, {_COUNT},
        count(distinct operator_name) as operators, {_MEAN}, {_PUNCTUAL}
    from departures left join (
        select station_code, min(station_name) as station_name from stg_services group by 1) n
        using (station_code)
    group by 1 order by departures desc, 1 limit 25""")
add("station_names", """
    select station_code, min(station_name) as station_name from stg_services
    where station_name <> '' group by 1""")
for _name, _where in (("network_scale", "true"), ("network_scale_selected", "station_code in ("
                       + ", ".join(f"'{s}'" for s in reg.SELECTED_STATIONS) + ")")):
    add(_name, f"""
        select {_MONTH}, count(distinct station_code) as active_stations,
            count(distinct operator_name) as active_operators, {_COUNT}, {_MEAN}
        from departures where {_where} group by 1""")
_YEAR = "year(service_date) as year"
add("disruptions_by_year", f"""
    select {_YEAR}, count(*) as total_disruptions, {rnd('avg(duration_minutes)', 0)}
        as avg_duration_min, count(*) filter (duration_minutes > 120) as long_disruptions
    from stg_archive_disruptions group by 1""")
add("disruption_causes_by_year", f"""
    select {_YEAR}, cause_group, count(*) as disruptions from stg_archive_disruptions
    where cause_group <> '' group by 1, 2""")
add("disruption_cause_totals", """
    select cause_group, count(*) as disruptions from stg_archive_disruptions
    where cause_group <> '' group by 1""")
_ATTRIBUTION = {"attribution": f"""
    select operator_name, {_COUNT},
        sum(case when delay_minutes < 0 then 0 else delay_minutes end)::bigint as total_delay_min,
        {rnd('avg(delay_minutes) filter (delay_minutes > 0)', 2)} as avg_delay_when_late
    from departures where operator_name is not null group by 1 having count(*) >= 1000"""}
add("delay_attribution", "select * from attribution", **_ATTRIBUTION)
add("delay_attribution_shares",
    "select * from attribution order by total_delay_min desc nulls last, operator_name limit 10",
    **_ATTRIBUTION)

# Alerts and checks ----------------------------------------------------------------------------

_FIRED = {"fired_alerts": f"""
    select * from (
        select corridor_id, corridor_name, service_date, pct_on_time, avg(pct_on_time) over (
            partition by corridor_id order by service_date
            range between interval 7 days preceding and current row) as avg_7d_pct_on_time
        from mart)
    where pct_on_time < {reg.ALERT_ON_TIME}
        and avg_7d_pct_on_time - pct_on_time > {reg.ALERT_DEVIATION}"""}
add("reliability_alerts", f"""
    select corridor_id, corridor_name, pct_on_time, {r6('avg_7d_pct_on_time')}
    from fired_alerts where service_date = date '{reg.ALERT_DAY}'""", **_FIRED)
add("reliability_alerts_all_days", f"""
    select corridor_id, corridor_name, {days('service_date')}, pct_on_time,
        {r6('avg_7d_pct_on_time')}
    from fired_alerts""", **_FIRED)
_RECORD = f"""sha256(service_date || '|reliability|' || corridor_name) as alert_id,
    {days('service_date')}, 'reliability' as alert_type, corridor_name as corridor,
    pct_on_time as metric_value, {rnd('avg_7d_pct_on_time', 6)} as recent_mean,
    {reg.ALERT_ON_TIME}::double as threshold, true as fired"""
add("alert_records", f"""
    select {_RECORD}, '2026-05-01 08:00:00' as check_ts from fired_alerts""", **_FIRED)
add("alert_history", f"select {_RECORD} from fired_alerts", **_FIRED)


def _quality_rows() -> str:
    """Checked columns map to a column here; a text constant stands for one never missing."""
    sources = {
        "ns_disruptions": ("orders", {"id": "o_orderkey", "_service_date": "o_orderkey"}),
        "ns_departures": ("raw_polls", {"_service_date": "service_date",
                                        "_station_code": "station_code"}),
        "rdt_services": ("raw_services", {}),
        "rdt_disruptions": ("orders", {"rdt_id": "o_orderkey", "start_time": "o_orderkey"}),
        "ndw_traffic_flow": ("stg_roads", {}),
        "knmi_weather": ("stg_weather", {"station_code": "knmi_station_code"}),
        "stg_ns_disruptions": ("stg_live_disruptions", {}),
        "stg_ns_departures": ("stg_live", {}),
        "stg_rdt_services": ("stg_services", {"departure_id": "stop_rdt_id"}),
        "stg_rdt_disruptions": ("stg_archive_disruptions", {}),
        "stg_ndw_traffic_flow": ("stg_roads", {"measurement_ts": "quarter"}),
        "int_train_delays_daily": ("train_days", {}),
        "int_ndw_traffic_daily": ("road_days", {}),
        "dim_stations": ("lk_corridors", {}),
        "dim_date": ("d_dates", {"date": "service_date"}),
        "dim_ndw_locations": ("d_roads", {}),
        "fct_train_performance": ("f_train", {}),
        "fct_road_traffic": ("f_road", {}),
        "dm_multimodal_daily": ("mart", {}),
    }
    rows = []
    for table, (source, names) in sources.items():
        for column in quality.NOT_NULL[table]:
            rows.append(f"select 'not_null' as \"check\", '{table}' as \"table\", '{column}' as "
                        f"\"column\", count(*) filter ({names.get(column, column)} is null) "
                        f"as failures from {source}")
        for column in quality.UNIQUE.get(table, []):
            c = names.get(column, column)
            rows.append(f"select 'unique', '{table}', '{column}', count(*) from (select {c} from "
                        f"{source} where {c} is not null group by 1 having count(*) > 1)")
    rows.append("select 'range', 'fct_train_performance', 'pct_on_time', count(*) from f_train "
                "where pct_on_time not between 0 and 100")
    return " union all ".join(rows)


add("quality_report", f"select *, failures = 0 as passed from ({_quality_rows()})")
add("pct_on_time_violations", f"""
    select station_code, {days('service_date')}, pct_on_time from f_train
    where pct_on_time not between 0 and 100""")
add("feed_freshness", f"""
    select feed, {stamp('newest')} as newest, {r6('age_hours')},
        if(age_hours <= 36, 'pass', if(age_hours <= 48, 'warn', 'error')) as status
    from (
        select *, date_sub('second', newest, now_ts) / 3600.0::double as age_hours from (
            select 'ns_departures' as feed, max(ts) as newest,
                timestamp '{reg.FRESHNESS_NOW}' as now_ts from raw_polls
            union all
            select 'ns_disruptions', max(service_date) + to_hours(10),
                timestamp '2026-05-02 08:00:00' from stg_live_disruptions
            union all
            select 'ndw_traffic_flow', max(service_date + to_minutes(quarter)),
                timestamp '2026-04-16 08:00:00' from stg_roads))""")

# Loads and maintenance ------------------------------------------------------------------------

_STAMP_TEXT = "strftime({0} + to_hours(1), '%Y-%m-%dT%H:%M:%S+01:00') as {1}"
add("services_csv_reload", f"""
    select service_rdt_id, {days('service_date')}, service_type, coalesce(company, '') as company,
        train_number, completely_cancelled, partly_cancelled, max_delay, stop_rdt_id,
        station_code, station_name, {_STAMP_TEXT.format('arrival_ts', 'arrival_time')},
        arrival_delay, arrival_cancelled,
        {_STAMP_TEXT.format('departure_ts', 'departure_time')}, departure_delay,
        departure_cancelled, platform_change, planned_platform, actual_platform,
        'rdt_archive' as _source, '2026-03' as _year_month
    from raw_services""")
add("partition_overwrite", f"""
    select {days('r.service_date')}, count(*) as readings,
        sum(vehicle_count + if(r.service_date >= date '2026-04-01', 1000, 0))::bigint as vehicles
    from stg_roads r group by r.service_date""")
add("services_backfill", f"""
    select strftime(service_date, '%Y-%m') as month,
        if(month(service_date) = 2, '2026-02', '2026') as period, count(*) as stops,
        sum(max_delay)::bigint as delay, count(distinct station_code) as stations
    from raw_services where month(service_date) <> 2 or not platform_change
    group by 1, 2""")
ORACLE["road_csv_load"] = ORACLE["stg_ndw_traffic_flow"]
ORACLE["daily_refresh"] = ORACLE["refresh_by_days"] = ORACLE["dm_multimodal_daily"]
ORACLE["road_facts_by_days"] = ORACLE["fct_road_traffic"]
_ORDER_ALERTS = """
    select corridor_name, pct_on_time from (
        select *, avg(pct_on_time) over (partition by corridor_id order by service_date
            range between interval 7 days preceding and current row) as recent from mart)
    where service_date = date '{day}' and pct_on_time < 80 and recent - pct_on_time > 10"""
add("daily_order", f"""
    select 'check' as step, "check" || ' ' || "table" || ' ' || "column" as item,
        failures::double as figure from ({_quality_rows()})
    union all
    select 'freshness', feed || ' ' || if(age <= 36, 'pass', if(age <= 48, 'warn', 'error')),
        {rnd('age', 6)} from (
        select feed, date_sub('second', newest, timestamp '{change_jobs.ORDER_NOW}') / 3600.0::double
            as age from (
            select 'ns_departures' as feed, max(ts) as newest from raw_polls
            union all
            select 'ns_disruptions', max(service_date) + to_hours(10) from stg_live_disruptions))
    union all
    select 'alert', corridor_name, pct_on_time from ({_ORDER_ALERTS.format(day=change_jobs.ORDER_DAY)})
    union all
    select 'history', station_code || ' ' || corridor_id, 1 from lk_corridors""")
ORACLE["free_flow_by_loads"] = ORACLE["free_flow_speed"]
ORACLE["bucketed_train_facts"] = ORACLE["fct_train_performance"]
ORACLE["bucketed_road_facts"] = ORACLE["fct_road_traffic"]
add("archive_rejects", """
    select 'accepted' as outcome, strftime(service_date, '%Y-%m') as item, count(*) as rows,
        sum(max_delay)::bigint as figure from archive_lines where fields = 20 group by 2
    union all
    select 'rejected', if(fields = 21, 'too many fields', 'too few fields'), count(*),
        sum(fields)::bigint from archive_lines where fields <> 20 group by 2
    union all
    select 'load', 'accepted and rejected', count(*) filter (fields = 20),
        count(*) filter (fields <> 20) from archive_lines""", archive_lines="""
    select *, if(p % 97 = 0, 21, if(p % 89 = 0, 18, 20)) as fields
    from (select *, cast(split_part(stop_rdt_id, '-', 3) as bigint) as p from raw_services)""")
add("evolving_polls", f"""
    select {days('p.service_date')}, count(*) as polls,
        count(*) filter (hour(ts) between 8 and 15) as with_crowding,
        count(*) filter (hour(ts) < 16) as with_age,
        sum(case when hour(ts) < 8 then minute(ts) * 60
            when hour(ts) < 16 then minute(ts) * 60 + 5000000000 end)::bigint as age_seconds,
        17::bigint as fields
    from raw_polls p group by p.service_date""".replace("as service_date", "as _service_date"))
add("weather_backfill", f"""
    select 'readings' as item, station_code, {day('min(service_date)')} as first_day,
        {day('max(service_date)')} as last_day, count(*) as n, {rnd('sum(avg_temp_c)', 6)} as figure
    from weather_loaded group by station_code
    union all
    select 'gap', station_code, {day('min(service_date)')}, {day('max(service_date)')}, count(*), null
    from weather_runs group by station_code, run""", weather_loaded="""
    select knmi_station_code as station_code, service_date,
        if(service_date < date '2026-02-10', avg_temp_c + 10, avg_temp_c) as avg_temp_c
    from raw_weather
    where service_date < date '2026-02-10' or knmi_station_code not in ('240', '344')
        or service_date not between date '2026-03-01' and date '2026-03-04'""", weather_missing="""
    select s.station_code, cast(g.d as date) as service_date
    from (select distinct station_code from weather_loaded where station_code is not null) s,
        generate_series(timestamp '2026-02-10', timestamp '2026-04-30', interval 1 day) g(d)
    anti join weather_loaded l
        on l.station_code = s.station_code and l.service_date = cast(g.d as date)""", weather_runs="""
    select *, service_date - cast(row_number() over (
        partition by station_code order by service_date) as integer) as run from weather_missing""")


def _distinct_values() -> str:
    kinds = {"station": ("station_code", "departures"), "operator": ("operator_name", "departures"),
             "train": ("train_number", "departures"), "disruption": ("disruption_id", "disruption_days")}
    return " union all ".join(
        f"select '{name}' as range, '{kind}' as kind, count(distinct {column}) as distinct_count "
        f"from {source} where service_date between date '{first}' and date '{last}' "
        f"having count({column}) > 0"
        for name, (first, last) in change_jobs.DISTINCT_RANGES.items()
        for kind, (column, source) in kinds.items())


add("distinct_values", _distinct_values(), disruption_days="""
    select disruption_id, service_date from stg_live_disruptions
    union all select disruption_id, service_date from stg_archive_disruptions""")
add("rolling_delay_stream", f"""
    select {stamp('window_start')} as window_start, {day('window_start')} as service_date,
        station_code, direction, count(*) as polls,
        {rnd('avg(delay)', 2)} as avg_delay_min, max(delay) as max_delay_min
    from (
        select *, time_bucket(interval 5 minutes, planned_ts) - to_minutes(5 * n) as window_start,
            date_sub('minute', planned_ts, actual_ts) as delay
        from live_polls, range(3) g(n))
    group by window_start, station_code, direction""")
add("cascading_delays", f"""
    select service_rdt_id, {days('service_date')}, max(train_number) as train_number,
        arg_min(station_code, stop_order) as first_station,
        arg_max(station_code, stop_order) as last_station, count(*) as stations,
        min(delay) as first_delay, max(delay) as last_delay
    from cascade_islands group by service_rdt_id, service_date, island having count(*) >= 3""",
    cascade_stops="""
    select *, row_number() over (partition by service_rdt_id, service_date
            order by coalesce(departure_ts, arrival_ts), stop_rdt_id,
                coalesce(departure_delay, arrival_delay) nulls first, station_code) as stop_order,
        coalesce(departure_delay, arrival_delay) as delay
    from stg_services where coalesce(departure_ts, arrival_ts) is not null""", cascade_islands="""
    select *, sum(fresh::int) over (partition by service_rdt_id, service_date order by stop_order)
        as island
    from (select *, not coalesce(delay > lag(delay) over (
            partition by service_rdt_id, service_date order by stop_order), false) as fresh
        from cascade_stops)""")
_PHASES = ("before", "during", "after")
add("disruption_road_impact", f"""
    select * exclude (start_ts, end_ts), {stamp('start_ts')} as start_ts, {stamp('end_ts')} as end_ts,
        {rnd('avg_speed_during - avg_speed_before', 2)} as speed_change_kmh
    from impact_figures""", impact_disruptions="""
    select disruption_id, codes, start_ts, end_ts from stg_archive_disruptions
    union all
    select disruption_id, codes, service_date + to_hours(7),
        service_date + to_minutes(k % 600 + 480 + 2 - 60) from stg_live_disruptions""",
    impact_windows="""
    select distinct d.disruption_id, d.start_ts, greatest(d.end_ts, d.start_ts) as end_ts,
        l.location_id
    from (select disruption_id, start_ts, end_ts, unnest(codes) as station_code
        from impact_disruptions) d
    join d_roads l on l.nearest_station_code = d.station_code""", impact_met="""
    select w.*, r.avg_speed_kmh, r.vehicle_count,
        case when r.at < w.start_ts then 'before' when r.at < w.end_ts then 'during'
            else 'after' end as phase
    from impact_windows w join (
        select *, service_date + to_minutes(quarter) as at from stg_roads) r
    on r.location_id = w.location_id and r.at >= w.start_ts - to_hours(2)
        and r.at < w.end_ts + to_hours(2)""", impact_figures="select disruption_id, start_ts, end_ts, "
    + ", ".join(
        f"{rnd(f"avg(avg_speed_kmh) filter (phase = '{p}')", 2)} as avg_speed_{p}, "
        f"sum(vehicle_count) filter (phase = '{p}')::bigint as vehicles_{p}, "
        f"count(*) filter (phase = '{p}') as readings_{p}" for p in _PHASES)
    + " from impact_met group by disruption_id, start_ts, end_ts")
add("csv_table_load", f"""
    select {days('r.service_date')}, count(*) as readings,
        if(r.service_date >= date '2026-04-01', 0, count(*)) as speeds,
        sum(vehicle_count)::bigint as vehicles, 5::bigint as fields
    from raw_roads r group by r.service_date""")
add("poll_appends", f"""
    select departure_id, station_code, {days('service_date')}, train_number, delay_minutes
    from stg_live""")
ORACLE["poll_stream_latest"] = ORACLE["poll_appends"]
add("poll_stream", f"""
    select {day('p.service_date')} as _service_date, station_code as _station_code,
        count(*) as polled, count(*) filter (event_type = 'error') as cancelled,
        count(distinct direction) as directions
    from raw_polls p group by p.service_date, station_code""")
add("incremental_upsert", f"""
    select station_code, corridor_id, {days('f.service_date')},
        total_departures + if(f.service_date between date '2026-03-29' and date '2026-03-31'
            and station_code <> 'UT', 1, 0) as total_departures, pct_on_time
    from f_train f""")
add("snapshot_history", """
    with versions as (
        select c_custkey, c_nationkey, c_mktsegment, c_nationkey = 7 as late, c_acctbal < 1000 as
            moved from customer)
    select c_custkey, c_nationkey, c_mktsegment, '2026-01-01' as valid_from,
        if(moved, '2026-02-01', null) as valid_to from versions where not late
    union all
    select c_custkey, c_nationkey, if(moved, null, c_mktsegment), '2026-02-01', null
    from versions where late or moved""")
