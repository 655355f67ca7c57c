"""DuckDB side of the feeds, models and reports, written against the given tables."""

from __future__ import annotations

from linewatch.sources import lookups, weather
from linewatch.sources.stand_in import CAUSES, CAUSE_GROUPS
from oracle.build import pick, rnd, values_table

STATIONS = lookups.station_codes()
NAMES = {r["station_code"]: r["station_name"]
         for r in lookups.bundled_rows("station_corridor_mapping")}
OPERATORS = lookups.operator_names()
_HALF_TYPES = {"station_code": "varchar", "station_name": "varchar"}

CTES: dict[str, str] = {}

CTES["lk_corridors"] = values_table(
    lookups.bundled_rows("station_corridor_mapping"),
    {**_HALF_TYPES, "corridor_id": "bigint", "corridor_name": "varchar",
     "lat": "double", "lon": "double"})
CTES["lk_roads"] = values_table(
    lookups.bundled_rows("station_ndw_mapping"),
    {**_HALF_TYPES, "ndw_location_id": "varchar", "road_name": "varchar", "ndw_lat": "double",
     "ndw_lon": "double", "distance_km": "double"})
CTES["lk_weather"] = values_table(
    lookups.bundled_rows("knmi_corridor_mapping"),
    {"knmi_station_code": "varchar", "corridor_id": "bigint"})
CTES["lk_holidays"] = values_table(
    lookups.bundled_rows("nl_holidays"), {"date": "date", "holiday_name": "varchar"})
CTES["lk_operators"] = values_table(
    lookups.bundled_rows("dim_operators"),
    {c: "varchar" for c in ("operator_name", "full_name", "country", "operator_type",
                            "description")})

# --- feeds -----------------------------------------------------------------------------------

CTES["line_stops"] = f"""
    select *, l_orderkey as o, l_partkey as p, l_linenumber as n,
        date '2026-01-01' + cast(l_orderkey % 90 as integer) as d,
        (l_orderkey * 7 + l_linenumber * 13) % 1020 + 300 as minute_of_day,
        case when l_partkey % 29 <> 0 then cast(floor(l_quantity) as bigint) % 23 - 3 end as late
    from lineitem"""

CTES["raw_services"] = f"""
    select cast(o as varchar) as service_rdt_id, d as service_date,
        case l_returnflag when 'A' then 'Intercity' when 'N' then 'Sprinter'
            else 'Nachttrein' end as service_type,
        {pick(OPERATORS, 'p % 27')} as company,
        cast(o % 10000 as varchar) as train_number,
        case when p % 41 <> 0 then p % 37 = 0 end as completely_cancelled,
        p % 11 = 0 as partly_cancelled,
        greatest(0, coalesce(late, 0)) as max_delay,
        o || '-' || n || '-' || p as stop_rdt_id,
        case when p % 53 = 0 then '' else {pick(STATIONS, 'l_suppkey % 14')} end as station_code,
        {pick([NAMES[s] for s in STATIONS], 'l_suppkey % 14')} as station_name,
        case when n > 1 then d + to_minutes(minute_of_day - 60) end as arrival_ts,
        case when n > 1 then late end as arrival_delay,
        p % 43 = 0 as arrival_cancelled,
        case when n < 7 then d + to_minutes(minute_of_day - 60) end as departure_ts,
        late as departure_delay,
        p % 31 = 0 as departure_cancelled,
        p % 5 = 0 as platform_change,
        cast(o % 12 + 1 as varchar) as planned_platform,
        case when p % 7 <> 0 then cast((o + p % 5) % 12 + 1 as varchar) end as actual_platform
    from line_stops"""

CTES["raw_polls"] = f"""
    select case when user_id % 50 <> 3 then event_type end as direction,
        'NS ' || user_id as train_name,
        date '2026-03-15' + cast(cast(ts as date) - date '2024-01-01' as integer) as service_date,
        hour(ts) - hour(ts) % 6 as planned_hour,
        cast(floor(value) as bigint) as v, user_id, event_type, ts,
        {pick(STATIONS, 'user_id % 14')} as station_code,
        {pick(OPERATORS, 'user_id % 26')} as operator_name
    from events"""

CTES["order_causes"] = f"""
    select o_orderkey as k, o_custkey as c,
        date '2011-01-01' + cast(o_orderkey * 37 % 5600 as integer) as d,
        case when o_orderkey % 17 <> 0 then o_orderkey * 7 % 240 end as duration_minutes,
        {pick(CAUSES, 'o_custkey % 7')} as cause,
        case when o_custkey % 5 <> 0 then {pick(CAUSES, 'o_custkey % 6')} end as statistical_cause,
        case when o_custkey % 13 <> 0 then case o_orderpriority
            {' '.join(f"when '{k}' then '{v}'" for k, v in CAUSE_GROUPS.items())} end
        end as cause_group,
        {pick(STATIONS, 'o_orderkey % 14')} as s1,
        {pick(STATIONS, '(o_orderkey // 14) % 14')} as s2,
        {pick(STATIONS, '(o_orderkey + o_custkey) % 14')} as s3
    from orders"""

# --- staging ---------------------------------------------------------------------------------

CTES["stg_services"] = "select * from raw_services where station_code <> ''"

CTES["stg_archive_disruptions"] = """
    select cast(k as varchar) as disruption_id, d as service_date, cause, statistical_cause,
        cause_group, duration_minutes, k,
        d + to_minutes(k % 1440) as start_ts,
        d + to_minutes(k % 1440 + k * 7 % 240) as end_ts,
        case when k % 101 = 0 then null when k % 103 = 0 then ['']
            when k % 2 = 0 then [s1, s2, s3][1:k % 3 + 1]
            else list_transform([s1, ' ' || s2, ' ' || s3][1:k % 3 + 1], lambda x: x)
        end as codes
    from order_causes"""

CTES["live_polls"] = """
    select *, service_date + to_hours(planned_hour - 1) as planned_ts,
        case when user_id % 43 <> 0 then
            service_date + to_hours(planned_hour - 1) + to_seconds(v % 40 * 60 - 80)
        end as actual_ts,
        station_code || '_' || service_date || '_' || service_date || 'T'
            || lpad(cast(planned_hour as varchar), 2, '0') || ':00:00+0100_' || direction
            as departure_id
    from raw_polls where event_type <> 'error'"""

CTES["stg_live"] = """
    select station_code, service_date, direction, train_name, planned_ts, actual_ts,
        case when user_id % 2 = 0 then 'IC' else 'SPR' end as train_category,
        case when event_type = 'signup' then null else false end as is_cancelled,
        case when user_id % 3 = 0 then 'DEPARTED' else 'INCOMING' end as departure_status,
        cast(user_id % 12 + 1 as varchar) as planned_track,
        cast((user_id + v) % 12 + 1 as varchar) as actual_track,
        cast(user_id as varchar) as train_number, operator_name,
        case when user_id % 2 = 0 then 'Intercity' else 'Sprinter' end as category_long_name,
        date_sub('minute', planned_ts, actual_ts) as delay_minutes, departure_id
    from live_polls
    qualify row_number() over (partition by departure_id
        order by ts desc nulls last, actual_ts desc nulls last, planned_ts desc nulls last,
            cast(user_id as varchar) desc, station_code desc nulls last,
            service_date desc nulls last, operator_name desc nulls last,
            train_name desc nulls last) = 1"""

CTES["stg_live_disruptions"] = f"""
    select 'D' || o_orderkey as disruption_id,
        date '2026-01-01' + cast(o_orderkey % 120 as integer) as service_date, o_orderkey as k,
        case when o_orderkey % 3 = 0 then 'MAINTENANCE' else 'DISRUPTION' end as disruption_type,
        case when o_orderkey % 7 <> 0 then {pick(CAUSES[:6], 'o_orderkey % 6')} end as cause,
        case when o_orderkey % 19 = 0 then []::varchar[] else list_sort(list_distinct([
            {pick(STATIONS, 'o_orderkey % 14')}, {pick(STATIONS, '(o_orderkey + 3) % 14')},
            {pick(STATIONS, '(o_orderkey + 5) % 14')}])) end as codes
    from orders"""

CTES["raw_weather"] = f"""
    select {pick(list(weather.STATION_REGIONS), 'c_custkey % 5')} as knmi_station_code,
        {pick(list(weather.STATION_REGIONS.values()), 'c_custkey % 5')} as station_region,
        date '2026-01-01' + cast((c_custkey // 5) % 120 as integer) as service_date,
        (c_custkey * 7 % 350 - 50) / 10.0::double as avg_temp_c,
        (c_custkey * 7 % 350 - 80 - c_custkey % 20) / 10.0::double as min_temp_c,
        (c_custkey * 7 % 350 - 20 + c_custkey % 40) / 10.0::double as max_temp_c,
        case when c_custkey % 23 <> 0 then greatest(c_custkey % 150 - 1, 0) / 10.0::double end
            as precipitation_mm,
        (c_custkey % 120) / 10.0::double as precipitation_duration_h,
        (c_custkey * 11 % 260) / 10.0::double as avg_wind_speed_ms,
        (c_custkey * 11 % 260 + 40 + c_custkey % 60) / 10.0::double as max_wind_gust_ms,
        c_custkey * 13 % 360 as wind_direction_deg
    from customer"""

CTES["stg_weather"] = f"""
    select *, {rnd('avg_wind_speed_ms * 3.6::double', 1)} as avg_wind_speed_kmh,
        {rnd('max_wind_gust_ms * 3.6::double', 1)} as max_wind_gust_kmh,
        avg_wind_speed_ms > 20.8 as is_stormy, precipitation_mm > 10 as is_heavy_rain,
        max_temp_c > 35 as is_extreme_heat, min_temp_c < -5 as is_freezing
    from raw_weather"""

CTES["raw_roads"] = f"""
    select coalesce({pick(lookups.road_locations(), 'user_id % 45')}, 'UNMAPPED-1') as location_id,
        date '2026-03-15' + cast(cast(ts as date) - date '2024-01-01' as integer) as service_date,
        hour(ts) * 60 + minute(ts) - minute(ts) % 15 as quarter,
        value + 20 as avg_speed_kmh, event_id % 50 as vehicle_count
    from events"""

CTES["stg_roads"] = """
    select * from raw_roads where location_id in (select ndw_location_id from lk_roads)"""

# --- intermediate ----------------------------------------------------------------------------

CTES["archive_departures"] = """
    select stop_rdt_id as departure_id, station_code, service_date, null::varchar as direction,
        departure_ts as planned_ts,
        departure_ts + to_minutes(coalesce(departure_delay, 0)) as actual_ts,
        departure_delay as delay_minutes,
        coalesce(completely_cancelled, departure_cancelled) as is_cancelled, train_number,
        service_type as train_category, company as operator_name, 'rdt_archive' as data_source
    from stg_services where departure_ts is not null"""

CTES["departures"] = """
    select * from archive_departures
    union all
    select departure_id, station_code, service_date, direction, planned_ts, actual_ts,
        delay_minutes, is_cancelled, train_number, train_category, operator_name, 'ns_api_v2'
    from stg_live where service_date not in (select service_date from archive_departures)"""

CTES["named_disruptions"] = """
    select disruption_id, service_date, unnest(codes) as station_code
    from stg_archive_disruptions
    union all
    select disruption_id, service_date, unnest(codes) from stg_live_disruptions"""

CTES["train_days"] = f"""
    select s.*, coalesce(x.disruption_count, 0) as disruption_count from (
        select station_code, service_date, count(*) as total_departures,
            {rnd('avg(delay_minutes)', 2)} as avg_delay_min,
            max(delay_minutes)::double as max_delay_min,
            {rnd('100 * (count(*) filter (delay_minutes <= 1))::double / count(*)', 2)}
                as pct_on_time,
            {rnd('100 * (count(*) filter (delay_minutes > 15))::double / count(*)', 2)}
                as severe_delay_share
        from departures group by all) s
    left join (
        select station_code, service_date, count(distinct disruption_id) as disruption_count
        from named_disruptions group by all) x using (station_code, service_date)"""

CTES["road_days"] = f"""
    with free as (
        select location_id, quantile_cont(avg_speed_kmh, 0.85) as free_speed
        from stg_roads group by location_id)
    select location_id, service_date, {rnd('avg(avg_speed_kmh)', 2)} as avg_speed_kmh,
        sum(vehicle_count)::bigint as total_vehicle_count,
        15 * count(*) filter (avg_speed_kmh < free_speed / 2) as congestion_minutes
    from stg_roads join free using (location_id) group by all"""

# --- core ------------------------------------------------------------------------------------

CTES["d_dates"] = """
    select cast(g.d as date) as service_date, dayofweek(g.d) + 1 as day_of_week,
        weekofyear(g.d) as week_number, month(g.d) as month,
        ['winter', 'spring', 'summer', 'autumn'][(month(g.d) % 12) // 3 + 1] as season,
        h.holiday_name is not null as is_holiday, dayofweek(g.d) in (0, 6) as is_weekend,
        h.holiday_name
    from generate_series(timestamp '2026-01-01', timestamp '2027-12-31', interval 1 day) g(d)
    left join lk_holidays h on h.date = cast(g.d as date)"""

CTES["d_roads"] = """
    select distinct on (ndw_location_id) ndw_location_id as location_id, road_name,
        ndw_lat as lat, ndw_lon as lon, r.station_code as nearest_station_code, c.corridor_id,
        distance_km
    from lk_roads r left join lk_corridors c using (station_code)
    order by ndw_location_id, distance_km, r.station_code, c.corridor_id"""

CTES["f_train"] = """
    select t.*, c.corridor_id, c.corridor_name
    from train_days t left join lk_corridors c using (station_code)"""

CTES["f_road"] = f"""
    select t.*, l.corridor_id, {rnd('100 * avg_speed_kmh / base', 2)} as speed_vs_baseline_pct
    from (select *, avg(avg_speed_kmh) over (partition by location_id) as base from road_days) t
    left join d_roads l using (location_id)"""

CTES["mart"] = f"""
    select t.*, d.* exclude (service_date, holiday_name), r.* exclude (corridor_id, service_date),
        w.* exclude (corridor_id, service_date)
    from (
        select corridor_id, corridor_name, service_date,
            {rnd('avg(pct_on_time)', 2)} as pct_on_time,
            {rnd('avg(avg_delay_min)', 2)} as avg_delay_min,
            sum(total_departures)::bigint as total_departures,
            sum(disruption_count)::bigint as disruption_count,
            {rnd('avg(severe_delay_share)', 2)} as severe_delay_share
        from f_train where corridor_id is not null group by all) t
    left join (
        select corridor_id, service_date, {rnd('avg(avg_speed_kmh)', 2)} as avg_road_speed_kmh,
            sum(total_vehicle_count)::bigint as total_vehicle_count,
            sum(congestion_minutes)::bigint as total_congestion_minutes,
            {rnd('avg(speed_vs_baseline_pct)', 2)} as road_speed_vs_baseline_pct
        from f_road group by all) r using (corridor_id, service_date)
    left join (
        select m.corridor_id, s.service_date,
            {', '.join(f"{rnd(f'avg(s.{c})', 1)} as {c}" for c in (
                'avg_temp_c', 'min_temp_c', 'max_temp_c', 'precipitation_mm',
                'precipitation_duration_h', 'avg_wind_speed_kmh'))},
            max(s.max_wind_gust_kmh) as max_wind_gust_kmh,
            coalesce(bool_or(s.is_stormy), false) as is_stormy,
            coalesce(bool_or(s.is_heavy_rain), false) as is_heavy_rain
        from stg_weather s join lk_weather m using (knmi_station_code) group by all) w
        using (corridor_id, service_date)
    left join d_dates d using (service_date)"""

CTES["weather_days"] = "select * from mart where avg_wind_speed_kmh is not null"
