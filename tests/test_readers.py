from __future__ import annotations

import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F

from linewatch.plans import staging
from linewatch.sources import archive, backfill, boards, lookups, roads, weather

SERVICE_HEADER = ",".join(f"h{i}" for i in range(20))
FIRST_STOP = ("901,2026-03-01,Sprinter,Arriva,7311,false,false,4,5001,GN,Groningen,"
              ",,,2026-03-01T21:47:00+01:00,2,false,true,3a,3b")
LAST_STOP = ("901,2026-03-01,Sprinter,Arriva,7311,false,false,4,5002,ASN,"
             "Assen,2026-03-01T22:06:00+01:00,4,false,,,,false,,")
DISRUPTION_HEADER = ("rdt_id,ns_lines,rdt_lines,rdt_lines_id,rdt_station_names,rdt_station_codes,"
                     "cause_nl,cause_en,statistical_cause_nl,statistical_cause_en,cause_group,"
                     "start_time,end_time,duration_minutes")


def write_gz(path, *lines):
    path.write_bytes(gzip.compress("\n".join(lines).encode() + b"\n"))
    return str(path)


def by_id(df, key="stop_rdt_id"):
    return {r[key]: r for r in df.collect()}


def test_service_stops(spark, tmp_path):
    path = write_gz(tmp_path / "services-2026-03.csv.gz", SERVICE_HEADER, FIRST_STOP, LAST_STOP)
    got = by_id(archive.read_services(spark, path))
    first, last = got["5001"], got["5002"]
    assert (first.service_rdt_id, first.service_date, first.train_number) == (
        "901", "2026-03-01", "7311")
    assert first.completely_cancelled is False and first.departure_delay == 2
    assert first.arrival_time is None and first.arrival_cancelled is None
    assert first._source == "rdt_archive" and first._year_month == "2026-03"
    assert last.arrival_delay == 4 and last.departure_time is None
    assert last.planned_platform is None and last.departure_cancelled is None


def test_rows_with_another_number_of_fields_are_dropped(spark, tmp_path):
    path = write_gz(tmp_path / "services-2026-03.csv.gz", SERVICE_HEADER, FIRST_STOP,
                    "too,few", FIRST_STOP + ",one more")
    read = archive.read_services(spark, path)
    assert read.count() == 1
    assert read.select("station_code").collect()[0][0] == "GN"


def test_quotes_commas_line_breaks_and_empty_text(spark, tmp_path):
    stop = FIRST_STOP.replace("Groningen", '"Groningen, ""N""\nhall"').replace("GN", "")
    stop = stop.replace("false,false,4,", "TRUE,t,4,")
    path = write_gz(tmp_path / "services-2026.csv.gz", SERVICE_HEADER, stop)
    row = archive.read_services(spark, path).first()
    assert row.station_name == 'Groningen, "N"\nhall'
    assert row.station_code == "" and row._year_month == "2026"
    assert row.completely_cancelled is True and row.partly_cancelled is None
    assert staging.stg_rdt_services(archive.read_services(spark, path)).count() == 0


def test_archived_disruptions(spark, tmp_path):
    path = tmp_path / "disruptions-2025.csv"
    path.write_text(
        DISRUPTION_HEADER + "\n"
        'Z1,Zwolle - Emmen,ZL - EMN,3,"Ommen,Hardenberg","OMN, HDB",boom op het spoor,fallen tree,'
        "boom op het spoor,fallen tree,weather,2025-11-14 23:50:00,2025-11-15 02:20:30,150\n"
        "Z2,,,,,,,,,,,2025-11-16 00:00:00,,\n")
    read = archive.read_disruptions(spark, str(path))
    first, second = (by_id(read, "rdt_id")[k] for k in ("Z1", "Z2"))
    assert (first.cause_en, first.cause_group, first.duration_minutes) == (
        "fallen tree", "weather", 150)
    assert first.rdt_station_codes == "OMN, HDB" and first._year == "2025"
    assert second.cause_group == "" and second.end_time is None
    assert second.duration_minutes is None

    staged = by_id(staging.stg_rdt_disruptions(read), "disruption_id")
    assert staged["Z1"].affected_station_codes == ["OMN", " HDB"]
    assert staged["Z1"].service_date == dt.date(2025, 11, 14)
    assert staged["Z2"].affected_station_codes == [""]
    trimmed = by_id(staging.stg_rdt_disruptions(read, trim_codes=True), "disruption_id")
    assert trimmed["Z1"].affected_station_codes == ["OMN", "HDB"]


def test_departure_board(spark, tmp_path):
    board = {"payload": {"departures": [{
        "direction": "Enschede", "name": "Blauwnet 31",
        "plannedDateTime": "2026-07-09T23:58:00+0200",
        "actualDateTime": "2026-07-10T00:07:00+0200", "trainCategory": "Stoptrein",
        "cancelled": False, "departureStatus": "ON_STATION",
        "product": {"number": "31", "operatorName": "Keolis"},
        "routeStations": [{"uicCode": "1", "mediumName": "Wierden"}, {"uicCode": "2"}]}]}}
    (tmp_path / "ZL.json").write_text(json.dumps(board, indent=2))
    read = boards.read_departures(spark, str(tmp_path), "ZL", "2026-07-09")
    row = read.first()
    assert row.direction == "Enschede"
    assert json.loads(row.product)["operatorName"] == "Keolis"
    assert json.loads(row.routeStations)[0]["mediumName"] == "Wierden"
    assert (row._station_code, row._service_date, row._source) == (
        "ZL", "2026-07-09", "ns_api_v2")
    assert row._ingested_at is not None and "delay_minutes" not in read.columns
    staged = staging.stg_ns_departures(read).first()
    assert (staged.delay_minutes, staged.train_number, staged.operator_name) == (9, "31", "Keolis")
    assert staged.departure_id == "ZL_2026-07-09_2026-07-09T23:58:00+0200_Enschede"
    assert staged.planned_departure_ts == dt.datetime(2026, 7, 9, 21, 58)


ITEM = {
    "id": "m-77", "type": "MAINTENANCE", "title": "Works near Meppel", "isActive": False,
    "start": "2026-05-30T22:15:00+0200", "end": "2026-05-31T03:00:00+0200",
    "impact": {"value": 5},
    "publicationSections": [{"section": {}}, {"section": {"stations": [
        {"stationCode": "MP"}, {"name": "a halt"}, {"stationCode": "HGV", "name": "Hoogeveen"},
        {"stationCode": "MP"}]}}],
    "timespans": [{"period": "night"}, {"cause": {"label": "track renewal"}}],
}


@pytest.mark.parametrize("response, expected", [
    ([ITEM], 1), ({"payload": [ITEM, ITEM]}, 2), ({"meta": 1}, 0), ([], 0)])
def test_disruption_feed_shapes(spark, tmp_path, response, expected):
    (tmp_path / "feed.json").write_text(json.dumps(response, indent=1))
    read = boards.read_disruption_feed(spark, str(tmp_path), "2026-05-30")
    assert read.count() == expected
    if expected:
        row = read.first()
        assert row.id == "m-77" and row._source == "ns_api_v3" and row.isActive is False
        assert json.loads(row.timespans)[1]["cause"]["label"] == "track renewal"
        staged = staging.stg_ns_disruptions(read).collect()
        assert len(staged) == 1
        assert staged[0].affected_station_codes == ["HGV", "MP"]
        assert staged[0].stations_affected_count == 2
        assert (staged[0].cause, staged[0].impact_score, staged[0].duration_minutes) == (
            "track renewal", 5, 285)


def test_weather(spark, tmp_path):
    base = {"date": "2026-04-01T00:00:00.000Z", "TG": 92, "TN": 31, "TX": 140, "DR": 10, "FG": 59,
            "FHX": 120, "DDVEC": 199}
    (tmp_path / "w.json").write_text(json.dumps([
        {**base, "station_code": 240, "RH": -1}, {**base, "station_code": 999, "RH": None},
        {**base, "station_code": 260, "RH": 123, "TG": None, "FG": 208}]))
    got = by_id(weather.read_weather(spark, str(tmp_path)), "station_code")
    assert got["240"].precipitation_mm == 0.0 and got["240"].station_region == "amsterdam"
    assert (got["240"].avg_temp_c, got["240"].service_date) == (9.2, "2026-04-01")
    assert got["999"].precipitation_mm is None and got["999"].station_region == "unknown"
    assert got["260"].precipitation_mm == 12.3 and got["260"].avg_temp_c is None
    staged = by_id(
        staging.stg_knmi_weather(weather.read_weather(spark, str(tmp_path))), "knmi_station_code")
    assert staged["240"].avg_wind_speed_kmh == 21.2 and staged["240"].is_stormy is False
    assert staged["260"].is_stormy is False and staged["260"].is_heavy_rain is True
    assert staged["999"].is_heavy_rain is None


@pytest.mark.parametrize("header", [
    "measurementSiteId,timestamp,averageSpeed,vehicleCount",
    "location_id,measurement_ts,avg_speed_kmh,vehicle_count"])
def test_road_csv_headers(spark, tmp_path, header):
    path = tmp_path / "roads.csv"
    path.write_text(header + "\nRWS-A28-7,2026-07-09T17:45:00+02:00,31.25,388\n")
    row = roads.read_traffic_csv(spark, str(path), "2026-07-09").first()
    assert tuple(row) == ("RWS-A28-7", "2026-07-09T17:45:00+02:00", "2026-07-09", 31.25, 388)


def test_road_csv_files_of_other_column_orders(spark, tmp_path):
    one, two = tmp_path / "a.csv", tmp_path / "b.csv"
    one.write_text("location_id,measurement_ts,avg_speed_kmh,vehicle_count\nA,t,60.5,9\n")
    two.write_text("location_id,measurement_ts,vehicle_count,avg_speed_kmh\nB,t,7,80.5\n")
    read = roads.read_traffic_csv(spark, [str(one), str(two)], "2026-07-09")
    assert {r.location_id: (r.avg_speed_kmh, r.vehicle_count) for r in read.collect()} == {
        "A": (60.5, 9), "B": (80.5, 7)}
    with pytest.raises(Exception, match="header"):
        roads.read_traffic_csv(spark, str(tmp_path), "2026-07-09").collect()


def test_road_csv_without_known_headers(spark, tmp_path):
    path = tmp_path / "roads.csv"
    path.write_text("a,b\n1,2\n")
    row = roads.read_traffic_csv(spark, str(path), "2026-03-26").first()
    assert tuple(row) == ("", "", "2026-03-26", 0.0, 0)


def test_unmapped_locations_are_left_out(spark):
    mapping = lookups.lookup(spark, "station_ndw_mapping")
    known = lookups.road_locations()[0]
    readings = spark.createDataFrame(
        [(known, 1), ("NDW-999", 2), (known, 3)], "location_id string, n int")
    assert sorted(r.n for r in roads.keep_mapped(readings, mapping).collect()) == [1, 3]


def test_missing_road_feed_keeps_the_schema(spark):
    empty = staging.stg_ndw_traffic_flow(None, spark)
    assert empty.count() == 0 and empty.columns == [
        "location_id", "measurement_ts", "service_date", "avg_speed_kmh", "vehicle_count"]


def test_lookups(spark, tmp_path):
    sizes = {n: lookups.lookup(spark, n).count() for n in (
        "station_corridor_mapping", "station_ndw_mapping", "knmi_corridor_mapping", "nl_holidays",
        "dim_operators")}
    assert list(sizes.values()) == [18, 42, 9, 11, 26]
    assert len(lookups.station_codes()) == 14
    (tmp_path / "nl_holidays.csv").write_text("date,holiday_name\n2027-04-27,King's Day\n")
    own = lookups.lookup(spark, "nl_holidays", str(tmp_path)).first()
    assert tuple(own) == (dt.date(2027, 4, 27), "King's Day")


def test_period_tokens():
    assert archive.period_tokens(" 2022, 2025-04,x,2025-4,none,") == ["2022", "2025-04"]
    assert archive.year_tokens("2024,2025-01") == ["2024"]
    assert archive.without_covered_months(["2022-01", "2022", "2023-05", "2023-05"]) == [
        "2022", "2023-05"]
    assert backfill.previous_month("2026-01-15") == "2025-12"
    assert backfill.previous_month("2026-04-02") == "2026-03"


def test_backfill_replaces_months_and_keeps_strays(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()

    def stop(n, day):
        return FIRST_STOP.replace("5001", str(n)).replace("2026-03-01,", f"{day},", 1)

    write_gz(source / "services-2026.csv.gz", SERVICE_HEADER,
             stop(1, "2026-01-05"), stop(2, "2026-02-05"), stop(3, "2025-12-31"))
    write_gz(source / "services-2026-02.csv.gz", SERVICE_HEADER,
             stop(4, "2026-02-06"), stop(5, "2026-03-01"))
    assert backfill.backfill_services(spark, str(source), "2026,2026-02,bad", target) == ["2026"]
    for _ in range(2):
        assert backfill.backfill_services(spark, str(source), "2026-02", target) == ["2026-02"]
    loaded = {r.stop_rdt_id for r in spark.read.parquet(target).collect()}
    assert loaded == {"1", "3", "4", "5"}
    assert backfill.backfill_services(spark, str(source), "none", target) == []


def test_disruption_backfill_keeps_every_year_whole(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for year in ("2024", "2025"):
        lines = [f"{year}{i},,,,,,,,,,g,{year}-01-01 00:00:00,,5" for i in range(3)]
        (source / f"disruptions-{year}.csv").write_text("\n".join([DISRUPTION_HEADER, *lines]))
    for years in ("2024,2025", "2025"):
        backfill.backfill_disruptions(spark, str(source), years, target)
    counts = spark.read.parquet(target).groupBy("_year").agg(F.count("*")).collect()
    assert sorted(tuple(r) for r in counts) == [(2024, 3), (2025, 3)]
