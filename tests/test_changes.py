"""Refreshes by touched days, quarantined rows, evolving tables, bitmaps, buckets, kept state."""

from __future__ import annotations

import datetime as dt
import glob
import gzip
import os
import uuid

import pytest
from pyspark.sql import functions as F, types as T

from linewatch import schemas
from linewatch.operators import bitmaps, changes
from linewatch.operators.quantile import counted_quantile, grouped_quantile
from linewatch.plans import bucketed, impact, staging
from linewatch.plans.day_refresh import DAY_OF, DayRefresh
from linewatch.plans.models import FEEDS, Models
from linewatch.sources import backfill, buckets, evolving, quarantine, sinks, stand_in
from linewatch.streaming import latest
from tests.conftest import SMALL

TABLES = ["int_departures_combined", "departure_rollup", "int_train_delays_daily",
          "int_ndw_traffic_daily", "fct_train_performance", "fct_road_traffic",
          "dm_multimodal_daily", "free_flow_speed", "station_names"]


def content(df):
    return sorted(map(str, df.collect()))


def files_of(path):
    return {os.path.relpath(f, path) for f in glob.glob(f"{path}/*/*.parquet")}


@pytest.fixture(scope="module")
def feeds(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("feeds")
    for f in FEEDS:
        getattr(stand_in, f)(spark, SMALL).write.parquet(str(folder / f))
    return {f: spark.read.parquet(str(folder / f)) for f in FEEDS}


def full_rebuild(spark, raw):
    models = Models(spark, raw)
    return {t: getattr(models, t) for t in TABLES if t != "free_flow_speed"}


def assert_equal_to_rebuild(spark, run, raw):
    for name, want in full_rebuild(spark, raw).items():
        assert content(run.table(name).select(*want.columns)) == content(want), name


# refresh by days ------------------------------------------------------------------------------

def test_refresh_of_touched_days_equals_a_full_rebuild(spark, feeds, tmp_path):
    run = DayRefresh(spark, str(tmp_path / "core"), "2026-04-12")
    now = {}

    def load(feed, rows, **how):
        run.load(feed, rows, **how)
        kept = now.get(feed)
        if kept is not None and how.get("replace", True):
            day = F.col(DAY_OF[feed]).cast("date")
            if "days" in how:
                kept = kept.where(~day.between(*[F.lit(d).cast("date") for d in how["days"]]))
            else:
                days = [r[0] for r in rows.select(day).distinct().collect()]
                kept = kept.where(~day.isin(days))
        now[feed] = rows if kept is None else kept.unionByName(rows)

    for feed in FEEDS:
        load(feed, feeds[feed].where(F.col(DAY_OF[feed]).cast("date") < "2026-03-25"))
    run.refresh()
    assert_equal_to_rebuild(spark, run, now)

    # the archive takes over days that live polls had; a reload empties a day
    late = {f: feeds[f].where(F.col(DAY_OF[f]).cast("date") >= "2026-03-25") for f in FEEDS}
    for feed in FEEDS:
        load(feed, late[feed], replace=feed not in ("ns_departures", "ns_disruptions"))
    load("rdt_services", feeds["rdt_services"].where(
        F.col("service_date").between("2026-02-03", "2026-02-05") & (F.col("service_date") != "2026-02-04")),
        days=("2026-02-03", "2026-02-05"))
    run.refresh()
    assert_equal_to_rebuild(spark, run, now)
    assert "2026-02-04" not in changes.stored_days(
        spark, run.path("int_departures_combined"), "service_date")
    before = {t: files_of(run.path(t)) for t in TABLES}
    assert run.refresh()  # nothing new was loaded
    assert {t: files_of(run.path(t)) for t in TABLES} == before | {
        t: files_of(run.path(t)) for t in ("free_flow_speed", "station_names")}


def test_days_that_a_load_does_not_touch_keep_their_files(spark, feeds, tmp_path):
    run = DayRefresh(spark, str(tmp_path / "core"), "2026-04-12")
    for feed in FEEDS:
        run.load(feed, feeds[feed])
    run.refresh()
    before = {t: files_of(run.path(t)) for t in TABLES}
    run.load("rdt_services", feeds["rdt_services"].where(
        F.col("service_date") == "2026-02-10").withColumn("departure_delay", F.lit(99)))
    written = run.refresh()
    for name in ("int_departures_combined", "departure_rollup", "int_train_delays_daily",
                 "fct_train_performance", "dm_multimodal_daily"):
        assert written[name] == {"2026-02-10"}, name
        changed = before[name] ^ files_of(run.path(name))
        assert changed and {os.path.dirname(f) for f in changed} == {"service_date=2026-02-10"}, name
    for name in ("int_ndw_traffic_daily", "fct_road_traffic"):
        assert files_of(run.path(name)) == before[name]


def test_the_departure_without_a_key_moves_between_days(spark, feeds, tmp_path):
    live = feeds["ns_departures"].where("direction is null and not coalesce(cancelled, false)")
    days = sorted(r[0] for r in live.select("_service_date").distinct().collect())
    first, second = live.where(F.col("_service_date") == days[0]), live.where(
        F.col("_service_date") == days[1])
    run = DayRefresh(spark, str(tmp_path / "core"), "2026-04-12")
    run.load("ns_departures", second)
    run.refresh()
    run.load("ns_departures", first.withColumn("_ingested_at", F.lit("2030-01-01").cast("timestamp")))
    run.refresh()
    rows = run.table("int_departures_combined").collect()
    assert [str(r.service_date) for r in rows] == [days[0]]
    run.load("ns_departures", first)  # an older poll again: the other day has the latest
    run.refresh()
    assert [str(r.service_date) for r in run.table("int_departures_combined").collect()] == [days[1]]


def test_rows_without_a_day(spark, feeds, tmp_path):
    run = DayRefresh(spark, str(tmp_path / "core"), "2026-04-12")
    live = feeds["ns_departures"].where("direction is not null").limit(40)
    undated = live.limit(3).withColumn("_service_date", F.lit(None).cast("string"))
    raw = {"ns_departures": live.unionByName(undated), "rdt_services": feeds["rdt_services"].limit(0)}
    run.load("ns_departures", raw["ns_departures"])
    run.refresh()
    def combined():
        m = Models(spark, {**raw})
        return content(m.int_departures_combined)
    columns = Models(spark, raw).int_departures_combined.columns
    assert content(run.table("int_departures_combined").select(*columns)) == combined()
    archive = feeds["rdt_services"].where("service_date = '2026-01-05'")
    run.load("rdt_services", archive)  # hides live departures without a day
    raw["rdt_services"] = archive
    run.refresh()
    assert content(run.table("int_departures_combined").select(*columns)) == combined()
    hiding = archive.limit(5).withColumn("service_date", F.lit(None).cast("string"))
    run.load("rdt_services", hiding)  # hides all of them
    raw["rdt_services"] = archive.unionByName(hiding)
    run.refresh()
    assert content(run.table("int_departures_combined").select(*columns)) == combined()


def test_a_refresh_that_died_is_repeated(spark, feeds, tmp_path, monkeypatch):
    run = DayRefresh(spark, str(tmp_path / "core"), "2026-04-12")
    for feed in ("ndw_traffic_flow", "rdt_services", "knmi_weather"):
        run.load(feed, feeds[feed])
    with monkeypatch.context() as m:
        m.setattr("linewatch.plans.core.dm_multimodal_daily", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run.refresh()
    again = DayRefresh(spark, str(tmp_path / "core"), "2026-04-12")
    again.refresh()
    none = {f: feeds[f].limit(0) for f in FEEDS}
    assert_equal_to_rebuild(spark, again, {**none, **{
        f: feeds[f] for f in ("ndw_traffic_flow", "rdt_services", "knmi_weather")}})


def test_replaced_days_and_days_that_differ(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame(
        [(dt.date(2026, 3, 1), 1), (dt.date(2026, 3, 2), 2), (None, 3)], "service_date date, n int")
    changes.replace_days(df, path, {"2026-03-01", "2026-03-02", None})
    assert changes.stored_days(spark, path, "service_date") == {"2026-03-01", "2026-03-02", None}
    new = df.where("n = 2").withColumn("n", F.lit(7))
    assert changes.days_that_differ(new, spark.read.parquet(path)) == {"2026-03-01", "2026-03-02", None}
    for _ in range(2):
        changes.replace_days(new, path, {"2026-03-01", "2026-03-02"})
    assert rows(spark.read.parquet(path), "service_date", "n") == sorted(
        [(None, 3), (dt.date(2026, 3, 2), 7)], key=lambda r: tuple(map(str, r)))
    changes.replace_days(df.limit(0), path, {"2026-03-02", None})
    assert changes.stored_days(spark, path, "service_date") == set()


def test_a_load_is_written_once_and_its_files_are_moved(spark, feeds, tmp_path, monkeypatch):
    written, write = [], sinks._partitioned_write

    def noted(df, path, *rest, **more):
        written.append(path)
        return write(df, path, *rest, **more)

    monkeypatch.setattr(sinks, "_partitioned_write", noted)
    run = DayRefresh(spark, str(tmp_path / "core"), "2026-04-12")
    stops = feeds["rdt_services"]
    run.load("rdt_services", stops)
    run.load("rdt_services", stops, replace=False)
    disruptions = feeds["rdt_disruptions"]
    run.load("rdt_disruptions", disruptions)
    assert len(written) == 3 and all("_staged-" in p for p in written)
    assert run.raw("rdt_services").count() == 2 * stops.count()
    assert content(run.raw("rdt_disruptions")) == content(disruptions)
    assert not [p for p in (tmp_path / "core" / "raw").iterdir() if p.name.startswith("_")]


def test_days_that_share_a_folder_with_replaced_ones_stay(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    day = dt.date(2026, 3, 1)
    df = spark.createDataFrame(
        [(day, 1), (dt.date(2026, 3, 2), 2), (dt.date(2027, 1, 1), 3), (None, 4)], "service_date date, n int")
    days = {"2026-03-01", "2026-03-02", "2027-01-01", None}
    changes.replace_days(df, path, days, grain="yyyy")
    new = spark.createDataFrame([(day, 7), (day, 7)], "service_date date, n int")
    for _ in range(2):
        changes.replace_days(new, path, {"2026-03-01", "2027-01-01"}, grain="yyyy")
    assert rows(spark.read.parquet(path), "service_date", "n") == sorted(
        [(None, 4), (day, 7), (day, 7), (dt.date(2026, 3, 2), 2)], key=lambda r: tuple(map(str, r)))
    changes.replace_days(df.limit(0), path, {None, "2026-03-02"}, grain="yyyy")
    assert rows(spark.read.parquet(path), "service_date", "n") == [(day, 7), (day, 7)]
    assert changes.stored_days(spark, path, "period") == {"2026"}


def test_counted_quantile_equals_the_one_over_rows(spark, rows):
    values = [(k, float(v)) for k in ("a", "b") for v in (3, 1, 4, 1, 5, 9, 2, 6)] + [
        ("c", None), (None, 1.0), ("d", 2.0)]
    df = spark.createDataFrame(values, "k string, v double")
    counted = df.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    want = rows(grouped_quantile(df, "k", "v", 0.85, "q"))
    assert rows(counted_quantile(counted, "k", "v", "n", 0.85, "q")) == want
    assert rows(counted_quantile(counted.union(counted), "k", "v", "n", 0.0, "q")) == [
        ("a", 1.0), ("b", 1.0), ("d", 2.0)]


# rejected rows --------------------------------------------------------------------------------

def _line(*changed, n=20):
    fields = ["1", "2026-03-01", "Intercity", "NS", "12", "false", "false", "0", "1:2", "UT",
              "Utrecht", "", "", "", "2026-03-01T10:00:00+01:00", "3", "false", "false", "1", "1"]
    for at, value in changed:
        fields[at] = value
    return ",".join(fields[:n] + ["x"] * (n - len(fields)))


def test_rejected_rows_are_kept_and_counted(spark, rows, tmp_path):
    head = ",".join(schemas.ARCHIVE_SERVICE_FIELDS)
    lines = [head, _line(), _line(n=21), _line(n=3), _line((10, '"Den, Bosch"')),
             _line((10, '"two\nlines, one ""name"""')), _line((10, '"a, b"'), n=22), "odd"]
    with gzip.open(tmp_path / "services-2026-03.csv.gz", "wt") as f:
        f.write("\n".join(lines) + "\n")
    target, rejected = str(tmp_path / "stops"), str(tmp_path / "rejected")
    for times in (1, 2):
        counts = quarantine.load_services(spark, str(tmp_path), "2026-03, nonsense", target, rejected)
        assert counts == quarantine.LoadCounts(3, 4)
        kept = spark.read.parquet(rejected)
        assert kept.count() == 4 * times  # the load repeats, the rows it rejected are noted again
    names = {r.station_name for r in spark.read.parquet(target).collect()}
    assert names == {"Utrecht", "Den, Bosch", 'two\nlines, one "name"'}
    found = {(r.fields, r.reason) for r in kept.collect()}
    assert found == {(21, quarantine.TOO_MANY), (22, quarantine.TOO_MANY), (3, quarantine.TOO_FEW),
                     (1, quarantine.TOO_FEW)}
    assert all(r.file.endswith("services-2026-03.csv.gz") and r.expected == 20 for r in kept.collect())
    assert quarantine.load_services(spark, str(tmp_path), "nonsense", target, rejected
                                    ) == quarantine.LoadCounts(0, 0)


def test_a_load_of_rejected_rows_alone_leaves_the_table(spark, tmp_path):
    (tmp_path / "disruptions-2020.csv").write_text("h\na,b\n")
    target, rejected = str(tmp_path / "t"), str(tmp_path / "r")
    assert quarantine.load_disruptions(spark, str(tmp_path), "2020", target, rejected
                                       ) == quarantine.LoadCounts(0, 1)
    assert not os.path.exists(target)
    assert spark.read.parquet(rejected).first().feed == "rdt_disruptions"


# evolving tables ------------------------------------------------------------------------------

def test_new_and_wider_fields_are_taken_in(spark, rows, tmp_path):
    path = str(tmp_path / "t")

    def load(values, fields):
        evolving.append_evolving(spark.createDataFrame(values, fields), path, ["day"])

    load([(1, 1.5, "d1")], "a int, b float, day string")
    load([(1 << 40, "new", "d2")], "A bigint, c string, day string")
    load([(2, 2.5, "d1")], "a int, b double, day string")
    table = evolving.read_evolving(spark, path)
    assert table.dtypes == [("a", "bigint"), ("b", "double"), ("day", "string"), ("c", "string")]
    assert rows(table, "a", "b", "c", "day") == sorted(
        [(1, 1.5, None, "d1"), (1 << 40, None, "new", "d2"), (2, 2.5, None, "d1")],
        key=lambda r: tuple(map(str, r)))
    with pytest.raises(evolving.IncompatibleField):
        load([("text", "d1")], "a string, day string")
    assert evolving.read_evolving(spark, path).count() == 3


def test_a_field_of_which_nothing_is_known_takes_any_type(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    evolving.append_evolving(spark.sql("select 1 a, null b, 'd' day"), path, ["day"])
    assert rows(evolving.read_evolving(spark, path), "a", "b") == [(1, None)]
    evolving.append_evolving(spark.sql("select 2 a, 7.5D b, 'd' day"), path, ["day"])
    assert rows(evolving.read_evolving(spark, path), "a", "b") == [(1, None), (2, 7.5)]


def test_a_table_without_a_record_gets_one(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.append_partitions(spark.createDataFrame([(1, "d")], "a int, day string"), path, ["day"])
    evolving.append_evolving(spark.createDataFrame([(2, "x", "d")], "a int, b string, day string"),
                             path, ["day"])
    assert evolving.recorded_schema(spark, path).fieldNames() == ["a", "day", "b"]
    assert evolving.read_evolving(spark, path).where("b is null").count() == 1
    with pytest.raises(ValueError):
        evolving.read_evolving(spark, str(tmp_path / "nothing"))


def test_widening_rules():
    def of(kind):
        return T.StructType([T.StructField("x", kind)])

    assert evolving.widened(of(T.ShortType()), of(T.LongType())) == of(T.LongType())
    assert evolving.widened(of(T.LongType()), of(T.IntegerType())) == of(T.LongType())
    assert evolving.widened(of(T.DateType()), of(T.TimestampNTZType())) == of(T.TimestampNTZType())
    for a, b in ((T.LongType(), T.DoubleType()), (T.StringType(), T.LongType()),
                 (T.BooleanType(), T.IntegerType())):
        with pytest.raises(evolving.IncompatibleField):
            evolving.widened(of(a), of(b))


# weather --------------------------------------------------------------------------------------

def test_weather_gaps(spark, rows):
    d = [f"2026-03-0{i}" for i in range(1, 9)]
    kept = [("A", d[0]), ("A", d[1]), ("A", d[1]), ("A", d[4]), ("B", "2025-01-01"), (None, d[2])]
    df = spark.createDataFrame(kept, "station_code string, service_date string")
    got = rows(backfill.weather_gaps(df, d[0], d[6]))
    day = [dt.date.fromisoformat(x) for x in d]
    assert got == [("A", day[2], day[3], 2), ("A", day[5], day[6], 2), ("B", day[0], day[6], 7)]


# distinct counts ------------------------------------------------------------------------------

def test_numbers_are_gapless_and_stay(spark, rows, tmp_path):
    path = str(tmp_path / "numbers")
    fields = "kind string, value string"
    bitmaps.add_numbers(spark, path, spark.createDataFrame(
        [("a", f"v{i % 50}") for i in range(200)] + [("b", "x"), ("b", None), (None, "y")], fields))
    first = dict(((r.kind, r.value), r.number) for r in bitmaps.numbers(spark, path).collect())
    assert sorted(n for (k, _), n in first.items() if k == "a") == list(range(1, 51))
    for _ in range(2):
        bitmaps.add_numbers(spark, path, spark.createDataFrame(
            [("a", "v3"), ("a", "new"), ("b", "z"), ("c", "x")], fields))
    later = dict(((r.kind, r.value), r.number) for r in bitmaps.numbers(spark, path).collect())
    assert later.items() >= first.items() and len(later) == len(first) + 3
    assert (later["a", "new"], later["b", "z"], later["c", "x"]) == (51, 2, 1)


def test_bitmaps_count_like_count_distinct(spark, tmp_path):
    rows = spark.range(90_000).selectExpr(
        "date_add(date'2026-03-01', cast(id % 7 as int)) service_date",
        "if(id % 3 = 0, 'p', 'q') kind", "cast(id * 7919 % 70001 as string) value").union(
        spark.createDataFrame([(None, "p", "undated")], "service_date date, kind string, value string"))
    kept = bitmaps.DistinctDays(spark, str(tmp_path / "d"))
    kept.replace(rows, {f"2026-03-0{i}" for i in range(1, 8)} | {None})
    for first, last in (("2026-03-01", "2026-03-07"), ("2026-03-02", "2026-03-03"), ("2026-03-05",) * 2):
        want = {r.kind: r.n for r in rows.where(F.col("service_date").between(first, last)).groupBy(
            "kind").agg(F.countDistinct("value").alias("n")).collect()}
        assert {r.kind: r.distinct_count for r in kept.between(first, last).collect()} == want
    kept.replace(rows.limit(0), {"2026-03-05"})
    assert kept.between("2026-03-05", "2026-03-05").collect() == []


def test_new_values_of_a_day_are_neighbours(spark, tmp_path):
    """40 days with 5,000 new values each: a day has its values in two bitmaps at most."""
    kept = bitmaps.DistinctDays(spark, str(tmp_path / "d"))
    day = F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 40).cast("int"))
    values = spark.range(200_000).select(
        day.alias("service_date"), F.lit("x").alias("kind"), F.col("id").cast("string").alias("value"))
    kept.replace(values, {r[0] for r in values.select(
        F.col("service_date").cast("string")).distinct().collect()})
    assert kept.table().groupBy("service_date").count().agg(F.max("count")).first()[0] <= 2
    assert [tuple(r) for r in kept.between("2026-01-03", "2026-01-05").collect()] == [("x", 15_000)]


# buckets --------------------------------------------------------------------------------------

def exchanges_below_joins(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning"), plan.count("SortMergeJoin")


def test_bucketed_tables_join_without_an_exchange(spark, feeds, tmp_path):
    models = Models(spark, feeds)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = bucketed.BucketedTables(models, str(tmp_path / "b"), 4)
        with buckets.co_partitioned(spark):
            trains, roads = tables.train_facts(), tables.road_facts()
            assert exchanges_below_joins(trains) == (0, 2)
            assert exchanges_below_joins(roads) == (0, 2)
            assert content(trains) == content(models.fct_train_performance)
            assert content(roads) == content(models.fct_road_traffic)
        assert exchanges_below_joins(models.fct_train_performance)[0] > 0

        # another session knows the tables by the record beside them
        other = spark.newSession()
        other.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        name = f"again_{uuid.uuid4().hex[:8]}"
        again = {t: buckets.register_bucketed(other, f"{name}_{t}", str(tmp_path / "b" / t))
                 for t in ("departure_rollup", "station_disruptions", "dim_stations")}
        with buckets.co_partitioned(other):
            facts = bucketed.train_facts(*again.values())
            assert exchanges_below_joins(facts) == (0, 2)
            assert content(facts) == content(models.fct_train_performance)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# stream ---------------------------------------------------------------------------------------

POLL = ("direction string, name string, plannedDateTime string, actualDateTime string, "
        "trainCategory string, cancelled boolean, departureStatus string, plannedTrack string, "
        "actualTrack string, product string, _station_code string, _service_date string, "
        "_source string, _ingested_at timestamp")


def poll(day, at, direction="Utrecht", actual=None, cancelled=False, number="12"):
    return ("" + direction if direction else None, "t", f"{day}T10:00:00+0100",
            actual, "IC", cancelled, "INCOMING", "1", "1", f'{{"number": "{number}"}}', "UT", day, "s",
            dt.datetime.fromisoformat(at))


def test_stream_keeps_the_latest_poll_and_drops_late_ones(spark, tmp_path):
    landing, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    batches = [
        [poll("2026-03-01", "2026-03-01T08:00:00"), poll("2026-03-01", "2026-03-01T09:00:00", number="13"),
         poll("2026-03-01", "2026-03-01T09:30:00", direction=None, number="14")],
        [poll("2026-03-01", "2026-03-01T08:30:00", number="old"),  # out of order
         poll("2026-03-02", "2026-03-02T08:00:00", number="15"),
         poll("2026-03-02", "2026-03-02T09:30:00", direction=None, number="16")],
        [poll("2026-03-09", "2026-03-09T08:00:00", number="17")],
        [poll("2026-03-01", "2026-03-10T08:00:00", number="late"),  # its state has gone
         poll("2026-03-09", "2026-03-09T07:00:00", cancelled=True)],
    ]
    late = 0
    for rows in batches:
        spark.createDataFrame(rows, POLL).coalesce(1).write.mode("append").json(landing)
        stream = spark.readStream.schema(POLL).json(landing)
        query = latest.upsert_latest(latest.latest_of_stream(stream, "3 days"), target, check)
        query.awaitTermination()
        late += latest.late_rows(query)
    assert late == 1
    in_time = [r for rows in batches for r in rows if '"late"' not in r[9]]
    want = staging.stg_ns_departures(spark.createDataFrame(in_time, POLL))
    got = latest.latest_departures(spark, target).select(*want.columns)
    assert content(got) == content(want)
    assert {r.train_number for r in got.collect()} == {"13", "15", "16", "17"}


# roads around disruptions ---------------------------------------------------------------------

def test_road_impact_of_hand_made_disruptions(spark, rows):
    at = dt.datetime.fromisoformat
    stations = spark.createDataFrame([("R1", "UT"), ("R2", "UT"), ("R3", "ASD")],
                                     "location_id string, nearest_station_code string")
    disruptions = spark.createDataFrame([
        ("d1", at("2026-03-01T10:30:00"), at("2026-03-01T11:30:00"), ["UT", "UT", None]),
        ("d2", at("2026-03-01T10:30:00"), None, ["UT"]),
        ("d3", None, at("2026-03-01T10:30:00"), ["UT"]), ("d4", at("2026-03-01T10:30:00"), None, None),
        ("d5", at("2026-03-05T10:30:00"), at("2026-03-05T11:00:00"), ["UT"])],
        "disruption_id string, start_ts timestamp, end_ts timestamp, affected_station_codes array<string>")
    readings = spark.createDataFrame([
        ("R1", at("2026-03-01T08:15:00"), 1.0, 1), ("R1", at("2026-03-01T08:30:00"), 80.0, 10),
        ("R2", at("2026-03-01T10:15:00"), 100.0, 20), ("R1", at("2026-03-01T10:30:00"), 30.0, 5),
        ("R2", at("2026-03-01T11:15:00"), None, 7), ("R1", at("2026-03-01T11:30:00"), 60.0, 2),
        ("R1", at("2026-03-01T13:15:00"), 70.0, 3), ("R1", at("2026-03-01T13:30:00"), 9.0, 9),
        ("R3", at("2026-03-01T10:30:00"), 9.0, 9), ("R1", None, 9.0, 9)],
        "location_id string, measurement_ts timestamp, avg_speed_kmh double, vehicle_count long")
    got = rows(impact.disruption_road_impact(readings, disruptions, stations).drop("start_ts", "end_ts"))
    assert got == [
        ("d1", 90.0, 30, 2, 30.0, 12, 2, 65.0, 5, 2, -60.0),
        ("d2", 90.0, 30, 2, None, None, 0, 45.0, 14, 3, None)]


def test_road_impact_plans_no_nested_loop(spark, feeds):
    m = Models(spark, feeds)
    plan = impact.disruption_road_impact(
        m.stg_ndw_traffic_flow, m.stg_ns_disruptions, m.dim_ndw_locations
    )._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
