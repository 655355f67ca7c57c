from __future__ import annotations

import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from linewatch.operators import merge, quality, snapshot
from linewatch.plans import alerts
from linewatch.sources import backfill, sinks
from linewatch.streaming import polls

D = dt.date
FACT = "station_code string, corridor_id bigint, service_date date, n bigint"
KEYS = ["station_code", "corridor_id", "service_date"]


def test_partition_overwrite_is_idempotent_and_scoped(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("2026-03-01", 1), ("2026-03-02", 2)], "service_date string, n int")
    again = spark.createDataFrame([("2026-03-02", 3), ("2026-03-02", 4)], "service_date string, n int")
    sinks.overwrite_partitions(first, path, ["service_date"])
    for _ in range(2):
        sinks.overwrite_partitions(again, path, ["service_date"], ["n"])
    assert rows(spark.read.parquet(path), "n") == [(1,), (3,), (4,)]


def test_periods_are_replaced_without_a_shuffle(spark, tmp_path, rows):
    path, setting = str(tmp_path / "t"), "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting)
    # more months in a task than folders are held open, and rows without a month
    months = F.when(F.col("id") % 41 > 0, F.concat(F.lit("m"), F.col("id") % 41))
    for factor in (2, 3):
        sinks.overwrite_periods(spark.range(0, 820, 1, 2).select(
            (F.col("id") * factor).alias("n"), months.alias("month")), path, ["month"])
    later = spark.createDataFrame([(1, "m1"), (2, "m1"), (3, "new")], "n long, month string")
    sinks.overwrite_periods(later.repartition(2), path, ["month"])
    kept = [(3 * i, f"m{i % 41}" if i % 41 else None) for i in range(820) if i % 41 != 1]
    want = sorted([*kept, (1, "m1"), (2, "m1"), (3, "new")], key=lambda r: tuple(map(str, r)))
    assert rows(spark.read.parquet(path), "n", "month") == want
    assert spark.conf.get(setting) == before
    # each of the two tasks wrote its own file
    assert len(glob.glob(f"{path}/month=m2/*.parquet")) == 2


def test_polls_append(spark, tmp_path):
    path = str(tmp_path / "t")
    poll = spark.createDataFrame([("a", "2026-03-01")], "id string, _service_date string")
    for _ in range(2):
        backfill.load_departure_polls(poll, path)
    assert spark.read.parquet(path).count() == 2


def test_new_fields_are_taken_in_or_cut_to_the_existing_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.append_partitions(spark.createDataFrame([(1, "d")], "a int, day string"), path, ["day"])
    wider = spark.createDataFrame([(2, "x", "d")], "a int, b string, day string")
    sinks.append_partitions(wider, path, ["day"])
    assert set(sinks.read_evolving(spark, path).columns) == {"a", "b", "day"}
    target = spark.createDataFrame([], "a bigint, c double").schema
    cut = sinks.with_existing_schema(wider, target)
    assert cut.dtypes == [("a", "bigint"), ("c", "double")] and tuple(cut.first()) == (2, None)


def test_landing_archives(spark, tmp_path, rows):
    folder = str(tmp_path / "ndjson")
    df = spark.range(25).selectExpr("id", "if(id < 20, '2026-03-01', '2026-03-02') as day")
    sinks.archive_ndjson(df, folder, "day", records_per_file=10)
    sizes = sorted(sum(1 for _ in open(f)) for f in glob.glob(f"{folder}/dt=2026-03-01/*.json"))
    assert max(sizes) <= 10 and sum(sizes) == 20
    record = json.loads(open(glob.glob(f"{folder}/dt=2026-03-02/*.json")[0]).readline())
    assert set(record) == {"id", "day"}
    sinks.archive_csv(df, str(tmp_path / "csv"))
    back = spark.read.csv(str(tmp_path / "csv"), header=True)
    assert back.count() == 25 and back.columns == ["id", "day"]
    target = str(tmp_path / "loaded")
    sinks.load_csv(spark, str(tmp_path / "csv"), target,
                   spark.createDataFrame([], "id bigint, day string").schema, "day")
    assert rows(spark.read.parquet(target).groupBy("day").count(), "count") == [(20,), (5,)]


def test_later_csv_loads_keep_the_schema_of_the_table(spark, tmp_path, rows):
    target, later = str(tmp_path / "t"), tmp_path / "later.csv"
    (tmp_path / "first.csv").write_text("n,name,day\n1,a,2026-03-01\n2,b,2026-03-02\n")
    sinks.load_csv(spark, str(tmp_path / "first.csv"), target, partition_field="day")
    types = spark.read.parquet(target).schema
    later.write_text("extra,day,n\nx,2026-03-02,7\n")
    for _ in range(2):
        sinks.load_csv(spark, str(later), target, partition_field="day")
    table = spark.read.parquet(target)
    assert table.schema == types
    assert rows(table, "n", "name") == [(1, "a"), (7, None)]
    later.write_text("day,n\n2026-03-02,many\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        sinks.load_csv(spark, str(later), target, partition_field="day")
    assert rows(spark.read.parquet(target), "n", "name") == [(1, "a"), (7, None)]


def test_each_table_is_checked_in_one_evaluation(spark):
    dates = spark.range(9).selectExpr("cast(id % 4 as string) as date")
    plan = quality.quality_report({"dim_date": dates})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1


def test_merge_replaces_null_safe_keys_and_touches_only_its_days(spark, tmp_path, rows):
    path = str(tmp_path / "fact")
    start = spark.createDataFrame([
        ("UT", 2, D(2026, 3, 1), 1), ("UT", 4, D(2026, 3, 2), 2), ("XX", None, D(2026, 3, 2), 3),
        ("ASD", 1, D(2026, 3, 2), 4)], FACT)
    merge.incremental_merge(spark, path, start, KEYS)
    untouched = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/service_date=2026-03-01/*")}
    delta = spark.createDataFrame([
        ("UT", 4, D(2026, 3, 2), 20), ("XX", None, D(2026, 3, 2), 30),
        ("UT", 2, D(2026, 3, 3), 50)], FACT)
    for _ in range(2):
        merge.incremental_merge(spark, path, delta, KEYS, cluster_by=["station_code"])
    assert rows(spark.read.parquet(path), "station_code", "corridor_id", "n") == [
        ("ASD", 1, 4), ("UT", 2, 1), ("UT", 2, 50), ("UT", 4, 20), ("XX", None, 30)]
    assert {f: os.path.getmtime(f)
            for f in glob.glob(f"{path}/service_date=2026-03-01/*")} == untouched


def test_merge_without_a_day_and_without_rows(spark, tmp_path, rows):
    path = str(tmp_path / "fact")
    merge.incremental_merge(spark, path, spark.createDataFrame(
        [("UT", 2, None, 1), ("ED", 5, None, 2), ("ED", 5, D(2026, 3, 1), 3)], FACT), KEYS)
    merge.incremental_merge(spark, path, spark.createDataFrame([("UT", 2, None, 10)], FACT), KEYS)
    merge.incremental_merge(spark, path, spark.createDataFrame([], FACT), KEYS)
    assert rows(spark.read.parquet(path), "station_code", "n") == [
        ("ED", 2), ("ED", 3), ("UT", 10)]


def test_snapshot_versions(spark, tmp_path, rows):
    path = str(tmp_path / "snap")

    def load(day, *stations):
        current = spark.createDataFrame(
            list(stations), "station_code string, corridor_id bigint, station_name string")
        snapshot.update_snapshot(spark, path, current, ["station_code", "corridor_id"],
                                 ["station_name"], day)
        return rows(spark.read.parquet(path), "station_code", "corridor_id", "station_name",
                    "valid_from", "valid_to")

    first = load("2026-03-01", ("UT", 4, "Utrecht"), ("UT", 5, None), ("ED", 5, "Ede"))
    assert first == load("2026-03-01", ("UT", 4, "Utrecht"), ("UT", 5, None), ("ED", 5, "Ede"))
    assert first == [
        ("ED", 5, "Ede", D(2026, 3, 1), None), ("UT", 4, "Utrecht", D(2026, 3, 1), None),
        ("UT", 5, None, D(2026, 3, 1), None)]
    # one row changes, one vanishes and stays, one is new
    changed = [
        ("ED", 5, "Ede", D(2026, 3, 1), None),
        ("HT", 4, "Den Bosch", D(2026, 3, 2), None),
        ("UT", 4, "Utrecht", D(2026, 3, 1), None),
        ("UT", 5, None, D(2026, 3, 1), D(2026, 3, 2)),
        ("UT", 5, "Utrecht C", D(2026, 3, 2), None)]
    rows_2 = [("UT", 4, "Utrecht"), ("UT", 5, "Utrecht C"), ("HT", 4, "Den Bosch")]
    assert load("2026-03-02", *rows_2) == changed
    assert load("2026-03-02", *rows_2) == changed
    assert load("2026-03-03", *rows_2) == changed
    back = load("2026-03-04", ("UT", 5, None))
    assert len(back) == 6 and ("UT", 5, "Utrecht C", D(2026, 3, 2), D(2026, 3, 4)) in back
    ids = spark.read.parquet(path).select("version_id")
    assert ids.distinct().count() == 6


MART = "corridor_id bigint, corridor_name string, service_date date, pct_on_time double"


def mart(spark, *on_times, last=D(2026, 3, 26)):
    """on_times of consecutive days up to and including the last."""
    first = last - dt.timedelta(days=len(on_times) - 1)
    return spark.createDataFrame(
        [(1, "A-R", first + dt.timedelta(days=i), v) for i, v in enumerate(on_times)], MART)


@pytest.mark.parametrize("on_times, fires", [
    ([90.0] * 7 + [62.0], True),
    ([100.0] * 7 + [80.0], False),            # exactly the threshold
    ([80.0, 60.0], False),                    # mean 70 is exactly 10 above
    ([80.2, 60.0], True),
    ([100.0] + [70.0] * 7 + [62.0], False),   # eight days before: outside
    ([146.0] + [70.0] * 6 + [62.0], True),    # seven days before: inside
    ([90.0, None], False)])
def test_alert_conditions(spark, on_times, fires):
    frame = mart(spark, *on_times)
    single = alerts.reliability_alerts(frame, "2026-03-26").collect()
    every = alerts.reliability_alerts_all_days(frame).where(
        F.col("service_date") == F.lit("2026-03-26").cast("date")).collect()
    assert bool(single) is fires and bool(every) is fires


def test_alert_history_is_appended_once(spark, tmp_path):
    path = str(tmp_path / "history")
    quiet = alerts.reliability_alerts(mart(spark, 99.0), "2026-03-26")
    alerts.append_alert_history(spark, path, alerts.alert_records(quiet, "2026-03-26"))
    assert not os.path.exists(path)
    fired = alerts.reliability_alerts(mart(spark, *[90.0] * 7, 62.0), "2026-03-26")
    for _ in range(2):
        alerts.append_alert_history(spark, path, alerts.alert_records(fired, "2026-03-26"))
    record = spark.read.parquet(path).collect()
    assert len(record) == 1
    r = record[0]
    assert (r.alert_type, r.corridor, r.metric_value, r.recent_mean, r.threshold, r.fired) == (
        "reliability", "A-R", 62.0, 86.5, 80.0, True)
    assert len(r.alert_id) == 64 and r.check_ts is not None


def test_checks(spark, rows):
    dates = spark.createDataFrame([("a", 1), ("a", None), (None, 3), (None, 4)], "date string, n int")
    assert rows(quality.check_not_null(dates, "t", ["date", "n"]), "column", "failures") == [
        ("date", 2), ("n", 1)]
    assert quality.check_unique(dates, "t", "date").first().failures == 1
    fact = spark.createDataFrame(
        [("UT", D(2026, 3, 1), v) for v in (0.0, 100.0, -0.1, 100.1, None)],
        "station_code string, service_date date, pct_on_time double")
    assert rows(quality.pct_on_time_violations(fact), "pct_on_time") == [(-0.1,), (100.1,)]
    report = quality.quality_report({"dim_date": dates, "fct_train_performance": fact})
    assert rows(report, "check", "table", "column", "failures", "passed") == [
        ("not_null", "dim_date", "date", 2, False),
        ("not_null", "fct_train_performance", "service_date", 0, True),
        ("not_null", "fct_train_performance", "station_code", 0, True),
        ("range", "fct_train_performance", "pct_on_time", 2, False),
        ("unique", "dim_date", "date", 1, False)]


def test_check_inventory():
    assert sum(map(len, quality.NOT_NULL.values())) == 35
    assert sum(map(len, quality.UNIQUE.values())) == 3


@pytest.mark.parametrize("hours, status", [(36, "pass"), (37, "warn"), (48, "warn"), (49, "error")])
def test_freshness(spark, hours, status):
    feed = spark.createDataFrame([(dt.datetime(2026, 3, 1),), (None,)], "_ingested_at timestamp")
    now = dt.datetime(2026, 3, 1) + dt.timedelta(hours=hours)
    row = quality.freshness(feed, "f", "_ingested_at", str(now)).first()
    assert (row.status, row.age_hours) == (status, float(hours))


def test_freshness_of_an_empty_feed(spark):
    feed = spark.createDataFrame([], "_ingested_at timestamp")
    assert quality.freshness(feed, "f", "_ingested_at", "2026-03-01 00:00:00").first().status == (
        "error")


def test_poll_stream_takes_every_file_once(spark, tmp_path):
    landing, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def land(station, poll, *directions):
        folder = f"{landing}/station={station}"
        os.makedirs(folder, exist_ok=True)
        board = {"payload": {"departures": [
            {"direction": d, "plannedDateTime": "2026-03-26T08:00:00+0100",
             "product": {"number": "1"}} for d in directions]}}
        with open(f"{folder}/{poll}.json", "w") as f:
            json.dump(board, f, indent=1)

    def run():
        stream = polls.board_stream(spark, landing, polls.file_part("station=([^/]+)/"),
                                    "2026-03-26")
        polls.append_polls(stream, target, checkpoint).awaitTermination()
        return sorted((r._station_code, r.direction) for r in spark.read.parquet(target).collect())

    land("UT", 1, "A", "B")
    land("ASD", 1, "C")
    assert run() == [("ASD", "C"), ("UT", "A"), ("UT", "B")]
    assert len(run()) == 3
    land("UT", 2, "A")
    assert run() == [("ASD", "C"), ("UT", "A"), ("UT", "A"), ("UT", "B")]
    row = spark.read.parquet(target).first()
    assert json.loads(row["product"]) == {"number": "1"}


def test_upsert_keeps_columns_that_only_one_side_has(spark, tmp_path, rows):
    path = str(tmp_path / "fact")
    day = D(2026, 3, 1)
    wide = "id long, v long, extra string, service_date date"
    merge.incremental_merge(spark, path, spark.createDataFrame(
        [(1, 10, "a", day), (2, 20, "b", day)], wide), ["id"])
    merge.incremental_merge(spark, path, spark.createDataFrame(
        [(1, 11, day), (3, 30, day)], "id long, v long, service_date date"), ["id"])
    columns = ("id", "v", "extra")
    assert rows(spark.read.parquet(path), *columns) == [(1, 11, "a"), (2, 20, "b"), (3, 30, None)]
    merge.incremental_merge(spark, path, spark.createDataFrame(
        [(2, 21, "c", 5, day)], "id long, v long, extra string, more long, service_date date"), ["id"])
    assert rows(spark.read.parquet(path), *columns, "more") == [
        (1, 11, "a", None), (2, 21, "c", 5), (3, 30, None, None)]


def test_scratch_is_shared_storage():
    from types import SimpleNamespace

    from linewatch import session

    def path(master, **conf):
        return session.scratch_path(SimpleNamespace(
            conf=conf and SimpleNamespace(get=lambda k, default=None: conf.get(
                k.rpartition(".")[0].rpartition(".")[2], default)),
            sparkContext=SimpleNamespace(master=master)), "x")

    assert path("spark://h:1", checkpoint="s3a://b/c", warehouse="/w").startswith("s3a://b/c/")
    assert path("spark://h:1", warehouse="hdfs://w").startswith("hdfs://w/_scratch/")
    assert path("local[2]", warehouse="file:/w").startswith("file:/w/_scratch/")
    with pytest.raises(ValueError):
        path("spark://h:1", warehouse="file:/w")
