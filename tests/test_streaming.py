"""Streams give what the batch gives, each file and each reading once."""

import datetime as dt
import json

from pyspark.sql import functions as F

from firnline.operators import align, resample
from firnline.session import scratch_dir
from firnline.sources import portal, store, tables
from firnline.streaming import ingest


def deliver(folder, name, start, values, minutes=60):
    folder.mkdir(parents=True, exist_ok=True)
    t0 = dt.datetime.fromisoformat(start)
    data = [{"DATE": (t0 + dt.timedelta(minutes=minutes * i)).strftime("%Y-%m-%dT%H:%M:%S") + "CEST", "VALUE": v} for i, v in enumerate(values)]
    (folder / name).write_text(json.dumps(data))


def stream(spark, folder):
    return portal.with_station_id(ingest.read_portal_stream(spark, str(folder)), tables.stations(spark))


def test_closed_days_equal_batch(spark, tmp_path, listed):
    deliver(tmp_path, "Rossalm_LT_from_20200505_to_20200507.json", "2020-05-05 00:00", [float(i % 7) for i in range(49)])
    deliver(tmp_path, "Rossalm_HS_from_20200505_to_20200507.json", "2020-05-05 00:00", [60.0] * 50)
    path = scratch_dir(spark, "s")
    ingest.run_to_table(ingest.closed_periods(stream(spark, tmp_path), "daily"), path + "/out", path + "/state")
    got = listed(spark.read.parquet(path + "/out").select("sensor", "period", "mean", "readings"), "sensor", "period")
    batch = portal.read_portal_json(spark, str(tmp_path)).groupBy("sensor", F.to_date("ts").cast("timestamp_ntz").alias("period")).agg(
        F.avg("value").alias("mean"), F.count("value").alias("readings"))
    assert got == listed(batch.where("period < '2020-05-07'"), "sensor", "period") and len(got) == 4
    # a later delivery closes the next day and does not repeat the first ones
    deliver(tmp_path, "Rossalm_LT_from_20200508_to_20200508.json", "2020-05-08 02:00", [1.0])
    ingest.run_to_table(ingest.closed_periods(stream(spark, tmp_path), "daily"), path + "/out", path + "/state")
    days = [r[0].day for r in listed(spark.read.parquet(path + "/out").where("sensor = 'LT'").select("period"), "period")]
    assert days == [5, 6, 7]


def test_weeks_start_on_monday(spark, tmp_path):
    deliver(tmp_path, "Rossalm_LT_from_20200504_to_20200512.json", "2020-05-04 00:00", [1.0] * (24 * 8))
    path = scratch_dir(spark, "s")
    ingest.run_to_table(ingest.closed_periods(stream(spark, tmp_path), "weekly"), path + "/out", path + "/state")
    got = spark.read.parquet(path + "/out").collect()
    assert [(r["period"], r["readings"]) for r in got] == [(dt.datetime(2020, 5, 10), 24 * 7)]


def test_redelivery_is_dropped(spark, tmp_path):
    deliver(tmp_path, "Rossalm_LT_from_20200505_to_20200506.json", "2020-05-05 00:00", [1.0, 2.0, 3.0], 10)
    path = scratch_dir(spark, "s")

    def run():
        rows = ingest.deduplicated(stream(spark, tmp_path)).select("station_id", "sensor", "ts", "value")
        ingest.run_to_table(rows, path + "/out", path + "/state")

    run()
    deliver(tmp_path, "Rossalm_LT_from_20200505_to_20200507.json", "2020-05-05 00:10", [9.0, 9.0, 4.0], 10)
    run()
    got = sorted(r["value"] for r in spark.read.parquet(path + "/out").collect())
    assert got == [1.0, 2.0, 3.0, 4.0]


def test_late_readings_overlay_the_table(spark, tmp_path, listed):
    path = scratch_dir(spark, "s")
    deliver(tmp_path, "Rossalm_LT_from_20200505_to_20200506.json", "2020-05-05 00:00", [1.0, 2.0], 10)
    deliver(tmp_path, "Rossalm_HS_from_20200505_to_20200506.json", "2020-05-05 00:00", [70.0, 71.0], 10)
    ingest.run_merge(stream(spark, tmp_path), path + "/raw", path + "/state", "ts_utc")
    deliver(tmp_path, "Rossalm_LT_from_20200504_to_20200506.json", "2020-05-04 23:50", [0.5, 8.0], 10)
    ingest.run_merge(stream(spark, tmp_path), path + "/raw", path + "/state", "ts_utc")
    got = listed(store.read_table(spark, path + "/raw").select("ts", "lt", "hs"), "ts")
    assert [(r[0].minute, r[1], r[2]) for r in got] == [(50, 0.5, None), (0, 8.0, 70.0), (10, 2.0, 71.0)]


def test_months_from_closed_days(spark, rows, listed):
    daily = rows("station_id int,sensor string,period timestamp_ntz,readings long,total double",
                 [(1, "N", "2020-04-29 00:00:00", 2, 4.0), (1, "N", "2020-04-30 00:00:00", 1, 5.0), (1, "N", "2020-05-01 00:00:00", 1, 7.0), (2, "N", "2020-04-30 00:00:00", 1, 1.0)])
    got = listed(ingest.closed_months(daily).select("station_id", "period", "mean"), "station_id", "period")
    assert got == [(1, dt.datetime(2020, 4, 30), 3.0), (2, dt.datetime(2020, 4, 30), 1.0)]


def test_batch_alignment_of_stream_files(spark, tmp_path):
    deliver(tmp_path, "Rossalm_LT_from_20200505_to_20200506.json", "2020-05-05 00:00", [1.0] * 144, 10)
    r = portal.with_station_id(portal.read_portal_json(spark, str(tmp_path)), tables.stations(spark))
    day = resample.resample(align.align(r, "ts_utc"), "daily").collect()
    assert len(day) == 1 and day[0]["lt"] == 1.0


def test_months_close_in_the_stream(spark, tmp_path, listed):
    """Over a year end, with a late reading: each month comes once, after its last day is over."""
    path, schema = scratch_dir(spark, "s"), "station_id int, sensor string, ts string, value double"

    def run(*data):
        rows = spark.createDataFrame([(1, "N", t, v) for t, v in data], schema).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        rows.coalesce(1).write.mode("append").parquet(path + "/in")
        readings = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path + "/in")
        ingest.run_to_table(ingest.closed_periods(readings, "monthly"), path + "/out", path + "/state")
        return [(r[0].month, r[1], r[2]) for r in listed(spark.read.parquet(path + "/out").select("period", "readings", "total"), "period")]

    assert run(("2019-12-01 00:00:00", 1.0), ("2019-12-31 23:50:00", 2.0)) == []
    # the new month has begun, the old one waits for what is late
    assert run(("2020-01-01 00:00:00", 4.0), ("2020-01-01 00:30:00", 8.0)) == []
    assert run(("2019-12-31 23:55:00", 16.0), ("2020-01-01 02:00:00", 32.0)) == [(12, 3, 19.0)]
    # too late for December
    assert run(("2019-12-31 10:00:00", 64.0), ("2020-03-01 05:00:00", 1.0)) == [(12, 3, 19.0), (1, 3, 44.0)]
