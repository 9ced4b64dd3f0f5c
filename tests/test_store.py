"""The store against plain Python: any order of deliveries, the autumn hour, deletes, and rebuilds of what a change touches."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from firnline.plans import update
from firnline.schema import SENSOR_COLS
from firnline.session import scratch_dir
from firnline.sources import store

READINGS = "station_id int,sensor string,ts timestamp_ntz,ts_utc timestamp_ntz,value double,load_seq long"
T0 = dt.datetime(2020, 5, 1)


def readings(rows, data):
    """(station, sensor, ts, value, load_seq) with UTC two hours before."""
    return rows(READINGS, [(s, x, str(t), str(t - dt.timedelta(hours=2)), v, n) for s, x, t, v, n in data])


def table(spark, path):
    got = store.read_table(spark, path).select("station_id", "ts", *SENSOR_COLS).collect()
    return sorted(map(tuple, got), key=str)


def processed(spark, path):
    return sorted((tuple(r) for r in store.read_table(spark, path).select("station_id", "rule", "period", *SENSOR_COLS).collect()), key=str)


def minutes(n):
    return T0 + dt.timedelta(minutes=n)


def test_any_order_of_deliveries_gives_the_same_table(spark, rows):
    rnd = random.Random(3)
    at = lambda: minutes(10 * rnd.randrange(6))
    first = [(1, "HS", minutes(3 + 10 * i), 7.0, 50 + i) for i in range(3)]  # off the grid of the anchor sensor, known later
    parts = [first + [(2, "N", at(), float(i), rnd.randrange(4)) for i in range(12)],
             [(1, rnd.choice(["LT", "HS"]), at(), float(i), rnd.randrange(4)) for i in range(20)] + [(1, "LT", minutes(0), 3.0, 9)],
             [(1, "LT", at(), float(i), rnd.randrange(4)) for i in range(20)]]
    want = {}
    for s, x, t, v, n in itertools.chain(*parts):
        if not (s == 1 and t.minute % 10 == 3):
            key = s, x, t
            want[key] = max(want.get(key, (n, v)), (n, v))
    grid = sorted({(s, t) for s, _, t in want})
    cells = [(s, t, *(want[s, c.upper(), t][1] if (s, c.upper(), t) in want else None for c in SENSOR_COLS)) for s, t in grid]
    for order in ((0, 1, 2), (2, 1, 0)):  # each of the grids is the first one once
        raw = scratch_dir(spark, "order")
        for k in order:
            update.ingest(spark, readings(rows, parts[k]), raw, "load_seq", newest=True)
        assert table(spark, raw) == sorted(cells, key=str)
        off = store.read_table(spark, f"{raw}-off")
        assert sorted(r["hs"] for r in off.collect()) == [7.0] * 3
    update.ingest(spark, readings(rows, parts[0]), raw, "load_seq", newest=True)  # again
    assert table(spark, raw) == sorted(cells, key=str)


def test_rows_kept_aside_come_back(spark, rows):
    raw = scratch_dir(spark, "grid")
    update.ingest(spark, readings(rows, [(1, "SD", minutes(3), 1.0, 1), (1, "HS", minutes(10), 5.0, 2)]), raw, "load_seq", newest=True)
    assert [r[1] for r in table(spark, raw)] == [minutes(3)]
    left = update.ingest(spark, readings(rows, [(1, "LT", minutes(0), 1.0, 3)]), raw, "load_seq", newest=True)
    assert [r[1] for r in table(spark, raw)] == [minutes(0), minutes(10)] and left.count() == 0


def autumn(rows):
    """LT rises by 1 every ten minutes through the hour that comes twice, until 05:00."""
    start = dt.datetime(2020, 10, 24, 23, 0)
    data = []
    for i in range(31):
        utc = start + dt.timedelta(minutes=10 * i)
        local = utc + dt.timedelta(hours=2 if utc < dt.datetime(2020, 10, 25, 1) else 1)
        data.append((1, "LT", str(local), str(utc), float(i), i))
        data.append((1, "HS", str(local), str(utc), 50.0, i))
    return rows(READINGS, data)


def test_the_hour_that_comes_twice(spark, rows):
    raw, done = scratch_dir(spark, "raw"), scratch_dir(spark, "processed")
    update.ingest_and_rebuild(spark, autumn(rows), raw, done)
    hours = {r["period"].hour: r["lt"] for r in store.read_table(spark, done).where("rule = 'hourly'").collect()}
    assert hours == {1: 2.5, 2: 11.5, 3: 20.5, 4: 26.5}
    keys = store.read_table(spark, done).groupBy("station_id", "rule", "period").count()
    assert keys.where("count > 1").count() == 0
    moving = store.read_table(spark, done).where("rule = 'movavg'")
    assert moving.count() == 31 and moving.where("hs = 50").count() == 2  # 30 values are there from the 30th on
    full = scratch_dir(spark, "full")
    update.update_processed(spark, raw, full)
    update.update_moving(spark, raw, full)
    assert processed(spark, full) == processed(spark, done)


def daily_rows(rows, days, station=1, start=T0, seq=0, shift=0.0):
    data = []
    for d, h in itertools.product(days, (0, 6, 12, 18)):
        t = start + dt.timedelta(days=d, hours=h)
        data += [(station, "LT", t, (d * 3 + h) % 7 + shift, seq), (station, "HS", t, 40.0 + (d * 5 + h) % 8 + shift, seq)]
    return readings(rows, data)


def test_deleted_rows_stay_away(spark, rows):
    raw, done = scratch_dir(spark, "raw"), scratch_dir(spark, "processed")
    update.ingest_and_rebuild(spark, daily_rows(rows, range(60)), raw, done)
    update.ingest_and_rebuild(spark, daily_rows(rows, range(60), station=2, start=T0 + dt.timedelta(days=400)), raw, done)
    assert update.delete_span(spark, raw, 1, "2020-05-01 00:00:00", "2020-05-31 23:59:59", done) == 31 * 4
    assert update.delete_span(spark, raw, 2, "2000-01-01 00:00:00", "2100-01-01 00:00:00", done) == 240
    left = [r for r in table(spark, raw)]
    assert {r[0] for r in left} == {1} and min(r[1] for r in left) == dt.datetime(2020, 6, 1)
    assert store.read_table(spark, done).where("station_id = 2 OR (rule = 'daily' AND period < '2020-06-01')").count() == 0
    # a later merge does not bring them back, nor does a full rebuild
    update.ingest_and_rebuild(spark, daily_rows(rows, [60, 61], seq=5), raw, done)
    update.update_processed(spark, raw, done)
    update.update_moving(spark, raw, done)
    assert min(r[1] for r in table(spark, raw)) == dt.datetime(2020, 6, 1) and len(table(spark, raw)) == 31 * 4
    fresh, want = scratch_dir(spark, "fresh"), scratch_dir(spark, "want")
    update.ingest_and_rebuild(spark, daily_rows(rows, range(31, 60)), fresh, want)
    update.ingest_and_rebuild(spark, daily_rows(rows, [60, 61], seq=5), fresh, want)
    assert processed(spark, done) == processed(spark, want)
    assert update.delete_span(spark, raw, 9, "2000-01-01 00:00:00", "2100-01-01 00:00:00", done) == 0
    # and what is delivered again is there again
    update.ingest(spark, daily_rows(rows, [0]), raw, "load_seq", newest=True)
    assert len(table(spark, raw)) == 32 * 4


def test_a_delete_that_broke_off_is_finished(spark, rows, monkeypatch):
    raw = scratch_dir(spark, "raw")
    update.ingest(spark, daily_rows(rows, range(40)), raw, "load_seq", newest=True)

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(store, "_move", lost)
        with pytest.raises(RuntimeError):
            update.delete_span(spark, raw, 1, "2020-05-01 00:00:00", "2020-05-31 23:59:59")
    assert len(table(spark, raw)) == 160
    store.finish_merge(spark, raw)
    assert len(table(spark, raw)) == 36 and store.days_of(spark, raw).agg(F.sum("n")).first()[0] == 36


def test_a_change_rebuilds_what_it_touches(spark, rows):
    """Deliveries of single days, late ones, corrections and the first rain against a rebuild of all."""
    raw, done = scratch_dir(spark, "raw"), scratch_dir(spark, "processed")
    base = [d for d in range(75) if d not in (20, 21, 50)]
    rain = readings(rows, [(1, "N", T0 + dt.timedelta(days=33, hours=6), 2.0, 9)])
    steps = [daily_rows(rows, base), daily_rows(rows, [20, 21], seq=1), daily_rows(rows, [50, 76], seq=2), daily_rows(rows, [30], seq=3, shift=2.0), rain]
    for step in steps:
        update.ingest_and_rebuild(spark, step, raw, done)
    full = scratch_dir(spark, "full")
    update.update_processed(spark, raw, full)
    update.update_moving(spark, raw, full)
    assert processed(spark, done) == processed(spark, full) and len(processed(spark, done)) > 500


def test_a_days_change_reads_a_few_partitions(spark, rows):
    days = rows("station_id int,day date,n long", [(s, str(T0.date() + dt.timedelta(days=d)), 4) for s in (1, 2) for d in range(900) if d % 3])
    known = rows("station_id int,grid_from timestamp_ntz,grid_to timestamp_ntz,origin timestamp_ntz,latest_ts timestamp_ntz,has_n boolean",
                 [(s, "2020-05-01 00:00:00", "2022-10-18 00:00:00", "2020-05-01 00:00:00", "2022-10-18 00:00:00", True) for s in (1, 2)])
    touched = rows("station_id int,day date", [(1, "2021-06-17")])
    plan = update.change_set(days, touched, known, known).collect()
    assert {r["station_id"] for r in plan} == {1}
    # the last day has become complete since, perhaps; the rest is about the day that came
    plan = [r for r in plan if r["day"] < dt.date(2022, 1, 1)]
    assert [r["day"] for r in plan if r["changed"]] == [dt.date(2021, 6, 17), dt.date(2021, 6, 18)]  # four rows a day, cleaning looks back on three
    months = {(r["day"].year, r["day"].month) for r in plan if r["read_periods"] or r["read_moving"]}
    assert months == {(2021, 5), (2021, 6), (2021, 7)}
    # 44 rows back are eleven days with rows
    assert sum(r["moving"] for r in plan) == 12 and sum(r["read_moving"] for r in plan) == 12 + 11
    assert sum(r["needed"] for r in plan) == 20 and sum(r["read_periods"] for r in plan) == 21


def test_scan_of_a_day_reads_few_row_groups(spark, rows, tmp_path):
    """Files are sorted by time, so the statistics of their row groups tell days apart."""
    import pyarrow.parquet as pq
    data = [(1, "LT", T0 + dt.timedelta(minutes=10 * i), float(i), 1) for i in range(31 * 144)]
    random.Random(1).shuffle(data)
    path = str(tmp_path / "raw")
    with_small = spark.conf.get("parquet.block.size", None)
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", "4096")
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.row.count.limit", "500")
    try:
        update.ingest(spark, readings(rows, data), path, "load_seq", newest=True)
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.row.count.limit")
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
    assert with_small is None
    groups = []
    for f in (tmp_path / "raw").rglob("*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index("ts")
        groups += [(meta.row_group(g).column(at).statistics.min, meta.row_group(g).column(at).statistics.max) for g in range(meta.num_row_groups)]
    groups.sort()
    assert len(groups) > 5 and all(a[1] < b[0] for a, b in zip(groups, groups[1:]))


def test_a_merge_reads_its_partitions_only(spark, rows, tmp_path):
    """The partitions a delivery does not fall into may even be unreadable."""
    path = str(tmp_path / "raw")
    update.ingest(spark, daily_rows(rows, (0, 40, 80)), path, "load_seq", newest=True)
    spoiled = [p for p in (tmp_path / "raw").rglob("*.parquet") if "month=6" not in str(p)]
    kept = [(p, p.read_bytes()) for p in spoiled]
    for p, data in kept:
        footer = 8 + int.from_bytes(data[-8:-4], "little")  # it stays, as Spark looks at one for the schema
        p.write_bytes(data[:4] + b"\xff" * (len(data) - 4 - footer) + data[-footer:])
        p.with_name(f".{p.name}.crc").unlink(missing_ok=True)
    store.merge_raw(spark, rows("station_id int,ts timestamp_ntz,lt double", [(1, "2020-06-20 00:00:00", 9.0)]), path)
    for p, data in kept:
        p.write_bytes(data)
    assert len(kept) == 2 and len(table(spark, path)) == 13
    p, data = kept[0]
    p.write_bytes(data[:4] + b"\xff" * (len(data) - 4 - footer) + data[-footer:])
    spark.catalog.refreshByPath(path)
    with pytest.raises(Exception):  # noqa: B017
        table(spark, path)  # such a file cannot be read
