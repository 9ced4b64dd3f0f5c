"""Cleaning, chunked windows, moving averages and roll-ups."""

import random

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from firnline.operators import align, chunks, clean, latest, merge, moving, resample, season
from firnline.operators.sizes import settled

MEASURES = "station_id int,ts timestamp_ntz,lt double,lf double,hs double,n double,sd double,gs double"


def series(rows, values, column="hs", start="2020-01-01 00:00:00", minutes=10):
    times = pd.date_range(start, periods=len(values), freq=f"{minutes}min")
    data = [(1, str(t), None if v is None else float(v), 0.0) for t, v in zip(times, values)]
    return rows(f"station_id int,ts timestamp_ntz,{column} double,{'lt' if column != 'lt' else 'hs'} double", data)


def column(df, name, order="ts"):
    return [r[0] for r in df.orderBy(order).select(name).collect()]


def whole():
    return Window.partitionBy("station_id").orderBy("ts")


def test_snow_jumps_see_the_nulls_of_the_step_before(rows):
    df = clean.clean_snow(series(rows, [10, 50, 51, 80, 81]), whole())
    assert column(df, "hs") == [10, None, 51, None, 81]


def test_snow_range_and_summer(rows):
    df = clean.clean_snow(series(rows, [-1, 251, 250, None, 3]), whole())
    assert column(df, "hs") == [None, None, 250, None, 3]
    df = clean.clean_snow(series(rows, [6, 5, 7], start="2020-07-01 00:00:00"), whole())
    assert column(df, "hs") == [0, 5, 0]


def test_snow_cannot_grow_when_warm(rows):
    times = ["2020-01-01 00:00:00", "2020-01-01 00:10:00", "2020-01-01 00:20:00"]
    df = rows("station_id int,ts timestamp_ntz,hs double,lt double", [(1, times[0], 10.0, 6.0), (1, times[1], 11.0, 6.0), (1, times[2], 12.0, 5.0)])
    assert column(clean.clean_snow(df, whole()), "hs") == [10, None, 12]


def test_temperature(rows):
    df = clean.clean_temperature(series(rows, [-30, 0, 6, 4, -2, 35, 34], "lt"), whole())
    assert column(df, "lt") == [None, 0, None, 4, None, None, 34]


def test_simple_cleaning(rows):
    df = rows(MEASURES, [(1, "2020-01-01 00:00:00", 0.0, -1.0, 0.0, -0.1, 7200.0, 1000.0), (1, "2020-01-01 00:10:00", 0.0, 0.0, 0.0, 0.0, -1.0, -1.0)])
    out = clean.clean_raw(df, whole()).orderBy("ts").select("lf", "n", "sd", "gs").collect()
    assert [tuple(r) for r in out] == [(None, None, 2.0, pytest.approx(0.6)), (0.0, 0.0, None, None)]


def test_conductivity(rows):
    data = [("a", f"2020-01-01 0{i}:00:00", 3.0, v) for i, v in enumerate([100.0, 106.0, 107.0, 101.0, 50.0])]
    w = Window.partitionBy("site").orderBy("ts")
    out = clean.clean_conductivity(rows("site string,ts timestamp_ntz,wt double,slt double", data), w)
    assert column(out, "slt") == [100, None, 107, None, None]
    assert column(out, "wt") == [3, None, 3, None, None]


def test_cleaning_never_fills_nulls(rows):
    rnd = random.Random(1)
    values = [rnd.choice([None, rnd.uniform(-20, 280)]) for _ in range(300)]
    df = series(rows, values).withColumn("raw", F.col("hs"))
    out = clean.clean_snow(df, whole())
    assert out.where("raw IS NULL AND hs IS NOT NULL").count() == 0
    assert out.where("hs IS NOT NULL AND hs <> raw").count() == 0


def irregular(rows, seed, n=400):
    """Series with dense days, single-row days, gaps over many chunks and a lone station."""
    rnd = random.Random(seed)
    data, when = [], pd.Timestamp("2020-01-01")
    for i in range(n):
        when += pd.Timedelta(minutes=rnd.choice([10, 10, 10, 60, 60 * 30, 60 * 24 * 9 if i % 37 == 0 else 10]))
        data.append((1 + i % 2, str(when), rnd.choice([None, rnd.uniform(0, 60)]), rnd.uniform(-5, 8)))
    data.append((3, "2021-06-01 00:00:00", 1.0, 1.0))
    return rows("station_id int,ts timestamp_ntz,hs double,lt double", data)


@pytest.mark.parametrize("chunk_rows", [1, 30, 4000])
def test_chunked_cleaning_equals_plain(rows, listed, chunk_rows):
    df = irregular(rows, 2)
    plain = clean.clean_snow(df, whole())
    cut = chunks.with_halo(df, clean.clean_snow, before=clean.SNOW_REACH, chunk_rows=chunk_rows)
    assert listed(cut, "station_id", "ts") == listed(plain, "station_id", "ts")


@pytest.mark.parametrize("chunk_rows", [1, 50])
def test_chunked_centred_mean_equals_plain(rows, listed, chunk_rows):
    df = irregular(rows, 3)

    def run(d, w):
        return moving.centred_mean(d, "hs", w, "m", 24, 5)

    before, after = moving.centre_reach(24)
    cut = chunks.with_halo(df, run, before=before, after=after, chunk_rows=chunk_rows)
    assert listed(cut, "station_id", "ts") == listed(run(df, whole()), "station_id", "ts")


def test_chunked_trailing_mean_equals_plain(rows, listed):
    df = irregular(rows, 4)

    def run(d, w):
        return moving.trailing_mean(clean.clean_snow(d, w), "hs", w, "m", 42, 10)

    cut = chunks.with_halo(df, run, before=41 + clean.SNOW_REACH, chunk_rows=60)
    assert listed(cut, "station_id", "ts") == listed(run(df, whole()), "station_id", "ts")


def test_too_little_halo_is_wrong(rows, listed):
    """The reach matters: without copies the chunk starts differ."""
    df = irregular(rows, 2)
    cut = chunks.with_halo(df, clean.clean_snow, before=1, chunk_rows=1)
    assert listed(cut, "station_id", "ts") != listed(clean.clean_snow(df, whole()), "station_id", "ts")


def test_times_that_are_null_are_left_out(rows, listed):
    df = rows("station_id int,ts timestamp_ntz,hs double,lt double", [(1, None, 10.0, 0.0), (1, "2020-01-01 00:00:00", 30.0, 0.0), (1, "2020-01-02 00:00:00", 31.0, 0.0)])
    for chunk_rows in (1, 4000):
        cut = chunks.with_halo(df, clean.clean_snow, before=clean.SNOW_REACH, chunk_rows=chunk_rows)
        assert [r[2] for r in listed(cut, "ts")] == [30.0, 31.0]


def test_one_station_with_most_rows_is_cut(rows, listed):
    rnd = random.Random(8)
    times = pd.date_range("2020-01-01", periods=900, freq="37min")
    data = [(1 if i % 5 else 2 + i % 4, str(t), rnd.choice([None, rnd.uniform(0, 60)]), rnd.uniform(-5, 8)) for i, t in enumerate(times) if not 300 < i < 340]
    df = rows("station_id int,ts timestamp_ntz,hs double,lt double", data)
    seen = []

    def run(d, w):
        seen.append(d.where("_own").groupBy("station_id", "_chunk").count())
        return clean.clean_snow(d, w)

    cut = chunks.with_halo(df, run, before=clean.SNOW_REACH, chunk_rows=100)
    assert listed(cut, "station_id", "ts") == listed(clean.clean_snow(df, whole()), "station_id", "ts")
    sizes = [r["count"] for r in seen[0].collect()]
    assert max(sizes) <= 140 and len(sizes) >= 8


def test_settled(spark):
    small = spark.sql("SELECT * FROM VALUES (1), (2) AS t(a)")
    assert [r[0] for r in settled(small, "t").orderBy("a").collect()] == [1, 2]


def test_centred_mean_positions(rows):
    df = series(rows, range(40), minutes=60)
    full = column(moving.centred_mean(df, "hs", whole(), "m", 24), "m")
    assert [i for i, v in enumerate(full) if v is not None] == list(range(12, 29)) and full[12] == 11.5
    part = column(moving.centred_mean(df, "hs", whole(), "m", 24, 16), "m")
    assert [i for i, v in enumerate(part) if v is not None] == list(range(4, 37))
    want = pd.Series(range(40), dtype=float).rolling(24, center=True, min_periods=16).mean()
    assert part == [None if pd.isna(v) else pytest.approx(v) for v in want]


def test_trailing_mean(rows):
    values = [None if i % 5 == 0 else float(i) for i in range(80)]
    got = column(moving.trailing_mean(series(rows, values), "hs", whole(), "m"), "m")
    want = pd.Series(values, dtype=float).rolling(42, min_periods=30).mean()
    assert got == [None if pd.isna(v) else pytest.approx(v) for v in want]


READ = "station_id int,sensor string,ts timestamp_ntz,value double,seq long"


def test_pivot_keeps_the_first_copy_and_nulls_lose(rows):
    t = "2020-01-01 00:00:00"
    df = rows(READ, [(1, "LT", t, 1.0, 2), (1, "LT", t, 5.0, 3), (1, "LT", t, None, 1), (1, "HS", t, 9.0, 4)])
    out = align.pivot_sensors(df, "seq").collect()
    assert len(out) == 1 and out[0]["lt"] == 1.0 and out[0]["hs"] == 9.0 and out[0]["n"] is None


def test_align_grid(rows):
    data = [(1, "LT", f"2020-01-01 00:{m:02d}:00", 1.0, m) for m in (10, 20, 30)]
    data += [(1, "HS", f"2020-01-01 00:{m:02d}:00", 2.0, m) for m in (5, 15, 17, 25, 40)]
    data += [(2, "SD", "2020-01-01 00:02:00", 3.0, 1), (2, "HS", "2020-01-01 00:02:00", 3.0, 1), (3, "HS", "2020-01-01 00:02:00", 3.0, 1)]
    out = align.align(rows(READ, data), "seq").orderBy("station_id", "ts").collect()
    assert [(r["station_id"], r["ts"].minute, r["lt"], r["hs"], r["sd"]) for r in out] == [
        (1, 10, 1.0, None, None), (1, 15, None, 2.0, None), (1, 20, 1.0, None, None), (1, 25, None, 2.0, None),
        (1, 30, 1.0, None, None), (2, 2, None, 3.0, 3.0),
    ]


def test_dense_grid(rows):
    df = rows(READ, [(1, "LT", "2020-05-05 00:00:00", 1.0, 1), (1, "LT", "2020-05-07 00:00:00", 2.0, 2)])
    wide = align.pivot_sensors(df, "seq")
    out = align.densify(wide, align.anchor_span(df), 300)
    assert out.count() == 577 and out.where("lt IS NOT NULL").count() == 2
    assert out.select("ts").distinct().count() == 577


def test_resample_sum_of_nothing_is_zero(rows):
    df = rows(MEASURES, [(1, "2020-05-06 00:00:00", 2.0, None, None, None, None, 1.0), (1, "2020-05-06 23:50:00", 4.0, None, None, None, None, 2.0)])
    r = resample.resample(df, "d").first()
    assert (r["lt"], r["lf"], r["n"], r["gs"]) == (3.0, None, 0.0, 3.0)


def test_resample_rules_mean_over_readings(rows, spark):
    data = [(1, f"2020-05-04 {h:02d}:{m:02d}:00", float(h), None, None, 1.0, None, None) for h in range(3) for m in range(0, 10 * (h + 1), 10)]
    data += [(2, "2020-05-04 00:00:00", 1.0, None, None, None, None, 4.0), (2, "2020-05-04 01:00:00", 1.0, None, None, None, None, 6.0)]
    has_n = spark.createDataFrame([(1, True), (2, False)], "station_id int, has_n boolean")
    out = {(r["station_id"], r["rule"], str(r["period"])[:10]): r for r in resample.resample_rules(rows(MEASURES, data), has_n).where("rule <> 'hourly'").collect()}
    assert out[1, "daily", "2020-05-04"]["lt"] == pytest.approx((0 + 1 * 2 + 2 * 3) / 6)
    assert out[1, "weekly", "2020-05-10"]["n"] == 6.0
    assert out[2, "monthly", "2020-05-31"]["gs"] == 5.0 and out[2, "monthly", "2020-05-31"]["n"] is None


def test_only_complete_periods(rows):
    df = rows("station_id int,rule string,period timestamp_ntz", [(1, "daily", "2020-05-05 00:00:00"), (1, "daily", "2020-05-06 00:00:00"),
              (1, "weekly", "2020-05-03 00:00:00"), (1, "weekly", "2020-05-10 00:00:00"), (1, "monthly", "2020-04-30 00:00:00"), (1, "monthly", "2020-05-31 00:00:00")])
    bounds = resample.complete_bounds(rows("station_id int,latest_ts timestamp_ntz", [(1, "2020-05-06 12:00:00")]))
    kept = {(r["rule"], r["period"].day) for r in resample.only_complete(df, bounds).collect()}
    assert kept == {("daily", 5), ("weekly", 3), ("monthly", 30)}


def test_dense_resample_keeps_gaps(rows, listed):
    df = rows("site string,ts timestamp_ntz,wt double", [("a", "2020-01-01 05:00:00", 1.0), ("a", "2020-01-04 05:00:00", 3.0), ("b", "2020-02-01 00:00:00", 2.0)])
    out = resample.resample_dense(df, "daily", ["wt"])
    assert [(r[0], r[1].day, r[2]) for r in listed(out, "site", "period")] == [("a", 1, 1.0), ("a", 2, None), ("a", 3, None), ("a", 4, 3.0), ("b", 1, 2.0)]
    months = resample.resample_dense(df.withColumn("ts", F.col("ts")), "monthly", ["wt"])
    assert [(r[0], r[1].month, r[1].day) for r in listed(months, "site", "period")] == [("a", 1, 31), ("b", 2, 29)]


def test_overlay(rows, listed):
    old = rows("station_id int,ts int,hs double", [(1, 1, 1.0), (1, 2, 2.0), (1, 3, 3.0)])
    new = rows("station_id int,ts int,hs double", [(1, 2, 9.0), (1, 3, None), (1, 4, 7.0)])
    full = merge.overlay(old, new, ["station_id", "ts"], ["hs"])
    assert listed(full, "ts") == [(1, 1, 1.0), (1, 2, 9.0), (1, 3, 3.0), (1, 4, 7.0)]
    left = merge.overlay(old, new, ["station_id", "ts"], ["hs"], "left")
    assert listed(left, "ts") == [(1, 1, 1.0), (1, 2, 9.0), (1, 3, 3.0)]


def test_duplicates(rows, listed):
    df = rows("station_id int,ts timestamp_ntz,v double,seq long", [(1, "2020-01-01 00:00:00", 1.0, 2), (1, "2020-01-01 00:00:00", None, 1),
              (1, "2020-01-02 00:00:00", 3.0, 3), (2, "2020-01-01 00:00:00", 4.0, 4)])
    assert listed(merge.duplicate_excess(df), "station_id") == [(1, 1), (2, 0)]
    first = merge.keep_first(df, ["station_id", "ts"], "seq").orderBy("seq").collect()
    assert [(r["seq"], r["v"]) for r in first] == [(1, None), (3, 3.0), (4, 4.0)]
    assert merge.duplicate_rows(df, ["station_id", "ts"]).first()["copies"] == 2


def test_hot_key_collapses_before_the_shuffle(spark):
    """A key with most rows is combined per task: the plan has a partial aggregate below the exchange."""
    df = spark.range(1000).selectExpr("0 AS station_id", "id % 3 AS ts", "CAST(id AS double) AS v", "id AS seq")
    plan = merge.keep_first(df, ["station_id", "ts"], "seq")._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan and "HashAggregate" in plan and "SortAggregate" not in plan


def test_latest(rows, listed):
    data = [(1, f"2020-01-01 00:{m:02d}:00", None if m > 5 else 1.0, None, 2.0, None, None, None) for m in range(16)]
    df = rows(MEASURES, data)
    got = latest.available_sensors(df).first()
    assert got["sensors"] == ["HS"] and got["has_n"] is False
    assert listed(latest.latest_rows(df, ["ts"], 2).select("rank", "ts"), "rank")[0][1].minute == 15


def test_span_falls_back_to_oldest_raw(rows, listed):
    raw = rows("station_id int,ts timestamp_ntz", [(1, "2020-01-01 00:00:00"), (1, "2020-01-09 00:00:00"), (2, "2020-01-05 00:00:00"), (2, "2020-01-06 00:00:00")])
    done = rows("station_id int,period timestamp_ntz", [(1, "2020-01-02 00:00:00"), (1, "2020-01-03 00:00:00")])
    assert [(r[0], r[1].day, r[2].day) for r in listed(latest.span_with_fallback(done, raw), "station_id")] == [(1, 2, 3), (2, 5, 5)]


def test_season_accumulation(rows, listed):
    data = [(1, "2014-09-30", 9.0), (1, "2014-10-01", 5.0), (1, "2014-10-02", 8.0), (1, "2014-10-03", None), (1, "2014-10-04", 20.0),
            (1, "2015-06-30", 21.0), (1, "2015-07-01", 50.0), (1, "2015-10-01", 1.0)]
    out = season.accumulate(season.in_season(rows("station_id int,date date,hs double", data)), "hs")
    assert [(r["season"], r["rise"], r["cum"]) for r in out.orderBy("date").collect()] == [
        (2014, 0.0, 0.0), (2014, 3.0, 3.0), (2014, 0.0, 3.0), (2014, 0.0, 3.0), (2014, 1.0, 4.0), (2015, 0.0, 0.0)]


def test_melt(rows):
    data = [(1, f"2020-01-0{i}", v) for i, v in enumerate([5.0, 3.0, None, 4.0, 4.0, 6.0], 1)]
    df = rows("station_id int,date date,swe double", data)
    assert column(season.melt(df, "swe", "m"), "m", "date") == [2.0, 0.0, 0.0, 0.0, 0.0, None]
    assert column(season.melt(df, "swe", "m", otherwise=None), "m", "date") == [2.0, None, None, None, None, None]
