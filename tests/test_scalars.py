"""Calendar, text and formula expressions against hand-computed values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from firnline.functions import hydro, periods, text
from firnline.schema import rule_name, sensor_list


def one(spark, expr, **cols):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()])
    return df.select(expr).first()[0]


@pytest.mark.parametrize("day, expected", [
    ("2019-09-30", 0), ("2019-10-01", 1), ("2019-12-31", 92), ("2020-01-01", 92), ("2019-01-01", 93),
    ("2020-02-29", 151), ("2020-03-01", 152), ("2020-05-05", 217), ("2020-09-29", 364),
])
def test_hydro_day(spark, day, expected):
    assert one(spark, hydro.hydro_day(F.to_date("d")), d=day) == expected


def test_snow_water_equivalent(spark):
    swe = hydro.snow_water_equivalent("h", "p", "t", F.lit(217))
    assert one(spark, swe, h=74.05, p=69.13125, t=18.0) == pytest.approx(209.74973339, abs=1e-6)
    assert one(spark, swe, h=74.05, p=69.13125, t=0.0) is None


@pytest.mark.parametrize("month, ra", [(1, 10.936257), (6, 43.052599), (12, 9.510342)])
def test_extraterrestrial_radiation(spark, month, ra):
    assert one(spark, hydro.extraterrestrial_radiation("m"), m=month) == pytest.approx(ra, abs=1e-6)


def test_penman_is_null_below_its_range(spark):
    e = hydro.penman_evaporation("g", "t", "f", "r")
    assert one(spark, e, g=10.0, t=-9.6, f=50.0, r=20.0) is None
    assert one(spark, e, g=10.0, t=-9.5, f=50.0, r=20.0) == pytest.approx(-2.4 * 0.25 + 0.09 * 10.5 * 0.5)


def test_lake_ratings(spark):
    assert one(spark, hydro.lake_volume(F.lit("Limo"), "d"), d=7.76025) == pytest.approx(51057.36185, abs=1e-4)
    assert one(spark, hydro.lake_volume(F.lit("Parom"), "d"), d=2.0) == pytest.approx(1372.99 * 4 - 2808.53 * 2 + 1728.66)
    assert one(spark, hydro.lake_area(F.lit("Parom"), "d"), d=3.0) == pytest.approx(3 * 3049.762182195784 - 3382.009706965325)
    assert one(spark, hydro.lake_area(F.lit("Other"), "d"), d=3.0) is None


def test_poly_eval_matches_horner(spark):
    by_array = hydro.poly_eval("x", F.array(F.lit(2.0), F.lit(-3.0), F.lit(0.5), F.lit(1.0)))
    assert one(spark, by_array, x=1.5) == one(spark, hydro.horner("x", [2.0, -3.0, 0.5, 1.0]), x=1.5) == 1.75


def test_groundwater_outflow(spark):
    assert one(spark, hydro.groundwater_outflow(F.lit("Limo")), a=1) == 0.93


def test_seepage_and_inflow(spark):
    cols = [F.to_date(F.lit("2016-08-01")), F.lit(1000.0), F.to_date(F.lit("2016-08-11")), F.lit(136.0)]
    assert one(spark, hydro.seepage(*cols), a=1) == pytest.approx(1.0)
    assert one(spark, hydro.inflow(*cols, F.lit(2.0)), a=1) == pytest.approx(3.0)
    cols[2] = cols[0]
    assert one(spark, hydro.seepage(*cols), a=1) is None


def test_period_labels(spark):
    ts = F.col("t").cast("timestamp_ntz")
    label = {r: one(spark, periods.period(ts, r), t="2020-05-06 13:45:59") for r in ("h", "d", "w", "m")}
    assert label == {
        "h": dt.datetime(2020, 5, 6, 13), "d": dt.datetime(2020, 5, 6), "w": dt.datetime(2020, 5, 10), "m": dt.datetime(2020, 5, 31),
    }
    assert one(spark, periods.period(ts, "w"), t="2020-05-10 23:50:00") == dt.datetime(2020, 5, 10)
    assert one(spark, periods.period(ts, "w"), t="2020-05-04 00:00:00") == dt.datetime(2020, 5, 10)


def test_periods_ignore_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Rome")
    try:
        assert one(spark, periods.hour_start(F.col("t").cast("timestamp_ntz")), t="2020-03-29 02:30:00") == dt.datetime(2020, 3, 29, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_complete_bounds(spark):
    ts = F.col("t").cast("timestamp_ntz")
    bound = {r: one(spark, periods.complete_before(ts, r), t="2020-05-06 13:45:59") for r in ("h", "d", "w", "m")}
    assert bound == {
        "h": dt.datetime(2020, 5, 6, 13), "d": dt.datetime(2020, 5, 6), "w": dt.datetime(2020, 5, 4), "m": dt.datetime(2020, 5, 1),
    }
    assert one(spark, periods.complete_before(ts, "w"), t="2020-05-04 00:00:00") == dt.datetime(2020, 5, 4)


def test_seasons_and_labels(spark):
    assert one(spark, periods.season_start_year(F.to_date("d"), 10), d="2015-06-30") == 2014
    assert one(spark, periods.season_start_year(F.to_date("d"), 10), d="2015-10-01") == 2015
    assert one(spark, periods.winter_label(F.lit(1999)), a=1) == "Winter_99_00"
    assert one(spark, periods.winter_label(F.lit(2008)), a=1) == "Winter_08_09"


def test_text_parsing(spark):
    assert one(spark, text.decimal_comma("v"), v="21,8") == 21.8
    assert one(spark, text.decimal_comma("v"), v="---") is None
    assert one(spark, text.decimal_comma("v"), v="n/a") is None
    assert one(spark, text.date_of("v", "dd/MM/yyyy"), v="31/12/1998") == dt.date(1998, 12, 31)
    assert one(spark, text.date_of("v", "dd/MM/yyyy"), v="rubbish") is None
    assert one(spark, text.portal_local_time("v"), v="2020-05-07T00:00:00CEST") == dt.datetime(2020, 5, 7)
    assert one(spark, text.portal_utc_time("v"), v="2020-10-25T02:10:00CEST") == dt.datetime(2020, 10, 25, 0, 10)
    assert one(spark, text.portal_utc_time("v"), v="2020-10-25T02:10:00CET") == dt.datetime(2020, 10, 25, 1, 10)
    assert one(spark, text.no_nan("v"), v=float("nan")) is None


def test_names():
    assert [rule_name(a) for a in ("Hourly", "h", "mAVG", "Moving")] == ["hourly", "hourly", "movavg", "movavg"]
    with pytest.raises(ValueError):
        rule_name("Yearly")
    assert sensor_list("LT,HS") == ["lt", "hs"]
    with pytest.raises(ValueError):
        sensor_list("LT,XX")
