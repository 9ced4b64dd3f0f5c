"""Snow, lake and panel plans on small tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from firnline.operators import climate, filters, season
from firnline.plans import lakes, panels, swe
from firnline.plans.quality import quality_report

# winter sums of the fixture series by start year, 1998 on
WINTERS = (32.6, 47.4, 0.0, 16.0, 13.2, 0.0, 23.8, 45.4, 95.8, 61.0, 30.4, 171.2, 105.1, 83.1, 99.7, 281.4)


def monthly_rows(rows):
    data = [(4, f"{1998 + i}-12-31 00:00:00", 10.0, w / 2) for i, w in enumerate(WINTERS)]
    data += [(4, f"{1999 + i}-02-28 00:00:00", -5.0, w / 2) for i, w in enumerate(WINTERS)]
    data += [(4, "1998-01-31 00:00:00", -8.0, 500.0), (4, "2014-12-31 00:00:00", 0.0, 900.0)]
    data += [(2, f"{y}-{m:02d}-28 00:00:00", float(m), None) for y in (1998, 1999, 2000) for m in (1, 6, 8)]
    return rows("station_id int,period timestamp_ntz,lt double,n double", data)


def test_winter_precipitation(rows, listed):
    got = dict(listed(climate.winter_precipitation_of(monthly_rows(rows), 4), "station_id"))
    assert got == {2: pytest.approx(69.13125), 4: pytest.approx(69.13125)}


def test_temperature_range(rows, listed):
    got = dict(listed(climate.temperature_range(monthly_rows(rows)), "station_id"))
    assert got[2] == 7.0 and got[4] == pytest.approx((18 + 15 * 15) / 16)


def test_year_before(rows, listed):
    dates = rows("station_id int,date date", [(4, "1999-05-01"), (2, "2000-02-01"), (2, "1998-02-01")])
    td = {(r["station_id"], r["date"].year): r["td"] for r in climate.temperature_range_before(monthly_rows(rows), dates).collect()}
    assert td == {(4, 1999): 18.0, (2, 2000): 7.0, (2, 1998): None}
    p = {(r["station_id"], r["date"].year): r["pptwt"] for r in climate.winter_precipitation_before(monthly_rows(rows), dates, 4).collect()}
    assert p == {(4, 1999): pytest.approx(32.6), (2, 2000): pytest.approx(47.4), (2, 1998): 500.0}


def test_swe_plans_agree_with_the_formula(rows):
    daily = rows("station_id int,date date,hs double,lt double", [(2, "2000-02-01", 80.0, -1.0), (4, "2000-02-02", None, 0.0), (2, "2000-02-03", 0.0, 1.0)])
    monthly = monthly_rows(rows)
    got = {(r["station_id"], r["date"].day): r["swe"] for r in swe.swe_period(daily, monthly, precipitation_station=4).collect()}
    assert got[2, 1] == pytest.approx(_swe(80.0, 69.13125, 7.0, 123)) and got[4, 2] is None and got[2, 3] == 0.0
    point = swe.swe_at(daily, monthly, "2000-02-01").collect()
    assert len(point) == 1 and point[0]["swe"] == pytest.approx(got[2, 1])
    special = {r["date"].day: r["swe"] for r in swe.swe_specific(daily, monthly).where("station_id = 2").collect()}
    assert special[1] == pytest.approx(_swe(80.0, 47.4, 7.0, 123))


def _swe(hs, p, t, d):
    import math
    a, b, s = (0.0533, 0.948, 0.1701, -0.1314, 0.2922), (0.0481, 1.0395, 0.1699, -0.0461, 0.1804), math.tanh(0.01 * (d - 180))

    def part(k):
        return k[0] * (hs * 10) ** k[1] * p ** k[2] * t ** k[3] * d ** k[4]

    return part(a) * (1 - s) / 2 + part(b) * (1 + s) / 2


DAILY = "station_id int,date date,lt double,lf double,gs double,n double"


def test_penman_joins_by_date(rows):
    daily = rows(DAILY, [(5, "2020-06-01", None, None, 20.0, None), (5, "2020-06-03", None, None, 10.0, None),
                         (2, "2020-06-01", 10.0, 50.0, None, None), (2, "2020-06-02", 10.0, 50.0, None, None), (2, "2020-06-03", None, 50.0, None, None)])
    got = lakes.penman_daily(daily).collect()
    ra = 43.052599
    assert len(got) == 1 and got[0]["epen"] == pytest.approx(0.047 * 20 * 19.5**0.5 - 2.4 * (20 / ra) ** 2 + 0.09 * 30 * 0.5, abs=1e-6)


def test_lake_evaporation(rows):
    calc = rows("lake string,date date,area_glatt double,wd double", [("Limo", "2020-06-01", 1000.0, 5.0), ("Limo", "2020-06-02", 1000.0, 11.0),
                ("Limo", "2020-03-01", None, 8.0), ("Parom", "2020-06-01", None, 11.0), ("Limo", "2020-07-01", 5.0, None), ("Limo", "2020-08-01", 5.0, 1.0)])
    epen = rows("date date,epen double", [("2020-06-01", 2.0), ("2020-03-01", 1.0), ("2020-06-02", 1.0)])
    got = {(r["lake"], r["date"].month): r for r in lakes.lake_evaporation(calc, epen).collect()}
    assert set(got) == {("Limo", 6), ("Limo", 3), ("Parom", 6), ("Limo", 8)}
    assert got["Limo", 6]["epen_area"] == 2000.0 and got["Limo", 6]["epen_shed"] == pytest.approx(-2000 / 849285)
    assert got["Limo", 3]["epen_area"] is None and got["Limo", 3]["epen_shed"] < 0
    assert got["Parom", 6]["area_glatt"] == pytest.approx(11 * 3049.762182195784 - 3382.009706965325)
    assert got["Limo", 8]["epen"] is None
    with pytest.raises(Exception, match="no evaporation on 2020-08-01"):
        lakes.lake_evaporation(calc, epen, strict=True).collect()


def test_water_balance_and_flows(rows):
    log = rows("lake string,date date,w_change double", [("Limo", "2020-04-01", 849.285), ("Limo", "2020-04-02", 0.0), ("Limo", "2020-04-03", None)])
    daily = rows(DAILY, [(4, f"2020-04-0{i}", None, None, None, 10.0) for i in (1, 2, 3, 4)])
    snow = rows("station_id int,date date,swe double", [(2, "2020-03-31", 900.0), (2, "2020-04-01", 100.0), (2, "2020-04-02", 90.0), (2, "2020-04-03", 95.0), (2, "2020-04-04", 0.0)])
    got = lakes.water_balance(log, daily, snow).orderBy("date").collect()
    assert [(r["n"], r["snowmelt"], r["lakestorage"]) for r in got] == [(8.8, 10.0, pytest.approx(1.0)), (8.8, 0.0, 0.0), (8.8, None, None)]
    assert got[0]["ssgw"] == pytest.approx(8.8 + 10 - 0.93 - 1) and got[2]["ssgw"] is None
    flow = lakes.inflow_outflow(log, daily, snow).orderBy("date").collect()
    assert [r["snowmelt"] for r in flow] == [10.0, None, None] and [r["n"] for r in flow] == [10.0] * 3
    base = lakes.baseflow(log, daily, "Limo", "2020-04-02", "2020-04-09").orderBy("date").collect()
    assert [(r["date"].day, r["n_effective"]) for r in base] == [(2, 8.8), (3, 8.8)]


PROCESSED = "station_id int,rule string,period timestamp_ntz,hs double,lt double,n double"


def hourly(rows, n=60):
    t0 = dt.datetime(2019, 4, 14)
    data = [(s, "hourly", str(t0 + dt.timedelta(hours=i)), 10.0 + i, 1.0, 0.5) for s in (2, 4) for i in range(n)]
    spring = [("spring", str(t0 + dt.timedelta(hours=i, minutes=5)), 3.0 + i, 100.0 + i) for i in range(n) if i != 7]
    return rows(PROCESSED, data), rows("site string,ts timestamp_ntz,wt double,slt double", spring)


def test_spring_panel(rows):
    processed, spring = hourly(rows)
    got = {r["period"]: r for r in panels.spring_panel(spring, processed, "Hourly").collect()}
    assert len(got) == 58 and min(got) == dt.datetime(2019, 4, 14, 1)
    assert got[dt.datetime(2019, 4, 14, 7)]["slt"] is None and got[dt.datetime(2019, 4, 14, 7)]["slt_rol"] is None
    assert got[dt.datetime(2019, 4, 15, 6)]["slt_rol"] == pytest.approx(100 + sum(range(18, 42)) / 24)
    # precipitation ends at midnight of the last day
    assert got[dt.datetime(2019, 4, 16, 0)]["n"] == 0.5 and got[dt.datetime(2019, 4, 16, 1)]["n"] is None


def test_spring_snow_panel(rows):
    processed, spring = hourly(rows)
    got = {r["period"]: r for r in panels.spring_snow_panel(spring, processed, "Hourly", clean=True).collect()}
    assert got[dt.datetime(2019, 4, 14, 6)]["slt_rol"] is not None and got[dt.datetime(2019, 4, 14, 6)]["hs"] == 16.0
    assert got[dt.datetime(2019, 4, 14, 4)]["hs_rol"] == pytest.approx(10 + sum(range(16)) / 16)


def test_lake_panels(rows):
    logger = rows("site string,ts timestamp_ntz,wd double", [(s, f"2016-06-0{i} 06:00:00", float(i)) for s in ("lower", "upper") for i in (1, 2, 3, 4)])
    processed = rows(PROCESSED, [(4, "daily", f"2016-06-0{i} 00:00:00", None, None, float(i)) for i in range(1, 8)])
    level = panels.lake_level_panel(logger, processed).orderBy("period").collect()
    assert [(r["period"].day, r["wd_lower"], r["wd_upper"], r["n"]) for r in level] == [(2, 2.0, 2.0, 2.0), (3, 3.0, 3.0, 3.0)]
    volume = panels.lake_volume_panel(logger.where("site = 'lower'"), processed, "Parom", right="2016-06-03 00:00:00", left="2016-06-01 00:00:00").collect()
    assert len(volume) == 1 and volume[0]["vol"] == pytest.approx(1372.99 * 4 - 2808.53 * 2 + 1728.66)


def test_yearly_maxima_prefer_measured(rows, listed):
    calc = rows("lake string,date date,volume double,vol_calc double", [("Limo", "2015-06-01", None, 27566.916), ("Limo", "2016-06-01", 74759.727, 66963.3),
                ("Limo", "2017-06-01", 18940.361, 21867.948), ("Limo", "2018-06-01", 105275.72, 111958.778), ("Limo", "2019-06-01", None, 100206.415), ("Limo", "2020-06-01", None, 118646.763)])
    got = [r["max_vol"] for r in season.yearly_maxima(calc).orderBy("year").collect()]
    assert got == [27566.916, 74759.727, 18940.361, 105275.72, 100206.415, 118646.763]
    snow = rows("station_id int,date date,hs double", [(2, f"{y}-{m}", v) for y in range(2014, 2019) for m, v in (("10-01", 0.0), ("11-01", 10.0 * (y - 2013)))])
    pairs = panels.volume_and_snow(calc, snow, "Limo", "hs").orderBy("year").collect()
    assert [(r["year"], r["season"], r["max_cum"]) for r in pairs] == [(2014 + i, 2013 + i, 10.0 * i) for i in range(1, 6)]
    line = panels.volume_snow_regression(calc, snow, "Limo", "hs").first()
    assert line["pairs"] == 5 and 0 <= line["r2"] <= 1


def test_winter_panels(rows, listed):
    data = [(1, "daily", "2016-10-18 00:00:00", 5.0), (1, "daily", "2016-12-01 00:00:00", 7.0), (1, "daily", "2017-08-01 00:00:00", 9.0),
            (2, "daily", "2016-12-01 00:00:00", None), (2, "daily", "2001-12-01 00:00:00", 3.0), (2, "daily", "2018-01-01 00:00:00", 4.0), (2, "daily", "2018-02-01 00:00:00", None)]
    processed = rows("station_id int,rule string,period timestamp_ntz,hs double", data)
    zero = rows("station_id int,from_date date,to_date date", [(1, "2016-10-17", "2016-11-03")])
    got = listed(panels.winter_panels(processed, "Daily", zero).select("station_id", "date", "hs", "winter"), "station_id", "date")
    assert got == [(1, dt.date(2016, 10, 18), 0.0, "Winter_16_17"), (1, dt.date(2016, 12, 1), 7.0, "Winter_16_17"),
                   (2, dt.date(2018, 1, 1), 4.0, "Winter_17_18"), (2, dt.date(2018, 2, 1), 0.0, "Winter_17_18")]
    keys = panels.panel_keys(panels.winter_panels(processed, "Daily", zero))
    assert [r["winter"] for r in keys.orderBy("season").collect()] == ["Winter_16_17", "Winter_17_18"]


def test_snow_monthly(rows, listed):
    data = [(4, "monthly", f"2015-{m:02d}-28 00:00:00", None, None, 10.0) for m in range(1, 13)] + [(4, "monthly", "2016-01-31 00:00:00", None, None, 10.0)]
    data += [(2, "monthly", "2015-01-31 00:00:00", 80.0, None, None), (1, "monthly", "2016-01-31 00:00:00", 50.0, None, None)]
    got = listed(panels.snow_monthly(rows(PROCESSED, data)).select("station_id", "hs", "n_year"), "station_id")
    assert got == [(1, 50.0, None), (2, 80.0, 120.0)]


def test_isotopes(rows, listed):
    s = rows("site string,date date,d18o double,d18o_sd double,d2h double,d2h_sd double", [("a", "2019-01-01", -12.0, 0.5, -85.0, 0.25), ("LimoseeSüd", "2019-01-02", -10.0, 0.5, -70.0, 0.25)])
    r = panels.isotope_view(s, "a").first()
    assert (r["d18o_lo"], r["d2h_hi"], r["line"], r["line_lo"], r["line_hi"]) == (-12.5, -84.75, -86.0, -94.0, -78.0)
    assert panels.isotopes_by_date(s, "LimoseeSüd").count() == 1 and panels.isotopes_by_date(s).count() == 2
    grid = s.limit(1).select(F.inline(panels.water_line_grid(F.lit(-13.0), F.lit(-12.0)))).collect()
    assert len(grid) == 10 and grid[0]["line"] == -94.0


def test_filters(rows, spark):
    wide = rows("station_id int,ts timestamp_ntz,lt double,hs double", [(1, "2020-01-01 00:00:00", 1.0, 1.0), (1, "2020-01-02 00:00:00", 1.0, 1.0), (1, "2020-01-02 00:10:00", 1.0, 1.0), (2, "2020-01-01 00:00:00", 1.0, 1.0)])
    assert filters.scan_raw(wide, 1, "LT", "20200101", "20200102").count() == 2
    assert filters.scan_raw(wide, 1, "LT").columns == ["station_id", "ts", "lt"] and filters.scan_raw(wide, 1, "LT").count() == 3
    assert filters.day_slice(wide, "ts", "2020-01-02", "2020-01-02").count() == 2
    processed = rows("station_id int,rule string,period timestamp_ntz,hs double,lt double", [(1, "movavg", "2020-01-01 00:00:00", 2.0, None)])
    assert filters.scan_processed(processed, 1, "Moving", "LT").columns == ["station_id", "period", "hs"]
    assert filters.not_value(rows("wd double", [(11.0,), (None,), (3.0,)]), "wd", 11).count() == 2


def test_quality_report(rows):
    wide = rows("station_id int,ts timestamp_ntz,lt double,lf double,hs double,n double,sd double,gs double",
                [(1, "2020-01-01 00:00:00", 1.0, None, None, 2.0, None, None), (1, "2020-01-01 00:00:00", 1.0, None, None, None, None, None), (1, "2020-01-02 00:00:00", None, None, 1.0, None, None, None)])
    r = quality_report(wide).first()
    assert (r["rows"], r["duplicates"], r["sensors"], r["has_n"], r["latest_ts"]) == (3, 1, ["LT", "HS", "N"], True, dt.datetime(2020, 1, 2))
