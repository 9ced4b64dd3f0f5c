"""File sources, manifest, request plan and partitioned tables."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from firnline.operators import filters
from firnline.plans import update
from firnline.schema import SENSOR_COLS
from firnline.sources import historic, manifest, portal, requests, store, tables
from firnline.session import scratch_dir


def write_portal(folder, station, sensor, first, values, minutes=10, zone="CEST"):
    start = dt.datetime.strptime(first, "%Y-%m-%d %H:%M")
    data = [{"DATE": (start + dt.timedelta(minutes=minutes * i)).strftime("%Y-%m-%dT%H:%M:%S") + zone, "VALUE": v} for i, v in enumerate(values)]
    folder.mkdir(parents=True, exist_ok=True)
    last = (start + dt.timedelta(minutes=minutes * len(values))).strftime("%Y%m%d")
    path = folder / f"{station}_{sensor}_from_{start:%Y%m%d}_to_{last}.json"
    path.write_text(json.dumps(list(reversed(data))))
    return path


def test_portal_json(spark, tmp_path, listed):
    write_portal(tmp_path / "St. Veit", "St. Veit", "LT", "2020-05-05 00:00", [1.5, None, 2.5])
    write_portal(tmp_path / "Rossalm", "Rossalm", "HS", "2020-05-05 00:00", [70])
    (tmp_path / "Rossalm" / "notes.json").write_text('[{"DATE": "2020-05-05T00:00:00CEST", "VALUE": 1}]')
    out = portal.with_station_id(portal.read_portal_json(spark, str(tmp_path)), tables.stations(spark))
    got = listed(out.select("station_id", "sensor", "ts", "ts_utc", "value"), "station_id", "ts")
    assert got[0] == (2, "HS", dt.datetime(2020, 5, 5), dt.datetime(2020, 5, 4, 22), 70.0)
    assert [(r[0], r[4]) for r in got[1:]] == [(6, 1.5), (6, None), (6, 2.5)]


def test_station_table(spark):
    got = {r["station_name"]: (r["station_id"], r["station_code"]) for r in tables.stations(spark).collect()}
    assert got["Piz La Ila"] == (1, "61690SF") and got["Wolkenstein"] == (4, "73500MS") and len(got) == 6


PREAMBLE = "\n".join(f"line {i}" for i in range(12)) + "\nDatum\tUhrzeit\tWert[mm]\tStatus des Werts\n"


def test_historic(spark, tmp_path, listed):
    (tmp_path / "73500MS_Wolkenstein_SelvaGardena_N_Month.Total.csv").write_text(
        PREAMBLE + "01/01/1998\t00:00:00\t21,8\t40 (Gut)\n01/02/1998\t00:00:00\t3,2\t80 (Ersatzwert)\n"
        "01/03/1998\t00:00:00\t---\t255 (255)\n01/08/2014\t00:00:00\t9,0\t40 (Gut)\n")
    (tmp_path / "61690SF_PizLaIla_HS_Day.csv").write_text(PREAMBLE + "02/01/1998\t00:00:00\t100,0\t40 (Gut)\n")
    out = historic.historic_wide(historic.read_historic(spark, str(tmp_path)))
    got = listed(out.select("station_id", "resolution", "date", "hs", "n"), "station_id", "date")
    assert got == [
        (1, "daily", dt.date(1998, 1, 2), 100.0, None), (4, "monthly", dt.date(1998, 1, 31), None, 21.8),
        (4, "monthly", dt.date(1998, 2, 28), None, None), (4, "monthly", dt.date(1998, 3, 31), None, None),
    ]


def test_lake_and_isotope_csv(spark, tmp_path):
    limo, parom, calc, iso = (tmp_path / n for n in ("limo.csv", "parom.csv", "calc.csv", "iso.csv"))
    limo.write_text("Datum,WD,Vol,W_change\n2016-06-10,7.76025,51057.36185,400.89066\n2016-06-11,7.7894167,51458.25251,\n")
    parom.write_text("Datum,Volume,WD,W_change\n2016-06-10,100.0,2.0,1.0\n")
    calc.write_text("Datum,Area,Area_glatt,Vol_calc,Volume,WD,WD_calc,WD_calc_smooth\n2015-06-01,,10.5,,,1.0,,\n")
    iso.write_text("Datum,Sample,d18O,s.d. d18O,d2H,s.d. d2H,Quelle\n2019-03-29,A-1,-12.1,0.07,-85.1,0.26,Pederü\n")
    a = tables.read_lake_log(spark, str(limo), "Limo").orderBy("date").collect()
    assert (a[0]["lake"], a[0]["date"], a[0]["volume"], a[1]["w_change"]) == ("Limo", dt.date(2016, 6, 10), 51057.36185, None)
    b = tables.read_lake_log(spark, str(parom), "Parom").first()
    assert (b["wd"], b["volume"]) == (2.0, 100.0)
    c = tables.read_lake_calc(spark, str(calc), "Limo").first()
    assert (c["area_glatt"], c["volume"], c["wd"], c["wd_calc_smooth"]) == (10.5, None, 1.0, None)
    d = tables.read_isotopes(spark, str(iso)).first()
    assert (d["site"], d["d18o_sd"], d["d2h_sd"]) == ("Pederü", 0.07, 0.26)


def test_station_metadata(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"Wolkenstein": {"coords": [712242.5, 5158393.9],\n "scode": "73500MS", "alt": 1594}, "Lavazé": {"alt": 1}}')
    got = {r["name"]: tuple(r)[1:] for r in tables.read_station_metadata(spark, str(tmp_path / "m.json")).collect()}
    assert got == {"Wolkenstein": ("73500MS", 1594, 712242.5, 5158393.9), "Lavazé": (None, 1, None, None)}


def test_logger_sheet(spark, tmp_path):
    sheet = tmp_path / "sheet.csv"
    sheet.write_text('"Date Time, GMT+02:00",#,"Temp, °C","T2 (m)"\n2019-04-14 00:00:00,1,3.5,2.25\n')
    out = tables.read_logger(spark, str(sheet), "`Date Time, GMT+02:00` timestamp_ntz, `#` int, `Temp, °C` double, `T2 (m)` double", [0, 3, 2])
    assert out.columns == ["ts", "wd", "wt"] and tuple(out.first()) == (dt.datetime(2019, 4, 14), 2.25, 3.5)
    with pytest.raises(ValueError):
        tables.normalise_logger(spark.range(1), [0])


def test_manifest(spark, tmp_path, listed):
    for folder, name in (("Rossalm", "Rossalm_LT_a.json"), ("Processed", "Rossalm_x.json"), ("1998_to_2014", "Rossalm_y.json"), ("Rossalm", "Rossalm_z.csv"), ("St. Veit", "St. Veit_N.json")):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_text("[]")
    files = manifest.list_files(spark, str(tmp_path))
    names = [r[0].split("/")[-1] for r in listed(manifest.station_files(files), "path")]
    assert [n.replace("%20", " ") for n in names] == ["Rossalm_LT_a.json", "St. Veit_N.json"]
    assert manifest.station_files(files, "Rossalm").count() == 1
    disk = spark.createDataFrame([("a",), ("b",)], "path string")
    seen = spark.createDataFrame([("b",), ("c",)], "path string")
    assert listed(manifest.file_changes(disk, seen), "path") == [("a", "added"), ("c", "removed")]
    assert [r[0] for r in listed(manifest.next_manifest(disk, seen), "path")] == ["a", "b", "c"]
    assert [r[0] for r in listed(manifest.forget_files(seen, "c"), "path")] == ["b"]


def test_request_plan(rows, spark, listed):
    known = rows("station_id int,latest_date date", [(1, "2013-01-01"), (2, "2020-05-07"), (3, "2020-05-01")])
    known = known.withColumn("sensors", F.array(F.lit("LT"), F.lit("N")))
    out = listed(requests.plan_requests(known, F.lit("2020-05-07").cast("date")), "station_id", "sensor", "part")
    cuts = {}
    for station, sensor, _, first, last in out:
        cuts.setdefault((station, sensor), [first.strftime("%Y%m%d")]).append(last.strftime("%Y%m%d"))
    assert cuts == {
        (1, "LT"): ["20140801", "20160703", "20180605", "20200507"],
        (1, "N"): ["20140801", "20150718", "20160703", "20170619", "20180605", "20190522", "20200507"],
        (3, "LT"): ["20200501", "20200507"], (3, "N"): ["20200501", "20200507"],
    }


WIDE = "station_id int,ts timestamp_ntz,lt double,lf double,hs double,n double,sd double,gs double"


def wide_rows(rows, *data):
    return rows(WIDE, [(s, t, lt, None, None, n, None, None) for s, t, lt, n in data])


def test_raw_table_merge_touches_only_its_partitions(spark, rows, listed):
    path = scratch_dir(spark, "raw-test")
    store.merge_raw(spark, wide_rows(rows, (1, "2019-12-31 23:50:00", 1.0, None), (1, "2020-01-01 00:00:00", 2.0, 1.0), (2, "2020-01-01 00:00:00", 3.0, None)), path)
    kept = {f.path for f in spark.read.format("binaryFile").load(path + "/station_id=2/year=2020").select("path").collect()}
    store.merge_raw(spark, wide_rows(rows, (1, "2020-01-01 00:00:00", None, 5.0), (1, "2020-01-01 00:10:00", 7.0, None)), path)
    got = listed(store.read_table(spark, path).select("station_id", "ts", "lt", "n"), "station_id", "ts")
    assert [(r[0], r[2], r[3]) for r in got] == [(1, 1.0, None), (1, 2.0, 5.0), (1, 7.0, None), (2, 3.0, None)]
    assert kept == {f.path for f in spark.read.format("binaryFile").load(path + "/station_id=2/year=2020").select("path").collect()}


def test_read_table_missing(spark):
    assert store.read_table(spark, scratch_dir(spark, "nothing")) is None


def test_append_and_delete(spark, rows):
    path = scratch_dir(spark, "append")
    store.write_raw(wide_rows(rows, (1, "2020-01-01 00:00:00", 1.0, None)), path)
    store.write_raw(wide_rows(rows, (1, "2020-01-02 00:00:00", 2.0, None)), path)
    table = store.read_table(spark, path)
    assert table.count() == 2
    lo, hi = (F.lit(t).cast("timestamp_ntz") for t in ("2020-01-01 12:00:00", "2020-01-03 00:00:00"))
    assert [r["lt"] for r in store.delete_range(table, 1, lo, hi).collect()] == [1.0]


def test_update_all_is_idempotent_and_incremental(spark, tmp_path, listed):
    files, raw, done, seen = tmp_path / "WeatherData", *(scratch_dir(spark, n) for n in ("r", "p", "m"))
    days = 10
    lt = [3.0 + (i % 6) for i in range(144 * days)]
    for sensor, values in (("LT", lt), ("HS", [50.0] * len(lt)), ("N", [0.5] * len(lt))):
        write_portal(files / "St. Martin", "St. Martin", sensor, "2020-05-01 00:00", values)
    assert update.update_all(spark, str(files), raw, done, seen) == 3
    first = listed(store.read_table(spark, done).select("station_id", "rule", "period", *SENSOR_COLS), "rule", "period")
    daily = [r for r in first if r[1] == "daily"]
    assert [r[2].day for r in daily] == list(range(1, 10)) and daily[0][3] == pytest.approx(5.5) and daily[0][6] == 72.0
    assert [r[2] for r in first if r[1] == "weekly"] == [dt.datetime(2020, 5, 3)]
    assert update.update_all(spark, str(files), raw, done, seen) == 0
    write_portal(files / "St. Martin", "St. Martin", "LT", "2020-05-10 00:00", [9.0] * 289)
    assert update.update_all(spark, str(files), raw, done, seen) == 1
    again = listed(store.read_table(spark, done).where("rule = 'daily'").select("period", "lt", "n"), "period")
    assert [r[0].day for r in again] == list(range(1, 12)) and again[9][1] == pytest.approx(9.0) and again[9][2] == 72.0
    assert [tuple(r) for r in again[:9]] == [(r[2], r[3], r[6]) for r in daily]


def test_rebuild_from_a_year_equals_full_rebuild(spark, rows, listed):
    raw = scratch_dir(spark, "raw-years")
    data = [(1, f"20{y}-{m:02d}-{d:02d} {h:02d}:00:00", float((y * 7 + m * 3 + d * 5 + h) % 9), 1.0)
            for y in (18, 19, 20) for m in (1, 12) for d in (1, 2, 29, 30, 31) for h in (0, 6)]
    store.merge_raw(spark, wide_rows(rows, *data), raw)
    full, part = scratch_dir(spark, "full"), scratch_dir(spark, "part")
    update.update_processed(spark, raw, full)
    update.update_processed(spark, raw, part, 2020)
    cols = ["rule", "period", "lt", "n"]
    want = listed(store.read_table(spark, full).where("year >= 2020").select(*cols), "rule", "period")
    assert listed(store.read_table(spark, part).select(*cols), "rule", "period") == want and len(want) > 20


def test_history_overlay(spark, rows, listed):
    parsed = rows("file_name string,sensor string,resolution string,date date,value double", [
        ("x_Wolkenstein_N_Month", "N", "monthly", "1998-01-31", 20.0), ("x_Wolkenstein_N_Month", "N", "monthly", "1998-02-28", 30.0),
        ("x_Wolkenstein_N_Day", "N", "daily", "1998-01-01", 1.0), ("x_Wolkenstein_N_Day", "N", "daily", "1998-01-02", 3.0),
        ("x_Wolkenstein_N_Day", "N", "daily", "1998-03-02", 3.0)])
    got = listed(update.history_rows(parsed).where("rule = 'monthly'").select("period", "n"), "period")
    assert [(r[0].month, r[1]) for r in got] == [(1, 2.0), (2, 30.0)]


def test_scans_read_the_years_asked_for_only(spark, rows):
    path = scratch_dir(spark, "years")
    store.merge_raw(spark, wide_rows(rows, *[(s, f"{y}-06-01 00:00:00", 1.0, None) for s in (1, 2) for y in range(2015, 2021)]), path)
    scan = filters.scan_raw(store.read_table(spark, path), 1, "LT", "20180101", "20181231")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    line = next(x for x in plan.splitlines() if "PartitionFilters" in x)
    assert "station_id" in line.split("PartitionFilters")[1] and "year" in line.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert scan.count() == 1
    assert filters.scan_raw(store.read_table(spark, path), 2, "LT", None, "20161231").count() == 2


def test_a_merge_that_broke_off_is_finished(spark, rows, listed, monkeypatch):
    path = scratch_dir(spark, "broken")
    store.merge_raw(spark, wide_rows(rows, (1, "2020-01-01 00:00:00", 1.0, None), (1, "2020-02-01 00:00:00", 2.0, None)), path)

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(store, "_move", lost)
        with pytest.raises(RuntimeError):
            store.merge_raw(spark, wide_rows(rows, (1, "2020-01-01 00:00:00", 7.0, None)), path)
    assert [r[0] for r in listed(store.read_table(spark, path).select("lt", "ts"), "ts")] == [1.0, 2.0]
    store.merge_raw(spark, wide_rows(rows, (1, "2020-03-01 00:00:00", 3.0, None)), path)
    assert [r[0] for r in listed(store.read_table(spark, path).select("lt", "ts"), "ts")] == [7.0, 2.0, 3.0]
    assert store.finish_merge(spark, path) == 2


def test_deliveries_without_anchor_and_off_the_grid(spark, tmp_path, listed):
    files, raw, done, seen = tmp_path / "WeatherData", *(scratch_dir(spark, n) for n in ("r", "p", "m"))
    write_portal(files / "St. Martin", "St. Martin", "HS", "2020-05-01 00:00", [50.0] * 30)
    assert update.update_all(spark, str(files), raw, done, seen, files_per_batch=1) == 1
    write_portal(files / "St. Martin", "St. Martin", "LT", "2020-05-01 00:00", [3.0] * 30)
    write_portal(files / "St. Martin", "St. Martin", "N", "2020-05-01 00:03", [1.0] * 30)
    write_portal(files / "Nowhere", "Nowhere", "N", "2020-05-01 00:00", [1.0] * 4)
    assert update.update_all(spark, str(files), raw, done, seen, files_per_batch=2) == 3
    table = store.read_table(spark, raw)
    assert table.where("hs = 50").count() == 30 and table.where("lt = 3").count() == 30 and table.where("n = 1").count() == 0
    left_out = {(r["reason"], r["records"]) for r in store.read_table(spark, f"{raw}-rejects").collect()}
    assert left_out == {("off grid", 30), ("station", 4)}
    assert store.read_table(spark, done).where("rule = 'movavg'").count() == 30


def test_rain_that_stops_still_sums(spark, rows, listed):
    """A station that rained once sums for good, also when only later years are rebuilt."""
    raw, full, part = (scratch_dir(spark, n) for n in ("rain", "full", "part"))
    data = [(1, f"20{y}-05-{d:02d} {h:02d}:00:00", 4.0, 1.0 if y == 19 else None) for y in (19, 20) for d in (1, 2, 3) for h in range(0, 24, 6)]
    store.merge_raw(spark, wide_rows(rows, *data), raw)
    update.update_processed(spark, raw, full)
    update.update_processed(spark, raw, part, 2020)
    day = "rule = 'daily' AND period = timestamp_ntz'2020-05-01 00:00:00'"
    assert [(r["n"], r["lt"]) for r in store.read_table(spark, part).where(day).collect()] == [(0.0, 4.0)] == [(r["n"], r["lt"]) for r in store.read_table(spark, full).where(day).collect()]


def test_unchanged_folders_are_not_compared(spark, tmp_path):
    """A look after one more file reads the manifest of its folder only: that of the others may even be unreadable."""
    files, seen = tmp_path / "in", str(tmp_path / "seen")
    for k in range(3):
        for sensor in ("LT", "HS"):
            (files / f"f {k}").mkdir(parents=True, exist_ok=True)
            (files / f"f {k}" / f"Rossalm_{sensor}_from_1_to_{k}.json").write_text("[]")

    def look(take=True):
        found, folders = manifest.unseen_files(spark, manifest.list_files(spark, str(files), times=True), seen)
        names = sorted(r["path"].split("/")[-1] for r in found.collect())
        if take:
            manifest.note_files(found, seen)
            manifest.note_folders(folders, seen)
        return names

    assert len(look()) == 6 and look() == []
    (files / "f 1" / "Rossalm_SD_from_1_to_9.json").write_text("[]")
    broken = [p for p in (tmp_path / "seen").rglob("*.parquet") if "f%201" not in str(p.parent) and "f 1" not in str(p.parent)]
    kept = [(p, p.read_bytes()) for p in broken]
    for p, _ in kept:
        p.write_bytes(b"not parquet")
        p.with_name(f".{p.name}.crc").unlink(missing_ok=True)
    assert len(kept) == 2 and look() == ["Rossalm_SD_from_1_to_9.json"]
    for p, data in kept:
        p.write_bytes(data)
    assert look() == []
    manifest.forget_stored(spark, seen, "HS_from_1_to_0")
    assert look(False) == ["Rossalm_HS_from_1_to_0.json"]
    manifest.forget_stored(spark, seen, "Rossalm_LT_from_1_to_2")
    manifest.forget_stored(spark, seen, "Rossalm_HS_from_1_to_2")
    assert look() == ["Rossalm_HS_from_1_to_0.json", "Rossalm_HS_from_1_to_2.json", "Rossalm_LT_from_1_to_2.json"] and look() == []
