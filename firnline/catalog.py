"""Named queries over the given tables, each with the SQL that checks it.

``QUERIES[name]`` takes (spark, sf_dir) and returns a DataFrame; ``ORACLES[name]`` is the
same result in DuckDB SQL. Results of transcendental functions and of sums that are
not exact in double precision are rounded on both sides.
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import views
from .functions import hydro, periods
from .operators import (
    align,
    chunks,
    clean,
    climate,
    density,
    filters,
    fit,
    latest,
    merge,
    mixture,
    moving,
    resample,
    season,
)
from .plans import conductivity, lakes, panels, quality, swe, update
from .schema import SENSOR_COLS
from .session import scratch_dir
from .sources import historic, manifest, portal, requests, store, tables
from .streaming import ingest

QUERIES = {}
ORACLES = {}


def _midnight(df):
    """Dates as timestamps, the one form both engines hand over alike."""
    return df.withColumns({f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema if f.dataType == T.DateType()})


def query(name, oracle=None, dates=""):
    """Register a query and its check; ``dates`` names the date columns of the check."""
    def add(fn):
        QUERIES[name] = lambda spark, sf_dir: _midnight(fn(spark, sf_dir))
        if oracle is not None:
            casts = ", ".join(f"CAST({c} AS TIMESTAMP) AS {c}" for c in dates.split())
            ORACLES[name] = f"SELECT * REPLACE ({casts}) FROM (\n{oracle}) checked" if dates else oracle
        return fn

    return add


def duck(names, body, *ctes):
    parts = [views.duck_views(*names)] if names else []
    return "WITH " + ",\n".join([*parts, *ctes]) + "\n" + body


def rounded(df, digits, *columns):
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- shared pieces of the check SQL ----------------------------------------

def _pivot(src):
    cols = ", ".join(
        f"arg_min(value, event_id) FILTER (WHERE sensor = '{c.upper()}') AS {c}" for c in SENSOR_COLS
    )
    return f"wide AS (SELECT station_id, ts, {cols} FROM {src} GROUP BY 1, 2)"


ALIGNED = """span AS (SELECT station_id, min(ts) AS lo, max(ts) AS hi FROM readings WHERE sensor = 'LT' GROUP BY 1),
aligned AS (SELECT w.* FROM wide w JOIN span USING (station_id)
            WHERE ts BETWEEN lo AND hi AND date_diff('second', lo, ts) % 300 = 0)"""


def _clean(src):
    w = "(PARTITION BY station_id ORDER BY ts)"
    return f"""c1 AS (SELECT station_id, ts, lt AS lt0, CASE WHEN lt <= -30 OR lt >= 35 THEN NULL ELSE lt END AS lt,
  CASE WHEN hs < 0 OR hs > 250 THEN NULL WHEN month(ts) IN (7, 8, 9) AND hs > 5 THEN 0 ELSE hs END AS hs,
  CASE WHEN lf >= 0 THEN lf END AS lf, CASE WHEN n >= 0 THEN n END AS n,
  CASE WHEN gs * 0.0006e0 >= 0 THEN gs * 0.0006e0 END AS gs, CASE WHEN sd / 3600 >= 0 THEN sd / 3600 END AS sd FROM {src}),
c2 AS (SELECT * REPLACE (CASE WHEN lt - lag(lt) OVER {w} > 5 THEN NULL ELSE lt END AS lt,
                         CASE WHEN hs - lag(hs) OVER {w} > 10 THEN NULL ELSE hs END AS hs) FROM c1),
c3 AS (SELECT * REPLACE (CASE WHEN lt - lag(lt) OVER {w} < -5 THEN NULL ELSE lt END AS lt,
                         CASE WHEN hs - lag(hs) OVER {w} < -10 THEN NULL ELSE hs END AS hs) FROM c2),
cleaned AS (SELECT * REPLACE (CASE WHEN hs > lag(hs) OVER {w} AND lt0 > 5 THEN NULL ELSE hs END AS hs) FROM c3)"""


PERIOD_SQL = {
    "hourly": "date_trunc('hour', ts)",
    "daily": "date_trunc('day', ts)",
    "weekly": "date_trunc('week', ts) + INTERVAL 6 DAY",
    "monthly": "CAST(last_day(CAST(ts AS DATE)) AS TIMESTAMP)",
}
BOUND_SQL = {r: f"date_trunc('{u}', latest_ts)" for r, u in
             {"hourly": "hour", "daily": "day", "weekly": "week", "monthly": "month"}.items()}
P = {r: f"CAST({e} AS TIMESTAMP)" for r, e in PERIOD_SQL.items()}


def wide(spark, sf, src="readings"):
    return align.pivot_sensors(views.load(spark, sf, src), "event_id")


def aligned(spark, sf):
    return align.align(views.load(spark, sf, "readings"), "event_id")


# --- alignment and cleaning ---------------------------------------------------

@query("clean_lt_daily", duck(
    ["readings"], f"SELECT station_id, {P['daily']} AS period, avg(lt) AS lt FROM cleaned GROUP BY 1, 2",
    _pivot("readings"), ALIGNED, _clean("aligned")))
def clean_lt_daily(spark, sf):
    """Readings -> aligned wide rows -> cleaned temperature -> daily mean."""
    rows = aligned(spark, sf).select("station_id", "ts", "lt")
    cleaned = chunks.with_halo(rows, clean.clean_temperature, before=clean.TEMPERATURE_REACH)
    return resample.resample(cleaned, "daily", {"lt": "mean"})


@query("align_grid", duck(["readings"], "SELECT station_id, ts, lt, lf, hs, n, sd, gs FROM aligned", _pivot("readings"), ALIGNED))
def align_grid(spark, sf):
    return aligned(spark, sf)


@query("align_dense_grid", duck(
    ["readings"], """SELECT g.station_id, g.ts, w.lt, w.hs
FROM (SELECT station_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM span) g
LEFT JOIN wide w USING (station_id, ts)""", _pivot("readings"), ALIGNED))
def align_dense_grid(spark, sf):
    r = views.load(spark, sf, "readings")
    rows = align.pivot_sensors(r, "event_id").select("station_id", "ts", "lt", "hs")
    return align.densify(rows, align.anchor_span(r), 3600)


@query("clean_snow", duck(
    ["season_readings"], "SELECT station_id, ts, hs, lt0 AS lt FROM cleaned", _pivot("season_readings"), _clean("wide")))
def clean_snow(spark, sf):
    rows = wide(spark, sf, "season_readings").select("station_id", "ts", "hs", "lt")
    return chunks.with_halo(rows, clean.clean_snow, before=clean.SNOW_REACH)


@query("clean_snow_chunked", duck(
    ["season_readings"], "SELECT station_id, ts, hs, lt0 AS lt FROM cleaned", _pivot("season_readings"), _clean("wide")))
def clean_snow_chunked(spark, sf):
    """The same cut into (station, chunk) groups, the form used for large tables."""
    rows = wide(spark, sf, "season_readings").select("station_id", "ts", "hs", "lt")
    return chunks.with_halo(rows, clean.clean_snow, before=clean.SNOW_REACH, chunk_rows=200)


@query("clean_temperature", duck(
    ["season_readings"], "SELECT station_id, ts, lt FROM cleaned", _pivot("season_readings"), _clean("wide")))
def clean_temperature(spark, sf):
    rows = wide(spark, sf, "season_readings").select("station_id", "ts", "lt")
    return chunks.with_halo(rows, clean.clean_temperature, before=clean.TEMPERATURE_REACH)


@query("clean_simple", duck(
    ["readings"], "SELECT station_id, ts, lf, n, gs, sd FROM cleaned",
    _pivot("readings"), "sunny AS (SELECT * REPLACE (gs * 100 AS sd) FROM wide)", _clean("sunny")))
def clean_simple(spark, sf):
    rows = wide(spark, sf).withColumn("sd", F.col("gs") * 100)
    rows = clean.clean_humidity(clean.clean_precipitation(rows))
    return clean.clean_sunshine(clean.clean_radiation(rows)).select("station_id", "ts", "lf", "n", "gs", "sd")


SPRING_CLEAN = """s1 AS (SELECT site, ts, slt - lag(slt) OVER w AS d, wt, slt FROM spring WINDOW w AS (PARTITION BY site ORDER BY ts)),
s2 AS (SELECT site, ts, CASE WHEN d > 5 OR d < -5 OR slt <= 50 THEN NULL ELSE wt END AS wt, CASE WHEN d > 5 THEN NULL ELSE slt END AS slt FROM s1),
s3 AS (SELECT site, ts, wt, CASE WHEN slt - lag(slt) OVER (PARTITION BY site ORDER BY ts) < -5 THEN NULL ELSE slt END AS slt FROM s2),
sclean AS (SELECT site, ts, wt, CASE WHEN slt <= 50 THEN NULL ELSE slt END AS slt FROM s3)"""


@query("clean_conductivity", duck(["spring"], "SELECT * FROM sclean", SPRING_CLEAN))
def clean_conductivity(spark, sf):
    rows = views.load(spark, sf, "spring").select("site", "ts", "wt", "slt")
    return chunks.with_halo(rows, clean.clean_conductivity, keys=("site",), before=clean.CONDUCTIVITY_REACH)


@query("clean_conductivity_chunked", duck(["spring"], "SELECT * FROM sclean", SPRING_CLEAN))
def clean_conductivity_chunked(spark, sf):
    rows = views.load(spark, sf, "spring").select("site", "ts", "wt", "slt")
    return chunks.with_halo(rows, clean.clean_conductivity, keys=("site",), before=clean.CONDUCTIVITY_REACH, chunk_rows=200)


@query("quality_status", duck(["historic"], """SELECT file_name, status, count(*) AS lines, count(good) AS good FROM (
  SELECT file_name, split_part(value, '\t', 4) AS status,
         CASE WHEN split_part(value, '\t', 4) = '40 (Gut)' THEN TRY_CAST(replace(split_part(value, '\t', 3), ',', '.') AS DOUBLE) END AS good
  FROM historic) t GROUP BY 1, 2"""))
def quality_status(spark, sf):
    """Values kept by the quality status."""
    lines = views.load(spark, sf, "historic")
    parts = F.split("value", "\t")
    rows = lines.select("file_name", parts[3].alias("status"), historic.decimal_comma(parts[2]).alias("v"))
    good = clean.keep_good_status("v", "status", historic.GOOD_STATUS)
    return rows.groupBy("file_name", "status").agg(F.count("*").alias("lines"), F.count(good).alias("good"))


# --- roll-ups -------------------------------------------------------------------

def _resample_sql(rule, src):
    return (f"SELECT station_id, {P[rule]} AS period, avg(lt) AS lt, avg(lf) AS lf, avg(hs) AS hs, coalesce(sum(n), 0) AS n, "
            f"coalesce(sum(sd), 0) AS sd, coalesce(sum(gs), 0) AS gs FROM {src} GROUP BY 1, 2")


def _resample_query(rule, src):
    @query(f"resample_{rule}", duck([src], _resample_sql(rule, "wide"), _pivot(src)))
    def run(spark, sf):
        return resample.resample(wide(spark, sf, src), rule)


for _rule, _src in (("hourly", "readings"), ("daily", "season_readings"), ("weekly", "season_readings"), ("monthly", "season_readings")):
    _resample_query(_rule, _src)


@query("resample_mean_weekly", duck(
    ["season_readings"], f"SELECT station_id, {P['weekly']} AS period, avg(lt) AS lt, avg(lf) AS lf, avg(hs) AS hs, avg(gs) AS gs FROM wide GROUP BY 1, 2",
    _pivot("season_readings")))
def resample_mean_weekly(spark, sf):
    """Roll-up of stations without precipitation: every sensor averaged."""
    return resample.resample(wide(spark, sf, "season_readings"), "weekly", {c: "mean" for c in ("lt", "lf", "hs", "gs")})


LATEST_RAW = "latest AS (SELECT station_id, max(ts) AS latest_ts, min(ts) AS oldest_ts FROM {} GROUP BY 1)"


def _newest(src):
    counts = ", ".join(f"count({c}) AS {c}" for c in SENSOR_COLS)
    return (f"newest AS (SELECT station_id, {counts} FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY ts DESC) AS rk "
            f"FROM {src}) t WHERE rk <= 10 GROUP BY 1)")


def _processed_sql(src):
    """All rules of the cleaned rows, complete periods only."""
    def one(rule):
        def either(c, digits):
            return (f"CASE WHEN any_value(k.n) > 0 THEN round(coalesce(sum(c.{c}), 0), {digits}) ELSE round(avg(c.{c}), {digits}) END AS {c}")
        return (f"SELECT c.station_id, '{rule}' AS rule, {P[rule].replace('ts', 'c.ts', 1)} AS period, avg(c.lt) AS lt, avg(c.lf) AS lf, avg(c.hs) AS hs, "
                f"{either('n', 9)}, {either('sd', 9)}, {either('gs', 9)} FROM cleaned c LEFT JOIN rained k USING (station_id) JOIN latest USING (station_id) "
                f"WHERE c.ts < {BOUND_SQL[rule]} GROUP BY 1, 2, 3")
    body = " UNION ALL ".join(one(r) for r in PERIOD_SQL).replace("cleaned cs", "cleaned c")
    return body, (_clean(src), f"rained AS (SELECT station_id, count(n) AS n FROM {src} GROUP BY 1)", LATEST_RAW.format(src))


_body, _ctes = _processed_sql("wide")
_PROCESSED_SEASON = duck(["season_readings"], _body, _pivot("season_readings"), *_ctes)
_body, _ctes = _processed_sql("aligned")
_PROCESSED_RAW = duck(["readings"], _body, _pivot("readings"), ALIGNED, *_ctes)


@query("resample_all_rules", _PROCESSED_SEASON)
def resample_all_rules(spark, sf):
    """Hourly to monthly tables of all stations in one aggregation, complete periods only."""
    return rounded(update.processed_rows(wide(spark, sf, "season_readings")), 9, "n", "sd", "gs")


@query("complete_period_bound", duck(
    ["readings"], " UNION ALL ".join(f"SELECT station_id, '{r}' AS rule, CAST({b} AS TIMESTAMP) AS bound FROM latest" for r, b in BOUND_SQL.items()),
    LATEST_RAW.format("readings")))
def complete_period_bound(spark, sf):
    return resample.complete_bounds(latest.time_span(views.load(spark, sf, "readings")))


@query("logger_dense_daily", duck(["spring"], """SELECT site, period, m.wt, m.slt
FROM (SELECT site, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS period
      FROM (SELECT site, date_trunc('day', min(ts)) AS lo, date_trunc('day', max(ts)) AS hi FROM spring GROUP BY 1) s) g
LEFT JOIN (SELECT site, date_trunc('day', ts) AS period, avg(wt) AS wt, avg(slt) AS slt FROM spring GROUP BY 1, 2) m USING (site, period)"""))
def logger_dense_daily(spark, sf):
    return resample.resample_dense(views.load(spark, sf, "spring"), "daily", ["wt", "slt"])


@query("logger_dense_hourly", duck(["spring"], """SELECT site, period, m.wt, m.slt
FROM (SELECT site, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS period
      FROM (SELECT site, date_trunc('hour', min(ts)) AS lo, date_trunc('hour', max(ts)) AS hi FROM spring GROUP BY 1) s) g
LEFT JOIN (SELECT site, date_trunc('hour', ts) AS period, avg(wt) AS wt, avg(slt) AS slt FROM spring GROUP BY 1, 2) m USING (site, period)"""))
def logger_dense_hourly(spark, sf):
    return resample.resample_dense(views.load(spark, sf, "spring"), "hourly", ["wt", "slt"])


@query("yearly_complete_sum", duck(["monthly"], """SELECT station_id, CAST(year(period) AS INTEGER) AS year, coalesce(sum(n), 0) AS n, count(*) AS months
FROM monthly GROUP BY 1, 2 HAVING count(*) = 12"""))
def yearly_complete_sum(spark, sf):
    return resample.yearly_complete_sum(views.load(spark, sf, "monthly"))


@query("monthly_of_daily", duck(["daily"], """SELECT * FROM (SELECT station_id, CAST(last_day(date) AS TIMESTAMP) AS period,
  avg(lt) AS lt, avg(hs) AS hs, avg(n) AS n FROM daily GROUP BY 1, 2) t WHERE lt IS NOT NULL AND hs IS NOT NULL AND n IS NOT NULL"""))
def monthly_of_daily(spark, sf):
    days = views.load(spark, sf, "daily").withColumn("period", F.col("date").cast("timestamp_ntz"))
    return resample.monthly_mean_of_daily(days, ["lt", "hs", "n"])


# --- climate ----------------------------------------------------------------------

TD_SQL = """years AS (SELECT station_id, CAST(year(period) AS INTEGER) AS year, max(lt) - min(lt) AS td, max(max(year(period))) OVER (PARTITION BY station_id) AS last_year
  FROM monthly GROUP BY station_id, year(period)),
td AS (SELECT station_id, avg(td) AS td FROM years WHERE year < last_year GROUP BY 1)"""
WINTER_SQL = """wint AS (SELECT station_id, CAST(year(period) - CASE WHEN month(period) <= 2 THEN 1 ELSE 0 END AS INTEGER) AS winter, coalesce(sum(n), 0) AS pptwt
  FROM monthly WHERE month(period) IN (12, 1, 2) GROUP BY 1, 2),
own AS (SELECT s.station_id, sum(CASE WHEN winter >= lo AND winter < hi THEN pptwt ELSE 0 END) / nullif(any_value(hi - lo), 0) AS pptwt
  FROM (SELECT station_id, min(year(period)) AS lo, max(year(period)) AS hi FROM monthly GROUP BY 1) s LEFT JOIN wint USING (station_id) GROUP BY 1),
source AS (SELECT station_id, CASE WHEN coalesce(sum(n), 0) = 0 THEN 4 ELSE station_id END AS source_id FROM monthly GROUP BY station_id),
pptwt AS (SELECT source.station_id, own.pptwt FROM source LEFT JOIN own ON own.station_id = source.source_id)"""


@query("td_longterm", duck(["monthly"], "SELECT station_id, round(td, 9) AS td FROM td", TD_SQL))
def td_longterm(spark, sf):
    return rounded(climate.temperature_range(views.load(spark, sf, "monthly")), 9, "td")


@query("td_year", duck(["daily", "monthly"], """SELECT d.station_id, d.date, y.td FROM daily d
LEFT JOIN years y ON y.station_id = d.station_id AND y.year = year(d.date) - 1""", TD_SQL), dates="date")
def td_year(spark, sf):
    dates = views.load(spark, sf, "daily").select("station_id", "date")
    return climate.temperature_range_before(views.load(spark, sf, "monthly"), dates)


@query("pptwt_longterm", duck(["monthly"], "SELECT * FROM pptwt", WINTER_SQL))
def pptwt_longterm(spark, sf):
    return climate.winter_precipitation_of(views.load(spark, sf, "monthly"), 4)


@query("pptwt_year", duck(["daily", "monthly"], """SELECT d.station_id, d.date, coalesce(w.pptwt, 0) AS pptwt FROM daily d
LEFT JOIN source s ON s.station_id = d.station_id LEFT JOIN wint w ON w.station_id = s.source_id AND w.winter = year(d.date) - 1""", WINTER_SQL), dates="date")
def pptwt_year(spark, sf):
    dates = views.load(spark, sf, "daily").select("station_id", "date")
    return climate.winter_precipitation_before(views.load(spark, sf, "monthly"), dates, 4)


# --- moving averages -------------------------------------------------------------------

TRAILING = duck(["season_readings"], """SELECT station_id, ts, CASE WHEN count(hs) OVER w >= 30 THEN avg(hs) OVER w END AS hs FROM cleaned
WINDOW w AS (PARTITION BY station_id ORDER BY ts ROWS BETWEEN 41 PRECEDING AND CURRENT ROW)""", _pivot("season_readings"), _clean("wide"))


@query("moving_avg_trailing", TRAILING)
def moving_avg_trailing(spark, sf):
    """Mean of the last 42 cleaned snow heights, 30 of them measured."""
    return update.moving_average(wide(spark, sf, "season_readings"))


@query("moving_avg_trailing_chunked", TRAILING)
def moving_avg_trailing_chunked(spark, sf):
    return update.moving_average(wide(spark, sf, "season_readings"), chunk_rows=200)


CENTRED = """SELECT station_id, ts, CASE WHEN count(lf) OVER w >= {} THEN avg(lf) OVER w END AS lf_rol FROM wide
WINDOW w AS (PARTITION BY station_id ORDER BY ts ROWS BETWEEN 12 PRECEDING AND 11 FOLLOWING)"""


def _centred(spark, sf, least, chunk_rows=chunks.CHUNK_ROWS):
    before, after = moving.centre_reach(24)
    rows = wide(spark, sf).select("station_id", "ts", "lf")
    return chunks.with_halo(
        rows, lambda d, w: moving.centred_mean(d, "lf", w, "lf_rol", 24, least),
        before=before, after=after, chunk_rows=chunk_rows,
    ).drop("lf")


@query("moving_avg_centered", duck(["readings"], CENTRED.format(24), _pivot("readings")))
def moving_avg_centered(spark, sf):
    return _centred(spark, sf, None)


@query("moving_avg_centered_chunked", duck(["readings"], CENTRED.format(24), _pivot("readings")))
def moving_avg_centered_chunked(spark, sf):
    return _centred(spark, sf, None, 2)


@query("moving_avg_centered_min", duck(["readings"], CENTRED.format(10), _pivot("readings")))
def moving_avg_centered_min(spark, sf):
    return _centred(spark, sf, 10)


# --- seasons ----------------------------------------------------------------------------

SEASON_SQL = """inseason AS (SELECT station_id, date, hs, CAST(year(date) - CASE WHEN month(date) < 10 THEN 1 ELSE 0 END AS INTEGER) AS season
  FROM daily WHERE month(date) IN (10, 11, 12, 1, 2, 3, 4, 5, 6)),
risen AS (SELECT *, greatest(coalesce(hs - lag(hs) OVER (PARTITION BY station_id, season ORDER BY date), 0), 0) AS rise FROM inseason),
cums AS (SELECT *, sum(rise) OVER (PARTITION BY station_id, season ORDER BY date ROWS UNBOUNDED PRECEDING) AS cum FROM risen)"""


def _accumulated(spark, sf):
    return season.accumulate(season.in_season(views.load(spark, sf, "daily").select("station_id", "date", "hs")), "hs")


@query("season_accumulation", duck(["daily"], "SELECT * FROM cums", SEASON_SQL), dates="date")
def season_accumulation(spark, sf):
    return _accumulated(spark, sf)


@query("season_max", duck(["daily"], "SELECT station_id, season, max(cum) AS max_cum FROM cums GROUP BY 1, 2", SEASON_SQL))
def season_max(spark, sf):
    return season.season_maximum(_accumulated(spark, sf))


MELT = """SELECT station_id, date, hs, CASE WHEN lead(1) OVER w IS NULL THEN NULL WHEN hs > lead(hs) OVER w THEN hs - lead(hs) OVER w ELSE {} END AS melt
FROM daily WINDOW w AS (PARTITION BY station_id ORDER BY date)"""


@query("snowmelt_zero", duck(["daily"], MELT.format("0")), dates="date")
def snowmelt_zero(spark, sf):
    return season.melt(views.load(spark, sf, "daily").select("station_id", "date", "hs"), "hs", "melt")


@query("snowmelt_null", duck(["daily"], MELT.format("NULL")), dates="date")
def snowmelt_null(spark, sf):
    return season.melt(views.load(spark, sf, "daily").select("station_id", "date", "hs"), "hs", "melt", otherwise=None)


# --- lakes --------------------------------------------------------------------------------

VOLUME_SQL = "CASE lake WHEN 'Limo' THEN (931.46e0 * wd + -739.07e0) * wd + 698.83e0 ELSE (1372.99e0 * wd + -2808.53e0) * wd + 1728.66e0 END"
AREA_SQL = ("CASE lake WHEN 'Limo' THEN ((41.05090849623958e0 * wd + -876.9004337585678e0) * wd + 7252.335363659846e0) * wd + -9634.640993941795e0 "
            "ELSE 3049.762182195784e0 * wd + -3382.009706965325e0 END")
SHED_SQL = "CASE lake WHEN 'Limo' THEN 849285e0 ELSE 8039068e0 END"
LAKE_LOG = f"""rated AS (SELECT lake, date, wd, {VOLUME_SQL} AS volume FROM lake_depth),
lake_log AS (SELECT *, lead(volume) OVER (PARTITION BY lake ORDER BY date) - volume AS w_change FROM rated)"""


def _lake_log(spark, sf):
    rows = views.load(spark, sf, "lake_depth").withColumn("volume", hydro.lake_volume("lake", "wd"))
    return season.storage_change(rows)


@query("depth_to_volume", duck(["lake_depth"], f"SELECT lake, date, wd, {VOLUME_SQL} AS volume FROM lake_depth"), dates="date")
def depth_to_volume(spark, sf):
    return views.load(spark, sf, "lake_depth").withColumn("volume", hydro.lake_volume("lake", "wd"))


@query("depth_to_area", duck(["lake_calc"], f"SELECT lake, date, coalesce(area_glatt, {AREA_SQL}) AS area FROM lake_calc"), dates="date")
def depth_to_area(spark, sf):
    return views.load(spark, sf, "lake_calc").select(
        "lake", "date", F.coalesce("area_glatt", hydro.lake_area("lake", "wd")).alias("area")
    )


@query("poly_eval", duck([], """SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey,
  ((l_discount * l_quantity + l_tax) * l_quantity + 2.5e0) AS quadratic, l_discount * l_quantity + l_tax AS line
FROM lineitem""", "one AS (SELECT 1)"))
def poly_eval(spark, sf):
    rows = views.load(spark, sf, "lineitem")
    return rows.select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey",
        hydro.poly_eval("l_quantity", F.array("l_discount", "l_tax", F.lit(2.5))).alias("quadratic"),
        hydro.poly_eval("l_quantity", F.array("l_discount", "l_tax")).alias("line"),
    )


@query("storage_change", duck(["lake_depth"], "SELECT lake, date, wd, volume, w_change FROM lake_log", LAKE_LOG), dates="date")
def storage_change(spark, sf):
    return _lake_log(spark, sf)


DOY_SQL = "(date_diff('day', make_date(year(date), 9, 30), date) + CASE WHEN date < make_date(year(date), 9, 30) THEN 365 ELSE 0 END)"


def _swe_expr(p, t):
    def regime(k):
        return (f"{k[0]} * pow(hs * 10, {k[1]}) * pow({p}, {k[2]}) * pow({t}, {k[3]}) * pow({DOY_SQL}, {k[4]})")
    switch = f"((exp(0.02 * ({DOY_SQL} - 180)) - 1) / (exp(0.02 * ({DOY_SQL} - 180)) + 1))"
    a, b = (0.0533, 0.948, 0.1701, -0.1314, 0.2922), (0.0481, 1.0395, 0.1699, -0.0461, 0.1804)
    return (f"CASE WHEN {t} > 0 AND hs >= 0 AND {p} >= 0 THEN {regime(a)} * (1 - {switch}) / 2 + {regime(b)} * (1 + {switch}) / 2 END")


SWE_SQL = f"""swe AS (SELECT d.station_id, d.date, d.hs, d.lt, {_swe_expr('pptwt', 'td')} AS swe
  FROM daily d JOIN td USING (station_id) LEFT JOIN pptwt USING (station_id))"""


def _swe(spark, sf, **kw):
    return swe.swe_period(views.load(spark, sf, "daily"), views.load(spark, sf, "monthly"), **kw)


@query("swe_period", duck(["daily", "monthly"], "SELECT station_id, date, hs, lt, round(swe, 5) AS swe FROM swe", TD_SQL, WINTER_SQL, SWE_SQL), dates="date")
def swe_period(spark, sf):
    return rounded(_swe(spark, sf), 5, "swe")


@query("swe_period_station", duck(
    ["daily", "monthly"], "SELECT station_id, date, hs, lt, round(swe, 5) AS swe FROM swe WHERE date BETWEEN DATE '1996-10-01' AND DATE '1999-06-30'",
    TD_SQL, WINTER_SQL.replace("SELECT source.station_id, own.pptwt FROM source LEFT JOIN own ON own.station_id = source.source_id",
                               "SELECT source.station_id, own.pptwt FROM source LEFT JOIN own ON own.station_id = 5"), SWE_SQL), dates="date")
def swe_period_station(spark, sf):
    """Precipitation of one given station for all."""
    return rounded(_swe(spark, sf, start="1996-10-01", end="1999-06-30", precipitation_station=5), 5, "swe")


@query("swe_point", duck(["daily", "monthly"], "SELECT station_id, date, hs, lt, round(swe, 5) AS swe FROM swe WHERE date = DATE '1998-02-14'", TD_SQL, WINTER_SQL, SWE_SQL), dates="date")
def swe_point(spark, sf):
    return rounded(swe.swe_at(views.load(spark, sf, "daily"), views.load(spark, sf, "monthly"), "1998-02-14"), 5, "swe")


@query("swe_specific", duck(["daily", "monthly"], f"""SELECT station_id, date, hs, td, pptwt, round({_swe_expr('pptwt', 'td')}, 5) AS swe FROM (
  SELECT d.station_id, d.date, d.hs, y.td, coalesce(w.pptwt, 0) AS pptwt FROM daily d
  LEFT JOIN years y ON y.station_id = d.station_id AND y.year = year(d.date) - 1
  LEFT JOIN source s ON s.station_id = d.station_id
  LEFT JOIN wint w ON w.station_id = s.source_id AND w.winter = year(d.date) - 1) t""", TD_SQL, WINTER_SQL), dates="date")
def swe_specific(spark, sf):
    return rounded(swe.swe_specific(views.load(spark, sf, "daily"), views.load(spark, sf, "monthly")), 5, "swe")


_PHI = "(46.6792e0 * pi() / 180)"
_DL = f"(4 * {_PHI} * sin(0.53e0 * month(date) - 1.65e0) + 12)"
PENMAN_SQL = f"""penman AS (SELECT date, gs, lt, lf, dl AS daylight_hours, ra,
  0.047e0 * gs * CASE WHEN lt >= -9.5 THEN sqrt(lt + 9.5e0) END - 2.4e0 * (gs / nullif(ra, 0)) * (gs / nullif(ra, 0)) + 0.09e0 * (lt + 20) * (1 - lf / 100) AS epen
  FROM (SELECT date, g.gs, a.lt, a.lf, {_DL} AS dl, 3 * {_DL} * sin(0.131e0 * {_DL} - 0.95e0 * {_PHI}) AS ra
        FROM (SELECT date, gs FROM daily WHERE station_id = 5) g JOIN (SELECT date, lt, lf FROM daily WHERE station_id = 2) a USING (date)
        WHERE g.gs IS NOT NULL AND a.lt IS NOT NULL AND a.lf IS NOT NULL) t)"""


@query("penman_daily", duck(["daily"], "SELECT date, gs, lt, lf, round(daylight_hours, 7) AS daylight_hours, round(ra, 7) AS ra, round(epen, 7) AS epen FROM penman", PENMAN_SQL), dates="date")
def penman_daily(spark, sf):
    return rounded(lakes.penman_daily(views.load(spark, sf, "daily")), 7, "daylight_hours", "ra", "epen")


@query("lake_evaporation", duck(["daily", "lake_calc"], f"""SELECT lake, date, wd, area_glatt, round(epen, 7) AS epen,
  CASE WHEN month(date) BETWEEN 6 AND 10 THEN round(area_glatt * epen, 4) END AS epen_area, round(-(area_glatt * epen / {SHED_SQL}), 7) AS epen_shed
FROM (SELECT lake, date, wd, coalesce(area_glatt, {AREA_SQL}) AS area_glatt, epen FROM lake_calc LEFT JOIN penman USING (date)
      WHERE wd IS NOT NULL AND NOT (lake = 'Limo' AND wd = 11)) t""", PENMAN_SQL), dates="date")
def lake_evaporation(spark, sf):
    daily = views.load(spark, sf, "daily")
    rows = lakes.lake_evaporation(views.load(spark, sf, "lake_calc"), lakes.penman_daily(daily))
    rows = rounded(rounded(rows, 7, "epen", "epen_shed"), 4, "epen_area")
    return rows.select("lake", "date", "wd", "area_glatt", "epen", "epen_area", "epen_shed")


@query("water_balance", duck(["daily", "monthly", "lake_depth"], f"""SELECT lake, date, round(n.n + m.snowmelt - round(9.1e0 * 86400 / {SHED_SQL}, 2) - l.mm, 5) AS ssgw,
  n.n AS n, round(m.snowmelt, 5) AS snowmelt, l.mm AS lakestorage
FROM (SELECT lake, date, w_change * 1000 / {SHED_SQL} AS mm FROM lake_log) l
LEFT JOIN (SELECT date, n - n * 0.12e0 AS n FROM daily WHERE station_id = 4) n USING (date)
LEFT JOIN (SELECT date, CASE WHEN lead(1) OVER w IS NULL THEN NULL WHEN swe > lead(swe) OVER w THEN swe - lead(swe) OVER w ELSE 0 END AS snowmelt
           FROM swe WHERE station_id = 2 AND date BETWEEN (SELECT min(date) FROM lake_log) AND (SELECT max(date) FROM lake_log)
           WINDOW w AS (ORDER BY date)) m USING (date)""", TD_SQL, WINTER_SQL, SWE_SQL, LAKE_LOG), dates="date")
def water_balance(spark, sf):
    out = lakes.water_balance(_lake_log(spark, sf), views.load(spark, sf, "daily"), _swe(spark, sf))
    return rounded(out, 5, "ssgw", "snowmelt")


@query("baseflow", duck(["daily", "lake_depth"], f"""SELECT date, l.w_change_shed, n.n, n.n_effective
FROM (SELECT date, w_change * 1000 / {SHED_SQL} AS w_change_shed FROM lake_log WHERE lake = 'Limo' AND date BETWEEN DATE '1996-08-13' AND DATE '1999-12-04') l
FULL OUTER JOIN (SELECT date, n, n - n * 0.12e0 AS n_effective FROM daily WHERE station_id = 4 AND date BETWEEN
  (SELECT min(date) FROM lake_log WHERE lake = 'Limo' AND date BETWEEN DATE '1996-08-13' AND DATE '1999-12-04') AND
  (SELECT max(date) FROM lake_log WHERE lake = 'Limo' AND date BETWEEN DATE '1996-08-13' AND DATE '1999-12-04')) n USING (date)""", LAKE_LOG), dates="date")
def baseflow(spark, sf):
    return lakes.baseflow(_lake_log(spark, sf), views.load(spark, sf, "daily"), "Limo", "1996-08-13", "1999-12-04")


@query("inflow_outflow", duck(["daily", "monthly", "lake_depth"], f"""SELECT date, l.w_change_shed, n.n, round(m.snowmelt, 5) AS snowmelt
FROM (SELECT date, w_change * 1000 / {SHED_SQL} AS w_change_shed FROM lake_log WHERE lake = 'Limo') l
FULL OUTER JOIN (SELECT date, n FROM daily WHERE station_id = 4 AND date BETWEEN (SELECT min(date) FROM lake_log WHERE lake = 'Limo')
  AND (SELECT max(date) FROM lake_log WHERE lake = 'Limo')) n USING (date)
FULL OUTER JOIN (SELECT date, CASE WHEN swe > lead(swe) OVER (ORDER BY date) THEN swe - lead(swe) OVER (ORDER BY date) END AS snowmelt
  FROM swe WHERE station_id = 2 AND date BETWEEN (SELECT min(date) FROM lake_log WHERE lake = 'Limo')
  AND (SELECT max(date) FROM lake_log WHERE lake = 'Limo')) m USING (date)""", TD_SQL,
    WINTER_SQL.replace("ON own.station_id = source.source_id", "ON own.station_id = 5"), SWE_SQL, LAKE_LOG), dates="date")
def inflow_outflow(spark, sf):
    out = lakes.inflow_outflow(_lake_log(spark, sf), views.load(spark, sf, "daily"), _swe(spark, sf, precipitation_station=5))
    return rounded(out, 5, "snowmelt")


@query("seepage_inflow", duck(["lake_depth"], """SELECT lake, high_date, low_date, (high_volume - low_volume) / dt * 1000 AS seepage,
  ((high_volume - low_volume) + (seepage_ls / 1000) * dt) / dt * 1000 AS inflow
FROM (SELECT lake, date AS high_date, volume AS high_volume, lead(date, 10) OVER w AS low_date, lead(volume, 10) OVER w AS low_volume,
        5 + wd AS seepage_ls, date_diff('day', date, lead(date, 10) OVER w) * 86400e0 AS dt
      FROM lake_log WINDOW w AS (PARTITION BY lake ORDER BY date)) t WHERE low_date IS NOT NULL""", LAKE_LOG), dates="high_date low_date")
def seepage_inflow(spark, sf):
    w = clean.series_window("lake", "date")
    stands = _lake_log(spark, sf).select(
        "lake", F.col("date").alias("high_date"), F.col("volume").alias("high_volume"),
        F.lead("date", 10).over(w).alias("low_date"), F.lead("volume", 10).over(w).alias("low_volume"),
        (5 + F.col("wd")).alias("seepage_ls"),
    ).where("low_date IS NOT NULL")
    return lakes.recession(stands).select("lake", "high_date", "low_date", "seepage", "inflow")


@query("yearly_lake_max", duck(["lake_calc"], """SELECT lake, CAST(year(date) AS INTEGER) AS year, max(volume) AS max_log, max(vol_calc) AS max_calc,
  coalesce(max(volume), max(vol_calc)) AS max_vol FROM lake_calc GROUP BY 1, 2"""))
def yearly_lake_max(spark, sf):
    return season.yearly_maxima(views.load(spark, sf, "lake_calc"))


VOLUME_SNOW = """pairs AS (SELECT v.year, s.season, v.max_vol, s.max_cum
FROM (SELECT CAST(year(date) AS INTEGER) AS year, coalesce(max(volume), max(vol_calc)) AS max_vol FROM lake_calc WHERE lake = 'Limo' AND year(date) < 2020 GROUP BY 1) v
JOIN (SELECT season, max(cum) AS max_cum FROM cums WHERE station_id = 2 AND season <= 2019 GROUP BY 1) s ON v.year = s.season + 1)"""
SWE_SEASON = SEASON_SQL.replace("FROM daily", "FROM (SELECT station_id, date, swe AS hs FROM swe) daily")


@query("volume_snow_pairs", duck(["daily", "lake_calc"], "SELECT * FROM pairs", SEASON_SQL, VOLUME_SNOW))
def volume_snow_pairs(spark, sf):
    return panels.volume_and_snow(views.load(spark, sf, "lake_calc"), views.load(spark, sf, "daily"), "Limo", "hs")


REGRESSION = """SELECT round(regr_slope(max_cum, max_vol), 6) AS slope, round(regr_intercept(max_cum, max_vol), 4) AS intercept,
  round(regr_r2(max_cum, max_vol), 9) AS r2, CAST(regr_count(max_cum, max_vol) AS BIGINT) AS pairs FROM pairs"""


def _regression(df):
    return rounded(rounded(rounded(df, 6, "slope"), 9, "r2"), 4, "intercept")


@query("volume_snow_regression", duck(["daily", "lake_calc"], REGRESSION, SEASON_SQL, VOLUME_SNOW))
def volume_snow_regression(spark, sf):
    return _regression(panels.volume_snow_regression(views.load(spark, sf, "lake_calc"), views.load(spark, sf, "daily"), "Limo", "hs"))


@query("volume_swe_regression", duck(["daily", "monthly", "lake_calc"], REGRESSION, TD_SQL, WINTER_SQL, SWE_SQL, SWE_SEASON, VOLUME_SNOW))
def volume_swe_regression(spark, sf):
    return _regression(panels.volume_snow_regression(views.load(spark, sf, "lake_calc"), _swe(spark, sf), "Limo", "swe"))


@query("volume_with_accumulation", duck(["daily", "monthly", "lake_calc"], """SELECT date, v.volume, v.vol_calc, n.n, round(s.cum, 5) AS cum
FROM (SELECT date, volume, vol_calc FROM lake_calc WHERE lake = 'Limo') v
FULL OUTER JOIN (SELECT date, n FROM daily WHERE station_id = 4 AND date BETWEEN DATE '1995-10-01' AND DATE '2001-06-01') n USING (date)
FULL OUTER JOIN (SELECT date, season, cum FROM cums WHERE station_id = 2) s USING (date)""",
    TD_SQL, WINTER_SQL, SWE_SQL, SWE_SEASON.replace("AS hs FROM swe)", "AS hs FROM swe WHERE date BETWEEN DATE '1995-10-01' AND DATE '2001-06-01')")), dates="date")
def volume_with_accumulation(spark, sf):
    out = panels.volume_with_accumulation(
        views.load(spark, sf, "lake_calc"), views.load(spark, sf, "daily"), _swe(spark, sf), "Limo", "swe",
        first="1995-10-01", last="2001-06-01",
    )
    return rounded(out.drop("season"), 5, "cum")


# --- fits and distributions -----------------------------------------------------------------

@query("linear_regression", duck([], """SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 5) AS slope,
  round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept, round(regr_r2(l_extendedprice, l_quantity), 9) AS r2,
  CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS pairs FROM lineitem GROUP BY 1""", "one AS (SELECT 1)"))
def linear_regression(spark, sf):
    out = fit.linear_regression(views.load(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", "l_returnflag")
    return rounded(rounded(rounded(out, 5, "slope"), 4, "intercept"), 9, "r2")


def _fit(spark, sf, degree):
    return fit.poly_fit(views.load(spark, sf, "lineitem"), "l_returnflag", "l_quantity", "l_extendedprice", degree)


@query("poly_fit_line", duck([], """SELECT l_returnflag, round(a, 5) AS slope, round(b, 4) AS intercept, pairs, round(rss / pairs, 0) AS mean_square FROM (
  SELECT l_returnflag, any_value(a) AS a, any_value(b) AS b, count(*) AS pairs, sum((l_extendedprice - (a * l_quantity + b)) * (l_extendedprice - (a * l_quantity + b))) AS rss
  FROM lineitem JOIN (SELECT l_returnflag, regr_slope(l_extendedprice, l_quantity) AS a, regr_intercept(l_extendedprice, l_quantity) AS b
                      FROM lineitem GROUP BY 1) f USING (l_returnflag) GROUP BY 1) t""", "one AS (SELECT 1)"))
def poly_fit_line(spark, sf):
    out = _fit(spark, sf, 1)
    return out.select(
        "l_returnflag", F.round(F.col("coefs")[0], 5).alias("slope"), F.round(F.col("coefs")[1], 4).alias("intercept"),
        "pairs", F.round(F.col("rss") / F.col("pairs"), 0).alias("mean_square"),
    )


QUADRATIC = """m AS (SELECT l_returnflag, avg(l_quantity) AS mx, avg(l_extendedprice) AS my, count(*) AS n, min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem GROUP BY 1),
s AS (SELECT l_returnflag, any_value(mx) AS mx, any_value(my) AS my, any_value(n) AS n, any_value(lo) AS lo, any_value(hi) AS hi, sum(t * t) AS s2, sum(t * t * t) AS s3, sum(t * t * t * t) AS s4,
        sum(t * u) AS ty, sum(t * t * u) AS t2y
      FROM (SELECT l_returnflag, mx, my, n, lo, hi, l_quantity - mx AS t, l_extendedprice - my AS u FROM lineitem JOIN m USING (l_returnflag)) x GROUP BY 1),
b AS (SELECT *, (s2 * t2y - s3 * ty) / (s2 * (s4 - s2 * s2 / n) - s3 * s3) AS b2 FROM s),
q AS (SELECT l_returnflag, n, lo, hi, b2 AS c2, (ty - b2 * s3) / s2 - 2 * b2 * mx AS c1,
        my - b2 * s2 / n - (ty - b2 * s3) / s2 * mx + b2 * mx * mx AS c0 FROM b)"""


@query("poly_fit_quadratic", duck([], "SELECT l_returnflag, round(c2, 5) AS c2, round(c1, 4) AS c1, round(c0, 3) AS c0, n AS pairs FROM q", QUADRATIC))
def poly_fit_quadratic(spark, sf):
    c = F.col("coefs")
    return _fit(spark, sf, 2).select(
        "l_returnflag", F.round(c[0], 5).alias("c2"), F.round(c[1], 4).alias("c1"), F.round(c[2], 3).alias("c0"), "pairs"
    )


@query("poly_fit_residuals", duck([], """SELECT l_returnflag, n AS pairs, round(1e9 * sum(pow(l_extendedprice - (c2 * l_quantity * l_quantity + c1 * l_quantity + c0), 2)) / n, 3) AS mean_square
FROM lineitem JOIN q USING (l_returnflag) GROUP BY 1, 2""", """lineitem AS (SELECT l_returnflag, l_quantity, 2 * l_quantity * l_quantity - 3 * l_quantity + 1 + l_tax / 100 AS l_extendedprice FROM main.lineitem)""", QUADRATIC))
def poly_fit_residuals(spark, sf):
    """Residuals of a very good fit, a millionth of the spread of the values."""
    x = F.col("l_quantity")
    rows = views.load(spark, sf, "lineitem").select("l_returnflag", "l_quantity", (2 * x * x - 3 * x + 1 + F.col("l_tax") / 100).alias("y"))
    return fit.poly_fit(rows, "l_returnflag", "l_quantity", "y", 2).select("l_returnflag", "pairs", F.round(F.col("rss") / F.col("pairs") * 1e9, 3).alias("mean_square"))


@query("poly_curve", duck([], """SELECT l_returnflag, point, round(lo + point * ((hi - lo) / 49), 9) AS x,
  round((c2 * (lo + point * ((hi - lo) / 49)) + c1) * (lo + point * ((hi - lo) / 49)) + c0, 3) AS y
FROM q, (SELECT CAST(unnest(generate_series(0, 49)) AS INTEGER) AS point) g""", QUADRATIC))
def poly_curve(spark, sf):
    return rounded(rounded(fit.poly_curve(_fit(spark, sf, 2), "l_returnflag"), 9, "x"), 3, "y")


CUBIC = """m AS (SELECT l_returnflag, avg(l_quantity) AS mx, avg(l_extendedprice) AS my, count(*) AS n FROM lineitem GROUP BY 1),
s AS (SELECT l_returnflag, any_value(mx) AS mx, any_value(my) AS my, any_value(n) AS n, sum(t ** 2) AS s2, sum(t ** 3) AS s3, sum(t ** 4) AS s4, sum(t ** 5) AS s5,
        sum(t ** 6) AS s6, sum(t * u) AS t1, sum(t ** 2 * u) AS t2, sum(t ** 3 * u) AS t3
      FROM (SELECT l_returnflag, mx, my, n, l_quantity - mx AS t, l_extendedprice - my AS u FROM lineitem JOIN m USING (l_returnflag)) x GROUP BY 1),
c AS (SELECT *, s2 AS a11, s3 AS a12, s4 AS a13, s4 - s2 * s2 / n AS a22, s5 - s2 * s3 / n AS a23, s6 - s3 * s3 / n AS a33 FROM s),
d AS (SELECT *, a11 * (a22 * a33 - a23 * a23) - a12 * (a12 * a33 - a23 * a13) + a13 * (a12 * a23 - a22 * a13) AS det FROM c),
b AS (SELECT *, (t1 * (a22 * a33 - a23 * a23) - a12 * (t2 * a33 - a23 * t3) + a13 * (t2 * a23 - a22 * t3)) / det AS b1,
        (a11 * (t2 * a33 - a23 * t3) - t1 * (a12 * a33 - a23 * a13) + a13 * (a12 * t3 - t2 * a13)) / det AS b2,
        (a11 * (a22 * t3 - t2 * a23) - a12 * (a12 * t3 - t2 * a13) + t1 * (a12 * a23 - a22 * a13)) / det AS b3 FROM d)"""


@query("poly_fit_cubic", duck([], """SELECT l_returnflag, n AS pairs, round(b3, 6) AS c3, round(b2 - 3 * b3 * mx, 4) AS c2,
  round(b1 - 2 * b2 * mx + 3 * b3 * mx ** 2, 3) AS c1, round(my - b2 * s2 / n - b3 * s3 / n - b1 * mx + b2 * mx ** 2 - b3 * mx ** 3, 2) AS c0 FROM b""", CUBIC))
def poly_fit_cubic(spark, sf):
    c = F.col("coefs")
    digits = (6, 4, 3, 2)
    return _fit(spark, sf, 3).select("l_returnflag", "pairs", *[F.round(c[i], d).alias(f"c{3 - i}") for i, d in enumerate(digits)])


GRID_END = "gmax AS (SELECT round_even((max(slt) + 51) / 100, 0) * 100 AS hi FROM conductivity)"


@query("kde", duck(["conductivity"], """SELECT point, round(100 + point * ((hi - 100) / 9999), 7) AS x,
  round(sum(cnt * exp(-0.5 * pow((100 + point * ((hi - 100) / 9999) - slt) / 5, 2))) / (any_value(total) * 5 * sqrt(2 * pi())), 9) AS density
FROM (SELECT slt, count(*) AS cnt, sum(count(*)) OVER () AS total FROM conductivity GROUP BY 1) v, gmax,
     (SELECT CAST(unnest(generate_series(0, 9999)) AS INTEGER) AS point) g GROUP BY point, hi""", GRID_END))
def kde(spark, sf):
    return rounded(rounded(density.kernel_density(views.load(spark, sf, "conductivity"), "slt"), 7, "x"), 9, "density")


_WIDE = "CAST(ceil(30 / ((hi - 100) / 9999)) AS INTEGER)"


@query("kde_binned", duck(["conductivity"], f"""SELECT point, round(100 + point * ((hi - 100) / 9999), 7) AS x, round(sum(w * exp(-0.5 * pow(k * ((hi - 100) / 9999) / 5, 2))) / (any_value(total) * 5 * sqrt(2 * pi())), 9) AS density
FROM (SELECT CAST(bin + k AS INTEGER) AS point, w, k, hi, total FROM bins, gmax, (SELECT count(*) AS total FROM conductivity) t, (SELECT unnest(generate_series(-{_WIDE}, {_WIDE})) AS k FROM gmax) r) s
WHERE point BETWEEN 0 AND 9999 GROUP BY point, hi""", GRID_END,
    "placed AS (SELECT (slt - 100) / ((hi - 100) / 9999) AS spot FROM conductivity, gmax)",
    "bins AS (SELECT bin, sum(w) AS w FROM (SELECT floor(spot) AS bin, 1 - (spot - floor(spot)) AS w FROM placed UNION ALL SELECT floor(spot) + 1, spot - floor(spot) FROM placed) b GROUP BY 1)"))
def kde_binned(spark, sf):
    """The density from linear bins, in DataFrame functions; every point of the grid is within the kernel's reach of a value or 0."""
    out = density.binned_density(views.load(spark, sf, "conductivity"), "slt").where("density > 0")
    return rounded(rounded(out, 7, "x"), 9, "density")


def _components(spark, sf):
    rows = views.load(spark, sf, "conductivity").withColumn("part", F.when(F.col("slt") < 250, 1).otherwise(2))
    parts = rows.groupBy("part").agg(F.avg("slt").alias("mean"), F.stddev_pop("slt").alias("std"), F.count("*").alias("_n"))
    total = parts.agg(F.sum("_n")).scalar()
    return mixture.rank_components(parts.select("mean", "std", (F.col("_n") / total).alias("weight")))


COMPONENTS = """parts AS (SELECT avg(slt) AS mean, stddev_pop(slt) AS std, count(*) / sum(count(*)) OVER () AS weight
  FROM conductivity GROUP BY slt < 250),
comps AS (SELECT *, CAST(row_number() OVER (ORDER BY weight DESC, mean) AS INTEGER) AS component FROM parts),
curves AS (SELECT component, point, 100 + point * ((hi - 100) / 9999) AS x,
  weight / (std * sqrt(2 * pi())) * exp(-0.5 * pow((100 + point * ((hi - 100) / 9999) - mean) / std, 2)) AS density
  FROM comps, gmax, (SELECT CAST(unnest(generate_series(0, 9999)) AS INTEGER) AS point) g)"""


def _curves(spark, sf):
    return density.component_curves(_components(spark, sf), density.grid_end(views.load(spark, sf, "conductivity"), "slt"))


@query("component_curves", duck(["conductivity"], "SELECT component, point, round(x, 7) AS x, round(density, 9) AS density FROM curves", GRID_END, COMPONENTS))
def component_curves(spark, sf):
    return rounded(rounded(_curves(spark, sf), 7, "x"), 9, "density")


@query("component_peaks", duck(["conductivity"], "SELECT component, round(max(density), 9) AS peak FROM curves GROUP BY 1", GRID_END, COMPONENTS))
def component_peaks(spark, sf):
    return rounded(density.component_peaks(_curves(spark, sf)), 9, "peak")


# the two groups lie so far apart that the fit is that of each group by itself
@query("gaussian_mixture", duck(["conductivity"], """SELECT CAST(row_number() OVER (ORDER BY count(*) DESC) AS INTEGER) AS component, round(avg(slt), 3) AS mean,
  round(count(*) / sum(count(*)) OVER (), 3) AS weight, round(sqrt(var_pop(slt) + 1e-6), 3) AS std FROM conductivity GROUP BY slt < 250"""))
def gaussian_mixture(spark, sf):
    out = mixture.gaussian_mixture(views.load(spark, sf, "conductivity"), "slt", 2)
    return rounded(out, 3, "mean", "weight", "std")


def _em_sql(rows, column, k, n_init=10, seed=0, max_iter=1000, tol=1e-3):
    """The same expectation maximisation as a recursive query over the histogram, all restarts at once."""
    each = range(k)
    probs = mixture.start_quantiles(k, n_init, seed)
    flat = ", ".join(repr(p) for row in probs for p in row)
    one = ", ".join(f"ln(1e0 / {k}) AS w{j}, q[{{0}} * {k} + {j} + 1] + 1e-3 * sd * {j} AS m{j}, sd AS s{j}" for j in each)
    start = " UNION ALL ".join(f"SELECT {r} AS r, 0 AS it, -1e300 AS ll, false AS done, {one.format(r)} FROM first_guess" for r in range(n_init))
    logs = ", ".join(f"w{j} - ln(s{j}) - 0.5 * ln(2 * pi()) - 0.5 * pow((v - m{j}) / s{j}, 2) AS l{j}" for j in each)
    top = "greatest(" + ", ".join(f"l{j}" for j in each) + ")"
    exps = ", ".join(f"exp(l{j} - top) AS e{j}" for j in each)
    total = " + ".join(f"e{j}" for j in each)
    sums = ", ".join(f"greatest(sum(c * e{j} / tot), 2.3e-15) AS n{j}, sum(c * e{j} / tot * (v - m{j})) AS d{j}, sum(c * e{j} / tot * pow(v - m{j}, 2)) AS q{j}" for j in each)
    kept = ", ".join(f"m{j}" for j in each)
    new = ", ".join(f"ln(n{j} / n) AS w{j}, m{j} + d{j} / n{j} AS m{j}, sqrt(greatest(q{j} / n{j} - pow(d{j} / n{j}, 2), 0) + 1e-6) AS s{j}" for j in each)
    parts = " UNION ALL ".join(f"SELECT exp(w{j}) AS weight, m{j} AS mean, s{j} AS std FROM best" for j in each)
    return f"""hist AS (SELECT CAST({column} AS DOUBLE) AS v, count(*) AS c FROM {rows} WHERE {column} IS NOT NULL GROUP BY 1),
first_guess AS (SELECT greatest(stddev_pop({column}) / {k}, 1e-3) AS sd, quantile_disc({column}, [{flat}]) AS q FROM {rows}),
em AS ({start} UNION ALL
  SELECT r, it + 1, bound, abs(bound - ll) < {tol!r}, {new} FROM (
    SELECT r, it, ll, {kept}, sum(c) AS n, sum(c * (top + ln(tot))) / sum(c) AS bound, {sums} FROM (
      SELECT *, {total} AS tot FROM (SELECT *, {exps} FROM (SELECT *, {top} AS top FROM (
        SELECT em.*, v, c, {logs} FROM em, hist WHERE NOT done AND it < {max_iter}) x) y) z) t GROUP BY r, it, ll, {kept}) u),
best AS (SELECT * FROM (SELECT * FROM em QUALIFY row_number() OVER (PARTITION BY r ORDER BY it DESC) = 1) e ORDER BY ll DESC LIMIT 1),
mixed AS (SELECT *, CAST(row_number() OVER (ORDER BY weight DESC, mean) AS INTEGER) AS component FROM ({parts}) p)"""


@query("conductivity_mixture", "WITH RECURSIVE " + duck(["spring"], """SELECT component, round(mean, 3) AS mean, round(weight, 3) AS weight, round(std, 3) AS std,
  round((SELECT max(weight / (std * sqrt(2 * pi())) * exp(-0.5 * pow((100 + point * ((hi - 100) / 9999e0) - mean) / std, 2)))
         FROM (SELECT unnest(generate_series(0, 9999)) AS point) g, (SELECT round_even((max(slt) + 51) / 100, 0) * 100 AS hi FROM spring) h), 3) AS peak
FROM mixed""", _em_sql("spring", "slt", 3))[len("WITH "):])
def conductivity_mixture(spark, sf):
    """Mixture of the spring conductance, whose components overlap, with ten restarts: components and their peaks."""
    comps, _, _ = conductivity.conductivity_mixture(views.load(spark, sf, "spring"), 3)
    return rounded(comps, 3, "mean", "weight", "std", "peak")


# --- merging, duplicates, latest rows ----------------------------------------------------------

# stored rows: readings of the first copy of each cell; new rows: the last copy, for times that have several
OVERLAY = """oldr AS (SELECT station_id, ts, arg_min(value, event_id) FILTER (WHERE sensor = 'LT') AS lt, arg_min(value, event_id) FILTER (WHERE sensor = 'HS') AS hs
  FROM readings WHERE ts < TIMESTAMP '2024-01-20 00:00:00' GROUP BY 1, 2),
newr AS (SELECT station_id, ts, arg_max(value, event_id) FILTER (WHERE sensor = 'LT') AS lt, arg_max(value, event_id) FILTER (WHERE sensor = 'HS') AS hs
  FROM readings WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' GROUP BY 1, 2)"""


def _old_new(spark, sf):
    r = views.load(spark, sf, "readings")
    cell = [F.when(F.col("sensor") == s, F.col("value")) for s in ("LT", "HS")]
    order = [F.when(F.col("sensor") == s, F.col("event_id")) for s in ("LT", "HS")]
    old = r.where("ts < timestamp_ntz'2024-01-20 00:00:00'").groupBy("station_id", "ts").agg(
        F.min_by(cell[0], order[0]).alias("lt"), F.min_by(cell[1], order[1]).alias("hs"))
    new = r.where("ts >= timestamp_ntz'2024-01-10 00:00:00'").groupBy("station_id", "ts").agg(
        F.max_by(cell[0], order[0]).alias("lt"), F.max_by(cell[1], order[1]).alias("hs"))
    return old, new


def _overlay_sql(how):
    return f"""SELECT station_id, ts, coalesce(n.lt, o.lt) AS lt, coalesce(n.hs, o.hs) AS hs
FROM oldr o {how} JOIN newr n USING (station_id, ts)"""


@query("overlay_merge", duck(["readings"], _overlay_sql("FULL OUTER"), OVERLAY))
def overlay_merge(spark, sf):
    return merge.overlay(*_old_new(spark, sf), ["station_id", "ts"], ["lt", "hs"])


@query("overlay_left", duck(["readings"], _overlay_sql("LEFT"), OVERLAY))
def overlay_left(spark, sf):
    return merge.overlay(*_old_new(spark, sf), ["station_id", "ts"], ["lt", "hs"], "left")


@query("overlap_rows", duck(["readings"], "SELECT n.* FROM newr n SEMI JOIN oldr USING (station_id, ts)", OVERLAY))
def overlap_rows(spark, sf):
    old, new = _old_new(spark, sf)
    return merge.overlapping(new, old, ["station_id", "ts"])


@query("overlay_months", duck(["daily", "monthly"], """SELECT station_id, period, coalesce(d.lt, m.lt) AS lt, coalesce(d.hs, m.hs) AS hs, coalesce(d.n, m.n) AS n
FROM monthly m LEFT JOIN (SELECT * FROM (SELECT station_id, CAST(last_day(date) AS TIMESTAMP) AS period, avg(lt) AS lt, avg(hs) AS hs, avg(n) AS n, station_id = 2 AS dry
  FROM daily GROUP BY 1, 2, 6) t WHERE lt IS NOT NULL AND hs IS NOT NULL AND (dry OR n IS NOT NULL)) d USING (station_id, period)"""))
def overlay_months(spark, sf):
    """Monthly means of the daily rows put over the stored months."""
    days = views.load(spark, sf, "daily").withColumn("period", F.col("date").cast("timestamp_ntz"))
    return update.overlay_months(views.load(spark, sf, "monthly"), days, ("lt", "hs", "n"))


@query("dedup_first", duck(["readings"], """SELECT station_id, sensor, ts, value, event_id
FROM (SELECT *, row_number() OVER (PARTITION BY station_id, sensor, ts ORDER BY event_id) AS rk FROM readings) t WHERE rk = 1"""))
def dedup_first(spark, sf):
    return merge.keep_first(views.load(spark, sf, "readings"), ["station_id", "sensor", "ts"], "event_id")


@query("duplicate_count", duck(["readings"], "SELECT station_id, CAST(count(ts) - count(DISTINCT ts) AS BIGINT) AS duplicates FROM readings GROUP BY 1"))
def duplicate_count(spark, sf):
    return merge.duplicate_excess(views.load(spark, sf, "readings"))


@query("duplicate_rows", duck(["readings"], "SELECT station_id, ts, count(*) AS copies FROM readings GROUP BY 1, 2 HAVING count(*) > 1"))
def duplicate_rows(spark, sf):
    return merge.duplicate_rows(views.load(spark, sf, "readings"), ["station_id", "ts"])


SENSORS_SQL = "list_filter([" + ", ".join(f"CASE WHEN k.{c} > 0 THEN '{c.upper()}' END" for c in SENSOR_COLS) + "], lambda x: x IS NOT NULL)"


@query("sensor_availability", duck(["readings"], f"SELECT station_id, array_to_string({SENSORS_SQL}, ',') AS sensors, k.n > 0 AS has_n FROM newest k", _pivot("readings"), _newest("wide")))
def sensor_availability(spark, sf):
    return latest.available_sensors(wide(spark, sf)).withColumn("sensors", F.array_join("sensors", ","))


@query("latest_oldest", duck(["readings"], "SELECT station_id, oldest_ts, latest_ts FROM latest", LATEST_RAW.format("readings")))
def latest_oldest(spark, sf):
    return latest.time_span(views.load(spark, sf, "readings"))


@query("latest_with_fallback", duck(["readings", "daily"], """SELECT station_id, coalesce(d.lo, l.oldest_ts) AS oldest_ts, coalesce(d.hi, l.oldest_ts) AS latest_ts
FROM latest l LEFT JOIN (SELECT station_id, CAST(min(date) AS TIMESTAMP) AS lo, CAST(max(date) AS TIMESTAMP) AS hi FROM daily WHERE n IS NOT NULL GROUP BY 1) d USING (station_id)""",
    LATEST_RAW.format("readings")))
def latest_with_fallback(spark, sf):
    """Station 2 has no processed precipitation and falls back to its oldest raw reading."""
    done = views.load(spark, sf, "daily").where("n IS NOT NULL").withColumn("period", F.col("date").cast("timestamp_ntz"))
    return latest.span_with_fallback(done, views.load(spark, sf, "readings"))


@query("latest_id", duck(["readings"], "SELECT CAST(user_id % 6 + 1 AS INTEGER) AS station_id, arg_max(event_id, ts) AS latest_id FROM events GROUP BY 1"))
def latest_id(spark, sf):
    rows = views.load(spark, sf, "events").withColumn("station_id", (F.col("user_id") % 6 + 1).cast("int"))
    return latest.latest_id(rows, "event_id")


@query("latest_rows", duck(["readings"], """SELECT station_id, sensor, ts, value, event_id, CAST(rk AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY ts DESC, event_id DESC) AS rk FROM readings) t WHERE rk <= 10"""))
def latest_rows(spark, sf):
    return latest.latest_rows(views.load(spark, sf, "readings"), ["ts", "event_id"])


@query("quality_report", duck(["readings"], f"""SELECT station_id, c.rows, d.duplicates, array_to_string({SENSORS_SQL}, ',') AS sensors, k.n > 0 AS has_n, l.oldest_ts, l.latest_ts
FROM (SELECT station_id, count(*) AS rows FROM wide GROUP BY 1) c
JOIN (SELECT station_id, CAST(count(ts) - count(DISTINCT ts) AS BIGINT) AS duplicates FROM wide GROUP BY 1) d USING (station_id)
JOIN newest k USING (station_id) JOIN latest l USING (station_id)""", _pivot("readings"), _newest("wide"), LATEST_RAW.format("wide")))
def quality_report(spark, sf):
    return quality.quality_report(wide(spark, sf)).withColumn("sensors", F.array_join("sensors", ","))


# --- sources --------------------------------------------------------------------------------------

PORTAL_SQL = """SELECT regexp_extract(file_name, '^(.*)_(LT|LF|HS|N|SD|GS)_from_', 1) AS station,
  regexp_extract(file_name, '^(.*)_(LT|LF|HS|N|SD|GS)_from_', 2) AS sensor,
  CAST(substr(DATE, 1, 19) AS TIMESTAMP) AS ts, CAST(substr(DATE, 1, 19) AS TIMESTAMP) - INTERVAL 1 HOUR AS ts_utc, VALUE AS value FROM portal"""


@query("portal_parse", duck(["portal"], PORTAL_SQL))
def portal_parse(spark, sf):
    return portal.parse_portal(views.load(spark, sf, "portal"))


STATIONS_SQL = """stations AS (SELECT * FROM (VALUES (1, 'Piz La Ila', '61690SF'), (2, 'Rossalm', '42830SF'), (3, 'Piz Pisciadu', '61720WS'),
  (4, 'Wolkenstein', '73500MS'), (5, 'St. Martin', '62600MS'), (6, 'St. Veit', '42700MS')) t(station_id, station_name, station_code))"""


@query("station_lookup", duck(["portal"], """SELECT s.station_id, s.station_code, count(*) AS readings FROM portal
JOIN stations s ON s.station_name = regexp_extract(file_name, '^(.*)_(LT|LF|HS|N|SD|GS)_from_', 1) GROUP BY 1, 2""", STATIONS_SQL))
def station_lookup(spark, sf):
    """Readings per station, joined to the station table."""
    rows = portal.with_station_id(portal.parse_portal(views.load(spark, sf, "portal")), tables.stations(spark))
    return rows.groupBy("station_id").agg(F.count("*").alias("readings")).join(
        tables.stations(spark).select("station_id", "station_code"), "station_id"
    )


@query("station_metadata", duck([], """SELECT s_name AS name, 'C' || s_suppkey AS scode, CAST(s_nationkey * 100 AS INTEGER) AS alt,
  s_suppkey + 0.5e0 AS x, s_nationkey + 0.25e0 AS y FROM supplier""", "one AS (SELECT 1)"))
def station_metadata(spark, sf):
    return tables.station_metadata(views.load(spark, sf, "documents_json"))


HISTORIC_SQL = """hist AS (SELECT file_name, CASE WHEN file_name LIKE '%HS%' THEN 'HS' WHEN file_name LIKE '%LT%' THEN 'LT' ELSE 'N' END AS sensor,
  CASE WHEN file_name LIKE '%Month%' THEN 'monthly' ELSE 'daily' END AS resolution,
  CAST(strptime(split_part(value, '\t', 1), '%d/%m/%Y') AS DATE) AS d,
  CASE WHEN split_part(value, '\t', 4) = '40 (Gut)' THEN TRY_CAST(replace(split_part(value, '\t', 3), ',', '.') AS DOUBLE) END AS value FROM historic),
parsed AS (SELECT file_name, sensor, resolution, CASE WHEN resolution = 'monthly' THEN last_day(d) ELSE d END AS date, value FROM hist WHERE d < DATE '2000-08-01')"""
HISTORIC_WIDE = """hwide AS (SELECT CASE WHEN file_name LIKE '%Rossalm%' THEN 2 WHEN file_name LIKE '%Wolkenstein%' THEN 4 ELSE 5 END AS station_id, resolution, date,
  min(value) FILTER (WHERE sensor = 'LT') AS lt, min(value) FILTER (WHERE sensor = 'HS') AS hs, min(value) FILTER (WHERE sensor = 'N') AS n FROM parsed GROUP BY 1, 2, 3)"""


def _historic(spark, sf):
    return historic.parse_historic(views.load(spark, sf, "historic"), "2000-08-01")


@query("historic_parse", duck(["historic"], "SELECT * FROM parsed", HISTORIC_SQL), dates="date")
def historic_parse(spark, sf):
    return _historic(spark, sf)


@query("historic_wide", duck(["historic"], "SELECT * FROM hwide", HISTORIC_SQL, HISTORIC_WIDE), dates="date")
def historic_wide(spark, sf):
    return historic.historic_wide(_historic(spark, sf)).drop("lf", "sd", "gs")


@query("load_history", duck(["historic"], """SELECT station_id, 'daily' AS rule, CAST(date AS TIMESTAMP) AS period, lt, hs, n FROM hwide WHERE resolution = 'daily'
UNION ALL SELECT m.station_id, 'monthly', CAST(m.date AS TIMESTAMP), coalesce(d.lt, m.lt), coalesce(d.hs, m.hs), coalesce(d.n, m.n)
FROM (SELECT * FROM hwide WHERE resolution = 'monthly') m
LEFT JOIN (SELECT * FROM (SELECT station_id, last_day(date) AS date, avg(lt) AS lt, avg(hs) AS hs, avg(n) AS n FROM hwide WHERE resolution = 'daily' GROUP BY 1, 2) t
           WHERE lt IS NOT NULL AND hs IS NOT NULL AND n IS NOT NULL) d USING (station_id, date)""", HISTORIC_SQL, HISTORIC_WIDE))
def load_history(spark, sf):
    """Historic files to processed rows, written to a table and read back."""
    path = scratch_dir(spark, "history")
    update.load_history(_historic(spark, sf), path)
    return store.read_table(spark, path).select("station_id", "rule", "period", "lt", "hs", "n")


def _listing(spark, sf, *status):
    return manifest.station_files(views.load(spark, sf, "files").where(F.col("status").isin(*status)).select("path").distinct())


FILES_SQL = """listing AS (SELECT DISTINCT path FROM files WHERE status IN ('F', 'O') AND path NOT LIKE '%/Processed/%'),
seen AS (SELECT DISTINCT path FROM files WHERE status IN ('O', 'P') AND path NOT LIKE '%/Processed/%')"""


@query("file_diff", duck(["files"], """SELECT path, 'added' AS state FROM listing WHERE path NOT IN (SELECT path FROM seen)
UNION ALL SELECT path, 'removed' FROM seen WHERE path NOT IN (SELECT path FROM listing)""", FILES_SQL))
def file_diff(spark, sf):
    return manifest.file_changes(_listing(spark, sf, "F", "O"), _listing(spark, sf, "O", "P"))


@query("file_unseen", duck(["files"], """SELECT path FROM listing WHERE path NOT IN (SELECT path FROM seen)
UNION ALL SELECT regexp_replace(path, '[.]json$', '_again.json') FROM listing WHERE path LIKE '%Wolkenstein_LT%'""", FILES_SQL))
def file_unseen(spark, sf):
    """A second look at folders with a stored manifest: what is new in those that have changed."""
    path = scratch_dir(spark, "manifest")
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    seen, now = _listing(spark, sf, "O", "P").withColumn("modified", at), _listing(spark, sf, "F", "O").withColumn("modified", at)
    again = now.where(F.col("path").contains("Wolkenstein_LT")).select(F.regexp_replace("path", "[.]json$", "_again.json").alias("path"), (F.col("modified") + F.expr("INTERVAL 1 DAY")).alias("modified"))
    first, folders = manifest.unseen_files(spark, seen, path)
    manifest.note_files(first, path)
    manifest.note_folders(folders, path)
    return manifest.unseen_files(spark, now.unionByName(again), path)[0]


@query("file_manifest", duck(["files"], "SELECT path FROM listing UNION SELECT path FROM seen", FILES_SQL))
def file_manifest(spark, sf):
    return manifest.next_manifest(_listing(spark, sf, "F", "O"), _listing(spark, sf, "O", "P"))


@query("file_forget", duck(["files"], "SELECT path FROM seen WHERE path NOT LIKE '%Rossalm_HS%'", FILES_SQL))
def file_forget(spark, sf):
    return manifest.forget_files(_listing(spark, sf, "O", "P"), "Rossalm_HS")


@query("request_plan", duck([], """SELECT station_id, sensor, CAST(part AS INTEGER) AS part, start + CAST(ceil((part - 1) * (days / parts)) AS INTEGER) AS date_from,
  start + CAST(ceil(part * (days / parts)) AS INTEGER) AS date_to
FROM (SELECT *, unnest(generate_series(1, parts)) AS part FROM (
  SELECT *, CASE WHEN days >= lim THEN CAST(ceil(days / lim) AS INTEGER) ELSE 1 END AS parts FROM (
    SELECT station_id, sensor, start, date_diff('day', start, DATE '2020-05-07') AS days, CASE WHEN sensor = 'N' THEN 418 ELSE 835 END AS lim FROM (
      SELECT station_id, unnest(sensors) AS sensor, greatest(latest_date, DATE '2014-08-01') AS start FROM (
        SELECT o_custkey AS station_id, CAST(max(o_orderdate) AS DATE) + 6575 AS latest_date,
          list_distinct(list(CASE o_orderstatus WHEN 'F' THEN 'LT' WHEN 'O' THEN 'N' ELSE 'HS' END)) AS sensors
        FROM orders GROUP BY 1) a WHERE latest_date <> DATE '2020-05-07') b) c) d) e""", "one AS (SELECT 1)"), dates="date_from date_to")
def request_plan(spark, sf):
    """Every customer as a station, last seen on the day of its latest order (18 years on)."""
    sensor = F.when(F.col("o_orderstatus") == "F", "LT").when(F.col("o_orderstatus") == "O", "N").otherwise("HS")
    known = views.load(spark, sf, "orders").groupBy(F.col("o_custkey").alias("station_id")).agg(
        F.date_add(F.max(F.to_date("o_orderdate")), 6575).alias("latest_date"), F.collect_set(sensor).alias("sensors")
    )
    return requests.plan_requests(known, F.lit("2020-05-07").cast("date"))


@query("logger_normalise", duck(["spring"], "SELECT ts, wt, slt FROM spring"))
def logger_normalise(spark, sf):
    sheet = views.load(spark, sf, "spring").select(
        F.col("ts").alias("Date Time, GMT+02:00"), F.lit(1).alias("#"), F.col("wt").alias("Temp, °C"),
        F.col("site").alias("Notes"), F.col("slt").alias("Specific Conductance, μS/cm"),
    )
    return tables.normalise_logger(sheet, [0, 2, 4])


@query("read_lake_csv", duck(["lake_depth"], "SELECT lake, date, wd, volume, w_change FROM lake_log", LAKE_LOG), dates="date")
def read_lake_csv(spark, sf):
    """The log of each lake exported to CSV in its own form and read back."""
    path = scratch_dir(spark, "lake-csv")
    out = []
    for lake, names in (("Limo", ("WD", "Vol")), ("Parom", ("Volume", "WD"))):
        cols = {"WD": "wd", "Vol": "volume", "Volume": "volume"}
        rows = _lake_log(spark, sf).where(F.col("lake") == lake)
        rows.select(F.col("date").alias("Datum"), *[F.col(cols[n]).alias(n) for n in names], F.col("w_change").alias("W_change")).write.csv(f"{path}/{lake}", header=True)
        out.append(tables.read_lake_log(spark, f"{path}/{lake}", lake))
    return out[0].unionByName(out[1])


@query("read_lake_calc_csv", duck(["lake_calc"], "SELECT lake, date, area_glatt, vol_calc, volume, wd FROM lake_calc"), dates="date")
def read_lake_calc_csv(spark, sf):
    """The sparse table of each lake exported to CSV and read back."""
    path = scratch_dir(spark, "lake-calc-csv")
    none = F.lit(None).cast("double")
    out = []
    for lake in ("Limo", "Parom"):
        views.load(spark, sf, "lake_calc").where(F.col("lake") == lake).select(
            F.col("date").alias("Datum"), none.alias("Area"), F.col("area_glatt").alias("Area_glatt"), F.col("vol_calc").alias("Vol_calc"),
            F.col("volume").alias("Volume"), F.col("wd").alias("WD"), none.alias("WD_calc"), none.alias("WD_calc_smooth"),
        ).write.csv(f"{path}/{lake}", header=True)
        out.append(tables.read_lake_calc(spark, f"{path}/{lake}", lake).select("lake", "date", "area_glatt", "vol_calc", "volume", "wd"))
    return out[0].unionByName(out[1])


@query("read_historic_files", duck(["historic"], "SELECT file_name, sensor, resolution, date, count(*) AS rows, sum(value) AS total FROM parsed GROUP BY 1, 2, 3, 4", HISTORIC_SQL), dates="date")
def read_historic_files(spark, sf):
    """All historic files written as text below folders of their names and read by the real reader."""
    path = scratch_dir(spark, "historic")
    views.load(spark, sf, "historic").select("file_name", "value").write.partitionBy("file_name").text(path)
    rows = historic.read_historic(spark, path, "2000-08-01")
    return rows.groupBy("file_name", "sensor", "resolution", "date").agg(F.count("*").alias("rows"), F.sum("value").alias("total"))


def _portal_files(spark, sf, view="portal"):
    """The records of a view as JSON files below folders of their names."""
    path = scratch_dir(spark, "portal")
    rows = views.load(spark, sf, view)
    rows.select("file_name", "DATE", "VALUE").write.partitionBy("file_name").json(path)
    return path


@query("read_portal_files", duck(["portal"], PORTAL_SQL))
def read_portal_files(spark, sf):
    """Portal files read back by the real reader, names and all."""
    return portal.read_portal_json(spark, _portal_files(spark, sf)).drop("load_seq")


@query("portal_rejects", duck(["portal"], """SELECT file_name, reason, count(*) AS records FROM (
  SELECT replace(file_name, 'Rossalm', 'Nowhere') AS file_name, CASE WHEN file_name LIKE '%\\_GS\\_%' ESCAPE '\\' THEN 'time' WHEN file_name LIKE 'Rossalm%' THEN 'station' END AS reason FROM portal) t
WHERE reason IS NOT NULL GROUP BY 1, 2""".replace("\\\\", "\\")))
def portal_rejects(spark, sf):
    """Records of an unknown station and with unreadable times, counted per file."""
    rows = views.load(spark, sf, "portal")
    bad = F.when(F.contains(F.col("file_name"), F.lit("_GS_")), F.lit("yesterday")).otherwise(F.col("DATE"))
    rows = rows.withColumn("DATE", bad).withColumn("file_name", F.replace("file_name", F.lit("Rossalm"), F.lit("Nowhere")))
    return portal.rejected(rows, tables.stations(spark))


@query("read_metadata_files", duck([], """SELECT s_name AS name, 'C' || s_suppkey AS scode, CAST(s_nationkey * 100 AS INTEGER) AS alt,
  s_suppkey + 0.5e0 AS x, s_nationkey + 0.25e0 AS y FROM supplier""", "one AS (SELECT 1)"))
def read_metadata_files(spark, sf):
    """Station documents written one to a line of text files and read whole by the real reader."""
    path = scratch_dir(spark, "metadata")
    rows = views.load(spark, sf, "documents_json")
    # one document of all stations per file
    merged = rows.groupBy(F.spark_partition_id().alias("p")).agg(F.concat_ws(", ", F.collect_list(F.expr("substr(value, 2, length(value) - 2)"))).alias("body"))
    merged.select(F.concat(F.lit("{"), "body", F.lit("}")).alias("value")).write.text(path)
    return tables.read_station_metadata(spark, path)


@query("read_logger_csv", duck(["spring"], "SELECT CAST(date_trunc('second', ts) AS TIMESTAMP) AS ts, wt, slt FROM spring"))
def read_logger_csv(spark, sf):
    """Logger sheet exported as CSV with its long column names and read by the real reader."""
    path = scratch_dir(spark, "logger-csv")
    names = ["#", "Date Time, GMT+02:00", "Temp, °C", "Specific Conductance, μS/cm", "Notes"]
    rows = views.load(spark, sf, "spring")
    second = F.date_trunc("second", "ts").cast("timestamp_ntz")  # as loggers write it
    rows.select(F.lit(1).alias(names[0]), second.alias(names[1]), F.col("wt").alias(names[2]), F.col("slt").alias(names[3]), F.col("site").alias(names[4])).write.csv(path, header=True)
    schema = ", ".join(f"`{n}` {t}" for n, t in zip(names, ("int", "timestamp_ntz", "double", "double", "string")))
    return tables.read_logger(spark, path, schema, [1, 2, 3])


@query("read_isotope_csv", duck(["isotopes"], "SELECT site, date, CAST(sample AS VARCHAR) AS sample, d18o, d18o_sd, d2h, d2h_sd FROM isotopes"), dates="date")
def read_isotope_csv(spark, sf):
    path = scratch_dir(spark, "isotope-csv")
    rows = views.load(spark, sf, "isotopes")
    rows.select(F.col("date").alias("Datum"), F.col("sample").alias("Sample"), F.col("d18o").alias("d18O"), F.col("d18o_sd").alias("s.d. d18O"),
                F.col("d2h").alias("d2H"), F.col("d2h_sd").alias("s.d. d2H"), F.col("site").alias("Quelle")).write.csv(path, header=True)
    return tables.read_isotopes(spark, path)


# --- tables, streams ---------------------------------------------------------------------------------

@query("store_raw_merge", duck(["readings"], _overlay_sql("FULL OUTER"), OVERLAY))
def store_raw_merge(spark, sf):
    """Append to the raw table, overlay a later delivery, read back."""
    old, new = _old_new(spark, sf)
    path = scratch_dir(spark, "raw")
    rest = [F.lit(None).cast("double").alias(c) for c in SENSOR_COLS if c not in ("lt", "hs")]
    for rows in (old, new):
        store.merge_raw(spark, rows.select("*", *rest), path)
    return store.read_table(spark, path).select("station_id", "ts", "lt", "hs")


@query("store_append", duck(["readings"], "SELECT station_id, ts, lt, hs FROM oldr UNION ALL SELECT station_id, ts, lt, hs FROM newr", OVERLAY))
def store_append(spark, sf):
    """Two appends to the raw table."""
    path = scratch_dir(spark, "raw")
    for rows in _old_new(spark, sf):
        store.write_raw(rows, path)
    return store.read_table(spark, path).select("station_id", "ts", "lt", "hs")


@query("delete_range", duck(["readings"], """SELECT * FROM readings
WHERE NOT (station_id = 3 AND ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-09 12:00:00')"""))
def delete_range(spark, sf):
    lo, hi = (F.lit(t).cast("timestamp_ntz") for t in ("2024-01-05 00:00:00", "2024-01-09 12:00:00"))
    return store.delete_range(views.load(spark, sf, "readings"), 3, lo, hi)


@query("update_store", _PROCESSED_RAW)
def update_store(spark, sf):
    """Readings -> raw table -> cleaned, rolled up -> processed table, run twice, read back."""
    raw, done = scratch_dir(spark, "raw"), scratch_dir(spark, "processed")
    readings = views.load(spark, sf, "readings")
    for _ in range(2):
        update.ingest(spark, readings, raw, "event_id")
        update.update_processed(spark, raw, done)
    return rounded(store.read_table(spark, done).drop("year"), 9, "n", "sd", "gs")


WINNER = ", ".join(f"arg_max(value, event_id) FILTER (WHERE sensor = '{c.upper()}') AS {c}" for c in SENSOR_COLS)


@query("overlay_newest", duck(["readings"], "SELECT station_id, ts, " + ", ".join(f"coalesce(b.{c}, a.{c}) AS {c}" for c in SENSOR_COLS) + f""" FROM
(SELECT station_id, ts, {WINNER} FROM readings WHERE event_id % 2 = 1 GROUP BY 1, 2) a FULL OUTER JOIN
(SELECT station_id, ts, {WINNER} FROM readings WHERE event_id % 2 = 0 GROUP BY 1, 2) b USING (station_id, ts)"""))
def overlay_newest(spark, sf):
    """Two deliveries with equal times and different values, rows in any order: the newest copy wins, then the newer delivery."""
    raw = scratch_dir(spark, "raw")
    for rest in (1, 0):
        rows = views.load(spark, sf, "readings").where(F.col("event_id") % 2 == rest).orderBy(F.xxhash64("event_id"))
        # the second delivery was written later
        seq = F.col("event_id") + (1 - rest) * 10**12
        update.ingest(spark, rows.select("station_id", "sensor", "ts", "value", seq.alias("load_seq")), raw, "load_seq", newest=True)
    return store.read_table(spark, raw).select("station_id", "ts", *SENSOR_COLS)


@query("ingest_any_order", duck(["readings"], f"SELECT station_id, ts, {WINNER} FROM readings GROUP BY 1, 2"))
def ingest_any_order(spark, sf):
    """Three deliveries that share their times, merged out of order: the highest sequence number wins in every cell."""
    raw = scratch_dir(spark, "raw")
    for rest in (1, 2, 0):
        rows = views.load(spark, sf, "readings").where(F.col("event_id") % 3 == rest)
        update.ingest(spark, rows, raw, "event_id", newest=True)
    return store.read_table(spark, raw).select("station_id", "ts", *SENSOR_COLS)


_KEPT = """kept AS (SELECT * FROM readings WHERE station_id <> 5
  AND NOT (station_id = 3 AND ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-09 12:00:00'))"""
_body, _ctes = _processed_sql("aligned")


@query("delete_store", duck(["readings"], _body, _KEPT, _pivot("kept"), ALIGNED.replace("FROM readings", "FROM kept"), *_ctes))
def delete_store(spark, sf):
    """Days of one station and all of another taken out of the raw table and of the periods; as if they had never come."""
    raw, done = scratch_dir(spark, "raw"), scratch_dir(spark, "processed")
    update.ingest_and_rebuild(spark, views.load(spark, sf, "readings"), raw, done, "event_id", newest=False)
    update.delete_span(spark, raw, 3, "2024-01-05 00:00:00", "2024-01-09 12:00:00", done)
    update.delete_span(spark, raw, 5, "2000-01-01 00:00:00", "2100-01-01 00:00:00", done)
    out = store.read_table(spark, done).where("rule != 'movavg'").drop("year")
    return rounded(out, 9, "n", "sd", "gs")


@query("update_one_day", _PROCESSED_RAW)
def update_one_day(spark, sf):
    """A day that comes after all others: the periods it touches are computed anew, and all are those of a full rebuild."""
    raw, done = scratch_dir(spark, "raw"), scratch_dir(spark, "processed")
    rows = views.load(spark, sf, "readings")
    late = F.to_date("ts") == F.lit("2024-01-10").cast("date")
    for part in (rows.where(~late), rows.where(late)):
        update.ingest_and_rebuild(spark, part, raw, done, "event_id", newest=False)
    return rounded(store.read_table(spark, done).where("rule != 'movavg'").drop("year"), 9, "n", "sd", "gs")


_AUTUMN = """autumn AS (SELECT station_id, sensor, value, event_id, ts_utc, ts_utc + CASE WHEN ts_utc < TIMESTAMP '2020-10-25 01:00:00' THEN INTERVAL 2 HOUR ELSE INTERVAL 1 HOUR END AS ts
  FROM (SELECT *, TIMESTAMP '2020-10-24 22:00:00' + to_minutes(CAST(event_id % 48 * 10 AS INTEGER)) AS ts_utc FROM (SELECT station_id, sensor, value, event_id FROM readings) q) r)"""
_in_utc = lambda sql: sql.replace("ORDER BY ts)", "ORDER BY ts_utc)").replace("SELECT station_id, ts, lt AS lt0", "SELECT station_id, ts_utc, ts, lt AS lt0")


@query("processed_autumn_day", duck(["readings"], _body, _AUTUMN,
    _pivot("autumn").replace("station_id, ts,", "station_id, ts_utc, any_value(ts) AS ts,", 1),
    ALIGNED.replace("FROM readings", "FROM autumn").replace("(ts)", "(ts_utc)").replace("ts BETWEEN", "ts_utc BETWEEN").replace("lo, ts)", "lo, ts_utc)"),
    *map(_in_utc, _ctes)))
def processed_autumn_day(spark, sf):
    """The day with the hour that comes twice: readings follow each other by instant, periods are local."""
    raw, done = scratch_dir(spark, "raw"), scratch_dir(spark, "processed")
    instant = F.lit("2020-10-24 22:00:00").cast("timestamp_ntz") + F.make_dt_interval(mins=(F.col("event_id") % 48 * 10).cast("int"))
    hours = F.when(F.col("ts_utc") < F.lit("2020-10-25 01:00:00").cast("timestamp_ntz"), 2).otherwise(1)
    rows = views.load(spark, sf, "readings").withColumn("ts_utc", instant).withColumn("ts", F.col("ts_utc") + F.make_dt_interval(hours=hours))
    update.ingest_and_rebuild(spark, rows, raw, done, "event_id", newest=False)
    return rounded(store.read_table(spark, done).where("rule != 'movavg'").drop("year"), 9, "n", "sd", "gs")


@query("ingest_single_sensor", duck(["readings"], f"SELECT station_id, ts, {WINNER} FROM readings GROUP BY 1, 2"))
def ingest_single_sensor(spark, sf):
    """One sensor per delivery, the anchor sensor last but one: nothing is lost."""
    raw = scratch_dir(spark, "raw")
    for sensor in ("HS", "N", "LF", "LT", "GS"):
        rows = views.load(spark, sf, "readings").where(F.col("sensor") == sensor)
        update.ingest(spark, rows, raw, "event_id", newest=True)
    return store.read_table(spark, raw).select("station_id", "ts", *SENSOR_COLS)


@query("ingest_autumn_hour", duck(["readings"], f"""SELECT station_id, CAST(ts - CASE WHEN summer THEN INTERVAL 2 HOUR ELSE INTERVAL 1 HOUR END AS TIMESTAMP) AS ts_utc, any_value(ts) AS ts, {WINNER}
FROM (SELECT station_id, sensor, value, event_id, event_id % 2 = 0 AS summer, CAST('2020-10-25 02:00:00' AS TIMESTAMP) + to_minutes(CAST(event_id // 2 % 6 * 10 AS INTEGER)) AS ts FROM readings) r GROUP BY 1, 2"""))
def ingest_autumn_hour(spark, sf):
    """The local hour that comes twice in autumn: both of its readings stay."""
    raw = scratch_dir(spark, "raw")
    rows = views.load(spark, sf, "readings")
    minute = F.lpad(((F.col("event_id") / 2).cast("long") % 6 * 10).cast("string"), 2, "0")
    zone = F.when(F.col("event_id") % 2 == 0, "CEST").otherwise("CET")
    name = F.concat(F.col("station_name"), F.lit("_"), "sensor", F.lit("_from_20201025_to_20201025.json"))
    records = rows.join(tables.stations(spark), "station_id").select(
        name.alias("file_name"), F.concat(F.lit("2020-10-25T02:"), minute, F.lit(":00"), zone).alias("DATE"), F.col("value").alias("VALUE"), F.col("event_id").alias("load_seq"))
    update.ingest(spark, portal.with_station_id(portal.parse_portal(records), tables.stations(spark)), raw, "load_seq", newest=True)
    return store.read_table(spark, raw).select("station_id", "ts_utc", "ts", *SENSOR_COLS)


_body, _ctes = _processed_sql("aligned")
_DRY = "dry AS (SELECT * FROM season_readings WHERE sensor <> 'N' OR ts < TIMESTAMP '2024-01-01 00:00:00')"


@query("update_incremental", duck(["season_readings"], _body, _DRY, _pivot("dry"), ALIGNED.replace("FROM readings", "FROM dry"), *_ctes))
def update_incremental(spark, sf):
    """Deliveries by year, no rain in the second; each rebuilds what it touches, and that equals a rebuild of all."""
    raw, done = scratch_dir(spark, "raw"), scratch_dir(spark, "processed")
    rows = views.load(spark, sf, "season_readings")
    for later in (False, True):
        part = rows.where((F.col("ts") >= F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")) == F.lit(later))
        update.ingest_and_rebuild(spark, part.where("sensor != 'N'") if later else part, raw, done, "event_id", newest=False)
    out = store.read_table(spark, done).where("rule != 'movavg'").drop("year")
    return rounded(out, 9, "n", "sd", "gs")


@query("update_moving", TRAILING)
def update_moving(spark, sf):
    """Moving averages written as the rule movavg and scanned station by station."""
    raw, done = scratch_dir(spark, "raw"), scratch_dir(spark, "processed")
    update.ingest(spark, views.load(spark, sf, "season_readings"), raw, "event_id")
    update.update_moving(spark, raw, done)
    table, out = store.read_table(spark, done), None
    for station in range(1, 7):
        rows = filters.scan_processed(table, station, "movAVG", "HS").withColumnRenamed("period", "ts")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("stream_hourly", duck(["readings"], f"""SELECT station_id, sensor, {P['hourly']} AS period, count(value) AS readings, sum(value) AS total, avg(value) AS mean
FROM readings GROUP BY 1, 2, 3 HAVING {P['hourly']} + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM readings)"""))
def stream_hourly(spark, sf):
    """Closed hours of the event stream."""
    path = scratch_dir(spark, "stream")
    ingest.run_to_table(ingest.closed_periods(views.load_stream(spark, sf, "readings"), "hourly"), f"{path}/out", f"{path}/state")
    return spark.read.parquet(f"{path}/out")


@query("stream_monthly", duck(["season_readings"], f"""SELECT station_id, sensor, CAST(last_day(CAST(ts AS DATE)) AS TIMESTAMP) AS period, CAST(count(value) AS BIGINT) AS readings, sum(value) AS total, avg(value) AS mean
FROM (SELECT * FROM season_readings WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM season_readings)) c
JOIN (SELECT station_id, sensor, max(date_trunc('day', ts)) AS last FROM season_readings WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM season_readings) GROUP BY 1, 2) l
  USING (station_id, sensor) GROUP BY 1, 2, 3, l.last HAVING last_day(CAST(min(ts) AS DATE)) < last_day(CAST(l.last AS DATE)) OR last_day(CAST(min(ts) AS DATE)) = CAST(l.last AS DATE)"""))
def stream_monthly(spark, sf):
    """Months of the season stream, from its stored closed days."""
    path = scratch_dir(spark, "stream")
    ingest.run_to_table(ingest.closed_periods(views.load_stream(spark, sf, "season_readings"), "daily"), f"{path}/out", f"{path}/state")
    return ingest.closed_months(spark.read.parquet(f"{path}/out"))


_CLOSED_MONTH = "CAST(last_day(CAST(ts AS DATE)) AS TIMESTAMP)"


@query("stream_months_closed", duck(["season_readings"], f"""SELECT station_id, sensor, {_CLOSED_MONTH} AS period, count(value) AS readings, sum(value) AS total, avg(value) AS mean
FROM season_readings GROUP BY 1, 2, 3 HAVING {_CLOSED_MONTH} + INTERVAL 1 DAY - INTERVAL 1 MICROSECOND <= (SELECT max(ts) - INTERVAL 1 HOUR FROM season_readings)"""))
def stream_months_closed(spark, sf):
    """Months of the season stream, closed by the stream itself."""
    path = scratch_dir(spark, "stream")
    ingest.run_to_table(ingest.closed_periods(views.load_stream(spark, sf, "season_readings"), "monthly"), f"{path}/out", f"{path}/state")
    return spark.read.parquet(f"{path}/out")


@query("stream_portal_files", duck(["portal"], f"""SELECT s.station_id, p.ts, {", ".join(f"max(value) FILTER (WHERE sensor = '{c.upper()}') AS {c}" for c in SENSOR_COLS)}
FROM ({PORTAL_SQL}) p JOIN stations s ON s.station_name = p.station GROUP BY 1, 2""", STATIONS_SQL))
def stream_portal_files(spark, sf):
    """Portal files through the file stream into the raw table; of copies the highest value wins here."""
    path = scratch_dir(spark, "stream")
    rows = portal.with_station_id(ingest.read_portal_stream(spark, _portal_files(spark, sf)), tables.stations(spark))
    rows = rows.withColumn("load_seq", F.col("value"))
    ingest.run_merge(rows, f"{path}/raw", f"{path}/state")
    return store.read_table(spark, f"{path}/raw").select("station_id", "ts", *SENSOR_COLS)


@query("stream_daily", duck(["readings"], f"""SELECT station_id, sensor, {P['daily']} AS period, count(value) AS readings, sum(value) AS total, avg(value) AS mean
FROM readings GROUP BY 1, 2, 3 HAVING {P['daily']} + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM readings)"""))
def stream_daily(spark, sf):
    """Closed days of the event stream."""
    path = scratch_dir(spark, "stream")
    ingest.run_to_table(ingest.closed_periods(views.load_stream(spark, sf, "readings"), "daily"), f"{path}/out", f"{path}/state")
    return spark.read.parquet(f"{path}/out")


@query("stream_weekly", duck(["readings"], f"""SELECT station_id, sensor, {P['weekly']} AS period, count(value) AS readings, sum(value) AS total, avg(value) AS mean
FROM readings GROUP BY 1, 2, 3 HAVING {P['weekly']} + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM readings)"""))
def stream_weekly(spark, sf):
    path = scratch_dir(spark, "stream")
    ingest.run_to_table(ingest.closed_periods(views.load_stream(spark, sf, "readings"), "weekly"), f"{path}/out", f"{path}/state")
    return spark.read.parquet(f"{path}/out")


@query("stream_dedup", duck(["readings"], "SELECT DISTINCT station_id, sensor, ts FROM readings"))
def stream_dedup(spark, sf):
    path = scratch_dir(spark, "stream")
    rows = ingest.deduplicated(views.load_stream(spark, sf, "readings")).select("station_id", "sensor", "ts")
    ingest.run_to_table(rows, f"{path}/out", f"{path}/state")
    return spark.read.parquet(f"{path}/out")


@query("stream_merge", duck(["readings"], "SELECT station_id, ts, lt, lf, hs, n, sd, gs FROM wide", _pivot("readings")))
def stream_merge(spark, sf):
    """Every micro-batch overlaid on the raw table."""
    path = scratch_dir(spark, "stream")
    ingest.run_merge(views.load_stream(spark, sf, "readings"), f"{path}/raw", f"{path}/state", "event_id", newest=False)
    return store.read_table(spark, f"{path}/raw").select("station_id", "ts", *SENSOR_COLS)


# --- isotopes, panels, filters -----------------------------------------------------------------------------

@query("isotope_line", duck(["isotopes"], """SELECT date, d18o, d2h, d18o - d18o_sd AS d18o_lo, d18o + d18o_sd AS d18o_hi, d2h - d2h_sd AS d2h_lo, d2h + d2h_sd AS d2h_hi,
  8 * d18o + 10 AS line, 8 * d18o + 2 AS line_lo, 8 * d18o + 18 AS line_hi FROM isotopes WHERE site = 'LimoseeNord'"""), dates="date")
def isotope_line(spark, sf):
    return panels.isotope_view(views.load(spark, sf, "isotopes"), "LimoseeNord")


@query("isotope_line_grid", duck(["isotopes"], """SELECT site, round(x, 7) AS x, round(8 * x + 10, 7) AS line, round(8 * x + 2, 7) AS line_lo, round(8 * x + 18, 7) AS line_hi
FROM (SELECT site, lo + i * 0.1e0 AS x FROM (SELECT site, lo, unnest(generate_series(0, CAST(ceil((hi - lo) / 0.1e0) AS INTEGER) - 1)) AS i
  FROM (SELECT site, min(d18o) - 1 AS lo, max(d18o) + 1 AS hi FROM isotopes GROUP BY 1) s) t) u"""))
def isotope_line_grid(spark, sf):
    """Water line and band sampled over the range of each site."""
    span = views.load(spark, sf, "isotopes").groupBy("site").agg((F.min("d18o") - 1).alias("lo"), (F.max("d18o") + 1).alias("hi"))
    out = span.select("site", F.inline(panels.water_line_grid(F.col("lo"), F.col("hi"))))
    return rounded(out, 7, "x", "line", "line_lo", "line_hi")


@query("isotope_by_date", duck(["isotopes"], "SELECT site, date, d18o, d18o - d18o_sd AS d18o_lo, d18o + d18o_sd AS d18o_hi FROM isotopes"), dates="date")
def isotope_by_date(spark, sf):
    return panels.isotopes_by_date(views.load(spark, sf, "isotopes"))


@query("isotope_by_date_without", duck(["isotopes"], "SELECT site, date, d18o, d18o - d18o_sd AS d18o_lo, d18o + d18o_sd AS d18o_hi FROM isotopes WHERE site <> 'LimoseeSüd'"), dates="date")
def isotope_by_date_without(spark, sf):
    return panels.isotopes_by_date(views.load(spark, sf, "isotopes"), "LimoseeSüd")


@query("isotope_sites", duck(["isotopes"], "SELECT DISTINCT site FROM isotopes"))
def isotope_sites(spark, sf):
    return panels.sites(views.load(spark, sf, "isotopes"))


WINTER_PANEL = """SELECT station_id, CAST(period AS DATE) AS date, coalesce(hs, 0) AS hs, CAST(year(period) - CASE WHEN month(period) < 9 THEN 1 ELSE 0 END AS INTEGER) AS season
  FROM processed WHERE rule = '{}' AND station_id IN (1, 2) AND month(period) <> 8 AND year(period) - CASE WHEN month(period) < 9 THEN 1 ELSE 0 END BETWEEN 1995 AND 2000
  AND year(period) - CASE WHEN month(period) < 9 THEN 1 ELSE 0 END <> 1997"""
WINTER_LABEL = "'Winter_' || lpad(CAST(season % 100 AS VARCHAR), 2, '0') || '_' || lpad(CAST((season + 1) % 100 AS VARCHAR), 2, '0') AS winter"
OVERRIDES = ("1996-10-17", "1996-11-03")


def _panels(spark, sf, rule, overrides=None):
    return panels.winter_panels(views.load(spark, sf, "processed"), rule, overrides, first=1995, last=2000, skip=(1997,))


@query("winter_panel_monthly", duck(["processed"], f"SELECT *, {WINTER_LABEL} FROM p", f"p AS ({WINTER_PANEL.format('monthly')})"), dates="date")
def winter_panel_monthly(spark, sf):
    return _panels(spark, sf, "monthly")


@query("winter_panel_daily", duck(["processed"], f"""SELECT station_id, date, CASE WHEN station_id = 1 AND date BETWEEN DATE '1996-10-17' AND DATE '1996-11-03' THEN 0 ELSE hs END AS hs,
  season, {WINTER_LABEL} FROM p SEMI JOIN (SELECT station_id, season FROM p GROUP BY 1, 2 HAVING max(abs(hs)) > 0) s USING (station_id, season)""",
    f"p AS ({WINTER_PANEL.format('daily')})"), dates="date")
def winter_panel_daily(spark, sf):
    """Daily winters with the zero period of one station."""
    zero = spark.sql(f"SELECT 1 AS station_id, DATE '{OVERRIDES[0]}' AS from_date, DATE '{OVERRIDES[1]}' AS to_date")
    return _panels(spark, sf, "daily", zero)


@query("winter_panel_keys", duck(["processed"], f"SELECT DISTINCT season, {WINTER_LABEL} FROM p", f"p AS ({WINTER_PANEL.format('monthly')})"))
def winter_panel_keys(spark, sf):
    return panels.panel_keys(_panels(spark, sf, "monthly"))


@query("range_scan", duck(["readings"], """SELECT station_id, ts, lt, hs FROM wide WHERE station_id = 2
  AND ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 00:00:00'""", _pivot("readings")))
def range_scan(spark, sf):
    return filters.scan_raw(wide(spark, sf), 2, "LT,HS", "20240105", "20240120")


@query("processed_scan", duck(["processed"], """SELECT station_id, period, n, lt FROM processed WHERE station_id = 4 AND rule = 'monthly'
  AND period BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1999-12-31 00:00:00'"""))
def processed_scan(spark, sf):
    return filters.scan_processed(views.load(spark, sf, "processed"), 4, "m", "N,LT", "19960101", "19991231").orderBy("period")


@query("open_clip", duck(["spring"], """SELECT site, ts, slt FROM spring WHERE ts > TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-09 00:00:00'"""))
def open_clip(spark, sf):
    lo, hi = (F.lit(t).cast("timestamp_ntz") for t in ("2024-01-05 06:00:00", "2024-01-09 00:00:00"))
    return filters.open_clip(views.load(spark, sf, "spring"), "ts", lo, hi).select("site", "ts", "slt")


@query("day_slice", duck(["spring"], """SELECT site, ts, slt FROM spring WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'"""))
def day_slice(spark, sf):
    return filters.day_slice(views.load(spark, sf, "spring"), "ts", "2024-01-05", "2024-01-09").select("site", "ts", "slt")


@query("season_slice", duck(["daily"], """SELECT station_id, date, hs, CAST(year(date) - CASE WHEN month(date) < 10 THEN 1 ELSE 0 END AS INTEGER) AS season FROM daily
WHERE month(date) NOT IN (7, 8, 9) AND year(date) - CASE WHEN month(date) < 10 THEN 1 ELSE 0 END BETWEEN 1996 AND 2000
  AND year(date) - CASE WHEN month(date) < 10 THEN 1 ELSE 0 END <> 1998"""), dates="date")
def season_slice(spark, sf):
    return filters.seasons(views.load(spark, sf, "daily").select("station_id", "date", "hs"), first=1996, last=2000, skip=(1998,))


@query("null_filters", duck(["lake_calc"], """SELECT 'any' AS kind, count(*) AS rows FROM lake_calc WHERE area_glatt IS NOT NULL AND volume IS NOT NULL AND wd IS NOT NULL
UNION ALL SELECT 'all', count(*) FROM lake_calc WHERE area_glatt IS NOT NULL OR volume IS NOT NULL OR wd IS NOT NULL
UNION ALL SELECT 'wd', count(*) FROM lake_calc WHERE wd IS NOT NULL
UNION ALL SELECT 'not_11', count(*) FROM lake_calc WHERE wd IS NULL OR wd <> 11
UNION ALL SELECT 'months', count(CASE WHEN month(date) BETWEEN 6 AND 10 THEN wd END) FROM lake_calc"""))
def null_filters(spark, sf):
    """Row counts after each kind of null, marker and month filter, from one scan."""
    cols = ["area_glatt", "volume", "wd"]
    lake = views.load(spark, sf, "lake_calc")
    date_ok = F.month("date").isin(*periods.EVAPORATION_MONTHS)
    known = {c: F.col(c).isNotNull() for c in cols}
    kinds = {
        "any": known["area_glatt"] & known["volume"] & known["wd"],
        "all": known["area_glatt"] | known["volume"] | known["wd"],
        "wd": known["wd"],
        "not_11": filters.is_not_value("wd", 11),
        "months": known["wd"] & date_ok,
    }
    counts = lake.agg(*[F.count_if(c).alias(k) for k, c in kinds.items()])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("rows")) for k in kinds])).alias("r")).select("r.*")


# hourly and daily processed rows in the time of the spring logger
PROCESSED_NOW = """now AS (SELECT station_id, 'hourly' AS rule, ts AS period, hs, lt, n FROM wide
UNION ALL SELECT station_id, 'daily' AS rule, date_trunc('day', ts) AS period, avg(hs), avg(lt), coalesce(sum(n), 0) FROM wide GROUP BY 1, 2, 3)"""


def _processed_now(spark, sf):
    rows = wide(spark, sf).select("station_id", "ts", "hs", "lt", "n")
    hourly = rows.select("station_id", F.lit("hourly").alias("rule"), F.col("ts").alias("period"), "hs", "lt", "n")
    daily = resample.resample(rows, "daily", {"hs": "mean", "lt": "mean", "n": "sum"}).withColumn("rule", F.lit("daily"))
    return hourly.unionByName(daily)


def _logger_sql(unit, sites, columns):
    means = ", ".join(f"avg({c}) AS {c}" for c in columns)
    cols = ", ".join(f"m.{c}" for c in columns)
    return f"""logger AS (SELECT site, period, {cols} FROM (SELECT site, unnest(generate_series(date_trunc('{unit}', min(ts)), date_trunc('{unit}', max(ts)), INTERVAL 1 {unit})) AS period
  FROM spring WHERE site IN ({sites}) GROUP BY 1) g LEFT JOIN (SELECT site, date_trunc('{unit}', ts) AS period, {means} FROM spring GROUP BY 1, 2) m USING (site, period))"""


# per logger: rows of a station from its first to its last day, inside its open span
BESIDE = """spans AS (SELECT site, min(period) AS mn, max(period) AS mx FROM logger GROUP BY 1),
beside AS (SELECT site, now.* FROM now JOIN spans ON period BETWEEN date_trunc('day', mn) AND date_trunc('day', mx)),
inside AS (SELECT beside.* FROM beside JOIN spans USING (site) WHERE period > mn AND period < mx)"""
CLIP_EACH = "period > (SELECT mn FROM spans s WHERE s.site = q.site) AND period < (SELECT mx FROM spans s WHERE s.site = q.site)"
IN_SPAN = "period BETWEEN (SELECT date_trunc('day', min(period)) FROM logger) AND (SELECT date_trunc('day', max(period)) FROM logger)"
CLIP = "period > (SELECT min(period) FROM logger) AND period < (SELECT max(period) FROM logger)"


def _roll(c, least):
    return f"CASE WHEN count({c}) OVER w >= {least} THEN avg({c}) OVER w END AS {c}_rol"


SITES = "'lower', 'upper', 'spring'"


@query("spring_panel_hourly", duck(["spring", "readings"], f"""SELECT site, period, l.wt, l.slt, round(l.slt_rol, 9) AS slt_rol, round(l.wt_rol, 9) AS wt_rol, r.n FROM (
  SELECT * FROM (SELECT *, {_roll('slt', 24)}, {_roll('wt', 24)} FROM logger WINDOW w AS (PARTITION BY site ORDER BY period ROWS BETWEEN 12 PRECEDING AND 11 FOLLOWING)) q WHERE {CLIP_EACH}) l
FULL OUTER JOIN (SELECT site, period, n FROM inside WHERE rule = 'hourly' AND station_id = 4) r USING (site, period)""",
    _pivot("readings"), PROCESSED_NOW, _logger_sql("hour", SITES, ["wt", "slt"]), BESIDE))
def spring_panel_hourly(spark, sf):
    spring = views.load(spark, sf, "spring")
    return rounded(panels.spring_panel(spring, _processed_now(spark, sf), "Hourly"), 9, "slt_rol", "wt_rol")


@query("spring_snow_panel", duck(["spring", "readings"], f"""SELECT site, period, l.wt, l.slt, round(l.slt_rol, 9) AS slt_rol, round(l.wt_rol, 9) AS wt_rol, r.n,
  s.hs, s.lt, round(s.hs_rol, 9) AS hs_rol, round(s.lt_rol, 9) AS lt_rol FROM (
  SELECT * FROM (SELECT *, {_roll('slt', 16)}, {_roll('wt', 16)} FROM (SELECT site, ts AS period, wt, slt FROM sclean) c
    WINDOW w AS (PARTITION BY site ORDER BY period ROWS BETWEEN 12 PRECEDING AND 11 FOLLOWING)) q WHERE {CLIP_EACH}) l
FULL OUTER JOIN (SELECT site, period, n FROM inside WHERE rule = 'hourly' AND station_id = 4) r USING (site, period)
FULL OUTER JOIN (SELECT site, period, hs, lt, hs_rol, lt_rol FROM (SELECT *, {_roll('hs', 16)}, {_roll('lt', 16)} FROM beside WHERE rule = 'hourly' AND station_id = 2
    WINDOW w AS (PARTITION BY site ORDER BY period ROWS BETWEEN 12 PRECEDING AND 11 FOLLOWING)) q WHERE {CLIP_EACH}) s USING (site, period)""",
    _pivot("readings"), PROCESSED_NOW, _logger_sql("hour", SITES, ["wt", "slt"]), BESIDE,
    SPRING_CLEAN.replace("FROM spring WINDOW", "FROM (SELECT site, period AS ts, wt, slt FROM logger) lg WINDOW")))
def spring_snow_panel(spark, sf):
    spring = views.load(spark, sf, "spring")
    out = panels.spring_snow_panel(spring, _processed_now(spark, sf), "Hourly", clean=True)
    return rounded(out, 9, "slt_rol", "wt_rol", "hs_rol", "lt_rol")


CLIP_LOW = CLIP.replace("FROM logger", "FROM logger WHERE site = 'lower'")
IN_SPAN_LOW = IN_SPAN.replace("FROM logger", "FROM logger WHERE site = 'lower'")


@query("lake_level_panel", duck(["spring", "readings"], f"""SELECT period, a.wd AS wd_lower, a.wt AS wt_lower, b.wd AS wd_upper, b.wt AS wt_upper, r.n
FROM (SELECT * FROM logger WHERE site = 'lower' AND {CLIP_LOW}) a
FULL OUTER JOIN (SELECT * FROM logger WHERE site = 'upper' AND {CLIP_LOW}) b USING (period)
FULL OUTER JOIN (SELECT period, n FROM now WHERE rule = 'daily' AND station_id = 4 AND {IN_SPAN_LOW} AND {CLIP_LOW}) r USING (period)""",
    _pivot("readings"), PROCESSED_NOW, _logger_sql("day", "'lower', 'upper'", ["wd", "wt"])))
def lake_level_panel(spark, sf):
    loggers = views.load(spark, sf, "spring").where("site IN ('lower', 'upper')")
    return panels.lake_level_panel(loggers, _processed_now(spark, sf), columns=("wd", "wt"))


LAKE_OF = {"lower": "Limo", "upper": "Parom", "spring": "Limo"}


@query("lake_volume_panel", duck(["spring", "readings"], f"""SELECT site, CASE site WHEN 'upper' THEN 'Parom' ELSE 'Limo' END AS lake, period, a.wd, a.vol, r.n
FROM (SELECT site, period, wd, CASE site WHEN 'upper' THEN (1372.99e0 * wd + -2808.53e0) * wd + 1728.66e0 ELSE (931.46e0 * wd + -739.07e0) * wd + 698.83e0 END AS vol
      FROM logger q WHERE {CLIP_EACH}) a
FULL OUTER JOIN (SELECT site, period, n FROM inside WHERE rule = 'daily' AND station_id = 4) r USING (site, period)""",
    _pivot("readings"), PROCESSED_NOW, _logger_sql("day", SITES, ["wd"]), BESIDE))
def lake_volume_panel(spark, sf):
    """Every logger with the rating of its lake."""
    return panels.lake_volume_panel(views.load(spark, sf, "spring"), _processed_now(spark, sf), LAKE_OF)


@query("snow_monthly", duck(["monthly"], """SELECT m.station_id, m.period, m.hs, y.n AS n_year FROM monthly m
LEFT JOIN (SELECT year(period) AS year, coalesce(sum(n), 0) AS n FROM monthly WHERE station_id = 4 GROUP BY 1 HAVING count(*) = 12) y ON y.year = year(m.period)
WHERE m.station_id IN (1, 2)"""))
def snow_monthly(spark, sf):
    return panels.snow_monthly(views.load(spark, sf, "processed"))
